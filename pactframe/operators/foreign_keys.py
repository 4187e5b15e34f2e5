"""Foreign keys: rows whose key has no match in the parent table.

A row with a NULL in any part of the key passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import all_present
from ..functions.names import absent_columns, quoted, target_table_name
from ..model import Rule, TableContract
from .findings import FOREIGN_KEY, Finding, union_all
from .keys import key_parts, key_sizes
from .matching import HOT_ROWS, fits_broadcast, rows_with_keys
from .rows import Skipped

TableLookup = Callable[[str], DataFrame | None]
ParentKey = tuple[str, tuple[str, ...]]  # parent table and its key columns


@dataclass(frozen=True)
class ForeignKey:
    """A foreign key with its parent table found and its parent columns known."""

    rule: Rule
    parent_table: str
    columns: tuple[str, ...]
    ref_columns: tuple[str, ...]

    @property
    def parent(self) -> ParentKey:
        return self.parent_table, self.ref_columns

    @property
    def finding(self) -> Finding:
        return Finding(FOREIGN_KEY, self.rule.name, self.columns)


def parents_named(
    rule: Rule, contracts: Iterable[TableContract], schema: str | None
) -> list[TableContract]:
    """The contracts a foreign key's parent may be, by source schema and name. More than one is
    left only if neither the rule nor the child's schema tells them apart."""
    table = rule.ref_table.upper()
    named = [c for c in contracts if c.source_name == table]
    if rule.ref_schema:
        # a contract without a schema may stand for any
        return [c for c in named if c.source_schema in (None, rule.ref_schema.upper())]
    beside = [c for c in named if schema and c.source_schema == schema.upper()]
    return beside or named


def resolve(
    rule: Rule,
    df: DataFrame,
    lookup: TableLookup,
    contracts: Mapping[str, TableContract],
    overrides: Mapping[str, str] | None = None,
    schema: str | None = None,
) -> ForeignKey | Skipped:
    """Settle from the contracts alone whether, and against what, a foreign key is tested.

    The parent is the contract whose source table the rule names, in the schema the rule names or
    else in `schema`, the child's own; without one an override or the naming rule gives its table.
    Without parent columns the parent's primary key is meant.
    """

    def skip(reason: str) -> Skipped:
        return Skipped(FOREIGN_KEY, rule.label, reason)

    named = parents_named(rule, contracts.values(), schema)
    if len(named) > 1:
        places = sorted(f"{c.source_schema}.{c.source_name}" for c in named)
        return skip(f"the parent may be any of {places}")
    parent_contract = named[0] if named else None
    if parent_contract:
        parent_table = parent_contract.target_name
    else:
        parent_table = target_table_name(rule.ref_table, overrides)
        if not rule.ref_schema:
            parent_contract = contracts.get(parent_table)
    ref_columns = rule.ref_columns
    if not ref_columns:
        if parent_contract and parent_contract.primary_key:
            ref_columns = parent_contract.primary_key.columns
    if not ref_columns:
        return skip("the parent columns are not known")
    if len(ref_columns) != len(rule.columns):
        return skip(f"{len(rule.columns)} columns refer to {len(ref_columns)}")
    parent = lookup(parent_table)
    if parent is None:
        return skip(f"parent table {parent_table} was not found")
    missing = absent_columns(df, rule.columns) + absent_columns(parent, ref_columns)
    if missing:
        return skip(f"no column {missing}")
    return ForeignKey(rule, parent_table, rule.columns, ref_columns)


def parent_keys(parent: DataFrame, ref_columns: Sequence[str]) -> DataFrame:
    return parent.selectExpr(
        *[f"{quoted(name)} AS __p{i}" for i, name in enumerate(ref_columns)]
    )


def _without_parent(keys: DataFrame, names: Sequence[str], parents: DataFrame) -> DataFrame:
    """Left anti join of key columns on the columns of `parents`, in order."""
    same = " AND ".join(f"{quoted(name)} = __p{i}" for i, name in enumerate(names))
    return keys.join(parents, F.expr(same), "left_anti")


def with_parent_marks(df: DataFrame, keys: Sequence[tuple[ForeignKey, DataFrame]]) -> DataFrame:
    """`df` with a column `__found<i>` per foreign key that says whether the parent is there.

    For parents that were measured and are broadcast together: any number of foreign keys is
    then tested in the same pass as the row rules, and parent duplicates add no rows.
    """
    # Outer references need names that no parent has, as a table may refer to itself.
    renamed = [
        f"{quoted(name)} AS __f{i}_{j}"
        for i, (key, _) in enumerate(keys)
        for j, name in enumerate(key.columns)
    ]
    marks = []
    for i, (key, parent) in enumerate(keys):
        same = reduce(
            and_,
            (F.col(f"__p{j}") == F.col(f"__f{i}_{j}").outer() for j in range(len(key.columns))),
        )
        parents = F.broadcast(parent_keys(parent, key.ref_columns))
        marks.append(parents.where(same).exists().alias(f"__found{i}"))
    return df.selectExpr("*", *renamed).select("*", *marks)


def orphan_count(key: ForeignKey, place: int) -> str:
    """Aggregate over `with_parent_marks` that counts the orphans of one foreign key."""
    return f"count_if({is_orphan(key, place)})"


def is_orphan(key: ForeignKey, place: int) -> str:
    """Condition over `with_parent_marks` that holds for the orphans of one foreign key."""
    return f"{all_present(key.columns)} AND NOT __found{place}"


def _shared_type(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The type in which two key columns are compared: their own, or the widest integer. None where equality
    would cast in another way."""
    if one == other:
        return None if isinstance(one, (T.MapType, T.VariantType)) else one
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return T.LongType() if isinstance(one, whole) and isinstance(other, whole) else None


def shared_types(child: DataFrame, parent: DataFrame, key: ForeignKey) -> list[T.DataType] | None:
    """The types a key's parts are compared in, or None if `count_orphans_together` cannot take it."""
    found = [
        _shared_type(child.select(quoted(a)).schema[0].dataType, parent.select(quoted(b)).schema[0].dataType)
        for a, b in zip(key.columns, key.ref_columns)
    ]
    return None if None in found else found


def count_orphans_together(
    child: DataFrame, keys: Sequence[tuple[ForeignKey, DataFrame]]
) -> DataFrame:
    """One row with `orphans<i>`, the child rows without a parent for each of several foreign keys.

    Child and parent keys, each with the number of its foreign key, are one frame: one scan of the child,
    one of each parent, one shuffle, and one aggregate that sees both sides. Rows are counted before the
    shuffle. Keys of one type share a column; `shared_types` says which keys can take part.
    """
    slots: list[tuple[str, int]] = []
    placed: list[list[int]] = []  # for each key the slots of its parts
    for key, parent in keys:
        seen: dict[str, int] = {}
        own = []
        for kind in shared_types(child, parent, key):
            name = kind.simpleString()
            seen[name] = seen.get(name, -1) + 1
            if (name, seen[name]) not in slots:
                slots.append((name, seen[name]))
            own.append(slots.index((name, seen[name])))
        placed.append(own)
    parts = [f"__s{k}" for k in range(len(slots))]

    def tagged(df: DataFrame, names_of: Mapping[int, Sequence[str]]) -> DataFrame:
        """The keys of `df` that have all their parts, with the numbers of their foreign keys."""
        entries = []
        for number, names in names_of.items():
            values = ["NULL"] * len(slots)
            for slot, name in zip(placed[number], names):
                values[slot] = quoted(name)
            typed = [f"CAST({v} AS {kind})" for v, (kind, _) in zip(values, slots)]
            entries.append(", ".join([str(number), all_present(names), *typed]))
        stacked = f"stack({len(entries)}, {', '.join(entries)}) AS ({', '.join(['__fk', '__ok', *parts])})"
        return df.selectExpr(stacked).where("__ok").drop("__ok")

    rows = [tagged(child, {k: key.columns for k, (key, _) in enumerate(keys)}).selectExpr("*", "1L AS n", "false AS there")]
    by_parent: dict[str, tuple[DataFrame, dict[int, Sequence[str]]]] = {}
    for number, (key, parent) in enumerate(keys):
        by_parent.setdefault(key.parent_table, (parent, {}))[1][number] = key.ref_columns
    for parent, names_of in by_parent.values():
        rows.append(tagged(parent, names_of).selectExpr("*", "0L AS n", "true AS there"))
    sizes = union_all(rows).groupBy("__fk", *parts).agg(F.sum("n").alias("n"), F.bool_or("there").alias("there"))
    return sizes.selectExpr(
        *[f"coalesce(sum(if(__fk = {k} AND NOT there, n, 0L)), 0L) AS orphans{k}" for k in range(len(keys))]
    )


def orphan_key_sizes(
    child: DataFrame, parent: DataFrame, columns: Sequence[str], ref_columns: Sequence[str]
) -> DataFrame:
    """Keys without a parent as `__k0`, ... and `count`, the number of child rows of each.

    The child is reduced to its distinct keys before the join and the join reuses that
    partitioning, so no key is ever more than one row on either side. When the parent is
    small enough to broadcast, Catalyst moves the join below the grouping by itself.
    """
    sizes = key_sizes(child.where(all_present(columns)), columns)
    parents = parent_keys(parent, ref_columns).distinct()
    return _without_parent(sizes, key_parts(columns), parents)


def orphan_rows(
    child: DataFrame,
    parent: DataFrame,
    columns: Sequence[str],
    ref_columns: Sequence[str],
    small_parent: bool | None = None,
) -> DataFrame:
    """Number of child rows without a parent, as one row `orphan_rows`.

    `small_parent` says whether the parent's keys fit a broadcast; unless it is given they
    are measured. The child of a small parent is filtered in place and not shuffled.
    """
    if small_parent is None:
        small_parent = fits_broadcast(parent_keys(parent, ref_columns))
    if small_parent:
        found = fk_orphans(child, parent, columns, ref_columns, small_parent=True)
        return found.selectExpr("count(1) AS orphan_rows")
    sizes = orphan_key_sizes(child, parent, columns, ref_columns)
    return sizes.selectExpr("coalesce(sum(count), 0L) AS orphan_rows")


def fk_orphans(
    child: DataFrame,
    parent: DataFrame,
    columns: Sequence[str],
    ref_columns: Sequence[str],
    small_parent: bool | None = None,
    hot_rows: int | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """The child rows without a parent; for `small_parent` see `orphan_rows`.

    Against a small parent this is one pass over the child. Otherwise
    the orphan keys are found first from the key columns alone, and the full rows are then
    picked by those keys instead of being shuffled.
    """
    parents = parent_keys(parent, ref_columns)
    if small_parent is None:
        small_parent = fits_broadcast(parents, broadcast_bytes)
    if small_parent:
        rows = child.where(all_present(columns))
        return _without_parent(rows, columns, F.broadcast(parents))
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    sizes = key_sizes(child.where(all_present(columns)), columns)
    same = " AND ".join(f"{part} = __p{i}" for i, part in enumerate(key_parts(columns)))
    keys = (
        sizes.join(parents.distinct(), F.expr(same), "left")
        .selectExpr(*sizes.columns, "__p0 IS NULL AS wanted")
        .where(f"wanted OR count >= {hot_rows}")
    )
    return rows_with_keys(child, keys, columns, False, hot_rows, broadcast_bytes)
