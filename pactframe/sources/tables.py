"""Contracted tables in storage and in the catalogue."""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field, replace
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.names import folded, quoted, sql_text
from ..model import Rule, TableContract
from ..operators.conform import CAST, check_set_aside, split_staged, stage
from ..scratch import checkpointed
from .files import Folder

# Conditions under which a file source says that nothing is stored at a path.
NOTHING_STORED = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}
# Providers that keep NOT NULL; a file source reads every column back as nullable.
KEEPS_NULLABILITY = {"delta"}


@dataclass(frozen=True)
class TableStore:
    """Where contracted tables live: `<root>/<target name>`, registered as
    `[catalog.]schema_name.<target name>`."""

    root: str
    provider: str = "delta"
    schema_name: str = "default"
    catalog: str | None = None
    overrides: Mapping[str, str] = field(default_factory=dict)

    def path(self, target: str) -> str:
        return f"{self.root.rstrip('/')}/{target}"

    @property
    def namespace(self) -> str:
        return ".".join(quoted(part) for part in (self.catalog, self.schema_name) if part)

    def identifier(self, target: str) -> str:
        return f"{self.namespace}.{quoted(target)}"

    @property
    def keeps_nullability(self) -> bool:
        return self.provider in KEEPS_NULLABILITY


class DataLossError(RuntimeError):
    """Replacing a table would drop its rows."""


class SchemaMismatch(ValueError):
    """A stored table differs from its contract."""


class UnrepeatableInput(RuntimeError):
    """The input of a load gave other rows when it was read again."""


class LocationError(RuntimeError):
    """A catalogue name already stands for another path."""


def read_table(
    spark: SparkSession, store: TableStore, target: str, by_name: bool = False
) -> DataFrame:
    """The stored table, found by its path or by its catalogue name."""
    if by_name:
        return spark.table(store.identifier(target))
    return spark.read.format(store.provider).load(store.path(target))


def table_exists(
    spark: SparkSession, store: TableStore, target: str, by_name: bool = False
) -> bool:
    if by_name:
        return spark.catalog.tableExists(store.identifier(target))
    if store.provider == "delta":
        from delta.tables import DeltaTable  # present wherever the provider is in use

        return DeltaTable.isDeltaTable(spark, store.path(target))
    return find_table(spark, store, target) is not None


def find_table(spark: SparkSession, store: TableStore, target: str) -> DataFrame | None:
    """The table, or None when nothing is stored at its path."""
    if store.provider == "delta":
        return read_table(spark, store, target) if table_exists(spark, store, target) else None
    try:
        return read_table(spark, store, target)
    except AnalysisException as error:
        if error.getCondition() in NOTHING_STORED:
            return None
        raise


def ensure_namespace(spark: SparkSession, store: TableStore) -> TableStore:
    """Create the schema and return the store under the name that worked: with the catalog
    if there is one and it takes nested names, else without."""
    attempts = [store, replace(store, catalog=None)] if store.catalog else [store]
    for attempt in attempts[:-1]:
        try:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {attempt.namespace}")
            return attempt
        except AnalysisException:
            continue
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {attempts[-1].namespace}")
    return attempts[-1]


def _plain_path(location: str) -> str:
    """A location without its trailing slash, and without the scheme of local files."""
    location = location.rstrip("/")
    parsed = urlparse(location)
    return unquote(parsed.path) if parsed.scheme == "file" else location


def register_table(spark: SparkSession, store: TableStore, target: str) -> None:
    """Make the table known to the catalogue, and check that its name stands for its path:
    `IF NOT EXISTS` alone would keep quiet about another one."""
    identifier, path = store.identifier(target), store.path(target)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {identifier} "
        f"USING {store.provider} LOCATION {sql_text(path)}"
    )
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {identifier}").where("col_name = 'Location'")
    location = details.first()["data_type"]
    if _plain_path(location) != _plain_path(path):
        raise LocationError(f"{identifier} is registered at {location}, not at {path}")


def create_table(
    spark: SparkSession,
    store: TableStore,
    contract: TableContract,
    mode: str = "register",
    allow_data_loss: bool = False,
) -> str:
    """Create the contracted table without rows; returns "created", "registered" or "replaced".

    What happens when it is already there depends on `mode`: "create" fails, "register"
    leaves the data alone and registers it, "replace" writes an empty table over it, which
    needs `allow_data_loss` if there are rows.
    """
    if mode not in ("create", "register", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    target = contract.target_name
    restore_replaced(spark, store, target)
    present = find_table(spark, store, target)
    if present is not None and mode == "register":
        register_table(spark, store, target)
        return "registered"
    if present is not None and mode == "replace":
        if not allow_data_loss and not present.isEmpty():
            raise DataLossError(f"{target} holds rows; pass allow_data_loss=True to drop them")
    empty = spark.createDataFrame([], contract.schema)
    if present is not None and mode == "replace" and store.provider != "delta":
        _swap_in(spark, store, contract, empty)
    else:
        (
            empty.write.format(store.provider)
            .mode("overwrite" if mode == "replace" else "errorifexists")
            .option("overwriteSchema", "true")
            .save(store.path(target))
        )
    register_table(spark, store, target)
    if present is not None:
        spark.catalog.refreshTable(store.identifier(target))
    return "created" if present is None else "replaced"


def _beside(target: str, what: str) -> str:
    """The name of a hidden folder next to a table's."""
    return f"_{what}.{target}"


def restore_replaced(spark: SparkSession, store: TableStore, target: str) -> bool:
    """Put back a table that a replacement was interrupted in moving aside; True if there was one."""
    if store.provider == "delta":
        return False
    root, old = Folder(spark, store.root), _beside(target, "old")
    if root.exists(target) or not root.exists(old):
        return False
    root.rename(old, target)
    return True


def _swap_in(
    spark: SparkSession, store: TableStore, contract: TableContract, rows: DataFrame
) -> None:
    """Put a new table in the place of a stored one.

    The new one is written beside it and read back first. Until then the old one is untouched; then
    it is moved aside, the new one takes its place, and only after that the old files go. A run that dies
    between the two moves leaves the old table whole beside: `restore_replaced` puts it back.
    """
    target = contract.target_name
    root, new, old = Folder(spark, store.root), _beside(target, "new"), _beside(target, "old")
    root.delete(new)
    rows.write.format(store.provider).save(f"{root.path}/{new}")
    written = spark.read.format(store.provider).load(f"{root.path}/{new}").schema
    if [(f.name, f.dataType) for f in written] != [(f.name, f.dataType) for f in contract.schema]:
        raise SchemaMismatch(f"{target} was written as {written.simpleString()}; the stored table is as it was")
    root.delete(old)  # left by a replacement that ended after its moves
    root.rename(target, old)
    try:
        root.rename(new, target)
    except Exception:
        root.rename(old, target)
        raise
    root.delete(old)


def contract_properties(contract: TableContract, prefix: str = "oracle") -> dict[str, str]:
    """The contract's facts as table properties holding JSON."""

    def key(rule: Rule) -> dict:
        return {"name": rule.name, "columns": list(rule.columns)}

    def unique(origin: str) -> list[dict]:
        return [key(r) for r in contract.rules_of("unique") if r.origin == origin]

    foreign_keys = [
        key(r)
        | {
            "ref_schema": r.ref_schema,
            "ref_table": r.ref_table,
            "ref_columns": list(r.ref_columns),
        }
        for r in contract.rules_of("foreign_key")
    ]
    checks = [{"name": r.name, "expression": r.expression} for r in contract.rules_of("check")]
    # The property names.
    facts = {
        "primary_key": key(contract.primary_key) if contract.primary_key else {},
        "unique_keys": unique("constraint"),
        "foreign_keys": foreign_keys,
        "check_constraints": checks,
        "not_null_columns": list(contract.required),
        "defaults": {
            c.name: contract.fill_expression(c.name)
            for c in contract.columns
            if contract.fill_expression(c.name) is not None
        },
        "unique_indexes": unique("index"),
    }
    texts = {"source_schema": contract.source_schema or "", "source_table": contract.source_name}
    texts |= {name: json.dumps(value) for name, value in facts.items()}
    return {f"{prefix}.{name}": text for name, text in texts.items()}


def write_contract_properties(
    spark: SparkSession, store: TableStore, contract: TableContract, prefix: str = "oracle"
) -> None:
    pairs = ", ".join(
        f"{sql_text(name)} = {sql_text(value)}"
        for name, value in contract_properties(contract, prefix).items()
    )
    spark.sql(f"ALTER TABLE {store.identifier(contract.target_name)} SET TBLPROPERTIES ({pairs})")


def read_contract_properties(
    spark: SparkSession, store: TableStore, target: str, prefix: str = "oracle"
) -> dict[str, str]:
    """The properties written by `write_contract_properties`."""
    shown = spark.sql(f"SHOW TBLPROPERTIES {store.identifier(target)}")
    mine = shown.where(F.col("key").startswith(f"{prefix}."))
    return {row.key: row.value for row in mine.collect()}


def check_loadable(spark: SparkSession, contract: TableContract, store: TableStore) -> None:
    """Raises unless the table is there and has the contract's columns, in type and name.

    Files appended in another type would make a file table unreadable; to a path without a table
    they would make one that no catalogue knows.
    """
    target = contract.target_name
    stored = find_table(spark, store, target)
    if stored is None:
        raise LookupError(f"table {target} was not found at {store.path(target)}; create it first")
    declared = {folded(spark, f.name): f.dataType for f in contract.schema.fields}
    actual = {folded(spark, f.name): f.dataType for f in stored.schema.fields}
    found = [f"no column {name}" for name in declared if name not in actual]
    found += [f"column {name} is not declared" for name in actual if name not in declared]
    found += [
        f"{name} is stored as {actual[name].simpleString()}, declared as {kind.simpleString()}"
        for name, kind in declared.items()
        if name in actual and actual[name] != kind
    ]
    if found:
        raise SchemaMismatch(f"{target} cannot take rows: {'; '.join(found)}")


def refresh(spark: SparkSession, store: TableStore, target: str) -> None:
    """Lets later reads of this session, by path and by name, see new files."""
    spark.catalog.refreshByPath(store.path(target))
    if spark.catalog.tableExists(store.identifier(target)):
        spark.catalog.refreshTable(store.identifier(target))


@dataclass(frozen=True)
class LoadResult:
    """What a load saw: rows read, rows appended, and the failures of each rule."""

    rows_read: int
    rows_loaded: int
    failures: dict[tuple[str, str], int]

    @property
    def rows_set_aside(self) -> int:
        return self.rows_read - self.rows_loaded

    def to_json(self) -> str:
        failures = [[*rule, n] for rule, n in self.failures.items()]
        return json.dumps({"rows_read": self.rows_read, "rows_loaded": self.rows_loaded, "failures": failures})

    @classmethod
    def from_json(cls, text: str) -> LoadResult:
        held = json.loads(text)
        failures = {(kind, label): n for kind, label, n in held["failures"]}
        return cls(held["rows_read"], held["rows_loaded"], failures)


LOADS = "_loads"  # hidden from readers of the table


def load_table(
    df: DataFrame,
    contract: TableContract,
    store: TableStore,
    set_aside: Collection[str] = (CAST,),
    set_aside_path: str | None = None,
    fill_defaults: bool = True,
    batch_id: str | None = None,
    read_once: bool = False,
) -> LoadResult:
    """Append `df` to a contracted table in its declared columns.

    Rows failing a rule of a kind in `set_aside` stay out of the table; other failures are
    only counted. All counts are taken by the write itself. The rows set aside are written
    to `set_aside_path` as they came in, with what is wrong with each. The table
    must be there and have the contract's schema.

    Everything is written to hidden folders first, in the table and in `set_aside_path`; a marker then makes
    the load valid, and its files are moved into place. A load that dies before the marker has changed
    nothing. With a `batch_id` it can be repeated: once marked it is only completed, not done again, and
    the result is that of the first time. Two loads of one id must not run at once. While files are moved a
    reader may see some of them. Delta appends in commits of its own and takes no `batch_id`.

    The input is read a second time if rows are set aside; if it then gives another number of them, nothing is
    loaded and `UnrepeatableInput` is raised. With `read_once` the staged rows are stored first, for
    inputs that are costly or cannot be read again.
    """
    spark, target = df.sparkSession, contract.target_name
    check_set_aside(set_aside, set_aside_path)
    if store.provider == "delta":
        if batch_id is not None:
            raise ValueError("a batch_id is for file tables")
        return _append(df, contract, store, set_aside, fill_defaults, store.path(target), set_aside_path, read_once)
    name = f"{LOADS}/{batch_id or uuid.uuid4().hex}"
    table = Folder(spark, store.path(target))
    aside = Folder(spark, set_aside_path) if set_aside_path else None
    if not table.exists(f"{name}/marked"):
        check_loadable(spark, contract, store)
        for folder in (table, aside):
            if folder is not None:
                folder.delete(name)  # what a load of this id left when it died
        try:
            result = _append(
                df, contract, store, set_aside, fill_defaults, f"{table.path}/{name}/rows",
                aside and f"{aside.path}/{name}/rows", read_once,
            )
        except Exception:
            for folder in (table, aside):
                if folder is not None:
                    folder.delete(name)
            raise
        table.write_text(f"{name}/marked", result.to_json())
    _complete(table, aside, name)
    refresh(spark, store, target)
    result = LoadResult.from_json(table.read_text(f"{name}/marked"))
    if batch_id is None:
        table.delete(name)
    return result


def _complete(table: Folder, aside: Folder | None, name: str) -> None:
    """Move the files of a marked load into place; those that were moved before are gone from its folder."""
    for folder in (aside, table):
        if folder is not None:
            for file in folder.names(f"{name}/rows"):
                if not file.startswith(("_", ".")):
                    folder.rename(f"{name}/rows/{file}", file)
            folder.delete(f"{name}/rows")
    if aside is not None:
        aside.delete(name)


def _append(
    df: DataFrame,
    contract: TableContract,
    store: TableStore,
    set_aside: Collection[str],
    fill_defaults: bool,
    path: str,
    aside_path: str | None,
    read_once: bool,
) -> LoadResult:
    """Write the rows that fit and those set aside, and count both and every failure."""
    staged = stage(df, contract, fill_defaults)
    if read_once:
        staged = replace(staged, rows=checkpointed(staged.rows))
    seen = Observation()
    counts = [F.expr(f"count_if({test.failure}) AS t{i}") for i, test in enumerate(staged.tests)]
    observed = replace(
        staged,
        rows=staged.rows.observe(
            seen,
            F.count(F.lit(1)).alias("n_read"),
            F.expr(f"count_if(NOT {staged.is_set_aside(set_aside)}) AS n_loaded"),
            *counts,
        ),
    )
    fitting, _ = split_staged(observed, contract, set_aside)
    fitting.write.format(store.provider).mode("append").save(path)
    got = seen.get
    failures = {
        (test.finding.kind, test.finding.label): got[f"t{i}"]
        for i, test in enumerate(staged.tests)
        if got[f"t{i}"]
    }
    result = LoadResult(got["n_read"], got["n_loaded"], failures)
    if result.rows_set_aside:
        _, rejected = split_staged(staged, contract, set_aside)
        again = Observation()
        rejected = rejected.observe(again, F.count(F.lit(1)).alias("n"))
        rejected.write.format(store.provider).mode("append").save(aside_path)
        if again.get["n"] != result.rows_set_aside:
            raise UnrepeatableInput(
                f"{contract.target_name}: {result.rows_set_aside} rows were set aside while loading and "
                f"{again.get['n']} when they were read again to be stored"
            )
    return result
