"""All rules of one table, or of many, as one report.

A table costs one fused aggregate for its row rules and the foreign keys to small parents,
one grouping for all its keys and one for all its foreign keys to large parents. The parts
are independent branches of one union, so a single action runs them side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import any_present
from ..functions.names import absent_columns, folded, quoted
from ..model import PRIMARY_KEY, UNIQUE, TableContract
from ..operators.findings import (
    ERROR,
    PRIMARY_KEY_DUPLICATE,
    REPORT_SCHEMA,
    ROW_COUNT,
    SCHEMA,
    SKIPPED,
    UNIQUE_DUPLICATE,
    Finding,
    RuleBook,
    numbered,
    union_all,
)
from ..operators.foreign_keys import (
    ForeignKey,
    ParentKey,
    TableLookup,
    count_orphans_together,
    fk_orphans,
    is_orphan,
    orphan_count,
    orphan_rows,
    parent_keys,
    resolve,
    shared_types,
    with_parent_marks,
)
from ..operators import file_ranges
from ..operators.file_ranges import duplicates_in_splits, lone_splits, stored_bytes
from ..operators.keys import (
    HASH_FIRST_ROWS,
    count_groups,
    count_duplicates,
    count_duplicates_together,
    rows_with_duplicate_key,
)
from ..operators.matching import BROADCAST_BYTES, key_bytes
from ..operators.rows import (
    RowTest,
    Skipped,
    count_failures,
    count_rows_and_failures,
    row_tests,
    rows_violating,
)


# What one job plans and reads at most, unless one table is more.
SCANS_PER_JOB = 96
BYTES_PER_JOB = 4 * 1024**4


@dataclass(frozen=True)
class KeySet:
    """A set of key columns with the rules that ask for it to be unique."""

    columns: tuple[str, ...]
    findings: tuple[Finding, ...]
    wide: bool  # holds long text by its declared type


@dataclass(frozen=True)
class TablePlan:
    """What can be tested on one table, and what cannot."""

    contract: TableContract
    data: DataFrame
    row_tests: list[RowTest]
    key_sets: list[KeySet]
    foreign_keys: list[ForeignKey]
    skipped: list[Skipped]


def plan_table(
    contract: TableContract,
    lookup: TableLookup,
    contracts: Mapping[str, TableContract] | None = None,
    overrides: Mapping[str, str] | None = None,
    where: str | None = None,
) -> TablePlan:
    """Settle which rules are tested, by analysis alone. `where` limits the test to a slice of
    the table."""
    data = lookup(contract.target_name)
    if data is None:
        raise LookupError(f"table {contract.target_name} was not found")
    if where:
        data = data.where(where)
    tests, skipped = row_tests(data, contract)

    grouped: dict[frozenset[str], list[Finding]] = {}
    columns_of: dict[frozenset[str], tuple[str, ...]] = {}
    kinds = ((PRIMARY_KEY, PRIMARY_KEY_DUPLICATE), (UNIQUE, UNIQUE_DUPLICATE))
    for rule_kind, kind in kinds:
        for rule in contract.rules_of(rule_kind):
            finding = Finding(kind, rule.name, rule.columns)
            missing = absent_columns(data, rule.columns)
            if missing:
                reason = f"no column {missing}"
                skipped.append(Skipped(kind, finding.label, reason))
                continue
            same = frozenset(folded(data.sparkSession, name) for name in rule.columns)
            columns_of.setdefault(same, rule.columns)
            grouped.setdefault(same, []).append(finding)
    key_sets = [
        KeySet(columns_of[same], tuple(rules), contract.has_wide_text(columns_of[same]))
        for same, rules in grouped.items()
    ]

    foreign_keys = []
    for rule in contract.rules_of("foreign_key"):
        found = resolve(
            rule, data, lookup, contracts or {}, overrides, contract.source_schema
        )
        (foreign_keys if isinstance(found, ForeignKey) else skipped).append(found)
    return TablePlan(contract, data, tests, key_sets, foreign_keys, skipped)


@dataclass(frozen=True)
class Sizes:
    """What was measured before planning: parent keys that fit a broadcast, with their bytes,
    and the tables long enough for their long text keys to be compared by hash first."""

    parents: Mapping[ParentKey, int]
    long_tables: frozenset[str]

    def within(self, plans: Sequence[TablePlan], budget: int) -> Sizes:
        """Only the parents, smallest first, that may be broadcast together in one action over
        `plans`; a parent that several keys refer to counts once. The rest are shuffled."""
        asked = {key.parent for plan in plans for key in plan.foreign_keys}
        kept, used = {}, 0
        for parent in sorted(asked & self.parents.keys(), key=lambda p: (self.parents[p], p)):
            used += self.parents[parent]
            if used > budget:
                break
            kept[parent] = self.parents[parent]
        return Sizes(kept, self.long_tables)

    def hash_first(self, plan: TablePlan, keys: KeySet) -> bool:
        return keys.wide and plan.contract.target_name in self.long_tables


UNMEASURED = Sizes({}, frozenset())  # every parent counts as large, no table as long


def measure(
    plans: Sequence[TablePlan],
    lookup: TableLookup,
    failed: Callable[[str, Exception], None] | None = None,
) -> Sizes:
    """Measure all parents and all tables with long text keys in one job.

    Row counts, and with them the size of fixed-width keys, come from file footers. With
    `failed` a table that cannot be measured is reported to it and counts as large, and only the
    others' sizes are then taken one by one.
    """
    parents = list(dict.fromkeys(key.parent for plan in plans for key in plan.foreign_keys))
    wide = {plan.contract.target_name: plan for plan in plans if any(k.wide for k in plan.key_sets)}
    asked = [partial(_parent_bytes, lookup, *parent) for parent in parents]
    asked += [partial(plan.data.selectExpr, "count(1)") for plan in wide.values()]
    if not asked:
        return UNMEASURED

    def sizes_of(some: Sequence[int]) -> dict[int, int]:
        rows = union_all([asked[place]().selectExpr(f"{place} AS place", "*") for place in some])
        return {row[0]: row[1] for row in rows.collect()}

    try:
        sizes = sizes_of(range(len(asked)))
    except Exception:
        if failed is None:
            raise
        sizes = {}
        for place, name in enumerate([table for table, _ in parents] + list(wide)):
            try:
                sizes |= sizes_of([place])
            except Exception as error:
                failed(name, error)
    by_parent = {p: sizes[place] for place, p in enumerate(parents) if place in sizes}
    lengths = {n: sizes.get(len(parents) + place, 0) for place, n in enumerate(wide)}
    return Sizes(
        {parent: n for parent, n in by_parent.items() if n <= BROADCAST_BYTES},
        frozenset(name for name, n in lengths.items() if n >= HASH_FIRST_ROWS),
    )


def _parent_bytes(lookup: TableLookup, table: str, columns: Sequence[str]) -> DataFrame:
    return key_bytes(parent_keys(lookup(table), columns))


def count_key_set(plan: TablePlan, keys: KeySet, sizes: Sizes, book: RuleBook) -> DataFrame:
    found = count_duplicates(plan.data, keys.columns, sizes.hash_first(plan, keys))
    return numbered_groups(plan, keys, found, book)


def numbered_groups(plan: TablePlan, keys: KeySet, found: DataFrame, book: RuleBook) -> DataFrame:
    """`(rule_id, n)` of the rules of a key set, from its duplicate groups under both readings."""
    counts = {
        book.number(plan.contract.target_name, finding): (
            "primary_groups" if finding.kind == PRIMARY_KEY_DUPLICATE else "unique_groups"
        )
        for finding in keys.findings
    }
    return numbered(found, counts)


def count_orphans(
    plan: TablePlan, key: ForeignKey, lookup: TableLookup, sizes: Sizes, book: RuleBook
) -> DataFrame:
    orphans = orphan_rows(
        plan.data, lookup(key.parent_table), key.columns, key.ref_columns,
        small_parent=key.parent in sizes.parents,
    )
    return numbered(
        orphans, {book.number(plan.contract.target_name, key.finding): "orphan_rows"}
    )


def count_key_sets(plan: TablePlan, sets: Sequence[KeySet], book: RuleBook) -> DataFrame:
    """Several key sets of a table in one scan and one shuffle."""
    counts = {}
    for place, keys in enumerate(sets):
        for finding in keys.findings:
            reading = "primary" if finding.kind == PRIMARY_KEY_DUPLICATE else "unique"
            counts[book.number(plan.contract.target_name, finding)] = f"{reading}_groups{place}"
    return numbered(count_duplicates_together(plan.data, [keys.columns for keys in sets]), counts)


def count_all_orphans(
    plan: TablePlan, keys: Sequence[ForeignKey], lookup: TableLookup, book: RuleBook
) -> DataFrame:
    """Several foreign keys to large parents in one scan of the child and one shuffle."""
    found = count_orphans_together(plan.data, [(key, lookup(key.parent_table)) for key in keys])
    counts = {
        book.number(plan.contract.target_name, key.finding): f"orphans{place}"
        for place, key in enumerate(keys)
    }
    return numbered(found, counts)


def footers_answer_counts(spark: SparkSession) -> bool:
    """Whether the session lets parquet answer plain counts from file footers."""
    row_sources = spark.conf.get("spark.sql.sources.useV1SourceList").lower().split(",")
    pushed_down = spark.conf.get("spark.sql.parquet.aggregatePushdown") == "true"
    return pushed_down and "parquet" not in [name.strip() for name in row_sources]


def table_counts(
    plan: TablePlan, lookup: TableLookup, sizes: Sizes, book: RuleBook
) -> list[DataFrame]:
    """The counts of all rules of a table: one frame for the row rules and the foreign keys to
    small parents, one per key set, one per remaining foreign key."""
    table, data, tests = plan.contract.target_name, plan.data, plan.row_tests
    together = [key for key in plan.foreign_keys if key.parent in sizes.parents]
    orphans = [(key.finding, orphan_count(key, place)) for place, key in enumerate(together)]
    parts = []
    if footers_answer_counts(data.sparkSession):
        # Values are counted without reading them, apart from the rules that do need a scan.
        counting = [test for test in tests if test.counts_values]
        parts.append(count_rows_and_failures(data, table, counting, book))
        tests = [test for test in tests if not test.counts_values]
    if together:
        data = with_parent_marks(data, [(key, lookup(key.parent_table)) for key in together])
    if not parts:
        parts.append(count_rows_and_failures(data, table, tests, book, orphans))
    elif tests or orphans:
        parts.append(count_failures(data, table, tests, book, orphans))
    by_value = [keys for keys in plan.key_sets if not sizes.hash_first(plan, keys)]
    if by_value and stored_bytes(plan.data) >= file_ranges.FILE_RANGE_BYTES:
        in_files = {keys: lone_splits(plan.data, keys.columns) for keys in by_value}
        for keys, lone in in_files.items():
            if lone is not None:
                groups = duplicates_in_splits(plan.data, keys.columns, lone)
                parts.append(numbered_groups(plan, keys, count_groups(groups, keys.columns), book))
        by_value = [keys for keys in by_value if in_files[keys] is None]
    if len(by_value) > 1:
        parts.append(count_key_sets(plan, by_value, book))
    else:
        parts += [count_key_set(plan, keys, sizes, book) for keys in by_value]
    parts += [
        count_key_set(plan, keys, sizes, book) for keys in plan.key_sets if sizes.hash_first(plan, keys)
    ]
    large = [key for key in plan.foreign_keys if key not in together]
    united = [
        key for key in large if shared_types(plan.data, lookup(key.parent_table), key) is not None
    ]
    if len(united) > 1:
        parts.append(count_all_orphans(plan, united, lookup, book))
        large = [key for key in large if key not in united]
    parts += [count_orphans(plan, key, lookup, sizes, book) for key in large]
    return parts


def scans_of(plan: TablePlan) -> int:
    """How many scans the plan of a table has at most: one for its row rules, one for its keys, one for
    its foreign keys and one of each parent."""
    parents = {key.parent_table for key in plan.foreign_keys}
    return 1 + bool(plan.key_sets) + bool(parents) + len(parents)


def packed(plans: Sequence[TablePlan], most_scans: int, most_bytes: int, most_tables: int | None = None) -> list[list[TablePlan]]:
    """The tables in jobs, none of which plans more than `most_scans` scans or reads tables of more than
    `most_bytes`; a table beyond either has a job of its own. Tables are taken by size, so that a job of many small
    ones does not wait for a large one."""
    jobs, scans, n_bytes = [], 0, 0
    sizes = {id(plan): stored_bytes(plan.data) for plan in plans}
    for plan in sorted(plans, key=lambda plan: sizes[id(plan)]):
        scans += scans_of(plan)
        n_bytes += sizes[id(plan)]
        full = not jobs or scans > most_scans or n_bytes > most_bytes
        if full or most_tables is not None and len(jobs[-1]) >= most_tables:
            jobs.append([])
            scans, n_bytes = scans_of(plan), sizes[id(plan)]
        jobs[-1].append(plan)
    return jobs


def report_of(
    plans: Sequence[TablePlan],
    lookup: TableLookup,
    sizes: Sizes,
    budget: int | None = None,
    book: RuleBook | None = None,
) -> DataFrame:
    """The report of planned tables: one row per declared rule (see `operators.findings`).

    All parents broadcast by the report share `budget` bytes of keys.
    """
    book = book or RuleBook()
    sizes = sizes.within(plans, BROADCAST_BYTES if budget is None else budget)
    counts = [part for plan in plans for part in table_counts(plan, lookup, sizes, book)]
    for plan in plans:
        for rule in plan.skipped:
            book.untested(plan.contract.target_name, rule.kind, rule.rule_name, SKIPPED, rule.reason)
    return book.report(plans[0].data.sparkSession if plans else SparkSession.active(), counts)


def validate_constraints(
    contract: TableContract,
    lookup: TableLookup,
    contracts: Mapping[str, TableContract] | None = None,
    overrides: Mapping[str, str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """The report of one table: every rule with the number of its violations."""
    plans = [plan_table(contract, lookup, contracts, overrides, where)]
    return report_of(plans, lookup, measure(plans, lookup))


def validate_tables(
    contracts: Sequence[TableContract],
    lookup: TableLookup,
    overrides: Mapping[str, str] | None = None,
    where: Mapping[str, str] | None = None,
) -> DataFrame:
    """The report of many tables as one frame. A table that is not there has one row, with status
    `error`.

    Up to `SCANS_PER_JOB` scans are one action of the caller's. More tables are taken in as many jobs as they need,
    one after the other, and what is returned is their rows: one per rule.
    """
    by_name = {contract.target_name: contract for contract in contracts}
    plans, book = [], RuleBook()
    for contract in contracts:
        slice_of = (where or {}).get(contract.target_name)
        try:
            plans.append(plan_table(contract, lookup, by_name, overrides, slice_of))
        except LookupError as error:
            book.untested(contract.target_name, ROW_COUNT, ROW_COUNT, ERROR, str(error))
    sizes = measure(plans, lookup)
    jobs = packed(plans, SCANS_PER_JOB, BYTES_PER_JOB)
    if len(jobs) <= 1:
        return report_of(plans, lookup, sizes, book=book)
    rows = [row for job in jobs for row in report_of(job, lookup, sizes).collect()]
    spark = plans[0].data.sparkSession
    return spark.createDataFrame(rows, REPORT_SCHEMA).unionAll(book.report(spark, []))


def violating_rows(
    contract: TableContract,
    lookup: TableLookup,
    contracts: Mapping[str, TableContract] | None = None,
    overrides: Mapping[str, str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """The violating rows themselves: `kind`, `rule_name` and the row's columns, one row per
    rule broken. Row rules and foreign keys to small parents share one scan; each key set and
    each larger parent has one more."""
    plan = plan_table(contract, lookup, contracts, overrides, where)
    sizes = measure([plan], lookup).within([plan], BROADCAST_BYTES)
    together = [key for key in plan.foreign_keys if key.parent in sizes.parents]
    tests, data = list(plan.row_tests), plan.data
    if together:
        data = with_parent_marks(data, [(key, lookup(key.parent_table)) for key in together])
        tests += [RowTest(key.finding, is_orphan(key, place)) for place, key in enumerate(together)]
    own = ["kind", "rule_name", *map(quoted, plan.data.columns)]
    parts = [rows_violating(data, tests).select(own)]
    for keys in plan.key_sets:
        primary = any(finding.kind == PRIMARY_KEY_DUPLICATE for finding in keys.findings)
        kind = PRIMARY_KEY if primary else UNIQUE
        rows = rows_with_duplicate_key(
            plan.data, keys.columns, kind, sizes.hash_first(plan, keys)
        )
        # A key that is NULL in all parts breaks a primary key but no unique key.
        broken = {PRIMARY_KEY_DUPLICATE: "true", UNIQUE_DUPLICATE: any_present(keys.columns)}
        marks = [RowTest(finding, broken[finding.kind]) for finding in keys.findings]
        parts.append(rows_violating(rows, marks))
    for fk in plan.foreign_keys:
        if fk not in together:
            parent = lookup(fk.parent_table)
            rows = fk_orphans(plan.data, parent, fk.columns, fk.ref_columns, small_parent=False)
            parts.append(rows_violating(rows, [RowTest(fk.finding, "true")]))
    return union_all(parts)


def write_violations(
    rows: DataFrame, path: str, provider: str = "parquet", mode: str = "append"
) -> None:
    """Store violating rows, one folder per kind of rule."""
    rows.write.format(provider).mode(mode).partitionBy("kind").save(path)


def table_outcomes(reported: DataFrame, drifted: Collection[str] = ()) -> DataFrame:
    """`(target_table, row_count, broken_rules, outcome)` of every table of a report.

    The first that holds: `failed` (a rule is broken, or the schema differs: a `schema` row of the
    report, or `drifted`), `error` (a rule failed to run, the table is missing or unreadable),
    `incomplete` (a rule was skipped), `skipped` (no rows), `passed`. A group holds the rules of one table.
    """
    differs = (F.col("kind") == SCHEMA) | F.col("target_table").isin(list(drifted))
    outcomes = reported.groupBy("target_table").agg(
        F.max("table_rows").alias("row_count"),
        F.count_if(F.col("violations") > 0).alias("broken_rules"),
        F.count_if(differs).alias("differences"),
        F.count_if(F.col("status") == ERROR).alias("errors"),
        F.count_if((F.col("status") == SKIPPED) & (F.col("kind") != SCHEMA)).alias("skips"),
    )
    outcome = (
        F.when((F.col("broken_rules") > 0) | (F.col("differences") > 0), "failed")
        .when(F.col("errors") > 0, "error")
        .when(F.col("skips") > 0, "incomplete")
        .when(F.col("row_count") == 0, "skipped")
        .otherwise("passed")
    )
    return outcomes.select("target_table", "row_count", "broken_rules", outcome.alias("outcome"))
