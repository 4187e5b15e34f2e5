"""Validation that reads only the files that came since the last time.

What a run learns of the files it reads is kept: the counts of row rules, and for every key and foreign key how
often each key occurs, by its digest. A later run reads new files only and merges. Parents are read for their
key columns each time, as they may have changed. The report is the same as one over the whole table.

State lies in three tables under a folder of the validated table: `counts`, `keys` and `files`. A run writes
`files` last, and what is not of a run named there does not count, so one that dies leaves nothing behind that is
used. If a file of a run has gone or changed, or the rules are others, that run's files are read again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import all_present, any_present
from ..functions.names import quoted
from ..model import TableContract
from ..operators.findings import PRIMARY_KEY_DUPLICATE, ROWS_FOUND, SKIPPED, RuleBook, numbered, union_all
from ..operators.foreign_keys import ForeignKey, TableLookup, shared_types
from ..operators.matching import key_digest
from ..sources.files import Folder
from ..sources.tables import TableStore
from .constraints import KeySet, TablePlan, count_key_set, count_orphans, measure, plan_table

FILES = "run string, rules string, path string, modified timestamp, length bigint"
COUNTS = "run string, rule int, n bigint"
KEYS = "run string, key int, digest binary, empty boolean, n bigint"


@dataclass(frozen=True)
class TrackedKey:
    """A key set, or a foreign key with the types it is compared in, whose key counts are kept."""

    rule: KeySet | ForeignKey
    types: tuple[str, ...]

    def digest(self, df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, str] | None:
        """`df` with the key's parts as `__d0`, ... and their digest; None for types without one."""
        parts = [f"__d{k}" for k in range(len(names))]
        typed = [f"CAST({quoted(n)} AS {t}) AS {p}" for n, t, p in zip(names, self.types, parts)]
        rows = df.selectExpr(*typed)
        text = key_digest(rows, parts)
        return None if text is None else (rows, text)


def tracked_keys(plan: TablePlan, lookup: TableLookup) -> list[TrackedKey]:
    """The keys of a plan that can be counted file by file."""
    found = []
    for keys in plan.key_sets:
        types = [plan.data.select(quoted(n)).schema[0].dataType.simpleString() for n in keys.columns]
        found.append(TrackedKey(keys, tuple(types)))
    for key in plan.foreign_keys:
        types = shared_types(plan.data, lookup(key.parent_table), key)
        if types is not None:
            found.append(TrackedKey(key, tuple(t.simpleString() for t in types)))
    return [key for key in found if key.digest(plan.data, key.rule.columns) is not None]


def rules_digest(plan: TablePlan, tracked: Sequence[TrackedKey]) -> str:
    """Stands for everything that counts of a file depend on but the file."""
    told = [test.count for test in plan.row_tests]
    told += [repr((type(key.rule).__name__, key.rule.columns, key.types)) for key in tracked]
    return hashlib.sha256("\n".join([plan.data.schema.simpleString(), *told]).encode()).hexdigest()


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """`path, modified, length` of a table's files, from the listing alone."""
    found = spark.read.format("binaryFile").load(path)
    return found.selectExpr("path", "modificationTime AS modified", "length")


def _state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not Folder(spark, path).exists():
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _whole_runs(files: DataFrame, stored: DataFrame) -> DataFrame:
    """The runs all of whose files are stored as they were."""
    there = stored.withColumn("there", F.lit(True))
    seen = files.join(there, ["path", "modified", "length"], "left")
    return seen.groupBy("run").agg(F.min(F.coalesce("there", F.lit(False))).alias("whole")).where("whole").select("run")


def _key_counts(df: DataFrame, tracked: Sequence[TrackedKey]) -> DataFrame:
    """`key, digest, empty, n` of all tracked keys of `df`, from one scan. Keys of foreign keys with a NULL
    are left out, as they pass."""
    entries, parts = [], {}
    for number, key in enumerate(tracked):
        names = key.rule.columns
        typed = {f"__t{number}_{k}": f"CAST({quoted(n)} AS {t})" for k, (n, t) in enumerate(zip(names, key.types))}
        parts |= typed
    rows = df.selectExpr(*[f"{value} AS {name}" for name, value in parts.items()])
    for number, key in enumerate(tracked):
        own = [f"__t{number}_{k}" for k in range(len(key.types))]
        wanted = all_present(own) if isinstance(key.rule, ForeignKey) else "true"
        entries.append(f"{number}, {wanted}, NOT ({any_present(own)}), {key_digest(rows, own)}")
    stacked = f"stack({len(entries)}, {', '.join(entries)}) AS (key, wanted, empty, digest)"
    return rows.selectExpr(stacked).where("wanted").groupBy("key", "digest", "empty").agg(F.count(F.lit(1)).alias("n"))


def files_to_read(spark: SparkSession, store: TableStore, target: str, state: str, rules: str) -> list[tuple]:
    """The files, with time and length, that no valid run has read."""
    stored = stored_files(spark, store.path(target))
    files = _state(spark, f"{state}/files", FILES).where(F.col("rules") == rules)
    valid = files.join(_whole_runs(files, stored), "run", "left_semi").select("path", "modified", "length")
    new = stored.join(valid, ["path", "modified", "length"], "left_anti")
    return sorted(map(tuple, new.select("path", "modified", "length").collect()))


def read_new_files(
    spark: SparkSession, plan: TablePlan, tracked: Sequence[TrackedKey], store: TableStore, state: str, rules: str
) -> int:
    """Read what is new and keep what it says; the number of files read."""
    new = files_to_read(spark, store, plan.contract.target_name, state, rules)
    if not new:
        return 0
    run = uuid.uuid4().hex
    df = spark.read.schema(plan.data.schema).format(store.provider).load([path for path, *_ in new])
    counted = df.selectExpr("count(1) AS t0", *[f"{test.count} AS t{k}" for k, test in enumerate(plan.row_tests, 1)])
    counts = numbered(counted, {k: f"t{k}" for k in range(len(plan.row_tests) + 1)})
    counts = counts.selectExpr(f"'{run}' AS run", "CAST(rule_id AS int) AS rule", "n")
    counts.write.mode("append").parquet(f"{state}/counts")
    if tracked:
        keys = _key_counts(df, tracked).selectExpr(f"'{run}' AS run", "key", "digest", "empty", "n")
        keys.write.mode("append").parquet(f"{state}/keys")
    rows = [(run, rules, *file) for file in new]
    spark.createDataFrame(rows, FILES).coalesce(1).write.mode("append").parquet(f"{state}/files")
    return len(new)


def _orphans(keys: DataFrame, tracked: Sequence[TrackedKey], lookup: TableLookup) -> DataFrame:
    """`key, n`: rows without a parent, by the digests of both sides in one shuffle."""
    sides = []
    for number, key in enumerate(tracked):
        if isinstance(key.rule, ForeignKey):
            rows, digest = key.digest(lookup(key.rule.parent_table), key.rule.ref_columns)
            sides.append(rows.selectExpr(f"{number} AS key", f"{digest} AS digest", "0L AS n", "true AS there"))
    both = union_all([keys.selectExpr("key", "digest", "n", "false AS there"), *sides])
    sizes = both.groupBy("key", "digest").agg(F.sum("n").alias("n"), F.bool_or("there").alias("there"))
    return sizes.where("NOT there").groupBy("key").agg(F.sum("n").alias("n"))


def validate_new_files(
    contract: TableContract,
    store: TableStore,
    lookup: TableLookup,
    state_path: str,
    contracts: Mapping[str, TableContract] | None = None,
    overrides: Mapping[str, str] | None = None,
) -> DataFrame:
    """The report of one stored table of files, as `validate_constraints` gives it, from its new files and what
    earlier runs have kept under `state_path`.

    Keys whose types have no digest, and foreign keys that are compared by cast, are tested on the whole table.
    Two runs over one table must not overlap.
    """
    plan = plan_table(contract, lookup, contracts, overrides)
    spark, target = plan.data.sparkSession, contract.target_name
    state = f"{state_path.rstrip('/')}/{target}"
    tracked = tracked_keys(plan, lookup)
    rules = rules_digest(plan, tracked)
    read_new_files(spark, plan, tracked, store, state, rules)

    files = _state(spark, f"{state}/files", FILES).where(F.col("rules") == rules)
    runs = F.broadcast(_whole_runs(files, stored_files(spark, store.path(target))))  # a row per run
    book = RuleBook()
    counts = _state(spark, f"{state}/counts", COUNTS).join(runs, "run", "left_semi")
    findings = [ROWS_FOUND, *(test.finding for test in plan.row_tests)]
    summed = counts.selectExpr(*[f"coalesce(sum(if(rule = {k}, n, 0L)), 0L) AS t{k}" for k in range(len(findings))])
    parts = [numbered(summed, {book.number(target, f): f"t{k}" for k, f in enumerate(findings)})]

    keys = _state(spark, f"{state}/keys", KEYS).join(runs, "run", "left_semi")
    unique = {n: key for n, key in enumerate(tracked) if isinstance(key.rule, KeySet)}
    foreign = {n: key for n, key in enumerate(tracked) if isinstance(key.rule, ForeignKey)}
    if unique:
        sizes = keys.where(F.col("key").isin(list(unique))).groupBy("key", "digest", "empty").agg(F.sum("n").alias("n"))
        wanted, columns = {}, []
        for number, key in unique.items():
            for finding in key.rule.findings:
                kept = "" if finding.kind == PRIMARY_KEY_DUPLICATE else " AND NOT empty"
                wanted[book.number(target, finding)] = f"t{len(columns)}"
                columns.append(f"count_if(key = {number} AND n > 1{kept}) AS t{len(columns)}")
        parts.append(numbered(sizes.selectExpr(*columns), wanted))
    if foreign:
        lost = _orphans(keys.where(F.col("key").isin(list(foreign))), tracked, lookup)
        columns = [f"coalesce(sum(if(key = {n}, n, 0L)), 0L) AS t{n}" for n in foreign]
        wanted = {book.number(target, key.rule.finding): f"t{n}" for n, key in foreign.items()}
        parts.append(numbered(lost.selectExpr(*columns), wanted))
    held = [key.rule for key in tracked]
    sizes = measure([plan], lookup)
    parts += [count_key_set(plan, k, sizes, book) for k in plan.key_sets if k not in held]
    parts += [count_orphans(plan, k, lookup, sizes, book) for k in plan.foreign_keys if k not in held]
    for rule in plan.skipped:
        book.untested(target, rule.kind, rule.rule_name, SKIPPED, rule.reason)
    return book.report(spark, parts)
