"""Counts against brute force over small generated tables, and injected violations."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pactframe import Column, Rule, TableContract, validate_tables, violating_rows
from pactframe.plans.constraints import validate_constraints

COLUMNS = (Column("id", "INTEGER", False), Column("ref", "INTEGER"), Column("amount", "INTEGER"))
RULES = (
    Rule("primary_key", ("id", "ref"), "pk"), Rule("unique", ("ref", "amount"), "uk"),
    Rule("foreign_key", ("ref",), "fk", "parent", ("k",)),
    Rule("check", name="ck", expression="amount > 2"),
)
CONTRACT = TableContract("child", COLUMNS, RULES)


def brute_force(rows, parents):
    keys = Counter((i, r) for i, r, _ in rows)
    pairs = Counter((r, a) for _, r, a in rows if r is not None or a is not None)
    return {
        "not_null": sum(i is None for i, _, _ in rows),
        "primary_key_null": sum(i is None or r is None for i, r, _ in rows),
        "primary_key_duplicate": sum(n > 1 for n in keys.values()),
        "check": sum(a is not None and a <= 2 for _, _, a in rows),
        "unique_duplicate": sum(n > 1 for n in pairs.values()),
        "foreign_key": sum(r is not None and r not in parents for _, r, _ in rows),
    }


@pytest.mark.parametrize("seed", range(6))
def test_counts_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [
        tuple(rng.choice([None, *range(rng.choice([2, 5]))]) for _ in COLUMNS)
        for _ in range(rng.choice([0, 1, 40]))
    ]
    parents = [rng.choice([None, 0, 1, 1, 3]) for _ in range(rng.randrange(4))]
    tables = {
        "child": spark.createDataFrame(rows, "id int, ref int, amount int"),
        "parent": spark.createDataFrame([(k,) for k in parents], "k int"),
    }
    report = validate_constraints(CONTRACT, tables.get).where("kind <> 'row_count'")
    expected = brute_force(rows, set(parents))
    assert {r.kind: r.violations for r in report.collect()} == expected

    listed = Counter(r.kind for r in violating_rows(CONTRACT, tables.get).select("kind").collect())
    for kind in ("not_null", "primary_key_null", "check", "foreign_key"):
        assert listed[kind] == expected[kind]
    keys = Counter((i, r) for i, r, _ in rows)
    assert listed["primary_key_duplicate"] == sum(n for n in keys.values() if n > 1)


INJECTIONS = {
    "not_null": ("id", None), "check": ("amount", 1), "foreign_key": ("ref", 10_000),
}


@pytest.mark.parametrize("kind", INJECTIONS)
def test_as_many_violations_as_were_put_in(spark, kind):
    column, value = INJECTIONS[kind]
    clean = spark.range(5000).selectExpr(
        "CAST(id AS int) AS id", "CAST(id % 100 AS int) AS ref", "CAST(id + 3 AS int) AS amount"
    )
    parent = spark.range(100).selectExpr("CAST(id AS int) AS k")
    for n in (0, 17):
        shown = "NULL" if value is None else value
        dirty = clean.withColumn(
            column, F.expr(f"IF(id < {n}, {shown}, {column})")
        )
        report = validate_tables([CONTRACT], {"child": dirty, "parent": parent}.get)
        found = {r.kind: r.violations for r in report.where("violations > 0").collect()}
        assert found.get(kind, 0) == n


def test_skewed_duplicates(spark):
    """A third of all rows share one key; groups and rows are still exact."""
    df = spark.range(30_000).selectExpr(
        "CAST(IF(id < 10000, 7, id) AS int) AS id", "CAST(1 AS int) AS ref", "CAST(id AS int) AS amount"
    )
    parent = spark.range(5).selectExpr("CAST(id AS int) AS k")
    tables = {"child": df, "parent": parent}
    report = {r.kind: r.violations for r in validate_constraints(CONTRACT, tables.get).collect()}
    assert report["primary_key_duplicate"] == 1
    rows = violating_rows(CONTRACT, tables.get)
    assert rows.where("kind = 'primary_key_duplicate'").count() == 10_000
