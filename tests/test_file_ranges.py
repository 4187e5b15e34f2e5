"""Duplicates found where files are read, against plain grouping."""

import random

import pytest

from pactframe import duplicate_keys, validate_constraints
from pactframe.operators import file_ranges
from pactframe.operators.file_ranges import duplicates_in_splits, key_ranges, lone_splits
from pactframe.operators.keys import duplicate_key_sizes
from conftest import SF_DIR
from fixture_contracts import BY_NAME, fixture_lookup

SCHEMA = "k bigint, t string, d decimal(10,2), day date, f double"


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """One table with repeated keys and NULLs, in the order of `k`, of `t`, and in none."""
    rng = random.Random(5)
    rows = [(rng.randrange(3000), rng.choice("abcxyz") * rng.randrange(4), rng.randrange(50), rng.random()) for _ in range(6000)]
    df = spark.createDataFrame(rows, "k bigint, t string, n int, f double").selectExpr(
        "if(n = 7, NULL, k) AS k", "if(n = 3, NULL, t) AS t", "CAST(n / 4 AS decimal(10,2)) AS d",
        "date_add(DATE'2020-01-01', n) AS day", "f",
    )
    root = tmp_path_factory.mktemp("copies")
    made = {"k": df.where("k IS NOT NULL").repartitionByRange(6, "k"), "t": df.repartitionByRange(6, "t"), "none": df.repartition(6)}
    for name, rows in made.items():
        rows.sortWithinPartitions("f").write.parquet(f"{root}/{name}")
    return {name: spark.read.schema(SCHEMA).parquet(f"{root}/{name}") for name in made}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("copy", ["k", "t", "none"])
@pytest.mark.parametrize("key", [["k"], ["k", "t"], ["t", "d"], ["d", "day"], ["t"]])
@pytest.mark.parametrize("kind", ["primary_key", "unique"])
def test_as_grouping_finds_them(copies, copy, key, kind):
    df = copies[copy]
    assert rows_of(duplicate_keys(df, key, kind, in_files=True)) == rows_of(duplicate_keys(df, key, kind))


def test_rows_of_a_table_in_order_stay_where_they_are(copies):
    df = copies["k"]
    lone = lone_splits(df, ["k", "t"])
    assert lone.count() == 6
    found = duplicates_in_splits(df, ["k", "t"], lone)
    plan = found._jdf.queryExecution().executedPlan().toString()
    here, others = plan.split("MapInArrow")[1].split("HashAggregate")[0], plan.split("HashAggregate", 1)[1]
    assert "hashpartitioning" not in here and "LeftSemi" in here
    assert "LeftAnti" in others  # only what is not in a lone split goes to the exchange
    split = file_ranges._splits(df, ["k"])
    assert split.join(lone, "__split", "left_anti").count() == 0


def test_a_table_in_no_order_is_grouped_as_before(copies):
    assert lone_splits(copies["none"], ["k"]) is None
    assert lone_splits(copies["k"], ["f"]) is None and lone_splits(copies["k"], ["k", "f"]) is None
    assert lone_splits(copies["k"], ["k"], broadcast_bytes=1) is None
    assert lone_splits(copies["k"].groupBy("k").count(), ["k"]) is None


def test_nulls_and_shared_bounds_are_not_alone(spark, tmp_path):
    parts = {"a": [1, 2, 3], "b": [3, 4], "c": [5, None], "d": [8, 9], "e": [None, None]}
    for name, keys in parts.items():
        spark.createDataFrame([(k,) for k in keys], "k int").coalesce(1).write.parquet(f"{tmp_path}/p={name}")
    df = spark.read.parquet(str(tmp_path)).select("k")
    ranges = {(r["low"], r["high"]): r["alone"] for r in key_ranges(df, ["k"]).collect()}
    assert ranges == {(1, 3): False, (3, 4): False, (5, 5): False, (8, 9): True, (None, None): False}
    assert rows_of(duplicate_keys(df, ["k"], in_files=True)) == [(3, 2), (None, 3)]


def test_splits_of_one_file(spark, tmp_path):
    """A file cut into many splits, some of which share a key with the next."""
    df = spark.range(200_000).selectExpr("id div 2 AS k", "repeat('x', 20) AS pad")
    df.coalesce(1).write.option("parquet.block.size", 65536).option("parquet.page.size", 4096).parquet(str(tmp_path / "one"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        stored = spark.read.parquet(str(tmp_path / "one"))
        assert key_ranges(stored, ["k"]).count() > 3
        assert duplicate_key_sizes(stored, ["k"], in_files=True).selectExpr("count(1)", "sum(count)").first()[:] == (100_000, 200_000)
        lone = lone_splits(stored, ["k"], least_share=0)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")  # the same splits are not met again
        again = spark.read.parquet(str(tmp_path / "one"))
        assert duplicates_in_splits(again, ["k"], lone).count() == 100_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "k int").write.parquet(str(tmp_path / "empty"))
    df = spark.read.parquet(str(tmp_path / "empty"))
    assert lone_splits(df, ["k"]) is None and duplicate_keys(df, ["k"], in_files=True).collect() == []


def test_reports_of_large_tables_use_it(spark, tmp_path, monkeypatch):
    find = fixture_lookup(spark, SF_DIR)
    find("events").repartitionByRange(4, "event_id").write.parquet(str(tmp_path / "events"))
    tables = {"events": spark.read.parquet(str(tmp_path / "events")), "customer": find("customer")}
    plain = rows_of(validate_constraints(BY_NAME["events"], tables.get, BY_NAME))
    monkeypatch.setattr(file_ranges, "FILE_RANGE_BYTES", 0)
    report = validate_constraints(BY_NAME["events"], tables.get, BY_NAME)
    assert "MapInArrow" in report._jdf.queryExecution().executedPlan().toString()
    strip = [(r[0], *r[2:]) for r in plain]
    assert sorted((r[0], *r[2:]) for r in rows_of(report)) == sorted(strip)
