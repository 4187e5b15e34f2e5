"""Rows picked by key and fetched from where they are stored."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from pactframe.operators import matching
from pactframe.operators.keys import key_sizes
from pactframe.operators.matching import has_row_numbers, key_digest, rows_at, rows_with_keys


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Six files; a key of 10 KB on a third of the rows."""
    rng = random.Random(3)
    rows = [
        (i, "h" * 10_000 if i % 3 == 0 else None if i % 50 == 1 else f"key {rng.randrange(700)}", rng.randrange(5), "wide " * 20)
        for i in range(3000)
    ]
    path = str(tmp_path_factory.mktemp("stored") / "t")
    spark.createDataFrame(rows, "id int, k string, n int, pad string").repartition(6).write.parquet(path)
    return spark.read.parquet(path)


def wanted(df, names, least):
    return key_sizes(df, names).selectExpr("*", f"count > {least} AS wanted")


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("names, least", [(["k"], 1), (["k"], 6), (["k", "n"], 3), (["n"], 0), (["k"], 10_000)])
@pytest.mark.parametrize("null_safe", [True, False])
def test_same_rows_at_every_bound(stored, names, least, null_safe):
    keys = wanted(stored, names, least)
    plain = rows_with_keys(stored, keys, names, null_safe)
    for bound, hot in ((1, 5), (3000, 100), (100_000, 1_000_000)):
        placed = rows_with_keys(stored, keys, names, null_safe, hot_rows=hot, broadcast_bytes=bound, most_passes=0)
        assert placed.columns == stored.columns and ids(placed) == ids(plain)


def test_no_row_is_shuffled_at_its_width(stored):
    keys = wanted(stored, ["k"], 1)
    found = rows_with_keys(stored, keys, ["k"], True, hot_rows=100, broadcast_bytes=1, most_passes=0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 6  # a pass per file, and no other scan
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 6


def test_each_pass_opens_its_own_files(stored):
    opened = []
    for place in range(6):
        rows = stored.where(f"pmod({matching.FILE[0]}, 6) = {place}")
        opened.append(rows.selectExpr("_metadata.file_path AS p").distinct().count())
    assert sum(opened) == 6


def test_few_places_one_by_one_and_many_as_bits(spark, stored):
    for condition in ("id % 500 = 7", "id % 2 = 0", "true", "false", "id = 0"):
        places = stored.where(condition).selectExpr(
            f"{matching.FILE[0]} AS __file", f"{matching.FILE[1]} AS __file_too", f"{matching.ROW} AS __row"
        )
        for bound in (None, 1):
            assert ids(rows_at(stored, places, bound)) == ids(stored.where(condition))


def test_a_long_hot_key_is_split_by_its_digest(stored):
    """No task of the shuffle gets the third of all rows that has one key."""
    digest = key_digest(stored, ["k"])
    held = wanted(stored, ["k"], 1).selectExpr(f"{key_digest(wanted(stored, ['k'], 1), ['__k0'])} AS __digest", "count AS __count", "wanted AS __wanted")
    rows = stored.selectExpr("id", f"{digest} AS __key_digest")
    found = matching._split_hot(rows, held, 100, None)
    per_task = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task <= 1000 / 2 and found.where("id % 3 = 0").count() == 1000


def test_digests_tell_keys_apart_as_equality_does(spark):
    day, moment = datetime.date(2020, 1, 2), datetime.datetime(2020, 10, 25, 1, 30)
    rows = [
        ("a", b"a", 1, 1.0, day, moment, True), ("a", b"a", 1, 1.0, day, moment, True), ("ab", None, 1, 0.0, day, moment, True),
        (None, None, None, -0.0, None, None, None), ("-", None, 1, 0.0, day, moment, True), (None, None, None, float("nan"), None, None, None),
        (None, None, None, float("nan"), None, None, None), ("", b"", 1, 0.0, day, moment, False),
    ]
    df = spark.createDataFrame(rows, "s string, b binary, n int, f double, d date, t timestamp, o boolean")
    names = df.columns
    digests = df.selectExpr(f"{key_digest(df, names)} AS d").groupBy("d").count()
    assert sorted(r["count"] for r in digests.collect()) == sorted(r["count"] for r in key_sizes(df, names).collect()) == [1, 1, 1, 1, 2, 2]
    two = spark.createDataFrame([("a1:b", "c"), ("a", "b1:c")], "x string, y string")
    assert two.selectExpr(f"{key_digest(two, ['x', 'y'])} AS d").distinct().count() == 2
    assert key_digest(spark.createDataFrame([([1],)], "a array<int>"), ["a"]) is None


def test_rows_that_no_file_holds(spark):
    df = spark.range(100).selectExpr("CAST(id AS int) AS id", "id % 7 AS k", "array(id % 5) AS a")
    assert not has_row_numbers(df.groupBy("k").count())
    for names in (["k"], ["a"], ["k", "a"]):
        keys = wanted(df, names, 14)
        assert ids(rows_with_keys(df, keys, names, True, 3, 10_000, most_passes=0)) == ids(rows_with_keys(df, keys, names, True))
