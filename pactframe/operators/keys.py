"""Duplicate keys: primary keys, unique constraints and unique indexes.

NULLs in a key are equal to each other, as in GROUP BY. Grouping counts rows before the
shuffle, so a key that holds a large share of the rows costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import any_present
from ..functions.names import folded, quoted
from ..scratch import checkpointed
from .file_ranges import duplicates_in_splits, lone_splits
from .matching import (
    MOST_PASSES,
    key_bytes,
    passes_for,
    rows_with_keys,
    semi_join_in_passes,
)

# Below this many rows a second scan costs more than shuffling the full key.
HASH_FIRST_ROWS = 10_000_000


def key_parts(key: Sequence[str]) -> list[str]:
    return [f"__k{i}" for i in range(len(key))]


def key_sizes(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """`__k0`, `__k1`, ... and `count`, the number of rows with that key.

    The key has positional names, so it may hold a column called `count`.
    """
    parts = key_parts(key)
    named = [f"{quoted(name)} AS {part}" for name, part in zip(key, parts)]
    return df.selectExpr(*named).groupBy(*parts).count()


def _suspects(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose 64-bit key hash is not unique; every duplicate is among them.

    Only hashes are shuffled. Repeated ones are broadcast, in several passes over `df` if they are
    many. Beyond MOST_PASSES most rows are suspect anyway and `df` is returned as it is.
    """
    digest = f"xxhash64({', '.join(quoted(name) for name in key)})"
    hashes = df.selectExpr(f"{digest} AS __h").groupBy("__h").count()
    repeated = checkpointed(hashes.where("count > 1").select("__h"))
    passes = passes_for(key_bytes(repeated).first()["n_bytes"])
    if passes > MOST_PASSES:
        return df
    return semi_join_in_passes(df, repeated, F.expr(f"{digest} = __h"), digest, "__h", passes)


def duplicate_key_sizes(
    df: DataFrame,
    key: Sequence[str],
    drop_all_null: bool = False,
    hash_first: bool = False,
    in_files: bool = False,
) -> DataFrame:
    """The groups of `key_sizes` with more than one row.

    `hash_first` is for long text keys on large tables: it finds repeated hashes first and
    groups by the real key only the rows behind them. `in_files` is for large tables stored in the order of
    the key: rows of files that share no key are not moved. The result is the same.
    """
    rows = df.where(any_present(key)) if drop_all_null else df
    lone = lone_splits(rows, key) if in_files else None
    if lone is not None:
        return duplicates_in_splits(rows, key, lone)
    if hash_first:
        rows = _suspects(rows, key)
    return key_sizes(rows, key).where("count > 1")


def duplicate_keys(
    df: DataFrame,
    key: Sequence[str],
    kind: str = "primary_key",
    hash_first: bool = False,
    count_name: str = "n_rows",
    in_files: bool = False,
) -> DataFrame:
    """The key columns and the number of rows of every key that occurs more than once.

    For `kind="unique"` rows whose key is NULL in all parts are left out.
    """
    groups = duplicate_key_sizes(df, key, kind == "unique", hash_first, in_files)
    return groups.toDF(*key, count_name)


def duplicate_key_groups(
    df: DataFrame, key: Sequence[str], kind: str = "primary_key", hash_first: bool = False
) -> DataFrame:
    """Number of keys that occur more than once (groups, not surplus rows)."""
    groups = duplicate_key_sizes(df, key, kind == "unique", hash_first)
    return groups.selectExpr("count(1) AS dup_groups")


def count_duplicates(df: DataFrame, key: Sequence[str], hash_first: bool = False) -> DataFrame:
    """One row with the duplicate groups under both readings of NULL, from one grouping:
    `primary_groups` counts all, `unique_groups` leaves out the key that is NULL in all parts."""
    return count_groups(duplicate_key_sizes(df, key, hash_first=hash_first), key)


def count_groups(groups: DataFrame, key: Sequence[str]) -> DataFrame:
    """`count_duplicates`, given the groups."""
    return groups.selectExpr(
        "count(1) AS primary_groups", f"count_if({any_present(key_parts(key))}) AS unique_groups"
    )


def count_duplicates_together(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """One row with `primary_groups<i>` and `unique_groups<i>` for each of several keys of a table, as
    `count_duplicates` has them for one.

    One scan serves all keys: each row is expanded into one per key, in which the other keys' columns are
    empty, and all are grouped in one shuffle. The grouping set's number keeps a key of NULLs apart
    from those of another set.
    """
    spark = df.sparkSession
    numbers: dict[str, int] = {}
    for key in keys:
        for name in key:
            numbers.setdefault(folded(spark, name), len(numbers))
    parts = [[f"__c{numbers[folded(spark, name)]}" for name in key] for key in keys]
    named = {f"__c{numbers[folded(spark, name)]}": quoted(name) for key in keys for name in key}
    rows = df.selectExpr(*[f"{name} AS {part}" for part, name in named.items()])
    groups = (
        rows.groupingSets(parts, *named)
        .agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("__set"))
        .where("count > 1")
    )
    counts = []
    for place, own in enumerate(parts):
        # a bit per column, the first one highest, set for those outside the key
        outside = sum(1 << (len(named) - 1 - k) for k, part in enumerate(named) if part not in own)
        counts.append(f"count_if(__set = {outside}) AS primary_groups{place}")
        counts.append(f"count_if(__set = {outside} AND ({any_present(own)})) AS unique_groups{place}")
    return groups.selectExpr(*counts)


def rows_with_duplicate_key(
    df: DataFrame, key: Sequence[str], kind: str = "primary_key", hash_first: bool = False
) -> DataFrame:
    """All rows that share their key with another row."""
    groups = duplicate_key_sizes(df, key, kind == "unique", hash_first)
    return rows_with_keys(df, groups.selectExpr("*", "true AS wanted"), key, null_safe=True)
