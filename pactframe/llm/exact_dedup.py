"""Exact duplicates, found in three combining steps that no large group of copies can skew.

A group is combined within each input partition (the partial aggregate), then over each of `salts`
shares of the partitions, then over the winners of the shares. Every step groups by the
whole normalised text beside its digest, so two texts with one digest stay apart.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import checkpointed
from .common import id_and_text


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def ascii_lower(text: Column) -> Column:
    """`text` with A-Z in lower case and everything else as it is."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    salts: int = 64,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of `df`: `id, keep_id, group_size, kept, digest`.

    Of rows with equal normalised text the largest id stays. A null text is an empty text. A null
    id never wins against another; a group of null ids alone keeps `keep_id` null. Rows that
    repeat both id and text count in `group_size` and share their verdict. An empty table gives no rows.
    """
    rows = id_and_text(df, id_col, text_col).select("id", ascii_lower(F.col("text")).alias("body"))
    rows = rows.withColumn("digest", digest(F.col("body")))
    shares = (
        # One salt per input partition: its copies of a text leave it as one row.
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "body")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    # Dealt by digest alone, so that the texts of one digest meet and need no further shuffle.
    groups = (
        shares.repartition("digest")
        .groupBy("digest", "body")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .withColumn("texts", F.count("*").over(Window.partitionBy("digest")))
    )
    winners = checkpointed(
        groups.select(
            "digest", "keep_id", "group_size", F.when(F.col("texts") > 1, F.col("body")).alias("one_of")
        )
    )
    alone = winners.where("one_of IS NULL").drop("one_of")
    found = rows.drop("body").join(alone, "digest")
    shared = winners.where("one_of IS NOT NULL")
    if not shared.isEmpty():
        shared = shared.withColumnRenamed("one_of", "body")
        found = found.unionByName(rows.join(shared, ["digest", "body"]).drop("body"))
    return found.select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )
