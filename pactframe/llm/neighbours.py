"""Each row beside the one that follows it in the order of ids."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of

FIRST = -(1 << 63)  # where null ids stand


def _range_of(value: Column, bounds: list[int]) -> Column:
    """The number of bounds up to `value`, found among the bounds' groups first and then in one group."""
    width = isqrt(len(bounds)) + 1
    every = F.array(*(F.lit(b).cast("long") for b in bounds))
    heads = F.array(*(F.lit(b).cast("long") for b in bounds[::width]))

    def up_to(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= value))

    group = F.greatest(up_to(heads) - 1, F.lit(0)) * width
    return group + up_to(F.slice(every, group + 1, width))


def dealt_by_id(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """`ahead, id, text` of `rows` (`id long, text string`), dealt by ranges of ids and in order; after the
    rows of a range come, with `ahead`, those that open the next one.

    Rows are dealt once, so no range has to ask another. `parts` ranges (as many as the session has shuffle
    partitions) are cut at ids of the table; that is all that comes to the driver.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.select(F.coalesce("id", F.lit(FIRST)).alias("place"), "id", "text")
    shares = ", ".join(str(k / parts) for k in range(parts))
    cuts = placed.selectExpr(
        f"percentile_approx(place, array({shares}), {max(10_000, 10 * parts)}) AS cuts", "min(place) AS first"
    ).first()
    if cuts["first"] is None:
        return rows.select(F.lit(False).alias("ahead"), "id", "text")
    bounds = sorted({cuts["first"], *cuts["cuts"]})  # ids of the table; the least one is the first
    part = _range_of(F.col("place"), bounds) - 1
    at_bound = F.element_at(F.array(*(F.lit(b).cast("long") for b in bounds)), F.col("part") + 1) == F.col("place")
    before = F.pmod(F.col("part") - 1, F.lit(len(bounds)))
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("ahead"))
    sent = F.struct(before.alias("part"), F.lit(True).alias("ahead"))
    dealt = (
        placed.withColumn("part", part)
        .withColumn("to", F.explode(F.when(at_bound, F.array(own, sent)).otherwise(F.array(own))))
        .select("to.part", "to.ahead", "place", "id", "text")
        .repartitionById(len(bounds), F.col("part"))
        .sortWithinPartitions("part", "ahead", "place", "text")
    )
    return dealt.select("ahead", "id", "text")


def pairs(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[tuple[list, list[str], list[str]]]:
    """Ids, texts and following texts, some rows at a time, from the batches of `dealt_by_id`."""
    held = None
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            ahead, ids, texts = (column.to_pylist() for column in part.columns)
            if held is not None:
                ahead, ids, texts = [held[0], *ahead], [held[1], *ids], [held[2], *texts]
            held = (ahead[-1], ids[-1], texts[-1])
            own = [k for k in range(len(texts) - 1) if not ahead[k]]
            if own:
                yield [ids[k] for k in own], [texts[k] for k in own], [texts[k + 1] for k in own]


def with_next(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """`id, text, next_text` for every row of `rows` (`id long, text string`): the text of the row with
    the next larger id, for the last row that of the first.

    Rows of one id stand in the order of their texts, null ids first; one row alone follows itself; an
    empty table gives no rows.
    """
    schema = pa.schema([("id", pa.int64()), ("text", pa.string()), ("next_text", pa.string())])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in pairs(batches):
            yield batch_of(schema, *found)

    return dealt_by_id(rows, parts).mapInArrow(pair, "id long, text string, next_text string")
