"""Duplicate keys of tables that are stored in the order of their keys, without moving their rows.

A split of a file is what one task reads. Splits are compared by the least and greatest value of the key's first
column. A split whose range meets no other's shares no key with one, so its duplicates are found where it is read;
only the rows of splits that do meet others are shuffled. How rows lie in a split does not matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import quoted
from ..scratch import checkpointed
from .matching import BROADCAST_BYTES

# Tables of fewer bytes are grouped as they are: the scan for the ranges would cost more.
FILE_RANGE_BYTES = 64 * 1024**3
# Less than this share of rows in splits of their own is not worth the scans.
LEAST_SHARE = 0.5
SPLIT = "_metadata.file_path, _metadata.file_block_start, _metadata.file_block_length"
# Types whose equality is the same here and in a grouping of Arrow's; floats differ in NaN and zero.
COMPARED = (
    T.StringType, T.BinaryType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files behind `df`, as the optimizer knows them; no job is run."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def has_splits(df: DataFrame) -> bool:
    """Whether the rows of `df` know the file and split they come from."""
    try:
        df.selectExpr(SPLIT.split(", ")[1]).schema
    except AnalysisException:
        return False
    return True


def can_compare(df: DataFrame, key: Sequence[str]) -> bool:
    kinds = [df.select(quoted(name)).schema[0].dataType for name in key]
    return all(type(kind) in COMPARED and getattr(kind, "collation", "UTF8_BINARY") == "UTF8_BINARY" for kind in kinds)


def _splits(df: DataFrame, key: Sequence[str]) -> DataFrame:
    parts = [f"{quoted(name)} AS __k{i}" for i, name in enumerate(key)]
    return df.selectExpr(f"xxhash64({SPLIT}) AS __split", *parts)


def key_ranges(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """`__split, low, high, n, alone` per split, from a scan of the key's first column.

    `alone` says that the range meets no other's. Splits with a NULL there, which may stand anywhere, and any
    two whose names have one hash, are not alone. The sweep over the ranges takes one task, on a row
    per split: the list the driver itself plans the scan with.
    """
    named = df.selectExpr(
        f"xxhash64({SPLIT}) AS __split", f"xxhash64('again', {SPLIT}) AS name", f"{quoted(key[0])} AS __k"
    )
    ranges = named.groupBy("__split").agg(
        F.min("__k").alias("low"), F.max("__k").alias("high"), F.count(F.lit(1)).alias("n"),
        (F.count("__k") == F.count(F.lit(1))).alias("no_null"),
        (F.min("name") == F.max("name")).alias("one_name"),
    )
    order = Window.orderBy("low", "high", "__split")
    reached = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    following = F.lead("low").over(order)
    apart = (reached.isNull() | (reached < F.col("low"))) & (following.isNull() | (following > F.col("high")))
    alone = F.col("no_null") & F.col("one_name") & F.coalesce(apart, F.lit(False))
    return ranges.select("__split", "low", "high", "n", alone.alias("alone"))


def lone_splits(
    df: DataFrame, key: Sequence[str], least_share: float | None = None, broadcast_bytes: int | None = None
) -> DataFrame | None:
    """The splits of `df` that share no key with others, as `__split`, or None where grouping all rows is
    the better way: too few rows lie in such splits, or there are too many splits for a broadcast."""
    if not (has_splits(df) and can_compare(df, key)):
        return None
    ranges = checkpointed(key_ranges(df, key).select("__split", "n", "alone"))
    seen = ranges.selectExpr("count(1) AS splits", "sum(n) AS n", "sum(if(alone, n, 0)) AS n_alone").first()
    bound = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    share = LEAST_SHARE if least_share is None else least_share
    if not seen["n"] or seen["n_alone"] < share * seen["n"] or 16 * seen["splits"] > bound:
        return None
    return ranges.where("alone").select("__split")


def duplicates_in_splits(df: DataFrame, key: Sequence[str], lone: DataFrame) -> DataFrame:
    """`__k0`, ... and `count` of every key that occurs more than once, given `lone_splits`.

    The rows of lone splits are grouped by the task that reads them, a split at a time; those of all others,
    and of splits that were cut otherwise when the ranges were read, are shuffled as usual.
    """
    rows, parts = _splits(df, key), [f"__k{i}" for i in range(len(key))]
    here = rows.join(F.broadcast(lone), "__split", "left_semi")
    others = rows.join(F.broadcast(lone), "__split", "left_anti")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held = None, []

        def repeated() -> Iterator[pa.RecordBatch]:
            if held:
                groups = pa.Table.from_batches(held).group_by(parts, use_threads=False).aggregate([([], "count_all")])
                groups = groups.rename_columns({"count_all": "count"}).select([*parts, "count"])
                yield from groups.filter(pc.greater(groups.column("count"), 1)).to_batches()

        for batch in batches:
            numbers = batch.column(0).to_numpy()
            edges = [0, *((numbers[1:] != numbers[:-1]).nonzero()[0] + 1).tolist(), len(numbers)]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                if numbers[start] != split:
                    yield from repeated()
                    split, held = numbers[start], []
                held.append(batch.slice(start, end - start).select(parts))
        yield from repeated()

    schema = T.StructType([*(rows.schema[part] for part in parts), T.StructField("count", T.LongType())])
    moved = others.groupBy(*parts).count().where("count > 1")
    return here.mapInArrow(count, schema).unionAll(moved)
