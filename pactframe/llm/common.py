"""What several text operators share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch_path


def col(name: str) -> Column:
    """A column by its plain name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator works on, as `id` and `text`; a null text becomes empty.

    Other columns of `df` are left behind, so their names cannot clash with anything here.
    """
    return df.select(
        col(id_col).cast("long").alias("id"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts lineage and survives the loss
    of executors. Later plans see its size on disk."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(texts: list[str], characters: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about so many characters each, so that work space stays bounded
    however long the texts of a batch are. A longer text has a range to itself."""
    start, held = 0, 0
    for place, text in enumerate(texts):
        if held and held + len(text) > characters:
            yield start, place
            start, held = place, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def batch_of(schema: pa.Schema, *columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(columns, schema.types, strict=True)],
        schema=schema,
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Gives this library to the executors of a session, as `--py-files` would, once."""
    context = spark.sparkContext
    if not getattr(context, "_pactframe_shipped", False):
        package = Path(__file__).resolve().parent.parent
        folder = tempfile.mkdtemp(prefix="pactframe-")  # the driver serves the file from here
        archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        context._pactframe_shipped = True
