"""Declared against actual schemas over whole sets of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import TableContract
from ..operators.findings import union_all
from ..operators.rows import row_count
from ..operators.schema_diff import schema_messages, schema_rows


def declared_rows(spark: SparkSession, contracts: Sequence[TableContract]) -> DataFrame:
    return schema_rows(spark, {c.target_name: c.schema for c in contracts})


def actual_rows(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    return schema_rows(spark, {name: df.schema for name, df in tables.items()})


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """`(target_table, row_count)` of every table, in one job."""
    return union_all(
        [
            row_count(df).select(F.lit(name).alias("target_table"), "row_count")
            for name, df in tables.items()
        ]
    )


def validate_schemas(
    contracts: Sequence[TableContract],
    tables: Mapping[str, DataFrame],
    check_nullability: bool = True,
    type_equivalence: Mapping[str, str] | None = None,
) -> DataFrame:
    """`(target_table, issues, row_count)` for every contracted table that is in `tables`."""
    spark = next(iter(tables.values())).sparkSession
    present = {c.target_name: tables[c.target_name] for c in contracts if c.target_name in tables}
    messages = schema_messages(
        declared_rows(spark, contracts), actual_rows(spark, present),
        check_nullability, type_equivalence,
    )
    return messages.select("target_table", "issues").join(row_counts(present), "target_table")
