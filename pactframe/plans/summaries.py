"""Counts over contracts and issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import KINDS
from ..sources.contracts import ContractTables


def contract_summary(contracts: ContractTables) -> DataFrame:
    """`(kind, origin, n)`: how many rules of each kind there are."""
    return contracts.rules.groupBy("kind", "origin").agg(F.count(F.lit(1)).alias("n"))


def table_summary(contracts: ContractTables) -> DataFrame:
    """One row per table: where it comes from, its number of columns, and of rules by kind."""
    columns = contracts.columns.groupBy("target_name").agg(F.count(F.lit(1)).alias("n_columns"))
    rules = contracts.rules.groupBy("target_name").agg(
        *[F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in KINDS]
    )
    return (
        contracts.tables.join(columns, "target_name", "left")
        .join(rules, "target_name", "left")
        .na.fill(0, ["n_columns", *[f"n_{kind}" for kind in KINDS]])
        .na.fill("<default>", ["source_schema"])
    )


def issue_summary(issues: DataFrame) -> DataFrame:
    """`(issue_type, target_table, n)`."""
    return issues.groupBy("issue_type", "target_table").agg(F.count(F.lit(1)).alias("n"))


def issue_lines(issues: DataFrame) -> DataFrame:
    """`(issue_type, target_schema, target_table, detail)`, one row per message: the texts of
    an issue that has them, else its error."""
    error = F.concat_ws(": ", "error_type", "error_message")
    details = F.when(F.size("issues") > 0, F.col("issues")).otherwise(F.array(error))
    return issues.select(
        "issue_type", "target_schema", "target_table", F.explode(details).alias("detail")
    )
