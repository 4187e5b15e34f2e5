"""The issue log: everything a run found or could not do, as rows of one table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import first_line
from ..model import TableContract
from ..operators.rows import Skipped
from ..sources.tables import TableStore

_COLUMNS = "array<struct<name:string,data_type:string,nullable:boolean>>"
# The fields of an issue.
ISSUE_FIELDS = {
    "logged_at_utc": "timestamp",
    "issue_type": "string",
    "source_schema": "string",
    "source_table": "string",
    "target_schema": "string",
    "target_table": "string",
    "target_path": "string",
    "issues": "array<string>",
    "expected_schema": _COLUMNS,
    "actual_schema": _COLUMNS,
    "operation": "string",
    "error_type": "string",
    "error_message": "string",
}
ISSUES_SCHEMA = ", ".join(f"{name} {data_type}" for name, data_type in ISSUE_FIELDS.items())
FACTS_SCHEMA = (
    "target_table string, source_schema string, source_table string, "
    "target_schema string, target_path string"
)

SCHEMA_MISMATCH = "schema_mismatch"
VIOLATION = "ContractViolation"


def table_facts(
    spark: SparkSession, contracts: Sequence[TableContract], store: TableStore
) -> DataFrame:
    """What every issue says about its table."""
    rows = [
        (name, c.source_schema, c.source_name, store.schema_name, store.path(name))
        for name, c in ((c.target_name, c) for c in contracts)
    ]
    return spark.createDataFrame(rows, FACTS_SCHEMA)


def _as_issues(found: DataFrame, facts: DataFrame) -> DataFrame:
    """Complete rows that have `target_table`, `issue_type` and some of the issue fields."""
    known = found.join(facts, "target_table").withColumn("logged_at_utc", F.current_timestamp())
    return known.select(
        *[
            (F.col(name) if name in known.columns else F.lit(None)).cast(data_type).alias(name)
            for name, data_type in ISSUE_FIELDS.items()
        ]
    )


def mismatch_issues(messages: DataFrame, facts: DataFrame) -> DataFrame:
    """One `schema_mismatch` row per table whose `schema_messages` are not empty."""
    found = messages.where(F.size("issues") > 0).withColumn("issue_type", F.lit(SCHEMA_MISMATCH))
    return _as_issues(found, facts)


def violation_issues(reported: DataFrame, facts: DataFrame) -> DataFrame:
    """One `validate_error` row per table with broken rules, naming them in report order."""
    broken = reported.where("violations > 0").groupBy("target_table").agg(
        F.array_sort(F.collect_list(F.struct("position", "message"))).alias("found")
    )
    texts = F.transform("found", lambda entry: entry["message"])
    found = broken.select(
        "target_table",
        F.lit("validate_error").alias("issue_type"),
        F.lit("validate").alias("operation"),
        F.lit(VIOLATION).alias("error_type"),
        F.concat(
            "target_table", F.lit(" constraint validation failed: "), F.array_join(texts, "; ")
        ).alias("error_message"),
    )
    return _as_issues(found, facts)


class IssueLog:
    """Issues of one run that arise on the driver: errors, skipped rules, unknown types."""

    def __init__(self, spark: SparkSession, contracts: Sequence[TableContract], store: TableStore):
        self.spark = spark
        self.store = store
        self.facts = table_facts(spark, contracts, store)
        self.rows: list[Row] = []

    def add(self, contract: TableContract, issue_type: str, **fields) -> None:
        base = {
            "logged_at_utc": datetime.now(timezone.utc),
            "issue_type": issue_type,
            "source_schema": contract.source_schema,
            "source_table": contract.source_name,
            "target_schema": self.store.schema_name,
            "target_table": contract.target_name,
            "target_path": self.store.path(contract.target_name),
        }
        values = base | fields
        self.rows.append(Row(**{name: values.get(name) for name in ISSUE_FIELDS}))

    def namespace_error(self, error: BaseException) -> None:
        """The schema could not be made; its tables may still be written by path."""
        values = {
            "logged_at_utc": datetime.now(timezone.utc), "issue_type": "namespace_error",
            "target_schema": self.store.schema_name, "operation": "create",
            "error_type": type(error).__name__, "error_message": str(error),
        }
        self.rows.append(Row(**{name: values.get(name) for name in ISSUE_FIELDS}))

    def error(self, contract: TableContract, operation: str, error: BaseException) -> None:
        self.add(
            contract, f"{operation}_error", operation=operation,
            error_type=type(error).__name__, error_message=str(error),
        )

    def rule_error(
        self, contract: TableContract, kind: str, rule_name: str, error: BaseException
    ) -> None:
        """A rule that was tested and failed at run time."""
        self.add(
            contract, f"{kind}_error", operation="validate", error_type=type(error).__name__,
            error_message=f"{rule_name}: {first_line(error)}",
        )

    def skipped(self, contract: TableContract, skipped: Skipped) -> None:
        self.add(
            contract, skipped.issue_type, operation="validate", error_type="Skipped",
            error_message=f"{skipped.rule_name}: {skipped.reason}",
        )

    def unknown_types(self, contract: TableContract) -> None:
        for name, declared in contract.unknown_types.items():
            self.add(
                contract, "type_fallback", operation="create", error_type="UnknownType",
                error_message=f"{name}: declared type {declared} becomes string",
            )

    def collected(self, issues: DataFrame) -> int:
        """Take up issues found by a job; they are at most one per table."""
        found = issues.collect()
        self.rows += found
        return len(found)

    def to_df(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, ISSUES_SCHEMA)
