"""Sinks for what a run found."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The layout of the text report.
TITLE = "Schema mismatch report - generated "
RULE_LINE = "=" * 72


def report_lines(issues: DataFrame, generated_at: datetime | None = None) -> DataFrame:
    """The schema mismatches of an issue log as ordered lines `(section, line_no, value)`:
    a head, then for each table its name, its differences and an empty line."""
    stamp = (generated_at or datetime.now(timezone.utc)).isoformat()
    mismatches = issues.where("issue_type = 'schema_mismatch'")
    head = mismatches.sparkSession.createDataFrame(
        [(0, f"{TITLE}{stamp}"), (1, RULE_LINE), (2, "")], "line_no int, value string"
    ).select(F.lit("").alias("section"), "line_no", "value")
    lines = F.concat(
        F.array(F.concat_ws(".", "target_schema", "target_table")),
        F.transform("issues", lambda text: F.concat(F.lit("  - "), text)),
        F.array(F.lit("")),
    )
    body = mismatches.select(
        F.col("target_table").alias("section"), F.posexplode(lines).alias("line_no", "value")
    )
    return head.unionByName(body)


def write_report(issues: DataFrame, path: str, generated_at: datetime | None = None) -> bool:
    """Write the mismatch report as one text file; nothing is written without mismatches.

    The report has a few lines per drifted table, so one ordered partition is right here.
    """
    if issues.where("issue_type = 'schema_mismatch'").isEmpty():
        return False
    ordered = (
        report_lines(issues, generated_at)
        .coalesce(1)
        .sortWithinPartitions("section", "line_no")
        .select("value")
    )
    ordered.write.mode("overwrite").text(path)
    return True


def write_issues(
    issues: DataFrame, path: str, provider: str = "parquet", mode: str = "append"
) -> None:
    """Store the whole issue log, one folder per issue type."""
    issues.write.format(provider).mode(mode).partitionBy("issue_type").save(path)
