"""Identifier rules."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def target_table_name(source_name: str, overrides: Mapping[str, str] | None = None) -> str:
    """Lower snake-case table name for a source table; an override wins over the rule."""
    if overrides and source_name in overrides:
        return overrides[source_name]
    words = re.findall(r"[0-9A-Za-z]+", source_name)
    if not words:
        raise ValueError(f"no table name can be derived from {source_name!r}")
    name = "_".join(words).lower()
    return f"t_{name}" if name[0].isdigit() else name


def quoted(identifier: str) -> str:
    """Backtick-quoted identifier, safe for names that hold dots, spaces or backticks."""
    return "`" + identifier.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """Single-quoted Spark SQL literal; backslashes and quotes survive the round trip."""
    return "'" + value.replace("\\", "\\\\").replace("'", "''") + "'"


def folded(spark: SparkSession, name: str) -> str:
    """The name as the session compares it."""
    return name if spark.conf.get("spark.sql.caseSensitive") == "true" else name.upper()


def absent_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that `df` has no column for, under the session's case rule."""
    spark = df.sparkSession
    present = {folded(spark, name) for name in df.columns}
    return [name for name in names if folded(spark, name) not in present]
