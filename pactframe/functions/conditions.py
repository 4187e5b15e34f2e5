"""Row conditions shared by the operators, as Spark SQL text over quoted names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .names import quoted

def any_null(names: Sequence[str]) -> str:
    return " OR ".join(f"{quoted(name)} IS NULL" for name in names)


def all_present(names: Sequence[str]) -> str:
    return " AND ".join(f"{quoted(name)} IS NOT NULL" for name in names)


def any_present(names: Sequence[str]) -> str:
    return " OR ".join(f"{quoted(name)} IS NOT NULL" for name in names)


def _name_before_not_null(expression: str) -> str:
    """A check that is one double-quoted name and NOT NULL test, with its name in backticks: the
    quotes can mean nothing else there. Any other text as it is."""
    empty, *rest = expression.strip().split('"')
    if empty == "" and len(rest) == 2 and rest[1].upper().split() == ["IS", "NOT", "NULL"]:
        return f"{quoted(rest[0])}{rest[1]}"
    return expression


def check_failure(df: DataFrame, expression: str) -> str:
    """Condition that holds for the rows of `df` which violate a CHECK expression.

    A check that is unknown (NULL) passes. Raises ValueError when the text cannot be used
    as a row condition on `df`; only analysis is done, no job is run.
    """
    expression = _name_before_not_null(expression)
    ansi_quotes = df.sparkSession.conf.get("spark.sql.ansi.doubleQuotedIdentifiers")
    if '"' in expression and ansi_quotes != "true":
        raise ValueError("double quotes mean text here, not a name; use backticks")
    # The line break keeps a trailing comment in the text from hiding the bracket.
    failure = f"NOT ({expression}\n)"
    try:
        # As a filter it must be boolean and free of aggregates; the second analysis is the
        # shape in which the condition is counted.
        df.where(expression).schema
        df.selectExpr(f"count_if({failure})").schema
    except Exception as error:  # ParseException or AnalysisException
        raise ValueError(first_line(error)) from error
    return failure


def first_line(error: BaseException) -> str:
    return (str(error).strip() or type(error).__name__).splitlines()[0]
