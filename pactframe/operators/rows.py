"""Rules that one row alone can break: NOT NULL, NULL key parts, checks.

All of a table's row rules are counted in one aggregate over one scan; the scan reads only
the columns the rules name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import any_null, check_failure
from ..functions.names import absent_columns, quoted, sql_text
from ..model import TableContract
from . import findings
from .findings import ROWS_FOUND, Finding, RuleBook, numbered


@dataclass(frozen=True)
class RowTest:
    """A rule with the condition (SQL text) that holds for the rows violating it."""

    finding: Finding
    failure: str

    @property
    def counts_values(self) -> bool:
        """Whether the rule only asks how many values one column has."""
        kinds = (findings.NOT_NULL, findings.PRIMARY_KEY_NULL)
        return self.finding.kind in kinds and len(self.finding.columns) == 1

    @property
    def count(self) -> str:
        """Aggregate that counts the violations.

        NULLs of one column are counted as rows minus values, a form that aggregate
        push-down answers from file footers.
        """
        if self.counts_values:
            return f"count(1) - count({quoted(self.finding.columns[0])})"
        return f"count_if({self.failure})"


@dataclass(frozen=True)
class Skipped:
    """A rule that could not be tested, and why."""

    kind: str
    rule_name: str
    reason: str

    @property
    def issue_type(self) -> str:
        return f"{self.kind}_skipped"


def row_tests(df: DataFrame, contract: TableContract) -> tuple[list[RowTest], list[Skipped]]:
    """The row rules of a contract that `df` has the columns for, and those it has not."""
    tests: list[RowTest] = []
    skipped: list[Skipped] = []
    nullable = [Finding(findings.NOT_NULL, name, (name,)) for name in contract.required]
    key = contract.primary_key
    if key:
        nullable.append(Finding(findings.PRIMARY_KEY_NULL, key.name, key.columns))
    for finding in nullable:
        missing = absent_columns(df, finding.columns)
        if missing:
            skipped.append(Skipped(finding.kind, finding.label, f"no column {missing}"))
        else:
            tests.append(RowTest(finding, any_null(finding.columns)))
    for rule in contract.rules_of("check"):
        try:
            failure = check_failure(df, rule.expression)
        except ValueError as error:
            skipped.append(Skipped(findings.CHECK, rule.label, str(error)))
        else:
            tests.append(RowTest(Finding(findings.CHECK, rule.label), failure))
    return tests, skipped


def row_count(df: DataFrame) -> DataFrame:
    return df.selectExpr("count(1) AS row_count")


def count_rows_and_failures(
    df: DataFrame,
    table: str,
    tests: Sequence[RowTest],
    book: RuleBook,
    others: Sequence[tuple[Finding, str]] = (),
) -> DataFrame:
    """The table's row count and every given rule's violations, from a single aggregate.

    `others` are rules other than row rules, with the aggregate over `df` that counts them.
    """
    rules = [(ROWS_FOUND, "count(1)")] + [(test.finding, test.count) for test in tests]
    return _count(df, table, [*rules, *others], book)


def count_failures(
    df: DataFrame,
    table: str,
    tests: Sequence[RowTest],
    book: RuleBook,
    others: Sequence[tuple[Finding, str]] = (),
) -> DataFrame:
    """The same without the row count."""
    rules = [(test.finding, test.count) for test in tests]
    return _count(df, table, [*rules, *others], book)


def _count(
    df: DataFrame, table: str, rules: Sequence[tuple[Finding, str]], book: RuleBook
) -> DataFrame:
    counts = {book.number(table, rule): count for rule, count in rules}
    counted = df.selectExpr(*[f"{count} AS t{rule_id}" for rule_id, count in counts.items()])
    return numbered(counted, {rule_id: f"t{rule_id}" for rule_id in counts})


def not_null_violations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """`(column_name, null_rows)` for each column that holds NULLs, from one scan."""
    counts = [f"count(1) - count({quoted(name)}) AS t{i}" for i, name in enumerate(names)]
    pairs = ", ".join(f"{sql_text(name)}, t{i}" for i, name in enumerate(names))
    return (
        df.selectExpr(*counts)
        .selectExpr(f"stack({len(names)}, {pairs}) AS (column_name, null_rows)")
        .where("null_rows > 0")
    )


def null_key_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of rows with a NULL in any part of the key."""
    return df.selectExpr(f"count_if({any_null(key)}) AS null_key_rows")


def check_violations(df: DataFrame, expression: str) -> DataFrame:
    """The rows that violate a check."""
    return df.where(check_failure(df, expression))


def violation_tags(tests: Sequence[RowTest]) -> Column:
    """Array with one `(kind, rule_name)` entry per row rule the row violates."""
    if not tests:
        return F.expr("CAST(array() AS array<struct<kind:string,rule_name:string>>)")
    entries = [
        f"CASE WHEN {test.failure} THEN named_struct('kind', {sql_text(test.finding.kind)}, "
        f"'rule_name', {sql_text(test.finding.label)}) END"
        for test in tests
    ]
    return F.expr(f"array_compact(array({', '.join(entries)}))")


def rows_violating(df: DataFrame, tests: Sequence[RowTest]) -> DataFrame:
    """Every violating row once per rule it violates: `kind`, `rule_name`, the row's columns.

    One scan serves all rules. The rows are filtered before they are tagged, so that the scan
    can pass over row groups whose statistics rule a violation out. Filters and projections
    only, so it also runs on a stream.
    """
    names = [quoted(name) for name in df.columns]
    broken = " OR ".join(f"({test.failure})" for test in tests) or "false"
    tagged = df.where(broken).select(F.explode(violation_tags(tests)).alias("__tag"), *names)
    return tagged.select("__tag.kind", "__tag.rule_name", *names)
