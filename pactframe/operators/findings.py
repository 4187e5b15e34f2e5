"""Rule results: one row per rule of one table.

Counting yields narrow rows `(rule_id, n)`; what the rule is called and how its finding reads
is a small relation of its own, joined once for a whole report.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = (
    "target_table string, position bigint, kind string, rule_name string, "
    "violations bigint, table_rows bigint, message string, status string"
)
RULES_SCHEMA = (
    "rule_id int, target_table string, position bigint, kind string, rule_name string, "
    "before string, after string"
)

ROW_COUNT = "row_count"
NOT_NULL = "not_null"
PRIMARY_KEY_NULL = "primary_key_null"
PRIMARY_KEY_DUPLICATE = "primary_key_duplicate"
CHECK = "check"
UNIQUE_DUPLICATE = "unique_duplicate"
FOREIGN_KEY = "foreign_key"
SCHEMA = "schema"

# What became of a rule. Every declared rule of a report has one of these.
TESTED = "tested"
SKIPPED = "skipped"  # cannot be tested; the message says why
ERROR = "error"  # failed while it was tested, or the table is missing or cannot be read

# The wording of each finding around its number, in the order of reporting.
# {rule} is the rule's name, or its columns if it has none.
MESSAGES = {
    ROW_COUNT: ("", ""),
    NOT_NULL: ("{rule} has ", " NULL rows"),
    PRIMARY_KEY_NULL: ("primary key {columns} has ", " rows with NULL key parts"),
    PRIMARY_KEY_DUPLICATE: ("primary key {columns} has ", " duplicate key groups"),
    CHECK: ("check {rule} has ", " violating rows"),
    UNIQUE_DUPLICATE: ("unique key {columns} has ", " duplicate key groups"),
    FOREIGN_KEY: ("foreign key {rule} has ", " orphan rows"),
}


@dataclass(frozen=True)
class Finding:
    """A rule whose violations are counted. `name` is None for an unnamed rule."""

    kind: str
    name: str | None
    columns: tuple[str, ...] = ()

    @property
    def label(self) -> str:
        return self.name or ",".join(self.columns)

    def wording(self) -> tuple[str, str]:
        columns = list(self.columns)
        before, after = MESSAGES[self.kind]
        return before.format(rule=self.name or columns, columns=columns), after


ROWS_FOUND = Finding(ROW_COUNT, ROW_COUNT)


def place_of(kind: str, rule_id: int) -> int:
    """Where a rule stands in a report: by kind, then by number."""
    ranks = [*MESSAGES, SCHEMA]
    return (ranks.index(kind) << 32) + rule_id


class RuleBook:
    """Numbers the rules of a report and turns their counts into report rows."""

    def __init__(self) -> None:
        self._rules: list[tuple] = []
        self._untested: list[tuple] = []

    def number(self, table: str, finding: Finding) -> int:
        rule_id = len(self._rules)
        position = place_of(finding.kind, rule_id)
        self._rules.append(
            (rule_id, table, position, finding.kind, finding.label, *finding.wording())
        )
        return rule_id

    def untested(self, table: str, kind: str, name: str, status: str, reason: str) -> None:
        """A rule that has no count, with the reason."""
        place = place_of(kind, len(self._rules) + len(self._untested))
        self._untested.append((table, place, kind, name, None, None, reason, status))

    def report(self, spark: SparkSession, counts: Sequence[DataFrame]) -> DataFrame:
        """Join `(rule_id, n)` frames with the rules. There is one row per rule on either
        side, so broadcasting the rules is bounded by the contracts."""
        untested = spark.createDataFrame(self._untested, REPORT_SCHEMA)
        if not counts:
            return untested
        rules = spark.createDataFrame(self._rules, RULES_SCHEMA)
        joined = union_all(counts).join(F.broadcast(rules), "rule_id")
        tested = joined.selectExpr(
            "target_table", "position", "kind", "rule_name",
            f"if(kind = '{ROW_COUNT}', 0L, n) AS violations",
            f"if(kind = '{ROW_COUNT}', n, NULL) AS table_rows",
            f"if(kind <> '{ROW_COUNT}' AND n > 0, concat(before, n, after), NULL) AS message",
            f"'{TESTED}' AS status",
        )
        return tested.unionAll(untested) if self._untested else tested


def numbered(counts: DataFrame, columns: dict[int, str]) -> DataFrame:
    """Turn a one-row frame of counts into `(rule_id, n)` rows, one per given column."""
    pairs = ", ".join(f"{rule_id}, {name}" for rule_id, name in columns.items())
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (rule_id, n)")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of many frames, built as a balanced tree so that analysis stays near-linear."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [reduce(DataFrame.unionAll, pair) for pair in pairs]
    return frames[0]
