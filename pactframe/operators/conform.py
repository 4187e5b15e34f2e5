"""Cast incoming data to a contract's declared columns."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import first_line
from ..functions.names import absent_columns, quoted, sql_text
from ..functions.types import fitting_cast
from ..model import TableContract
from .rows import RowTest, row_tests, violation_tags
from .findings import Finding

CAST = "cast"


class IllegalCast(ValueError):
    """A column whose type Spark can never cast to the declared one."""


@dataclass(frozen=True)
class CastPlan:
    """How each declared column is obtained from the input, as SQL text.

    `casts` are columns of the input, `filled` are absent from it.
    """

    casts: dict[str, str]
    filled: dict[str, str]
    names: list[str]

    def columns(self) -> list[str]:
        sources = self.casts | self.filled
        return [f"{sources[name]} AS {quoted(name)}" for name in self.names]


def illegal_casts(df: DataFrame, contract: TableContract) -> dict[str, str]:
    """Declared columns whose input type cannot be cast at all, with Spark's reason.

    Found by analysis alone. The usual case is legal, so one analysis of the whole
    projection comes first and single columns are only tried when it fails.
    """
    plan = _plan(df, contract, fill_defaults=False)
    if _failure(df, plan.columns()) is None:
        return {}
    reasons = {name: _failure(df, [cast]) for name, cast in plan.casts.items()}
    return {name: reason for name, reason in reasons.items() if reason}


def _failure(df: DataFrame, columns: Sequence[str]) -> str | None:
    try:
        df.selectExpr(*columns).schema
    except Exception as error:  # AnalysisException
        return first_line(error)
    return None


def _plan(df: DataFrame, contract: TableContract, fill_defaults: bool) -> CastPlan:
    types = {field.name: field.dataType for field in contract.schema.fields}
    absent = set(absent_columns(df, types))
    stored = df.select(*[quoted(name) for name in types if name not in absent]).schema.fields
    sources = {
        name: field.dataType for name, field in zip([n for n in types if n not in absent], stored)
    }
    casts = {
        name: fitting_cast(quoted(name), source, types[name]) for name, source in sources.items()
    }
    filled = {
        name: f"CAST({_filling(contract, name, fill_defaults)} AS {types[name].simpleString()})"
        for name in types
        if name in absent
    }
    return CastPlan(casts, filled, list(types))


def _filling(contract: TableContract, name: str, fill_defaults: bool) -> str:
    expression = contract.fill_expression(name) if fill_defaults else None
    return "NULL" if expression is None else expression


def cast_plan(df: DataFrame, contract: TableContract, fill_defaults: bool = False) -> CastPlan:
    illegal = illegal_casts(df, contract)
    if illegal:
        raise IllegalCast(f"{contract.target_name}: {illegal}")
    return _plan(df, contract, fill_defaults)


def conform(df: DataFrame, contract: TableContract, fill_defaults: bool = False) -> DataFrame:
    """The declared columns in declared order and type.

    A value that does not fit becomes NULL (see `cast_rejects`). A column absent from `df`
    takes its default when `fill_defaults` is set and is NULL otherwise; an explicit NULL in
    the input stays NULL. Columns outside the contract are dropped.
    """
    return df.selectExpr(*cast_plan(df, contract, fill_defaults).columns())


def cast_rejects(df: DataFrame, contract: TableContract) -> DataFrame:
    """The rows holding a value that does not fit its declared type, with the names of those
    columns in `rejected_columns`.

    Rounding and truncation still fit; this finds values the declared type cannot hold.
    """
    plan = cast_plan(df, contract)
    misfits = {
        name: f"{quoted(name)} IS NOT NULL AND {cast} IS NULL" for name, cast in plan.casts.items()
    }
    named = ", ".join(
        f"CASE WHEN {misfit} THEN {sql_text(name)} END" for name, misfit in misfits.items()
    )
    found = df.where(" OR ".join(f"({misfit})" for misfit in misfits.values()) or "false")
    return found.withColumn("rejected_columns", F.expr(f"array_compact(array({named}))"))


@dataclass(frozen=True)
class Staged:
    """Rows ready to load: the declared columns next to the input columns, with the casts and
    row rules each row is tested for. `raw` gives the staged name of each input column."""

    rows: DataFrame
    raw: dict[str, str]
    tests: list[RowTest]

    def is_set_aside(self, kinds: Collection[str]) -> str:
        """Condition for a row that fails a rule of one of the kinds."""
        failures = [f"({test.failure})" for test in self.tests if test.finding.kind in kinds]
        return f"coalesce({' OR '.join(failures)}, false)" if failures else "false"


def stage(df: DataFrame, contract: TableContract, fill_defaults: bool = True) -> Staged:
    """Conform rows and keep the input beside them, in one projection.

    Works on a stream as well as on a table.
    """
    plan = cast_plan(df, contract, fill_defaults)
    raw = {name: f"__raw{place}" for place, name in enumerate(df.columns)}
    kept = [f"{quoted(name)} AS {alias}" for name, alias in raw.items()]
    rows = df.selectExpr(*kept, *plan.columns())
    alias_of = {name.upper(): alias for name, alias in raw.items()} | raw
    tests = [
        RowTest(
            Finding(CAST, name),
            f"{alias_of.get(name) or alias_of[name.upper()]} IS NOT NULL "
            f"AND {quoted(name)} IS NULL",
        )
        for name in plan.casts
    ]
    return Staged(rows, raw, tests + row_tests(rows, contract)[0])


def check_set_aside(set_aside: Collection[str], path: str | None) -> None:
    """Refuse to set rows aside to nowhere."""
    if set_aside and not path:
        raise ValueError(
            "rows are set aside to a path: pass set_aside_path, or set_aside=() to load every "
            "row, with NULL for values that do not fit"
        )


def split_staged(
    staged: Staged, contract: TableContract, set_aside: Collection[str] = (CAST,)
) -> tuple[DataFrame, DataFrame]:
    """Staged rows in two frames: those to load, in the declared columns, and those set
    aside, as they came in plus `violations`, what is wrong with each."""
    out = staged.is_set_aside(set_aside)
    fitting = staged.rows.where(f"NOT {out}").select(*[quoted(c.name) for c in contract.columns])
    original = [f"{alias} AS {quoted(name)}" for name, alias in staged.raw.items()]
    rejected = staged.rows.where(out).select(
        *[F.expr(column) for column in original],
        violation_tags(staged.tests).alias("violations"),
    )
    return fitting, rejected
