"""Contracts held as data: a table's declared columns and the rules on its rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from .functions.names import target_table_name
from .functions.types import is_wide_text, map_declared_type

PRIMARY_KEY = "primary_key"
UNIQUE = "unique"
FOREIGN_KEY = "foreign_key"
CHECK = "check"
KINDS = (PRIMARY_KEY, UNIQUE, FOREIGN_KEY, CHECK)


@dataclass(frozen=True)
class Column:
    name: str
    declared_type: str
    nullable: bool = True
    default_expr: str | None = None


@dataclass(frozen=True)
class Rule:
    """One key or check. `origin` tells a unique constraint from a unique index."""

    kind: str
    columns: tuple[str, ...] = ()
    name: str | None = None
    ref_table: str | None = None
    ref_columns: tuple[str, ...] = ()
    expression: str | None = None
    origin: str = "constraint"
    ref_schema: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown rule kind {self.kind!r}")
        if self.kind == CHECK and not self.expression:
            raise ValueError("a check rule needs an expression")
        if self.kind != CHECK and not self.columns:
            raise ValueError(f"a {self.kind} rule needs columns")
        if self.kind == FOREIGN_KEY and not self.ref_table:
            raise ValueError("a foreign_key rule needs ref_table")
        object.__setattr__(self, "columns", tuple(self.columns))
        object.__setattr__(self, "ref_columns", tuple(self.ref_columns))

    @property
    def label(self) -> str:
        return self.name or self.expression or ",".join(self.columns)


@dataclass(frozen=True)
class TableContract:
    source_name: str
    columns: tuple[Column, ...]
    rules: tuple[Rule, ...] = ()
    source_schema: str | None = None
    target_name: str = ""

    def __post_init__(self) -> None:
        object.__setattr__(self, "columns", tuple(self.columns))
        object.__setattr__(self, "rules", tuple(self.rules))
        object.__setattr__(self, "source_name", self.source_name.upper())
        if self.source_schema:
            object.__setattr__(self, "source_schema", self.source_schema.upper())
        if not self.target_name:
            object.__setattr__(self, "target_name", target_table_name(self.source_name))
        if not self.columns:
            raise ValueError(f"table {self.source_name} declares no columns")
        if sum(rule.kind == PRIMARY_KEY for rule in self.rules) > 1:
            raise ValueError(f"table {self.source_name} declares more than one primary key")

    def rules_of(self, kind: str) -> tuple[Rule, ...]:
        return tuple(rule for rule in self.rules if rule.kind == kind)

    @property
    def primary_key(self) -> Rule | None:
        return next(iter(self.rules_of(PRIMARY_KEY)), None)

    @property
    def required(self) -> tuple[str, ...]:
        """Names of the columns that take no NULL."""
        return tuple(stored.name for stored in self.schema if not stored.nullable)

    def fill_expression(self, name: str) -> str | None:
        """What a column absent from a load is filled with, as SQL text."""
        found = {column.name: column.default_expr for column in self.columns}
        return found[name]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(c.name, map_declared_type(c.declared_type).data_type, c.nullable)
                for c in self.columns
            ]
        )

    @property
    def unknown_types(self) -> dict[str, str]:
        """Columns whose declared type is outside the type table and became string."""
        return {
            c.name: c.declared_type
            for c in self.columns
            if not map_declared_type(c.declared_type).known
        }

    def has_wide_text(self, names: Iterable[str]) -> bool:
        wide = {c.name.upper() for c in self.columns if is_wide_text(c.declared_type)}
        return any(name.upper() in wide for name in names)

    def upper_cased(self) -> TableContract:
        """The same contract with column names in the source database's upper case."""

        def up(names: Iterable[str]) -> tuple[str, ...]:
            return tuple(name.upper() for name in names)

        return replace(
            self,
            columns=tuple(replace(c, name=c.name.upper()) for c in self.columns),
            rules=tuple(
                replace(r, columns=up(r.columns), ref_columns=up(r.ref_columns))
                for r in self.rules
            ),
        )


@dataclass(frozen=True)
class RunOptions:
    """Behaviour switches of a run; every run gets its own."""

    replace_existing: bool = False
    allow_data_loss: bool = False
    fail_on_mismatch: bool = True
    write_properties: bool = True
    validate_schema: bool = True
    validate_constraints: bool = True
    continue_on_error: bool = True
    # File sources other than delta read every column back as nullable, so comparing
    # nullability is only meaningful where the provider keeps it. None = decide by provider.
    check_nullability: bool | None = None
    type_equivalence: Mapping[str, str] = field(default_factory=dict)
    # target table -> Spark SQL condition that limits validation to a slice of it
    where: Mapping[str, str] = field(default_factory=dict)
    report_path: str | None = None
    issues_path: str | None = None
    # a job holds tables up to so many scans, and up to so many tables if that is set
    scans_per_job: int = 32
    tables_per_job: int | None = None
    jobs_at_once: int = 4
