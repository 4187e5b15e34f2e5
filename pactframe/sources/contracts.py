"""Contracts stored as three tables, one row per fact.

Contracts are metadata (a few rows per table), so they are brought to the driver to build
plans from; the data they describe never is.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession

from ..model import Column, Rule, TableContract

TABLES_SCHEMA = "source_schema string, source_name string, target_name string"
COLUMNS_SCHEMA = (
    "target_name string, position int, name string, declared_type string, "
    "nullable boolean, default_expr string"
)
RULES_SCHEMA = (
    "target_name string, rule_name string, kind string, columns array<string>, "
    "ref_table string, ref_columns array<string>, expression string, origin string, "
    "ref_schema string, position int"
)


class ContractTables(NamedTuple):
    tables: DataFrame
    columns: DataFrame
    rules: DataFrame


def to_tables(spark: SparkSession, contracts: Sequence[TableContract]) -> ContractTables:
    tables = [(c.source_schema, c.source_name, c.target_name) for c in contracts]
    columns = [
        (c.target_name, place, col.name, col.declared_type, col.nullable, col.default_expr)
        for c in contracts
        for place, col in enumerate(c.columns)
    ]
    rules = [
        (
            c.target_name, r.name, r.kind, list(r.columns), r.ref_table,
            list(r.ref_columns), r.expression, r.origin, r.ref_schema, place,
        )
        for c in contracts
        for place, r in enumerate(c.rules)
    ]
    return ContractTables(
        spark.createDataFrame(tables, TABLES_SCHEMA),
        spark.createDataFrame(columns, COLUMNS_SCHEMA),
        spark.createDataFrame(rules, RULES_SCHEMA),
    )


def from_tables(
    tables: DataFrame, columns: DataFrame, rules: DataFrame, targets: Iterable[str] | None = None,
    faults: dict[str, str] | None = None,
) -> list[TableContract]:
    """The contracts held in the three tables, or those of the given target tables.

    With `faults` a table whose rows make no contract is left out, and what is wrong with it is put
    there under its name; without, it raises.
    """
    if targets is not None:
        wanted = list(targets)
        tables, columns, rules = (
            df.where(df["target_name"].isin(wanted)) for df in (tables, columns, rules)
        )
    columns_of, rules_of = defaultdict(list), defaultdict(list)
    for row in columns.orderBy("target_name", "position").collect():
        nullable = True if row.nullable is None else row.nullable
        columns_of[row.target_name].append(
            Column(row.name, row.declared_type, nullable, row.default_expr)
        )
    # The last two columns of the rules may be left out of hand-made contract tables.
    places = ["position"] if "position" in rules.columns else []
    for row in rules.orderBy("target_name", *places, "rule_name").collect():
        rules_of[row.target_name].append(row)

    def rule(row: Row) -> Rule:
        return Rule(
            row.kind, tuple(row.columns or ()), row.rule_name, row.ref_table,
            tuple(row.ref_columns or ()), row.expression, row.origin or "constraint",
            row["ref_schema"] if "ref_schema" in rules.columns else None,
        )

    contracts = []
    for row in tables.orderBy("target_name").collect():
        name = row.target_name
        try:
            contract = TableContract(
                row.source_name, tuple(columns_of[name]), tuple(map(rule, rules_of[name])),
                row.source_schema, name,
            )
        except ValueError as error:
            if faults is None:
                raise
            faults[name] = str(error)
        else:
            contracts.append(contract)
    return contracts


def read_contracts(
    spark: SparkSession, root: str, provider: str = "parquet", faults: dict[str, str] | None = None
) -> list[TableContract]:
    """Contracts saved under `root` by `write_contracts`; for `faults` see `from_tables`."""
    read = spark.read.format(provider)
    frames = [read.load(f"{root.rstrip('/')}/{name}") for name in _NAMES]
    return from_tables(*frames, faults=faults)


def write_contracts(
    spark: SparkSession, contracts: Sequence[TableContract], root: str,
    provider: str = "parquet", mode: str = "errorifexists",
) -> None:
    for name, frame in zip(_NAMES, to_tables(spark, contracts)):
        frame.write.format(provider).mode(mode).save(f"{root.rstrip('/')}/{name}")


_NAMES = ("contract_tables", "contract_columns", "contract_rules")
