"""Declared against actual schemas, for all tables in one join.

The inputs are relations of columns, so a run over hundreds of tables compares every column
of every table at once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_ROWS = "target_table string, position int, name string, data_type string, nullable boolean"

MISSING = "missing"
EXTRA = "extra"
ORDER = "order"
TYPE = "type"
NULLABILITY = "nullability"


def schema_rows(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """One row per column of each table; names in upper case, types in Spark's short form."""
    rows = [
        (table, place, field.name.upper(), field.dataType.simpleString(), field.nullable)
        for table, schema in schemas.items()
        for place, field in enumerate(schema.fields)
    ]
    return spark.createDataFrame(rows, SCHEMA_ROWS)


def _same_type_names(data_type: Column, equivalence: Mapping[str, str]) -> Column:
    """Replace type names by the one they count as, e.g. timestamp_ntz by timestamp."""
    for name, counts_as in equivalence.items():
        data_type = F.when(data_type == name, F.lit(counts_as)).otherwise(data_type)
    return data_type


def compare_columns(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """The columns of two relations side by side, limited to tables that both have.

    `e_*` and `a_*` hold the two sides; `e_rank` and `a_rank` number the common columns of a
    table by either order.
    """
    fields = {"position": "int", "data_type": "string", "nullable": "boolean"}

    def side(rows: DataFrame, mine: str, other: str) -> DataFrame:
        return rows.selectExpr(
            "target_table", "name",
            *[f"{name} AS {mine}_{name}" for name in fields],
            *[f"CAST(NULL AS {kind}) AS {other}_{name}" for name, kind in fields.items()],
        )

    # Pairing by grouping the stacked sides takes one shuffle; each side has one row per column.
    both = side(expected, "e", "a").unionByName(side(actual, "a", "e"))
    values = [name for name in both.columns if name not in ("target_table", "name")]
    paired = both.groupBy("target_table", "name").agg(*[F.max(name).alias(name) for name in values])
    # A window holds the columns of one table.
    table = "PARTITION BY target_table"
    common = "e_position IS NOT NULL AND a_position IS NOT NULL"
    ranked = paired.selectExpr(
        "*",
        f"max(e_position) OVER ({table}) IS NOT NULL AND max(a_position) OVER ({table}) IS NOT NULL"
        " AS in_both",
        *[
            f"CASE WHEN {common} THEN count_if({common}) OVER ({table} ORDER BY {s}_position) END"
            f" AS {s}_rank"
            for s in ("e", "a")
        ],
    )
    return ranked.where("in_both").drop("in_both")


def _drift(
    compared: DataFrame, check_nullability: bool, type_equivalence: Mapping[str, str] | None
) -> dict[str, Column]:
    """Condition of each kind of difference over a row of `compare_columns`."""
    equivalence = type_equivalence or {}
    common = F.col("e_rank").isNotNull()
    return {
        MISSING: F.col("a_position").isNull(),
        EXTRA: F.col("e_position").isNull(),
        ORDER: common & (F.col("e_rank") != F.col("a_rank")),
        TYPE: common
        & (
            _same_type_names(F.col("e_data_type"), equivalence)
            != _same_type_names(F.col("a_data_type"), equivalence)
        ),
        NULLABILITY: common
        & F.lit(check_nullability)
        & ~F.col("e_nullable")
        & F.col("a_nullable"),
    }


def schema_diff(
    expected: DataFrame,
    actual: DataFrame,
    check_nullability: bool = True,
    type_equivalence: Mapping[str, str] | None = None,
) -> DataFrame:
    """`(target_table, column_name, issue, expected, actual)`, one row per column and kind.

    Only a column that is declared NOT NULL and found nullable is a nullability issue, not
    the reverse. Order is compared over the columns both sides have.
    """
    compared = compare_columns(expected, actual)
    shown = {
        MISSING: ("e_data_type", None),
        EXTRA: (None, "a_data_type"),
        ORDER: ("e_rank", "a_rank"),
        TYPE: ("e_data_type", "a_data_type"),
        NULLABILITY: ("e_nullable", "a_nullable"),
    }

    def side(name: str | None) -> Column:
        return (F.lit(None) if name is None else F.col(name)).cast("string")

    kinds = [
        F.when(
            found,
            F.struct(
                F.lit(kind).alias("issue"),
                side(shown[kind][0]).alias("expected"),
                side(shown[kind][1]).alias("actual"),
            ),
        )
        for kind, found in _drift(compared, check_nullability, type_equivalence).items()
    ]
    found = F.inline(F.array_compact(F.array(*kinds)))
    return compared.select("target_table", F.col("name").alias("column_name"), found)


def _names_in_order(found: Column, position: str) -> Column:
    """Names of the matching columns in the given order, as an array."""
    entries = F.collect_list(F.when(found, F.struct(position, "name")))
    return F.transform(F.array_sort(entries), lambda entry: entry["name"])


def _listed(names: Column) -> Column:
    return F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))


def _signature(side: str) -> Column:
    """The columns of one side in order, as they are stored with an issue."""
    entries = F.collect_list(
        F.when(
            F.col(f"{side}_position").isNotNull(),
            F.struct(
                F.col(f"{side}_position").alias("position"),
                "name",
                F.col(f"{side}_data_type").alias("data_type"),
                F.col(f"{side}_nullable").alias("nullable"),
            ),
        )
    )
    return F.transform(
        F.array_sort(entries),
        lambda entry: F.struct(
            entry["name"].alias("name"),
            entry["data_type"].alias("data_type"),
            entry["nullable"].alias("nullable"),
        ),
    )


def schema_messages(
    expected: DataFrame,
    actual: DataFrame,
    check_nullability: bool = True,
    type_equivalence: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per compared table: `target_table`, `issues` (the differences in words, empty
    when there are none), `expected_schema` and `actual_schema`.

    A group holds the columns of one table.
    """
    compared = compare_columns(expected, actual)
    found = _drift(compared, check_nullability, type_equivalence)
    common = F.col("e_rank").isNotNull()
    # The wording of each difference.
    type_text = F.concat(
        "name", F.lit(" type expected "), "e_data_type", F.lit(", found "), "a_data_type"
    )
    nullability_text = F.concat("name", F.lit(" expected NOT NULL but catalog is nullable"))
    per_column = F.array_compact(
        F.array(
            F.when(found[TYPE], type_text), F.when(found[NULLABILITY], nullability_text)
        )
    )
    lists = compared.groupBy("target_table").agg(
        _names_in_order(found[MISSING], "e_position").alias(MISSING),
        _names_in_order(found[EXTRA], "a_position").alias(EXTRA),
        F.max(found[ORDER]).alias("reordered"),
        _names_in_order(common, "e_rank").alias("e_order"),
        _names_in_order(common, "a_rank").alias("a_order"),
        F.array_sort(
            F.collect_list(
                F.when(common, F.struct("e_position", per_column.alias("texts")))
            )
        ).alias("details"),
        _signature("e").alias("expected_schema"),
        _signature("a").alias("actual_schema"),
    )
    order_text = F.concat(
        F.lit("column order mismatch: expected "), _listed(F.col("e_order")),
        F.lit(", found "), _listed(F.col("a_order")),
    )
    summary = F.array_compact(
        F.array(
            *[
                F.when(
                    F.size(kind) > 0, F.concat(F.lit(f"{kind} columns: "), _listed(F.col(kind)))
                )
                for kind in (MISSING, EXTRA)
            ],
            F.when(F.col("reordered"), order_text),
        )
    )
    details = F.flatten(F.transform("details", lambda entry: entry["texts"]))
    return lists.select(
        "target_table", F.concat(summary, details).alias("issues"),
        "expected_schema", "actual_schema",
    )
