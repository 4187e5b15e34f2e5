import pytest
from pyspark.sql import types as T

from pactframe import Column, TableContract, schema_diff, schema_messages, schema_rows, validate_schemas


def schema(ddl):
    return T.StructType.fromDDL(ddl)


def compared(spark, expected, actual, **options):
    left, right = (schema_rows(spark, {"t": schema(s)}) for s in (expected, actual))
    diff = {
        (r.column_name, r.issue, r.expected, r.actual)
        for r in schema_diff(left, right, **options).collect()
    }
    return diff, schema_messages(left, right, **options).first().issues


def test_no_difference(spark):
    diff, issues = compared(spark, "a int, b string", "A int, B string")
    assert (diff, issues) == (set(), [])


def test_every_kind_of_difference(spark):
    diff, issues = compared(
        spark,
        "a int, gone date, b bigint NOT NULL, c string, lost int",
        "c string, more int, b int, a int, extra string",
    )
    assert diff == {
        ("GONE", "missing", "date", None), ("LOST", "missing", "int", None),
        ("MORE", "extra", None, "int"), ("EXTRA", "extra", None, "string"),
        ("A", "order", "1", "3"), ("C", "order", "3", "1"),
        ("B", "type", "bigint", "int"), ("B", "nullability", "false", "true"),
    }
    assert issues == [
        "missing columns: ['GONE', 'LOST']",
        "extra columns: ['MORE', 'EXTRA']",
        "column order mismatch: expected ['A', 'B', 'C'], found ['C', 'B', 'A']",
        "B type expected bigint, found int",
        "B expected NOT NULL but catalog is nullable",
    ]


def test_nullability_is_one_way_and_can_be_left_out(spark):
    diff, issues = compared(spark, "a int, b int NOT NULL", "a int NOT NULL, b int")
    assert diff == {("B", "nullability", "false", "true")}
    diff, issues = compared(spark, "b int NOT NULL", "b int", check_nullability=False)
    assert (diff, issues) == (set(), [])


def test_missing_columns_do_not_make_an_order_mismatch(spark):
    diff, _ = compared(spark, "a int, b int, c int", "b int, x int, c int")
    assert {kind for _, kind, _, _ in diff} == {"missing", "extra"}


def test_equivalent_types(spark):
    diff, _ = compared(spark, "a timestamp", "a timestamp_ntz")
    assert diff == {("A", "type", "timestamp", "timestamp_ntz")}
    diff, _ = compared(
        spark, "a timestamp", "a timestamp_ntz", type_equivalence={"timestamp_ntz": "timestamp"}
    )
    assert diff == set()


def test_tables_are_kept_apart_and_absent_ones_left_out(spark):
    left = schema_rows(spark, {n: schema("a int, b int") for n in ("x", "y", "z")})
    right = schema_rows(spark, {"x": schema("a int, b int"), "y": schema("b int, a int")})
    rows = {(r.target_table, r.column_name) for r in schema_diff(left, right).collect()}
    assert rows == {("y", "A"), ("y", "B")}
    messages = {r.target_table: r for r in schema_messages(left, right).collect()}
    assert set(messages) == {"x", "y"}
    assert [c.name for c in messages["y"].actual_schema] == ["B", "A"]
    assert messages["y"].expected_schema[0].asDict() == {
        "name": "A", "data_type": "int", "nullable": True
    }


def test_validate_schemas_counts_rows(spark):
    contracts = [TableContract("t", (Column("a", "INTEGER"),)), TableContract("u", (Column("a", "INT"),))]
    found = validate_schemas(contracts, {"t": spark.range(3).toDF("a")}).collect()
    assert [tuple(r) for r in found] == [("t", ["A type expected int, found bigint"], 3)]


@pytest.mark.parametrize("ddl", ["`a.b` int, `c``d` string", "x array<struct<y:int>>"])
def test_awkward_columns_equal_themselves(spark, ddl):
    assert compared(spark, ddl, ddl) == (set(), [])
