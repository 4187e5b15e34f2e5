from decimal import Decimal

import pytest

from pactframe import Column, TableContract, cast_rejects, conform
from pactframe.operators.conform import IllegalCast, illegal_casts, stage
from pactframe.operators.rows import violation_tags


def declared(*columns):
    return TableContract("t", tuple(Column(*column) for column in columns))


def test_conform_orders_casts_and_fills(spark):
    df = spark.createDataFrame([("1.239", 7, "x"), (None, 8, "y")], "price string, id bigint, extra string")
    c = declared(
        ("ID", "INTEGER"), ("PRICE", "NUMBER(5,2)"), ("STATE", "CHAR(1)", True, "'N'"),
        ("NOTE", "VARCHAR2(9)"),
    )
    out = conform(df, c, fill_defaults=True)
    assert out.columns == ["ID", "PRICE", "STATE", "NOTE"]
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "decimal(5,2)", "string", "string"]
    assert [tuple(r) for r in out.collect()] == [(7, Decimal("1.24"), "N", None), (8, None, "N", None)]
    assert conform(df, c).first().STATE is None


def test_explicit_null_keeps_no_default(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert conform(df, declared(("s", "CHAR(1)", True, "'N'")), fill_defaults=True).first().s is None


def test_rejects_name_the_columns_that_do_not_fit(spark):
    df = spark.createDataFrame(
        [("12", "1"), ("x", "1"), ("x", "1000"), (None, None)], "a string, `b.c` string"
    )
    c = declared(("a", "INTEGER"), ("b.c", "NUMBER(2)"))
    found = {(r.a, r["b.c"]): r.rejected_columns for r in cast_rejects(df, c).collect()}
    assert found == {("x", "1"): ["a"], ("x", "1000"): ["a", "b.c"]}


def test_loss_of_digits_still_fits(spark):
    df = spark.createDataFrame([(1.9, 1.256)], "a double, b double")
    c = declared(("a", "INTEGER"), ("b", "NUMBER(5,2)"))
    assert cast_rejects(df, c).count() == 0
    assert tuple(conform(df, c).first()) == (1, Decimal("1.26"))


def test_illegal_pairs_are_found_by_analysis(spark):
    df = spark.createDataFrame([([1], 1)], "a array<int>, b int")
    c = declared(("a", "INTEGER"), ("b", "NUMBER(5)"))
    assert list(illegal_casts(df, c)) == ["a"]
    with pytest.raises(IllegalCast, match="a"):
        conform(df, c)


def test_stage_tags_casts_and_rules_in_one_pass(spark):
    df = spark.createDataFrame([("x",), ("5",), (None,)], "a string")
    c = TableContract("t", (Column("a", "INTEGER", nullable=False),))
    staged = stage(df, c)
    tagged = staged.rows.select("__raw0", violation_tags(staged.tests).alias("tags")).collect()
    tags = {r["__raw0"]: [tuple(t) for t in r.tags] for r in tagged}
    assert tags == {
        "x": [("cast", "a"), ("not_null", "a")], "5": [], None: [("not_null", "a")]
    }


EDGES = [0, 1, -1, 9, 99, 100, 999, 1000, 2**31 - 1, 2**31, -(2**31), -(2**31) - 1, 2**63 - 1, -(2**63)]
SOURCES = {
    "bigint": [str(n) for n in EDGES],
    "double": [repr(n + d) for n in map(float, EDGES) for d in (0.0, 0.4, 0.5, -0.5, 0.994, 0.995)]
    + ["double('NaN')", "double('Infinity')", "-double('Infinity')", "1e300", "9.3e18", "99.995", "99.9949999"],
    "float": ["99.995", "100.0", "2147483520", "2147483648", "-2147483648", "-2147483904", "3e9", "1e30"],
    "decimal(20,3)": [f"{n}.{d}" for n in EDGES if abs(n) < 10**16 for d in ("0", "4", "5", "994", "995")],
}


@pytest.mark.parametrize("source", SOURCES)
def test_range_guard_equals_try_cast(spark, source):
    values = ", ".join(f"(CAST({v} AS {source}))" for v in SOURCES[source])
    df = spark.sql(f"SELECT * FROM VALUES {values}, (NULL) AS t(x)")
    targets = [
        "NUMBER(2)", "NUMBER(4,2)", "NUMBER(5,2)", "NUMBER(10)", "NUMBER(19)", "NUMBER(38)",
        "NUMBER(38,10)", "NUMBER", "INTEGER", "BIGINT", "BINARY_DOUBLE", "VARCHAR2(40)",
    ]
    for target in targets:
        c = declared(("x", target))
        wanted = c.schema.fields[0].dataType.simpleString()
        plain = df.selectExpr(f"try_cast(x AS {wanted}) AS x").collect()
        assert str(conform(df, c).collect()) == str(plain)
