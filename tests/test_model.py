import pytest
from pyspark.sql import types as T

from pactframe import Column, Rule, TableContract, contract_summary, from_tables, table_summary, to_tables
from pactframe import read_contracts, write_contracts
from pactframe.functions.names import quoted, sql_text, target_table_name
from pactframe.functions.types import is_wide_text, map_declared_type
from fixture_contracts import CONTRACTS

TYPES = {
    "VARCHAR(10)": "string", "VARCHAR2(20 BYTE)": "string", "NVARCHAR2(5)": "string",
    "CHAR(1)": "string", "NCHAR(2)": "string", "CLOB": "string", "NCLOB": "string",
    "LONG": "string", "LONG RAW": "string", "CHARACTER VARYING(10)": "string",
    "BLOB": "binary", "RAW(16)": "binary",
    "TIMESTAMP": "timestamp", "TIMESTAMP(6)": "timestamp",
    "timestamp(3) with local time zone": "timestamp",
    "DATE": "date",
    "BINARY_DOUBLE": "double", "BINARY_FLOAT": "double", "DOUBLE  PRECISION": "double",
    "FLOAT": "double", "FLOAT(126)": "double",
    "INTEGER": "int", "INT": "int", "SMALLINT": "int", "BIGINT": "bigint", "BOOLEAN": "boolean",
    "NUMBER": "decimal(38,10)", "NUMERIC": "decimal(38,10)", "DECIMAL": "decimal(38,10)",
    "NUMBER(9)": "decimal(9,0)", "NUMBER(*)": "decimal(38,0)", "NUMBER(*, 2)": "decimal(38,2)",
    "NUMBER (12 , 4)": "decimal(12,4)", "DECIMAL(0)": "decimal(1,0)",
    "NUMBER(50,2)": "decimal(38,2)", "NUMBER(5,-2)": "decimal(5,0)", "NUMBER(3,7)": "decimal(3,3)",
}
UNKNOWN = [
    "INTERVAL DAY TO SECOND", "XMLTYPE", "ROWID", "REAL", "DEC(5)", "BFILE", "DATE(1)",
    "NUMBER(1,2,3)", "INTEGER(4)", "NUMBER(5) X",
]


@pytest.mark.parametrize("declared,expected", TYPES.items())
def test_declared_types(declared, expected):
    mapped = map_declared_type(declared)
    assert (mapped.data_type.simpleString(), mapped.known) == (expected, True)


@pytest.mark.parametrize("declared", UNKNOWN)
def test_unknown_types_become_string_and_say_so(declared):
    assert map_declared_type(declared) == (T.StringType(), False)


def test_wide_text():
    assert is_wide_text("CLOB") and is_wide_text("VARCHAR2(4000 CHAR)") and is_wide_text("BLOB")
    assert not is_wide_text("CHAR(2)") and not is_wide_text("NUMBER(38)")
    assert not is_wide_text("XMLTYPE")


@pytest.mark.parametrize(
    "source,target",
    [
        ("CUSTOMER_MASTER", "customer_master"), (" a--b$$c ", "a_b_c"), ("9LIVES", "t_9lives"),
        ("__X__", "x"), ("Sales Order#1", "sales_order_1"),
    ],
)
def test_target_table_names(source, target):
    assert target_table_name(source) == target


def test_target_table_name_edges():
    assert target_table_name("T1", {"T1": "renamed"}) == "renamed"
    with pytest.raises(ValueError):
        target_table_name("$$$")


def test_quoting():
    assert quoted("a`b.c") == "`a``b.c`"
    assert sql_text("it's a \\ b") == "'it''s a \\\\ b'"


def test_contract_checks_itself():
    column = Column("a", "INTEGER")
    with pytest.raises(ValueError, match="no columns"):
        TableContract("t", ())
    with pytest.raises(ValueError, match="more than one primary key"):
        TableContract("t", (column,), (Rule("primary_key", ("a",)), Rule("primary_key", ("b",))))
    for bad in [
        dict(kind="index", columns=("a",)), dict(kind="check"), dict(kind="unique"),
        dict(kind="foreign_key", columns=("a",)),
    ]:
        with pytest.raises(ValueError):
            Rule(**bad)


def test_contract_derives_facts():
    contract = TableContract(
        "Big Table", (Column("a", "INTEGER", False), Column("b", "ROWID", default_expr="'x'")),
        source_schema="own",
    )
    assert (contract.source_schema, contract.source_name) == ("OWN", "BIG TABLE")
    assert contract.target_name == "big_table"
    assert contract.required == ("a",)
    assert contract.fill_expression("a") is None
    assert contract.fill_expression("b") == "'x'"
    assert contract.unknown_types == {"b": "ROWID"}
    assert contract.schema == T.StructType(
        [T.StructField("a", T.IntegerType(), False), T.StructField("b", T.StringType(), True)]
    )
    assert [c.name for c in contract.upper_cased().columns] == ["A", "B"]


def test_contracts_survive_their_tables(spark, tmp_path):
    by_name = {c.target_name: c for c in CONTRACTS}
    assert {c.target_name: c for c in from_tables(*to_tables(spark, CONTRACTS))} == by_name
    write_contracts(spark, CONTRACTS, str(tmp_path / "contracts"))
    assert {c.target_name: c for c in read_contracts(spark, str(tmp_path / "contracts"))} == by_name
    assert from_tables(*to_tables(spark, CONTRACTS), targets=["orders"]) == [by_name["orders"]]


def test_summaries(spark):
    tables = to_tables(spark, CONTRACTS)
    kinds = {(r.kind, r.origin): r.n for r in contract_summary(tables).collect()}
    assert kinds[("primary_key", "constraint")] == 16
    assert kinds[("unique", "index")] == 1
    orders = table_summary(tables).where("target_name = 'orders'").first()
    assert (orders.n_columns, orders.n_check, orders.n_unique) == (6, 1, 0)
    plain = TableContract("p", (Column("a", "INT"),))
    assert table_summary(to_tables(spark, [plain])).first().source_schema == "<default>"
