"""Contracts for the test tables, used by the driver entry, the bench and the tests.

The declared types differ from the stored ones on purpose, so that schema comparison and
casting have something to find. Three views add what the tables lack: NULLs, broken
references and a key that refers to its own table.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

from pactframe import Column, Rule, TableContract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

VIEWS = {
    "event_refs": """
        select event_id, user_id,
               case when event_type = 'error' then null else value end as value,
               case when event_id % 10 = 0 then null
                    else user_id + case when event_id % 7 = 0 then 1000000 else 0 end
               end as fk_user
        from events""",
    "line_keys": """
        select l_orderkey,
               case when l_returnflag = 'A' and l_discount = 0 then null
                    else l_linenumber end as l_linenumber
        from lineitem""",
    "line_chain": """
        select l_orderkey, l_linenumber - 1 as previous_line from lineitem""",
}


def pk(*columns: str, name: str | None = None) -> Rule:
    return Rule("primary_key", columns, name)


def unique(*columns: str, name: str | None = None, origin: str = "constraint") -> Rule:
    return Rule("unique", columns, name, origin=origin)


def fk(columns: str, table: str, ref_columns: str = "", name: str | None = None) -> Rule:
    return Rule(
        "foreign_key", tuple(columns.split()), name, table.upper(), tuple(ref_columns.split())
    )


def check(expression: str, name: str | None = None) -> Rule:
    return Rule("check", name=name, expression=expression)


def table(name: str, columns: str, *rules: Rule) -> TableContract:
    """`columns` lists "name TYPE[!]" per line; `!` marks NOT NULL."""
    declared = []
    for line in columns.strip().splitlines():
        column, declared_type = line.strip().split(" ", 1)
        declared.append(
            Column(column, declared_type.rstrip("!"), nullable=not declared_type.endswith("!"))
        )
    return TableContract(name, tuple(declared), rules, source_schema="SHOP")


CONTRACTS = [
    table(
        "region",
        """r_regionkey INTEGER!
        r_name VARCHAR2(25)!""",
        pk("r_regionkey", name="region_pk"), unique("r_name"),
    ),
    table(
        "nation",
        """n_nationkey INTEGER!
        n_name VARCHAR2(25)!
        n_regionkey INTEGER""",
        pk("n_nationkey", name="nation_pk"), unique("n_name"),
        fk("n_regionkey", "region", name="nation_region_fk"),
    ),
    table(
        "customer",
        """c_custkey NUMBER(12)!
        c_name VARCHAR2(25)
        c_acctbal NUMBER(15,2)""",
        pk("c_custkey", name="customer_pk"), unique("c_name", name="customer_name_uk"),
        fk("c_nationkey", "nation", "n_nationkey", name="customer_nation_fk"),
        fk("c_custkey", "orders", "o_custkey", name="customer_has_order_fk"),
        check("c_acctbal >= 0", name="customer_solvent_ck"),
    ),
    table(
        "supplier",
        """s_suppkey NUMBER(12)!
        s_name VARCHAR2(25)
        s_nationkey INTEGER
        s_acctbal NUMBER(15,2)""",
        pk("s_suppkey"), fk("s_nationkey", "nation"),
    ),
    table(
        "part",
        """p_partkey NUMBER(12)!
        p_name VARCHAR2(55)
        p_brand CHAR(10)
        p_size INTEGER""",
        pk("p_partkey"), unique("p_name", name="part_name_ix", origin="index"),
    ),
    table(
        "orders",
        """o_orderkey NUMBER(12)!
        o_custkey NUMBER(12)
        o_orderstatus CHAR(1)
        o_totalprice NUMBER(15,2)
        o_orderdate DATE
        o_orderpriority VARCHAR2(15)""",
        pk("o_orderkey", name="orders_pk"),
        fk("o_custkey", "customer", "c_custkey", name="orders_customer_fk"),
        check("o_orderstatus in ('O', 'F', 'P')", name="orders_status_ck"),
    ),
    table(
        "lineitem",
        """l_orderkey NUMBER(12)!
        l_linenumber INTEGER!
        l_quantity NUMBER(15,2)
        l_discount NUMBER(15,2)
        l_shipdate DATE""",
        pk("l_orderkey", "l_linenumber", name="lineitem_pk"),
        fk("l_orderkey", "orders", "o_orderkey", name="lineitem_orders_fk"),
        fk("l_partkey", "part", "p_partkey", name="lineitem_part_fk"),
        fk("l_suppkey", "supplier", "s_suppkey", name="lineitem_supplier_fk"),
        check("l_discount <= 0.05", name="lineitem_discount_ck"),
        check("l_discount between 0 and 0.10 and l_quantity > 0", name="lineitem_range_ck"),
    ),
    table(
        "events",
        """event_id NUMBER(19)!
        ts TIMESTAMP(6)
        value BINARY_DOUBLE
        props CLOB""",
        pk("event_id"), unique("user_id", "ts", name="events_user_time_uk"),
        fk("user_id", "customer", "c_custkey", name="events_customer_fk"),
    ),
    table(
        "documents",
        """doc_id NUMBER(19)!
        text CLOB
        lang CHAR(2)""",
        pk("doc_id"), unique("text", name="documents_text_uk"),
        fk("doc_id", "labels", "doc_id", name="documents_labels_fk"),
    ),
    table(
        "embeddings",
        """vec_id NUMBER(19)!
        label INTEGER""",
        pk("vec_id"),
    ),
    table(
        "pages",
        """page_id NUMBER(19)!
        url VARCHAR2(2000)
        html CLOB""",
        pk("page_id"), unique("url", name="pages_url_uk"), check('"HTML" IS NOT NULL'),
    ),
    table(
        "benchmark",
        """item_id NUMBER(19)!
        text CLOB""",
        pk("item_id"), unique("text", name="benchmark_text_uk"),
    ),
    table(
        "labels",
        """doc_id NUMBER(19)!
        quality SMALLINT
        toxic SMALLINT""",
        pk("doc_id"), fk("doc_id", "documents", "doc_id", name="labels_documents_fk"),
        check("quality in (0, 1) and toxic in (0, 1)", name="labels_binary_ck"),
    ),
    table(
        "conversations",
        """conv_id NUMBER(19)!
        turn INTEGER!
        role VARCHAR2(20)
        text CLOB""",
        pk("conv_id", "turn", name="conversations_pk"),
    ),
    table(
        "event_refs",
        """event_id NUMBER(19)!
        user_id NUMBER(19)
        value BINARY_DOUBLE!
        fk_user NUMBER(19)""",
        pk("event_id"), fk("fk_user", "customer", name="event_refs_customer_fk"),
        check("value >= 5", name="event_refs_value_ck"),
    ),
    table(
        "line_keys",
        """l_orderkey NUMBER(12)!
        l_linenumber INTEGER""",
        pk("l_orderkey", "l_linenumber", name="line_keys_pk"),
        unique("l_linenumber", "l_orderkey", name="line_keys_uk"),
    ),
    table(
        "line_chain",
        """l_orderkey NUMBER(12)!
        previous_line INTEGER""",
        fk("l_orderkey previous_line", "lineitem", "l_orderkey l_linenumber", name="chain_fk"),
    ),
]
BY_NAME = {contract.target_name: contract for contract in CONTRACTS}


@cache
def fixture_lookup(spark: SparkSession, sf_dir: str):
    """Finds the test tables and views by name. Tables are opened once per session."""

    @cache
    def find(name: str) -> DataFrame | None:
        if name in TABLES:
            return spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name in VIEWS:
            sources = {t: find(t) for t in ("events", "lineitem") if t in VIEWS[name]}
            source, = sources
            return spark.sql(VIEWS[name].replace(f"from {source}", f"from {{{source}}}"), **sources)
        return None

    return find


def fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    find = fixture_lookup(spark, sf_dir)
    return {name: find(name) for name in [*TABLES, *VIEWS]}
