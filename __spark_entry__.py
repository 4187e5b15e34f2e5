"""

Every query runs over the whole of the tables it names. The SQL is written against the raw
tables alone; the three views of `fixture_contracts` are spelled out where it needs them.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import fixture_queries  # noqa: E402
import pactframe as pf  # noqa: E402
from fixture_contracts import (  # noqa: E402
    BY_NAME,
    CONTRACTS,
    TABLES,
    VIEWS,
    fixture_lookup,
    fixture_tables,
)
from pactframe.operators.foreign_keys import orphan_key_sizes  # noqa: E402
from pactframe.plans.issues import mismatch_issues, table_facts, violation_issues  # noqa: E402
from pactframe.plans.schemas import actual_rows, declared_rows, row_counts  # noqa: E402
from pactframe.scratch import scratch_path  # noqa: E402

try:  # the package of text operators may be absent
    from pactframe.llm import queries as text_operators
except ImportError as error:
    if not (error.name or "").startswith("pactframe.llm"):
        raise
    text_operators = None

Query = Callable[[SparkSession, str], DataFrame]
REPORT_COLUMNS = ["target_table", "kind", "rule_name", "violations"]


def entry(spark: SparkSession) -> DataFrame:
    """All rules of all contracts over the smallest tables: one row per rule."""
    return constraint_report(spark, "/root/testdata/sf0.001")


# --------------------------------------------------------------------------- queries


def full_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.validate_tables(CONTRACTS, fixture_lookup(spark, sf_dir))


def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_report(spark, sf_dir).where("kind <> 'row_count'").select(REPORT_COLUMNS)


def constraint_report_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table, limited to a slice of it that reaches the scan as a filter."""
    report = pf.validate_constraints(
        BY_NAME["lineitem"], fixture_lookup(spark, sf_dir), BY_NAME, where="l_returnflag = 'R'"
    )
    return report.where("kind <> 'row_count'").select(REPORT_COLUMNS)


def table_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.table_outcomes(full_report(spark, sf_dir))


def facts(spark: SparkSession) -> DataFrame:
    return table_facts(spark, CONTRACTS, pf.TableStore("/tables", "parquet", "shop"))


def violation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = violation_issues(full_report(spark, sf_dir), facts(spark))
    return issues.select(
        "issue_type", "source_schema", "source_table", "target_schema", "target_table",
        "target_path", "operation", "error_type", "error_message",
    )


def schema_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fixture_tables(spark, sf_dir)
    messages = pf.schema_messages(
        declared_rows(spark, CONTRACTS), actual_rows(spark, tables), check_nullability=False
    )
    return mismatch_issues(messages, facts(spark))


def issue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    violations = violation_issues(full_report(spark, sf_dir), facts(spark))
    return pf.issue_summary(violations.unionByName(schema_issues(spark, sf_dir)))


def issue_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    violations = violation_issues(full_report(spark, sf_dir), facts(spark))
    return pf.issue_lines(violations)


def contract_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules by kind, with the rows of the tables they cover."""
    contracts = pf.to_tables(spark, CONTRACTS)
    counts = row_counts(fixture_tables(spark, sf_dir))
    rules = contracts.rules.join(counts, contracts.rules.target_name == counts.target_table)
    rows = rules.groupBy("kind", "origin").agg(F.sum("row_count").alias("rows_covered"))
    return pf.contract_summary(contracts).join(rows, ["kind", "origin"])


def table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = row_counts(fixture_tables(spark, sf_dir))
    summary = pf.table_summary(pf.to_tables(spark, CONTRACTS))
    return summary.join(counts.withColumnRenamed("target_table", "target_name"), "target_name")


def contracts_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts stored as tables, read back, and used to count rows and violations."""
    path = scratch_path(spark, "contracts")
    pf.write_contracts(spark, CONTRACTS, path)
    report = pf.validate_tables(pf.read_contracts(spark, path), fixture_lookup(spark, sf_dir))
    return report.select("target_table", "kind", "rule_name", "violations", "table_rows")


def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: fixture_lookup(spark, sf_dir)(name) for name in TABLES}
    diff = pf.schema_diff(declared_rows(spark, CONTRACTS), actual_rows(spark, tables))
    return diff.where("issue <> 'order'").join(row_counts(tables), "target_table")


def schema_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixture_lookup(spark, sf_dir)("orders")
    columns = BY_NAME["orders"].columns
    declared = replace(BY_NAME["orders"], columns=(columns[2], *columns[:2], *columns[3:]))
    diff = pf.schema_diff(
        declared_rows(spark, [declared]), actual_rows(spark, {"orders": orders}), False
    )
    ranks = diff.where("issue = 'order'").select(
        "target_table", "column_name",
        F.col("expected").cast("int").alias("expected_rank"),
        F.col("actual").cast("int").alias("actual_rank"),
    )
    return ranks.join(row_counts({"orders": orders}), "target_table")


def validate_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All contracts against the stored tables and views, with a bigint taken for a decimal(12,0)."""
    found = pf.validate_schemas(
        CONTRACTS,
        fixture_tables(spark, sf_dir),
        check_nullability=False,
        type_equivalence={"bigint": "decimal(12,0)"},
    )
    return found.select("target_table", F.array_join("issues", "; ").alias("issues"), "row_count")


def violating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.violating_rows(BY_NAME["event_refs"], fixture_lookup(spark, sf_dir), BY_NAME)


def violating_rows_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pf.violating_rows(BY_NAME["line_keys"], fixture_lookup(spark, sf_dir), BY_NAME)
    return rows.select("kind", "rule_name", "l_orderkey", "l_linenumber")


def load_orders(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Load orders with a total too narrow for some of them; paths of what was kept and not."""
    contract = pf.TableContract(
        "orders",
        (
            pf.Column("o_orderkey", "NUMBER(12)", nullable=False),
            pf.Column("o_totalprice", "NUMBER(7,2)"),
            pf.Column("o_orderdate", "DATE"),
            pf.Column("o_channel", "VARCHAR2(10)", default_expr="'store'"),
        ),
    )
    store = fixture_queries.fresh_store(spark, "load")
    aside = f"{store.root}/set_aside"
    orders = fixture_lookup(spark, sf_dir)("orders")
    pf.run(spark, "create", [contract], store, pf.RunOptions(continue_on_error=False))
    pf.load_table(orders, contract, store, set_aside_path=aside)
    spark.sql(f"DROP SCHEMA {store.namespace} CASCADE")  # the files stay
    return store.path("orders"), aside


def load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(load_orders(spark, sf_dir)[0])


def load_set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = spark.read.parquet(load_orders(spark, sf_dir)[1])
    violation = F.explode("violations").alias("violation")
    return rejected.select("o_orderkey", "o_totalprice", violation).select(
        "o_orderkey", "o_totalprice", "violation.kind", "violation.rule_name"
    )


def conform_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    conformed = pf.conform(fixture_lookup(spark, sf_dir)("orders"), BY_NAME["orders"])
    return conformed.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = pf.TableContract("orders", (pf.Column("o_totalprice", "NUMBER(7,2)"),))
    rejects = pf.cast_rejects(fixture_lookup(spark, sf_dir)("orders"), narrow)
    return rejects.select(
        "o_orderkey", F.array_join("rejected_columns", ",").alias("rejected_columns")
    )


def conform_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = replace(
        BY_NAME["nation"],
        columns=(
            *BY_NAME["nation"].columns,
            pf.Column("n_status", "CHAR(1)", default_expr="'A'"),
            pf.Column("n_rank", "NUMBER(3)", default_expr="1 + 1"),
            pf.Column("n_note", "VARCHAR2(10)"),
        ),
    )
    return pf.conform(fixture_lookup(spark, sf_dir)("nation"), contract, fill_defaults=True)


def _on(table: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    """A query that applies an operator to one table or view."""
    return lambda spark, sf_dir: operator(fixture_lookup(spark, sf_dir)(table))


def _between(child: str, parent: str, operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """A query that applies an operator to a child and a parent table."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        find = fixture_lookup(spark, sf_dir)
        return operator(find(child), find(parent))

    return query


def minimum_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key and one foreign key of two tables, as a report."""
    wanted = {"lineitem": "lineitem_pk", "documents": "documents_labels_fk"}
    contracts = [
        replace(
            BY_NAME[name],
            columns=tuple(replace(column, nullable=True) for column in BY_NAME[name].columns),
            rules=tuple(rule for rule in BY_NAME[name].rules if rule.name == rule_name),
        )
        for name, rule_name in wanted.items()
    ]
    report = pf.validate_tables(contracts, fixture_lookup(spark, sf_dir))
    kinds = ["primary_key_duplicate", "foreign_key"]
    return report.where(report["kind"].isin(kinds)).select(REPORT_COLUMNS)


def run_validate(spark: SparkSession, sf_dir: str) -> pf.RunResult:
    """The validate section of a run over the stored tables as they are."""
    contracts, files = fixture_queries.stored_contracts()
    store = pf.TableStore(sf_dir, "parquet", "shop", overrides=files)
    return pf.run(spark, "validate", contracts, store)


def run_validate_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_validate(spark, sf_dir).outcomes


def run_validate_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.issue_summary(run_validate(spark, sf_dir).issues)


def run_create_load_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables created from their contracts, loaded, and validated as loaded."""
    customer = replace(
        BY_NAME["customer"],
        rules=tuple(rule for rule in BY_NAME["customer"].rules if rule.kind != "foreign_key"),
    )
    contracts = [customer, BY_NAME["orders"]]
    root = scratch_path(spark, "run")
    store = pf.TableStore(root, "parquet", f"run_{root[-32:]}")
    options = pf.RunOptions(continue_on_error=False)
    pf.run(spark, "create", contracts, store, options)
    find = fixture_lookup(spark, sf_dir)
    for contract in contracts:
        pf.load_table(find(contract.target_name), contract, store, set_aside=())
    result = pf.run(spark, "validate", contracts, store)
    spark.sql(f"DROP SCHEMA {store.namespace} CASCADE")
    return result.report.select(*REPORT_COLUMNS, "table_rows")


LINE_KEY = ["l_orderkey", "l_linenumber"]


def queries() -> dict[str, Query]:
    return contract_queries() | (text_operators.queries() if text_operators else {})


def contract_queries() -> dict[str, Query]:
    return fixture_queries.queries() | {
        "minimum_slice": minimum_slice,
        # counts over rows
        "row_count": lambda spark, sf_dir: row_counts(fixture_tables(spark, sf_dir)),
        "not_null_violations": _on(
            "event_refs", lambda df: pf.not_null_violations(df, ["event_id", "user_id", "value", "fk_user"])
        ),
        "null_key_rows": _on("line_keys", lambda df: pf.null_key_rows(df, LINE_KEY)),
        "check_violations": _on(
            "customer",
            lambda df: pf.check_violations(df, "c_acctbal >= 0").select("c_custkey", "c_acctbal"),
        ),
        "check_not_null": _on(
            "event_refs",
            lambda df: pf.check_violations(df, '"VALUE" IS NOT NULL').select("event_id", "user_id"),
        ),
        "check_null_passes": _on(
            "event_refs",
            lambda df: pf.row_count(pf.check_violations(df, "value >= 5")).withColumnRenamed(
                "row_count", "violating_rows"
            ),
        ),
        # keys
        "duplicate_keys": _on("lineitem", lambda df: pf.duplicate_keys(df, LINE_KEY)),
        "duplicate_key_groups": _on("lineitem", lambda df: pf.duplicate_key_groups(df, LINE_KEY)),
        "duplicate_keys_with_nulls": _on("line_keys", lambda df: pf.duplicate_keys(df, LINE_KEY)),
        "duplicate_key_groups_with_nulls": _on(
            "line_keys", lambda df: pf.duplicate_key_groups(df, LINE_KEY)
        ),
        "unique_duplicates": _on("part", lambda df: pf.duplicate_keys(df, ["p_name"], "unique")),
        "unique_duplicates_nullable": _on(
            "event_refs", lambda df: pf.duplicate_keys(df, ["fk_user"], "unique")
        ),
        "unique_duplicates_long_text": _on(
            "documents", lambda df: pf.duplicate_keys(df, ["text"], "unique", hash_first=True)
        ),
        "unique_groups_long_text": _on(
            "documents", lambda df: pf.duplicate_key_groups(df, ["text"], "unique", hash_first=True)
        ),
        "rows_with_duplicate_key": _on(
            "documents",
            lambda df: pf.rows_with_duplicate_key(df, ["text"], "unique").select("doc_id", "lang"),
        ),
        # foreign keys
        "fk_orphans": _between(
            "documents", "labels",
            lambda c, p: pf.fk_orphans(c, p, ["doc_id"], ["doc_id"]).select("doc_id"),
        ),
        "fk_orphans_by_key": _between(
            "documents", "labels",
            lambda c, p: pf.fk_orphans(c, p, ["doc_id"], ["doc_id"], small_parent=False).select("doc_id"),
        ),
        "fk_orphans_nullable": _between(
            "event_refs", "customer", lambda c, p: pf.orphan_rows(c, p, ["fk_user"], ["c_custkey"])
        ),
        "fk_orphans_composite_self": _between(
            "line_chain", "lineitem",
            lambda c, p: pf.orphan_rows(c, p, ["l_orderkey", "previous_line"], LINE_KEY),
        ),
        "fk_orphan_keys": _between(
            "event_refs", "customer",
            lambda c, p: orphan_key_sizes(c, p, ["fk_user"], ["c_custkey"]).toDF("fk_user", "n_rows"),
        ),
        # declared types
        "conform_orders": conform_orders,
        "cast_rejects": cast_rejects,
        "conform_defaults": conform_defaults,
        "load_table": load_table,
        "load_set_aside": load_set_aside,
        # schemas
        "schema_diff": schema_diff,
        "schema_order": schema_order,
        "validate_schema": validate_schema,
        # whole reports
        "constraint_report": constraint_report,
        "constraint_report_sliced": constraint_report_sliced,
        "table_outcomes": table_outcomes,
        "violation_messages": violation_messages,
        "violating_rows": violating_rows,
        "violating_rows_by_key": violating_rows_by_key,
        "contract_summary": contract_summary,
        "table_summary": table_summary,
        "contracts_round_trip": contracts_round_trip,
        "issue_summary": issue_summary,
        "issue_lines": issue_lines,
        # runs
        "run_validate_outcomes": run_validate_outcomes,
        "run_validate_issues": run_validate_issues,
        "run_create_load_validate": run_create_load_validate,
    }


# --------------------------------------------------------------------------- oracle SQL

# Where the stored tables differ from their contracts, with a bigint taken for a decimal(12,0).
SCHEMA_ISSUES = {
    "benchmark": ["ITEM_ID type expected decimal(19,0), found bigint"],
    "conversations": ["CONV_ID type expected decimal(19,0), found bigint", "TURN type expected int, found bigint"],
    "customer": ["extra columns: ['C_NATIONKEY', 'C_MKTSEGMENT']", "C_ACCTBAL type expected decimal(15,2), found double"],
    "documents": ["extra columns: ['SOURCE', 'N_CHARS']", "DOC_ID type expected decimal(19,0), found bigint"],
    "embeddings": ["extra columns: ['EMBEDDING']", "VEC_ID type expected decimal(19,0), found bigint"],
    "event_refs": [
        "EVENT_ID type expected decimal(19,0), found bigint", "USER_ID type expected decimal(19,0), found bigint",
        "FK_USER type expected decimal(19,0), found bigint",
    ],
    "events": [
        "extra columns: ['USER_ID', 'EVENT_TYPE']", "EVENT_ID type expected decimal(19,0), found bigint",
        "TS type expected timestamp, found timestamp_ntz",
    ],
    "labels": ["DOC_ID type expected decimal(19,0), found bigint"],
    "lineitem": [
        "extra columns: ['L_PARTKEY', 'L_SUPPKEY', 'L_EXTENDEDPRICE', 'L_TAX', 'L_RETURNFLAG', 'L_LINESTATUS']",
        "L_QUANTITY type expected decimal(15,2), found double", "L_DISCOUNT type expected decimal(15,2), found double",
        "L_SHIPDATE type expected date, found timestamp_ntz",
    ],
    "orders": [
        "O_TOTALPRICE type expected decimal(15,2), found double", "O_ORDERDATE type expected date, found timestamp_ntz",
    ],
    "pages": ["PAGE_ID type expected decimal(19,0), found bigint"],
    "part": ["extra columns: ['P_TYPE', 'P_RETAILPRICE']"],
    "supplier": ["S_ACCTBAL type expected decimal(15,2), found double"],
}
WITH_VIEWS = "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in VIEWS.items())


def _duplicates(table: str, key: str, where: str = "true") -> str:
    return (
        f"SELECT {key}, count(*) AS n_rows FROM {table} WHERE {where} "
        f"GROUP BY {key} HAVING count(*) > 1"
    )


def _orphans(child: str, parent: str, pairs: str) -> str:
    """Child rows without a parent; `pairs` lists "child_column=parent_column"."""
    columns = [pair.split("=") for pair in pairs.split()]
    present = " AND ".join(f"c.{left} IS NOT NULL" for left, _ in columns)
    same = " AND ".join(f"p.{right} = c.{left}" for left, right in columns)
    return (
        f"SELECT c.* FROM {child} c WHERE {present} "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {same})"
    )


def _count(rows: str) -> str:
    return f"(SELECT count(*) FROM ({rows}))"


def _where(table: str, condition: str) -> str:
    return f"SELECT * FROM {table} WHERE {condition}"


# Each rule of the fixture contracts: table, kind, rule name, the violating rows or groups in
# SQL, and the wording of its message around the number.
REPORT_RULES = [
    ("region", "not_null", "r_regionkey", _where("region", "r_regionkey IS NULL"), "", ""),
    ("region", "not_null", "r_name", _where("region", "r_name IS NULL"), "", ""),
    ("region", "primary_key_null", "region_pk", _where("region", "r_regionkey IS NULL"), "", ""),
    ("region", "primary_key_duplicate", "region_pk", _duplicates("region", "r_regionkey"), "", ""),
    ("region", "unique_duplicate", "r_name", _duplicates("region", "r_name"), "", ""),
    ("nation", "not_null", "n_nationkey", _where("nation", "n_nationkey IS NULL"), "", ""),
    ("nation", "not_null", "n_name", _where("nation", "n_name IS NULL"), "", ""),
    ("nation", "primary_key_null", "nation_pk", _where("nation", "n_nationkey IS NULL"), "", ""),
    ("nation", "primary_key_duplicate", "nation_pk", _duplicates("nation", "n_nationkey"), "", ""),
    ("nation", "unique_duplicate", "n_name", _duplicates("nation", "n_name"), "", ""),
    ("nation", "foreign_key", "nation_region_fk",
     _orphans("nation", "region", "n_regionkey=r_regionkey"), "", ""),
    ("customer", "not_null", "c_custkey", _where("customer", "c_custkey IS NULL"), "", ""),
    ("customer", "primary_key_null", "customer_pk", _where("customer", "c_custkey IS NULL"), "", ""),
    ("customer", "primary_key_duplicate", "customer_pk", _duplicates("customer", "c_custkey"), "", ""),
    ("customer", "check", "customer_solvent_ck", _where("customer", "NOT (c_acctbal >= 0)"),
     "check customer_solvent_ck has ", " violating rows"),
    ("customer", "unique_duplicate", "customer_name_uk", _duplicates("customer", "c_name"), "", ""),
    ("customer", "foreign_key", "customer_nation_fk",
     _orphans("customer", "nation", "c_nationkey=n_nationkey"), "", ""),
    ("customer", "foreign_key", "customer_has_order_fk",
     _orphans("customer", "orders", "c_custkey=o_custkey"),
     "foreign key customer_has_order_fk has ", " orphan rows"),
    ("supplier", "not_null", "s_suppkey", _where("supplier", "s_suppkey IS NULL"), "", ""),
    ("supplier", "primary_key_null", "s_suppkey", _where("supplier", "s_suppkey IS NULL"), "", ""),
    ("supplier", "primary_key_duplicate", "s_suppkey", _duplicates("supplier", "s_suppkey"), "", ""),
    ("supplier", "foreign_key", "s_nationkey",
     _orphans("supplier", "nation", "s_nationkey=n_nationkey"), "", ""),
    ("part", "not_null", "p_partkey", _where("part", "p_partkey IS NULL"), "", ""),
    ("part", "primary_key_null", "p_partkey", _where("part", "p_partkey IS NULL"), "", ""),
    ("part", "primary_key_duplicate", "p_partkey", _duplicates("part", "p_partkey"), "", ""),
    ("part", "unique_duplicate", "part_name_ix", _duplicates("part", "p_name"),
     "unique key ['p_name'] has ", " duplicate key groups"),
    ("orders", "not_null", "o_orderkey", _where("orders", "o_orderkey IS NULL"), "", ""),
    ("orders", "primary_key_null", "orders_pk", _where("orders", "o_orderkey IS NULL"), "", ""),
    ("orders", "primary_key_duplicate", "orders_pk", _duplicates("orders", "o_orderkey"), "", ""),
    ("orders", "check", "orders_status_ck",
     _where("orders", "NOT (o_orderstatus IN ('O', 'F', 'P'))"), "", ""),
    ("orders", "foreign_key", "orders_customer_fk",
     _orphans("orders", "customer", "o_custkey=c_custkey"), "", ""),
    ("lineitem", "not_null", "l_orderkey", _where("lineitem", "l_orderkey IS NULL"), "", ""),
    ("lineitem", "not_null", "l_linenumber", _where("lineitem", "l_linenumber IS NULL"), "", ""),
    ("lineitem", "primary_key_null", "lineitem_pk",
     _where("lineitem", "l_orderkey IS NULL OR l_linenumber IS NULL"), "", ""),
    ("lineitem", "primary_key_duplicate", "lineitem_pk",
     _duplicates("lineitem", "l_orderkey, l_linenumber"),
     "primary key ['l_orderkey', 'l_linenumber'] has ", " duplicate key groups"),
    ("lineitem", "check", "lineitem_discount_ck", _where("lineitem", "NOT (l_discount <= 0.05)"),
     "check lineitem_discount_ck has ", " violating rows"),
    ("lineitem", "check", "lineitem_range_ck",
     _where("lineitem", "NOT (l_discount BETWEEN 0 AND 0.10 AND l_quantity > 0)"), "", ""),
    ("lineitem", "foreign_key", "lineitem_orders_fk",
     _orphans("lineitem", "orders", "l_orderkey=o_orderkey"), "", ""),
    ("lineitem", "foreign_key", "lineitem_part_fk",
     _orphans("lineitem", "part", "l_partkey=p_partkey"), "", ""),
    ("lineitem", "foreign_key", "lineitem_supplier_fk",
     _orphans("lineitem", "supplier", "l_suppkey=s_suppkey"), "", ""),
    ("events", "not_null", "event_id", _where("events", "event_id IS NULL"), "", ""),
    ("events", "primary_key_null", "event_id", _where("events", "event_id IS NULL"), "", ""),
    ("events", "primary_key_duplicate", "event_id", _duplicates("events", "event_id"), "", ""),
    ("events", "unique_duplicate", "events_user_time_uk", _duplicates("events", "user_id, ts"), "", ""),
    ("events", "foreign_key", "events_customer_fk",
     _orphans("events", "customer", "user_id=c_custkey"), "", ""),
    ("documents", "not_null", "doc_id", _where("documents", "doc_id IS NULL"), "", ""),
    ("documents", "primary_key_null", "doc_id", _where("documents", "doc_id IS NULL"), "", ""),
    ("documents", "primary_key_duplicate", "doc_id", _duplicates("documents", "doc_id"), "", ""),
    ("documents", "unique_duplicate", "documents_text_uk", _duplicates("documents", "text"),
     "unique key ['text'] has ", " duplicate key groups"),
    ("documents", "foreign_key", "documents_labels_fk",
     _orphans("documents", "labels", "doc_id=doc_id"),
     "foreign key documents_labels_fk has ", " orphan rows"),
    ("embeddings", "not_null", "vec_id", _where("embeddings", "vec_id IS NULL"), "", ""),
    ("embeddings", "primary_key_null", "vec_id", _where("embeddings", "vec_id IS NULL"), "", ""),
    ("embeddings", "primary_key_duplicate", "vec_id", _duplicates("embeddings", "vec_id"), "", ""),
    ("pages", "not_null", "page_id", _where("pages", "page_id IS NULL"), "", ""),
    ("pages", "primary_key_null", "page_id", _where("pages", "page_id IS NULL"), "", ""),
    ("pages", "primary_key_duplicate", "page_id", _duplicates("pages", "page_id"), "", ""),
    ("pages", "check", '"HTML" IS NOT NULL', _where("pages", "html IS NULL"), "", ""),
    ("pages", "unique_duplicate", "pages_url_uk", _duplicates("pages", "url"), "", ""),
    ("benchmark", "not_null", "item_id", _where("benchmark", "item_id IS NULL"), "", ""),
    ("benchmark", "primary_key_null", "item_id", _where("benchmark", "item_id IS NULL"), "", ""),
    ("benchmark", "primary_key_duplicate", "item_id", _duplicates("benchmark", "item_id"), "", ""),
    ("benchmark", "unique_duplicate", "benchmark_text_uk", _duplicates("benchmark", "text"), "", ""),
    ("labels", "not_null", "doc_id", _where("labels", "doc_id IS NULL"), "", ""),
    ("labels", "primary_key_null", "doc_id", _where("labels", "doc_id IS NULL"), "", ""),
    ("labels", "primary_key_duplicate", "doc_id", _duplicates("labels", "doc_id"), "", ""),
    ("labels", "check", "labels_binary_ck",
     _where("labels", "NOT (quality IN (0, 1) AND toxic IN (0, 1))"), "", ""),
    ("labels", "foreign_key", "labels_documents_fk",
     _orphans("labels", "documents", "doc_id=doc_id"), "", ""),
    ("conversations", "not_null", "conv_id", _where("conversations", "conv_id IS NULL"), "", ""),
    ("conversations", "not_null", "turn", _where("conversations", "turn IS NULL"), "", ""),
    ("conversations", "primary_key_null", "conversations_pk",
     _where("conversations", "conv_id IS NULL OR turn IS NULL"), "", ""),
    ("conversations", "primary_key_duplicate", "conversations_pk",
     _duplicates("conversations", "conv_id, turn"), "", ""),
    ("event_refs", "not_null", "event_id", _where("event_refs", "event_id IS NULL"), "", ""),
    ("event_refs", "not_null", "value", _where("event_refs", "value IS NULL"),
     "value has ", " NULL rows"),
    ("event_refs", "primary_key_null", "event_id", _where("event_refs", "event_id IS NULL"), "", ""),
    ("event_refs", "primary_key_duplicate", "event_id", _duplicates("event_refs", "event_id"), "", ""),
    ("event_refs", "check", "event_refs_value_ck", _where("event_refs", "NOT (value >= 5)"),
     "check event_refs_value_ck has ", " violating rows"),
    ("event_refs", "foreign_key", "event_refs_customer_fk",
     _orphans("event_refs", "customer", "fk_user=c_custkey"),
     "foreign key event_refs_customer_fk has ", " orphan rows"),
    ("line_keys", "not_null", "l_orderkey", _where("line_keys", "l_orderkey IS NULL"), "", ""),
    ("line_keys", "primary_key_null", "line_keys_pk",
     _where("line_keys", "l_orderkey IS NULL OR l_linenumber IS NULL"),
     "primary key ['l_orderkey', 'l_linenumber'] has ", " rows with NULL key parts"),
    ("line_keys", "primary_key_duplicate", "line_keys_pk",
     _duplicates("line_keys", "l_orderkey, l_linenumber"),
     "primary key ['l_orderkey', 'l_linenumber'] has ", " duplicate key groups"),
    ("line_keys", "unique_duplicate", "line_keys_uk",
     _duplicates("line_keys", "l_linenumber, l_orderkey"),
     "unique key ['l_linenumber', 'l_orderkey'] has ", " duplicate key groups"),
    ("line_chain", "not_null", "l_orderkey", _where("line_chain", "l_orderkey IS NULL"), "", ""),
    ("line_chain", "foreign_key", "chain_fk",
     _orphans("line_chain", "lineitem", "l_orderkey=l_orderkey previous_line=l_linenumber"),
     "foreign key chain_fk has ", " orphan rows"),
]


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _report_rows(rules: list[tuple]) -> str:
    return " UNION ALL ".join(
        f"SELECT {_text(table)} AS target_table, {_text(kind)} AS kind, "
        f"{_text(name)} AS rule_name, {_count(rows)} AS violations, "
        f"{_text(before)} AS before_n, {_text(after)} AS after_n, {place} AS place"
        for place, (table, kind, name, rows, before, after) in enumerate(rules)
    )


REPORT = f"{WITH_VIEWS}, report AS ({_report_rows(REPORT_RULES)})"


def _row_counts(names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS target_table, count(*) AS row_count FROM {name}" for name in names
    )


TABLE_COUNTS = _row_counts(TABLES)
ROW_COUNTS = _row_counts([*TABLES, *VIEWS])
VIOLATION_TEXTS = """
    SELECT target_table,
           target_table || ' constraint validation failed: '
           || string_agg(before_n || violations || after_n, '; ' ORDER BY place) AS error_message
    FROM report WHERE violations > 0 GROUP BY target_table"""

STORED_RUN = f"({', '.join(repr(name) for name in TABLES)})"
# The stored tables whose declared types are the stored ones; the others differ on purpose.
ALIKE = "('region', 'nation')"

# Declared and stored columns as the schema oracles see them: table, column, type, position.
DECLARED = """
    ('region', 'R_REGIONKEY', 'int', true), ('region', 'R_NAME', 'string', true),
    ('nation', 'N_NATIONKEY', 'int', true), ('nation', 'N_NAME', 'string', true),
    ('nation', 'N_REGIONKEY', 'int', false),
    ('customer', 'C_CUSTKEY', 'decimal(12,0)', true), ('customer', 'C_NAME', 'string', false),
    ('customer', 'C_ACCTBAL', 'decimal(15,2)', false),
    ('supplier', 'S_SUPPKEY', 'decimal(12,0)', true), ('supplier', 'S_NAME', 'string', false),
    ('supplier', 'S_NATIONKEY', 'int', false), ('supplier', 'S_ACCTBAL', 'decimal(15,2)', false),
    ('part', 'P_PARTKEY', 'decimal(12,0)', true), ('part', 'P_NAME', 'string', false),
    ('part', 'P_BRAND', 'string', false), ('part', 'P_SIZE', 'int', false),
    ('orders', 'O_ORDERKEY', 'decimal(12,0)', true), ('orders', 'O_CUSTKEY', 'decimal(12,0)', false),
    ('orders', 'O_ORDERSTATUS', 'string', false), ('orders', 'O_TOTALPRICE', 'decimal(15,2)', false),
    ('orders', 'O_ORDERDATE', 'date', false), ('orders', 'O_ORDERPRIORITY', 'string', false),
    ('lineitem', 'L_ORDERKEY', 'decimal(12,0)', true), ('lineitem', 'L_LINENUMBER', 'int', true),
    ('lineitem', 'L_QUANTITY', 'decimal(15,2)', false), ('lineitem', 'L_DISCOUNT', 'decimal(15,2)', false),
    ('lineitem', 'L_SHIPDATE', 'date', false),
    ('events', 'EVENT_ID', 'decimal(19,0)', true), ('events', 'TS', 'timestamp', false),
    ('events', 'VALUE', 'double', false), ('events', 'PROPS', 'string', false),
    ('documents', 'DOC_ID', 'decimal(19,0)', true), ('documents', 'TEXT', 'string', false),
    ('documents', 'LANG', 'string', false),
    ('embeddings', 'VEC_ID', 'decimal(19,0)', true), ('embeddings', 'LABEL', 'int', false),
    ('pages', 'PAGE_ID', 'decimal(19,0)', true), ('pages', 'URL', 'string', false),
    ('pages', 'HTML', 'string', false),
    ('benchmark', 'ITEM_ID', 'decimal(19,0)', true), ('benchmark', 'TEXT', 'string', false),
    ('labels', 'DOC_ID', 'decimal(19,0)', true), ('labels', 'QUALITY', 'int', false),
    ('labels', 'TOXIC', 'int', false),
    ('conversations', 'CONV_ID', 'decimal(19,0)', true), ('conversations', 'TURN', 'int', true),
    ('conversations', 'ROLE', 'string', false), ('conversations', 'TEXT', 'string', false)"""
STORED = """
    ('region', 'R_REGIONKEY', 'int'), ('region', 'R_NAME', 'string'),
    ('nation', 'N_NATIONKEY', 'int'), ('nation', 'N_NAME', 'string'), ('nation', 'N_REGIONKEY', 'int'),
    ('customer', 'C_CUSTKEY', 'bigint'), ('customer', 'C_NAME', 'string'),
    ('customer', 'C_NATIONKEY', 'int'), ('customer', 'C_ACCTBAL', 'double'),
    ('customer', 'C_MKTSEGMENT', 'string'),
    ('supplier', 'S_SUPPKEY', 'bigint'), ('supplier', 'S_NAME', 'string'),
    ('supplier', 'S_NATIONKEY', 'int'), ('supplier', 'S_ACCTBAL', 'double'),
    ('part', 'P_PARTKEY', 'bigint'), ('part', 'P_NAME', 'string'), ('part', 'P_BRAND', 'string'),
    ('part', 'P_TYPE', 'string'), ('part', 'P_SIZE', 'int'), ('part', 'P_RETAILPRICE', 'double'),
    ('orders', 'O_ORDERKEY', 'bigint'), ('orders', 'O_CUSTKEY', 'bigint'),
    ('orders', 'O_ORDERSTATUS', 'string'), ('orders', 'O_TOTALPRICE', 'double'),
    ('orders', 'O_ORDERDATE', 'timestamp_ntz'), ('orders', 'O_ORDERPRIORITY', 'string'),
    ('lineitem', 'L_ORDERKEY', 'bigint'), ('lineitem', 'L_PARTKEY', 'bigint'),
    ('lineitem', 'L_SUPPKEY', 'bigint'), ('lineitem', 'L_LINENUMBER', 'int'),
    ('lineitem', 'L_QUANTITY', 'double'), ('lineitem', 'L_EXTENDEDPRICE', 'double'),
    ('lineitem', 'L_DISCOUNT', 'double'), ('lineitem', 'L_TAX', 'double'),
    ('lineitem', 'L_RETURNFLAG', 'string'), ('lineitem', 'L_LINESTATUS', 'string'),
    ('lineitem', 'L_SHIPDATE', 'timestamp_ntz'),
    ('events', 'EVENT_ID', 'bigint'), ('events', 'TS', 'timestamp_ntz'), ('events', 'USER_ID', 'bigint'),
    ('events', 'EVENT_TYPE', 'string'), ('events', 'VALUE', 'double'), ('events', 'PROPS', 'string'),
    ('documents', 'DOC_ID', 'bigint'), ('documents', 'TEXT', 'string'), ('documents', 'LANG', 'string'),
    ('documents', 'SOURCE', 'string'), ('documents', 'N_CHARS', 'bigint'),
    ('embeddings', 'VEC_ID', 'bigint'), ('embeddings', 'EMBEDDING', 'array<float>'),
    ('embeddings', 'LABEL', 'int'),
    ('pages', 'PAGE_ID', 'bigint'), ('pages', 'URL', 'string'), ('pages', 'HTML', 'string'),
    ('benchmark', 'ITEM_ID', 'bigint'), ('benchmark', 'TEXT', 'string'),
    ('labels', 'DOC_ID', 'bigint'), ('labels', 'QUALITY', 'int'), ('labels', 'TOXIC', 'int'),
    ('conversations', 'CONV_ID', 'bigint'), ('conversations', 'TURN', 'bigint'),
    ('conversations', 'ROLE', 'string'), ('conversations', 'TEXT', 'string')"""


def oracle_sql() -> dict[str, str]:
    return contract_sql() | (text_operators.oracle_sql() if text_operators else {})


def contract_sql() -> dict[str, str]:
    slice_of = [
        (table, kind, name, rows.replace(" lineitem ", " slice "), before, after)
        for table, kind, name, rows, before, after in REPORT_RULES
        if table == "lineitem"
    ]
    loaded_rules = [
        (table, kind, name, re.sub(r" (customer|orders) ", r" \1_loaded ", rows), before, after)
        for table, kind, name, rows, before, after in REPORT_RULES
        if table in ("customer", "orders") and (table, kind) != ("customer", "foreign_key")
    ]
    # region and nation are declared as they are stored; every other table declares a number
    # that is stored as bigint or double.
    drifted = [name for name in [*TABLES, *VIEWS] if name not in ("region", "nation")]
    found = {
        "minimum_slice": f"""
            SELECT 'lineitem' AS target_table, 'primary_key_duplicate' AS kind,
                   'lineitem_pk' AS rule_name,
                   {_count(_duplicates("lineitem", "l_orderkey, l_linenumber"))} AS violations
            UNION ALL
            SELECT 'documents', 'foreign_key', 'documents_labels_fk',
                   {_count(_orphans("documents", "labels", "doc_id=doc_id"))}""",
        "row_count": f"{WITH_VIEWS} {ROW_COUNTS}",
        "not_null_violations": f"""{WITH_VIEWS}
            SELECT * FROM (
                SELECT 'event_id' AS column_name,
                       count(*) FILTER (WHERE event_id IS NULL) AS null_rows FROM event_refs
                UNION ALL
                SELECT 'user_id', count(*) FILTER (WHERE user_id IS NULL) FROM event_refs
                UNION ALL
                SELECT 'value', count(*) FILTER (WHERE value IS NULL) FROM event_refs
                UNION ALL
                SELECT 'fk_user', count(*) FILTER (WHERE fk_user IS NULL) FROM event_refs)
            WHERE null_rows > 0""",
        "null_key_rows": f"""{WITH_VIEWS}
            SELECT count(*) AS null_key_rows FROM line_keys
            WHERE l_orderkey IS NULL OR l_linenumber IS NULL""",
        "check_violations": """
            SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal >= 0)""",
        "check_not_null": f"""{WITH_VIEWS}
            SELECT event_id, user_id FROM event_refs WHERE value IS NULL""",
        "check_null_passes": f"""{WITH_VIEWS}
            SELECT count(*) AS violating_rows FROM event_refs WHERE NOT (value >= 5)""",
        "duplicate_keys": _duplicates("lineitem", "l_orderkey, l_linenumber"),
        "duplicate_key_groups": f"""
            SELECT {_count(_duplicates("lineitem", "l_orderkey, l_linenumber"))} AS dup_groups""",
        "duplicate_keys_with_nulls": (
            f"{WITH_VIEWS} {_duplicates('line_keys', 'l_orderkey, l_linenumber')}"
        ),
        "duplicate_key_groups_with_nulls": f"""{WITH_VIEWS}
            SELECT {_count(_duplicates("line_keys", "l_orderkey, l_linenumber"))} AS dup_groups""",
        "unique_duplicates": _duplicates("part", "p_name", "p_name IS NOT NULL"),
        "unique_duplicates_nullable": (
            f"{WITH_VIEWS} {_duplicates('event_refs', 'fk_user', 'fk_user IS NOT NULL')}"
        ),
        "unique_duplicates_long_text": _duplicates("documents", "text", "text IS NOT NULL"),
        "unique_groups_long_text": f"""
            SELECT {_count(_duplicates("documents", "text", "text IS NOT NULL"))} AS dup_groups""",
        "rows_with_duplicate_key": """
            SELECT doc_id, lang FROM documents
            WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)""",
        "fk_orphans": f"SELECT doc_id FROM ({_orphans('documents', 'labels', 'doc_id=doc_id')})",
        "fk_orphans_by_key": (
            f"SELECT doc_id FROM ({_orphans('documents', 'labels', 'doc_id=doc_id')})"
        ),
        "fk_orphans_nullable": f"""{WITH_VIEWS}
            SELECT {_count(_orphans("event_refs", "customer", "fk_user=c_custkey"))} AS orphan_rows""",
        "fk_orphans_composite_self": f"""{WITH_VIEWS}
            SELECT {_count(_orphans("line_chain", "lineitem",
                                    "l_orderkey=l_orderkey previous_line=l_linenumber"))}
                   AS orphan_rows""",
        "fk_orphan_keys": f"""{WITH_VIEWS}
            SELECT fk_user, count(*) AS n_rows
            FROM ({_orphans("event_refs", "customer", "fk_user=c_custkey")}) GROUP BY fk_user""",
        "conform_orders": """
            SELECT CAST(o_orderkey AS DECIMAL(12,0)) AS o_orderkey,
                   CAST(o_custkey AS DECIMAL(12,0)) AS o_custkey,
                   CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
                   CAST(o_orderdate AS DATE) AS o_orderdate
            FROM orders""",
        "cast_rejects": """
            SELECT o_orderkey, 'o_totalprice' AS rejected_columns FROM orders
            WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL""",
        "conform_defaults": """
            SELECT n_nationkey, n_name, n_regionkey, 'A' AS n_status,
                   CAST(2 AS DECIMAL(3,0)) AS n_rank, CAST(NULL AS VARCHAR) AS n_note
            FROM nation""",
        "load_table": """
            SELECT CAST(o_orderkey AS DECIMAL(12,0)) AS o_orderkey,
                   TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS o_totalprice,
                   CAST(o_orderdate AS DATE) AS o_orderdate, 'store' AS o_channel
            FROM orders WHERE TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NOT NULL""",
        "load_set_aside": """
            SELECT o_orderkey, o_totalprice, 'cast' AS kind, 'o_totalprice' AS rule_name
            FROM orders WHERE TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL""",
        "schema_diff": f"""
            WITH e(target_table, column_name, data_type, required) AS (VALUES {DECLARED}),
                 a(target_table, column_name, data_type) AS (VALUES {STORED}),
                 n AS ({TABLE_COUNTS}),
                 d AS (
                     SELECT target_table, column_name, 'missing' AS issue,
                            e.data_type AS expected, NULL AS actual
                     FROM e ANTI JOIN a USING (target_table, column_name)
                     UNION ALL
                     SELECT target_table, column_name, 'extra', NULL, a.data_type
                     FROM a ANTI JOIN e USING (target_table, column_name)
                     UNION ALL
                     SELECT target_table, column_name, 'type', e.data_type, a.data_type
                     FROM e JOIN a USING (target_table, column_name)
                     WHERE e.data_type <> a.data_type
                     UNION ALL
                     SELECT target_table, column_name, 'nullability', 'false', 'true'
                     FROM e JOIN a USING (target_table, column_name) WHERE e.required)
            SELECT target_table, column_name, issue, expected, actual, row_count
            FROM d JOIN n USING (target_table)""",
        "schema_order": """
            WITH e(column_name, place) AS (VALUES
                     ('O_ORDERSTATUS', 1), ('O_ORDERKEY', 2), ('O_CUSTKEY', 3),
                     ('O_TOTALPRICE', 4), ('O_ORDERDATE', 5), ('O_ORDERPRIORITY', 6)),
                 a(column_name, place) AS (VALUES
                     ('O_ORDERKEY', 1), ('O_CUSTKEY', 2), ('O_ORDERSTATUS', 3),
                     ('O_TOTALPRICE', 4), ('O_ORDERDATE', 5), ('O_ORDERPRIORITY', 6)),
                 r AS (
                     SELECT column_name,
                            CAST(row_number() OVER (ORDER BY e.place) AS INTEGER) AS expected_rank,
                            CAST(row_number() OVER (ORDER BY a.place) AS INTEGER) AS actual_rank
                     FROM e JOIN a USING (column_name))
            SELECT 'orders' AS target_table, column_name, expected_rank, actual_rank,
                   (SELECT count(*) FROM orders) AS row_count
            FROM r WHERE expected_rank <> actual_rank""",
        "validate_schema": WITH_VIEWS + " " + " UNION ALL ".join(
            f"SELECT '{name}' AS target_table, '{'; '.join(SCHEMA_ISSUES.get(name, [])).replace(chr(39), chr(39) * 2)}' AS issues, "
            f"(SELECT count(*) FROM {name}) AS row_count"
            for name in [*TABLES, *VIEWS]
        ),
        "constraint_report": f"""{REPORT}
            SELECT target_table, kind, rule_name, violations FROM report""",
        "constraint_report_sliced": f"""
            WITH slice AS (SELECT * FROM lineitem WHERE l_returnflag = 'R'),
                 report AS ({_report_rows(slice_of)})
            SELECT target_table, kind, rule_name, violations FROM report""",
        "table_outcomes": f"""{REPORT}, counts AS ({ROW_COUNTS})
            SELECT target_table, row_count,
                   count(*) FILTER (WHERE violations > 0) AS broken_rules,
                   CASE WHEN row_count = 0 THEN 'skipped'
                        WHEN count(*) FILTER (WHERE violations > 0) > 0 THEN 'failed'
                        ELSE 'passed' END AS outcome
            FROM report JOIN counts USING (target_table) GROUP BY target_table, row_count""",
        "violation_messages": f"""{REPORT}
            SELECT 'validate_error' AS issue_type, 'SHOP' AS source_schema,
                   upper(target_table) AS source_table, 'shop' AS target_schema, target_table,
                   '/tables/' || target_table AS target_path, 'validate' AS operation,
                   'ContractViolation' AS error_type, error_message
            FROM ({VIOLATION_TEXTS})""",
        "issue_summary": f"""{REPORT}
            SELECT 'validate_error' AS issue_type, target_table, CAST(1 AS BIGINT) AS n
            FROM ({VIOLATION_TEXTS})
            UNION ALL
            SELECT 'schema_mismatch', t, CAST(1 AS BIGINT)
            FROM (VALUES {", ".join(f"('{name}')" for name in drifted)}) v(t)""",
        "issue_lines": f"""{REPORT}
            SELECT 'validate_error' AS issue_type, 'shop' AS target_schema, target_table,
                   'ContractViolation: ' || error_message AS detail
            FROM ({VIOLATION_TEXTS})""",
        "run_validate_outcomes": f"""{REPORT}, counts AS ({ROW_COUNTS})
            SELECT target_table || '.parquet' AS target_table, row_count,
                   count(*) FILTER (WHERE violations > 0) AS broken_rules,
                   CASE WHEN target_table NOT IN {ALIKE} THEN 'failed'
                        WHEN row_count = 0 THEN 'skipped'
                        WHEN count(*) FILTER (WHERE violations > 0) > 0 THEN 'failed'
                        ELSE 'passed' END AS outcome
            FROM report JOIN counts USING (target_table) WHERE target_table IN {STORED_RUN}
            GROUP BY target_table, row_count""",
        "run_validate_issues": f"""{REPORT}
            SELECT 'validate_error' AS issue_type, target_table || '.parquet' AS target_table,
                   CAST(1 AS BIGINT) AS n
            FROM ({VIOLATION_TEXTS}) WHERE target_table IN {STORED_RUN}
            UNION ALL
            SELECT 'schema_mismatch', t || '.parquet', CAST(1 AS BIGINT)
            FROM (SELECT unnest([{STORED_RUN[1:-1]}]) AS t) WHERE t NOT IN {ALIKE}""",
        "run_create_load_validate": f"""
            WITH customer_loaded AS (
                     SELECT CAST(c_custkey AS DECIMAL(12,0)) AS c_custkey, c_name,
                            CAST(c_acctbal AS DECIMAL(15,2)) AS c_acctbal FROM customer),
                 orders_loaded AS (
                     SELECT CAST(o_orderkey AS DECIMAL(12,0)) AS o_orderkey,
                            CAST(o_custkey AS DECIMAL(12,0)) AS o_custkey, o_orderstatus
                     FROM orders),
                 report AS ({_report_rows(loaded_rules)})
            SELECT target_table, kind, rule_name, violations, CAST(NULL AS BIGINT) AS table_rows
            FROM report
            UNION ALL
            SELECT 'customer', 'row_count', 'row_count', 0, (SELECT count(*) FROM customer)
            UNION ALL
            SELECT 'orders', 'row_count', 'row_count', 0, (SELECT count(*) FROM orders)""",
        "violating_rows": f"""{WITH_VIEWS}
            SELECT 'not_null' AS kind, 'value' AS rule_name, event_id, user_id, value, fk_user
            FROM event_refs WHERE value IS NULL
            UNION ALL
            SELECT 'check', 'event_refs_value_ck', event_id, user_id, value, fk_user
            FROM event_refs WHERE NOT (value >= 5)
            UNION ALL
            SELECT 'foreign_key', 'event_refs_customer_fk', event_id, user_id, value, fk_user
            FROM ({_orphans("event_refs", "customer", "fk_user=c_custkey")})""",
        "violating_rows_by_key": f"""{WITH_VIEWS},
            sized AS (
                SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM line_keys)
            SELECT 'primary_key_null' AS kind, 'line_keys_pk' AS rule_name, l_orderkey, l_linenumber
            FROM sized WHERE l_linenumber IS NULL
            UNION ALL
            SELECT 'primary_key_duplicate', 'line_keys_pk', l_orderkey, l_linenumber
            FROM sized WHERE n > 1
            UNION ALL
            SELECT 'unique_duplicate', 'line_keys_uk', l_orderkey, l_linenumber
            FROM sized WHERE n > 1""",
        "contract_summary": f"""{WITH_VIEWS}, counts AS ({ROW_COUNTS}),
            rules(target_table, kind, origin, n) AS (VALUES {RULE_COUNTS})
            SELECT kind, origin, CAST(sum(n) AS BIGINT) AS n,
                   CAST(sum(n * row_count) AS BIGINT) AS rows_covered
            FROM rules JOIN counts USING (target_table) GROUP BY kind, origin""",
        "table_summary": f"""{WITH_VIEWS}, counts AS ({ROW_COUNTS}),
            facts(target_name, n_columns, n_primary_key, n_unique, n_foreign_key, n_check)
                AS (VALUES {TABLE_FACTS})
            SELECT target_name, 'SHOP' AS source_schema, upper(target_name) AS source_name,
                   CAST(n_columns AS BIGINT) AS n_columns,
                   CAST(n_primary_key AS BIGINT) AS n_primary_key,
                   CAST(n_unique AS BIGINT) AS n_unique,
                   CAST(n_foreign_key AS BIGINT) AS n_foreign_key,
                   CAST(n_check AS BIGINT) AS n_check, row_count
            FROM facts JOIN counts ON target_table = target_name""",
        "contracts_round_trip": f"""{REPORT}, counts AS ({ROW_COUNTS})
            SELECT target_table, kind, rule_name, violations, CAST(NULL AS BIGINT) AS table_rows FROM report
            UNION ALL SELECT target_table, 'row_count', 'row_count', 0, row_count FROM counts""",
    }
    lineitem = [(kind, name, rows) for table, kind, name, rows, *_ in REPORT_RULES if table == "lineitem"]
    lineitem = [
        (kind, name, rows)
        if kind != "primary_key_duplicate"
        else (kind, name, "SELECT * FROM lineitem WHERE (l_orderkey, l_linenumber) IN "
              f"(SELECT (l_orderkey, l_linenumber) FROM ({rows}))")
        for kind, name, rows in lineitem
    ]
    return found | fixture_queries.oracle_sql(
        found["table_outcomes"], found["constraint_report"], lineitem
    )


# Rules per table, kind and origin, and columns and rules per table, in the fixture contracts.
RULE_COUNTS = """
    ('region', 'primary_key', 'constraint', 1), ('region', 'unique', 'constraint', 1),
    ('nation', 'primary_key', 'constraint', 1), ('nation', 'unique', 'constraint', 1),
    ('nation', 'foreign_key', 'constraint', 1),
    ('customer', 'primary_key', 'constraint', 1), ('customer', 'unique', 'constraint', 1),
    ('customer', 'foreign_key', 'constraint', 2), ('customer', 'check', 'constraint', 1),
    ('supplier', 'primary_key', 'constraint', 1), ('supplier', 'foreign_key', 'constraint', 1),
    ('part', 'primary_key', 'constraint', 1), ('part', 'unique', 'index', 1),
    ('orders', 'primary_key', 'constraint', 1), ('orders', 'foreign_key', 'constraint', 1),
    ('orders', 'check', 'constraint', 1),
    ('lineitem', 'primary_key', 'constraint', 1), ('lineitem', 'foreign_key', 'constraint', 3),
    ('lineitem', 'check', 'constraint', 2),
    ('events', 'primary_key', 'constraint', 1), ('events', 'unique', 'constraint', 1),
    ('events', 'foreign_key', 'constraint', 1),
    ('documents', 'primary_key', 'constraint', 1), ('documents', 'unique', 'constraint', 1),
    ('documents', 'foreign_key', 'constraint', 1),
    ('embeddings', 'primary_key', 'constraint', 1),
    ('pages', 'primary_key', 'constraint', 1), ('pages', 'unique', 'constraint', 1),
    ('pages', 'check', 'constraint', 1),
    ('benchmark', 'primary_key', 'constraint', 1), ('benchmark', 'unique', 'constraint', 1),
    ('labels', 'primary_key', 'constraint', 1), ('labels', 'foreign_key', 'constraint', 1),
    ('labels', 'check', 'constraint', 1),
    ('conversations', 'primary_key', 'constraint', 1),
    ('event_refs', 'primary_key', 'constraint', 1), ('event_refs', 'foreign_key', 'constraint', 1),
    ('event_refs', 'check', 'constraint', 1),
    ('line_keys', 'primary_key', 'constraint', 1), ('line_keys', 'unique', 'constraint', 1),
    ('line_chain', 'foreign_key', 'constraint', 1)"""
TABLE_FACTS = """
    ('region', 2, 1, 1, 0, 0), ('nation', 3, 1, 1, 1, 0), ('customer', 3, 1, 1, 2, 1),
    ('supplier', 4, 1, 0, 1, 0), ('part', 4, 1, 1, 0, 0), ('orders', 6, 1, 0, 1, 1),
    ('lineitem', 5, 1, 0, 3, 2), ('events', 4, 1, 1, 1, 0), ('documents', 3, 1, 1, 1, 0),
    ('embeddings', 2, 1, 0, 0, 0), ('pages', 3, 1, 1, 0, 1), ('benchmark', 2, 1, 1, 0, 0),
    ('labels', 3, 1, 0, 1, 1), ('conversations', 4, 1, 0, 0, 0), ('event_refs', 4, 1, 0, 1, 1),
    ('line_keys', 2, 1, 1, 0, 0), ('line_chain', 2, 0, 0, 1, 0)"""
