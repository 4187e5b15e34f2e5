"""Driver queries that write tables or run whole sections, each with the SQL it must equal."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import pactframe as pf
from fixture_contracts import BY_NAME, CONTRACTS, TABLES, VIEWS, fixture_lookup
from pactframe.operators import matching
from pactframe.operators.findings import union_all
from pactframe.operators.foreign_keys import ForeignKey, count_orphans_together, orphan_key_sizes
from pactframe.operators.matching import rows_with_keys
from pactframe.operators.keys import count_duplicates_together, key_sizes
from pactframe.scratch import scratch_path
from pactframe.sources.tables import read_contract_properties, write_contract_properties

Query = Callable[[SparkSession, str], DataFrame]


def fresh_store(spark: SparkSession, name: str) -> pf.TableStore:
    root = scratch_path(spark, name)
    return pf.TableStore(root, "parquet", f"{name}_{root[-32:]}")


def dropped(spark: SparkSession, store: pf.TableStore, result: DataFrame) -> DataFrame:
    """The result, a few rows, held by the driver, and the store's catalogue entries gone."""
    held = spark.createDataFrame(result.collect(), result.schema)
    spark.sql(f"DROP SCHEMA IF EXISTS {store.namespace} CASCADE")
    return held


def stored_contracts() -> tuple[list[pf.TableContract], dict[str, str]]:
    """The contracts of all stored tables, by the file names they have."""
    files = {name.upper(): f"{name}.parquet" for name in TABLES}
    found = [replace(c, target_name=files[c.source_name]) for c in CONTRACTS if c.source_name in files]
    return found, files


def plain_name() -> F.Column:
    return F.regexp_replace("target_table", r"\.parquet$", "").alias("target_table")


def run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of all stored tables, of one with a check that fails while it runs, one with rules
    that cannot be tested, one whose schema differs and one that is missing."""
    contracts, files = stored_contracts()
    store = pf.TableStore(sf_dir, "parquet", "shop", overrides=files)
    lax = pf.RunOptions(validate_schema=False)
    whole = pf.run(spark, "validate", contracts, store, lax).outcomes
    columns = (pf.Column("r_regionkey", "NUMBER(12)"), pf.Column("r_name", "VARCHAR2(30)"))
    odd = {
        "crashing": [pf.Rule("check", name="ck", expression="1 / (r_regionkey - r_regionkey) > 0")],
        "untestable": [pf.Rule("check", name="ck", expression="absent_column > 0")],
        "drifted": [],
    }
    parts = [whole.select(plain_name(), "row_count", "broken_rules", "outcome")]
    for name, rules in odd.items():
        contract = pf.TableContract("REGION", columns, tuple(rules), target_name="region.parquet")
        options = pf.RunOptions(validate_schema=name == "drifted")
        found = pf.run(spark, "validate", [contract], store, options).outcomes
        parts.append(found.select(F.lit(name).alias("target_table"), "row_count", "broken_rules", "outcome"))
    gone = pf.TableContract("GONE", columns)
    parts.append(pf.run(spark, "validate", [gone], store, lax).outcomes)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def load_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows seen by catalogue name and by path before and after each of two loads."""
    store, contract = fresh_store(spark, "loads"), BY_NAME["orders"]
    orders = fixture_lookup(spark, sf_dir)("orders")
    pf.run(spark, "create", [contract], store, pf.RunOptions(continue_on_error=False))
    steps = []
    for step in range(3):
        if step:
            pf.load_table(orders, contract, store, set_aside=())
        steps += [
            pf.read_table(spark, store, "orders", by_name=by_name)
            .agg(F.count("*").alias("n_rows"), F.count_distinct("o_orderkey").alias("n_keys"))
            .select(F.lit(step).alias("step"), F.lit(by_name).alias("by_name"), "n_rows", "n_keys")
            .collect()[0]
            for by_name in (True, False)
        ]
    out = spark.createDataFrame(steps, "step int, by_name boolean, n_rows long, n_keys long")
    return dropped(spark, store, out)


def loads_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in a table and set aside after a batch, the same again, and another one whose input is
    read once."""
    contract = pf.TableContract(
        "orders",
        (pf.Column("o_orderkey", "NUMBER(12)", nullable=False), pf.Column("o_totalprice", "NUMBER(7,2)")),
    )
    store = fresh_store(spark, "batches")
    aside = f"{store.root}/set_aside"
    orders = fixture_lookup(spark, sf_dir)("orders")
    pf.run(spark, "create", [contract], store, pf.RunOptions(continue_on_error=False))
    rows = []
    for step, (batch, once) in enumerate((("a", False), ("a", False), ("b", True))):
        result = pf.load_table(orders, contract, store, set_aside_path=aside, batch_id=batch, read_once=once)
        n = pf.read_table(spark, store, "orders").count()
        rows.append((step, batch, result.rows_read, result.rows_loaded, n, spark.read.parquet(aside).count()))
    out = spark.createDataFrame(
        rows, "step int, batch string, n_read long, n_loaded long, n_rows long, n_aside long"
    )
    return dropped(spark, store, out)


def create_register_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of a table with rows when it is created again in each mode."""
    store, contract = fresh_store(spark, "modes"), BY_NAME["customer"]
    customers = fixture_lookup(spark, sf_dir)("customer")
    pf.run(spark, "create", [contract], store, pf.RunOptions(continue_on_error=False))
    pf.load_table(customers, contract, store, set_aside=())
    rows = []
    for mode, loss in (("register", False), ("create", False), ("replace", False), ("replace", True)):
        try:
            state = pf.create_table(spark, store, contract, mode, allow_data_loss=loss)
        except Exception as error:
            state = type(error).__name__
        n = pf.read_table(spark, store, "customer", by_name=True).count()
        rows.append((mode, loss, state, n))
    out = spark.createDataFrame(rows, "mode string, allow_data_loss boolean, state string, n_rows long")
    return dropped(spark, store, out)


def contract_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The properties of a created and loaded table, read back from the catalogue."""
    store, contract = fresh_store(spark, "facts"), BY_NAME["customer"]
    pf.run(spark, "create", [contract], store, pf.RunOptions(write_properties=False))
    pf.load_table(fixture_lookup(spark, sf_dir)("customer"), contract, store, set_aside=())
    write_contract_properties(spark, store, contract)
    n = pf.read_table(spark, store, "customer", by_name=True).count()
    found = read_contract_properties(spark, store, "customer")
    rows = [(key, value, n) for key, value in found.items()]
    return dropped(spark, store, spark.createDataFrame(rows, "property string, value string, n_rows long"))


def run_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error records of a run over all sections: a table with rows that may not be replaced, and
    one whose name stands for another place."""
    store, contract = fresh_store(spark, "errors"), BY_NAME["nation"]
    pf.run(spark, "create", [contract], store)
    pf.load_table(fixture_lookup(spark, sf_dir)("nation"), contract, store, set_aside=())
    elsewhere = replace(store, root=f"{store.root}/elsewhere")
    found = []
    for place, options in ((store, pf.RunOptions(replace_existing=True)), (elsewhere, pf.RunOptions())):
        issues = pf.run(spark, "all", [contract], place, options).issues
        known = issues.where("issue_type IN ('create_error', 'validate_error')")
        found += known.select("issue_type", "target_table", "operation", "error_type").collect()
    n = pf.read_table(spark, store, "nation").count()
    rows = [(*row, n) for row in found]
    out = spark.createDataFrame(
        rows, "issue_type string, target_table string, operation string, error_type string, n_rows long"
    )
    return dropped(spark, store, out)


# Declared types for columns that rules name and contracts leave out.
DECLARED = {
    "bigint": "NUMBER(19)", "int": "INTEGER", "double": "BINARY_DOUBLE", "string": "CLOB", "timestamp_ntz": "TIMESTAMP(6)",
}


def complete(contract: pf.TableContract, df: DataFrame) -> pf.TableContract:
    """The contract with every column of `df`, so that a table made from it has those that its rules name."""
    declared = {column.name.lower() for column in contract.columns}
    more = [
        pf.Column(name, DECLARED[kind]) for name, kind in df.dtypes if name.lower() not in declared and kind in DECLARED
    ]
    return replace(contract, columns=(*contract.columns, *more))


def run_all_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table created from its contract and loaded, then `all` over them: the report, and what became
    of each table."""
    store, find = fresh_store(spark, "whole"), fixture_lookup(spark, sf_dir)
    contracts = [complete(c, find(c.target_name)) for c in CONTRACTS if c.source_name.lower() in TABLES]
    pf.run(spark, "create", contracts, store, pf.RunOptions(continue_on_error=False))
    for contract in contracts:
        pf.load_table(find(contract.target_name), contract, store, set_aside=())
    result = pf.run(spark, "all", contracts, store)
    states = spark.createDataFrame(list(result.created.items()), "target_table string, state string")
    rules = result.report.where("kind <> 'row_count'").select("target_table", "kind", "rule_name", "violations", "status")
    counts = result.outcomes.select("target_table", "row_count").join(states, "target_table")
    return dropped(spark, store, rules.join(counts, "target_table"))


def validate_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables loaded in two halves and validated after each; the second time only the new files are read."""
    names = ("region", "nation", "part", "supplier", "customer", "orders", "lineitem")
    store, find = fresh_store(spark, "steps"), fixture_lookup(spark, sf_dir)
    contracts = {name: complete(BY_NAME[name], find(name)) for name in names}
    pf.run(spark, "create", list(contracts.values()), store, pf.RunOptions(continue_on_error=False))
    reports = []
    for half in (0, 1):
        for name, contract in contracts.items():
            rows = find(name).where(f"pmod(xxhash64(*), 2) = {half}")
            pf.load_table(rows, contract, store, set_aside=())
        lookup = pf.table_lookup(spark, store)
        reports = [
            pf.validate_new_files(contracts[name], store, lookup, f"{store.root}/_state", contracts)
            for name in ("customer", "orders", "lineitem")
        ]
        done = union_all(reports).select("target_table", "kind", "rule_name", "violations", "table_rows").collect()
    columns = "target_table string, kind string, rule_name string, violations long, table_rows long"
    spark.sql(f"DROP SCHEMA {store.namespace} CASCADE")
    return spark.createDataFrame(done, columns)


def schema_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mismatch record of three tables: what was declared, what is stored, and the report's
    lines, without its head."""
    from pactframe.sources.reports import report_lines

    contracts, files = stored_contracts()
    chosen = [c for c in contracts if c.source_name in ("REGION", "NATION", "LABELS")]
    store = pf.TableStore(sf_dir, "parquet", "shop", overrides=files)
    issues = pf.run(spark, "validate", chosen, store).issues.where("issue_type = 'schema_mismatch'")
    lines = report_lines(issues).where("section <> '' AND value <> ''")
    counts = spark.read.parquet(f"{sf_dir}/nation.parquet").agg(F.count("*").alias("nations"))
    schemas = issues.select(
        "target_table",
        *(
            F.array_join(F.transform(name, lambda c: F.concat_ws(" ", c["name"], c["data_type"])), ", ").alias(name)
            for name in ("expected_schema", "actual_schema")
        ),
    )
    joined = lines.join(schemas, lines["section"] == schemas["target_table"])
    return joined.select(plain_name(), "line_no", "value", "expected_schema", "actual_schema").crossJoin(
        F.broadcast(counts)  # one row
    )


def parents_by_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreign keys to a parent with a name of its own, and to tables of one name in two schemas."""
    find = fixture_lookup(spark, sf_dir)
    key = pf.Column("c_custkey", "NUMBER(12)")
    half = find("customer").where("c_custkey % 2 = 0")
    contracts = [
        pf.TableContract("CUSTOMER", (key,), (), "EVEN", "dim_customer_even"),
        pf.TableContract("CUSTOMER", (key,), (), "FULL", "dim_customer"),
        pf.TableContract(
            "ORDERS", (pf.Column("o_custkey", "NUMBER(12)"),),
            (
                pf.Rule("foreign_key", ("o_custkey",), "to_even", "CUSTOMER", ("c_custkey",), ref_schema="EVEN"),
                pf.Rule("foreign_key", ("o_custkey",), "to_full", "CUSTOMER", ("c_custkey",), ref_schema="FULL"),
                pf.Rule("foreign_key", ("o_custkey",), "to_own", "CUSTOMER", ("c_custkey",)),
            ),
            "EVEN", "fact_orders",
        ),
    ]
    tables = {"dim_customer_even": half, "dim_customer": find("customer"), "fact_orders": find("orders")}
    report = pf.validate_tables(contracts, tables.get)
    return report.where("kind = 'foreign_key'").select("rule_name", "violations", "status")


def rows_in_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of repeated texts and orphan orders, with a bound so small that keys go in passes."""
    find = fixture_lookup(spark, sf_dir)
    documents, orders = find("documents"), find("orders")
    repeated = key_sizes(documents, ["text"]).selectExpr("*", "count > 1 AS wanted").where("wanted")
    size = matching.key_bytes(repeated.select("__k0")).first()["n_bytes"]
    texts = rows_with_keys(documents, repeated, ["text"], True, broadcast_bytes=max(1, size // 5))
    few = find("customer").where("c_custkey % 3 = 0")
    orphans = orphan_key_sizes(orders, few, ["o_custkey"], ["c_custkey"]).selectExpr("*", "true AS wanted")
    lost = rows_with_keys(orders, orphans, ["o_custkey"], broadcast_bytes=1, most_passes=0, hot_rows=50)
    return texts.selectExpr("'text' AS part", "doc_id AS id").unionAll(
        lost.selectExpr("'order' AS part", "o_orderkey AS id")
    )


def keys_in_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two and more keys of a table counted in one scan, with NULLs in some."""
    find = fixture_lookup(spark, sf_dir)
    keys = {
        "events": [["event_id"], ["user_id", "ts"], ["user_id", "event_type"]],
        "customer": [["c_custkey"], ["c_name"]],
        "event_refs": [["event_id"], ["fk_user"], ["fk_user", "value"], ["value"]],
        "line_keys": [["l_linenumber"], ["l_orderkey", "L_LINENUMBER"]],
    }
    parts = []
    for table, sets in keys.items():
        found = count_duplicates_together(find(table), sets)
        for place, key in enumerate(sets):
            parts.append(
                found.select(
                    F.lit(table).alias("target_table"), F.lit(",".join(key)).alias("key_columns"),
                    F.col(f"primary_groups{place}").alias("primary_groups"),
                    F.col(f"unique_groups{place}").alias("unique_groups"),
                )
            )
    return union_all(parts)


def orphans_in_one_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreign keys of one child to large parents, among them a parent of two keys and keys of
    two parts, counted with one scan of the child."""
    find = fixture_lookup(spark, sf_dir)
    asked = {
        "lineitem": [
            ("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"),
            ("l_suppkey", "supplier", "s_suppkey"), ("l_linenumber", "part", "p_partkey"),
            ("l_orderkey l_linenumber", "line_keys", "l_orderkey l_linenumber"),
        ],
        "event_refs": [("fk_user", "customer", "c_custkey"), ("user_id fk_user", "orders", "o_custkey o_orderkey")],
    }
    parts = []
    for table, links in asked.items():
        keys = []
        for columns, parent, ref_columns in links:
            rule = pf.Rule("foreign_key", tuple(columns.split()), None, parent, tuple(ref_columns.split()))
            keys.append((ForeignKey(rule, parent, rule.columns, rule.ref_columns), find(parent)))
        found = count_orphans_together(find(table), keys)
        for place, (key, _) in enumerate(keys):
            parts.append(
                found.select(
                    F.lit(table).alias("target_table"), F.lit(",".join(key.columns)).alias("key_columns"),
                    F.lit(key.parent_table).alias("parent_table"), F.col(f"orphans{place}").alias("orphan_rows"),
                )
            )
    return union_all(parts)


def rows_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of repeated texts, orphan orders and repeated line keys with NULLs, with no bytes to broadcast:
    found by key alone and fetched from their files."""
    find = fixture_lookup(spark, sf_dir)

    def repeated(df: DataFrame, names: list[str]) -> DataFrame:
        keys = key_sizes(df, names).selectExpr("*", "count > 1 AS wanted")
        return rows_with_keys(df, keys, names, True, hot_rows=3, broadcast_bytes=1, most_passes=0)

    documents, orders, lines = find("documents"), find("orders"), find("line_keys")
    few = find("customer").where("c_custkey % 3 = 0")
    orphans = orphan_key_sizes(orders, few, ["o_custkey"], ["c_custkey"]).selectExpr("*", "true AS wanted")
    lost = rows_with_keys(orders, orphans, ["o_custkey"], broadcast_bytes=1, most_passes=0, hot_rows=50)
    return union_all(
        [
            repeated(documents, ["text"]).selectExpr("'text' AS part", "doc_id AS id", "CAST(n_chars AS long) AS more"),
            lost.selectExpr("'order'", "o_orderkey", "o_custkey"),
            repeated(lines, ["l_orderkey", "l_linenumber"]).selectExpr("'line'", "l_orderkey", "CAST(l_linenumber AS long)"),
        ]
    )


def duplicates_in_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate keys of two stored copies of a table: one in the order of the key, whose files share no
    key and are not shuffled, and one in no order."""
    lines = fixture_lookup(spark, sf_dir)("line_keys")
    copies = {
        "sorted": lines.repartitionByRange(8, "l_orderkey").sortWithinPartitions("l_orderkey"),
        "shuffled": lines.repartition(8, F.xxhash64("l_orderkey", "l_linenumber")),
    }
    parts = []
    for name, rows in copies.items():
        path = scratch_path(spark, name)
        rows.write.parquet(path)
        for kind in ("primary_key", "unique"):
            found = pf.duplicate_keys(spark.read.parquet(path), ["l_orderkey", "l_linenumber"], kind, in_files=True)
            parts.append(found.select(F.lit(name).alias("copy"), F.lit(kind).alias("kind"), *found.columns))
    return union_all(parts)


def violating_rows_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pf.violating_rows(BY_NAME["lineitem"], fixture_lookup(spark, sf_dir), BY_NAME)
    return rows.select("kind", "rule_name", "l_orderkey", "l_linenumber")


def queries() -> dict[str, Query]:
    return {
        "run_outcomes": run_outcomes,
        "load_by_name": load_by_name,
        "loads_by_batch": loads_by_batch,
        "create_register_replace": create_register_replace,
        "contract_properties": contract_properties,
        "run_errors": run_errors,
        "run_all_stored": run_all_stored,
        "validate_in_steps": validate_in_steps,
        "schema_reports": schema_reports,
        "parents_by_contract": parents_by_contract,
        "rows_in_passes": rows_in_passes,
        "violating_rows_lineitem": violating_rows_lineitem,
        "keys_in_one_scan": keys_in_one_scan,
        "orphans_in_one_shuffle": orphans_in_one_shuffle,
        "duplicates_in_files": duplicates_in_files,
        "rows_by_place": rows_by_place,
    }


def _key_groups(table: str, key: str, present: str) -> str:
    return f"""
        SELECT '{table}' AS target_table, '{key}' AS key_columns, count(*) AS primary_groups,
            count(*) FILTER ({present}) AS unique_groups
        FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)"""


def _orphan_count(table: str, columns: str, parent: str, ref_columns: str) -> str:
    pairs = list(zip(columns.split(), ref_columns.split()))
    present = " AND ".join(f"c.{a} IS NOT NULL" for a, _ in pairs)
    same = " AND ".join(f"p.{b} = c.{a}" for a, b in pairs)
    return f"""
        SELECT '{table}' AS target_table, '{",".join(columns.split())}' AS key_columns, '{parent}' AS parent_table,
            count(*) AS orphan_rows
        FROM {table} c WHERE {present} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {same})"""


def _property_rows() -> str:
    """The facts of the customer contract, written out."""
    facts = {
        "source_schema": "SHOP",
        "source_table": "CUSTOMER",
        "primary_key": {"name": "customer_pk", "columns": ["c_custkey"]},
        "unique_keys": [{"name": "customer_name_uk", "columns": ["c_name"]}],
        "foreign_keys": [
            {"name": "customer_nation_fk", "columns": ["c_nationkey"], "ref_schema": None, "ref_table": "NATION", "ref_columns": ["n_nationkey"]},
            {"name": "customer_has_order_fk", "columns": ["c_custkey"], "ref_schema": None, "ref_table": "ORDERS", "ref_columns": ["o_custkey"]},
        ],
        "check_constraints": [{"name": "customer_solvent_ck", "expression": "c_acctbal >= 0"}],
        "not_null_columns": ["c_custkey"],
        "defaults": {},
        "unique_indexes": [],
    }
    texts = {k: v if isinstance(v, str) else json.dumps(v) for k, v in facts.items()}
    rows = ", ".join(f"('oracle.{k}', '{v}')" for k, v in texts.items())
    return f"SELECT property, value, (SELECT count(*) FROM customer) AS n_rows FROM (VALUES {rows}) p(property, value)"


def oracle_sql(outcomes: str, report: str, lineitem_rules: list[tuple[str, str, str]]) -> dict[str, str]:
    """`outcomes`, `report`: the SQL of queries `table_outcomes` and `constraint_report`; `lineitem_rules`: kind,
    name and rows."""
    views = "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in VIEWS.items())
    names = ", ".join(f"'{name}'" for name in TABLES)
    loads = " UNION ALL ".join(
        f"SELECT {step} AS step, {by_name} AS by_name, {step} * count(*) AS n_rows, "
        f"CASE WHEN {step} = 0 THEN 0 ELSE count(DISTINCT o_orderkey) END AS n_keys FROM orders"
        for step in range(3)
        for by_name in ("true", "false")
    )
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS target_table, count(*) AS row_count, 'registered' AS state FROM {name}"
        for name in TABLES
    )
    every = " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{name}' AS rule_name, l_orderkey, l_linenumber FROM ({rows})"
        for kind, name, rows in lineitem_rules
    )
    return {
        "run_outcomes": f"""
            SELECT target_table, row_count, broken_rules, outcome FROM ({outcomes}) WHERE target_table IN ({names})
            UNION ALL SELECT 'crashing', count(*), 0, 'error' FROM region
            UNION ALL SELECT 'untestable', count(*), 0, 'incomplete' FROM region
            UNION ALL SELECT 'drifted', count(*), 0, 'failed' FROM region
            UNION ALL SELECT 'gone', NULL, 0, 'error'""",
        "load_by_name": loads,
        "loads_by_batch": """
            SELECT step, batch, count(*) AS n_read, count(*) FILTER (fits) AS n_loaded, times * count(*) FILTER (fits) AS n_rows,
                times * count(*) FILTER (NOT fits) AS n_aside
            FROM (SELECT round(o_totalprice, 2) < 100000 AS fits FROM orders),
                (VALUES (0, 'a', 1), (1, 'a', 1), (2, 'b', 2)) b(step, batch, times)
            GROUP BY step, batch, times""",
        "create_register_replace": """
            SELECT 'register' AS mode, false AS allow_data_loss, 'registered' AS state, count(*) AS n_rows FROM customer
            UNION ALL SELECT 'create', false, 'AnalysisException', count(*) FROM customer
            UNION ALL SELECT 'replace', false, 'DataLossError', count(*) FROM customer
            UNION ALL SELECT 'replace', true, 'replaced', 0""",
        "contract_properties": _property_rows(),
        "run_errors": """
            SELECT 'create_error' AS issue_type, 'nation' AS target_table, 'create' AS operation, error_type,
                (SELECT count(*) FROM nation) AS n_rows
            FROM (VALUES ('DataLossError'), ('LocationError')) e(error_type)""",
        "run_all_stored": f"""
            SELECT r.*, 'tested' AS status, row_count, state FROM ({report}) r JOIN ({counts}) c USING (target_table)""",
        "validate_in_steps": f"""
            SELECT *, CAST(NULL AS BIGINT) AS table_rows FROM ({report}) WHERE target_table IN ('customer', 'orders', 'lineitem')
            UNION ALL SELECT target_table, 'row_count', 'row_count', 0, row_count FROM ({counts})
            WHERE target_table IN ('customer', 'orders', 'lineitem')""",
        "schema_reports": """
            SELECT 'labels' AS target_table, line_no, value, 'DOC_ID decimal(19,0), QUALITY int, TOXIC int' AS expected_schema,
                'DOC_ID bigint, QUALITY int, TOXIC int' AS actual_schema, (SELECT count(*) FROM nation) AS nations
            FROM (VALUES (0, 'shop.labels.parquet'), (1, '  - DOC_ID type expected decimal(19,0), found bigint')) v(line_no, value)""",
        "parents_by_contract": """
            SELECT rule_name, (SELECT count(*) FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS (
                SELECT 1 FROM customer WHERE c_custkey = o_custkey AND (rule_name = 'to_full' OR c_custkey % 2 = 0)
            )) AS violations, 'tested' AS status
            FROM (VALUES ('to_even'), ('to_full'), ('to_own')) r(rule_name)""",
        "rows_in_passes": """
            SELECT 'text' AS part, doc_id AS id FROM documents
            WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)
            UNION ALL SELECT 'order', o_orderkey FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS (
                SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 3 = 0)""",
        "violating_rows_lineitem": every,
        "keys_in_one_scan": views + " UNION ALL ".join(
            _key_groups(*entry)
            for entry in (
                ("events", "event_id", "event_id IS NOT NULL"),
                ("events", "user_id,ts", "user_id IS NOT NULL OR ts IS NOT NULL"),
                ("events", "user_id,event_type", "user_id IS NOT NULL OR event_type IS NOT NULL"),
                ("customer", "c_custkey", "c_custkey IS NOT NULL"),
                ("customer", "c_name", "c_name IS NOT NULL"),
                ("event_refs", "event_id", "event_id IS NOT NULL"),
                ("event_refs", "fk_user", "fk_user IS NOT NULL"),
                ("event_refs", "fk_user,value", "fk_user IS NOT NULL OR value IS NOT NULL"),
                ("event_refs", "value", "value IS NOT NULL"),
                ("line_keys", "l_linenumber", "l_linenumber IS NOT NULL"),
                ("line_keys", "l_orderkey,L_LINENUMBER", "l_orderkey IS NOT NULL OR l_linenumber IS NOT NULL"),
            )
        ),
        "rows_by_place": views + """
            SELECT 'text' AS part, doc_id AS id, n_chars AS more FROM documents
            WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)
            UNION ALL SELECT 'order', o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS (
                SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 3 = 0)
            UNION ALL SELECT 'line', l_orderkey, l_linenumber FROM (
                SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM line_keys) WHERE n > 1""",
        "duplicates_in_files": views + """
            SELECT copy, kind, l_orderkey, l_linenumber, count(*) AS n_rows
            FROM line_keys, (VALUES ('sorted'), ('shuffled')) c(copy), (VALUES ('primary_key'), ('unique')) k(kind)
            WHERE kind = 'primary_key' OR l_orderkey IS NOT NULL OR l_linenumber IS NOT NULL
            GROUP BY ALL HAVING count(*) > 1""",
        "orphans_in_one_shuffle": views + " UNION ALL ".join(
            _orphan_count(*entry)
            for entry in (
                ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
                ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("lineitem", "l_linenumber", "part", "p_partkey"),
                ("lineitem", "l_orderkey l_linenumber", "line_keys", "l_orderkey l_linenumber"),
                ("event_refs", "fk_user", "customer", "c_custkey"),
                ("event_refs", "user_id fk_user", "orders", "o_custkey o_orderkey"),
            )
        ),
    }
