from datetime import datetime, timezone

import pytest

from pactframe import Column, Rule, RunOptions, TableContract, TableStore, issue_lines, issue_summary, run
from pactframe.plans.run import ContractViolation, SchemaMismatch
from pactframe.sources.reports import report_lines
from pactframe.sources.tables import read_contract_properties

PARENT = TableContract(
    "PARENT", (Column("K", "INTEGER", False),), (Rule("primary_key", ("K",), "PARENT_PK"),), "OWN"
)
CHILD = TableContract(
    "CHILD",
    (Column("ID", "INTEGER", False), Column("K", "INTEGER"), Column("NOTE", "XMLTYPE")),
    (
        Rule("primary_key", ("ID",), "CHILD_PK"), Rule("foreign_key", ("K",), "CHILD_FK", "PARENT"),
        Rule("check", name="CHILD_CK", expression="K > 0"),
        Rule("check", name="BAD_CK", expression="ZZ > 0"),
    ),
    "OWN",
)


@pytest.fixture
def store(spark, tmp_path, request):
    name = "r_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    yield TableStore(str(tmp_path / "tables"), "parquet", name)
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def put(spark, store, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(store.path(name))


def kinds(result):
    return {(r.issue_type, r.target_table): r.n for r in issue_summary(result.issues).collect()}


def test_parse_only_summarises(spark, store):
    result = run(spark, " PARSE ", [PARENT, CHILD], store)
    assert result.summary.count() == 2
    assert kinds(result) == {("type_fallback", "child"): 1}
    with pytest.raises(ValueError, match="section"):
        run(spark, "drop", [PARENT], store)


def test_all_on_an_empty_store(spark, store, tmp_path):
    options = RunOptions(report_path=str(tmp_path / "report"), issues_path=str(tmp_path / "issues"))
    result = run(spark, "all", [PARENT, CHILD], store, options)
    assert result.created == {"parent": "created", "child": "created"}
    assert {(r.target_table, r.outcome) for r in result.outcomes.collect()} == {
        ("parent", "skipped"), ("child", "incomplete")  # a check of child cannot be tested
    }
    assert kinds(result) == {("type_fallback", "child"): 1, ("check_skipped", "child"): 1}
    assert read_contract_properties(spark, store, "child")["oracle.source_table"] == "CHILD"
    assert not (tmp_path / "report").exists()  # no mismatches, no report
    assert spark.read.parquet(str(tmp_path / "issues")).count() == 2


def test_validate_reports_violations_and_goes_on(spark, store):
    put(spark, store, "parent", [(1,), (1,)], "K int")
    put(spark, store, "child", [(1, 1, ""), (1, -2, ""), (None, None, "")], "ID int, K int, NOTE string")
    result = run(spark, "validate", [PARENT, CHILD], store)
    errors = {r.target_table: r for r in result.issues.where("issue_type = 'validate_error'").collect()}
    assert errors["parent"].error_message == (
        "parent constraint validation failed: primary key ['K'] has 1 duplicate key groups"
    )
    assert errors["child"].error_message == (
        "child constraint validation failed: ID has 1 NULL rows; "
        "primary key ['ID'] has 1 rows with NULL key parts; "
        "primary key ['ID'] has 1 duplicate key groups; "
        "check CHILD_CK has 1 violating rows; foreign key CHILD_FK has 1 orphan rows"
    )
    child = errors["child"]
    assert (child.source_schema, child.source_table, child.target_path) == (
        "OWN", "CHILD", store.path("child")
    )
    assert child.operation == "validate" and child.logged_at_utc is not None
    with pytest.raises(ContractViolation, match="child constraint"):
        run(spark, "validate", [PARENT, CHILD], store, RunOptions(continue_on_error=False))


def test_missing_tables_are_errors(spark, store):
    result = run(spark, "validate", [PARENT], store)
    assert kinds(result) == {("validate_error", "parent"): 1}
    assert [(r.kind, r.status) for r in result.report.collect()] == [("row_count", "error")]
    assert [(r.target_table, r.outcome) for r in result.outcomes.collect()] == [("parent", "error")]
    with pytest.raises(LookupError):
        run(spark, "validate", [PARENT], store, RunOptions(continue_on_error=False))


def test_drift_is_logged_once_and_rules_still_run(spark, store, tmp_path):
    put(spark, store, "parent", [(1,), (1,)], "K bigint")
    options = RunOptions(report_path=str(tmp_path / "report"))
    result = run(spark, "all", [PARENT], store, options)
    assert kinds(result) == {("schema_mismatch", "parent"): 1, ("validate_error", "parent"): 1}
    mismatch = result.issues.where("issue_type = 'schema_mismatch'").first()
    assert mismatch.issues == ["K type expected int, found bigint"]
    assert mismatch.expected_schema[0].data_type == "int"
    assert mismatch.actual_schema[0].asDict() == {"name": "K", "data_type": "bigint", "nullable": True}
    assert read_contract_properties(spark, store, "parent") == {}
    lines = (tmp_path / "report").glob("part-*")
    text = [line for part in lines for line in part.read_text().splitlines()]
    assert text[0].startswith("Schema mismatch report - generated ")
    assert text[1:] == [
        "=" * 72, "", f"{store.schema_name}.parent", "  - K type expected int, found bigint", ""
    ]


def test_drift_as_a_warning_or_a_failure(spark, store):
    put(spark, store, "parent", [(1,)], "K bigint")
    run(spark, "create", [PARENT], store, RunOptions(fail_on_mismatch=False))
    assert read_contract_properties(spark, store, "parent")["oracle.source_table"] == "PARENT"
    with pytest.raises(SchemaMismatch, match="parent schema mismatch: K type"):
        run(spark, "create", [PARENT], store, RunOptions(continue_on_error=False))


def test_nullability_is_compared_on_request(spark, store):
    put(spark, store, "parent", [(1,)], "K int")
    assert kinds(run(spark, "validate", [PARENT], store)) == {}
    strict = run(spark, "validate", [PARENT], store, RunOptions(check_nullability=True))
    assert strict.issues.first().issues == ["K expected NOT NULL but catalog is nullable"]


def test_replace_needs_leave_to_drop_rows(spark, store):
    put(spark, store, "parent", [(1,)], "K int")
    kept = run(spark, "create", [PARENT], store, RunOptions(replace_existing=True))
    assert kinds(kept) == {("create_error", "parent"): 1}
    assert kept.issues.first().error_type == "DataLossError"
    done = run(spark, "create", [PARENT], store, RunOptions(replace_existing=True, allow_data_loss=True))
    assert done.created == {"parent": "replaced"}


def test_a_check_failing_at_run_time_costs_only_itself(spark, store):
    put(spark, store, "parent", [(1,), (0,)], "K int")
    checks = (
        Rule("check", name="DIV", expression="10 / K > 0"), Rule("check", name="POS", expression="K > 0")
    )
    contract = TableContract("PARENT", PARENT.columns, (*PARENT.rules, *checks), "OWN")
    put(spark, store, "other", [(None,)], "K int")
    other = TableContract("OTHER", PARENT.columns, PARENT.rules)
    result = run(spark, "validate", [contract, other], store)
    found = {(r.target_table, r.kind, r.rule_name): r.violations for r in result.report.collect()}
    assert found[("parent", "check", "DIV")] is None
    assert found[("parent", "check", "POS")] == 1
    assert found[("other", "not_null", "K")] == 1
    assert kinds(result)[("check_error", "parent")] == 1
    assert {r.target_table: r.outcome for r in result.outcomes.collect()} == {
        "parent": "failed", "other": "failed"
    }
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        run(spark, "validate", [contract], store, RunOptions(continue_on_error=False))


def test_many_tables_in_many_jobs(spark, store):
    contracts = []
    for i in range(7):
        put(spark, store, f"t{i}", [(j % (i + 1),) for j in range(4)], "K int")
        contracts.append(TableContract(f"T{i}", PARENT.columns, PARENT.rules))
    result = run(spark, "validate", contracts, store, RunOptions(tables_per_job=2, jobs_at_once=3))
    found = result.report.where("kind = 'primary_key_duplicate'").collect()
    assert {r.target_table: r.violations for r in found} == {
        "t0": 1, "t1": 2, "t2": 1, "t3": 0, "t4": 0, "t5": 0, "t6": 0
    }


def test_slices_and_switches(spark, store):
    put(spark, store, "parent", [(1,), (1,), (2,)], "K int")
    sliced = run(spark, "validate", [PARENT], store, RunOptions(where={"parent": "K = 2"}))
    assert sliced.outcomes.first().outcome == "passed"
    off = run(spark, "validate", [PARENT], store, RunOptions(validate_constraints=False))
    assert off.report.count() == 0


def test_issue_lines(spark, store):
    put(spark, store, "parent", [(1,), (1,)], "K bigint")
    result = run(spark, "validate", [PARENT], store)
    details = sorted(r.detail for r in issue_lines(result.issues).collect())
    assert details == [
        "ContractViolation: parent constraint validation failed: "
        "primary key ['K'] has 1 duplicate key groups",
        "K type expected int, found bigint",
    ]
    stamp = datetime(2030, 1, 1, tzinfo=timezone.utc)
    assert report_lines(result.issues, stamp).first().value.endswith("2030-01-01T00:00:00+00:00")


def test_rules_spark_cannot_plan_cost_only_themselves(spark, store):
    """A foreign key between types that cannot be compared, next to rules that work."""
    spark.sql("SELECT 1 AS ID, map(1, 2) AS M, array(1) AS A").write.parquet(store.path("odd"))
    put(spark, store, "parent", [(1,), (1,)], "K int")
    odd = TableContract(
        "ODD", (Column("ID", "INTEGER", False),),
        (
            Rule("primary_key", ("ID",), "ODD_PK"), Rule("unique", ("M",), "ODD_UK"),
            Rule("foreign_key", ("A",), "ODD_FK", "PARENT", ("K",)),
        ),
    )
    result = run(spark, "validate", [odd, PARENT], store, RunOptions(validate_schema=False))
    found = {(r.target_table, r.kind): r.violations for r in result.report.collect()}
    assert found[("odd", "primary_key_duplicate")] == 0 and found[("odd", "not_null")] == 0
    assert found[("parent", "primary_key_duplicate")] == 1
    assert found[("odd", "unique_duplicate")] == 0 and found[("odd", "foreign_key")] is None
    outcomes = {r.target_table: r.outcome for r in result.outcomes.collect()}
    assert outcomes == {"odd": "error", "parent": "failed"}
    assert {k: n for k, n in kinds(result).items() if k[1] == "odd"} == {
        ("foreign_key_error", "odd"): 1
    }


def test_no_outcome_is_better_than_its_rules(spark, store):
    """Tables that crashed, were skipped, differ or are missing never pass."""
    columns = (Column("K", "INTEGER", False),)
    rules = {
        "crashed": Rule("check", name="ck", expression="1 / (K - K) > 0"),
        "skipped": Rule("foreign_key", ("K",), "fk", "ABSENT", ("K",)),
        "differs": None,
        "missing": None,
        "sound": Rule("check", name="ck", expression="K > 0"),
    }
    contracts = [
        TableContract(name.upper(), columns, (rule,) if rule else ()) for name, rule in rules.items()
    ]
    for name in rules:
        if name != "missing":
            put(spark, store, name, [(1,)], "K bigint" if name == "differs" else "K int")
    result = run(spark, "validate", contracts, store)
    assert {r.target_table: r.outcome for r in result.outcomes.collect()} == {
        "crashed": "error", "skipped": "incomplete", "differs": "failed", "missing": "error", "sound": "passed",
    }


def test_a_namespace_that_cannot_be_made_is_survived(spark, store):
    odd = TableStore(store.root, "parquet", "no/such.name`")
    result = run(spark, "validate", [PARENT], odd)
    assert result.outcomes.first().outcome == "error"
    result = run(spark, "create", [PARENT], odd)
    assert ("namespace_error", None) in kinds(result)
    with pytest.raises(Exception):
        run(spark, "create", [PARENT], odd, RunOptions(continue_on_error=False))


def test_one_damaged_table_leaves_the_plans_of_others(spark, store, tmp_path):
    from pactframe.plans.constraints import measure, plan_table
    from pactframe.plans.run import table_lookup

    put(spark, store, "parent", [(1,)], "K int")
    put(spark, store, "broken", [(1,)], "K int")
    put(spark, store, "child", [(1, 1)], "ID int, K int")
    rules = (Rule("foreign_key", ("K",), "a", "PARENT", ("K",)), Rule("foreign_key", ("K",), "b", "BROKEN", ("K",)))
    child = TableContract("CHILD", (Column("ID", "INTEGER"), Column("K", "INTEGER")), rules)
    lookup = table_lookup(spark, store)
    plan = plan_table(child, lookup)
    for file in (tmp_path / "tables" / "broken").glob("*.parquet"):
        file.write_bytes(b"PAR1 damaged")
    failed = []
    sizes = measure([plan], lookup, lambda name, error: failed.append(name))
    assert failed == ["broken"] and set(sizes.parents) == {("parent", ("K",))}


def test_broadcasts_of_an_action_share_one_budget(spark):
    from pactframe.plans.constraints import Sizes, plan_table

    tables = {f"p{i}": spark.range(1).selectExpr("id AS K") for i in range(40)}
    plans = []
    for i in range(200):
        rules = [Rule("foreign_key", ("K",), f"f{j}", f"P{(i + j) % 40}", ("K",)) for j in range(3)]
        contract = TableContract(f"T{i}", (Column("K", "INTEGER"),), tuple(rules))
        plans.append(plan_table(contract, (tables | {f"t{i}": tables["p0"]}).get))
    sizes = Sizes({(f"p{i}", ("K",)): 100 + i for i in range(40)}, frozenset())
    kept = sizes.within(plans, 1000).parents
    assert sum(kept.values()) <= 1000 and len(kept) == 9


def test_a_bad_contract_row_leaves_the_others(spark):
    from pactframe import from_tables, to_tables

    twice = spark.createDataFrame(
        [("child", "second", "primary_key", ["ID"], None, None, None, None, None, 9)], to_tables(spark, [CHILD]).rules.schema
    )
    tables, columns, rules = to_tables(spark, [PARENT, CHILD])
    faults = {}
    found = from_tables(tables, columns, rules.union(twice), faults=faults)
    assert [c.source_name for c in found] == ["PARENT"] and "primary key" in faults["child"]
    with pytest.raises(ValueError):
        from_tables(tables, columns, rules.union(twice))
