import pytest

from pactframe import (
    Column, Rule, TableContract, check_violations, duplicate_key_groups, duplicate_keys,
    fk_orphans, not_null_violations, null_key_rows, orphan_rows, row_count,
    rows_with_duplicate_key, validate_constraints, validate_tables, violating_rows,
    table_outcomes, write_violations,
)
from pactframe.operators.keys import count_duplicates
from pactframe.operators.matching import rows_with_keys
from pactframe.plans.constraints import measure, plan_table


def contract(columns, *rules, name="t"):
    return TableContract(name, tuple(Column(c, "INTEGER", n) for c, n in columns), rules)


def counts(report):
    tested = report.where("kind <> 'row_count' AND status = 'tested'").collect()
    return {(r.kind, r.rule_name): r.violations for r in tested}


# ------------------------------------------------------------------ rows


def test_not_null_names_only_broken_columns(spark):
    df = spark.createDataFrame([(1, None, 2), (None, None, 3)], "a int, `b.c` int, d int")
    found = {r.column_name: r.null_rows for r in not_null_violations(df, ["a", "b.c", "d"]).collect()}
    assert found == {"a": 1, "b.c": 2}


def test_null_key_rows_counts_a_row_once(spark):
    df = spark.createDataFrame([(None, None), (None, 1), (1, 1)], "a int, b int")
    assert null_key_rows(df, ["a", "b"]).first()[0] == 2
    assert row_count(df).first()[0] == 3


def test_check_passes_when_unknown(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "a int")
    assert [r.a for r in check_violations(df, "a > 0").collect()] == [-1]
    assert [r.a for r in check_violations(df, '"A" is  not null ').collect()] == [None]
    assert check_violations(df, "a > 0 -- positive").count() == 1


@pytest.mark.parametrize(
    "expression",
    ['"FLAG" IN (1, 2)', "nope > 1", "a + 1", "sum(a) > 0", "a >", "a > 0) OR (1 = 1", "GONE IS NOT NULL"],
)
def test_unusable_checks_are_refused_without_a_job(spark, expression):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        check_violations(df, expression)


def test_double_quotes_are_names_where_the_session_says_so(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("X",)], "flag string")
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    try:
        assert check_violations(df, "\"FLAG\" IN ('Y', 'N')").count() == 1
    finally:
        spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")


def test_a_bad_check_does_not_spoil_the_others(spark):
    df = spark.createDataFrame([(1,), (-1,)], "a int")
    rules = [Rule("check", name="good", expression="a > 0"), Rule("check", name="bad", expression="zz > 0")]
    plan = plan_table(contract([("a", True)], *rules), {"t": df}.get)
    assert [(s.issue_type, s.rule_name) for s in plan.skipped] == [("check_skipped", "bad")]
    assert counts(validate_constraints(plan.contract, {"t": df}.get)) == {("check", "good"): 1}


# ------------------------------------------------------------------ keys


def test_keys_with_awkward_names(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 1), (1, 1, 1, 1), (2, 1, 1, 1)], "COUNT int, `a.b` int, `x#` int, `y$` int"
    )
    key = ["count", "a.b", "X#", "y$"]
    rows = duplicate_keys(df, key).collect()
    assert [tuple(r) for r in rows] == [(1, 1, 1, 1, 2)]
    assert duplicate_keys(df, key).columns == [*key, "n_rows"]
    assert duplicate_key_groups(df, key).first()[0] == 1


def test_null_keys_are_equal_and_unique_lets_all_null_pass(spark):
    rows = [(None, None), (None, None), (1, None), (1, None), (2, 2)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert duplicate_key_groups(df, ["a", "b"]).first()[0] == 2
    assert duplicate_key_groups(df, ["a", "b"], "unique").first()[0] == 1
    assert tuple(count_duplicates(df, ["a", "b"]).first()) == (2, 1)
    assert rows_with_duplicate_key(df, ["a", "b"]).count() == 4
    assert rows_with_duplicate_key(df, ["a", "b"], "unique").count() == 2


@pytest.mark.parametrize("bound", [None, 24, 0])
def test_hash_first_gives_the_same_groups(spark, monkeypatch, bound):
    if bound is not None:  # hashes are broadcast in passes, or are too many for that
        monkeypatch.setattr("pactframe.operators.matching.BROADCAST_BYTES", bound)
    rows = [(f"text {i % 7}" if i % 5 else None, i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "t string, n int")
    for kind in ("primary_key", "unique"):
        plain = sorted(map(tuple, duplicate_keys(df, ["t", "n"], kind).collect()), key=str)
        hashed = sorted(map(tuple, duplicate_keys(df, ["t", "n"], kind, True).collect()), key=str)
        assert plain == hashed and plain


def test_rules_on_the_same_columns_share_one_grouping(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (None, None), (None, None)], "a int, b int")
    c = contract(
        [("a", True), ("b", True)], Rule("primary_key", ("a", "b"), "pk"),
        Rule("unique", ("B", "A"), "uk"), Rule("unique", ("a",), origin="index"),
    )
    assert len(plan_table(c, {"t": df}.get).key_sets) == 2
    assert counts(validate_constraints(c, {"t": df}.get)) == {
        ("primary_key_null", "pk"): 2, ("primary_key_duplicate", "pk"): 2,
        ("unique_duplicate", "uk"): 1, ("unique_duplicate", "a"): 1,
    }


# ------------------------------------------------------------------ foreign keys


def test_any_null_part_passes(spark):
    child = spark.createDataFrame([(1, 1), (1, None), (None, 9), (9, 9)], "a int, b int")
    parent = spark.createDataFrame([(1, 1), (1, 1)], "x int, y int")
    for small in (True, False):
        assert orphan_rows(child, parent, ["a", "b"], ["x", "y"], small).first()[0] == 1
        found = fk_orphans(child, parent, ["a", "b"], ["x", "y"], small_parent=small)
        assert [tuple(r) for r in found.collect()] == [(9, 9)]


def test_orphans_count_rows_not_keys(spark):
    child = spark.createDataFrame([(7,)] * 5 + [(1,)], "a int")
    parent = spark.createDataFrame([(1,)], "a int")
    assert orphan_rows(child, parent, ["a"], ["a"]).first()[0] == 5
    assert orphan_rows(child.where("a = 1"), parent, ["a"], ["a"]).first()[0] == 0


@pytest.mark.parametrize("small", [True, False])
def test_self_reference(spark, small):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 9)], "id int, boss int")
    assert orphan_rows(df, df, ["boss"], ["id"], small).first()[0] == 1
    c = contract([("id", True), ("boss", True)], Rule("foreign_key", ("boss",), "fk", "t", ("id",)))
    assert counts(validate_constraints(c, {"t": df}.get)) == {("foreign_key", "fk"): 1}


def test_orphans_of_hot_keys_without_a_broadcast(spark):
    """A third of the rows share an orphan key, a third a valid one."""
    rows = [(-1, i) for i in range(100)] + [(0, i) for i in range(100)] + [(i, i) for i in range(100)]
    child = spark.createDataFrame(rows, "k int, v int").repartition(4)
    parent = spark.range(50).selectExpr("CAST(id AS int) AS k")
    found = fk_orphans(
        child, parent, ["k"], ["k"], small_parent=False, hot_rows=10, broadcast_bytes=100
    )
    assert sorted(map(tuple, found.collect())) == sorted(r for r in rows if not 0 <= r[0] < 50)


def test_rows_with_keys_is_exact_on_every_path(spark):
    rows = [(i % 10 if i % 10 else None, i) for i in range(200)] + [(1, i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(3)
    sizes = df.groupBy("k").count().selectExpr("*", "k IS NULL OR k IN (1, 3) AS wanted")
    expected = sorted((r for r in rows if r[0] in (None, 1, 3)), key=str)
    for bound in (None, 40, 8, 0):
        found = rows_with_keys(df, sizes, ["k"], True, hot_rows=50, broadcast_bytes=bound)
        assert sorted(map(tuple, found.collect()), key=str) == expected


def test_skipped_foreign_keys_say_why(spark):
    child = spark.createDataFrame([(1, 1)], "a int, b int")
    parent = spark.createDataFrame([(1,)], "k int")
    rules = [
        Rule("foreign_key", ("a",), "implicit", "parent"),
        Rule("foreign_key", ("a",), "unknown_columns", "bare"),
        Rule("foreign_key", ("a", "b"), "lengths", "parent", ("k",)),
        Rule("foreign_key", ("a",), "no_table", "gone", ("k",)),
        Rule("foreign_key", ("z",), "no_child_column", "parent", ("k",)),
        Rule("foreign_key", ("a",), "no_parent_column", "parent", ("z",)),
    ]
    c = contract([("a", True), ("b", True)], *rules)
    contracts = {"parent": contract([("k", True)], Rule("primary_key", ("k",)), name="parent")}
    tables = {"t": child, "parent": parent, "bare": parent}
    plan = plan_table(c, tables.get, contracts)
    assert [key.rule.name for key in plan.foreign_keys] == ["implicit"]
    assert {s.rule_name for s in plan.skipped} == {
        "unknown_columns", "lengths", "no_table", "no_child_column", "no_parent_column"
    }
    assert {s.issue_type for s in plan.skipped} == {"foreign_key_skipped"}
    assert counts(validate_constraints(c, tables.get, contracts)) == {("foreign_key", "implicit"): 0}


def test_parent_override(spark):
    child = spark.createDataFrame([(1,), (2,)], "a int")
    parent = spark.createDataFrame([(1,)], "k int")
    c = contract([("a", True)], Rule("foreign_key", ("a",), "fk", "OLD", ("k",)))
    report = validate_constraints(
        c, {"t": child, "renamed": parent}.get, overrides={"OLD": "renamed"}
    )
    assert counts(report) == {("foreign_key", "fk"): 1}


def test_unnamed_foreign_keys_on_the_same_column_stay_apart(spark):
    child = spark.createDataFrame([(1,), (2,)], "a int")
    one, two = (spark.createDataFrame([(i,)], "k int") for i in (1, 3))
    c = contract(
        [("a", True)], Rule("foreign_key", ("a",), None, "one", ("k",)),
        Rule("foreign_key", ("a",), None, "two", ("k",)),
    )
    report = validate_constraints(c, {"t": child, "one": one, "two": two}.get)
    rows = report.where("kind = 'foreign_key'").orderBy("position").collect()
    assert [r.violations for r in rows] == [1, 2]
    assert rows[0].message == "foreign key ['a'] has 1 orphan rows"


@pytest.mark.parametrize("bound", [32 << 20, 40, 0])
def test_report_is_the_same_whatever_is_broadcast(spark, monkeypatch, bound):
    monkeypatch.setattr("pactframe.plans.constraints.BROADCAST_BYTES", bound)
    child = spark.createDataFrame([(i, i % 4, f"k{i % 3}") for i in range(30)], "a int, b int, c string")
    small = spark.createDataFrame([(0,), (1,)], "k int")
    large = spark.createDataFrame([("k0",), ("k1",), ("k9",)], "k string")
    c = contract(
        [("a", True), ("b", True), ("c", True)],
        Rule("foreign_key", ("b",), "to_small", "small", ("k",)),
        Rule("foreign_key", ("c",), "to_large", "large", ("k",)),
    )
    tables = {"t": child, "small": small, "large": large}
    plan = plan_table(c, tables.get)
    assert len(measure([plan], tables.get).parents) == {32 << 20: 2, 40: 1, 0: 0}[bound]
    assert counts(validate_constraints(c, tables.get)) == {
        ("foreign_key", "to_small"): 14, ("foreign_key", "to_large"): 10
    }


# ------------------------------------------------------------------ reports


def test_report_order_messages_and_outcomes(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (None, -5)], "A int, B int")
    c = contract(
        [("A", False), ("B", False)], Rule("primary_key", ("A",), "pk"),
        Rule("check", expression="b > 0"), Rule("foreign_key", ("B",), "fk", "p", ("k",)),
    )
    clean = contract([("A", True)], name="clean")
    empty = contract([("A", False)], name="empty")
    tables = {
        "t": df, "p": spark.createDataFrame([(5,)], "k int"),
        "clean": df.select("A"), "empty": df.select("A").limit(0),
    }
    report = validate_tables([c, clean, empty], tables.get)
    messages = [r.message for r in report.where("violations > 0").orderBy("position").collect()]
    assert messages == [
        "A has 1 NULL rows", "B has 1 NULL rows",
        "primary key ['A'] has 1 rows with NULL key parts",
        "primary key ['A'] has 1 duplicate key groups",
        "check b > 0 has 1 violating rows", "foreign key fk has 1 orphan rows",
    ]
    outcomes = {r.target_table: (r.outcome, r.row_count) for r in table_outcomes(report).collect()}
    assert outcomes == {"t": ("failed", 3), "clean": ("passed", 3), "empty": ("skipped", 0)}


def test_missing_columns_skip_only_their_rules(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    c = contract(
        [("a", False), ("z", False)], Rule("primary_key", ("a", "z"), "pk"), Rule("unique", ("a",), "uk")
    )
    plan = plan_table(c, {"t": df}.get)
    assert sorted(s.issue_type for s in plan.skipped) == [
        "not_null_skipped", "primary_key_duplicate_skipped", "primary_key_null_skipped"
    ]
    assert counts(validate_constraints(c, {"t": df}.get)) == {
        ("not_null", "a"): 0, ("unique_duplicate", "uk"): 1
    }


def test_violating_rows_and_their_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (1, -5), (2, 3)], "a int, `b.x` int")
    c = TableContract(
        "t", (Column("a", "INTEGER"), Column("b.x", "INTEGER", False)),
        (Rule("primary_key", ("a",), "pk"), Rule("check", name="ck", expression="`b.x` > 0")),
    )
    rows = violating_rows(c, {"t": df}.get)
    found = sorted((tuple(r) for r in rows.collect()), key=str)
    assert found == sorted(
        [
            ("not_null", "b.x", 1, None), ("check", "ck", 1, -5),
            ("primary_key_duplicate", "pk", 1, None), ("primary_key_duplicate", "pk", 1, -5),
        ],
        key=str,
    )
    write_violations(rows, str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "bad")).where("kind = 'check'").count() == 1


def test_slice(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, "y")], "a int, part string")
    c = contract([("a", False)], Rule("primary_key", ("a",), "pk"))
    report = validate_constraints(c, {"t": df}.get, where="part = 'x'")
    assert set(counts(report).values()) == {0}


def test_long_text_keys_of_long_tables_go_by_hash(spark, monkeypatch):
    monkeypatch.setattr("pactframe.plans.constraints.HASH_FIRST_ROWS", 3)
    long, short = (
        spark.createDataFrame([(t,) for t in texts], "t string") for texts in ("aab", "aa")
    )
    columns, rules = (Column("t", "CLOB"),), (Rule("unique", ("t",), "uk"),)
    contracts = [TableContract(name, columns, rules) for name in ("long", "short")]
    tables = {"long": long, "short": short}
    plans = [plan_table(c, tables.get) for c in contracts]
    sizes = measure(plans, tables.get)
    assert [sizes.hash_first(plan, plan.key_sets[0]) for plan in plans] == [True, False]
    report = validate_tables(contracts, tables.get).where("kind = 'unique_duplicate'")
    assert {r.target_table: r.violations for r in report.collect()} == {"long": 1, "short": 1}


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_empty_tables_on_either_side(spark, monkeypatch, bound):
    monkeypatch.setattr("pactframe.plans.constraints.BROADCAST_BYTES", bound)
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    none = rows.limit(0)
    rules = (Rule("foreign_key", ("k",), "fk", "parent", ("k",)), Rule("primary_key", ("k",), "pk"))
    c = contract([("k", False)], *rules)
    for child, parent, orphans in [(rows, none, 2), (none, rows, 0), (none, none, 0)]:
        found = counts(validate_constraints(c, {"t": child, "parent": parent}.get))
        assert found[("foreign_key", "fk")] == orphans
        assert found[("primary_key_duplicate", "pk")] == 0
    assert fk_orphans(rows, none, ["k"], ["k"], small_parent=False).count() == 2


def test_session_case_rule(spark):
    df = spark.createDataFrame([(1, 5), (1, 6)], "k int, v int")
    c = contract([("K", False)], Rule("unique", ("K",), "uk"))
    assert counts(validate_constraints(c, {"t": df}.get))[("unique_duplicate", "uk")] == 1
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        plan = plan_table(c, {"t": df}.get)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert not plan.key_sets and len(plan.skipped) == 2
