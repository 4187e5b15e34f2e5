import json

import pytest
from pyspark.sql import functions as F

from pactframe import Column, Rule, TableContract, TableStore, create_table, load_table, read_table, register_table
from pactframe.sources.tables import (
    DataLossError,
    LocationError,
    contract_properties,
    ensure_namespace,
    find_table,
    read_contract_properties,
    table_exists,
    write_contract_properties,
)

CONTRACT = TableContract(
    "Thing", source_schema="own",
    columns=(
        Column("ID", "NUMBER(9)", nullable=False), Column("KIND", "CHAR(1)", default_expr="'it''s'"),
        Column("PRICE", "NUMBER(5,2)"),
    ),
    rules=(
        Rule("primary_key", ("ID",), "THING_PK"), Rule("unique", ("KIND", "ID"), "THING_UK"),
        Rule("unique", ("PRICE",), "THING_IX", origin="index"),
        Rule("foreign_key", ("ID",), "THING_FK", "PARENT", ("K",), ref_schema="OWN"),
        Rule("check", name="THING_CK", expression="\"KIND\" in ('a', 'b\\c')"),
    ),
)


@pytest.fixture
def store(spark, tmp_path, request):
    name = "s_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    store = ensure_namespace(spark, TableStore(str(tmp_path / "my tables"), "parquet", name))
    yield store
    spark.sql(f"DROP SCHEMA {store.namespace} CASCADE")


def test_create_then_register_then_replace(spark, store):
    for by_name in (False, True):
        assert not table_exists(spark, store, "thing", by_name)
    assert create_table(spark, store, CONTRACT) == "created"
    for by_name in (False, True):
        assert table_exists(spark, store, "thing", by_name)
    table = read_table(spark, store, "thing", by_name=True)
    assert table.count() == 0
    assert [f.dataType for f in table.schema] == [f.dataType for f in CONTRACT.schema]

    rows = spark.createDataFrame([(1, "a", 2.5)], "id int, kind string, price double")
    load_table(rows, CONTRACT, store, set_aside=())
    assert create_table(spark, store, CONTRACT) == "registered"
    assert read_table(spark, store, "thing").count() == 1
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        create_table(spark, store, CONTRACT, "create")

    with pytest.raises(DataLossError):
        create_table(spark, store, CONTRACT, "replace")
    assert read_table(spark, store, "thing").count() == 1
    assert create_table(spark, store, CONTRACT, "replace", allow_data_loss=True) == "replaced"
    assert spark.table(store.identifier("thing")).count() == 0
    assert create_table(spark, store, CONTRACT, "replace") == "replaced"
    with pytest.raises(ValueError):
        create_table(spark, store, CONTRACT, "merge")


def test_a_name_cannot_stand_for_two_paths(spark, store, tmp_path):
    create_table(spark, store, CONTRACT)
    elsewhere = TableStore(str(tmp_path / "other"), "parquet", store.schema_name)
    spark.range(1).write.parquet(elsewhere.path("thing"))
    with pytest.raises(LocationError):
        register_table(spark, elsewhere, "thing")


def test_namespace_falls_back_to_what_the_catalogue_takes(spark, tmp_path):
    asked = TableStore(str(tmp_path), "parquet", "fallback_schema", catalog="Gold")
    assert asked.identifier("t") == "`Gold`.`fallback_schema`.`t`"
    got = ensure_namespace(spark, asked)
    assert got.identifier("t") == "`fallback_schema`.`t`"
    assert spark.catalog.databaseExists("fallback_schema")


def test_missing_table_is_none_but_other_errors_are_not_hidden(spark, store):
    assert find_table(spark, store, "nothing") is None
    broken = TableStore(store.root, "no_such_format", store.schema_name)
    with pytest.raises(Exception):
        find_table(spark, broken, "nothing")


def test_properties_survive_quotes_and_backslashes(spark, store):
    create_table(spark, store, CONTRACT)
    write_contract_properties(spark, store, CONTRACT)
    stored = read_contract_properties(spark, store, "thing")
    assert stored == contract_properties(CONTRACT)
    assert len(stored) == 9
    read = {name.removeprefix("oracle."): text for name, text in stored.items()}
    assert (read["source_schema"], read["source_table"]) == ("OWN", "THING")
    assert json.loads(read["primary_key"]) == {"name": "THING_PK", "columns": ["ID"]}
    assert json.loads(read["unique_keys"]) == [{"name": "THING_UK", "columns": ["KIND", "ID"]}]
    assert json.loads(read["unique_indexes"]) == [{"name": "THING_IX", "columns": ["PRICE"]}]
    assert json.loads(read["foreign_keys"]) == [
        {"name": "THING_FK", "columns": ["ID"], "ref_schema": "OWN", "ref_table": "PARENT", "ref_columns": ["K"]}
    ]
    assert json.loads(read["check_constraints"])[0]["expression"] == "\"KIND\" in ('a', 'b\\c')"
    assert json.loads(read["not_null_columns"]) == ["ID"]
    assert json.loads(read["defaults"]) == {"KIND": "'it''s'"}


def incoming(spark):
    return spark.createDataFrame(
        [("1", "9.999"), ("2", "12345"), (None, "1"), ("x", None)], "id string, price string"
    )


def test_load_counts_and_sets_aside_in_the_write(spark, store, tmp_path):
    create_table(spark, store, CONTRACT)
    aside = str(tmp_path / "aside")
    result = load_table(incoming(spark), CONTRACT, store, set_aside_path=aside)
    assert (result.rows_read, result.rows_loaded, result.rows_set_aside) == (4, 2, 2)
    assert result.failures == {
        ("cast", "ID"): 1, ("cast", "PRICE"): 1, ("not_null", "ID"): 2, ("primary_key_null", "THING_PK"): 2
    }
    loaded = read_table(spark, store, "thing").orderBy(F.col("ID").desc_nulls_last()).collect()
    assert [(r.ID and int(r.ID), r.KIND, str(r.PRICE)) for r in loaded] == [
        (1, "it's", "10.00"), (None, "it's", "1.00")
    ]
    rejected = {r.id: [tuple(v) for v in r.violations] for r in spark.read.parquet(aside).collect()}
    assert rejected["2"] == [("cast", "PRICE")]
    assert rejected["x"][0] == ("cast", "ID")


def test_load_can_set_aside_by_rule_or_not_at_all(spark, store, tmp_path):
    create_table(spark, store, CONTRACT)
    with pytest.raises(ValueError, match="set_aside_path"):
        load_table(incoming(spark), CONTRACT, store)
    aside = str(tmp_path / "aside")
    kept = load_table(incoming(spark), CONTRACT, store, ("cast", "not_null"), aside)
    assert kept.rows_loaded == 1 and spark.read.parquet(aside).count() == 3
    kept = load_table(incoming(spark), CONTRACT, store, set_aside=())
    assert kept.rows_loaded == 4
    assert read_table(spark, store, "thing").count() == 5


def test_stream_takes_the_same_path(spark, store, tmp_path):
    from pactframe import start_load

    create_table(spark, store, CONTRACT)
    source, aside = str(tmp_path / "source"), str(tmp_path / "aside")

    def run_once():
        stream = spark.readStream.schema("id string, price string").parquet(source)
        queries = start_load(
            stream, CONTRACT, store, str(tmp_path / "progress"), set_aside_path=aside
        )
        for query in queries:
            assert query.awaitTermination(120)

    incoming(spark).write.parquet(source)
    run_once()
    assert read_table(spark, store, "thing").count() == 2
    assert spark.read.parquet(aside).count() == 2
    incoming(spark).where("id = '1'").write.mode("append").parquet(source)
    run_once()
    assert read_table(spark, store, "thing").count() == 3
    assert spark.read.parquet(aside).count() == 2


def test_loads_that_would_spoil_a_table_are_refused(spark, tmp_path):
    from pactframe import start_load
    from pactframe.sources.tables import SchemaMismatch

    store = TableStore(str(tmp_path / "t"), "parquet", "default")
    contract = TableContract("SPOILT", (Column("V", "NUMBER(15,2)"),))
    rows = spark.createDataFrame([(1.5,)], "V double")
    with pytest.raises(LookupError):
        load_table(rows, contract, store, set_aside=())
    rows.write.parquet(store.path("spoilt"))
    with pytest.raises(SchemaMismatch, match="stored as double"):
        load_table(rows, contract, store, set_aside=())
    with pytest.raises(SchemaMismatch):
        start_load(rows, contract, store, str(tmp_path / "c"), set_aside=())
    assert read_table(spark, store, "spoilt").count() == 1


def test_an_input_that_changes_between_passes_is_noticed(spark, tmp_path):

    from pactframe.sources.tables import UnrepeatableInput

    store = TableStore(str(tmp_path / "t"), "parquet", "unrepeatable")
    spark.sql("CREATE SCHEMA unrepeatable")
    contract = TableContract("MOVING", (Column("V", "NUMBER(3)"),))
    create_table(spark, store, contract)
    now = "pmod(unix_micros(current_timestamp()), 5000)"  # another one for each job
    moving = spark.range(5001).selectExpr(f"if(id <= {now}, 5000, 1) AS V")
    with pytest.raises(UnrepeatableInput):
        load_table(moving, contract, store, set_aside_path=str(tmp_path / "aside"))
    spark.sql("DROP SCHEMA unrepeatable CASCADE")


class Died(BaseException):
    """Stands for a driver that is killed."""


def dying(monkeypatch, method, when):
    """The given method of folders dies when `when(call number, arguments)` holds."""
    from pactframe.sources.files import Folder

    original, calls = getattr(Folder, method), []

    def call(self, *args):
        calls.append(args)
        if when(len(calls), args):
            raise Died
        return original(self, *args)

    monkeypatch.setattr(Folder, method, call)


@pytest.mark.parametrize("read_once", [False, True])
def test_a_load_that_dies_before_its_marker_changes_nothing(spark, store, tmp_path, monkeypatch, read_once):
    create_table(spark, store, CONTRACT)
    aside = str(tmp_path / "aside")
    load_table(incoming(spark), CONTRACT, store, set_aside_path=aside)
    with monkeypatch.context() as patch:
        dying(patch, "write_text", lambda n, args: True)
        with pytest.raises(Died):
            load_table(incoming(spark), CONTRACT, store, set_aside_path=aside, batch_id="monday", read_once=read_once)
    spark.catalog.refreshByPath(store.path("thing"))
    assert read_table(spark, store, "thing").count() == 2 and spark.read.parquet(aside).count() == 2
    for _ in range(2):
        result = load_table(incoming(spark), CONTRACT, store, set_aside_path=aside, batch_id="monday", read_once=read_once)
        assert (result.rows_read, result.rows_loaded, result.rows_set_aside) == (4, 2, 2)
        assert result.failures[("not_null", "ID")] == 2
        assert read_table(spark, store, "thing").count() == 4 and spark.read.parquet(aside).count() == 4


@pytest.mark.parametrize("at", [1, 2, 3])
def test_a_load_that_dies_while_files_are_moved_is_completed(spark, store, tmp_path, monkeypatch, at):
    create_table(spark, store, CONTRACT)
    aside = str(tmp_path / "aside")
    rows = incoming(spark).repartition(4)
    with monkeypatch.context() as patch:
        moves = []
        dying(patch, "rename", lambda n, args: "/rows/" in args[0] and (moves.append(n) or len(moves) == at))
        with pytest.raises(Died):
            load_table(rows, CONTRACT, store, set_aside_path=aside, batch_id="b")
    for _ in range(2):
        again = load_table(incoming(spark).where("false"), CONTRACT, store, set_aside_path=aside, batch_id="b")
        assert (again.rows_read, again.rows_loaded) == (4, 2)  # of the load that was marked
        assert read_table(spark, store, "thing").count() == 2 and spark.read.parquet(aside).count() == 2


def test_read_once_reads_the_input_once(spark, store, tmp_path):
    create_table(spark, store, CONTRACT)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = incoming(spark).mapInPandas(count, "id string, price string")
    result = load_table(rows, CONTRACT, store, set_aside_path=str(tmp_path / "aside"), read_once=True)
    assert result.rows_set_aside == 2 and seen.value == 4


def test_a_refused_load_leaves_nothing_behind(spark, tmp_path):
    from pactframe.sources.tables import UnrepeatableInput

    store = TableStore(str(tmp_path / "t"), "parquet", "refused")
    contract = TableContract("MOVING", (Column("V", "NUMBER(3)"),))
    spark.sql("CREATE SCHEMA IF NOT EXISTS refused")
    create_table(spark, store, contract)
    moving = spark.range(5001).selectExpr("if(id <= pmod(unix_micros(current_timestamp()), 5000), 5000, 1) AS V")
    with pytest.raises(UnrepeatableInput):
        load_table(moving, contract, store, set_aside_path=str(tmp_path / "aside"), batch_id="x")
    assert read_table(spark, store, "moving").count() == 0
    assert not (tmp_path / "t" / "moving" / "_loads" / "x").exists()
    once = load_table(moving, contract, store, set_aside_path=str(tmp_path / "aside"), batch_id="x", read_once=True)
    assert read_table(spark, store, "moving").count() == once.rows_loaded
    spark.sql("DROP SCHEMA refused CASCADE")


def filled(spark, store):
    create_table(spark, store, CONTRACT)
    load_table(incoming(spark), CONTRACT, store, set_aside=())
    return sorted(map(tuple, read_table(spark, store, "thing").collect()), key=str)


def rows_now(spark, store):
    spark.catalog.refreshByPath(store.path("thing"))
    return sorted(map(tuple, read_table(spark, store, "thing").collect()), key=str)


def test_a_failing_replacement_leaves_the_old_rows(spark, store, monkeypatch):
    before = filled(spark, store)
    from pactframe.sources.files import Folder

    original = Folder.rename
    for fails in ("_new.thing", "thing"):
        def rename(self, name, to, fails=fails):
            if name == fails:
                raise OSError("no")
            original(self, name, to)

        with monkeypatch.context() as patch:
            patch.setattr(Folder, "rename", rename)
            with pytest.raises(OSError):
                create_table(spark, store, CONTRACT, "replace", allow_data_loss=True)
        assert rows_now(spark, store) == before
    assert create_table(spark, store, CONTRACT, "replace", allow_data_loss=True) == "replaced"
    assert rows_now(spark, store) == []
    from pathlib import Path

    assert not [p.name for p in Path(store.root).iterdir() if p.name.startswith("_")]


def test_a_replacement_that_dies_between_its_moves_is_undone(spark, store, monkeypatch):
    before = filled(spark, store)
    with monkeypatch.context() as patch:
        dying(patch, "rename", lambda n, args: args[0] == "_new.thing")
        with pytest.raises(Died):
            create_table(spark, store, CONTRACT, "replace", allow_data_loss=True)
    assert create_table(spark, store, CONTRACT, "register") == "registered"
    assert rows_now(spark, store) == before
