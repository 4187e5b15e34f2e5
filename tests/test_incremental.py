"""Validation of new files only, against validation of whole tables."""

from dataclasses import replace
from pathlib import Path

import pytest

import pactframe as pf
from pactframe.plans import incremental
from pactframe.plans.constraints import plan_table
from pactframe.plans.incremental import files_to_read, rules_digest, tracked_keys, validate_new_files

CONTRACT = pf.TableContract(
    "THING",
    (pf.Column("a", "NUMBER(9)", nullable=False), pf.Column("b", "VARCHAR2(9)"), pf.Column("c", "NUMBER(9,2)"), pf.Column("p", "NUMBER(12)")),
    (
        pf.Rule("primary_key", ("a",), "pk"), pf.Rule("unique", ("b", "c"), "uk"), pf.Rule("unique", ("b",), "ub"),
        pf.Rule("foreign_key", ("p",), "fk", "PARENT", ("k",)), pf.Rule("foreign_key", ("b",), "fb", "PARENT", ("name",)),
        pf.Rule("foreign_key", ("c",), "cast", "PARENT", ("k",)), pf.Rule("check", name="ck", expression="c > 1"),
        pf.Rule("check", name="unknown", expression="missing > 1"),
    ),
)
SCHEMA = "a int, b string, c decimal(9,2), p bigint"


class Table:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.store = pf.TableStore(str(root), "parquet", "default")
        self.state = str(root / "state")
        self.parents = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, None)], "k bigint, name string")

    def add(self, *rows):
        df = self.spark.createDataFrame(rows, "a int, b string, c int, p bigint").selectExpr("a", "b", "CAST(c AS decimal(9,2)) AS c", "p")
        df.coalesce(1).write.mode("append").parquet(self.store.path("thing"))

    def find(self, name):
        return {"parent": lambda: self.parents, "thing": lambda: self.spark.read.schema(SCHEMA).parquet(self.store.path("thing"))}.get(name, lambda: None)()

    def new(self, contract=CONTRACT):
        plan = plan_table(contract, self.find, {})
        rules = rules_digest(plan, tracked_keys(plan, self.find))
        return files_to_read(self.spark, self.store, "thing", f"{self.state}/thing", rules)

    def check(self, contract=CONTRACT):
        """The report, which must be that of the whole table."""
        def rows(df):
            return sorted(map(tuple, df.drop("position").collect()), key=str)

        got = rows(validate_new_files(contract, self.store, self.find, self.state, {}))
        assert got == rows(pf.validate_constraints(contract, self.find, {}))
        assert self.new(contract) == []
        return {r[2]: r[3] for r in got if r[1] != "primary_key_null"}


@pytest.fixture
def thing(spark, tmp_path):
    table = Table(spark, tmp_path)
    table.add((1, "x", 5, 1), (2, "y", 0, 7), (None, None, None, None))
    return table


def test_steps_against_the_whole_table(thing):
    first = thing.check()
    assert first["pk"] == 0 and first["fk"] == 1 and first["ck"] == 1
    thing.add((1, "x", 5, 2), (3, "z", 2, None), (None, None, None, 9))
    assert len(thing.new()) == 1
    second = thing.check()
    assert (second["pk"], second["uk"], second["ub"], second["fk"], second["fb"]) == (2, 1, 1, 2, 1)
    thing.add()
    thing.check()


def test_only_new_files_are_opened(thing, monkeypatch):
    thing.check()
    thing.add((9, "q", 3, 1))
    opened = []
    original = incremental._key_counts
    monkeypatch.setattr(incremental, "_key_counts", lambda df, tracked: opened.append(df.inputFiles()) or original(df, tracked))
    plain = thing.new()
    assert len(plain) == 1
    thing.check()
    assert [len(files) for files in opened] == [1] and Path(plain[0][0]).name == Path(opened[0][0]).name


def test_parents_may_change(thing, spark):
    assert thing.check()["fk"] == 1
    thing.parents = spark.createDataFrame([(7, "x")], "k bigint, name string")
    assert thing.check()["fk"] == 1 and thing.new() == []
    thing.parents = spark.createDataFrame([], "k bigint, name string")
    assert thing.check()["fk"] == 2


def test_a_file_that_goes_or_changes_takes_its_run_along(thing):
    thing.add((5, "w", 2, 2))
    thing.check()
    thing.add((1, "x", 5, 1))
    assert thing.check()["pk"] == 1
    files = sorted((thing.root / "thing").glob("*.parquet"), key=lambda p: p.stat().st_mtime)
    files[0].unlink()
    thing.spark.catalog.refreshByPath(thing.store.path("thing"))
    assert len(thing.new()) == 1  # the other file of the first run
    assert thing.check()["pk"] == 0


def test_other_rules_read_all_files_again(thing):
    thing.check()
    stricter = replace(CONTRACT, rules=(*CONTRACT.rules, pf.Rule("check", name="more", expression="a > 1")))
    assert len(thing.new(stricter)) == 1
    assert thing.check(stricter)["more"] == 1
    assert thing.new() == []


def test_a_run_that_dies_counts_for_nothing(thing, spark, monkeypatch):
    class Died(BaseException):
        pass

    def die(*_):
        raise Died

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", die)  # the list of files cannot be written
        plan = plan_table(CONTRACT, thing.find, {})
        tracked = tracked_keys(plan, thing.find)
        patch.setattr(incremental, "files_to_read", lambda *a: [(str(next((thing.root / "thing").glob("*.parquet"))), None, 0)])
        with pytest.raises(Died):
            incremental.read_new_files(spark, plan, tracked, thing.store, f"{thing.state}/thing", rules_digest(plan, tracked))
    assert (thing.root / "state" / "thing" / "keys").exists() and len(thing.new()) == 1
    assert thing.check()["fk"] == 1


def test_an_empty_table(spark, tmp_path):
    table = Table(spark, tmp_path)
    table.add()
    assert table.check()["fk"] == 0
