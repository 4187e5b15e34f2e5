"""Queries of the package against their SQL, and the pipeline stage by stage."""

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from pactframe.llm import queries

from .conftest import SMALL

ORACLES = queries.oracle_sql()


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", list(ORACLES))
@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_sql(session, name, folder):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    found = queries.queries()[name](session, folder)
    columns = sorted(found.columns)
    rows = Counter(tuple(map(plain, r)) for r in found.select(*columns).collect())
    result = duck.execute(ORACLES[name])
    names = [entry[0] for entry in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert rows == Counter(tuple(plain(r[p]) for p in places) for r in result.fetchall())


def test_stages_keep_what_they_should(session):
    documents = session.read.parquet(f"{SMALL}/documents.parquet")
    docs, texts = documents, {}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()} if number < 5 else {}
        docs = corpus_pipeline.written(stage(session, docs, SMALL), "stage-test")
        if number < 4:
            assert docs.columns == documents.columns and docs.schema == documents.schema
            after = {r["doc_id"]: r for r in docs.collect()}
            assert set(after) <= set(before)
            if number < 3:
                assert all(after[i] == before[i] for i in after)
            if number == 1:
                assert {r["text"].lower() for r in after.values()} == {r["text"].lower() for r in before.values()}
            if number == 3:
                assert set(after) == set(before)
                assert all(r["n_chars"] == len(r["text"]) for r in after.values())
            texts = {i: r["text"] for i, r in after.items()}
    assert {r["doc_id"] for r in docs.collect()} == set(texts)


def test_run_equals_its_stages(session):
    docs = session.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(session, docs, SMALL), "stage-test")
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = corpus_pipeline.run(session, SMALL)
    assert sorted(map(tuple, run.select(pieces).collect())) == sorted(map(tuple, docs.select(pieces).collect()))


def test_stages_on_odd_rows(session):
    """Nulls in any column, empty and long texts, and repeated rows go through every stage."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (None, "a row without an id", "en", "s", 19),
        (None, "a row without an id", "en", "s", 19), (None, None, None, None, None),
        (3, "The same text twice over.", "en", "s", 25), (3, "The same text twice over.", "en", "s", 25),
        (4, "the SAME text twice over.", "en", None, 25), (3, "another text with the id three", "en", "s", None),
        (5, "word " * 40_000, "en", "s", 200_000), (6, "token = 11acdfb36bb72224148e6160f674b4be45601bff", "en", "s", 48),
    ]
    schema = session.read.parquet(f"{SMALL}/documents.parquet").schema
    docs = session.createDataFrame(rows, schema)
    kept = corpus_pipeline.quality(session, docs, SMALL)
    assert kept.schema.names == schema.names and kept.count() <= len(rows)
    once = corpus_pipeline.exact(session, docs, SMALL)
    found = sorted(((r["doc_id"], r["text"]) for r in once.collect()), key=str)
    assert found == sorted(
        [
            (2, ""), (None, "a row without an id"), (4, "the SAME text twice over."),
            (3, "another text with the id three"), (5, "word " * 40_000), (6, rows[-1][1]),
        ],
        key=str,
    )
    apart = corpus_pipeline.near(session, once, SMALL)
    assert apart.count() == len(found)
    masked = corpus_pipeline.mask_secrets(session, apart, SMALL)
    assert "[SECRET]" in {r["text"] for r in masked.collect()}
    pieces = corpus_pipeline.sequences(session, masked, SMALL)
    assert pieces.select("doc_id").distinct().count() == len(found)


def test_stages_on_an_empty_table(session):
    docs = session.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(session, docs, SMALL), "stage-test")
        assert docs.count() == 0
