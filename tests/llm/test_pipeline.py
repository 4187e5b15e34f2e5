"""Each stage of the pipeline against plain Python, with repeated ids and clashing column names."""

import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from pactframe.llm import linear, queries, secrets
from pactframe.llm.quality import SETTINGS

from .conftest import SMALL

CLASH = ("id", "_row", "_digest", "_kept", "class_id", "digest", "row", "own", "body", "number", "label")


@pytest.fixture(scope="module")
def small(session):
    return session.read.parquet(f"{SMALL}/documents.parquet")


def with_clashes(session, rows):
    """(doc_id, text) rows as documents with further columns of all the names that are in use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
    full = [(i, t, "en", "s", None if t is None else len(t), *(f"{c} of {i} {t}" for c in CLASH)) for i, t in rows]
    return session.createDataFrame(full, schema)


def pairs(df):
    """(doc_id, text) of the rows, which must have kept their other columns."""
    rows = df.collect()
    for r in rows:
        assert all(r[c] == f"{c} of {r['doc_id']} {r['text']}" for c in CLASH if c in df.columns)
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=str)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_exact(rows):
    kept = {}
    for i, text in rows:
        body = lowered(text)
        if body not in kept or (i is not None and (kept[body][0] is None or i > kept[body][0])):
            kept[body] = (i, text)
    return kept


def words_runs(text):
    words = [w for w in re.split(r"[^\w]+|_", lowered(text).lower()) if w]
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def plain_near(rows):
    """Rows that stay: of each class of linked texts the least id; all rows without id or words."""
    sets = [words_runs(t) for _, t in rows]
    of = list(range(len(rows)))

    def root(k):
        while of[k] != k:
            k = of[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b]:
                if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                    of[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(root(k), []).append(i)
    return sorted((min(ids) for ids in least.values() if ids[0] is not None)), [r for r in rows if r[0] is None]


ROWS = [
    (1, "a b"), (1, "a c"), (2, "a b"), (2, "A B"), (None, "a b"), (None, "only here"), (None, "only here"), (3, None), (4, ""),
    (5, "x" * 50_000), (6, "x" * 50_000), (7, "é漢"), (7, "É漢"), (8, "tie"), (8, "tie"),
]


def test_exact_against_plain_python(session):
    for rows in (ROWS, [(i, t) for i, t in dict(ROWS[::-1]).items()], []):
        found = pairs(corpus_pipeline.exact(session, with_clashes(session, rows), SMALL))
        expected = plain_exact(rows)
        assert {lowered(t): i for i, t in found} == {body: i for body, (i, _) in expected.items()}
        assert len(found) == len(expected)


def test_an_id_whose_other_text_stays_does_not_save_a_copy(session):
    """(1, 'a b') is a copy of (2, 'a b') although another text of id 1 stays."""
    found = pairs(corpus_pipeline.exact(session, with_clashes(session, [(1, "a b"), (1, "a c"), (2, "a b")]), SMALL))
    assert found == [(1, "a c"), (2, "a b")]


def near_rows(repeat):
    text = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    rows = [
        (10, text), (11, text + " more"), (12, text.replace("w30", "zz")), (13, other), (14, other + " and more words"), (15, "short text"),
        (16, "short text"), (17, ""), (18, None), (19, " ".join(f"u{k}" for k in range(60))), (None, text), (None, text), (9, "..!"),
    ]
    return rows + ([(10, other), (13, text), (19, "short text"), (15, "short text")] if repeat else [])


@pytest.mark.parametrize("repeat", [False, True])
def test_near_against_all_pairs(session, repeat):
    rows = near_rows(repeat)
    found = pairs(corpus_pipeline.near(session, with_clashes(session, rows), SMALL))
    ids, without = plain_near(rows)
    assert sorted(i for i, _ in found if i is not None) == ids
    assert [r for r in found if r[0] is None] == sorted(without, key=str)


def test_near_and_exact_on_documents(session, small):
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    once = corpus_pipeline.written(corpus_pipeline.exact(session, small, SMALL), "t")
    kept = sorted(i for i, _ in plain_exact(rows).values())
    assert sorted(r["doc_id"] for r in once.collect()) == kept
    left = [(i, t) for i, t in rows if i in set(kept)]
    found = sorted(r["doc_id"] for r in corpus_pipeline.near(session, once, SMALL).collect())
    assert found == plain_near(left)[0]


def test_quality_keeps_what_its_own_model_accepts(session, small):
    """The model fitted in memory, from the same labels, decides each text by itself."""
    labels = {r["doc_id"]: r["quality"] for r in session.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    known = [(t, labels[i]) for i, t in rows if labels.get(i) in (0, 1)]
    model = linear.fit_rows([t for t, _ in known], np.array([y for _, y in known]), SETTINGS)
    accepted = sorted(i for i, t in rows if model.scores([t or ""], linear.Features(SETTINGS))[0] >= 0.5)
    found = corpus_pipeline.quality(session, small, SMALL)
    assert sorted(r["doc_id"] for r in found.collect()) == accepted
    assert 0 < len(accepted) < len(rows)
    good = {i for i, _ in rows if labels.get(i) == 1}
    assert len(good & set(accepted)) >= 0.95 * len(good)


BASE = [
    re.compile(r"""(?:password|passwd|secret|token|api_?key)["']? *[:=] *["']?[A-Za-z0-9+/_.=-]{12,}""", re.I),
    re.compile(r"AKIA[A-Z0-9]{14,}"),
    re.compile(r"[0-9a-f]{16,}"),
]


def test_masks_leave_no_base_secret_and_all_else(session, small):
    found = {r["doc_id"]: r for r in corpus_pipeline.mask_secrets(session, small, SMALL).collect()}
    scanner, masked = secrets.Scanner(secrets.EntropyScan()), 0
    for r in small.collect():
        text, spans = r["text"], scanner.spans(r["text"])
        gone = [False] * len(text)
        for start, end, _ in spans:
            gone[start:end] = [True] * (end - start)
        for pattern in BASE:
            for match in pattern.finditer(text):
                assert all(gone[match.start() : match.end()])
        kept = "".join(c for c, g in zip(text, gone) if not g)
        assert found[r["doc_id"]]["text"].replace("[SECRET]", "") == kept.replace("[SECRET]", "")
        assert found[r["doc_id"]]["n_chars"] == len(found[r["doc_id"]]["text"])
        masked += bool(spans)
    assert masked
    plain = corpus_pipeline.mask_secrets(session, small.drop("n_chars"), SMALL)
    assert "n_chars" not in plain.columns and plain.count() == small.count()


def test_pieces_against_the_tokenizer(session, small):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    pieces = {}
    for r in corpus_pipeline.sequences(session, small, SMALL).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    filled = {}
    for r in small.collect():
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids + [0]
        own = sorted(pieces[r["doc_id"]], key=lambda p: p["piece"])
        assert [p["start"] for p in own] == [sum(q["length"] for q in own[:k]) for k in range(len(own))]
        assert sum(p["length"] for p in own) == len(ids)
        for p in own:
            part = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == p["ids_crc32"]
            filled.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for places in filled.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 2048


def test_run_is_its_stages_in_plain_python(session, small):
    """The documents that reach the end are those that the plain stages leave."""
    labels = {r["doc_id"]: r["quality"] for r in session.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    known = [(t, labels[i]) for i, t in rows if labels.get(i) in (0, 1)]
    model = linear.fit_rows([t for t, _ in known], np.array([y for _, y in known]), SETTINGS)
    good = [(i, t) for i, t in rows if model.scores([t or ""], linear.Features(SETTINGS))[0] >= 0.5]
    once = {i for i, _ in plain_exact(good).values()}
    apart = plain_near([(i, t) for i, t in good if i in once])[0]
    assert sorted({r["doc_id"] for r in corpus_pipeline.run(session, SMALL).collect()}) == apart
