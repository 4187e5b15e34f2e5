import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from pactframe.llm import fingerprints as fp
from pactframe.llm import queries
from pactframe.llm.common import id_and_text
from pactframe.llm.fingerprints import digests, entropy_ranks, fingerprints, likeness, overlap
from pactframe.llm.neighbours import with_next

from .conftest import ODD_ROWS, SMALL

W = fp.WINDOW


def class_of(window):
    spent = sum(round(n * math.log2(n) * (1 << 20)) for n in Counter(window).values())
    full = round(W * math.log2(W) * (1 << 20))
    return 1000 * (full - spent) // full


def plain_ranks(texts):
    counts = Counter(class_of(t[k : k + W]) for t in texts for k in range(len(t) - W + 1))
    order = sorted(range(fp.LEAST_CLASS, 1001), key=lambda c: (counts[c], c))
    return [order.index(c) if c in order else fp.NEVER for c in range(1001)]


def plain_digest(text, ranks):
    if not text:
        return b""
    windows = [text[k : k + W] for k in range(len(text) - W + 1)]
    if windows:
        rank = [ranks[class_of(w)] for w in windows]
        score = Counter()
        for k in range(max(1, len(windows) - fp.NEIGHBOURS + 1)):
            near = range(k, min(k + fp.NEIGHBOURS, len(windows)))
            best = min(near, key=lambda i: (rank[i], i))
            score[best] += rank[best] < fp.NEVER
        chosen = [k for k in range(len(windows)) if score[k] >= fp.LEAST_SCORE]
        chosen = chosen or [min(range(len(windows)), key=lambda i: (rank[i], i))]
        features = [windows[k] for k in chosen]
    else:
        features = [text]
    filters, held = [], list(dict.fromkeys(features))
    for start in range(0, len(held), fp.FILTER_FEATURES):
        bits = [0] * fp.BITS
        for feature in held[start : start + fp.FILTER_FEATURES]:
            x = len(feature)
            padded = feature.ljust(W, b"\0")
            for k in range(0, W, 8):
                x = ((x ^ int.from_bytes(padded[k : k + 8], "little")) * 0x9E3779B97F4A7C15) % 2**64
                x ^= x >> 29
            x = x * 0xBF58476D1CE4E5B9 % 2**64
            x ^= x >> 32
            for k in range(fp.HASHES):
                bits[x >> (11 * k) & (fp.BITS - 1)] = 1
        filters.append(np.packbits(np.array(bits, np.uint8)).tobytes())
    return b"".join(filters)


def bits_of(filter_bytes):
    return {k for k in range(fp.BITS) if filter_bytes[k // 8] >> (7 - k % 8) & 1}


def plain_overlap(one, other):
    if one == other:
        return 1.0
    if not one or not other:
        return 0.0
    chains = [[bits_of(x[k : k + 256]) for k in range(0, len(x), 256)] for x in (one, other)]

    def match(a, b):
        chance = len(a) * len(b) / fp.BITS
        return min(1, max(0, (len(a & b) - chance) / max(max(len(a), len(b)) - chance, 1e-9)))

    total = weight = 0
    for mine, theirs in (chains, chains[::-1]):
        for a in mine:
            total += len(a) * max(match(a, b) for b in theirs)
            weight += len(a)
    return total / weight


def some_texts(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé漢") for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 1, 3, 4, 5, 6, 7, 8, 10, 30, 200, 900)]
    texts += ["a" * 500, "ab" * 40, "word " * 300, "\n" * 31, "\n" * 32, " ".join(texts[10:12]), texts[11][:3000] + texts[10]]
    return [t.encode() for t in texts]


def test_digests_against_plain_python():
    texts = some_texts()
    ranks = plain_ranks(texts)
    expected = [plain_digest(t, ranks) for t in texts]
    table = np.array(ranks, np.int32)
    assert digests(texts, table) == expected
    assert [digests([t], table)[0] for t in texts] == expected
    for a in expected:
        for b in expected:
            assert overlap(a, b) == pytest.approx(plain_overlap(a, b), abs=1e-9)
            assert overlap(a, b, rows=1) == pytest.approx(overlap(b, a), abs=1e-9)


def test_long_texts_are_worked_on_in_blocks(monkeypatch):
    texts = some_texts(2)
    ranks = np.array(plain_ranks(texts), np.int32)
    whole = digests(texts, ranks)
    monkeypatch.setattr(fp, "BLOCK", 100)
    assert digests(texts, ranks) == whole


def test_ranks_count_all_windows(docs):
    texts = some_texts()
    rows = [*enumerate(t.decode() for t in texts), (90, None), (None, texts[10].decode())]
    assert entropy_ranks(docs(rows).repartition(5)) == plain_ranks([(t or "").encode() for _, t in rows])


def test_odd_rows(docs):
    rows = [*ODD_ROWS, (30, "x" * 200_000), (31, "")]
    df = docs(rows)
    ranks = entropy_ranks(df)
    made = fingerprints(df, {"text": "fingerprint"}, ranks)
    assert made.columns == ["doc_id", *df.columns[2:], "fingerprint"]
    got = sorted(((r["doc_id"], bytes(r["fingerprint"])) for r in made.collect()), key=str)
    seen = {t: digests([(t or "").encode()], np.array(ranks, np.int32))[0] for _, t in rows}
    assert got == sorted(((i, seen[t]) for i, t in rows), key=str)
    assert fingerprints(docs([]), {"text": "fingerprint"}, entropy_ranks(docs([]))).collect() == []


def test_likeness_of_nulls(session):
    df = session.createDataFrame([(b"", b""), (None, b""), (b"", b"\1" * 256)], "a binary, b binary")
    assert [r[0] for r in df.select(likeness("a", "b")).collect()] == [1.0, None, 0.0]


@pytest.mark.parametrize("parts", [1, 3, 8, 50])
def test_every_row_with_the_next(docs, parts):
    rows = [(i * 7 % 101, f"text {i}") for i in range(101)] + [(500, None), (-3, ""), (40, "b"), (40, "a"), (None, "n"), (None, "m")]
    got = with_next(id_and_text(docs(rows).repartition(4), "doc_id", "text"), parts).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = [(*row, order[(k + 1) % len(order)][1]) for k, row in enumerate(order)]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_next_of_one_row_of_many_equal_ids_and_of_none(docs):
    one = with_next(id_and_text(docs([(4, "x")]), "doc_id", "text")).collect()
    assert list(map(tuple, one)) == [(4, "x", "x")]
    rows = [(1, f"t{k % 3}") for k in range(30)]
    got = Counter((r["text"], r["next_text"]) for r in with_next(id_and_text(docs(rows), "doc_id", "text"), 6).collect())
    assert got == Counter({("t0", "t0"): 9, ("t1", "t1"): 9, ("t2", "t2"): 9, ("t0", "t1"): 1, ("t1", "t2"): 1, ("t2", "t0"): 1})
    assert with_next(id_and_text(docs([]), "doc_id", "text")).collect() == []


def test_query_against_plain_python(session):
    rows = sorted(map(tuple, session.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()))
    texts = [t or "" for _, t in rows]
    # ranks by the library, which are tested above: windows in plain Python take minutes here
    ranks = entropy_ranks(session.read.parquet(f"{SMALL}/documents.parquet"))
    table = np.array(ranks, np.int32)
    got = {r["doc_id"]: r for r in queries.op12_fingerprints(session, SMALL).collect()}
    assert len(got) == len(rows)
    prints = digests([t.encode() for t in texts], table)
    for k, (i, _) in enumerate(rows):
        text, following = texts[k], texts[(k + 1) % len(rows)]
        part = len(text) // 4
        changed = text[: len(text) - part] + following[:part]
        row = got[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert base64.b64decode(row["fingerprint"]) == prints[k]
        (other,) = digests([changed.encode()], table)
        assert base64.b64decode(row["edited_fingerprint"]) == other
        assert row["near_edited"] == pytest.approx(overlap(prints[k], other))
        assert row["near_next"] == pytest.approx(overlap(prints[k], prints[(k + 1) % len(rows)]))
    long = [r for r in got.values() if r["n_chars"] >= 1000]
    assert sum(r["near_edited"] > r["near_next"] + 0.3 for r in long) > 0.95 * len(long)
