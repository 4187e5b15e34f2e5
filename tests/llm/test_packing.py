import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pactframe.llm.packing import OpenBins, best_fit_decreasing, pack

from .conftest import ODD_ROWS, SMALL

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_tightest_bin_is_found():
    source = random.Random(3)
    bins, held = OpenBins(50), []
    for step in range(3000):
        if source.random() < 0.5 or not held:
            capacity = source.randrange(1, 51)
            bins.add(step, capacity)
            held.append(capacity)
        else:
            least = source.randrange(1, 51)
            fits = [c for c in held if c >= least]
            found = bins.take(least)
            assert (found[1] if found else None) == (min(fits) if fits else None)
            if found:
                held.remove(found[1])


def test_best_fit_against_a_plain_search():
    source = np.random.default_rng(1)
    for _ in range(20):
        lengths = source.integers(1, 101, 200)
        places, offsets = best_fit_decreasing(lengths, 100)
        left, used = [], 0
        for item in np.argsort(-lengths, kind="stable"):
            fits = [k for k, c in enumerate(left) if c >= lengths[item]]
            if fits:
                left[min(fits, key=lambda k: left[k])] -= lengths[item]
            else:
                left.append(100 - lengths[item])
        assert len(set(places.tolist())) == len(left)
        for place in set(places.tolist()):
            inside = sorted((offsets[k], lengths[k]) for k in np.flatnonzero(places == place))
            assert [o for o, _ in inside] == np.cumsum([0] + [n for _, n in inside])[:-1].tolist()
            assert sum(n for _, n in inside) <= 100


def check(rows, texts, size):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["id"]].append(r)
    for inside in sequences.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= size
    total = 0
    for i, found in texts.items():
        for text in set(found):
            ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
            total += len(ids) * found.count(text)
            if len(found) > 1:
                continue
            got = sorted(pieces[i], key=lambda r: r["piece"])
            assert [r["piece"] for r in got] == list(range(-(-len(ids) // size)))
            assert [r["start"] for r in got] == np.cumsum([0] + [r["length"] for r in got])[:-1].tolist()
            assert sum(r["length"] for r in got) == len(ids)
            assert all(r["length"] == size for r in got[1:])
            for r in got:
                part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
                assert r["ids_crc32"] == zlib.crc32(part)
    assert sum(r["length"] for r in rows) == total
    return len(sequences), -(-total // size)


def test_odd_rows(docs):
    texts = defaultdict(list)
    for i, text in ODD_ROWS:
        texts[i].append(text)
    rows = pack(docs(ODD_ROWS), VOCABULARY, size=64).collect()
    check(rows, texts, 64)


@pytest.mark.parametrize("share", [40, 20_000])
def test_whole_table_is_packed_tightly(session, share):
    frame = session.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: [r["text"]] for r in frame.collect()}
    used, least = check(pack(frame, VOCABULARY, share_pieces=share).collect(), texts, 2048)
    assert used <= least + 2 + (len(texts) // share if share < len(texts) else 0)


def test_empty_table(docs):
    assert pack(docs([]), VOCABULARY).collect() == []


def test_equal_rows_are_dealt_over_the_shares(docs):
    rows = pack(docs([(None, "the same text")] * 400), VOCABULARY, share_pieces=50).collect()
    shares = Counter(r["sequence_id"] % 8 for r in rows)
    assert len(rows) == 400 and len(shares) == 8 and max(shares.values()) < 120
