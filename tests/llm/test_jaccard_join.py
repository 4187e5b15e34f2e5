import random
import re

import numpy as np
import pytest

from pactframe.llm import jaccard_join as j

from .conftest import ODD_ROWS


def brute(rows, n=5, threshold=0.8):
    """class and links by comparing all pairs; rows that repeat an id have equal texts."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        grams = {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()
        sets.append(grams)
    links = {k: set() for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            common = len(sets[a] & sets[b])
            if common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a].add(b)
                links[b].add(a)
    out = []
    for k, (i, _) in enumerate(rows):
        reach, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        out.append((i, min((rows[x][0] for x in reach), key=lambda x: (x is None, x)), len(links[k])))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["id"], r["class_id"], r["n_links"]) for r in df.collect()), key=str)


def near_copies(count, seed=1, length=120):
    source = random.Random(seed)
    base = [f"w{source.randrange(5000)}" for _ in range(length)]
    rows = []
    for k in range(count):
        words = list(base)
        for _ in range(source.randrange(4)):
            words[source.randrange(length)] = f"x{source.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    return rows


def test_odd_rows(docs):
    rows = [r for r in ODD_ROWS if r[0] != 9]
    assert found(j.jaccard_join(docs(rows))) == brute(rows)


def test_groups_against_all_pairs(docs):
    rows = []
    for group in range(12):
        for i, text in near_copies(6, group, 40 + 10 * group):
            rows.append((100 * group + i, text))
    rows += [(5000 + k, f"{k} " * 3 + "shared passage of some ten words that many documents hold") for k in range(30)]
    assert found(j.jaccard_join(docs(rows))) == brute(rows)


@pytest.mark.parametrize("block_rows", [7, 64])
def test_a_large_group_is_split_and_loses_no_link(docs, block_rows):
    rows = near_copies(90)
    settings = j.JoinSettings(block_rows=block_rows)
    assert found(j.jaccard_join(docs(rows), settings=settings)) == brute(rows)


def test_empty_table(docs):
    assert j.jaccard_join(docs([])).collect() == []


def test_different_texts_with_one_id(docs):
    rows = [(1, "a b c d e f g"), (1, "h i j k l m n"), (2, "a b c d e f g")]
    assert {r["id"] for r in j.jaccard_join(docs(rows)).collect()} == {1, 2}


def test_pruning_keeps_pairs_at_the_threshold():
    settings = j.JoinSettings()
    needs = j.least_matches(settings)
    source = np.random.default_rng(5)
    matches = source.random((20_000, settings.hashes)) < settings.threshold
    for n, need in needs:
        assert (matches[:, :n].sum(axis=1) < need).mean() < 1e-3
    assert all(need <= n for n, need in needs)
    unlike = source.random((20_000, settings.hashes)) < 0.4
    assert (unlike[:, :48].sum(axis=1) >= dict(needs)[48]).mean() < 0.2


def test_min_hashes_estimate_similarity():
    source = np.random.default_rng(2)
    grams = source.integers(0, 2**63, 3000, np.uint64)
    a, b = np.unique(grams[:2000]), np.unique(grams[500:2500])
    functions = j.hash_functions(2000)
    same = (j.min_hashes(a, *functions) == j.min_hashes(b, *functions)).mean()
    assert abs(same - 1500 / 2500) < 0.04


def test_overlaps_two_ways():
    source = np.random.default_rng(3)
    sets = [np.unique(source.integers(0, 400, 200).astype(np.uint64)) for _ in range(20)]
    a, b = np.triu_indices(20, 1)
    many = j.overlaps(sets, a, b)
    few = np.concatenate([j.overlaps(sets, a[k : k + 5], b[k : k + 5]) for k in range(0, len(a), 5)])
    assert (many == few).all()
    assert many[0] == len(np.intersect1d(sets[a[0]], sets[b[0]]))


def test_different_texts_with_one_id_are_all_compared(docs):
    import corpus_pipeline

    near, base = (" ".join(f"w{k}" for k in range(n)) for n in (61, 60))
    other, copy = " ".join(f"v{k}" for k in range(40)), " ".join(f"v{k}" for k in range(41))
    rows = [(3, near), (5, base), (5, other), (8, copy), (None, base), (6, None), (6, "")]
    assert found(j.jaccard_join(docs(rows))) == sorted(
        [(3, 3, 1), (5, 3, 1), (5, 5, 1), (8, 5, 1), (None, None, 0), (6, 6, 0), (6, 6, 0)], key=str
    )
    kept = corpus_pipeline.near(docs(rows).sparkSession, docs(rows), "")
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(3, near), (5, other), (None, base), (6, None), (6, "")], key=str
    )


def test_many_surviving_ids_are_joined_by_a_shuffle(docs, monkeypatch):
    rows = near_copies(20) + [(1000 + i, t) for i, t in near_copies(20, 2)]
    monkeypatch.setattr(j, "BROADCAST_IDS", -1)
    assert found(j.jaccard_join(docs(rows))) == brute(rows)
