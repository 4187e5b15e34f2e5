import random

import pytest
from pyspark.sql import functions as F

from pactframe.llm import periodic
from pactframe.llm.periodic import periodic_runs, solve_tile, tiles_of, word_ids, z_function

from .conftest import ODD_ROWS

SPACE = b" \t\n\x0b\f\r"


def words_of(text):
    out, word = [], b""
    for byte in (text or "").encode() + b" ":
        if byte in SPACE:
            out += [word] if word else []
            word = b""
        else:
            word += bytes([byte])
    return out


def runs_of(words, least_words=24, least_repeats=3):
    """(start, length, period), every period tried at every place."""
    found = {}
    for q in range(1, len(words) // least_repeats + 1):
        start = None
        for i in range(len(words) - q + 1):
            same = i + q < len(words) and words[i] == words[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                length = i + q - start
                if length >= max(least_words, least_repeats * q):
                    found.setdefault((start, length), q)  # the smallest period comes first
                start = None
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def expected(rows, **bounds):
    out = []
    for i, text in rows:
        words = words_of(text)
        runs = runs_of(words, **bounds)
        out.append((i, len(words), runs, kept(words, runs)))
    return sorted(out, key=str)


def found(df):
    return sorted(
        ((r["id"], r["n_words"], [(x["start"], x["length"], x["period"]) for x in r["runs"]], r["collapsed"]) for r in df.collect()),
        key=str,
    )


def random_words(seed, n, kinds, repeats):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    for _ in range(repeats):
        q = rng.randrange(1, max(2, n // 4))
        a = rng.randrange(max(1, n - 2 * q))
        for i in range(a + q, min(n, a + q * rng.randrange(2, 12) + rng.randrange(q))):
            words[i] = words[i - q]
    return words


@pytest.mark.parametrize("bounds", [{}, {"least_words": 5, "least_repeats": 2}])
def test_against_every_period(docs, bounds):
    sizes = (0, 23, 24, 70, 300, 900)
    rows = [(k, " ".join(random_words(k, sizes[k % 6], (1, 2, 3, 60)[k % 4], k % 5))) for k in range(60)]
    assert found(periodic_runs(docs(rows), **bounds)) == expected(rows, **bounds)


def test_odd_rows(docs):
    rows = [*ODD_ROWS, (20, "a b " * 30), (21, "a\x1cb " * 30), (22, "x\ty\n" * 12), (23, "\x0b\f\r")]
    rows += [(20, "a b c " * 9), (None, "a b c " * 9), (None, "a b c " * 9)]
    assert found(periodic_runs(docs(rows))) == expected([r for r in rows if r[0] != 5] + [(5, "word " * 30_000)])


def test_long_runs_are_stitched_from_many_tiles(docs):
    """Short periods over thousands of words, and one period of a thousand words."""
    block = [f"b{i}" for i in range(1000)]
    words = ["x", "y", "z"] * 3000 + block * 4 + ["a"] * 700 + [f"u{i}" for i in range(2000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[1:]))]
    (first, second) = found(periodic_runs(docs(rows)))
    assert first[2] == [(0, 9000, 3), (9000, 4000, 1000), (13000, 700, 1)]
    assert second[2] == [(0, 8999, 3), (8999, 4000, 1000), (12999, 700, 1)]
    assert first[3].split() == ["x", "y", "z", *block, "a", *words[13700:]]


def test_empty_table(docs):
    assert periodic_runs(docs([])).collect() == []


def test_bounds_are_checked(docs):
    with pytest.raises(ValueError):
        periodic_runs(docs([]), least_repeats=1)


def test_tiles_cover_every_run_and_no_plain_text():
    assert tiles_of(word_ids([b"%d" % i for i in range(5000)]), 24, 3) == []
    for seed in range(40):
        words = [w.encode() for w in random_words(seed, 800, 40, 3)]
        tiles = tiles_of(word_ids(words), 24, 3)
        for start, length, period in runs_of(words):
            inside = [(low, a, a + len(t)) for low, a, t in tiles if low <= period < 2 * low]
            covered = {i for _, a, b in inside for i in range(a, b)}
            assert set(range(start, start + length)) <= covered


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        words = [rng.randrange(2) for _ in range(rng.randrange(1, 200))]
        plain = [next((k for k in range(len(words) - i) if words[k] != words[i + k]), len(words) - i) for i in range(len(words))]
        assert z_function(words, len(words)) == plain


def test_fragments_have_their_smallest_period():
    assert solve_tile([1, 2] * 40, 4, 24) == []
    assert solve_tile([1, 2] * 40, 2, 24) == [(2, 0, 80)]
    assert periodic.is_power([1, 2, 3] * 5) and not periodic.is_power([1, 1, 2]) and not periodic.is_power([7])


def test_tiles_of_one_document_are_dealt_over_tasks(session, docs):
    words = " ".join(["x y z"] * 60_000)
    marked = periodic._marked(docs([(1, words)]).select("doc_id", F.col("text").cast("binary")), 24, 3)
    tiles = marked.select(F.lit(0).alias("row"), F.explode("tiles").alias("t")).select("row", "t.*")
    dealt = tiles.repartition(8, "row", "low", "start").select(F.spark_partition_id().alias("p")).distinct()
    assert dealt.count() == 8
