"""Join of near-equal texts: Jaccard similarity of word n-gram sets, candidates pruned by Bayes.

1. Texts become sets of hashed n-grams. Texts with one set are one class and go on as one row,
   so copies cost nothing below.
2. Each class gets MinHash values. Classes that agree on all values of a band share a bucket;
   at the default settings a pair at the threshold misses every band with probability 3e-6.
3. Within a bucket MinHash values are compared a few at a time. After each step the pairs whose
   posterior probability of reaching the threshold has fallen below `tolerance` are dropped.
4. What is left is verified on the exact sets.

A large bucket is split into blocks, and pairs of blocks are spread over tasks, so that no task holds more than
two blocks. Pairs live only as index arrays inside a task: what leaves it is one row per class
and block pair (its number of links, and the least class it is linked with there), never a row per pair.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, id_and_text, written
from .components import connected_components

PAIRS_AT_ONCE = 100_000
BROADCAST_IDS = 1_000_000  # ids, 8 bytes each: more are joined by a shuffle


@dataclass(frozen=True)
class JoinSettings:
    """`bands` of `rows` MinHash values each; `step` values are compared between two prunings;
    blocks hold at most about `block_rows` classes and `block_grams` n-grams."""

    n: int = 5
    threshold: float = 0.8
    tolerance: float = 1e-7
    bands: int = 32
    rows: int = 5
    step: int = 16
    block_rows: int = 1024
    block_grams: int = 2_000_000

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def least_matches(settings: JoinSettings) -> list[tuple[int, int]]:
    """(values compared, matches needed): fewer matches and P(similarity >= threshold) < tolerance.

    With a uniform prior the posterior after m matches of n is Beta(m + 1, n - m + 1), and its
    upper tail at t is P(Binomial(n + 1, t) <= m).
    """
    found, t = [], settings.threshold
    stops = [*range(settings.step, settings.hashes, settings.step), settings.hashes]
    for n in stops:
        below, need = 0.0, 0
        for m in range(n + 1):
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= settings.tolerance:
                need = m
                break
        found.append((n, need))
    return found


def word_hashes(text: str = "text"):
    """The words of a text column (letters and digits of any script, lower case) as hashes."""
    words = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def gram_set(words: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of `n` words; a shorter text is one run."""
    words = words.view(np.uint64)
    if not len(words):
        return words
    width = min(n, len(words))
    mixed = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(mixed)]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def min_hashes(grams: np.ndarray, multipliers: np.ndarray, additions: np.ndarray) -> np.ndarray:
    """The high 32 bits of the least value of each hash function over a non-empty set."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 1024):
        values = multipliers[:, None] * grams[None, at : at + 1024]
        values += additions[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    source = np.random.Generator(np.random.PCG64(20_24))
    both = source.integers(0, 1 << 63, (2, count), np.uint64) << np.uint64(1)
    return both[0] | np.uint64(1), both[1]


def _word_arrays(batch: pa.RecordBatch, column: str) -> Iterator[np.ndarray]:
    lists = batch.column(column)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.asarray(lists.value_lengths()))
    start = 0
    for end in ends.tolist():
        yield values[start:end]
        start = end


def _digest(packed: bytes) -> bytes:
    return hashlib.blake2b(packed, digest_size=16).digest()


def signatures(texts: DataFrame, settings: JoinSettings) -> DataFrame:
    """`id, digest, grams, sig` of (id, text): a digest of the set, its size, packed MinHash values.

    A text without words has a null digest and signature.
    """
    schema = pa.schema(
        [("id", pa.int64()), ("digest", pa.binary()), ("grams", pa.int32()), ("sig", pa.binary())]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers, additions = hash_functions(settings.hashes)
        for batch in batches:
            out = []
            for words in _word_arrays(batch, "words"):
                grams = gram_set(words, settings.n)
                if len(grams):
                    sig = min_hashes(grams, multipliers, additions).tobytes()
                    out.append((_digest(grams.tobytes()), len(grams), sig))
                else:
                    out.append((None, 0, None))
            yield batch_of(schema, batch.column("id"), *(zip(*out, strict=True) if out else ((), (), ())))

    words = texts.select("id", word_hashes().alias("words"))
    return words.mapInArrow(sign, "id long, digest binary, grams int, sig binary")


def gram_sets(texts: DataFrame, settings: JoinSettings) -> DataFrame:
    """`rep, digest, set` of (id, text): the packed n-gram set and its digest."""
    schema = pa.schema([("rep", pa.int64()), ("digest", pa.binary()), ("set", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [gram_set(words, settings.n).tobytes() for words in _word_arrays(batch, "words")]
            yield batch_of(schema, batch.column("id"), [_digest(x) for x in packed], packed)

    words = texts.select("id", word_hashes().alias("words"))
    return words.mapInArrow(sets, "rep long, digest binary, set binary")


def bucket_rows(classes: DataFrame, settings: JoinSettings) -> DataFrame:
    """`bucket, left, right, band, rep, block`: each class in each bucket it shares, once for
    each pair of blocks that its own block takes part in."""
    width = 4 * settings.rows
    bands = F.array(
        *(F.xxhash64(F.lit(b), F.substring("sig", 1 + b * width, width)) for b in range(settings.bands))
    )
    placed = classes.select("rep", "grams", F.posexplode(bands).alias("band", "bucket"))
    sizes = (
        placed.groupBy("bucket")
        .agg(F.count("*").alias("members"), F.sum("grams").alias("held"))
        .where("members > 1")
    )
    blocks = F.greatest(
        F.ceil(F.col("members") / settings.block_rows), F.ceil(F.col("held") / settings.block_grams)
    ).cast("long")
    shared = placed.join(sizes, "bucket").withColumn("blocks", blocks)
    shared = shared.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    spread = shared.withColumn(
        "other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))
    )
    return spread.select(
        "bucket",
        F.least("block", "other").alias("left"),
        F.greatest("block", "other").alias("right"),
        "band",
        "rep",
        "block",
    )


KEY = ["bucket", "left", "right"]


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of sorted rows that end where a group of KEY ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        keys = [batch.column(k).to_numpy() for k in KEY]
        same = np.ones(batch.num_rows, bool)
        for key in keys:
            same &= key == key[-1]
        begin = batch.num_rows - int(same[::-1].argmin()) if not same.all() else 0
        if begin:
            table = pa.Table.from_batches(held[:-1] + [batch.slice(0, begin)])
            held = [batch.slice(begin)]
            yield table
        elif len(held) > 1 and any(
            held[-2].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in KEY
        ):
            table, held = pa.Table.from_batches(held[:-1]), [batch]
            yield table
    if held:
        yield pa.Table.from_batches(held)


def candidate_pairs(
    rows: pa.Table, settings: JoinSettings, needs: list[tuple[int, int]]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted rows that share a group, survive pruning, and meet in this band first."""
    bucket, left, right = (rows[k].to_numpy() for k in KEY)
    band, block = rows["band"].to_numpy(), rows["block"].to_numpy()
    count = rows.num_rows
    # An id can repeat only through a hash collision of two of its bands; both rows stay.
    sig = np.frombuffer(b"".join(rows["sig"].to_pylist()), "<u4").reshape(count, settings.hashes)
    bands = sig.reshape(count, settings.bands, settings.rows)
    new = np.ones(count, bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    group = np.cumsum(new)
    widest = int(np.bincount(group).max()) if count else 0
    firsts: list[np.ndarray] = []
    seconds: list[np.ndarray] = []
    held = 0

    def pruned() -> tuple[np.ndarray, np.ndarray]:
        a, b = np.concatenate(firsts), np.concatenate(seconds)
        matches, at = np.zeros(len(a), np.int32), 0
        for n, need in needs:
            matches += (sig[a, at:n] == sig[b, at:n]).sum(axis=1, dtype=np.int32)
            stay = matches >= need
            a, b, matches, at = a[stay], b[stay], matches[stay], n
        meet = (bands[a] == bands[b]).all(axis=2)
        stay = meet[np.arange(len(a)), band[a]] & (meet.argmax(axis=1) == band[a]) & (band[a] == band[b])
        return a[stay], b[stay]

    for apart in range(1, widest):
        a = np.flatnonzero(group[apart:] == group[:-apart])
        b = a + apart
        stay = (left[a] == right[a]) | (block[a] != block[b])
        a, b = a[stay], b[stay]
        for at in range(0, len(a), PAIRS_AT_ONCE):
            firsts.append(a[at : at + PAIRS_AT_ONCE])
            seconds.append(b[at : at + PAIRS_AT_ONCE])
            held += len(firsts[-1])
            if held >= PAIRS_AT_ONCE:
                yield pruned()
                firsts, seconds, held = [], [], 0
    if held:
        yield pruned()


def _grouped(rows: DataFrame, function: Callable, ddl: str) -> DataFrame:
    """`function` over sorted rows, with whole groups of KEY in each call."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            yield function(table)

    return rows.repartition(*KEY).sortWithinPartitions(*KEY, "rep").mapInArrow(run, ddl)


def surviving_rows(rows: DataFrame, settings: JoinSettings) -> DataFrame:
    """The rows of `bucket_rows`, with signatures, that take part in a pair that survives pruning."""
    needs = least_matches(settings)
    ddl = "bucket long, left int, right int, band int, rep long, block int"
    schema = pa.schema(
        [(k, pa.int64() if k in ("bucket", "rep") else pa.int32()) for k in ("bucket", "left", "right", "band", "rep", "block")]
    )

    def survivors(table: pa.Table) -> pa.RecordBatch:
        kept = np.zeros(table.num_rows, bool)
        for a, b in candidate_pairs(table, settings, needs):
            kept[a] = True
            kept[b] = True
        return batch_of(schema, *(table[name].to_numpy()[kept] for name in schema.names))

    return _grouped(rows, survivors, ddl)


def overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets."""
    used, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    if len(a) <= 8 * len(used):
        out = np.zeros(len(a), np.int64)
        for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            small, large = sorted((sets[x], sets[y]), key=len)
            at = np.searchsorted(large, small)
            at[at == len(large)] = 0
            out[k] = np.count_nonzero(large[at] == small)
        return out
    # Many pairs among few sets: products of incidence matrices, some columns at a time.
    owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used.tolist()])
    grams, column = np.unique(np.concatenate([sets[i] for i in used.tolist()]), return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(used), len(used)), np.float32)
    for low in range(0, len(grams), 4096):
        lo, hi = np.searchsorted(column, [low, low + 4096])
        matrix = np.zeros((len(used), min(4096, len(grams) - low)), np.float32)
        matrix[owner[lo:hi], column[lo:hi] - low] = 1
        total += matrix @ matrix.T
    return total[places[: len(a)], places[len(a) :]].astype(np.int64)


def _roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index reachable from each index over pairs (a, b)."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def verified_links(rows: DataFrame, settings: JoinSettings) -> DataFrame:
    """`rep, links, root` of rows with `sig, set, size`: per class and group the documents linked
    with it there by exact similarity, and the least class of those joined in the group."""
    needs = least_matches(settings)
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def verify(table: pa.Table) -> pa.RecordBatch:
        reps, size = table["rep"].to_numpy(), table["size"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table["set"].to_pylist()]
        grams = np.array([len(s) for s in sets], np.int64)
        links = np.zeros(len(reps), np.int64)
        ends: list[np.ndarray] = [np.zeros(0, np.int64)]
        others: list[np.ndarray] = [np.zeros(0, np.int64)]
        for a, b in candidate_pairs(table, settings, needs):
            if not len(a):
                continue
            common = overlaps(sets, a, b)
            linked = common >= settings.threshold * (grams[a] + grams[b] - common) - 1e-9
            a, b = a[linked], b[linked]
            np.add.at(links, a, size[b])
            np.add.at(links, b, size[a])
            ends.append(a)
            others.append(b)
        roots = _roots(len(reps), np.concatenate(ends), np.concatenate(others))
        kept = np.flatnonzero(links)
        return batch_of(schema, reps[kept], links[kept], reps[roots[kept]])

    return _grouped(rows, verify, "rep long, links long, root long")


def _numbered_join(texts: DataFrame, settings: JoinSettings) -> DataFrame:
    """The join of rows that repeat ids: by a number of each row, named by the least id at the end."""
    rows = written(texts.withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = jaccard_join(rows.where("id IS NOT NULL").select("row", "text"), "row", "text", settings)
    named = written(
        found.select(F.col("id").alias("row"), "class_id", "n_links").join(rows.select("row", "id"), "row"), "named"
    )
    least = named.groupBy("class_id").agg(F.min("id").alias("least"))
    alone = rows.where("id IS NULL").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return (
        named.join(least, "class_id").select("id", F.col("least").alias("class_id"), "n_links").unionByName(alone)
    )


def jaccard_join(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: JoinSettings | None = None,
) -> DataFrame:
    """`id, class_id, n_links` for every row of `df`.

    Two texts are linked if the Jaccard similarity of their sets of `n`-word runs reaches the threshold (texts of
    fewer words are one run). `n_links` counts the other rows linked directly, copies included;
    `class_id` is the least id reachable over links. A null or wordless text is linked with nothing and is a class of its own, as is a row
    whose id is null (its class is null). Ids may repeat: each row is compared, and rows that repeat id and text count
    as copies. An empty table gives no rows.
    """
    settings = settings or JoinSettings()
    texts = id_and_text(df, id_col, text_col)
    signed = written(signatures(texts, settings), "signatures")
    usable = signed.where("id IS NOT NULL AND digest IS NOT NULL")
    classes = written(
        usable.groupBy("digest").agg(
            F.min("id").alias("rep"),
            F.count("*").alias("size"),
            F.first("grams").alias("grams"),
            F.first("sig").alias("sig"),
        ),
        "classes",
    )
    # Only rows that repeat an id can give two classes one name.
    if not classes.groupBy("rep").count().where("count > 1").isEmpty():
        return _numbered_join(texts, settings)
    near = written(
        surviving_rows(
            bucket_rows(classes, settings).join(classes.select("rep", "sig"), "rep"), settings
        ),
        "survivors",
    )
    wanted = near.select("rep").distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    chosen = texts.join(wanted, texts["id"] == wanted["rep"], "left_semi")
    sets = gram_sets(chosen, settings).groupBy("rep", "digest").agg(F.first("set").alias("set"))
    rows = near.join(classes.select("rep", "digest", "size", "sig"), "rep").join(sets, ["rep", "digest"])
    found = written(verified_links(rows, settings), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = (
        classes.select("digest", "rep", "size")
        .join(links, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "digest",
            F.coalesce("component", "rep").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        )
    )
    alone = signed.where("id IS NULL OR digest IS NULL").select(
        "id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    return usable.select("id", "digest").join(named, "digest").drop("digest").unionByName(alone)
