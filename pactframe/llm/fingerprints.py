"""Fingerprints of documents by their improbable features.

A feature is a window of 32 bytes. Its Shannon entropy puts it in one of 1001 classes, and the rarer a
class is among all windows of a corpus, the better its rank. In each stretch of 32 neighbouring windows
the best ranked one scores; windows that score often are selected. Selected features go into a chain of Bloom filters of
2048 bits, up to 160 features each, five bits a feature. Two fingerprints are compared filter by filter: the
bits they share beyond chance, by what equal filters would share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batch_of, col, id_and_text, slices
from .neighbours import dealt_by_id, pairs

WINDOW = 32  # bytes of a feature
CLASSES = 1001
LEAST_CLASS = 100  # windows of less entropy say nothing
NEIGHBOURS = 32
LEAST_SCORE = 8
BITS = 2048
HASHES = 5
FILTER_FEATURES = 160
BLOCK = 1 << 18  # windows worked on at once
NEVER = 1 << 10  # rank of a window that is not chosen

# c * log2(c) in fixed point, so that equal windows have equal sums wherever they stand
WEIGHTS = np.array([0] + [round(c * math.log2(c) * (1 << 20)) for c in range(1, WINDOW + 1)], np.int64)
STEPS = np.diff(WEIGHTS)


def _block_classes(data: np.ndarray) -> np.ndarray:
    """Entropy classes of all windows of a block: counts change by one byte that leaves and one that comes."""
    n = len(data)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for distance in range(1, WINDOW):
        same = (data[distance:] == data[:-distance]).view(np.uint8)
        before[distance:] += same
        after[:-distance] += same
    total = WEIGHTS[np.bincount(data[:WINDOW], minlength=256)].sum()
    changes = STEPS[before[WINDOW:]] - STEPS[after[: n - WINDOW]]
    sums = total + np.concatenate(([0], np.cumsum(changes)))
    full = int(WEIGHTS[WINDOW])
    return ((CLASSES - 1) * (full - sums) // full).astype(np.int16)


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """The class of each window of some bytes, 0 (one byte over and over) to 1000 (no byte twice)."""
    n = len(data) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.int16)
    parts = [_block_classes(data[k : min(k + BLOCK, n) + WINDOW - 1]) for k in range(0, n, BLOCK)]
    return np.concatenate(parts)


def _inside(starts: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the ranges."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + counts, -1)
    return np.cumsum(edges[:-1]) > 0


def scores(ranks: np.ndarray, openings: np.ndarray) -> np.ndarray:
    """How often each window is the best, leftmost one of `NEIGHBOURS` windows from an opening on."""
    n = len(ranks)
    out = np.zeros(n, np.uint8)
    for first in range(0, n, BLOCK):
        last = min(first + BLOCK + NEIGHBOURS - 1, n)
        block = np.full(last - first + NEIGHBOURS - 1, np.iinfo(np.int32).max, np.int32)
        block[: last - first] = (ranks[first:last].astype(np.int32) << 20) | np.arange(last - first, dtype=np.int32)
        span = 1
        while span < NEIGHBOURS:
            block = np.minimum(block[:-span], block[span:])
            span *= 2
        block = block[: min(BLOCK, n - first)]
        best = block[openings[first : first + BLOCK]]
        best = best[best < NEVER << 20] & ((1 << 20) - 1)
        out[first:last] += np.bincount(best, minlength=last - first).astype(np.uint8)
    return out


def _hashes(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of features given as 64-bit words, and their lengths."""
    found = lengths.astype(np.uint64)
    for k in range(words.shape[1]):
        found = (found ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(32))


def _features(texts: Sequence[bytes], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each selected feature, in the order they stand."""
    sizes = np.array([len(text) for text in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    owners, hashes = [], []
    whole = np.flatnonzero(sizes >= WINDOW)
    if len(whole):
        own = ranks[entropy_classes(data)]
        counts = sizes[whole] - WINDOW + 1
        own[~_inside(starts[whole], counts, len(own))] = NEVER
        openings = _inside(starts[whole], np.maximum(counts - NEIGHBOURS + 1, 1), len(own))
        chosen = np.flatnonzero(scores(own, openings) >= LEAST_SCORE)
        missing = np.setdiff1d(whole, _owners(starts, whole, chosen))
        # a text without one: its best window
        best = [starts[k] + int(np.argmin(own[starts[k] : starts[k] + sizes[k] - WINDOW + 1])) for k in missing]
        chosen = np.sort(np.concatenate((chosen, np.array(best, np.int64))))
        windows = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[chosen]
        owners.append(_owners(starts, whole, chosen))
        hashes.append(_hashes(np.ascontiguousarray(windows).view("<u8"), np.full(len(chosen), WINDOW)))
    short = np.flatnonzero((sizes > 0) & (sizes < WINDOW))  # the whole text is the feature
    if len(short):
        padded = b"".join([texts[k].ljust(WINDOW, b"\0") for k in short])
        owners.append(short)
        hashes.append(_hashes(np.frombuffer(padded, "<u8").reshape(len(short), -1), sizes[short]))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(hashes)


def _owners(starts: np.ndarray, whole: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The text that each place belongs to."""
    return whole[np.searchsorted(starts[whole], places, "right") - 1]


def digests(texts: Sequence[bytes], ranks: np.ndarray) -> list[bytes]:
    """The chain of filters of each text. An empty text has none."""
    owners, hashes = _features(texts, ranks)
    order = np.lexsort((np.arange(len(owners)), hashes, owners))
    first = np.ones(len(order), bool)
    first[1:] = (owners[order][1:] != owners[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    kept = np.sort(order[first])  # a feature counts once in a text
    kept = kept[np.argsort(owners[kept], kind="stable")]
    owners, hashes = owners[kept], hashes[kept]
    counts = np.bincount(owners, minlength=len(texts))
    filters = -(-counts // FILTER_FEATURES)
    place = np.arange(len(owners)) - (np.cumsum(counts) - counts)[owners]
    chain = (np.cumsum(filters) - filters)[owners] + place // FILTER_FEATURES
    bits = np.zeros((int(filters.sum()), BITS), bool)
    width = np.uint64(BITS.bit_length() - 1)
    for _ in range(HASHES):
        bits[chain, (hashes & np.uint64(BITS - 1)).astype(np.int64)] = True
        hashes = hashes >> width
    packed = np.packbits(bits, axis=1)
    ends = np.cumsum(filters)
    return [packed[a:b].tobytes() for a, b in zip((ends - filters).tolist(), ends.tolist(), strict=True)]


def _chain(fingerprint: bytes) -> np.ndarray:
    return np.frombuffer(fingerprint, "<u8").reshape(-1, BITS // 64)


def overlap(one: bytes, other: bytes, rows: int = 128) -> float:
    """Likeness of two fingerprints, 0 to 1: each filter's best match in the other chain, weighted by bits.

    A match is the number of shared bits less what chance gives, by the same for the fuller of the two
    filters. Two empty fingerprints are equal, an empty one is like no other. Work grows with the product of the
    chains, in blocks of `rows` filters.
    """
    if one == other:
        return 1.0
    if not one or not other:
        return 0.0
    a, b = _chain(one), _chain(other)
    in_a, in_b = (np.bitwise_count(x).sum(1).astype(float) for x in (a, b))
    best_a, best_b = np.zeros(len(a)), np.zeros(len(b))
    for k in range(0, len(a), rows):
        for j in range(0, len(b), rows):
            x, y = a[k : k + rows], b[j : j + rows]
            shared = np.bitwise_count(x[:, None] & y[None]).sum(-1, dtype=np.int64)
            chance = np.multiply.outer(in_a[k : k + rows], in_b[j : j + rows]) / BITS
            most = np.maximum.outer(in_a[k : k + rows], in_b[j : j + rows])
            match = np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1)
            best_a[k : k + rows] = np.maximum(best_a[k : k + rows], match.max(1))
            best_b[j : j + rows] = np.maximum(best_b[j : j + rows], match.max(0))
    return float((in_a @ best_a + in_b @ best_b) / (in_a.sum() + in_b.sum()))


def likeness(one: str, other: str) -> Column:
    """`overlap` of two columns of fingerprints; null if one of them is."""

    def compare(these: pd.Series, those: pd.Series) -> pd.Series:
        return pd.Series(
            [None if a is None or b is None else overlap(bytes(a), bytes(b)) for a, b in zip(these, those, strict=True)],
            dtype="float64",
        )

    return F.pandas_udf(compare, T.DoubleType())(col(one), col(other))


def entropy_ranks(df: DataFrame, text_col: str = "text") -> list[int]:
    """The rank of each entropy class, the rarest first, from all windows of all texts of a corpus.

    Windows are counted where they are; 1001 sums come to the driver. Classes below `LEAST_CLASS` are never
    chosen. Nulls and texts shorter than a window count nothing.
    """
    schema = pa.schema([("class", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(CLASSES, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for low, high in slices(texts, BLOCK):
                some = [text for text in texts[low:high] if len(text) >= WINDOW]
                if some:
                    sizes = np.array([len(text) for text in some], np.int64)
                    classes = entropy_classes(np.frombuffer(b"".join(some), np.uint8))
                    classes = classes[_inside(np.cumsum(sizes) - sizes, sizes - WINDOW + 1, len(classes))]
                    found += np.bincount(classes, minlength=CLASSES)
        yield batch_of(schema, range(CLASSES), found)

    texts = df.select(F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    sums = texts.mapInArrow(count, "class int, n long").groupBy("class").agg(F.sum("n").alias("n"))
    counts = {row["class"]: row["n"] for row in sums.collect()}
    order = sorted(range(LEAST_CLASS, CLASSES), key=lambda c: (counts.get(c, 0), c))
    ranks = [NEVER] * CLASSES
    for rank, number in enumerate(order):
        ranks[number] = rank
    return ranks


def fingerprints(
    df: DataFrame, columns: Mapping[str, str], ranks: Sequence[int]
) -> DataFrame:
    """`df` with each text column named in `columns` replaced by its fingerprint (binary), under the name given.

    Null and empty texts have an empty fingerprint; a text shorter than a window is one feature; a text without
    a window that is selected has its best one. Equal texts have equal fingerprints. Ids may be null or
    repeat, other columns stay as they are; an empty table gives no rows. A long text is worked on
    in blocks, in about four times its size.
    """
    others = [name for name in df.columns if name not in columns]
    texts = [F.coalesce(col(name).cast("string"), F.lit("")).cast("binary").alias(f"_{k}") for k, name in enumerate(columns)]
    kinds = [df.schema[name] for name in others]
    out = T.StructType([*kinds, *(T.StructField(name, T.BinaryType()) for name in columns.values())])
    held, table = len(others), np.array(ranks, np.int32)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [batch.column(held + k).to_pylist() for k in range(len(columns))]
            known: dict[bytes, bytes] = dict.fromkeys(text for values in given for text in values)
            distinct = list(known)
            for low, high in slices(distinct, BLOCK):
                known.update(zip(distinct[low:high], digests(distinct[low:high], table), strict=True))
            made = [pa.array([known[text] for text in values], pa.binary()) for values in given]
            yield pa.RecordBatch.from_arrays([*batch.columns[:held], *made], names=out.names)

    return df.select(*map(col, others), *texts).mapInArrow(digest, out)


def edited(text: str, following: str) -> str:
    """`text` with its last quarter, in code points, replaced by as much of another text's start."""
    part = len(text) // 4
    return text[: len(text) - part] + following[:part]


def edit_likeness(
    df: DataFrame, ranks: Sequence[int], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """How well fingerprints bear an edit: per row `id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`.

    The edited text of a row ends as the next row, in the order of ids, begins (`edited`); `near_edited` is the likeness
    to it, `near_next` that to the next row itself. Rows meet as in `neighbours.with_next`, which states the
    order of null and repeated ids; texts are treated as in `fingerprints`. All is done where a range of ids
    lies, a few rows at a time.
    """
    names = "id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    schema = pa.schema([(field.split()[0], kind) for field, kind in zip(names.split(", "), kinds, strict=True)])
    table = np.array(ranks, np.int32)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, following in pairs(batches):
            changed = [edited(text, other).encode() for text, other in zip(texts, following, strict=True)]
            given = [[text.encode() for text in texts], changed, [text.encode() for text in following]]
            known: dict[bytes, bytes] = dict.fromkeys(text for values in given for text in values)
            distinct = list(known)
            for low, high in slices(distinct, BLOCK):
                known.update(zip(distinct[low:high], digests(distinct[low:high], table), strict=True))
            own, other, beside = ([known[text] for text in values] for values in given)
            yield batch_of(
                schema, ids, map(len, texts), [sha256(text).hexdigest() for text in changed], own, other,
                [overlap(a, b) for a, b in zip(own, other, strict=True)],
                [overlap(a, b) for a, b in zip(own, beside, strict=True)],
            )

    return dealt_by_id(id_and_text(df, id_col, text_col)).mapInArrow(compare, names)
