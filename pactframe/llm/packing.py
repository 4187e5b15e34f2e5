"""Documents packed into sequences of a fixed number of tokens, best fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import PieceEncoder, load_json
from .common import batch_of, id_and_text, slices, written

PIECES = "id long, piece int, start long, length int, ids_crc32 long"


class OpenBins:
    """Open bins by remaining capacity, in a segment tree over the capacities 0 to `size`.

    A node counts the bins below it, so the tightest bin that still fits is found by one walk up
    and one walk down: logarithmic in `size` for each document.
    """

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.counts = [0] * (2 * self.width)
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, number: int, capacity: int) -> None:
        self.bins[capacity].append(number)
        node = self.width + capacity
        while node:
            self.counts[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes and returns a bin with the smallest capacity of at least `least`."""
        counts, node = self.counts, self.width + least
        if not counts[node]:
            while True:
                if node == 1:
                    return None
                if not node & 1 and counts[node + 1]:
                    node += 1
                    break
                node >>= 1
            while node < self.width:
                node <<= 1
                if not counts[node]:
                    node += 1
        capacity = node - self.width
        while node:
            counts[node] -= 1
            node >>= 1
        return self.bins[capacity].pop(), capacity


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each length (1 to `size`) its bin and its offset there. Ties go in the given order."""
    places, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins, used = OpenBins(size), 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        found = open_bins.take(length)
        if found is None:
            found = (used, size)
            used += 1
        number, capacity = found
        places[item], offsets[item] = number, size - capacity
        if capacity > length:
            open_bins.add(number, capacity - length)
    return places, offsets


def token_pieces(
    df: DataFrame, vocabulary: str, id_col: str, text_col: str, size: int, end_id: int = 0
) -> DataFrame:
    """The pieces of every document: its tokens and `end_id`, cut only if longer than `size`.

    All pieces of a long document are full but the first.
    """
    schema = pa.schema(
        [("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64())]
    )
    tail = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.shared(vocabulary, load_json)
        for batch in batches:
            ids, texts, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for low, high in slices(texts):
                for row, packed in zip(ids[low:high], encoder.encode(texts[low:high]), strict=True):
                    packed += tail
                    n = len(packed) // 4
                    start, stop = 0, n - (n - 1) // size * size
                    for piece in range((n - 1) // size + 1):
                        part = packed[4 * start : 4 * stop]
                        out.append((row, piece, start, stop - start, zlib.crc32(part)))
                        start, stop = stop, stop + size
            if out:
                yield batch_of(schema, *zip(*out, strict=True))

    return id_and_text(df, id_col, text_col).mapInArrow(cut, PIECES)


def pack(
    df: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    size: int = 2048,
    end_id: int = 0,
    share_pieces: int = 20_000,
) -> DataFrame:
    """`id, piece, start, length, ids_crc32, sequence_id, offset` for every piece.

    A full piece is a sequence of its own. The rest are dealt at random into shares of about
    `share_pieces`, and each share is packed best fit decreasing. A share leaves about one
    sequence part empty, in some thousands. Null and empty texts are documents of one token; ids may be null
    or repeat; an empty table gives no rows. A long text is held whole by one task, with its ids; its pieces are rows.
    """
    # Rows are numbered as they are written: equal ones are dealt like others.
    cut = token_pieces(df, vocabulary, id_col, text_col, size, end_id)
    pieces = written(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == size)
    rest = pieces.where(F.col("length") < size)
    shares = max(1, -(-rest.count() // share_pieces))

    def pack_share(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["id", "piece", "start", "length", "ids_crc32"], ignore_index=True)
        places, offsets = best_fit_decreasing(frame["length"].to_numpy(), size)
        # shares count in steps of their number: no two give the same sequence
        frame["sequence_id"] = places * shares + int(frame["share"].iloc[0]) if len(frame) else places
        frame["offset"] = offsets
        return frame.drop(columns=["share", "row"])

    packed = (
        rest.withColumn(
            "share", F.pmod(F.xxhash64("row", "id", "piece", "length", "ids_crc32"), F.lit(shares)).cast("long")
        )
        .groupBy("share")
        .applyInPandas(pack_share, f"{PIECES}, sequence_id long, offset long")
    )
    alone = full.select(
        *cut.columns,
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(alone)
