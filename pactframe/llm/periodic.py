"""Periodic runs: stretches of words that repeat with some period, found in tiles of all scales.

Words are maximal runs of bytes that are no ASCII white space. A run is a stretch of words with smallest period
q (words q apart are equal) that has at least `least_words` words and `least_repeats` times q of them, and
that no neighbouring word extends.

Periods are taken by octave: `low` to `2 * low - 1`. For each octave a document is laid out in tiles of about
`TILE * low` words that overlap by `4 * low`, so that each part of a run that one tile misses is whole in
the next. Tiles are rows, dealt over all tasks whatever document they come from. A tile is solved by itself: at
every `low`-th word a boundary is set, and Z-functions of the words to its right and, read backwards, to
its left tell for every period of the octave how far the repetition goes both ways. What is found are
fragments; they are shuffled by document and period and those that overlap by a period are stitched.

Most tiles hold no run. In a run of period q each group of `gram` words but the first q stands again at most
q words after its last occurrence. Only tiles that meet a long enough stretch of such groups are made.
This drops no run.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, col, slices, written

TILE = 16  # words of a tile by the least period of its octave
LEAST_TILE = 256
TILES = "array<struct<low:int,start:long,words:binary>>"
RUNS = "array<struct<start:long,length:long,period:long>>"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def word_ids(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words of this text."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(word, len(seen)) for word in words], np.int32)


def group_distances(ids: np.ndarray, gram: int) -> np.ndarray:
    """For each group of `gram` words how far back the same group stood last; a large number if never.

    Groups are compared by hash; two with one hash only make a tile that holds no run.
    """
    n = len(ids) - gram + 1
    hashes = np.zeros(n, np.uint64)
    for k in range(gram):
        hashes = hashes * MULTIPLIER + ids[k : k + n].astype(np.uint64) + np.uint64(1)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    distances = np.full(n, np.iinfo(np.int64).max)
    distances[order[1:][same]] = (order[1:] - order[:-1])[same]
    return distances


def stretches(near: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Ranges of at least `least` consecutive true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], near.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def tiles_of(ids: np.ndarray, least_words: int, least_repeats: int) -> list[tuple[int, int, np.ndarray]]:
    """Tiles (least period, first word, words) that hold every run of a text."""
    n = len(ids)
    spare = -(-least_words * (least_repeats - 1) // least_repeats)  # a run has at least so many words after one period
    gram = max(1, spare // 2)
    if n < max(least_words, gram + 1):
        return []
    distances = group_distances(ids, gram)
    out, low = [], 1
    if distances.min() >= n:
        return out
    while low * least_repeats <= n:
        need = max(spare, (least_repeats - 1) * low) - gram + 1
        overlap = max(4 * low, least_words)
        width = max(TILE * low, LEAST_TILE, 2 * overlap)
        step, least = width - overlap, max(2 * low, least_words)
        regions: list[list[int]] = []
        for first, last in stretches(distances < 2 * low, need):
            start, end = max(0, first - 2 * low + 1), min(n, last + gram - 1)
            if regions and start <= regions[-1][1]:
                regions[-1][1] = end
            else:
                regions.append([start, end])
        count = max(1, -(-(n - overlap) // step))
        for start, end in regions:
            for tile in range(max(0, -(-(start - width + 1) // step)), min(count, (end - 1) // step + 1)):
                a, b = max(start, tile * step), min(end, tile * step + width)
                if b - a >= least:
                    out.append((low, a, ids[a:b]))
        low *= 2
    return out


def z_function(words: list[int], upto: int) -> list[int]:
    """For each of the first `upto` places how many words from there on repeat the start."""
    n = len(words)
    z, left, right = [n] + [0] * (upto - 1), 0, 0
    for i in range(1, upto):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right or i >= right:
            while k + i + 64 <= n and words[k : k + 64] == words[i + k : i + k + 64]:
                k += 64
            while i + k < n and words[k] == words[i + k]:
                k += 1
            if i + k > right:
                left, right = i, i + k
        z[i] = k
    return z


def is_power(block: list[int]) -> bool:
    """Whether a block of words is a shorter one several times over."""
    n = len(block)
    rest, divisor = n, 2
    while rest > 1:
        if divisor * divisor > rest:
            divisor = rest
        if rest % divisor:
            divisor += 1
            continue
        while rest % divisor == 0:
            rest //= divisor
        part = n // divisor
        if block[:-part] == block[part:]:
            return True
    return False


def solve_tile(words: list[int], low: int, least_words: int) -> list[tuple[int, int, int]]:
    """Fragments (period, start, end) of a tile: stretches with a smallest period of the octave, as far
    as they go within the tile, of at least two periods and `least_words` words."""
    n, found = len(words), []
    for boundary in range(0, n - low + 1, low):
        ahead = words[boundary:]
        periods = range(low, min(2 * low, len(ahead) + 1))
        right = z_function(ahead, min(2 * low, len(ahead)))
        # Backwards: how far the words before the boundary repeat those before boundary + period.
        behind = words[max(0, boundary - low) : boundary][::-1]
        near = words[boundary : boundary + 2 * low - 1][::-1]
        left = z_function(behind + [-1] + near, len(behind) + 1 + len(near))[len(behind) + 1 :]
        for period in periods:
            to_left = left[len(near) - period] if behind and period <= len(near) else 0
            if to_left >= low:
                continue  # the boundary before this one finds it
            end = boundary + period + (right[period] if period < len(right) else 0)
            start = boundary - to_left
            if end - start >= max(2 * period, least_words) and not is_power(words[start : start + period]):
                found.append((period, start, end))
    return found


def collapsed(words: list[bytes], runs: list[dict]) -> bytes:
    """The words, joined by spaces, without those that follow the first period of a run."""
    depth = np.zeros(len(words) + 1, np.int64)
    for run in runs:
        depth[run["start"] + run["period"]] += 1
        depth[run["start"] + run["length"]] -= 1
    return b" ".join(compress(words, (np.cumsum(depth)[:-1] == 0).tolist()))


def _marked(rows: DataFrame, least_words: int, least_repeats: int) -> DataFrame:
    """`id, n_words, text, tiles`; a text without tiles comes with its words joined by spaces."""
    tile = pa.struct([("low", pa.int32()), ("start", pa.int64()), ("words", pa.binary())])
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("text", pa.binary()), ("tiles", pa.list_(tile))])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for first, last in slices(texts):
                counts, bodies, tiles = [], [], []
                for text in texts[first:last]:
                    words = text.split()  # of bytes: at ASCII white space
                    made = tiles_of(word_ids(words), least_words, least_repeats)
                    counts.append(len(words))
                    bodies.append(text if made else b" ".join(words))
                    tiles.append([{"low": low, "start": start, "words": w.tobytes()} for low, start, w in made])
                yield batch_of(schema, ids.slice(first, last - first), counts, bodies, tiles)

    return rows.mapInArrow(mark, f"id long, n_words long, text binary, tiles {TILES}")


def _fragments(tiles: DataFrame, least_words: int) -> DataFrame:
    """`row, period, start, end` of the fragments of all tiles."""
    schema = pa.schema([("row", pa.int64()), ("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(name).to_pylist() for name in ("row", "low", "start", "words")]
            for row, low, first, words in zip(*columns, strict=True):
                found = solve_tile(np.frombuffer(words, np.int32).tolist(), low, least_words)
                out += [(row, period, first + start, first + end) for period, start, end in found]
            if out:
                yield batch_of(schema, *zip(*out, strict=True))

    return tiles.mapInArrow(solve, "row long, period long, start long, end long")


def stitched(fragments: DataFrame, least_words: int, least_repeats: int) -> DataFrame:
    """`row, start, length, period` of whole runs: fragments of one period that share a period's words
    are parts of one run."""
    in_order = Window.partitionBy("row", "period").orderBy("start", "end")
    reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    parts = fragments.distinct().withColumn("new", (reached.isNull() | (F.col("start") + F.col("period") > reached)).cast("int"))
    runs = (
        parts.withColumn("number", F.sum("new").over(in_order))
        .groupBy("row", "period", "number")
        .agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"))
    )
    long = (F.col("length") >= least_words) & (F.col("length") >= least_repeats * F.col("period"))
    return runs.where(long).select("row", "start", "length", "period")


def periodic_runs(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    least_words: int = 24,
    least_repeats: int = 3,
) -> DataFrame:
    """`id, n_words, runs, collapsed` for every row of `df`.

    `runs` has `start, length, period` of every run by start, then period; `collapsed` are the words, joined by one
    space, but those that any run contains after its first period. Null and empty texts have no words; ids may
    be null or repeat, each row is treated by itself; an empty table gives no rows; other columns are not read.
    A text of any length is cut into tiles in one task, in memory that grows with it; the search in its tiles
    is spread. `least_repeats` is 2 at least.
    """
    if least_repeats < 2 or least_words < 2:
        raise ValueError("a run has two periods and two words at least")
    rows = df.select(
        col(id_col).cast("long").alias("id"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    marked = _marked(rows, least_words, least_repeats)
    # Few texts have tiles; they are written, as they are needed twice, and numbered as they are.
    chosen = written(
        marked.where(F.size("tiles") > 0).withColumn("row", F.monotonically_increasing_id()), "tiled"
    )
    tiles = chosen.select("row", F.explode("tiles").alias("tile")).select("row", "tile.*")
    # As many parts as the session has: tiles are small, but take long.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fragments = _fragments(tiles.repartition(parts, "row", "low", "start"), least_words)
    runs = (
        stitched(fragments, least_words, least_repeats)
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("found"))
    )
    ordered = F.transform("found", lambda r: F.struct(r["start"], r["length"], r["period"]))
    chosen = chosen.drop("tiles").join(runs, "row", "left").select(
        "id", "n_words", "text",
        F.coalesce(ordered, F.array()).cast(RUNS).alias("runs"),
    )
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.binary())])

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            bodies = [collapsed(text.split(), own) for text, own in zip(texts, found, strict=True)]
            yield batch_of(schema, batch.column(0), batch.column(1), found, bodies)

    whole = chosen.mapInArrow(collapse, f"id long, n_words long, runs {RUNS}, collapsed binary")
    plain = marked.where(F.size("tiles") == 0).select(
        "id", "n_words", F.array().cast(RUNS).alias("runs"), F.col("text").alias("collapsed")
    )
    return plain.unionByName(whole).withColumn("collapsed", F.col("collapsed").cast("string"))
