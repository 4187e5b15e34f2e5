"""Near duplicates among vectors, by range search in a flat graph built on overlapping shards.

1. Equal directions collapse into one row.
2. Centroids fitted on a bounded sample cut space into cells; every vector goes to its `overlap` nearest.
   Large cells are split at random into shards of bounded size.
3. Each shard gets a graph of robust-pruned neighbour lists. The lists of a vector from all
   its shards are united.
4. Each two shards of a cell are a group, of bounded size. Its graph has all edges of the united lists that stay
   in the group. Every vector of it searches greedily from the medoids, with a beam; from then on everything in range is
   expanded, its own node too, until nothing new is in range.
5. The pairs found, and no others, are verified by cosine in double precision. A link
   counts in the first cell that both vectors share; numbers of links and roots leave the group, not pairs. Recall of
   the search is audited against brute force for a sample of queries over all rows; below the target the search is run
   again, wider; only the last attempt compares each group in full. A result below the recall required is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, col, written
from .components import connected_components


@dataclass(frozen=True)
class GraphSettings:
    """`sample` rows fit at most `most_cells` centroids (the broadcast is that large at most);
    a shard holds about `shard_rows` vectors; `degree` bounds a neighbour list, `alpha` slackens
    pruning; `beam` is the width of the search. Recall is measured on `audit` queries, or on ten times as many if
    these have fewer than `audit_links` true links; below `recall` the search is run again, wider, and the last
    of `attempts` compares all vectors of each group. Below `required` after that an error is raised."""

    threshold: float = 0.95
    overlap: int = 3
    shard_rows: int = 2048
    most_cells: int = 1024
    sample: int = 8192
    candidates: int = 64
    degree: int = 24
    alpha: float = 1.2
    beam: int = 24
    audit: int = 200
    audit_links: int = 100
    recall: float = 0.98
    required: float = 0.9
    attempts: int = 3


def unit_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """`id, unit` with the vector scaled to length one as packed doubles, null if it is null,
    empty, zero or holds a null or non-finite component."""
    schema = pa.schema([("id", pa.int64()), ("unit", pa.binary())])

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.column(1):
                vector = np.array(row.as_py() if row.is_valid else [], dtype=np.float64)
                with np.errstate(all="ignore"):
                    largest = np.abs(vector).max(initial=0.0)
                    scaled = vector / largest
                    usable = len(vector) and 0 < largest < np.inf and np.isfinite(scaled).all()
                out.append((scaled / np.sqrt(scaled @ scaled)).tobytes() if usable else None)
            yield batch_of(schema, batch.column(0), out)

    rows = df.select(col(id_col).cast("long").alias("id"), col(vector_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(unit, "id long, unit binary")


def matrix_of(packed: list[bytes], width: int) -> np.ndarray:
    """Rows of packed doubles; shorter ones count as filled up with zeros."""
    out = np.zeros((len(packed), width))
    for k, row in enumerate(packed):
        vector = np.frombuffer(row)
        out[k, : len(vector)] = vector
    return out


def fit_centroids(sample: np.ndarray, cells: int) -> np.ndarray:
    """Spherical k-means on the sample."""
    picks = np.random.Generator(np.random.PCG64(3)).permutation(len(sample))[:cells]
    centroids = sample[picks]
    for _ in range(6):
        nearest = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 0, sums / np.maximum(length, 1e-12), centroids)
    return centroids


def robust_prune(order: np.ndarray, near: np.ndarray, among: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours kept from candidates in order of distance: one is dropped if a kept one is
    `alpha` times nearer to it than the point is. `near`, `among`: distances from the point and
    between candidates."""
    alive = np.ones(len(order), bool)
    kept = []
    for k in range(len(order)):
        if alive[k]:
            kept.append(k)
            if len(kept) == degree:
                break
            alive &= alpha * among[k] > near
    return order[kept]


def shard_graph(units: np.ndarray, settings: GraphSettings) -> list[np.ndarray]:
    """Neighbour lists of a shard, with the edges back."""
    count = len(units)
    units = units.astype(np.float32)
    random = np.random.Generator(np.random.PCG64(11))
    nearest = min(settings.candidates, count - 1)
    lists: list[list[int]] = [[] for _ in range(count)]
    for low in range(0, count, 512):
        similar = units[low : low + 512] @ units.T
        rows = np.arange(len(similar))
        similar[rows, rows + low] = -2.0
        if nearest <= 0:
            continue
        best = np.argpartition(-similar, nearest - 1, axis=1)[:, :nearest]
        far = random.integers(0, count, (len(similar), 8))  # long edges keep the graph connected
        for k in range(len(similar)):
            order = np.unique(np.concatenate([best[k], far[k][far[k] != low + k]]))
            order = order[np.argsort(-similar[k, order], kind="stable")]
            own = units[order]
            kept = robust_prune(
                order, 1.0 - similar[k, order], 1.0 - own @ own.T, settings.degree, settings.alpha
            )
            lists[low + k] += kept.tolist()
            for other in kept.tolist():
                if len(lists[other]) < 2 * settings.degree:
                    lists[other].append(low + k)
    return [np.unique(np.array(x, np.int64)) for x in lists]


def padded(lists: list[np.ndarray]) -> np.ndarray:
    width = max([len(x) for x in lists], default=0)
    out = np.full((len(lists), max(width, 1)), -1, np.int64)
    for k, x in enumerate(lists):
        out[k, : len(x)] = x
    return out


def cosines(a: np.ndarray, b: np.ndarray, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The cosine of each row of `a` and the one of `b` beside it, in double precision, in bounded work space. The
    one formula that decides at the threshold; it is the same in both directions."""
    out = np.empty(len(rows))
    step = max(1, 2_000_000 // a.shape[1])
    for low in range(0, len(rows), step):
        part = slice(low, low + step)
        out[part] = np.einsum("ij,ij->i", a[rows[part]], b[others[part]])
    return out


def reaches(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """For which rows of `a` and `b` the cosine reaches the threshold, all compared."""
    similar = a @ b.T
    out = similar >= threshold
    rows, others = np.nonzero(np.abs(similar - threshold) < 1e-9)
    out[rows, others] = cosines(a, b, rows, others) >= threshold
    return out


def range_search(
    queries: np.ndarray,
    units: np.ndarray,
    graph: np.ndarray,
    entries: list[int],
    settings: GraphSettings,
    own: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) found at or above the threshold, less a little slack, by single precision.

    The search starts at `entries`. `own` is the node that each query is itself; it is in range, and is expanded like
    all that is."""
    count, beam = len(queries), settings.beam
    reach = np.float32(settings.threshold - 1e-5)
    seen = np.zeros((count, len(units)), bool)
    rows = np.arange(count)[:, None]
    seen[:, entries] = True
    ids = np.full((count, beam), -1, np.int64)
    score = np.full((count, beam), -2.0, np.float32)
    opened = np.ones((count, beam), bool)
    first = slice(0, len(entries))
    ids[:, first], score[:, first], opened[:, first] = entries, queries @ units[entries].T, False
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    q, v = np.nonzero(score[:, first] >= reach)
    hits.append((q, np.asarray(entries)[v]))

    def fresh(q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs not seen before, once each, with their similarity."""
        good = v >= 0
        q, v = q[good], v[good]
        good = ~seen[q, v]
        both = np.unique(q[good] * len(units) + v[good])
        q, v = both // len(units), both % len(units)
        seen[q, v] = True
        return q, v, np.einsum("ij,ij->i", queries[q], units[v])

    while True:
        open_score = np.where(opened, np.float32(-3.0), score)
        picks = np.argsort(-open_score, axis=1)[:, :4]
        valid = open_score[rows, picks] > -2.0
        if not valid.any():
            break
        q, place = np.nonzero(valid)
        place = picks[q, place]
        opened[q, place] = True
        around = graph[ids[q, place]]
        q, v, s = fresh(np.repeat(q, graph.shape[1]), around.ravel())
        near = s >= reach
        hits.append((q[near], v[near]))
        if not len(q):
            continue
        begins = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        rank = np.arange(len(q)) - np.repeat(begins, np.diff(np.r_[begins, len(q)]))
        width = int(rank.max()) + 1
        new_ids = np.full((count, width), -1, np.int64)
        new_score = np.full((count, width), -2.0, np.float32)
        new_ids[q, rank], new_score[q, rank] = v, s
        ids = np.concatenate([ids, new_ids], axis=1)
        score = np.concatenate([score, new_score], axis=1)
        opened = np.concatenate([opened, new_ids < 0], axis=1)
        best = np.argpartition(-score, beam - 1, axis=1)[:, :beam]
        ids, score, opened = ids[rows, best], score[rows, best], opened[rows, best]
    if own is not None:
        missed = np.flatnonzero(~seen[rows[:, 0], own])
        seen[missed, own[missed]] = True
        hits.append((missed, own[missed]))
    # Everything in range is expanded, and what it finds in range again.
    q, v = (np.concatenate(x) for x in zip(*hits, strict=True))
    while len(q):
        q, v, s = fresh(np.repeat(q, graph.shape[1]), graph[v].ravel())
        near = s >= reach
        q, v = q[near], v[near]
        hits.append((q, v))
    q, v = (np.concatenate(x) for x in zip(*hits, strict=True))
    return q, v


def _assigned(reps: DataFrame, centroids: np.ndarray, splits: np.ndarray | None, overlap: int) -> DataFrame:
    """Rows of `reps` in each of their cells. With `splits` (shards per cell) each row is a member of
    one `shard` of a cell and is sent to the groups of this shard with each of the cell's shards: a group
    (cell, low, high) holds two shards, or one if they are equal. `cells` are all of the row's, in order."""
    schema = pa.schema(
        [
            *((name, pa.int32()) for name in ("cell", "low", "high", "shard")),
            ("cells", pa.list_(pa.int32())), ("rep", pa.int64()), ("size", pa.int64()), ("unit", pa.binary()),
        ]
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("unit").to_pylist()
            similar = matrix_of(packed, centroids.shape[1]) @ centroids.T
            k = min(overlap, len(centroids))
            cells = np.sort(np.argsort(-similar, axis=1, kind="stable")[:, :k], axis=1)
            out = []
            for row, (rep, size) in enumerate(
                zip(batch.column("rep").to_pylist(), batch.column("size").to_pylist(), strict=True)
            ):
                own_cells = cells[row].tolist()
                for cell in own_cells:
                    if splits is None:
                        out.append((cell, 0, 0, 0, [], rep, size, b""))
                        continue
                    own = (rep * 0x9E3779B97F4A7C15 >> 20) % int(splits[cell])
                    for other in range(int(splits[cell])):
                        out.append((cell, min(own, other), max(own, other), own, own_cells, rep, size, packed[row]))
                        if len(out) >= 20_000:
                            yield batch_of(schema, *zip(*out, strict=True))
                            out = []
            if out:
                yield batch_of(schema, *zip(*out, strict=True))

    return reps.mapInArrow(
        assign, "cell int, low int, high int, shard int, cells array<int>, rep long, size long, unit binary"
    )


def shares_before(cell: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows of `a` and `b` (the cells of each vector) share a cell before this one."""
    out = np.zeros((len(a), len(b)), bool)
    for x in a.T:
        for y in b.T:
            out |= (x[:, None] == y[None, :]) & (x < cell)[:, None]
    return out


def linked_in_group(
    found: np.ndarray, q: np.ndarray, m: np.ndarray, units: np.ndarray, size: np.ndarray, cells: np.ndarray, cell: int,
    settings: GraphSettings,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`root, near, pairs` of all rows of a group whose two shards are the rows `q` and `m`: the least row
    joined with each by links, the number of rows behind its links and that of its links. `found` says which pairs
    the search has; those that hold in double precision are links, no others. A link is
    counted in the first cell that both vectors share. Work space is bounded."""
    count = len(units)
    root, near, pairs = np.arange(count), np.zeros(count, np.int64), np.zeros(count, np.int64)
    same = len(q) == len(m) and (q == m).all()
    if same:
        found |= found.T
        np.fill_diagonal(found, False)
    step = max(1, 1_000_000 // len(m))
    parts = [slice(low, low + step) for low in range(0, len(q), step)]
    parts = [part for part in parts if found[part].any()]
    for part in parts:
        asked, got = np.nonzero(found[part])
        false = cosines(units, units, q[part][asked], m[got]) < settings.threshold
        found[part][asked[false], got[false]] = False
    for part in parts:
        new = found[part] & ~shares_before(cell, cells[q[part]], cells[m])
        near[q[part]] += np.where(new, size[m][None, :], 0).sum(axis=1)
        pairs[q[part]] += new.sum(axis=1)
        if not same:
            near[m] += np.where(new, size[q[part]][:, None], 0).sum(axis=0)
            pairs[m] += new.sum(axis=0)
    while True:
        before = root.copy()
        for part in parts:
            own = q[part]
            root[own] = np.minimum(root[own], np.where(found[part], root[m][None, :], count).min(axis=1))
            root[m] = np.minimum(root[m], np.where(found[part], root[own][:, None], count).min(axis=0))
        root = root[root]
        if (root == before).all():
            return root, near, pairs


def _searched(placed: DataFrame, width: int, settings: GraphSettings, full: bool = False) -> DataFrame:
    """`rep, root, near, pairs` found in each group of two shards: the least vector joined with each over
    verified links, the number of rows behind the links that are counted here, and that of the links.
    With `full` the graph is left out and all vectors of a group are compared."""
    keys, told = ["cell", "low", "high"], "rep long, root long, near long, pairs long"

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rep", ignore_index=True)
        lists = shard_graph(matrix_of(frame["unit"].tolist(), width), settings)
        reps = frame["rep"].to_numpy()
        return pd.DataFrame({"rep": reps, "around": [reps[x] for x in lists]})

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rep", ignore_index=True)
        units = matrix_of(frame["unit"].tolist(), width)
        short = units.astype(np.float32)
        reps, size, shard = (frame[name].to_numpy() for name in ("rep", "size", "shard"))

        low, high = (np.flatnonzero(shard == frame[name].iloc[0]) for name in ("low", "high"))
        found = np.zeros((len(high), len(low)), bool)
        if full:
            step = max(1, 1_000_000 // max(1, len(low)))
            for start in range(0, len(high), step):
                part = slice(start, start + step)
                found[part] = reaches(units[high[part]], units[low], settings.threshold)
        elif len(low) and len(high):
            lists = []
            for around in frame["around"]:
                around = np.asarray(around, np.int64)
                at = np.minimum(np.searchsorted(reps, around), len(reps) - 1)
                lists.append(at[reps[at] == around])
            graph, every = padded(lists), np.arange(len(reps))
            shards = (low, high) if frame["low"].iloc[0] != frame["high"].iloc[0] else (low,)
            entries = [int(x[(short[x] @ short[x].mean(axis=0)).argmax()]) for x in shards]
            in_low, in_high = np.full(len(reps), -1), np.full(len(reps), -1)
            in_low[low], in_high[high] = np.arange(len(low)), np.arange(len(high))
            block = max(32, 4_000_000 // len(reps))
            for start in range(0, len(reps), block):
                part = every[start : start + block]
                q, v = range_search(short[part], short, graph, entries, settings, part)
                q = part[q]
                for x, y in ((q, v), (v, q)):
                    across = (in_high[x] >= 0) & (in_low[y] >= 0)
                    found[in_high[x[across]], in_low[y[across]]] = True
        cells = np.array(frame["cells"].tolist(), np.int64)
        root, near, pairs = linked_in_group(
            found, high, low, units, size, cells, int(frame["cell"].iloc[0]), settings
        )
        rows = np.flatnonzero((pairs > 0) | (root < np.arange(len(root))))
        return pd.DataFrame({"rep": reps[rows], "root": reps[root[rows]], "near": near[rows], "pairs": pairs[rows]})

    if full:
        return placed.groupBy(*keys).applyInPandas(search, told)
    members = placed.where("low = high")
    built = members.groupBy(*keys).applyInPandas(build, "rep long, around array<long>")
    united = built.groupBy("rep").agg(
        F.array_distinct(F.flatten(F.collect_list("around"))).alias("around")
    )
    rows = placed.join(united, "rep", "left")
    return rows.groupBy(*keys).applyInPandas(search, told)


def least_hashed(df: DataFrame, column: str, count: int, n: int) -> DataFrame:
    """The `count` rows of `df`, which has `n` rows, whose `column` has the least hashes.

    A bound on the hash leaves about twice as many rows in all partitions together, so what they send does
    not grow with their number.
    """
    share = 2 * count / max(n, 1)
    low = df if share >= 1 else df.where(F.xxhash64(column) < int(-(2**63) + share * 2**64))
    return low.orderBy(F.xxhash64(column), column).limit(count)


def audited_recall(reps: DataFrame, links: DataFrame, width: int, settings: GraphSettings) -> float:
    """Share of the true links of `settings.audit` queries, chosen by a hash of their id, that
    `links` has: `rep` with the number of its `pairs`, or with its partners, `linked`. What it has is verified, so
    numbers are compared. The queries, a bounded number, are compared with all rows in blocks. If they have fewer
    than `settings.audit_links` true links, ten times as many are asked."""
    queries = least_hashed(reps, "rep", 10 * settings.audit, reps.count()).select("rep", "unit").collect()
    pairs = F.size("linked") if "linked" in links.columns else F.col("pairs")
    schema = pa.schema([("rep", pa.int64()), ("true", pa.int64())])
    recall = 1.0
    for many in sorted({min(len(queries), settings.audit), len(queries)}):
        names = np.array([q["rep"] for q in queries[:many]], np.int64)
        matrix = matrix_of([bytes(q["unit"]) for q in queries[:many]], width)

        def compare(batches: Iterator[pa.RecordBatch], names=names, matrix=matrix) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                others = batch.column("rep").to_numpy()
                units = matrix_of(batch.column("unit").to_pylist(), width)
                for low in range(0, len(names), 200):
                    part = slice(low, low + 200)
                    near = reaches(matrix[part], units, settings.threshold) & (names[part, None] != others[None, :])
                    yield batch_of(schema, names[part], near.sum(axis=1))

        true = (
            reps.select("rep", "unit").mapInArrow(compare, "rep long, true long")
            .groupBy("rep").agg(F.sum("true").alias("true"))
        )
        asked = F.broadcast(reps.sparkSession.createDataFrame([(int(n),) for n in names], "rep long"))
        got = links.join(asked, "rep").groupBy("rep").agg(F.sum(pairs).alias("got"))
        both = true.join(got, "rep", "left").agg(
            F.sum("true").alias("total"), F.sum(F.least("true", F.coalesce("got", F.lit(0)))).alias("had")
        ).first()
        recall = both["had"] / both["total"] if both["total"] else 1.0
        if (both["total"] or 0) >= settings.audit_links:
            break
    return recall


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    settings: GraphSettings | None = None,
) -> DataFrame:
    """`id, n_links, component_id, kept` for every row of `df`.

    Rows are linked if the cosine of their vectors reaches the threshold. Null, empty and zero vectors and those with null or
    non-finite components link with nothing, and so do rows with a null id (their component is
    null). Shorter vectors count as filled up with zeros. Rows that repeat an id and a vector
    link with each other; rows of one id and different vectors are compared each for itself, and a component has
    the least id in it. An empty table gives no rows.
    Raises if the audited recall stays below `settings.required`.
    """
    settings = settings or GraphSettings()
    spark = df.sparkSession
    units = written(unit_vectors(df, id_col, vector_col), "units")
    usable = units.where("id IS NOT NULL AND unit IS NOT NULL")
    reps = written(
        usable.groupBy("unit").agg(F.min("id").alias("rep"), F.count("*").alias("size")), "directions"
    )
    # Only rows that repeat an id can give two directions one name; then they are numbered.
    numbered = not reps.groupBy("rep").count().where("count > 1").isEmpty()
    reps = reps.withColumn("first", F.col("rep"))
    if numbered:
        reps = written(reps.withColumn("rep", F.monotonically_increasing_id()), "numbered")
    facts = reps.agg(F.count("*").alias("n"), F.max(F.length("unit")).alias("bytes")).first()
    alone = F.lit(0).cast("long")
    if not facts["n"]:
        return units.select("id", alone.alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    width = facts["bytes"] // 8
    cells = max(1, min(settings.most_cells, -(-facts["n"] * settings.overlap // settings.shard_rows)))
    sample = least_hashed(reps, "unit", settings.sample, facts["n"]).select("unit").collect()
    centroids = fit_centroids(matrix_of([bytes(r["unit"]) for r in sample], width), cells)
    for attempt in range(settings.attempts):
        counts = _assigned(reps, centroids, None, settings.overlap).groupBy("cell").count().collect()
        splits = np.ones(len(centroids), np.int64)
        for row in counts:
            splits[row["cell"]] = -(-row["count"] // (2 * settings.shard_rows))
        placed = written(_assigned(reps, centroids, splits, settings.overlap), "placed")
        last = attempt + 1 == settings.attempts
        found = written(_searched(placed, width, settings, full=last), "links")
        links = found.groupBy("rep").agg(F.sum("near").alias("near"), F.sum("pairs").alias("pairs"))
        recall = audited_recall(reps, links, width, settings)
        if recall >= (settings.required if last else settings.recall):
            break
        if last:
            raise RuntimeError(f"near_vectors: recall {recall:.4f} is below {settings.required}; raise `overlap`")
        settings = replace(
            settings, beam=2 * settings.beam, overlap=settings.overlap + 1, degree=settings.degree + 8
        )
    counted = links.select("rep", "near")
    joined = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = (
        reps.join(counted, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "unit",
            (F.coalesce("near", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
            "first",
        )
    )
    if numbered:
        firsts = named.groupBy("component_id").agg(F.min("first").alias("first"))
        named = named.drop("first").join(firsts, "component_id").withColumn("component_id", F.col("first"))
    rest = units.where("id IS NULL OR unit IS NULL").select(
        "id", alone.alias("n_links"), F.col("id").alias("component_id")
    )
    out = usable.join(named, "unit").select("id", "n_links", "component_id").unionByName(rest)
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
