import numpy as np
import pytest

from pactframe.llm import vector_dedup as v


def brute(rows, threshold=0.95):
    units = []
    for i, x in rows:
        usable = i is not None and x and all(c is not None and np.isfinite(c) for c in x) and any(x)
        scaled = np.array(x) / np.abs(x).max() if usable else None
        units.append(scaled / np.linalg.norm(scaled) if usable else None)
    links = {k: set() for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if units[a] is not None and units[b] is not None and units[a] @ units[b] >= threshold:
                links[a].add(b)
                links[b].add(a)
    out = []
    for k, (i, _) in enumerate(rows):
        reach, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        least = min((rows[x][0] for x in reach), key=lambda x: (x is None, x))
        out.append((i, len(links[k]), least, i == least))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame_of(session, rows):
    data = [(i, x, "clash", 3) for i, x in rows]
    return session.createDataFrame(data, "vec_id long, embedding array<double>, unit string, rep int")


def clustered(seed, groups, each, noise, dims=16):
    source = np.random.default_rng(seed)
    centres = source.normal(size=(groups, dims))
    rows = []
    for g in range(groups):
        for k in range(each):
            rows.append((g * each + k, (centres[g] + source.normal(size=dims) * noise).tolist()))
    return rows


def test_odd_vectors(session):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0] * 4), (4, [1.0, None, 0.0, 0.0]), (5, [nan, 1.0, 0.0, 0.0]), (6, [inf, 1.0, 0.0, 0.0]),
        (7, [1.0, 2.0, 3.0, 4.0]), (8, [2.0, 4.0, 6.0, 8.0]), (9, [1.0, 2.0, 3.0, 4.0]), (9, [1.0, 2.0, 3.0, 4.0]),
        (None, [1.0, 2.0, 3.0, 4.0]), (10, [-1.0, -2.0, -3.0, -4.0]), (11, [1e300, 2e300, 3e300, 4e300]), (12, [4.0, 3.0, 2.0, 1.0]),
    ]
    assert found(v.near_vectors(frame_of(session, rows))) == brute(rows)


def test_groups_against_all_pairs(session):
    rows = clustered(1, 60, 8, 0.1) + [(1000 + k, x) for k, x in clustered(2, 200, 1, 0.0)]
    settings = v.GraphSettings(shard_rows=100)
    assert found(v.near_vectors(frame_of(session, rows), settings=settings)) == brute(rows)


def test_one_dense_group_split_over_shards(session):
    rows = clustered(3, 1, 300, 0.08) + [(1000 + k, x) for k, x in clustered(4, 100, 1, 0.0)]
    settings = v.GraphSettings(shard_rows=60, most_cells=3)
    assert found(v.near_vectors(frame_of(session, rows), settings=settings)) == brute(rows)


def test_empty_table_and_no_usable_vector(session):
    assert v.near_vectors(frame_of(session, [])).collect() == []
    assert found(v.near_vectors(frame_of(session, [(1, None), (2, None)]))) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_recall_of_the_search_alone():
    rows = clustered(5, 40, 25, 0.12, 32)
    units = v.matrix_of([(np.array(x) / np.linalg.norm(x)).tobytes() for _, x in rows], 32)
    settings = v.GraphSettings()
    graph = v.padded(v.shard_graph(units, settings))
    assert graph.shape[1] <= 3 * settings.degree
    short = units.astype(np.float32)
    q, x = v.range_search(short, short, graph, [0], settings)
    got = set(zip(q.tolist(), x.tolist(), strict=True))
    true = set(zip(*(k.tolist() for k in np.nonzero(units @ units.T >= 0.95)), strict=True))
    assert len(true & got) >= 0.99 * len(true)


@pytest.mark.parametrize("drop", [0.0, 1.0])
def test_audit_sees_what_is_missing(session, drop):
    rows = clustered(6, 30, 5, 0.05)
    units = [(i, bytearray((np.array(x) / np.linalg.norm(x)).tobytes())) for i, x in rows]
    reps = session.createDataFrame(units, "rep long, unit binary")
    linked = [(i, [] if drop else [(i // 5 * 5 + k, 1) for k in range(5) if i // 5 * 5 + k != i]) for i, _ in rows]
    links = session.createDataFrame(linked, "rep long, linked array<struct<others:long,sizes:long>>")
    assert v.audited_recall(reps, links, 16, v.GraphSettings()) == 1.0 - drop


def test_groups_of_a_dense_cell_are_bounded_and_hold_each_pair_once(session):
    rows = clustered(7, 1, 400, 0.01)
    units = [(i, 1, bytearray((np.array(x) / np.linalg.norm(x)).tobytes())) for i, x in rows]
    reps = session.createDataFrame(units, "rep long, size long, unit binary")
    centroids = np.frombuffer(units[0][2])[None, :]
    placed = v._assigned(reps, centroids, np.array([8]), 1)
    groups = {}
    for r in placed.collect():
        groups.setdefault((r["low"], r["high"]), {}).setdefault(r["shard"], []).append(r["rep"])
    assert len(groups) == 8 * 9 // 2 and max(sum(map(len, g.values())) for g in groups.values()) <= 200
    pairs = []
    for (low, high), group in groups.items():
        pairs += [tuple(sorted((a, b))) for a in group[low] for b in group[high] if low != high or a < b]
    assert len(pairs) == len(set(pairs)) == 400 * 399 // 2
    told = v._searched(placed, 16, v.GraphSettings())
    assert not [f for f in told.schema if f.dataType.typeName() == "array"]
    assert [r["n"] for r in told.groupBy("rep").agg({"pairs": "sum"}).toDF("rep", "n").collect()] == [399] * 400


def test_links_in_several_shared_cells_count_once(session):
    rows = clustered(8, 12, 20, 0.08)
    assert found(v.near_vectors(frame_of(session, rows), settings=v.GraphSettings(shard_rows=30, overlap=4))) == brute(rows)


def test_low_recall_of_the_last_attempt_is_an_error(session, monkeypatch):
    asked = []
    monkeypatch.setattr(v, "audited_recall", lambda *a: asked.append(1) or 0.89)
    rows = clustered(9, 5, 4, 0.05)
    with pytest.raises(RuntimeError, match="recall 0.8900"):
        v.near_vectors(frame_of(session, rows), settings=v.GraphSettings(attempts=2))
    assert len(asked) == 2


def test_last_attempt_compares_in_full(session, monkeypatch):
    def nothing(*_):
        raise AssertionError("the graph is not needed")

    monkeypatch.setattr(v, "shard_graph", nothing)
    rows = clustered(10, 20, 6, 0.08)
    assert found(v.near_vectors(frame_of(session, rows), settings=v.GraphSettings(attempts=1))) == brute(rows)


def test_audit_goes_on_where_links_are_rare(session):
    rows = clustered(11, 300, 1, 0.0) + [(1000 + k, x) for k, x in clustered(12, 3, 2, 0.01)]
    units = [(i, bytearray((np.array(x) / np.linalg.norm(x)).tobytes())) for i, x in rows]
    reps = session.createDataFrame(units, "rep long, unit binary")
    nothing = session.createDataFrame([], "rep long, pairs long")
    assert v.audited_recall(reps, nothing, 16, v.GraphSettings(audit=31)) == 0.0


def test_ids_on_several_vectors(session):
    """Rows of one id and different vectors are counted each for itself; components have the least id."""
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (5, [-1.0, 0.0]), (4, [-1.0, 0.01]), (5, [-1.0, 0.02])]
    assert found(v.near_vectors(frame_of(session, rows))) == brute(rows)
    again = [(i % 7, x) for i, x in clustered(3, 12, 6, 0.02)]
    assert found(v.near_vectors(frame_of(session, again))) == brute(again)


def test_what_the_driver_gets_does_not_grow_with_partitions(session):
    df = session.range(20_000).selectExpr("id AS rep", "encode(CAST(id AS string), 'utf-8') AS unit").repartition(50)
    chosen = v.least_hashed(df, "rep", 100, 20_000)
    assert sorted(r["rep"] for r in chosen.collect()) == sorted(
        r["rep"] for r in df.orderBy(v.F.xxhash64("rep"), "rep").limit(100).collect()
    )
    plan = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "xxhash64" in plan.split("Filter")[1]
    low = df.where(v.F.xxhash64("rep") < int(-(2**63) + 2**64 * 200 / 20_000)).count()
    assert 100 <= low < 300
    assert v.least_hashed(df.limit(5), "rep", 100, 5).count() == 5


def test_links_come_from_the_search(session, monkeypatch):
    """Nothing is compared in full before the last attempt, and the search alone finds what is planted."""

    def nothing(*_):
        raise AssertionError("all pairs compared")

    audits = []
    audited = v.audited_recall
    monkeypatch.setattr(v, "audited_recall", lambda *a: audits.append(a) or 1.0)
    monkeypatch.setattr(v, "reaches", nothing)
    rows = clustered(13, 150, 9, 0.08) + [(5000 + k, x) for k, x in clustered(14, 700, 1, 0.0)]
    settings = v.GraphSettings(shard_rows=150, most_cells=12)
    got, true = found(v.near_vectors(frame_of(session, rows), settings=settings)), brute(rows)
    assert len(audits) == 1 and got == true
    with pytest.raises(Exception, match="all pairs compared"):
        v.near_vectors(frame_of(session, rows), settings=v.GraphSettings(attempts=1)).collect()
    monkeypatch.undo()
    assert audited(*audits[0]) == 1.0


def test_nothing_below_the_threshold_links():
    """One formula decides, in both directions and in every path, without slack."""
    source = np.random.default_rng(15)
    a = source.normal(size=(400, 24))
    b = a * 0.95 / np.linalg.norm(a, axis=1, keepdims=True)
    side = source.normal(size=a.shape)
    side -= a * (side * a).sum(axis=1, keepdims=True) / (a * a).sum(axis=1, keepdims=True)
    b += side * np.sqrt(1 - 0.95**2) / np.linalg.norm(side, axis=1, keepdims=True)
    units = np.concatenate([a, b])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    rows, others = np.arange(400), np.arange(400, 800)
    exact = v.cosines(units, units, rows, others)
    assert (exact == v.cosines(units, units, others, rows)).all()
    assert 0 < (exact >= 0.95).sum() < 400 and np.abs(exact - 0.95).max() < 1e-12
    assert (v.reaches(units, units, 0.95)[rows, others] == (exact >= 0.95)).all()
    found = np.ones((800, 800), bool)
    every = np.arange(800)
    _, _, pairs = v.linked_in_group(
        found, every, every, units, np.ones(800, np.int64), np.zeros((800, 1), np.int64), 0, v.GraphSettings()
    )
    assert (found[rows, others] == (exact >= 0.95)).all() and (found == found.T).all()
    assert pairs.sum() == found.sum()
