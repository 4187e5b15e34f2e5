import random

from pactframe.llm.components import connected_components


def test_components_of_chains_stars_and_loops(session):
    source = random.Random(4)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(10, 40)]
    edges += [(3, 3), (5, 4), (4, 5), (None, 1)] + [(200 + source.randrange(40), 240 + source.randrange(40)) for _ in range(30)]
    frame = session.createDataFrame(edges, "a long, b long")
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    expected = {(x, root(x)) for x in list(parent)}
    assert {tuple(r) for r in connected_components(frame).collect()} == expected


def test_no_edges(session):
    assert connected_components(session.createDataFrame([], "a long, b long")).collect() == []
