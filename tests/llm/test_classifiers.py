import random
import zlib

import numpy as np
import pytest

from pactframe.llm import linear
from pactframe.llm.quality import quality_scores
from pactframe.llm.toxicity import toxicity_scores

from .conftest import ODD_ROWS


def labelled(count=300, seed=1):
    source = random.Random(seed)
    words = [f"wo{source.randrange(400)}rd" for _ in range(300)]
    rows, labels = [], []
    for k in range(count):
        text = [source.choice(words) for _ in range(40)]
        good = k % 2
        if not good:
            text[source.randrange(40)] = "nasty***"
        rows.append((k, " ".join(text)))
        labels.append((k, good, 1 - good))
    return rows, labels


@pytest.mark.parametrize(("scores", "sign"), [(quality_scores, 1), (toxicity_scores, 0)])
def test_learns_and_generalises(session, docs, scores, sign):
    rows, labels = labelled()
    known = session.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = scores(docs(rows), known, learn=linear.F.col("id") < 200).collect()
    held = [r for r in found if r["id"] >= 200]
    right = [r["predicted"] == (r["id"] % 2 if sign else 1 - r["id"] % 2) for r in held]
    assert len(found) == len(rows) and np.mean(right) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)


def test_odd_rows_are_scored_and_copies_alike(session, docs):
    rows, labels = labelled(60)
    known = [*labels, (None, 1, 1), (1, None, None), (2, 7, 7), (99_999, 1, 0)]
    frame = session.createDataFrame(known, "doc_id long, quality int, toxic int")
    odd = [(1000 + i if i is not None else None, t) for i, t in ODD_ROWS]
    for scores in (quality_scores, toxicity_scores):
        found = scores(docs(rows + odd), frame).collect()
        assert len(found) == len(rows) + len(odd)
        assert len({r["score"] for r in found if r["id"] == 1006}) == 1


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(777, 1, 1), (778, 0, 0)]])
def test_without_both_classes_every_score_is_even(session, docs, labels):
    known = session.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = quality_scores(docs(ODD_ROWS), known).collect()
    assert {(r["score"], r["predicted"]) for r in found} == {(0.5, 1)} and len(found) == len(ODD_ROWS)


def test_empty_table(session, docs):
    known = session.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity_scores(docs([]), known).collect() == []


def test_dual_coordinate_descent_reaches_the_optimum():
    source = np.random.default_rng(4)
    x = source.normal(size=(60, 5))
    y = np.where(x @ np.array([1.0, -2, 0, 0.5, 0]) + source.normal(size=60) > 0, 1.0, -1.0)
    rows = [np.arange(5)] * 60
    w, bias = linear.dual_coordinate_descent(rows, list(x), y, 5, np.full(60, 0.5), 3000, 1e-9)

    def loss(w, bias):
        return 0.5 * (w @ w + bias**2) + 0.5 * np.maximum(0, 1 - y * (x @ w + bias)).sum()

    best = loss(w, bias)
    for _ in range(300):
        step = source.normal(size=6) * source.choice([1e-3, 1e-2, 0.1])
        assert loss(w + step[:5], bias + step[5]) >= best - 1e-6


def test_features_are_distinct_and_cover_whole_texts():
    features = linear.Features(linear.ClassifierSettings(words=(1, 2)))
    long = features.of("abc " * 50_000 + "zzz")
    assert len(set(long.tolist())) == len(long)
    assert set(features.of("zzz").tolist()) & set(long.tolist())
    assert set(features.of("c zzz").tolist()) <= set(long.tolist()) | set(features.of("c").tolist()) | set(features.of("c zzz").tolist())
    assert len(features.of("")) == 0


def test_labels_of_held_out_rows_do_not_matter(session):
    from pactframe.llm.queries import op3_quality, op8_toxicity

    from .conftest import SMALL

    for query, of, at in ((op3_quality, 3, 1), (op8_toxicity, 5, 0)):
        rows = query(session, SMALL).collect()
        assert len(rows) == 200
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % of == at) for r in rows)


@pytest.mark.parametrize(("name", "of", "at", "least"), [("quality", 3, 1, 0.85), ("toxic", 5, 0, 0.85)])
def test_held_out_accuracy(session, name, of, at, least):
    from pactframe.llm.queries import op3_quality, op8_toxicity

    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r[name] for r in session.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = {"quality": op3_quality, "toxic": op8_toxicity}[name](session, folder).collect()
    right = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(right) > 40 and np.mean(right) >= least


def test_the_sample_is_bounded_in_rows_and_characters(session, docs):
    from dataclasses import replace

    rows = [(1, f"copy {k} of the id") for k in range(300)] + [(k, f"text {k} " * 20) for k in range(2, 60)]
    known = session.createDataFrame([(k, k % 2) for k in range(1, 60)], "doc_id long, quality int")
    settings = replace(linear.ClassifierSettings(), sample_per_class=10)
    for bound in (100_000_000, 1500):
        some = replace(settings, sample_characters=bound)
        sample = linear.training_sample(docs(rows), known, "doc_id", "text", "doc_id", "quality", None, some).collect()
        for label in (0, 1):
            texts = [r["text"] for r in sample if r["label"] == label]
            assert 0 < len(texts) <= 10 and sum(map(len, texts)) <= bound / 2


def plain_model(texts, labels, settings):
    """Features, ratios and scores written out in plain Python; the weights of the hinge loss are the solver's,
    which has a test of its own."""
    features = linear.Features(settings)
    order = sorted(range(len(texts)), key=lambda k: (texts[k], labels[k]))
    rows = [sorted(set(features.of(texts[k]).tolist())) for k in order]
    signs = [labels[k] for k in order]
    seen = {0: {}, 1: {}}
    for row, label in zip(rows, signs):
        for place in row:
            seen[label][place] = seen[label].get(place, 0) + 1
    total = {
        label: sum(settings.smoothing + seen[label].get(p, 0) for p in range(settings.dimensions)) for label in (0, 1)
    }

    def ratio(place):
        one, other = ((settings.smoothing + seen[label].get(place, 0)) / total[label] for label in (1, 0))
        return np.log(one / other)

    def values(row):
        x = np.array([ratio(p) for p in row])
        return x if settings.damping is None else x / np.sqrt(settings.damping + (x * x).sum())

    costs = np.full(len(rows), float(settings.cost))
    if settings.balanced:
        costs *= [len(signs) / 2 / signs.count(label) for label in signs]
    weights, bias = linear.dual_coordinate_descent(
        [np.array(r) for r in rows], [values(r) for r in rows], np.where(np.array(signs) == 1, 1.0, -1.0),
        settings.dimensions, costs, settings.rounds, settings.tolerance,
    )

    def score(text):
        row = sorted(set(features.of(text).tolist()))
        margin = float(sum(w * v for w, v in zip(weights[row], values(row)))) + bias if row else bias
        return 1 / (1 + np.exp(-settings.steepness * margin))

    return score


@pytest.mark.parametrize("module", ["quality", "toxicity"])
def test_scores_against_ratios_in_plain_python(session, docs, module):
    from dataclasses import replace
    from importlib import import_module

    settings = replace(import_module(f"pactframe.llm.{module}").SETTINGS, dimensions=1 << 12)
    rows, labels = labelled(80)
    column = {"quality": 1, "toxicity": 2}[module]
    known = session.createDataFrame([(r[0], r[column]) for r in labels], "doc_id long, y int")
    scores = {"quality": quality_scores, "toxicity": toxicity_scores}[module]
    found = {r["id"]: r["score"] for r in scores(docs(rows), known, label_col="y", learn=linear.F.col("id") < 50, settings=settings).collect()}
    plain = plain_model([t for k, t in rows if k < 50], [r[column] for r in labels if r[0] < 50], settings)
    assert max(abs(found[k] - plain(t)) for k, t in rows) < 1e-3
