"""Linear text classifiers over hashed n-gram indicators scaled by naive Bayes log-count ratios.

The ratios come from the labelled sample, the linear model is fitted on the scaled indicators by
dual coordinate descent on the hinge loss, and scoring reads every text as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, col, id_and_text

EDGE = 0x110000  # stands between texts; no character has this number


@dataclass(frozen=True)
class ClassifierSettings:
    """Which n-grams are read, and how the model is fitted.

    `chars` and `words` are n-gram sizes; `repeats` adds indicators of one to three words said again
    1, 2, 4 or 8 times in a row; `dimensions` is the hashed feature space. At most
    `sample_per_class` labelled rows of each class, chosen by a hash of their id, are learnt from, half of
    `sample_characters` of each: that bounds the memory of the fit, whatever the input. `cost` is the hinge loss's weight;
    `balanced` gives both classes the same total. With `damping` features are divided by
    sqrt(damping + their squared length), so that length hardly matters but a text of a few words
    stays near the bias; without, they are summed as they are.
    """

    chars: tuple[int, ...] = (3, 4, 5)
    words: tuple[int, ...] = ()
    repeats: bool = False
    lower: bool = True
    dimensions: int = 1 << 18
    smoothing: float = 1.0
    cost: float = 1.0
    rounds: int = 30
    tolerance: float = 1e-3
    steepness: float = 4.0
    damping: float | None = 25.0
    balanced: bool = True
    sample_per_class: int = 2000
    sample_characters: int = 100_000_000


class Features:
    """The distinct hashed n-grams of a text."""

    def __init__(self, settings: ClassifierSettings):
        self.settings = settings
        self.owner = np.zeros(settings.dimensions, np.int32)

    def _distinct(self, hashed: list[np.ndarray]) -> np.ndarray:
        mixed = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        places = (mixed >> np.uint64(40)).astype(np.int64) % self.settings.dimensions
        # the last position that writes to a place owns it
        order = np.arange(len(places), dtype=np.int32)
        self.owner[places] = order
        return places[self.owner[places] == order]

    def of(self, text: str) -> np.ndarray:
        if self.settings.lower:
            text = text.lower()
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        hashed = []
        for n in self.settings.chars:
            if len(points) >= n:
                gram = np.full(len(points) - n + 1, n, np.uint64)
                for k in range(n):
                    gram *= np.uint64(0x100000001B3)
                    gram += points[k : k + len(gram)]
                gram ^= gram >> np.uint64(31)
                hashed.append(gram)
        if (self.settings.words or self.settings.repeats) and len(points):
            space = (points == 32) | ((points >= 9) & (points <= 13))
            first = ~space
            first[1:] &= space[:-1]
            starts = np.flatnonzero(first)
            if len(starts):
                word = np.cumsum(first) - 1
                inside = np.flatnonzero(~space)
                place = (inside - starts[word[inside]]).astype(np.uint64)
                value = (points[inside] + np.uint64(1)) * (place * np.uint64(2654435761) + np.uint64(97))
                value ^= value >> np.uint64(15)
                value *= np.uint64(0xD6E8FEB86659FD93)
                begins = np.flatnonzero(np.r_[True, np.diff(word[inside]) > 0])
                words = np.add.reduceat(value, begins)
                if self.settings.repeats:
                    for apart in (1, 2, 3):
                        same = np.r_[False, words[apart:] == words[:-apart], False]
                        turns = np.flatnonzero(same[1:] != same[:-1])
                        longest = int((turns[1::2] - turns[::2]).max(initial=0)) // apart
                        for times in (1, 2, 4, 8):
                            if longest >= times:
                                hashed.append(np.array([1000 * apart + times], np.uint64))
                for n in self.settings.words:
                    if len(words) >= n:
                        gram = np.full(len(words) - n + 1, n + 100, np.uint64)
                        for k in range(n):
                            gram *= np.uint64(0x100000001B3)
                            gram += words[k : k + len(gram)]
                            gram ^= gram >> np.uint64(29)
                        hashed.append(gram)
        return self._distinct(hashed)


@dataclass(frozen=True)
class LinearModel:
    """Margin of a text with features P: `bias + sum(weight[P]) / sqrt(damping + sum(square[P]))`,
    or without the divisor; its score is the margin's logistic."""

    settings: ClassifierSettings
    weight: np.ndarray
    square: np.ndarray
    bias: float

    def scores(self, texts: list[str], features: Features) -> list[float]:
        out = []
        for text in texts:
            places = features.of(text)
            margin = float(self.weight[places].sum(dtype=np.float64))
            if self.settings.damping is not None:
                margin /= (self.settings.damping + float(self.square[places].sum(dtype=np.float64))) ** 0.5
            margin += self.bias
            out.append(1.0 / (1.0 + float(np.exp(-self.settings.steepness * margin))))
        return out


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, dimensions: int, smoothing: float) -> np.ndarray:
    """log of the ratio of each indicator's share in class 1 to that in class 0."""
    shares = []
    for label in (1, 0):
        chosen = [rows[k] for k in np.flatnonzero(labels == label).tolist()]
        counts = np.bincount(np.concatenate(chosen), minlength=dimensions) + smoothing
        shares.append(counts / counts.sum())
    return np.log(shares[0] / shares[1])


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, dimensions: int,
    costs: np.ndarray, rounds: int, tolerance: float,
) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model, one dual variable at a time.

    Each step solves its variable exactly within [0, its cost] and moves the weights by the change.
    The bias is the weight of a constant feature. Rounds end when no projected gradient is larger
    than `tolerance`.
    """
    weights, bias = np.zeros(dimensions), 0.0
    dual = np.zeros(len(rows))
    curvature = [float(v @ v) + 1.0 for v in values]
    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(rounds):
        worst = 0.0
        for k in order.permutation(len(rows)).tolist():
            at, x, y, cost = rows[k], values[k], signs[k], costs[k]
            gradient = y * (float(weights[at] @ x) + bias) - 1.0
            projected = gradient
            if dual[k] <= 0:
                projected = min(gradient, 0.0)
            elif dual[k] >= cost:
                projected = max(gradient, 0.0)
            worst = max(worst, abs(projected))
            if projected:
                new = min(max(dual[k] - gradient / curvature[k], 0.0), cost)
                step = (new - dual[k]) * y
                dual[k] = new
                weights[at] += step * x
                bias += step
        if worst < tolerance:
            break
    return weights, bias


def fit_rows(texts: list[str], labels: np.ndarray, settings: ClassifierSettings) -> LinearModel | None:
    """The model of a labelled sample in memory; None unless both classes are there."""
    if len(set(labels.tolist())) < 2:
        return None
    features = Features(settings)
    order = sorted(range(len(texts)), key=lambda k: (texts[k], int(labels[k])))
    rows = [features.of(texts[k]) for k in order]
    labels = labels[order]
    ratios = log_count_ratios(rows, labels, settings.dimensions, settings.smoothing)
    values = []
    for places in rows:
        x = ratios[places]
        values.append(x if settings.damping is None else x / float(np.sqrt(settings.damping + x @ x)))
    costs = np.full(len(labels), float(settings.cost))
    if settings.balanced:
        costs *= len(labels) / 2 / np.bincount(labels, minlength=2)[labels]
    weights, bias = dual_coordinate_descent(
        rows, values, np.where(labels == 1, 1.0, -1.0), settings.dimensions, costs, settings.rounds, settings.tolerance
    )
    return LinearModel(
        settings, (weights * ratios).astype(np.float32), (ratios * ratios).astype(np.float32), bias
    )


def training_sample(
    df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str,
    learn: Column | None, settings: ClassifierSettings,
) -> DataFrame:
    """`text, label` of at most `sample_per_class` rows of each class, with at most `sample_characters` together.

    Ids are chosen from the labels alone and, being so few, are broadcast: no text is shuffled but the sample's. Where
    ids repeat, or texts are very long, rows are taken by a hash of id and text until a bound is met.
    """
    known = labels.select(col(label_id).cast("long").alias("id"), col(label_col).cast("int").alias("label"))
    known = known.where("id IS NOT NULL AND label IN (0, 1)")
    if learn is not None:
        known = known.where(learn)
    known = known.distinct()
    chosen = None
    for label in (0, 1):
        one = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(settings.sample_per_class)
        chosen = one if chosen is None else chosen.union(one)
    rows = id_and_text(df, id_col, text_col).join(F.broadcast(chosen), "id")
    # Each partition gives at most so many rows of a class to the one that orders them.
    order = Window.partitionBy("label").orderBy("place", "text")
    rows = rows.withColumn("place", F.xxhash64("id", "text")).withColumn("number", F.row_number().over(order))
    rows = rows.where(F.col("number") <= settings.sample_per_class)
    held = F.sum(F.length("text").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("held", held).where(F.col("held") <= settings.sample_characters // 2).select("text", "label")


def fit(sample: DataFrame, settings: ClassifierSettings) -> LinearModel | None:
    """The model of a bounded sample (text, label), fitted in one task of its own."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        model = fit_rows(frame["text"].tolist(), frame["label"].to_numpy(), settings)
        if model is None:
            return pd.DataFrame({"weight": [], "square": [], "bias": []})
        return pd.DataFrame(
            {"weight": [model.weight.tobytes()], "square": [model.square.tobytes()], "bias": [float(model.bias)]}
        )

    fitted = sample.groupBy().applyInPandas(run, "weight binary, square binary, bias double").first()
    if fitted is None:
        return None
    return LinearModel(
        settings, np.frombuffer(fitted["weight"], np.float32), np.frombuffer(fitted["square"], np.float32), fitted["bias"]
    )


def score(df: DataFrame, model: LinearModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id, score, predicted` of every row; without a model every score is 0.5."""
    schema = pa.schema([("id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])
    rows = id_and_text(df, id_col, text_col)
    ddl = "id long, score double, predicted int"
    if model is None:
        return rows.select("id", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.settings)
        for batch in batches:
            scores = model.scores(batch.column(1).to_pylist(), features)
            yield batch_of(schema, batch.column(0), scores, [int(s >= 0.5) for s in scores])

    return rows.mapInArrow(run, ddl)


def accepted(df: DataFrame, model: LinearModel | None, text_col: str = "text") -> DataFrame:
    """The rows of `df` whose text scores 0.5 or more, with all their columns, in one pass."""
    if model is None:
        return df
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.settings)
        for batch in batches:
            texts = [text or "" for text in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([s >= 0.5 for s in model.scores(texts, features)], pa.bool_()))

    return df.mapInArrow(run, df.schema)
