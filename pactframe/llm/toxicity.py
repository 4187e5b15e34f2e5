"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from . import linear

SETTINGS = linear.ClassifierSettings(chars=(3, 4, 5), damping=None, cost=0.01, sample_per_class=3000)


def toxicity_scores(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    label_id: str = "doc_id",
    label_col: str = "toxic",
    learn: Column | None = None,
    settings: linear.ClassifierSettings = SETTINGS,
) -> DataFrame:
    """`id, score, predicted` of every row of `df`, learnt from `labels` where `learn` holds.

    Nulls, empty and repeated rows, ties and missing classes are treated as in `quality_scores`.
    """
    sample = linear.training_sample(df, labels, id_col, text_col, label_id, label_col, learn, settings)
    return linear.score(df, linear.fit(sample, settings), id_col, text_col)
