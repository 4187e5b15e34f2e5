"""Quality classifier: naive Bayes support vectors over word and short character n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from . import linear

SETTINGS = linear.ClassifierSettings(
    chars=(2, 3), words=(1,), repeats=True, lower=False, damping=400.0, cost=4.0, balanced=False
)


def quality_scores(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    label_id: str = "doc_id",
    label_col: str = "quality",
    learn: Column | None = None,
    settings: linear.ClassifierSettings = SETTINGS,
) -> DataFrame:
    """`id, score, predicted` of every row of `df`, learnt from `labels` where `learn` holds.

    `learn` is a condition on the label's `id`. Labels other than 0 and 1 and null ids teach
    nothing; an id with both labels teaches both. Without labels of both classes every score is 0.5. A null text
    is an empty one, and has the score of no n-grams. Repeated rows are scored alike; an empty table gives no rows.
    """
    sample = linear.training_sample(df, labels, id_col, text_col, label_id, label_col, learn, settings)
    return linear.score(df, linear.fit(sample, settings), id_col, text_col)


def quality_filter(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    label_id: str = "doc_id",
    label_col: str = "quality",
    learn: Column | None = None,
    settings: linear.ClassifierSettings = SETTINGS,
) -> DataFrame:
    """The rows of `df` that `quality_scores` predicts as 1, as they are; nothing is shuffled but the
    sample. Rows with null ids are judged like any other."""
    sample = linear.training_sample(df, labels, id_col, text_col, label_id, label_col, learn, settings)
    return linear.accepted(df, linear.fit(sample, settings), text_col)
