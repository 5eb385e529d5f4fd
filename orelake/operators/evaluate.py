"""Scores of binary classifiers as aggregates over scored rows.

Scored rows hold ``label`` (0/1), ``prediction`` (0/1) and ``prob``; ``by``
names columns (such as the model) to score separately.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orelake.functions import columns as c
from orelake.operators.ranking import merge_groups, running_totals, value_counts

# Names of the four cells.
CELLS = ["TP", "FP", "TN", "FN"]


def _cell_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    label, guess = F.col("label") == 1, F.col("prediction") == 1
    return scored.groupBy(*by).agg(
        F.count_if(label & guess).alias("TP"),
        F.count_if(~label & guess).alias("FP"),
        F.count_if(~label & ~guess).alias("TN"),
        F.count_if(label & ~guess).alias("FN"),
    )


def confusion_cells(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Four rows per group, also for empty cells."""
    return _cell_counts(scored, by).unpivot(list(by), CELLS, "cell", "count")


def cells_to_row(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One column per cell; a missing cell is 0."""
    wide = cells.groupBy(*by).pivot("cell", CELLS).agg(F.sum("count"))
    return wide.select(*by, *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in CELLS])


def _guarded(top: Column, bottom: Column) -> Column:
    return c.guarded_ratio(top.cast("double"), bottom)


def _f1(precision: Column, recall: Column) -> Column:
    return _guarded(2 * precision * recall, precision + recall)


def positive_class_scores(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of class 1; 0.0 where undefined."""
    tp, fp, fn = F.col("TP"), F.col("FP"), F.col("FN")
    return (
        _cell_counts(scored, by)
        .withColumns({"precision": _guarded(tp, tp + fp), "recall": _guarded(tp, tp + fn)})
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
        .select(*by, "precision", "recall", "f1")
    )


def weighted_scores(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and precision, recall, F1 weighted by class share; a class never predicted scores 0."""
    tp, fp, tn, fn = (F.col(n) for n in CELLS)
    rows = tp + fp + tn + fn

    def weighted(one: Column, zero: Column) -> Column:
        return _guarded(one * (tp + fn) + zero * (tn + fp), rows)

    p1, r1 = _guarded(tp, tp + fp), _guarded(tp, tp + fn)
    p0, r0 = _guarded(tn, tn + fn), _guarded(tn, tn + fp)
    return _cell_counts(scored, by).select(
        *by,
        weighted(_f1(p1, r1), _f1(p0, r0)).alias("f1"),
        _guarded(tp + tn, rows).alias("accuracy"),
        weighted(p1, p0).alias("precision"),
        weighted(r1, r0).alias("recall"),
    )


def _ranked_scores(scored: DataFrame, by: Sequence[str], order: Column) -> DataFrame:
    """Per distinct score: positives, negatives and their running totals."""
    counts = value_counts(scored, by, "prob", {"pos": F.col("label").cast("long")})
    counts = counts.withColumn("neg", F.col("n") - F.col("pos"))
    return running_totals(counts, by, [order], {"pos_upto": "pos", "neg_upto": "neg"})


def auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve by ranks; ties count half.

    NULL when a class is absent.
    """
    below = F.col("neg_upto") - F.col("neg")
    return (
        _ranked_scores(scored, by, F.col("prob"))
        .groupBy(*by)
        .agg(
            F.sum(F.col("pos") * (below + F.col("neg") / 2.0)).alias("_wins"),
            F.max("pos_upto_total").cast("double").alias("_p"),
            F.max("neg_upto_total").cast("double").alias("_n"),
        )
        .select(*by, (F.col("_wins") / F.nullif(F.col("_p") * F.col("_n"), F.lit(0.0))).alias("auc"))
    )


def roc_points(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The start (0, 0), where ``prob`` is infinite, and one point per distinct score.

    A group without rows has no start.
    """
    points = _ranked_scores(scored, by, F.col("prob").desc()).select(
        *by,
        "prob",
        _guarded(F.col("neg_upto"), F.col("neg_upto_total")).alias("fpr"),
        _guarded(F.col("pos_upto"), F.col("pos_upto_total")).alias("tpr"),
    )
    start = scored.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 0").select(
        *by, F.lit(float("inf")).alias("prob"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def roc_area(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area under the ROC curve.

    The running totals give both corners of each trapezoid, so no row has to
    look at its neighbour.
    """
    ranked = _ranked_scores(scored, by, F.col("prob").desc())
    width = F.col("neg") / F.nullif(F.col("neg_upto_total").cast("double"), F.lit(0.0))
    height = (2 * F.col("pos_upto") - F.col("pos")) / F.nullif(2.0 * F.col("pos_upto_total"), F.lit(0.0))
    return ranked.groupBy(*by).agg(F.sum(width * height).alias("area"))


def model_scores(scored: DataFrame, model: str = "model_name") -> DataFrame:
    """AUC and weighted scores, one row per model."""
    return merge_groups([model], auc(scored, [model]), weighted_scores(scored, [model]))


def pick_champion(scores: DataFrame, score: str = "auc", model: str = "model_name") -> DataFrame:
    """Scores with a boolean ``is_champion``; the first name wins ties.

    Runs over one row per model.
    """
    best = Window.orderBy(F.col(score).desc_nulls_last(), model)
    return scores.withColumn("is_champion", F.row_number().over(best) == 1)


def rank_features(importances: DataFrame, value: str = "importance", feature: str = "feature") -> DataFrame:
    """1-based rank by importance; runs over one row per feature."""
    order = Window.orderBy(F.col(value).desc_nulls_last(), feature)
    return importances.withColumn("rank", F.row_number().over(order))
