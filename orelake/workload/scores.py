"""Evaluation queries on rows scored by plain rules, so that SQL can check every figure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.functions.columns import pearson
from orelake.operators import evaluate, ml
from orelake.workload import views as v
from orelake.workload.registry import half_up, query

_CELLS = {
    "TP": "label = 1 AND prediction = 1",
    "FP": "label = 0 AND prediction = 1",
    "TN": "label = 0 AND prediction = 0",
    "FN": "label = 1 AND prediction = 0",
}
_CELL_COUNTS = ", ".join(f"CAST(count(*) FILTER ({cond}) AS DOUBLE) AS {cell}" for cell, cond in _CELLS.items())


def _div(top: str, bottom: str) -> str:
    return f"coalesce(({top}) / nullif({bottom}, 0), 0.0)"


_P1, _R1 = _div("TP", "TP + FP"), _div("TP", "TP + FN")
_P0, _R0 = _div("TN", "TN + FN"), _div("TN", "TN + FP")
_F1, _F0 = _div(f"2 * {_P1} * {_R1}", f"{_P1} + {_R1}"), _div(f"2 * {_P0} * {_R0}", f"{_P0} + {_R0}")


def _weighted(one: str, zero: str) -> str:
    return f"({one} * (TP + FN) + {zero} * (TN + FP)) / (TP + FP + TN + FN)"


SCORES_SQL = f"""
    SELECT model_name, {half_up("auc", 6)} AS auc, {half_up(_weighted(_F1, _F0), 6)} AS f1,
           {half_up("(TP + TN) / (TP + FP + TN + FN)", 6)} AS accuracy,
           {half_up(_weighted(_P1, _P0), 6)} AS precision, {half_up(_weighted(_R1, _R0), 6)} AS recall
    FROM (SELECT model_name, {_CELL_COUNTS} FROM p3 GROUP BY model_name) JOIN (
        SELECT model_name, sum(p * (below + n / 2.0)) / (sum(p) * sum(n)) AS auc FROM (
            SELECT model_name, p, n, sum(n) OVER (PARTITION BY model_name ORDER BY prob) - n AS below FROM (
                SELECT model_name, prob, sum(label)::DOUBLE AS p, (count(*) - sum(label))::DOUBLE AS n
                FROM p3 GROUP BY model_name, prob)) GROUP BY model_name) USING (model_name)"""


@query(
    v.with_views(
        "p",
        " UNION ALL ".join(f"SELECT '{cell}' AS cell, count(*) AS count FROM p WHERE {cond}" for cell, cond in _CELLS.items()),
    )
)
def confusion_cells(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.confusion_cells(v.scored(spark, folder))


@query(
    v.with_views(
        "p",
        "SELECT _project, " + ", ".join(f"count(*) FILTER ({cond}) AS {cell}" for cell, cond in _CELLS.items()) + " FROM p GROUP BY _project",
    )
)
def cells_to_row(spark: SparkSession, folder: str) -> DataFrame:
    """Cells per project without the empty ones, back to one row with zeros."""
    cells = evaluate.confusion_cells(v.scored(spark, folder), ["_project"]).filter("count > 0")
    return evaluate.cells_to_row(cells, ["_project"])


@query(
    v.with_views(
        "p3",
        f"""SELECT model_name, {half_up(_P1, 6)} AS precision, {half_up(_R1, 6)} AS recall, {half_up(_F1, 6)} AS f1
            FROM (SELECT model_name, {_CELL_COUNTS} FROM p3 GROUP BY model_name)""",
    )
)
def positive_class_scores(spark: SparkSession, folder: str) -> DataFrame:
    out = evaluate.positive_class_scores(v.scored_models(spark, folder), ["model_name"])
    return out.select("model_name", *[F.round(n, 6).alias(n) for n in ("precision", "recall", "f1")])


_FIGURES = ("auc", "f1", "accuracy", "precision", "recall")


@query(v.with_views("p3", SCORES_SQL))
def model_scores(spark: SparkSession, folder: str) -> DataFrame:
    out = evaluate.model_scores(v.scored_models(spark, folder))
    return out.select("model_name", *[F.round(n, 6).alias(n) for n in _FIGURES])


@query(
    v.with_views(
        "p3",
        "SELECT *, row_number() OVER (ORDER BY auc DESC, model_name) = 1 AS is_champion FROM x",
        x=SCORES_SQL,
    )
)
def pick_champion(spark: SparkSession, folder: str) -> DataFrame:
    out = ml.compare(v.scored_models(spark, folder))
    return out.select("model_name", "is_champion", *[F.round(n, 6).alias(n) for n in _FIGURES])


_ROC = """SELECT model_name, prob, sum(n) OVER w / sum(n) OVER g AS fpr, sum(p) OVER w / sum(p) OVER g AS tpr, n, p FROM (
        SELECT model_name, prob, sum(label)::DOUBLE AS p, (count(*) - sum(label))::DOUBLE AS n FROM p3 GROUP BY model_name, prob)
    WINDOW w AS (PARTITION BY model_name ORDER BY prob DESC), g AS (PARTITION BY model_name)"""


@query(v.with_views("p3", f"""SELECT model_name, prob, {half_up('fpr', 8)} AS fpr, {half_up('tpr', 8)} AS tpr FROM ({_ROC})
                    UNION ALL SELECT DISTINCT model_name, CAST('Infinity' AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM p3"""))
def roc_points(spark: SparkSession, folder: str) -> DataFrame:
    out = evaluate.roc_points(v.scored_models(spark, folder), ["model_name"])
    return out.select("model_name", "prob", F.round("fpr", 8).alias("fpr"), F.round("tpr", 8).alias("tpr"))


@query(
    v.with_views(
        "p3",
        f"""SELECT model_name, {half_up("sum((fpr - last_fpr) * (tpr + last_tpr) / 2)", 6)} AS area FROM (
                SELECT *, coalesce(lag(fpr) OVER (PARTITION BY model_name ORDER BY prob DESC), 0) AS last_fpr,
                       coalesce(lag(tpr) OVER (PARTITION BY model_name ORDER BY prob DESC), 0) AS last_tpr FROM ({_ROC}))
            GROUP BY model_name""",
    )
)
def roc_area(spark: SparkSession, folder: str) -> DataFrame:
    out = evaluate.roc_area(v.scored_models(spark, folder), ["model_name"])
    return out.select("model_name", F.round("area", 6).alias("area"))


@query(
    v.with_views(
        "m",
        "SELECT feature, importance, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM x",
        x=" UNION ALL ".join(
            f"SELECT '{f}' AS feature, {half_up(f'abs(corr({f}, is_buggy))', 6)} AS importance FROM m" for f in v.FEATURES
        ),
    )
)
def rank_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features ranked by the strength of their correlation with the flag."""
    modules = v.silver_modules(spark, folder)
    one_row = modules.agg(
        *[F.struct(F.lit(f).alias("feature"), F.round(F.abs(pearson(f, "is_buggy")), 6).alias("importance")).alias(f) for f in v.FEATURES]
    )
    return evaluate.rank_features(one_row.select(F.inline(F.array(*v.FEATURES))))
