"""Evaluation metrics written as aggregates over a scored table.

Each returns a one-row (or per-group) DataFrame; nothing is collected. They
agree with Spark ML's evaluators: RMSE / MSE / MAE, accuracy, weighted F1
(the multiclass evaluator's default) and area under ROC. The AUC here is exact
(average ranks for ties), i.e. the binary evaluator with ``numBins=0``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import prefix_totals


def positive_score(col: str = "probability") -> Column:
    """Second element of a probability / raw-prediction vector."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(col))[1]


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction",
                       group_cols: list[str] | None = None) -> DataFrame:
    e = F.col(prediction).cast("double") - F.col(label).cast("double")
    aggs = [F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e * e).alias("mse"),
            F.avg(F.abs(e)).alias("mae"), F.count(F.lit(1)).alias("n")]
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)


def accuracy(df: DataFrame, label: str, prediction: str = "prediction",
             group_cols: list[str] | None = None) -> DataFrame:
    hit = (F.col(prediction).cast("double") == F.col(label).cast("double")).cast("double")
    aggs = [F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n")]
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)


def weighted_f1(df: DataFrame, label: str, prediction: str = "prediction",
                group_cols: list[str] | None = None) -> DataFrame:
    """F1 per label class weighted by the class's share of rows.

    Only a confusion table (classes x classes per group) is built; precision
    of a class with no predictions, and F1 with p + r = 0, are 0.
    """
    g = list(group_cols or [])
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    conf = df.groupBy(*g, y.alias("_y"), p.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    # Each confusion cell counts once for its true class and once for its
    # predicted class; one aggregate over the (tiny) cells gives per class
    # the true positives, actual and predicted totals.
    hit = F.when(F.col("_y") == F.col("_p"), F.col("_c")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("_y").alias("cls"), F.col("_c").alias("a"), hit.alias("t"), zero.alias("p")),
        F.struct(F.col("_p").alias("cls"), zero.alias("a"), zero.alias("t"), F.col("_c").alias("p")))
    per = conf.select(*g, F.explode(sides).alias("s")) \
        .groupBy(*g, F.col("s.cls").alias("_cls")) \
        .agg(F.sum("s.a").alias("n_actual"), F.sum("s.t").alias("tp"), F.sum("s.p").alias("n_pred")) \
        .filter(F.col("n_actual") > 0)
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.col("tp") / F.col("n_actual")
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    per = per.select(*g, "n_actual", f1.alias("f1"))
    aggs = [(F.sum(F.col("f1") * F.col("n_actual")) / F.sum("n_actual")).alias("weighted_f1"),
            F.sum("n_actual").alias("n")]
    return per.groupBy(*g).agg(*aggs) if g else per.agg(*aggs)


def f1_of_counts(counts: list[tuple[float, float, int]]) -> float:
    """The weighted F1 of a confusion table ``(label, prediction, rows)`` that
    is already on the driver; 0 without rows."""
    total = sum(n for _, _, n in counts)
    value = 0.0
    for cls in {y for y, _, _ in counts}:
        hit = sum(n for y, p, n in counts if y == p == cls)
        actual, predicted = sum(n for y, _, n in counts if y == cls), sum(n for _, p, n in counts if p == cls)
        value += actual / total * 2 * hit / (actual + predicted)  # 2 p r / (p + r)
    return value


def area_under_roc(df: DataFrame, label: str, score: Column | str,
                   group_cols: list[str] | None = None) -> DataFrame:
    """Exact AUC: P(score of a positive > score of a negative) + half the ties.

    Per distinct score count positives and negatives, then the negatives below
    each score by a distributed prefix sum; AUC = sum pos * (neg_below +
    neg_here / 2) / (P * N). Positive means label > 0.5, as in Spark ML.
    """
    s = F.col(score) if isinstance(score, str) else score
    g = list(group_cols or [])
    is_pos = F.col(label).cast("double") > 0.5
    per_score = df.select(*g, s.cast("double").alias("_s"), is_pos.alias("_pos")) \
        .groupBy(*g, "_s").agg(F.count_if(F.col("_pos")).alias("_np"),
                               F.count_if(~F.col("_pos")).alias("_nn"))
    ranked = prefix_totals(per_score, "_s", ["_nn"], group_cols=g)
    aggs = [F.sum(F.col("_np") * (F.col("_nn_before") + F.col("_nn") / 2.0)).alias("_u"),
            F.sum("_np").alias("_P"), F.sum("_nn").alias("_N")]
    agg = ranked.groupBy(*g).agg(*aggs) if g else ranked.agg(*aggs)
    auc = F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                 F.col("_u") / (F.col("_P") * F.col("_N"))).otherwise(F.lit(None).cast("double"))
    return agg.select(*g, auc.alias("auc"), (F.col("_P") + F.col("_N")).alias("n"))


def hard_label_auc(df: DataFrame, label: str, prediction: str = "prediction",
                   group_cols: list[str] | None = None) -> DataFrame:
    """AUC with the 0/1 prediction as score: (TPR + TNR) / 2. Reported apart
    from the score AUC, as it is a different number."""
    return area_under_roc(df, label, prediction, group_cols) \
        .withColumnRenamed("auc", "auc_hard")


def base_rate(df: DataFrame, label: str) -> DataFrame:
    """Share of the majority class: the accuracy of always predicting it."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg((F.max("n") / F.sum("n")).alias("base_rate"))
