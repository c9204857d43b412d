"""Grid search with k-fold cross-validation, and its results as a table.

One grid per estimator (a shared grid over foreign parameters only repeats
identical fits). Folds fit in parallel from the driver; each fit is itself a
distributed job. ``prefix_search`` fits no more often than it must: maps that
differ only in a number of rounds share one fit of the longest, whose first
rounds are the shorter models.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Executor, ThreadPoolExecutor
from contextlib import AbstractContextManager, nullcontext

import numpy as np
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import small_table, together
from . import metrics


def param_grid(estimator, axes: dict[str, list]) -> list:
    """``{param name: values}`` to a list of param maps for ``estimator``."""
    builder = ParamGridBuilder()
    for name, values in axes.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def cross_validate(pipeline, grid: list, evaluator, train: DataFrame, folds: int = 3, seed: int = 12,
                   parallelism: int = 4, fold_col: str = "", stages: Estimator | None = None) -> CrossValidatorModel:
    """Fit every map on every fold, pick the best by the evaluator (honouring
    ``isLargerBetter``) and refit it on all of ``train``. ``fold_col`` names an
    int column with each row's fold (0 to ``folds`` - 1), such as a key hash, so
    that folds do not move with the partitioning; without it folds are random.
    ``stages``, for named folds only, are fitted before the estimator, once per
    fold, as no map changes them; folds are filters on ``train``, which every
    fit reads: persist it."""
    if not fold_col:
        if stages is not None:
            raise ValueError("stages need named folds")
        cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator,
                            numFolds=folds, seed=seed, parallelism=parallelism)
        return cv.fit(train)
    spark = train.sparkSession

    def fitted(rows: DataFrame) -> tuple[list, DataFrame]:
        if stages is None:
            return [], rows
        first = stages.fit(rows)
        return [first], first.transform(rows)

    def parts(fold: int):
        first, fit = fitted(train.where(F.col(fold_col) != fold))
        held_out = train.where(F.col(fold_col) == fold)
        return fit, first[0].transform(held_out) if first else held_out

    def score(job) -> float:
        fold, i = job
        fit, held_out = by_fold[fold]
        return evaluator.evaluate(pipeline.fit(fit, grid[i]).transform(held_out, grid[i]))

    jobs = [(fold, i) for fold in range(folds) for i in range(len(grid))]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        by_fold = together(spark, pool, parts, range(folds))
        found = together(spark, pool, score, jobs)
    table = np.array(found).reshape(folds, len(grid))
    means = table.mean(axis=0)
    best = grid[int(np.argmax(means) if evaluator.isLargerBetter() else np.argmin(means))]
    first, rows = fitted(train)
    model = pipeline.fit(rows, best)
    cv = CrossValidatorModel(PipelineModel([*first, model]) if first else model, means.tolist(), None,
                             table.std(axis=0).tolist())
    return cv._set(estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, foldCol=fold_col)


def shared_fits(grid: list, rounds: str | None) -> list[list[int]]:
    """Positions of the maps in ``grid`` that one fit serves: those equal in
    every parameter but ``rounds``, fewest rounds first."""
    groups: dict[tuple, list[int]] = {}
    for i, pm in enumerate(grid):
        key = tuple(sorted((p.name, repr(v)) for p, v in pm.items() if p.name != rounds))
        groups.setdefault(key, []).append(i)
    return [sorted(g, key=lambda i: _rounds(grid[i], rounds)) for g in groups.values()] if rounds \
        else [[i] for i in range(len(grid))]


def _rounds(pm: dict, rounds: str):
    return next(v for p, v in pm.items() if p.name == rounds)


def prefix_search(estimator: Estimator, grid: list, train: DataFrame, label: str, fold_col: str, folds: int,
                  rounds: str | None = None, prefix: Callable[[Model, int], Model] | None = None,
                  stages: Estimator | None = None, parallelism: int = 4,
                  gate: AbstractContextManager | None = None, pool: Executor | None = None) -> CrossValidatorModel:
    """Cross-validate ``grid`` by weighted F1 over the folds that ``fold_col``
    names (0 to ``folds`` - 1), and refit the best map (the first of equals) on
    all of ``train``; the result reads like a ``CrossValidatorModel``.

    ``rounds`` names a parameter whose smaller values give the first part of the
    fit with a larger one (boosting rounds); ``prefix(model, n)`` cuts that part
    out. ``stages`` are fitted before the estimator, once per fold, as no map
    changes them. All models of one fit score its fold in one job. ``train``
    is read by every fit: persist it. Every fit is made inside ``gate``, such
    as a semaphore, and on the threads of ``pool`` (``parallelism`` own ones if
    none is given). Searches side by side that share a pool are served in turn:
    the first has all of it, and makes its last fit while the next goes on.
    """
    gate = gate or nullcontext()
    groups = shared_fits(grid, rounds)
    spark = train.sparkSession

    def parts(fold: int):
        fit, held_out = train.where(F.col(fold_col) != fold), train.where(F.col(fold_col) == fold)
        if stages is not None:
            model = stages.fit(fit)
            fit, held_out = model.transform(fit), model.transform(held_out)
        return fit, held_out

    def scores(job) -> list[tuple[int, int, float]]:
        with gate:
            return fold_scores(*job)

    def fold_scores(fold: int, group: list[int]) -> list[tuple[int, int, float]]:
        fit, held_out = by_fold[fold]
        longest = estimator.fit(fit, grid[group[-1]])
        scored = held_out
        for k, i in enumerate(group):
            model = longest if i == group[-1] else prefix(longest, _rounds(grid[i], rounds))
            named = model.copy().setPredictionCol(f"_p{k}").setRawPredictionCol("").setProbabilityCol("")
            scored = named.transform(scored)
        each = F.array(*[F.struct(F.lit(i).alias("map"), F.col(f"_p{k}").alias("prediction"))
                         for k, i in enumerate(group)])
        counts = scored.select(F.col(label).alias("label"), F.explode(each).alias("s")) \
            .groupBy("s.map", "label", "s.prediction").count().collect()  # maps x classes x classes rows
        return [(i, fold, metrics.f1_of_counts([(r["label"], r["prediction"], r["count"]) for r in counts
                                                if r["map"] == i])) for i in group]

    with nullcontext(pool) if pool else ThreadPoolExecutor(max_workers=parallelism) as threads:
        by_fold = together(spark, threads, parts, range(folds))
        found = [r for rows in together(spark, threads, scores, [(k, g) for g in reversed(groups) for k in range(folds)])
                 for r in rows]
    table = np.zeros((folds, len(grid)))
    for i, fold, value in found:
        table[fold, i] = value
    means = table.mean(axis=0)
    best = grid[int(np.argmax(means))]
    if stages is None:
        model = estimator.fit(train, best)
    else:
        first = stages.fit(train)
        model = PipelineModel([first, estimator.fit(first.transform(train), best)])
    cv = CrossValidatorModel(model, means.tolist(), None, table.std(axis=0).tolist())
    return cv._set(estimatorParamMaps=grid, evaluator=MulticlassClassificationEvaluator(labelCol=label),
                   numFolds=folds)


def _value(v):
    return list(v) if isinstance(v, (list, tuple)) else v


def grid_table(spark: SparkSession, cv: CrossValidatorModel, model_name: str) -> DataFrame:
    """One row per param map: ``(model, params, metric, avg_metric, std_metric,
    larger_is_better)``. Its size is the grid's, not the data's."""
    ev = cv.getEvaluator()
    rows = []
    for i, pm in enumerate(cv.getEstimatorParamMaps()):
        params = ", ".join(f"{p.name}={_value(v)}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        std = float(cv.stdMetrics[i]) if len(cv.stdMetrics) > i else None
        rows.append((model_name, i, params, ev.getMetricName(), float(cv.avgMetrics[i]), std,
                     bool(ev.isLargerBetter())))
    schema = ("model string, map_index int, params string, metric string, avg_metric double, "
              "std_metric double, larger_is_better boolean")
    return small_table(spark, rows, schema)


def best_params(grid: DataFrame) -> DataFrame:
    """Best map per model: arg-max of the mean metric, or arg-min when smaller
    is better (RMSE); ties go to the first map."""
    signed = F.when(F.col("larger_is_better"), F.col("avg_metric")).otherwise(-F.col("avg_metric"))
    keyed = grid.withColumn("_key", F.struct(signed.alias("s"), (-F.col("map_index")).alias("i")))
    return keyed.groupBy("model").agg(
        F.max_by("params", "_key").alias("params"),
        F.max_by("avg_metric", "_key").alias("avg_metric"),
        F.first("metric").alias("metric"))
