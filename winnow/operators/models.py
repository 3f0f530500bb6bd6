"""Propensity models on Spark ML: families, ensembles, experts and search."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.operators.boosting import Growth, HistogramBoosting
from winnow.operators.evaluation import auc_of, average_precision_of, score_curve
from winnow.operators.kernelmaps import KernelSVC
from winnow.operators.splits import row_kfold

# Default settings of the model families.
DEFAULTS: dict[str, dict] = {
    "baseline_lr": {"C": 1.0, "l1_ratio": 0.2, "max_iter": 4000},
    "ridge_lr": {"C": 1.0, "l1_ratio": 0.0, "max_iter": 4000},
    "lasso_lr": {"C": 1.0, "l1_ratio": 1.0, "max_iter": 4000},
    "svm": {"C": 1.0, "max_iter": 1000, "kernel": "linear"},
    "random_forest": {"trees": 500, "depth": 10, "features": "sqrt", "min_leaf": 1},
    "lightgbm": {"trees": 300, "depth": 5, "step": 0.1, "rows": 1.0, "features": 1.0, "leaves": 31, "l2": 0.0, "min_rows": 20},
    "xgboost": {"trees": 500, "depth": 7, "step": 0.1, "rows": 0.7, "features": 0.7, "l2": 1.0, "min_weight": 1.0},
    "catboost": {"trees": 1000, "depth": 6, "step": 0.1, "rows": 1.0, "features": 1.0, "l2": 3.0},
    "gbt": {"trees": 100, "depth": 5, "step": 0.1, "rows": 1.0, "features": "all"},
}
MIN_SOURCE_ROWS = 50


#: How the boosted families grow their trees; ``gbt`` is Spark's own first-order booster.
BOOSTED = {"lightgbm": "leaf", "xgboost": "level", "catboost": "symmetric"}

# output columns of a fitted model: own names, so that models can be chained on one frame
OUTPUTS = {"rawPredictionCol": "_m_raw", "probabilityCol": "_m_probability", "predictionCol": "_m_class"}


def estimator(family: str, n: int, features: str = "features", label: str = "label", weight: str | None = None,
              seed: int = 42, **params):
    """A Spark ML estimator; ``n`` is the number of training rows (the penalty is per row)."""
    out = _estimator(family, n, features, label, weight, seed, **params)
    for name, column in OUTPUTS.items():
        if out.hasParam(name):
            out.set(out.getParam(name), column)
    return out


def _estimator(family, n, features, label, weight, seed, **params):
    p = {**DEFAULTS[family], **params}
    names = {"featuresCol": features, "labelCol": label, **({"weightCol": weight} if weight else {})}
    if family.endswith("_lr"):
        return LogisticRegression(
            **names, elasticNetParam=p["l1_ratio"], regParam=1.0 / (p["C"] * max(n, 1)), maxIter=p["max_iter"],
            tol=p.get("tol", 1e-6), standardization=False,
        )
    if family == "svm" and p["kernel"] != "linear":
        shape = {k: p[k] for k in ("gamma", "degree", "coef0", "components") if k in p}
        return KernelSVC(**names, kernel=p["kernel"], **shape, regParam=1.0 / (p["C"] * max(n, 1)), maxIter=p["max_iter"],
                         tol=p.get("tol", 1e-6), seed=seed)
    if family == "svm":
        return LinearSVC(**names, regParam=1.0 / (p["C"] * max(n, 1)), maxIter=p["max_iter"],
                         tol=p.get("tol", 1e-6), standardization=False)
    if family == "random_forest":
        return RandomForestClassifier(
            **names, numTrees=p["trees"], maxDepth=p["depth"], featureSubsetStrategy=p["features"],
            minInstancesPerNode=p["min_leaf"], seed=seed,
        )
    if family in BOOSTED:
        known = {f.name for f in fields(Growth)} - {"policy"}
        return HistogramBoosting(**names, growth=Growth(BOOSTED[family], **{k: v for k, v in p.items() if k in known}), seed=seed)
    return GBTClassifier(
        **names, maxIter=p["trees"], maxDepth=p["depth"], stepSize=p["step"], subsamplingRate=p["rows"],
        featureSubsetStrategy=p["features"], seed=seed,
    )


def positive_probability(model) -> Column:
    """P(class 1); a margin model has none, its margin goes through the logistic function."""
    if model.hasParam("probabilityCol"):
        return vector_to_array(model.getProbabilityCol())[1]
    return 1.0 / (1.0 + F.exp(-vector_to_array(model.getRawPredictionCol())[1]))


@dataclass
class Fitted:
    """A fitted family; ``transform`` adds its probability and nothing else."""

    family: str
    model: object

    def transform(self, df: DataFrame, out: str = "probability_1") -> DataFrame:
        rows = self.model.transform(df)
        extra = [c for c in rows.columns if c not in df.columns ]
        return rows.withColumn(out, positive_probability(self.model)).drop(*extra)


def fit_family(df: DataFrame, family: str, features: str = "features", label: str = "label", weight: str | None = None,
               seed: int = 42, **params) -> Fitted:
    rows = df.withColumn(label, F.col(label).cast("double"))
    return Fitted(family, estimator(family, rows.count(), features, label, weight, seed, **params).fit(rows))


def fit_families(df: DataFrame, families: Mapping[str, dict] | Sequence[str], **common) -> dict[str, Fitted]:
    """Several families on the same feature column."""
    wanted = families if isinstance(families, Mapping) else dict.fromkeys(families, {})
    return {name: fit_family(df, name, **{**common, **params}) for name, params in wanted.items()}


def add_probabilities(df: DataFrame, models: Mapping[str, Fitted]) -> tuple[DataFrame, list[str]]:
    columns = []
    for name, model in models.items():
        columns.append(f"p_{name}")
        df = model.transform(df, columns[-1])
    return df, columns


def model_importances(model, names: Sequence[str], spark) -> DataFrame:
    """(feature, importance): impurity gain of trees, absolute weight of linear models."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    else:
        values = np.abs(model.coefficients.toArray())
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def vector_names(df: DataFrame, column: str = "features") -> list[str]:
    """Slot names of an assembled vector, from its metadata."""
    attrs = df.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for kind in attrs.values() for a in kind)
    return [name for _, name in slots]


# ---------------------------------------------------------------- ensembles


def vote(columns: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    """Soft vote: weighted mean of probability columns."""
    weights = list(weights) if weights is not None else [1.0] * len(columns)
    total = sum(weights)
    out = F.lit(0.0)
    for c, w in zip(columns, weights):
        out = out + F.col(c) * (w / total)
    return out


def weight_candidates(k: int, seed: int = 42, draws: int = 100) -> list[list[float]]:
    """Two models: steps of 0.1. More: seeded points of the simplex and the equal weights."""
    if k == 2:
        return [[i / 10, 1 - i / 10] for i in range(11)]
    raw = np.random.default_rng(seed).random((draws, k))
    return [*(raw / raw.sum(axis=1, keepdims=True)).tolist(), [1.0 / k] * k]


def candidate_scores(df: DataFrame, columns: Sequence[str], label: str, candidates: Sequence[Sequence[float]],
                     metric: str = "roc_auc") -> DataFrame:
    """(candidate, value) for all weightings in one pass over the rows."""
    cells = F.array(*[
        F.struct(F.lit(i).alias("candidate"), vote(columns, w).alias("_s")) for i, w in enumerate(candidates)
    ])
    long = df.select(F.col(label).cast("int").alias("_y"), F.inline(cells))
    if metric in ("roc_auc", "average_precision"):
        value = auc_of() if metric == "roc_auc" else average_precision_of()
        return score_curve(long, "_s", "_y", ["candidate"]).groupBy("candidate").agg(value.alias("value"))
    hit, y = F.col("_s") >= 0.5, F.col("_y") == 1
    tp, fp, fn = F.count_if(hit & y), F.count_if(hit & ~y), F.count_if(~hit & y)
    top, bottom = {
        "f1": (2.0 * tp, 2.0 * tp + fp + fn), "precision": (tp, tp + fp), "recall": (tp, tp + fn),
    }[metric]
    return long.groupBy("candidate").agg(F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0)).alias("value"))


def auc_bounds(df: DataFrame, columns: Sequence[str], label: str, candidates: Sequence[Sequence[float]], bins: int = 1024) -> DataFrame:
    """(candidate, low, high): the AUC of every weighting lies between them.

    Scores are counted on a grid, so that what is shuffled depends on the candidates and the grid and not on the rows. Pairs in
    different cells are decided, pairs in one cell may go either way. NULL where a class is missing.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("candidate"), vote(columns, w).alias("_s")) for i, w in enumerate(candidates)])
    long = df.select(F.col(label).cast("long").alias("_y"), F.inline(cells)).filter("_s IS NOT NULL AND _y IS NOT NULL")
    cell = F.greatest(F.least(F.floor(F.col("_s") * bins), F.lit(bins - 1)), F.lit(0)).cast("int")
    grid = long.groupBy("candidate", cell.alias("_b")).agg(F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"))
    above = Window.partitionBy("candidate").orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    wins = grid.withColumn("_won", F.col("neg").cast("double") * F.coalesce(F.sum("pos").over(above), F.lit(0)))
    pairs = F.nullif(F.sum("pos").cast("double") * F.sum("neg"), F.lit(0.0))
    open_pairs = F.sum(F.col("pos").cast("double") * F.col("neg"))
    return wins.groupBy("candidate").agg((F.sum("_won") / pairs).alias("low"), ((F.sum("_won") + open_pairs) / pairs).alias("high"))


def optimize_weights(df: DataFrame, columns: Sequence[str], label: str, metric: str = "roc_auc",
                     seed: int = 42) -> tuple[list[float], float]:
    """The weighting with the best value (the first of equal ones); for the AUC only those that the grid's bounds leave open are ranked exactly."""
    candidates = weight_candidates(len(columns), seed)
    left = list(range(len(candidates)))
    if metric == "roc_auc":
        bounds = {r["candidate"]: r for r in auc_bounds(df, columns, label, candidates).collect() if r["low"] is not None}
        floor = max((r["low"] for r in bounds.values()), default=0.0) - 1e-9  # sums of doubles
        left = [i for i in left if i in bounds and bounds[i]["high"] >= floor]
        if not left:
            return [1.0 / len(columns)] * len(columns), 0.0
    exact = candidate_scores(df, columns, label, [candidates[i] for i in left], metric)
    best = exact.orderBy(F.desc_nulls_last("value"), "candidate").first()
    if best is None or best["value"] is None:
        return [1.0 / len(columns)] * len(columns), 0.0
    return candidates[left[best["candidate"]]], best["value"]


@dataclass
class Stacked:
    bases: dict[str, Fitted]
    meta: Fitted
    passthrough: str | None

    def _inputs(self, df: DataFrame) -> DataFrame:
        rows, columns = add_probabilities(df, self.bases)
        return _meta_vector(rows, columns, self.passthrough)

    def transform(self, df: DataFrame, out: str = "probability_1") -> DataFrame:
        rows = self.meta.transform(self._inputs(df), out)
        return rows.drop("_meta", *[f"p_{n}" for n in self.bases])


def _meta_vector(df: DataFrame, columns: Sequence[str], passthrough: str | None) -> DataFrame:
    inputs = [*columns, *([passthrough] if passthrough else [])]
    return VectorAssembler(inputCols=inputs, outputCol="_meta").transform(df)


def fit_stacking(df: DataFrame, families: Mapping[str, dict], row_id: str, features: str = "features",
                 label: str = "label", folds: int = 5, passthrough: bool = True, C: float = 5.0, seed: int = 42) -> Stacked:
    """The meta model learns from out-of-fold probabilities, so no base model scores its own rows."""
    dealt = row_kfold(df, row_id, folds, seed)
    parts = []
    for k in range(folds):
        models = fit_families(dealt.filter(F.col("fold") != k), families, features=features, label=label)
        scored, columns = add_probabilities(dealt.filter(F.col("fold") == k), models)
        parts.append(scored)
    oof = parts[0]
    for more in parts[1:]:
        oof = oof.unionByName(more)
    through = features if passthrough else None
    meta = fit_family(_meta_vector(oof, columns, through), "ridge_lr", "_meta", label, C=C, max_iter=200)
    return Stacked(fit_families(df, families, features=features, label=label), meta, through)


@dataclass
class SourceExperts:
    """One model per well-filled source, the global model for the rest."""

    source: str
    general: Fitted
    experts: dict[str, Fitted] = field(default_factory=dict)

    def transform(self, df: DataFrame, out: str = "probability_1") -> DataFrame:
        rows = self.general.transform(df, out)
        value = F.col(out)
        for i, (name, model) in enumerate(self.experts.items()):
            rows = model.transform(rows, f"_e{i}")
            value = F.when(F.col(self.source) == name, F.col(f"_e{i}")).otherwise(value)
        return rows.withColumn(out, value).drop(*[f"_e{i}" for i in range(len(self.experts))])


def fit_source_experts(df: DataFrame, source: str, sources: Sequence[str], family: str, label: str = "label",
                       min_rows: int = MIN_SOURCE_ROWS, **params) -> SourceExperts:
    """``sources`` is the bounded list of main sources; each fit is a distributed job."""
    sizes = {r[0]: r for r in df.filter(F.col(source).isin(list(sources))).groupBy(source).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(label).alias("classes")).collect()}
    model = SourceExperts(source, fit_family(df, family, label=label, **params))
    for name in sources:
        if name in sizes and sizes[name]["n"] >= min_rows and sizes[name]["classes"] == 2:
            model.experts[name] = fit_family(df.filter(F.col(source) == name), family, label=label, **params)
    return model


# ---------------------------------------------------------------- search

# Values tried per family, for the parameters that Spark's estimators have.
GRIDS: dict[str, dict[str, list]] = {
    "baseline_lr": {
        "C": [0.001, 0.01, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 50.0, 100.0],
        "l1_ratio": [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
        "max_iter": [1000, 2000, 4000, 10000],
        "tol": [0.0001, 0.001, 0.01],
    },
    "ridge_lr": {
        "C": [0.001, 0.01, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 50.0, 100.0],
        "max_iter": [1000, 2000, 4000, 10000],
        "tol": [0.0001, 0.001, 0.01],
    },
    "lasso_lr": {
        "C": [0.001, 0.01, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 50.0, 100.0],
        "max_iter": [1000, 2000, 4000, 10000],
        "tol": [0.0001, 0.001, 0.01],
    },
    "svm": {
        "C": [0.1, 0.5, 1.0, 5.0, 10.0, 50.0, 100.0],
        "kernel": ["linear", "rbf", "poly", "sigmoid"],
        "gamma": ["scale", "auto", 0.001, 0.01, 0.1, 1.0],
        "degree": [2, 3, 4, 5],
        "coef0": [0.0, 0.1, 0.5, 1.0],
        "tol": [0.0001, 0.001, 0.01],
    },
    "random_forest": {
        "trees": [50, 100, 200, 300, 500, 1000, 2000],
        "depth": [3, 5, 7, 10, 15, 20, 30],
        "min_leaf": [1, 2, 4, 8, 16],
    },
    "lightgbm": {
        "trees": [50, 100, 200, 300, 500, 800, 1000, 2000],
        "leaves": [31, 63, 127, 255, 511, 1023],
        "depth": [3, 5, 7, 9, 12],
        "step": [0.001, 0.005, 0.01, 0.03, 0.05, 0.07, 0.1, 0.2, 0.3],
        "min_rows": [5, 10, 20, 50, 100, 200, 500],
        "rows": [0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
        "features": [0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
        "l1": [0.0, 0.001, 0.01, 0.03, 0.1, 0.3, 1.0, 3.0, 10.0],
        "l2": [0.0, 0.001, 0.01, 0.03, 0.1, 0.3, 1.0, 3.0, 10.0],
        "min_gain": [0.0, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0],
    },
    "xgboost": {
        "trees": [50, 100, 200, 300, 500, 700, 1000, 2000],
        "depth": [3, 4, 5, 6, 7, 8, 9, 10, 12],
        "min_gain": [0, 0.1, 0.2, 0.3, 0.5, 1.0, 3.0, 5.0],
        "features": [0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
        "step": [0.001, 0.005, 0.01, 0.03, 0.05, 0.07, 0.1, 0.2, 0.3],
        "rows": [0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
        "l1": [0.0, 0.001, 0.01, 0.03, 0.1, 0.3, 1.0, 3.0, 10.0],
        "l2": [0.0, 0.001, 0.01, 0.03, 0.1, 0.3, 1.0, 3.0, 10.0],
        "min_weight": [1, 3, 5, 7, 10, 15, 20],
    },
    "catboost": {
        "trees": [50, 100, 200, 300, 500, 1000, 2000],
        "depth": [3, 4, 5, 6, 7, 8, 10, 12],
        "step": [0.001, 0.005, 0.01, 0.03, 0.05, 0.07, 0.1, 0.2, 0.3],
        "rows": [0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
        "l2": [0.1, 1, 3, 5, 10, 30, 100],
        "bins": [32, 64, 128, 254],
    },
    "gbt": {
        "trees": [50, 100, 200, 300, 500],
        "depth": [3, 5, 7, 10],
        "step": [0.001, 0.005, 0.01, 0.03, 0.05, 0.07, 0.1, 0.2, 0.3],
        "rows": [0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    },
}
#: Metrics of the positive class that search can follow.
METRICS = {"roc_auc": "areaUnderROC", "average_precision": "areaUnderPR", "f1": "fMeasureByLabel",
           "precision": "precisionByLabel", "recall": "recallByLabel", "accuracy": "accuracy"}


def evaluator_of(metric: str, label: str):
    if metric in ("roc_auc", "average_precision"):
        return BinaryClassificationEvaluator(
            rawPredictionCol=OUTPUTS["rawPredictionCol"], labelCol=label, metricName=METRICS[metric], numBins=0)
    return MulticlassClassificationEvaluator(
        predictionCol=OUTPUTS["predictionCol"], labelCol=label, metricName=METRICS[metric], metricLabel=1.0)


def grid_points(grid: Mapping[str, list], trials: int, seed: int) -> list[dict]:
    """At most ``trials`` seeded points of a grid, each once, without writing the grid out."""
    names, sizes = list(grid), [len(v) for v in grid.values()]
    total = int(np.prod(sizes, dtype=object)) if sizes else 1
    order = random.Random(seed).sample(range(total), min(trials, total))
    out = []
    for at in order:
        point = {}
        for name, size in zip(names, sizes):
            at, k = divmod(at, size)
            point[name] = grid[name][k]
        out.append(point)
    return out


def fold_value(rows: DataFrame, held: DataFrame, n: int, family: str, metric: str, features: str, label: str, weight: str | None, seed: int,
               params: Mapping) -> float:
    """``metric`` on ``held`` of a model fitted on ``rows`` (``n`` of them)."""
    model = estimator(family, n, features, label, weight, seed, **params).fit(rows)
    return float(evaluator_of(metric, label).evaluate(model.transform(held)))


def side_by_side(spark, work, jobs: Sequence, parallelism: int) -> list:
    """Spark jobs submitted from a few threads, results in order."""
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), jobs))


def search(df: DataFrame, family: str, grid: Mapping[str, list], row_id: str, label: str = "label",
           features: str = "features", trials: int = 100, folds: int = 5, parallelism: int = 4, seed: int = 42,
           metric: str = "roc_auc", weight: str | None = None, **fixed) -> tuple[dict, float, Fitted]:
    """Cross-validated ``metric`` over a seeded subset of the grid, at most ``trials`` points, each on all rows.

    :func:`winnow.operators.tuning.tune` stops early and draws from spans instead.
    """
    rows = row_kfold(df.withColumn(label, F.col(label).cast("double")), row_id, folds, seed).persist()
    sizes = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}
    n = sum(sizes.values())
    points = grid_points(grid, trials, seed) or [{}]

    def one(job: tuple[dict, int]) -> float:
        point, k = job
        return fold_value(rows.filter(F.col("fold") != k), rows.filter(F.col("fold") == k), n - sizes.get(k, 0), family, metric, features,
                          label, weight, seed, {**fixed, **point})

    found = np.array(side_by_side(df.sparkSession, one, [(p, k) for p in points for k in range(folds)], parallelism)).reshape(-1, folds).mean(1)
    best = int(np.argmax(found))
    fitted = estimator(family, n, features, label, weight, seed, **{**fixed, **points[best]}).fit(rows)
    rows.unpersist()
    return points[best], float(found[best]), Fitted(family, fitted)


def last_stage(model):
    return model.stages[-1] if isinstance(model, PipelineModel) else model
