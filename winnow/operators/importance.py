"""Feature importance: attributions, permutation, folds, shadows, comparison."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.operators.evaluation import auc_of, score_curve
from winnow.operators.kernels import feistel_donor, row_positions, safe_corr
from winnow.operators.models import fit_family
from winnow.operators.splits import row_kfold
from winnow.session import pin, scratch_path

# ---------------------------------------------------------------- attributions


def linear_importance(df: DataFrame, model, names: Sequence[str], features: str = "features") -> DataFrame:
    """mean |w (x - mean x)|: the exact attribution of a linear margin."""
    w = np.asarray(model.coefficients.toArray())
    means = df.select(Summarizer.mean(F.col(features)).alias("m")).first()["m"].toArray()
    # |w (x - mean)| cell by cell, summed over slots and rows in one aggregate of (slot, value) pairs
    centred = F.transform(vector_to_array(features), lambda x, i: F.abs(x - F.element_at(F.lit(means.tolist()), i + 1)))
    table = df.select(F.posexplode(centred).alias("slot", "gap")).groupBy("slot").agg(F.avg("gap").alias("gap"))
    scale = df.sparkSession.createDataFrame([(k, n, float(abs(c))) for k, (n, c) in enumerate(zip(names, w))], "slot int, feature string, w double")
    return table.join(scale, "slot").select("feature", (F.col("gap") * F.col("w")).alias("importance"))


def tree_paths(model, spark) -> tuple[list, float]:
    """Leaves of a tree ensemble as ``(value, [(feature, low, high, cover share)])``.

    Read from the saved model; its size is the model's, not the data's. Conditions on one
    feature along a path are merged into an interval ``low < x <= high``.
    """
    if hasattr(model, "leaf_paths"):
        return model.leaf_paths()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    nodes = spark.read.parquet(path + "/data").select("treeID", "nodeData.*").toPandas()
    weights = dict(enumerate(model.treeWeights))
    forest = model.hasParam("probabilityCol") and not model.hasParam("lossType")
    leaves: list = []
    base = 0.0
    for tree, part in nodes.groupby("treeID"):
        rows = {r.id: r for r in part.itertuples(index=False)}
        scale = weights[tree] / (len(weights) if forest else 1)

        def value(r) -> float:
            if not forest:
                return r.prediction * scale
            stats = np.asarray(r.impurityStats, dtype=float)
            return stats[1] / max(stats.sum(), 1e-300) * scale

        def walk(i: int, conditions: dict) -> None:
            nonlocal base
            r = rows[i]
            if r.leftChild < 0:
                leaves.append((value(r), [(f, lo, hi, share) for f, (lo, hi, share) in conditions.items()]))
                base += value(r) * math.prod(share for *_, share in conditions.values())
                return
            f, cut = r.split["featureIndex"], float(r.split["leftCategoriesOrThreshold"][0])
            for child, left in ((r.leftChild, True), (r.rightChild, False)):
                lo, hi, share = conditions.get(f, (-math.inf, math.inf, 1.0))
                share *= rows[child].rawCount / r.rawCount
                bounds = (lo, min(hi, cut), share) if left else (max(lo, cut), hi, share)
                walk(child, {**conditions, f: bounds})

        walk(0, {})
    return leaves, base


def attribute(x: np.ndarray, leaves: list) -> np.ndarray:
    """Path-dependent Shapley values of a batch of rows, leaf by leaf.

    On a leaf's path each feature either holds for the row or keeps its cover share; the
    sum over coalitions by size is a polynomial product.
    """
    phi = np.zeros_like(x, dtype=float)
    for value, path in leaves:
        m = len(path)
        if m == 0:
            continue
        holds = [((x[:, f] > lo) & (x[:, f] <= hi)).astype(float) for f, lo, hi, _ in path]
        size_weight = [math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)]
        for j, (f, _, _, share) in enumerate(path):
            poly = np.zeros((len(x), m))
            poly[:, 0] = 1.0
            for k, (*_, z) in enumerate(path):
                if k != j:
                    poly[:, 1:] = poly[:, 1:] * z + poly[:, :-1] * holds[k][:, None]
                    poly[:, 0] *= z
            phi[:, f] += value * (holds[j] - share) * (poly @ np.array(size_weight))
    return phi


def tree_importance(df: DataFrame, model, names: Sequence[str], features: str = "features") -> DataFrame:
    """mean |attribution| per feature over all rows; batches are reduced before they leave the task."""
    spark = df.sparkSession
    leaves, _ = tree_paths(model, spark)
    shared = spark.sparkContext.broadcast(leaves)  # one entry per leaf
    width = len(names)

    def batches(frames):
        for pdf in frames:
            if len(pdf):
                phi = np.abs(attribute(np.stack(pdf["x"].to_numpy()), shared.value))
                yield pd.DataFrame({"slot": np.arange(width), "total": phi.sum(axis=0), "n": len(pdf)})

    parts = df.select(vector_to_array(features).alias("x")).mapInPandas(batches, "slot int, total double, n long")
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("slot") + 1)
    return parts.groupBy("slot").agg((F.sum("total") / F.sum("n")).alias("importance")).select(label.alias("feature"), "importance")


def attribution_importance(df: DataFrame, model, names: Sequence[str], features: str = "features") -> DataFrame:
    kind = tree_importance if hasattr(model, "treeWeights") else linear_importance
    return kind(df, model, names, features)


# ---------------------------------------------------------------- permutation


def _indexed(df: DataFrame, row_id: str) -> tuple[DataFrame, int]:
    return row_positions(df, row_id, row_id, out="_i"), df.count()


def permutation_importance(
    df: DataFrame, columns: Sequence[str], score: Callable[[DataFrame], DataFrame], label: str, row_id: str,
    repeats: int = 5, seed: int = 42,
) -> DataFrame:
    """Mean and spread of the AUC lost when one column is shuffled.

    ``score`` adds ``p`` from the raw columns. A repeat takes its donor rows from one equi-join on the shuffled
    index, whatever the number of columns; which column is swapped is decided after it, row by row.
    """
    indexed, n = _indexed(df.select(row_id, label, *columns), row_id)
    indexed = pin(indexed)
    donors = indexed.select(F.col("_i").alias("_from"), *[F.col(c).alias("_d_" + c) for c in columns])
    features = F.explode(F.array(*map(F.lit, columns))).alias("feature")
    rounds = []
    for r in range(repeats):
        met = indexed.withColumn("_from", feistel_donor(F.col("_i"), n, seed + r)).join(donors, "_from").select("*", features)
        rounds.append(met.select(row_id, label, "feature", F.lit(r).alias("repeat"), *[
            F.when(F.col("feature") == c, F.col("_d_" + c)).otherwise(F.col(c)).alias(c) for c in columns]))
    swapped = reduce(DataFrame.unionByName, rounds)
    base = score_curve(score(df), "p", label).agg(auc_of().alias("auc")).first()["auc"]
    lost = (
        score_curve(score(swapped), "p", label, ["feature", "repeat"]).groupBy("feature", "repeat")
        .agg((F.lit(base) - auc_of()).alias("drop"))
    )
    return lost.groupBy("feature").agg(
        F.avg("drop").alias("importance"), F.coalesce(F.stddev_samp("drop"), F.lit(0.0)).alias("std")
    )


# ---------------------------------------------------------------- folds


def fold_importances(df: DataFrame, family: str, names: Sequence[str], row_id: str, features: str = "features",
                     label: str = "label", folds: int = 5, seed: int = 42, **params) -> DataFrame:
    """(feature, fold, importance): a model per fold, attributed over all rows."""
    dealt = row_kfold(df, row_id, folds, seed)
    out = None
    for k in range(folds):
        fitted = fit_family(dealt.filter(F.col("fold") != k), family, features, label, seed=seed, **params)
        one = attribution_importance(df, fitted.model, names, features).withColumn("fold", F.lit(k))
        out = one if out is None else out.unionByName(one)
    return out


def importance_stability(importances: DataFrame) -> DataFrame:
    """mean, sample std and stability = clip(1 - std / mean, 0, 1) over folds."""
    table = importances.groupBy("feature").agg(
        F.avg("importance").alias("mean_importance"), F.stddev_samp("importance").alias("std_importance")
    )
    stability = 1.0 - F.col("std_importance") / (F.col("mean_importance") + 1e-10)
    return table.withColumn("stability", F.least(F.greatest(stability, F.lit(0.0)), F.lit(1.0)))


def fold_table(importances: DataFrame, folds: int) -> DataFrame:
    """One column per fold, one row per feature: a pivot, not a join per fold."""
    wide = importances.groupBy("feature").pivot("fold", list(range(folds))).agg(F.first("importance"))
    return wide.select("feature", *[F.col(str(k)).alias(f"importance_fold_{k + 1}") for k in range(folds)])


def select_features(table: DataFrame, threshold: float = 0.6, top_k: int | None = None) -> DataFrame:
    ordered = table.orderBy(F.desc("mean_importance"), "feature")
    return ordered.filter(F.col("stability") >= threshold) if top_k is None else ordered.limit(top_k)


# ---------------------------------------------------------------- shadows


def binomial_tail(hits: int, trials: int) -> float:
    """P(X >= hits) for fair coin flips."""
    return sum(math.comb(trials, k) for k in range(hits, trials + 1)) / 2.0**trials


def discoveries(tails: Mapping[str, float], alpha: float) -> set[str]:
    """Names whose probabilities are small at a false discovery rate of ``alpha`` (step-up over the sorted values)."""
    ranked = sorted(tails, key=lambda k: (tails[k], k))
    cut = max((i + 1 for i, k in enumerate(ranked) if tails[k] <= alpha * (i + 1) / len(ranked)), default=0)
    return set(ranked[:cut])


def shuffled_columns(indexed: DataFrame, n: int, columns: Sequence[str], seed: int) -> DataFrame:
    """``_i`` and a shuffled copy of every column, each by a bijection of its own: the copies keep no joint distribution.

    A row sends each of its values to the row that takes it; one exchange brings the copies together.
    """
    sent = F.array(*[
        F.struct(feistel_donor(F.col("_i"), n, seed * 7919 + k).alias("_to"), F.lit(k).alias("_k"), F.col(c).cast("double").alias("_v"))
        for k, c in enumerate(columns)])
    long = indexed.select(F.inline(sent))
    return long.groupBy(F.col("_to").alias("_i")).agg(*[
        F.max(F.when(F.col("_k") == k, F.col("_v"))).alias(f"shadow_{c}") for k, c in enumerate(columns)])


def shadow_selection(df: DataFrame, columns: Sequence[str], label: str, row_id: str, rounds: int = 20, alpha: float = 0.05,
                     seed: int = 42, balanced: bool = True, **params) -> DataFrame:
    """(feature, hits, rounds, importance, decision): columns that beat the best shuffled copy.

    Every round shuffles each column still in the race by itself and fits one forest on columns and copies, classes weighted equally. A
    column is confirmed or rejected when its hits are unlikely under a fair coin, at a false discovery rate over the columns and
    a bound over the rounds so far; rejected ones leave, so later bars come from the rest. What is open after the last round is tested
    once more with a bound over the columns.
    """
    from pyspark.ml.feature import VectorAssembler

    from winnow.operators.imbalance import add_class_weights

    indexed, n = _indexed(df.select(row_id, label, *columns), row_id)
    weight = None
    if balanced:
        indexed, weight = add_class_weights(indexed, label), "weight"
    indexed = pin(indexed)
    hits, last, played = dict.fromkeys(columns, 0), dict.fromkeys(columns, 0.0), dict.fromkeys(columns, 0)
    decision = dict.fromkeys(columns, "tentative")
    for r in range(rounds):
        racing = [c for c in columns if decision[c] != "rejected"]
        if not any(decision[c] == "tentative" for c in columns):
            break
        copies = shuffled_columns(indexed, n, racing, seed + r)
        inputs = [*racing, *[f"shadow_{c}" for c in racing]]
        rows = VectorAssembler(inputCols=inputs, outputCol="features").transform(indexed.join(copies, "_i"))
        values = fit_family(rows, "random_forest", "features", label, weight, seed=seed + r, **params).model.featureImportances.toArray()
        bar = max(values[len(racing):])
        for c, v in zip(racing, values):
            hits[c] += int(v > bar)
            last[c], played[c] = float(v), r + 1
        open_ones = [c for c in racing if decision[c] == "tentative"]
        for name, tail in (("confirmed", lambda c: binomial_tail(hits[c], r + 1)), ("rejected", lambda c: binomial_tail(r + 1 - hits[c], r + 1))):
            tails = {c: tail(c) for c in open_ones}
            for c in discoveries(tails, alpha):
                if tails[c] <= alpha / (r + 1):
                    decision[c] = name
    for c in columns:  # once more at the end, over the columns alone
        if decision[c] == "tentative":
            for name, tail in (("confirmed", binomial_tail(hits[c], rounds)), ("rejected", binomial_tail(rounds - hits[c], rounds))):
                decision[c] = name if tail < alpha / max(len(columns), 1) else decision[c]
    rows = [(c, hits[c], played[c], last[c], decision[c]) for c in columns]
    return df.sparkSession.createDataFrame(rows, "feature string, hits int, rounds int, importance double, decision string")


# ---------------------------------------------------------------- comparing methods


def combine_methods(methods: Mapping[str, DataFrame]) -> DataFrame:
    """Full outer join on feature with the mean of the importances present."""
    named = [df.select("feature", F.col("importance").alias(f"importance_{k}")) for k, df in methods.items()]
    out = reduce(lambda a, b: a.join(b, "feature", "full_outer"), named)
    cells = [F.col(f"importance_{k}") for k in methods]
    present = sum((c.isNotNull().cast("int") for c in cells), F.lit(0))
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cells), F.lit(0.0))
    return out.withColumn("mean_importance", total / present)


def method_ranks(importances: DataFrame) -> DataFrame:
    """``(method, feature, importance)`` -> rank 1..n within each method."""
    from winnow.operators.selection import rank_within

    return rank_within(importances, "method", "importance", "feature")


def rank_agreement(ranks: DataFrame, a: str, b: str) -> DataFrame:
    """Spearman correlation of two methods' ranks; a feature one method lacks ranks last + 1."""
    worst = ranks.filter(F.col("method").isin(a, b)).agg(F.max("rank") + 1).scalar()
    pick = lambda m, n: ranks.filter(F.col("method") == m).select("feature", F.col("rank").alias(n))
    both = pick(a, "ra").join(pick(b, "rb"), "feature", "full_outer").select(
        F.coalesce("ra", worst).cast("double").alias("ra"), F.coalesce("rb", worst).cast("double").alias("rb")
    )
    from winnow.operators.stat_tests import average_ranks

    fine = both.join(average_ranks(both, [], "ra").withColumnRenamed("rank", "xa"), "ra").join(
        average_ranks(both, [], "rb").withColumnRenamed("rank", "xb"), "rb"
    )
    return fine.agg(safe_corr(F.col("xa"), F.col("xb")).alias("r"))


def top_overlap(ranks: DataFrame, a: str, b: str, k: int = 20) -> DataFrame:
    """Features among the best ``k`` of both methods."""
    best = lambda m: ranks.filter((F.col("method") == m) & (F.col("rank") <= k)).select("feature")
    return best(a).intersect(best(b))
