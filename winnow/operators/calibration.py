"""Probability calibration, segments and their tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.functions.scalar import (
    SEGMENT_EDGES, SEGMENT_LABELS, assign_segment, cut_right_closed, equal_width_bin,
)
from winnow.operators.evaluation import auc_of, brier_of, score_curve
from winnow.operators.kernels import stats_to_rows
from winnow.session import stored

# ---------------------------------------------------------------- calibrators


@dataclass
class Calibrator:
    """``transform`` adds the calibrated probability of a raw score."""

    kind: str
    model: object

    def transform(self, df: DataFrame, score: str, out: str = "calibrated") -> DataFrame:
        if self.kind == "isotonic":
            # the vector form keeps the model's own clipping at both ends
            rows = self.model.transform(VectorAssembler(inputCols=[score], outputCol="_v").transform(df))
            value = F.least(F.greatest(F.col("_cal"), F.lit(0.0)), F.lit(1.0))
            return rows.withColumn(out, value).drop("_v", "_cal")
        rows = self.model.transform(VectorAssembler(inputCols=[score], outputCol="_v").transform(df))
        return rows.withColumn(out, vector_to_array("_cal")[1]).drop("_v", "_cal", "_raw", "_pred")


def pool(value: np.ndarray, weight: np.ndarray) -> list[tuple[int, int, float, float]]:
    """Adjacent violators pooled: (first, last, mean, weight) of each block."""
    blocks: list[tuple[int, int, float, float]] = []
    for k, (v, w) in enumerate(zip(value.tolist(), weight.tolist())):
        now = (k, k, v, w)
        while blocks and blocks[-1][2] >= now[2]:
            a = blocks.pop()
            total = a[3] + now[3]
            now = (a[0], now[1], (a[2] * a[3] + now[2] * now[3]) / total, total)
        blocks.append(now)
    return blocks


def _pool_ranges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames), ignore_index=True)
    if len(rows):
        rows = rows.sort_values("s")
        s = rows["s"].to_numpy()
        blocks = pool(rows["label"].to_numpy(), rows["w"].to_numpy())
        ends = [(s[x], m, w / 2) for a, b, m, w in blocks for x in (a, b)]
        yield pd.DataFrame(ends, columns=["s", "label", "w"]).groupby("s", as_index=False).agg({"label": "first", "w": "sum"})


def fit_isotonic(df: DataFrame, score: str, label: str) -> Calibrator:
    """Distinct scores enter once, weighted, and are pooled inside score ranges first.

    Pooling may go in any order, so pooling each range and then the ranges' blocks gives the fit over all
    scores, at any size and without rounding. A block stays as its two end points, half its weight each. What the
    library pools on the driver in the end are the blocks.
    """
    points = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.avg(F.col(label).cast("double")).alias("label"), F.count(F.lit(1)).cast("double").alias("w")
    ).filter("s IS NOT NULL AND label IS NOT NULL")
    ranges = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pooled = points.repartitionByRange(ranges, "s").mapInPandas(_pool_ranges, "s double, label double, w double")
    rows = VectorAssembler(inputCols=["s"], outputCol="_v").transform(stored(pooled, "isotonic"))
    est = IsotonicRegression(featuresCol="_v", labelCol="label", weightCol="w", predictionCol="_cal")
    return Calibrator("isotonic", est.fit(rows))


def fit_platt(df: DataFrame, score: str, label: str) -> Calibrator:
    """One-feature logistic regression; calibrated values are probabilities."""
    points = df.groupBy(F.col(score).cast("double").alias(score), F.col(label).cast("double").alias("label")).agg(
        F.count(F.lit(1)).cast("double").alias("w")
    )
    rows = VectorAssembler(inputCols=[score], outputCol="_v").transform(points)
    est = LogisticRegression(
        featuresCol="_v", labelCol="label", weightCol="w", probabilityCol="_cal", rawPredictionCol="_raw",
        predictionCol="_pred", regParam=0.0, standardization=False,
    )
    return Calibrator("sigmoid", est.fit(rows))


@dataclass(frozen=True)
class CalibratorScore:
    brier: float
    ordered: bool
    covered: bool


def decide(sigmoid: CalibratorScore, isotonic: CalibratorScore, close: float = 0.01) -> str:
    """Close Brier scores are decided by segment order, then coverage, then Brier."""
    worst = max(sigmoid.brier, isotonic.brier)
    gap = abs(sigmoid.brier - isotonic.brier) / worst if worst else 0.0
    if gap < close:
        for question in ("ordered", "covered"):
            a, b = getattr(sigmoid, question), getattr(isotonic, question)
            if a != b:
                return "sigmoid" if a else "isotonic"
    return "sigmoid" if sigmoid.brier <= isotonic.brier else "isotonic"


def calibrator_metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """What the decision reads for one candidate: Brier and the three segment rates and sizes."""
    seg = assign_segment(F.col(score))
    aggs = [brier_of(score, label).alias("brier"), F.count(F.lit(1)).alias("n")]
    for name in SEGMENT_LABELS:
        aggs += [
            F.count_if(seg == name).alias(f"n_{name.lower()}"), F.avg(F.when(seg == name, F.col(label))).alias(f"rate_{name.lower()}")
        ]
    return df.agg(*aggs)


def score_of(df: DataFrame, score: str, label: str) -> CalibratorScore:
    row = calibrator_metrics(df, score, label).first()
    rates = [row[f"rate_{s.lower()}"] for s in SEGMENT_LABELS]
    sizes = [row[f"n_{s.lower()}"] for s in SEGMENT_LABELS]
    return CalibratorScore(row["brier"], rates_ordered(rates), min(sizes) >= coverage_threshold(row["n"]))


def rates_ordered(rates: Sequence[float | None]) -> bool:
    return None not in rates and all(a < b for a, b in zip(rates, rates[1:]))


def coverage_threshold(n: int, usual: int = 10) -> int:
    if n < 100:
        return max(2, int(n * 0.05))
    if n < 1000:
        return max(5, int(n * 0.02))
    return usual


def choose_calibrator(validation: DataFrame, score: str, label: str, close: float = 0.01) -> tuple[Calibrator, str]:
    """Fit both on validation and keep the better one."""
    fits = {"sigmoid": fit_platt(validation, score, label), "isotonic": fit_isotonic(validation, score, label)}
    marks = {k: score_of(c.transform(validation, score), "calibrated", label) for k, c in fits.items()}
    best = decide(marks["sigmoid"], marks["isotonic"], close)
    return fits[best], best


# ---------------------------------------------------------------- tables


def bin_stats(df: DataFrame, score: str, label: str, edges: Sequence[float] = SEGMENT_EDGES,
              labels: Sequence[str] = SEGMENT_LABELS) -> DataFrame:
    """Right-closed bins: count, mean label and score, range, percent and signed error."""
    binned = df.select(cut_right_closed(F.col(score), edges, labels).alias("bin"), F.col(score).alias("p"),
                       F.col(label).alias("y")).filter("bin IS NOT NULL")
    stats = binned.groupBy("bin").agg(
        F.count("y").alias("count"), F.avg("y").alias("mean_true"), F.avg("p").alias("mean_pred"),
        F.min("p").alias("min_pred"), F.max("p").alias("max_pred"),
    )
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))  # one row per label
    return stats.select("*", (100.0 * F.col("count") / total).alias("percent"),
                        (F.col("mean_true") - F.col("mean_pred")).alias("calibration_error"))


def binwise_metrics(df: DataFrame, score: str, label: str, edges: Sequence[float] = SEGMENT_EDGES,
                    labels: Sequence[str] = SEGMENT_LABELS) -> DataFrame:
    """Every label in fixed order; labels without rows read 0."""
    seg = assign_segment(F.col(score), edges, labels)
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[
        e for i, name in enumerate(labels) for e in (
            F.count_if(seg == name).alias(f"n{i}"), F.avg(F.when(seg == name, F.col(label).cast("double"))).alias(f"y{i}"),
            F.avg(F.when(seg == name, F.col(score))).alias(f"p{i}"),
        )
    ])
    zero = lambda e: F.coalesce(e, F.lit(0.0))
    slots = [str(i) for i in range(len(labels))]
    return stats_to_rows(wide, slots, {
        "segment": lambda i: F.lit(labels[int(i)]), "count": lambda i: F.col(f"n{i}"),
        "conversion_rate": lambda i: zero(F.col(f"y{i}")), "mean_score": lambda i: zero(F.col(f"p{i}")),
        "percent": lambda i: zero(100.0 * F.col(f"n{i}") / F.nullif(F.col("n"), F.lit(0))),
    }, name="slot").select(F.col("slot").cast("int").alias("position"), "segment", "count", "conversion_rate", "mean_score", "percent")


def segment_order(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: are all segments present and their rates strictly increasing?"""
    m = calibrator_metrics(df, score, label)
    low, mid, high = (F.col(f"rate_{s.lower()}") for s in SEGMENT_LABELS)
    return m.select("rate_low", "rate_medium", "rate_high",
                    F.coalesce((low < mid) & (mid < high), F.lit(False)).cast("int").alias("ordered"))


def segment_coverage(df: DataFrame, score: str, label: str, usual: int = 10) -> DataFrame:
    """One row: segment sizes, the size each must reach, and whether all do."""
    n = F.col("n")
    need = (
        F.when(n < 100, F.greatest(F.lit(2), F.floor(n * 0.05))).when(n < 1000, F.greatest(F.lit(5), F.floor(n * 0.02)))
        .otherwise(usual).cast("int")
    )
    least = F.least(*[F.col(f"n_{s.lower()}") for s in SEGMENT_LABELS])
    return calibrator_metrics(df, score, label).select(
        "n", "n_low", "n_medium", "n_high", need.alias("threshold"), (least >= need).cast("int").alias("covered")
    )


def reliability_bins(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Equal-width bins that hold rows: count, true rate, mean prediction, absolute error."""
    table = df.filter(F.col(score).isNotNull()).groupBy(equal_width_bin(F.col(score), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.avg(label).alias("true_rate"), F.avg(score).alias("avg_pred")
    )
    return table.select(
        "bin", (F.col("bin") / bins).alias("bin_min"), ((F.col("bin") + 1) / bins).alias("bin_max"), "count", "true_rate",
        "avg_pred", F.abs(F.col("true_rate") - F.col("avg_pred")).alias("error"),
    )


def segment_migration(df: DataFrame, before: str, after: str) -> DataFrame:
    """Rows per (segment before, segment after) calibration."""
    return df.groupBy(
        assign_segment(F.col(before)).alias("segment_before"), assign_segment(F.col(after)).alias("segment_after")
    ).agg(F.count(F.lit(1)).alias("count"))


def compare_sets(sets: dict[str, DataFrame], score: str, calibrated: str, label: str) -> DataFrame:
    """(dataset, metric, raw, calibrated): AUC and Brier, each on its own rows."""
    out = None
    for name, df in sets.items():
        for metric in ("auc", "brier"):
            values = []
            for column in (score, calibrated):
                table = (
                    score_curve(df, column, label).agg(auc_of().alias("v")) if metric == "auc"
                    else df.agg(brier_of(column, label).alias("v"))
                )
                values.append(table.scalar())
            one = df.sparkSession.range(1).select(
                F.lit(name).alias("dataset"), F.lit(metric).alias("metric"), values[0].alias("raw"), values[1].alias("calibrated")
            )
            out = one if out is None else out.unionByName(one)
    return out
