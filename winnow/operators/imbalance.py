"""Class imbalance: weights, replication and synthetic minority rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.operators.kernels import row_positions, uniform_key

MAX_CLASSES = 1000


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): ``balanced`` weights n / (k * n_c)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total, classes = counts.agg(F.sum("n")).scalar(), counts.agg(F.count(F.lit(1))).scalar()
    return counts.select(label, "n", (total / (classes * F.col("n"))).alias("weight"))


def class_sizes(df: DataFrame, label: str) -> dict:
    rows = df.filter(F.col(label).isNotNull()).groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return {r[0]: r[1] for r in rows}


def add_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    sizes = class_sizes(df, label)
    total, value = sum(sizes.values()), F.lit(None).cast("double")
    for k, n in sizes.items():
        value = F.when(F.col(label) == k, total / (len(sizes) * n)).otherwise(value)
    return df.withColumn(out, value)


def _class_order(df: DataFrame, label: str, row_id: str, seed: int) -> DataFrame:
    key = uniform_key(F.concat_ws("|", F.col(row_id).cast("string"), F.lit(str(seed))))
    rows = df.filter(F.col(label).isNotNull()).withColumn("_h", key)
    return row_positions(rows, "_h", row_id, keys=[label])


def oversample(df: DataFrame, label: str, row_id: str, seed: int = 42) -> DataFrame:
    """Replicate rows until every class is as large as the largest; ``copy`` numbers the copies.

    Every row gets the whole number of copies, and the first rows in digest order one more.
    """
    sizes = class_sizes(df, label)
    top, copies = max(sizes.values()), F.lit(1).cast("long")
    for k, n in sizes.items():
        more = F.when(F.col("pos") < top % n, top // n + 1).otherwise(top // n).cast("long")
        copies = F.when(F.col(label) == k, more).otherwise(copies)
    ranked = _class_order(df, label, row_id, seed)
    return ranked.select(*df.columns, F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("copy"))


def undersample(df: DataFrame, label: str, row_id: str, seed: int = 42) -> DataFrame:
    """Keep as many rows of every class, first in digest order, as the smallest has."""
    least = min(class_sizes(df, label).values())
    return _class_order(df, label, row_id, seed).filter(F.col("pos") < least).select(*df.columns)


def positive_rate(df: DataFrame, label: str) -> float:
    return df.agg(F.avg(F.col(label).cast("double"))).first()[0]


def needs_balancing(df: DataFrame, label: str, threshold: float = 0.2) -> bool:
    rate = positive_rate(df, label)
    return rate is not None and min(rate, 1.0 - rate) < threshold


