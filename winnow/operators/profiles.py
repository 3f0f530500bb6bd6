"""Column profiles that merge: one small state a day and column, from which any span of days is described without its rows.

Counts, moments and extremes are exact. Quantiles come from a sketch whose ranks are off by at most ``RANK_ERROR`` (at 99 %),
distinct counts from one that is off by about ``DISTINCT_ERROR``; both merge, and merging does not add to the error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winnow.operators.kernels import chunks

QUANTILE_SIZE, RANK_ERROR = 400, 0.01  # items of a quantile sketch; the documented bound is below this
DISTINCT_BITS, DISTINCT_ERROR = 14, 0.02  # registers by power of two; about two standard errors
MOMENTS = ("rows", "n", "mean", "m2", "low", "high")


def _cells(c: str, numeric: bool) -> dict[str, Column]:
    value = F.nullif(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) if numeric else F.lit(None).cast("double")
    present = value if numeric else F.col(f"`{c}`")
    n = F.count(present)
    return {
        "rows": F.count(F.lit(1)), "n": n, "mean": F.avg(value), "m2": F.var_pop(value) * n, "low": F.min(value), "high": F.max(value),
        "quantiles": F.kll_sketch_agg_double(value, QUANTILE_SIZE) if numeric else F.lit(None).cast("binary"),
        "distinct": F.hll_sketch_agg(present.cast("string"), DISTINCT_BITS),
    }


def daily_states(df: DataFrame, time: str, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """``day, feature, rows, n, mean, m2, low, high, quantiles, distinct``: one aggregate by day for all columns side by side.

    NULL and NaN are missing; rows without a time have the NULL day.
    """
    out = None
    for part in chunks([*numeric, *categorical], 20):
        cells = {c: _cells(c, c in set(numeric)) for c in part}
        wide = df.groupBy(F.col(f"`{time}`").cast("date").alias("day")).agg(*[
            e.alias(f"s{i}_{k}") for i, c in enumerate(part) for k, e in cells[c].items()])
        rows = F.array(*[
            F.struct(F.lit(c).alias("feature"), *[F.col(f"s{i}_{k}").alias(k) for k in cells[c]]) for i, c in enumerate(part)])
        long = wide.select("day", F.inline(rows))
        out = long if out is None else out.unionByName(long)
    return out


def store_states(states: DataFrame, path: str) -> None:
    """A day that is stored again replaces its earlier state, other days stay."""
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def stored_states(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """States of the days from ``first`` to ``last``; other days' files are not opened."""
    out = spark.read.parquet(path)
    day = F.col("day").cast("date")
    if first is not None:
        out = out.filter(day >= F.lit(first).cast("date"))
    return out if last is None else out.filter(day <= F.lit(last).cast("date"))


def merged_profile(states: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``feature, rows, count, missing, mean, std, min, max, q…, nunique`` over all states given."""
    over = Window.partitionBy("feature")
    share = F.sum(F.col("mean") * F.col("n")).over(over) / F.nullif(F.sum(F.when(F.col("mean").isNotNull(), F.col("n"))).over(over), F.lit(0))
    gathered = states.withColumn("_mean", share).groupBy("feature").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("count"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2).alias("_m2"), F.min("low").alias("min"), F.max("high").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("_q"), F.hll_union_agg("distinct").alias("_d"))
    named = {p: "q" + f"{100 * p:g}".replace(".", "_") for p in probs}
    quantile = lambda p: F.when(F.col("min").isNotNull(), F.kll_sketch_get_quantile_double("_q", F.lit(float(p))))
    return gathered.select(
        "feature", "rows", "count", (F.col("rows") - F.col("count")).alias("missing"), "mean",
        F.sqrt(F.col("_m2") / F.nullif(F.col("count") - 1, F.lit(0))).alias("std"), "min", "max",
        *[quantile(p).alias(name) for p, name in named.items()], F.hll_sketch_estimate("_d").alias("nunique"))
