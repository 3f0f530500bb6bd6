"""Descriptive tables: one scan per table, not per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.operators.kernels import chunks, exact_quantiles, stats_to_rows, unpivot
from winnow.roles import is_numeric


def _num(c: str) -> Column:
    return F.col(c).cast("double")


def _literal_per(values: dict[str, list], i: int):
    return lambda c: F.lit(values[c][i]).cast("double")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles (interpolated), max per column."""
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    parts = []
    for part in chunks(list(columns), 40):
        wide = df.agg(*[
            e for c in part for e in (
                F.count(c).alias(f"{c}__n"), F.avg(_num(c)).alias(f"{c}__mean"), F.stddev_samp(_num(c)).alias(f"{c}__std"),
                F.min(_num(c)).alias(f"{c}__min"), F.max(_num(c)).alias(f"{c}__max"),
            )
        ])
        get = lambda s: (lambda c: F.col(f"{c}__{s}"))
        parts.append(stats_to_rows(wide, part, {
            "count": get("n"), "mean": get("mean"), "std": get("std"), "min": get("min"),
            "q25": _literal_per(quartiles, 0), "q50": _literal_per(quartiles, 1), "q75": _literal_per(quartiles, 2),
            "max": get("max"),
        }))
    return _stack(parts)


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, count, pct of all rows) for every categorical column, one shuffle."""
    long = unpivot(df, columns, dtype="string").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
    # every row counts once per feature; the subquery reads the same exchange
    total = long.agg(F.sum("count") / len(columns)).scalar()
    return long.filter("value IS NOT NULL").select("feature", "value", "count", _share(total, F.col("count")).alias("pct"))


def missing_stats(df: DataFrame) -> DataFrame:
    columns = df.columns
    parts = []
    for part in chunks(columns):
        wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in part])
        parts.append(stats_to_rows(wide, part, {
            "missing": lambda c: F.col(c), "pct": lambda c: 100.0 * F.col(c) / F.col("_n"),
        }))
    return _stack(parts).orderBy(F.desc("missing"), "feature")


def _share(total: Column, part: Column) -> Column:
    return 100.0 * part / total


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(target, "count", _share(counts.agg(F.sum("count")).scalar(), F.col("count")).alias("pct"))


def conversion_by(df: DataFrame, key: str, target: str) -> DataFrame:
    """Per key: count, converted, rate, share of all rows; best rate first.

    The total is its own aggregate, so that a key of any cardinality never passes
    through a single task.
    """
    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"), F.sum(target).alias("converted"))
    # the unused second sum keeps the subquery's columns, and so its exchange, the same
    total = rows.agg(F.struct(F.sum("count").alias("n"), F.sum("converted"))).scalar()["n"]
    return (
        rows.select(key, "count", "converted", (F.col("converted") / F.col("count")).alias("rate"),
                    _share(total, F.col("count")).alias("pct_total"))
        .orderBy(F.desc("rate"), key)
    )


def top_k(df: DataFrame, by: Column, k: int, *tie: str) -> DataFrame:
    return df.orderBy(by, *tie).limit(k)


def cohort_analysis(df: DataFrame, cohorts: dict[str, Column], target: str, min_rows: int = 1) -> DataFrame:
    """(cohort_type, cohort_value, count, converted, rate, pct_total) over many cohort variables.

    The grouping sets are the single columns, so one scan feeds one long aggregate with
    map-side combine.
    """
    cells = F.array(*[
        F.struct(F.lit(n).alias("cohort_type"), e.cast("string").alias("cohort_value")) for n, e in cohorts.items()
    ])
    long = df.select(F.col(target).alias("_y"), F.inline(cells)).filter("cohort_value IS NOT NULL")
    table = long.groupBy("cohort_type", "cohort_value").agg(
        F.count(F.lit(1)).alias("count"), F.sum("_y").alias("converted")
    )
    totals = table.groupBy("cohort_type").agg(F.sum("count").alias("total"))
    return (
        table.join(totals, "cohort_type").filter(F.col("count") >= min_rows)
        .select("cohort_type", "cohort_value", "count", "converted", (F.col("converted") / F.col("count")).alias("rate"),
                _share(F.col("total"), F.col("count")).alias("pct_total"))
    )


def top_cohorts(cohorts: DataFrame, k: int = 10, min_rows: int = 5) -> DataFrame:
    """Best ``k`` values per cohort type among those with enough rows.

    Spark keeps only k rows per type before the shuffle (window group limit).
    """
    best = Window.partitionBy("cohort_type").orderBy(F.desc("rate"), "cohort_value")
    return (
        cohorts.filter(F.col("count") >= min_rows).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    )


def corrected_skew(c: Column, n: Column) -> Column:
    """G1 from the population skewness."""
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurtosis(c: Column, n: Column) -> Column:
    """G2 from the population excess kurtosis."""
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def skew_kurtosis(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    parts = []
    for part in chunks(list(columns), 60):
        wide = df.agg(*[
            e for c in part for e in (
                corrected_skew(_num(c), F.count(c).cast("double")).alias(f"{c}__skew"),
                corrected_kurtosis(_num(c), F.count(c).cast("double")).alias(f"{c}__kurt"),
            )
        ])
        parts.append(stats_to_rows(wide, part, {
            "skew": lambda c: F.col(f"{c}__skew"), "kurtosis": lambda c: F.col(f"{c}__kurt"),
        }))
    return _stack(parts)


def most_common(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, count) of the most frequent value; ties go to the smallest."""
    counts = (
        unpivot(df, columns, dtype="string").filter("value IS NOT NULL")
        .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
    )
    best = F.min_by(F.struct("value", "count"), F.struct((-F.col("count")).alias("c"), "value")).alias("best")
    return counts.groupBy("feature").agg(best).select("feature", "best.value", "best.count")


def feature_profile(df: DataFrame, columns: Sequence[str], approx_distinct: bool = False) -> DataFrame:
    """dtype, missing ratio, distinct count and ratio, moments and mode per column."""
    numeric = {f.name for f in df.schema if is_numeric(f.dataType)}
    dtypes = {f.name: ("numeric" if f.name in numeric else "categorical") for f in df.schema}
    parts = []
    for part in chunks(list(columns), 25):
        aggs = [F.count(F.lit(1)).alias("_n")]
        for c in part:
            aggs.append(F.count(c).alias(f"{c}__n"))
            if approx_distinct:
                aggs.append(F.approx_count_distinct(c).alias(f"{c}__nu"))
            if c in numeric:
                n = F.count(c).cast("double")
                aggs += [
                    F.avg(_num(c)).alias(f"{c}__mean"), F.stddev_samp(_num(c)).alias(f"{c}__std"),
                    F.min(_num(c)).alias(f"{c}__min"), F.max(_num(c)).alias(f"{c}__max"),
                    corrected_skew(_num(c), n).alias(f"{c}__skew"), corrected_kurtosis(_num(c), n).alias(f"{c}__kurt"),
                ]
        stat = lambda s: (lambda c: F.col(f"{c}__{s}") if c in numeric else F.lit(None).cast("double"))
        stats = {
            "dtype": lambda c: F.lit(dtypes[c]), "rows": lambda c: F.col("_n"),
            "na_ratio": lambda c: 1.0 - F.col(f"{c}__n") / F.col("_n"),
        }
        if approx_distinct:
            stats["nunique"] = lambda c: F.col(f"{c}__nu")
        for s in ("mean", "std", "min", "max", "skew", "kurt"):
            stats[s] = stat(s)
        parts.append(stats_to_rows(df.agg(*aggs), part, stats))
    base = _stack(parts)
    # value counts give the mode and, exactly and without a distinct-per-column expansion, nunique
    counts = (
        unpivot(df, columns, dtype="string").filter("value IS NOT NULL")
        .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
    )
    number = F.when(F.col("feature").isin(sorted(numeric)), F.col("value").try_cast("double"))
    rank = F.struct((-F.col("count")).alias("c"), number.alias("x"), "value")
    best = F.min_by(F.struct("value", "count"), rank).alias("best")
    extra = [] if approx_distinct else [F.count(F.lit(1)).alias("nunique")]
    modes = counts.groupBy("feature").agg(best, *extra)
    out = base.join(modes, "feature", "left")
    nunique = F.coalesce(F.col("nunique"), F.lit(0))
    return out.select(
        "feature", "dtype", "na_ratio", nunique.alias("nunique"), (nunique / F.col("rows")).alias("unique_ratio"),
        "mean", "std", "min", "max", "skew", F.col("kurt").alias("kurtosis"),
        F.col("best.value").alias("top_value"), (F.col("best.count") / F.col("rows")).alias("top_ratio"),
    )


def crosstab(df: DataFrame, category: str, target: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    return (
        df.groupBy(category).pivot(target, list(classes)).count()
        .select(category, *[F.coalesce(F.col(str(k)), F.lit(0)).alias(f"n_{k}") for k in classes])
    )


def top_variance(df: DataFrame, columns: Sequence[str], k: int = 30) -> DataFrame:
    parts = []
    for part in chunks(list(columns)):
        wide = df.agg(*[F.var_samp(_num(c)).alias(c) for c in part])
        parts.append(stats_to_rows(wide, part, {"variance": F.col}))
    return top_k(_stack(parts), F.desc("variance"), k, "feature")
