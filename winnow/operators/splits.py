"""Leak-safe train / validation / test splits and folds, as a ``split`` or ``fold`` column.

Group splits decide on the aggregated group table and join the decision back by key;
a hot group is split by AQE's skew join, never gathered into one window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.operators.kernels import row_positions, uniform_key

SETS = ("train", "validation", "test")


def _ts(value) -> Column:
    return F.lit(value).cast("timestamp_ntz") if isinstance(value, str) else F.lit(value)


def time_split(df: DataFrame, time: str, train_cutoff, val_cutoff, test_cutoff=None) -> DataFrame:
    """Rows by their own date; beyond ``test_cutoff`` they are dropped."""
    t = F.col(time)
    label = F.when(t <= _ts(train_cutoff), "train").when(t <= _ts(val_cutoff), "validation")
    late = t > _ts(val_cutoff) if test_cutoff is None else (t > _ts(val_cutoff)) & (t <= _ts(test_cutoff))
    return df.withColumn("split", label.when(late, "test")).filter("split IS NOT NULL")


def group_first_time(df: DataFrame, time: str, group: str) -> DataFrame:
    return (
        df.filter(F.col(group).isNotNull() & F.col(time).isNotNull())
        .groupBy(group).agg(F.min(time).alias("first_time"))
    )


def label_groups(df: DataFrame, groups: DataFrame, group: str, column: str = "split") -> DataFrame:
    return df.join(groups.select(group, column), group, "inner")


def time_group_split(df: DataFrame, time: str, group: str, train_cutoff, val_cutoff, truncate_future=None,
                     force_balance: bool = False) -> DataFrame:
    """The group's first date decides for all its rows; rows without group or date are dropped.

    ``truncate_future`` also drops rows later than that date. ``force_balance`` fills an
    empty validation set from train, then an empty test set from validation.
    """
    first = F.col("first_time")
    groups = group_first_time(df, time, group).withColumn(
        "split",
        F.when(first <= _ts(train_cutoff), "train").when(first <= _ts(val_cutoff), "validation").otherwise("test"),
    )
    if force_balance:
        groups = balance_groups(groups, group)
    rows = df.filter(F.col(time).isNotNull())
    if truncate_future is not None:
        rows = rows.filter(F.col(time) <= _ts(truncate_future))
    return label_groups(rows, groups, group)


def balance_groups(groups: DataFrame, group: str, share: float = 0.1) -> DataFrame:
    """Move the latest ``ceil(share)`` groups of the donor into an empty set."""
    for empty, donor in (("validation", "train"), ("test", "validation")):
        sizes = {r["split"]: r["count"] for r in groups.groupBy("split").count().collect()}
        if sizes.get(empty) or sizes.get(donor, 0) < 2:
            continue
        n, moved = sizes[donor], math.ceil(share * sizes[donor])
        ranked = row_positions(
            groups.filter(F.col("split") == donor).withColumn("_at", F.unix_micros(F.col("first_time").cast("timestamp"))),
            "_at", group,
        )
        fresh = F.when(F.col("pos") >= n - moved, empty).otherwise(donor)
        groups = groups.filter(F.col("split") != donor).unionByName(
            ranked.withColumn("split", fresh).select(*groups.columns)
        )
    return groups


def date_based_split(
    df: DataFrame, time: str, group: str | None, train_end, validation_start=None, validation_end=None,
    test_start=None, test_end=None,
) -> DataFrame:
    """Explicit date ranges; a group goes to the first of train, validation, test it appears in.

    Without ``validation_end`` there are only train and hold rows.
    """
    t = F.col(time)
    if validation_end is None:
        return df.filter(t.isNotNull()).withColumn("split", F.when(t <= _ts(train_end), "train").otherwise("hold"))
    validation_start = validation_start or train_end
    test_start = test_start or validation_end
    in_test = t > _ts(test_start)
    if test_end is not None:
        in_test = in_test & (t <= _ts(test_end))
    priority = (
        F.when(t <= _ts(train_end), 0)
        .when((t > _ts(validation_start)) & (t <= _ts(validation_end)), 1)
        .when(in_test, 2)
    )
    name = lambda p: F.when(p == 0, "train").when(p == 1, "validation").when(p == 2, "test")
    if group is None:
        return df.withColumn("split", name(priority)).filter("split IS NOT NULL")
    groups = (
        df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.min(priority).alias("_p"))
        .filter("_p IS NOT NULL").withColumn("split", name(F.col("_p")))
    )
    return label_groups(df, groups, group)


def _tail_labels(pos: Column, n: int, test_size: float, val_size: float) -> Column:
    n_test, n_val = int(n * test_size), int(n * val_size)
    return (
        F.when(pos >= n - n_test, "test").when(pos >= n - n_test - n_val, "validation").otherwise("train")
    )


def percentage_split(df: DataFrame, time: str, key: str, test_size: float = 0.2, val_size: float = 0.15,
                     grouped: bool = True) -> DataFrame:
    """Latest share to test, the share before it to validation.

    ``grouped``: groups ordered by their last date. Otherwise rows by (time, key).
    """
    if not grouped:
        rows = df.withColumn("_at", F.unix_micros(F.col(time).cast("timestamp")))
        n = df.count()
        return (
            row_positions(rows, "_at", key).withColumn("split", _tail_labels(F.col("pos"), n, test_size, val_size))
            .drop("_at", "pos")
        )
    groups = (
        df.filter(F.col(key).isNotNull()).groupBy(key)
        .agg(F.unix_micros(F.max(time).cast("timestamp")).alias("_at"))
    )
    n = groups.count()
    ranked = row_positions(groups, "_at", key).withColumn("split", _tail_labels(F.col("pos"), n, test_size, val_size))
    return label_groups(df, ranked, key)


def rate_stratum(rate: Column) -> Column:
    """0 for rate 0, then steps of 0.2, right-closed."""
    return (
        F.when(rate <= 0, 0).when(rate <= 0.2, 1).when(rate <= 0.4, 2).when(rate <= 0.6, 3).when(rate <= 0.8, 4).otherwise(5)
    )


def _digest(key: str, seed: int) -> Column:
    return uniform_key(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def stratified_group_split(df: DataFrame, group: str, target: str, test_size: float = 0.2, val_size: float = 0.15,
                           seed: int = 42) -> DataFrame:
    """Per stratum of the group's target rate, groups in digest order: test, validation, train."""
    groups = (
        df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.avg(target).alias("_rate"))
        .select(group, rate_stratum(F.col("_rate")).alias("stratum"), _digest(group, seed).alias("_h"))
    )
    ranked = row_positions(groups, "_h", group, keys=["stratum"])
    sizes = groups.groupBy("stratum").agg(F.count(F.lit(1)).alias("_n"))
    n_test, n_val = (F.floor(F.col("_n") * s + 0.5) for s in (test_size, val_size))
    labelled = ranked.join(F.broadcast(sizes), "stratum").withColumn(  # six strata
        "split",
        F.when(F.col("pos") < n_test, "test").when(F.col("pos") < n_test + n_val, "validation").otherwise("train"),
    )
    return label_groups(df, labelled, group)


def size_bucket(n: Column) -> Column:
    return F.when(n <= 1, 0).when(n <= 4, 1).when(n <= 16, 2).when(n <= 64, 3).otherwise(4)


def group_kfold(df: DataFrame, group: str, target: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Groups dealt round-robin in digest order within (rate, size) strata."""
    groups = (
        df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.avg(target).alias("_rate"), F.count(F.lit(1)).alias("_n"))
        .select(group, (rate_stratum(F.col("_rate")) * 5 + size_bucket(F.col("_n"))).alias("stratum"),
                _digest(group, seed).alias("_h"))
    )
    folds = row_positions(groups, "_h", group, keys=["stratum"]).withColumn("fold", (F.col("pos") % k).cast("int"))
    return label_groups(df, folds, group, "fold")


def row_kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Fold from the row id's digest: no shuffle, stable under any partitioning."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))), 1, 8), 16, 10)
    return df.withColumn("fold", (h.cast("long") % k).cast("int"))


def stratified_row_kfold(df: DataFrame, key: str, target: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Round-robin in digest order within each class."""
    ranked = row_positions(df.withColumn("_h", _digest(key, seed)), "_h", key, keys=[target])
    return ranked.withColumn("fold", (F.col("pos") % k).cast("int")).drop("_h", "pos")


def split_overlap(df: DataFrame, group: str) -> DataFrame:
    """Groups found in more than one set (must be empty)."""
    return (
        df.select(group, "split").distinct().groupBy(group).agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    )


def split_report(df: DataFrame, group: str, target: str, time: str) -> DataFrame:
    """Rows, groups, target rate and date range per set.

    Groups are reduced to one row each before the second aggregate.
    """
    per_group = df.groupBy("split", group).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(target).alias("_y"), F.min(time).alias("_a"), F.max(time).alias("_b")
    )
    return per_group.groupBy("split").agg(
        F.sum("_n").alias("rows"), F.count(group).alias("groups"), (F.sum("_y") / F.sum("_n")).alias("target_rate"),
        F.min("_a").alias("first_time"), F.max("_b").alias("last_time"),
    )
