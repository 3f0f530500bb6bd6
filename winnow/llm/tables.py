"""Durable intermediate tables and an ordering of rows that no single task holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.session import scratch_path


def pinned(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again, so that a lost executor never repeats the work."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def light(df: DataFrame) -> DataFrame:
    """Rows go to Python a few thousand at a time, so that long texts do not fill a worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return df


def partitions(df: DataFrame) -> int:
    """As many parts as the session shuffles into."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def range_bucket(df: DataFrame, key: str, tie: Column, parts: int) -> Column:
    """Number of the key range a row belongs to, 0 to about ``parts``; ranges ascend with (key, tie).

    ``key`` is a whole number; nulls come first. ``tie`` is a hash of 63 bits (not negative): a key that fills several
    ranges is cut by it. The cut points are a sketch of the key column (a bounded list); the order of rows does not depend
    on them.
    """
    shares = [k / parts for k in range(1, parts)]
    cuts = df.agg(F.percentile_approx(key, F.array(*map(F.lit, shares)), 20 * parts).alias("c")).first()[0] if shares else None
    if not cuts:
        return F.lit(0)
    edges = sorted(set(cuts))
    # a key that is the cut point c times over holds about c ranges; its rows go to c slots by hash
    slots = [cuts.count(e) for e in edges]
    base, bases = 0, []
    for n in slots:
        bases.append(base)
        base += n
    edge = F.array(*map(F.lit, edges)).cast("array<long>")
    k = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    below = F.size(F.filter(edge, lambda e: e < k))
    start = F.when(below < len(edges), F.element_at(F.array(*map(F.lit, bases)), F.least(below, F.lit(len(edges) - 1)) + 1)).otherwise(base)
    width = F.when(
        (below < len(edges)) & (F.element_at(edge, F.least(below, F.lit(len(edges) - 1)) + 1) == k),
        F.element_at(F.array(*map(F.lit, slots)), F.least(below, F.lit(len(edges) - 1)) + 1),
    ).otherwise(1)
    share = tie.cast("double") / F.lit(float(2**63))
    # rows below an edge, and rows equal to it, share its slots in order: those below take the first
    return (start + F.least(F.floor(share * width).cast("int"), width - 1)).cast("int")
