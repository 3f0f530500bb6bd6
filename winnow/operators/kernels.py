"""Shared distributed building blocks.

No function here brings an unbounded group into one task or onto the driver.
What reaches the driver is a sketch, a list of bucket edges, or a table whose row
count is bounded by a constant in this file.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.session import pin, stored

TASK_ROWS = 1_000_000  # rows one task may order or buffer
MAX_PIECES = 65_536  # most buckets an order is cut into
MAX_HOT_KEYS = 10_000  # most keys written into a plan as a literal list
GATHER_ROWS = 50_000  # most distinct values per column read back to finish a selection
WIDE_LIMIT = 200  # aggregate expressions per job
FEW_PAIRS = 60  # correlations computed side by side


def chunks(items: Sequence, size: int = WIDE_LIMIT):
    for start in range(0, len(items), size):
        yield items[start : start + size]


def rows_per_task(df: DataFrame, task_rows: int | None = None) -> int:
    """``task_rows``, else the session's ``spark.winnow.taskRows``, else ``TASK_ROWS``. Results do not depend on it."""
    return task_rows or int(df.sparkSession.conf.get("spark.winnow.taskRows", str(TASK_ROWS)))


def pieces_for(n: int, task_rows: int) -> int:
    return max(1, min(MAX_PIECES, math.ceil(n / task_rows)))


# ---------------------------------------------------------------- reshaping


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence = (), dtype: str = "double",
            name: str = "feature", value: str = "value") -> DataFrame:
    """Long form ``(keep…, feature, value)``: one scan serves every column."""
    cells = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast(dtype).alias(value)) for c in columns])
    return df.select(*keep, F.inline(cells))


def stats_to_rows(wide: DataFrame, features: Sequence[str], stats: Mapping[str, Callable[[str], Column]],
                  name: str = "feature") -> DataFrame:
    """Turn a one-row aggregate into one row per feature."""
    rows = F.array(*[
        F.struct(F.lit(f).alias(name), *[make(f).alias(s) for s, make in stats.items()]) for f in features
    ])
    return wide.select(F.inline(rows))


# ---------------------------------------------------------------- bucketing


def _strict(edges: Sequence[float]) -> list[float]:
    return sorted({float(e) for e in edges if e is not None and not math.isnan(e) and not math.isinf(e)})


def point_gap_bucket(df: DataFrame, column: str, edges: Sequence[float], out: str) -> DataFrame:
    """Ordered bucket numbers: ``2i`` for values between edges, ``2i+1`` for the edge itself.

    A value frequent enough to be an edge has an odd bucket of its own, so the even
    buckets stay small whatever the ties; odd buckets hold one value and need no order. NULL (-3),
    -Infinity (-1), Infinity and NaN (the last two odd numbers) are points too.
    """
    cuts = _strict(edges)
    if not cuts:
        return df.withColumn(out, _special(column, 0, F.lit(0)))
    raw, low = out + "_raw", F.expr("array(double('-infinity'), " + ", ".join(f"{e!r}D" for e in cuts) + ")")
    top = 2 * len(cuts)
    bucketed = Bucketizer(
        splits=[float("-inf"), *cuts, float("inf")], inputCol=column, outputCol=raw, handleInvalid="keep"
    ).transform(df)
    at = F.col(raw).cast("int")
    on_edge = (F.col(column) == F.get(low, at)) & (at > 0)
    return bucketed.withColumn(out, _special(column, top, F.when(on_edge, 2 * at - 1).otherwise(2 * at))).drop(raw)


def _special(column: str, top: int, bucket: Column) -> Column:
    c = F.col(column)
    return (
        F.when(c.isNull(), -3).when(F.isnan(c), top + 3).when(c == float("-inf"), -1).when(c == float("inf"), top + 1)
        .otherwise(bucket)
    )


def order_number(df: DataFrame, column: str) -> Column:
    """A double that never falls along the column's own order, whatever its type.

    Numbers and times are cast (rounding keeps the order). Text is read as bytes after the prefix that the least and
    greatest value share. It only places rows in buckets; inside a bucket the column itself orders.
    """
    kind = df.schema[column].dataType
    c = F.col(f"`{column}`")
    if isinstance(kind, T.StringType):
        low, high = df.agg(F.min(c), F.max(c)).first()
        a, b = (low or "").encode(), (high or "").encode()
        shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        part = F.rpad(F.hex(F.substring(c.cast("binary"), shared + 1, 6)), 12, "0")
        return F.conv(part, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def order_edges(df: DataFrame, pieces: int, *columns: str) -> list[list[float]]:
    """Approximate edges cutting each column into ``pieces`` parts, in one aggregate."""
    probs = ", ".join(f"{i / pieces!r}D" for i in range(1, pieces))
    row = df.agg(*[
        F.expr(f"percentile_approx(CAST(`{c}` AS DOUBLE), array({probs}), {max(10_000, 4 * pieces)})").alias(f"e{i}")
        for i, c in enumerate(columns)
    ]).first()
    return [_strict(line or []) for line in row]


# ---------------------------------------------------------------- prefix sums in a global order


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    values: Mapping[str, Column],
    tie: str | None = None,
    task_rows: int | None = None,
    durable: bool = False,
    maxima: Mapping[str, Column] | None = None,
    totals: bool = False,
) -> DataFrame:
    """Exclusive running sums of ``values`` in the order ``(by, tie)`` within each key.

    ``maxima`` are exclusive running maxima, NULL on a key's first row. ``totals`` adds the
    key's whole sum of each value as ``<name>_total``.

    The order is cut into value buckets; totals of earlier buckets are added to a
    window inside the own bucket. ``tie`` (unique, of any type) further cuts values of
    ``by`` that hold very many rows, NULL among them. Up to one task's rows a single window does it;
    the result is the same.
    """
    task_rows = rows_per_task(df, task_rows)
    maxima = maxima or {}
    cols = [c for c in (by, tie) if c]
    if durable:
        df = pin(df)
    n = df.count()
    if n <= task_rows:
        scope = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*cols)
        scope = scope.rowsBetween(Window.unboundedPreceding, -1)
        return df.select(
            "*", *[F.coalesce(F.sum(v).over(scope), F.lit(0)).alias(k) for k, v in values.items()],
            *[F.max(v).over(scope).alias(k) for k, v in maxima.items()],
            *[F.sum(v).over(Window.partitionBy(*(keys or [F.lit(0)]))).alias(k + "_total") for k, v in values.items() if totals],
        )
    work = df.withColumn("_ps_by", order_number(df, by))
    if tie:
        work = work.withColumn("_ps_tie", order_number(df, tie))
    edges = order_edges(work, pieces_for(n, task_rows), *["_ps_by", "_ps_tie"][: len(cols)])
    work = point_gap_bucket(work, "_ps_by", edges[0], "_ps_b")
    if tie:
        work = point_gap_bucket(work, "_ps_tie", edges[1], "_ps_t")
        work = work.withColumn("_ps_t", F.when(F.pmod("_ps_b", F.lit(2)) == 1, F.col("_ps_t")).otherwise(0))
    else:
        work = work.withColumn("_ps_t", F.lit(0))
    slot = [*keys, "_ps_b", "_ps_t"]
    per_slot = work.groupBy(*slot).agg(
        *[F.sum(v).alias(k) for k, v in values.items()], *[F.max(v).alias(k) for k, v in maxima.items()]
    )
    ahead = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_ps_b", "_ps_t").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    offsets = per_slot.select(
        *[F.col(c).alias("_ps_o" + c) for c in slot],
        *[F.coalesce(F.sum(k).over(ahead), F.lit(0)).alias("_ps_o_" + k) for k in values],
        *[F.max(k).over(ahead).alias("_ps_o_" + k) for k in maxima],
        *[F.sum(k).over(whole).alias(k + "_total") for k in values if totals],
    )
    inside = Window.partitionBy(*slot).orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    local = work.select(
        "*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias("_ps_l_" + k) for k, v in values.items()],
        *[F.max(v).over(inside).alias("_ps_l_" + k) for k, v in maxima.items()],
    )
    on = [local[c].eqNullSafe(offsets["_ps_o" + c]) for c in slot]
    return local.join(offsets, on).select(
        *df.columns, *[(F.col("_ps_l_" + k) + F.col("_ps_o_" + k)).alias(k) for k in values],
        *[F.greatest(F.col("_ps_l_" + k), F.col("_ps_o_" + k)).alias(k) for k in maxima],
        *[F.col(k + "_total") for k in values if totals],
    )


def row_positions(df: DataFrame, by: str, tie: str, keys: Sequence[str] = (), out: str = "pos",
                  task_rows: int | None = None) -> DataFrame:
    """0-based dense position in the order ``(by, tie)``."""
    return prefix_sums(df, keys, by, {out: F.lit(1).cast("long")}, tie, task_rows)


def uniform_key(text: Column) -> Column:
    """A number in [0, 2**52) drawn from the md5 of a text; orders like the digest."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")


# ---------------------------------------------------------------- exact selection


def _cell_counts(data: DataFrame, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """``(c, b, n)``: values per column and point-and-gap bucket, odd ones the edges themselves; NULL is not counted.

    The tasks add up their rows, so a bucket and column is one row a task.
    """
    edges = {c: np.array(e, float) for c, e in cuts.items()}

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(2 * len(e) + 1, np.int64) for e in edges.values()]
        for batch in batches:
            for i, e in enumerate(edges.values()):
                v = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                at = np.searchsorted(e, v)
                on = e[np.minimum(at, len(e) - 1)] == v if len(e) else np.zeros(len(v), bool)
                total[i] += np.bincount(2 * at + on, minlength=len(total[i]))
        for c, t in zip(edges, total):
            hit = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array([c] * len(hit), pa.string()), pa.array(hit, pa.int32()), pa.array(t[hit])], names=["c", "b", "n"])

    return data.select(*edges).mapInArrow(tally, "c string, b int, n long").groupBy("c", "b").agg(F.sum("n").alias("n"))


def order_statistics(
    df: DataFrame, wanted: Mapping[str, Callable[[int], Sequence[int]]], gather: int = GATHER_ROWS
) -> dict[str, tuple[int, dict[int, float]]]:
    """Exact values at given 0-based ranks, ``{column: (n, {rank: value})}``; NULL and NaN are skipped.

    Sketched edges cut each column into points and gaps, which are counted exactly. A
    rank on a point is found; otherwise its gap is sketched again until it is small
    enough to read back. All columns advance together: three jobs for up to about
    ``gather * 500`` rows, two more for every further factor of that kind.
    """
    columns = list(wanted)
    cast = df.select(*[F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in columns])
    data = cast.select(*[F.when(F.abs(c) < float("inf"), F.col(c)).alias(c) for c in columns])
    counts: dict[str, int] = {}
    ends: dict[str, tuple[int, int]] = {}
    for part in chunks(columns, WIDE_LIMIT // 3):
        row = cast.agg(*[e for i, c in enumerate(part) for e in (
            F.count(c).alias(f"n{i}"), F.count_if(F.col(c) == float("-inf")).alias(f"l{i}"),
            F.count_if(F.col(c) == float("inf")).alias(f"h{i}"))]).first()
        for i, c in enumerate(part):
            counts[c], ends[c] = row[f"n{i}"], (row[f"l{i}"], row[f"h{i}"])
    found: dict[str, dict[int, float]] = {c: {} for c in columns}
    # open interval, rows below it, rows inside it
    where: dict[tuple[str, int], tuple[float, float, int, int]] = {}
    for c in columns:
        for r in wanted[c](counts[c]):
            low, high = ends[c]
            if r < low or r >= counts[c] - high:
                found[c][r] = -math.inf if r < low else math.inf
            else:
                where[c, r] = (-math.inf, math.inf, low, counts[c] - low - high)
    probs = ", ".join(f"{i / 1000!r}D" for i in range(1, 1000))

    def inside(c: str, lo: float, hi: float) -> Column:
        v = F.col(c)
        return F.when((v > F.lit(lo)) & (v < F.lit(hi)), v)

    while any(size > gather for *_, size in where.values()):
        spans = {(c, lo, hi) for (c, _), (lo, hi, _, size) in where.items() if size > gather}
        edges: dict[str, set[float]] = {}
        for part in chunks(sorted(spans), 50):
            row = data.select(*[inside(c, lo, hi).alias(f"s{i}") for i, (c, lo, hi) in enumerate(part)]).agg(*[
                F.expr(f"percentile_approx(s{i}, array({probs}), 10000)").alias(f"s{i}") for i in range(len(part))
            ]).first()
            for i, (c, lo, hi) in enumerate(part):
                edges.setdefault(c, set()).update(row[i] or [])
                edges[c].update(e for e in (lo, hi) if not math.isinf(e))
        cuts = {c: _strict(e) for c, e in edges.items()}
        table = _cell_counts(data, cuts).collect()
        for c, e in cuts.items():
            size = np.zeros(2 * len(e) + 1, dtype=np.int64)
            for row in table:
                if row["c"] == c:
                    size[row["b"]] += row["n"]
            upto = np.cumsum(size) + ends[c][0]
            bounds = [-math.inf, *e, math.inf]
            for (cc, r) in [k for k in where if k[0] == c and where[k][3] > gather]:
                b = int(np.searchsorted(upto, r, side="right"))
                if b % 2 == 1:
                    found[c][r] = e[b // 2]
                    del where[cc, r]
                else:
                    where[cc, r] = (bounds[b // 2], bounds[b // 2 + 1], int(upto[b] - size[b]), int(size[b]))
    if where:
        spans = sorted({(c, lo, hi) for (c, _), (lo, hi, *_) in where.items()})
        for part in chunks(spans, 50):
            cells = F.array(*[
                F.struct(F.lit(i).alias("i"), inside(c, lo, hi).alias("v")) for i, (c, lo, hi) in enumerate(part)
            ])
            table = data.select(F.inline(cells)).filter("v IS NOT NULL").groupBy("i", "v").count().toPandas()
            for i, (c, lo, hi) in enumerate(part):
                mine = table[table["i"] == i].sort_values("v")
                upto = mine["count"].to_numpy().cumsum()
                for (cc, r), (a, b, below, _) in where.items():
                    if (cc, a, b) == (c, lo, hi):
                        found[c][r] = float(mine["v"].iloc[int(np.searchsorted(upto, r - below, side="right"))])
    return {c: (counts[c], found[c]) for c in columns}


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], task_rows: int | None = None, durable: bool = True
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles, exact at any size.

    The selection reads its columns several times, so with ``durable`` they are stored first and what stands
    behind ``df`` runs once. Up to ``task_rows`` rows the built-in ``percentile`` buffer is bounded and one
    aggregate does it; beyond that ``order_statistics`` selects the neighbours.
    """
    if not columns:
        return {}
    task_rows = rows_per_task(df, task_rows)
    if durable and not df.is_cached:
        df = stored(df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys(columns)]), "quantiles")
    if df.count() <= task_rows:
        out: dict[str, list[float | None]] = {}
        for part in chunks(list(columns), 50):
            row = df.agg(*[
                F.percentile(F.nullif(F.col(c).cast("double"), F.lit(float("nan"))), F.array(*[F.lit(float(p)) for p in probs])).alias(c)
                for c in part
            ]).first()
            out.update({c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in part})
        return out

    def ranks(n: int) -> list[int]:
        if n == 0:
            return []
        spots = [p * (n - 1) for p in probs]
        return sorted({int(math.floor(s)) for s in spots} | {int(math.ceil(s)) for s in spots})

    picked = order_statistics(df, {c: ranks for c in columns})
    result: dict[str, list[float | None]] = {}
    for c, (n, values) in picked.items():
        line = []
        for p in probs:
            if n == 0:
                line.append(None)
                continue
            spot = p * (n - 1)
            lo, hi = values[int(math.floor(spot))], values[int(math.ceil(spot))]
            line.append(lo if lo == hi else lo + (hi - lo) * (spot - math.floor(spot)))
        result[c] = line
    return result


# ---------------------------------------------------------------- tables behind the statistics


def contingency(df: DataFrame, categories: Sequence[str], target: str) -> DataFrame:
    """``(feature, category, y, n)`` for all categorical columns in one shuffle."""
    long = unpivot(df, categories, [F.col(target).cast("int").alias("y")], "string", value="category")
    return (
        long.filter("category IS NOT NULL AND y IS NOT NULL").groupBy("feature", "category", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def moments_by_group(df: DataFrame, numeric: Sequence[str], group: str) -> DataFrame:
    """``(feature, grp, n, mean, var)`` for all numeric columns.

    The columns sit side by side in one aggregate, so a row is hashed once and not once per
    column; the table is only turned to long form when it has one row per group.
    """
    parts = []
    for part in chunks(list(numeric), WIDE_LIMIT // 3):
        wide = df.filter(F.col(group).isNotNull()).groupBy(F.col(group).cast("string").alias("grp")).agg(*[
            e for i, c in enumerate(part) for e in (
                F.count(c).alias(f"n{i}"), F.avg(F.col(c).cast("double")).alias(f"m{i}"),
                F.var_samp(F.col(c).cast("double")).alias(f"v{i}"),
            )
        ])
        cells = F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("mean"), F.col(f"v{i}").alias("var"))
            for i, c in enumerate(part)
        ])
        parts.append(wide.select("grp", F.inline(cells)).filter("n > 0"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson over rows where both are present; NULL when one side is constant.

    The built-in ``corr`` divides by zero there, which is an error in ANSI mode.
    """
    a, b = a.cast("double"), b.cast("double")
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0))


def pairwise_corr(df: DataFrame, pairs: Sequence[tuple[str, str]], few: int = FEW_PAIRS) -> DataFrame:
    """``(feature_a, feature_b, r)`` over rows where both are present, in one scan.

    A few pairs are JVM aggregates; many are read off one matrix of sums.
    """
    pairs = list(pairs)
    if len(pairs) > few:
        return _corr_by_sums(df, pairs)
    wide = df.agg(*[safe_corr(F.col(a), F.col(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ])
    return wide.select(F.inline(rows))


def _corr_by_sums(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """All pairs in one pass: per batch four matrix products of the centred values and the
    presence flags, added up by Spark. Centring first keeps the sums free of cancellation."""
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    d = len(columns)
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    means = np.concatenate([
        np.array([v or 0.0 for v in data.agg(*[F.avg(c) for c in part]).first()]) for part in chunks(columns)
    ])

    def batches(frames):
        total = None
        for pdf in frames:
            x = pdf.to_numpy(dtype=float) - means
            here = ~np.isnan(x)
            x, m = np.where(here, x, 0.0), here.astype(float)
            sums = np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
            total = sums if total is None else total + sums
        if total is not None:
            yield pd.DataFrame({"i": np.arange(d), **{k: list(total[j]) for j, k in enumerate("nstp")}})

    arrays = ", ".join(f"{k} array<double>" for k in "nstp")
    rows = data.mapInPandas(batches, f"i int, {arrays}").select("i", F.posexplode(F.arrays_zip(*"nstp")).alias("j", "v"))
    sums = rows.groupBy("i", "j").agg(*[F.sum(F.col("v")[k]).alias(k) for k in "nstp"])
    order = {c: k for k, c in enumerate(columns)}
    wanted = df.sparkSession.createDataFrame(
        [(order[a], order[b], a, b) for a, b in pairs], "i int, j int, feature_a string, feature_b string"
    )
    back = sums.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("s").alias("s2"), F.col("t").alias("t2"))
    n, sa, sb = F.col("n"), F.col("s"), F.col("s2")
    spread = (F.col("t") - sa * sa / F.nullif(n, F.lit(0.0))) * (F.col("t2") - sb * sb / F.nullif(n, F.lit(0.0)))
    r = (F.col("p") - sa * sb / F.nullif(n, F.lit(0.0))) / F.nullif(F.sqrt(F.greatest(spread, F.lit(0.0))), F.lit(0.0))
    return wanted.join(sums, ["i", "j"]).join(back, ["i", "j"]).select("feature_a", "feature_b", r.alias("r"))


FEISTEL_PRIME = 2**31 - 1
FEISTEL_ROUNDS = 6


def feistel_keys(seed: int) -> list[tuple[int, int, int]]:
    """Multipliers and offset of each round."""
    rng = np.random.default_rng(seed)
    return [tuple(int(v) for v in rng.integers(1, FEISTEL_PRIME, 3)) for _ in range(FEISTEL_ROUNDS)]


def feistel_side(n: int) -> int:
    """Both halves of an index run below this; their square is the least one not below ``n``."""
    return max(1, math.isqrt(max(n, 1) - 1) + 1)


def feistel_donor(index: Column, n: int, seed: int) -> Column:
    """A keyed bijection of 0..n-1 without visible order, as a column expression.

    Both digits of the index in base ``side`` are changed in turn by a keyed polynomial of the other one; a result
    outside 0..n-1 is sent through again, which keeps it a bijection. So often that one row in 2**60 would stay outside, an error then.
    """
    side, keys = feistel_side(n), feistel_keys(seed)
    stray = (side * side - n) / (side * side)
    walks = 1 if stray == 0 else max(2, math.ceil(60 / -math.log2(stray)))
    constant = F.array(*[F.array(*[F.lit(v).cast("long") for v in k]) for k in keys])

    def turn(state: Column, i: Column) -> Column:
        a, b, done = state["a"], state["b"], state["done"]
        key = F.element_at(constant, (i % FEISTEL_ROUNDS + 1).cast("int"))
        p = F.lit(FEISTEL_PRIME).cast("long")
        mixed = ((b * b) % p * F.get(key, F.lit(0)) % p + b * F.get(key, F.lit(1)) % p + F.get(key, F.lit(2))) % F.lit(side).cast("long")
        over = (i % FEISTEL_ROUNDS == FEISTEL_ROUNDS - 1) & (b * side + (a + mixed) % side < n)
        return F.when(done, state).otherwise(F.struct(b.alias("a"), ((a + mixed) % side).cast("long").alias("b"), over.alias("done")))

    x = index.cast("long")
    start = F.struct(F.floor(x / side).cast("long").alias("a"), (x % side).cast("long").alias("b"), F.lit(False).alias("done"))
    end = F.aggregate(F.sequence(F.lit(0), F.lit(walks * FEISTEL_ROUNDS - 1)), start, turn)
    return F.when(end["done"], end["a"] * side + end["b"]).otherwise(F.raise_error(F.lit("index left its range")).cast("long"))
