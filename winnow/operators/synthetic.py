"""Synthetic minority rows from exact nearest neighbours.

The neighbour search is a pivot join. Points go to the cell of their closest pivot; the
k-th distance inside the own cell bounds the search; by the triangle inequality only cells
within that bound can hold closer points, and the query visits exactly those. Cells are cut
into slices of bounded size, distances are computed in numpy inside the task, and only the
best k per visit leave it. Equal rows are one point with a multiplicity.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.operators.kernels import prefix_sums, uniform_key
from winnow.session import pin

SLICE_ROWS = 4000  # points compared with each other in one call
MAX_PIVOTS = 512
BLOCK = 512  # query rows per distance matrix
CHUNK = 10_000  # synthetic rows written per task row


def _distances(x: np.ndarray, c: np.ndarray, y: np.ndarray, d: np.ndarray, penalty: float) -> np.ndarray:
    """Euclid over the numbers, ``penalty`` squared per differing category."""
    gap = ((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2)
    for j in range(c.shape[1]):
        gap += penalty**2 * (c[:, j][:, None] != d[:, j][None, :])
    return np.sqrt(gap)


def _arrays(pdf: pd.DataFrame, cats: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.stack(pdf["x"].to_numpy()).astype(float) if len(pdf) else np.zeros((0, 1))
    c = np.array([list(v) for v in pdf["c"]], dtype=object).reshape(len(pdf), cats)
    return x, c


def _best(queries: pd.DataFrame, points: pd.DataFrame, k: int, cats: int, penalty: float):
    """Yield (query position, point positions, distances) of the k closest other points."""
    x, c = _arrays(queries, cats)
    y, d = _arrays(points, cats)
    names = points["p"].to_numpy()
    for start in range(0, len(queries), BLOCK):
        block = slice(start, start + BLOCK)
        gaps = _distances(x[block], c[block], y, d, penalty)
        gaps[queries["p"].to_numpy()[block][:, None] == names[None, :]] = np.inf
        take = min(k, gaps.shape[1])
        near = np.argpartition(gaps, take - 1, axis=1)[:, :take]
        for i, row in enumerate(near):
            row = row[np.isfinite(gaps[i, row])]
            yield start + i, row, gaps[i, row]


def nearest(points: DataFrame, k: int, penalty: float, cats: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``(q, dist, m, x, c)``: the k nearest other points of every point ``(p, x, c, m)``."""
    spark = points.sparkSession
    n = points.count()
    count = max(1, min(MAX_PIVOTS, math.ceil(n / slice_rows)))
    # pivots in digest order: a bounded list, the same on every run
    pivots = points.orderBy("p").limit(count).select("p", "x", "c").toPandas()
    shared = spark.sparkContext.broadcast(pivots)

    def assign(frames):
        px, pc = _arrays(shared.value, cats)
        for pdf in frames:
            if len(pdf):
                gaps = _distances(*_arrays(pdf, cats), px, pc, penalty)
                yield pdf.assign(cell=gaps.argmin(axis=1).astype("int32"), radius=gaps.min(axis=1))

    celled = pin(points.select("p", "x", "c", "m").mapInPandas(assign, "p string, x array<double>, c array<string>, m long, cell int, radius double"))
    stats = celled.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("radius").alias("far"), F.min("radius").alias("close")
    ).toPandas()  # one row per pivot
    slices = {int(r.cell): max(1, math.ceil(r.n / slice_rows)) for r in stats.itertuples()}
    slice_count = F.element_at(F.create_map(*[F.lit(v) for kv in slices.items() for v in kv]), F.col("cell"))
    celled = celled.withColumn("slice", F.pmod(F.xxhash64("p"), slice_count).cast("int"))

    def bound(pdf: pd.DataFrame) -> pd.DataFrame:
        limit = np.full(len(pdf), np.inf)
        for i, row, gaps in _best(pdf, pdf, k, cats, penalty):
            if len(row) == k:
                limit[i] = gaps.max()
        return pdf[["p", "x", "c"]].assign(limit=limit)

    bounded = celled.groupBy("cell", "slice").applyInPandas(bound, "p string, x array<double>, c array<string>, limit double")
    far, close = stats.set_index("cell")["far"].to_dict(), stats.set_index("cell")["close"].to_dict()

    def visits(frames):
        px, pc = _arrays(shared.value, cats)
        for pdf in frames:
            if not len(pdf):
                continue
            gaps = _distances(*_arrays(pdf, cats), px, pc, penalty)
            # a hair of slack: rounding must not cut a cell at its very edge
            limit = pdf["limit"].to_numpy() * (1 + 1e-9) + 1e-12
            for cell, parts in slices.items():
                hit = (gaps[:, cell] - far[cell] <= limit) & (close[cell] - gaps[:, cell] <= limit)
                if hit.any():
                    for s in range(parts):
                        yield pdf.loc[hit, ["p", "x", "c"]].assign(cell=np.int32(cell), slice=np.int32(s))

    asked = bounded.mapInPandas(visits, "p string, x array<double>, c array<string>, cell int, slice int")
    # a busy slice is visited by many queries: they are dealt out, the slice's points copied along
    load = asked.groupBy("cell", "slice").agg(F.ceil(F.count(F.lit(1)) / (16.0 * slice_rows)).cast("int").alias("shares"))
    asked = asked.join(load, ["cell", "slice"]).withColumn("share", F.pmod(F.xxhash64("p"), "shares").cast("int")).drop("shares")
    served = celled.join(load, ["cell", "slice"]).withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")

    def answer(queries: pd.DataFrame, inside: pd.DataFrame) -> pd.DataFrame:
        out = []
        for i, row, gaps in _best(queries, inside, k, cats, penalty) if len(queries) and len(inside) else ():
            part = inside.iloc[row][["p", "m", "x", "c"]].rename(columns={"p": "other"})
            out.append(part.assign(q=queries["p"].iloc[i], dist=gaps))
        columns = ["q", "other", "dist", "m", "x", "c"]
        return pd.concat(out)[columns] if out else pd.DataFrame(columns=columns)

    slot = ["cell", "slice", "share"]
    found = asked.groupBy(*slot).cogroup(served.groupBy(*slot)).applyInPandas(
        answer, "q string, other string, dist double, m long, x array<double>, c array<string>"
    )
    ranked = Window.partitionBy("q").orderBy("dist", "other")
    return found.withColumn("r", F.row_number().over(ranked)).filter(F.col("r") <= k).drop("r", "other")


def median_deviation(df: DataFrame, numeric: Sequence[str]) -> float:
    """Median of the columns' standard deviations: what one differing category weighs."""
    row = df.agg(*[F.stddev_samp(F.col(c).cast("double")) for c in numeric]).first()
    return float(np.median([v or 0.0 for v in row])) if len(row) else 1.0


def smote(df: DataFrame, label: str, row_id: str, numeric: Sequence[str], categorical: Sequence[str] = (), k: int = 5,
          seed: int = 42, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """All rows plus synthetic minority rows until the two classes are equal.

    Numbers lie between a minority row and one of its k nearest minority neighbours;
    categories are the neighbours' most frequent. Inputs must be filled. Synthetic rows have
    ``synthetic = 1``; columns beyond the named ones are NULL in them.
    """
    sizes = {r[0]: r["count"] for r in df.filter(F.col(label).isNotNull()).groupBy(label).count().limit(3).collect()}
    if len(sizes) != 2:
        raise ValueError("two classes are needed")
    minority = min(sizes, key=lambda v: (sizes[v], v))
    n, need = sizes[minority], max(sizes.values()) - sizes[minority]
    base = df.withColumn("synthetic", F.lit(0))
    if need == 0 or n < 2:
        return base
    rows = df.filter(F.col(label) == minority)
    x = F.array(*[F.col(c).cast("double") for c in numeric])
    c = F.array(*[F.coalesce(F.col(v).cast("string"), F.lit("")) for v in categorical]).cast("array<string>")
    points = rows.select(x.alias("x"), c.alias("c")).groupBy("x", "c").agg(F.count(F.lit(1)).alias("m"))
    points = pin(points.withColumn("p", F.sha2(F.concat_ws("|", F.to_json("x"), F.to_json("c"), F.lit(str(seed))), 256)))
    near = nearest(points, k, median_deviation(rows, numeric), len(categorical), slice_rows)
    entry = F.struct("dist", "x", "c", "m")
    lists = near.groupBy("q").agg(F.sort_array(F.collect_list(entry)).alias("near"))  # k entries
    # copies of the row itself come first, at distance 0
    own = F.array_repeat(F.struct(F.lit(0.0).alias("dist"), "x", "c", F.lit(1).cast("long").alias("m")),
                         F.least(F.col("m") - 1, F.lit(k)).cast("int"))
    others = F.flatten(F.transform(F.coalesce("near", F.array().cast(lists.schema["near"].dataType)),
                                   lambda e: F.array_repeat(e, F.least(e["m"], F.lit(k)).cast("int"))))
    around = F.slice(F.concat(own, others), 1, k)
    placed = points.join(lists, points["p"] == lists["q"], "left").select("p", "x", "c", "m", around.alias("around"))
    placed = placed.withColumn("_h", uniform_key(F.col("p")))
    placed = prefix_sums(placed, [], "_h", {"_before": F.col("m")})
    extra = F.greatest(F.least(F.lit(need % n) - F.col("_before"), F.col("m")), F.lit(0))
    quota = placed.withColumn("quota", F.col("m") * (need // n) + extra).filter("quota > 0")
    # two steps, so that a point with very many copies is written by many tasks
    starts = quota.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1, F.lit(CHUNK).cast("long"))))
    starts = starts.repartition("p", "start")
    each = starts.withColumn("s", F.explode(F.sequence(F.col("start"), F.least(F.col("start") + CHUNK, F.col("quota")) - 1)))
    draw = lambda salt: F.pmod(F.xxhash64("p", "s", F.lit(seed), F.lit(salt)), F.lit(1 << 30).cast("long")) / float(1 << 30)
    pick = F.get("around", F.floor(draw("neighbour") * F.size("around")).cast("int"))
    each = each.withColumn("to", pick).withColumn("gap", draw("gap"))
    made = F.zip_with("x", F.coalesce("to.x", "x"), lambda a, b: a + F.col("gap") * (b - a))

    def majority(j: int):
        seen = F.transform("around", lambda e: F.get(e["c"], F.lit(j)))
        best = F.transform(F.array_distinct(seen), lambda v: F.struct(
            (-F.size(F.filter(seen, lambda w: w == v))).alias("n"), v.alias("v")))
        return F.coalesce(F.array_min(best)["v"], F.get("c", F.lit(j)))

    types = dict(df.dtypes)
    cells = {label: F.lit(minority).cast(types[label]), "synthetic": F.lit(1)}
    cells |= {name: F.get(made, F.lit(i)).alias(name) for i, name in enumerate(numeric)}
    cells |= {name: majority(j) for j, name in enumerate(categorical)}
    synthetic = each.select(*[
        cells[name].alias(name) if name in cells else F.lit(None).cast(types[name]).alias(name) for name in base.columns
    ])
    wide = base.withColumns({c: F.col(c).cast("double") for c in numeric})
    return wide.unionByName(synthetic)
