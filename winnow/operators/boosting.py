"""Boosted trees of second order over quantile bins, grown leaf by leaf, level by level or symmetrically.

Rows keep their features as one byte a slot. One pass over the rows per level adds up gradients and curvatures by
(node, feature, bin) inside the tasks; a feature's sums then meet in one task, which finds its best cut in every node. Only these, one row
a node and feature, reach the driver. A cut's gain does not depend on other leaves, so the leaf-wise order (best gain first, up to a number
of leaves) is taken over the levels once they are known.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.session import scratch_path

MAX_BINS = 255
MAX_DEPTH = 12  # a level holds 2**depth nodes
HELD = 16  # trees between two writes of the margins
STATS = 3  # gradient, curvature, rows


@dataclass(frozen=True)
class Growth:
    """``policy``: ``leaf`` (best gain first up to ``leaves``), ``level``, or ``symmetric`` (one cut for a whole level).

    ``l2`` and ``l1`` shrink leaf values, a cut must gain more than ``min_gain`` and leave ``min_rows`` rows and ``min_weight``
    curvature on both sides. ``rows`` and ``features`` are the shares that a tree looks at.
    """

    policy: str = "leaf"
    trees: int = 100
    depth: int = 6
    leaves: int = 31
    step: float = 0.1
    l2: float = 1.0
    l1: float = 0.0
    min_gain: float = 0.0
    min_rows: int = 1
    min_weight: float = 1e-3
    rows: float = 1.0
    features: float = 1.0
    bins: int = 64
    base: float | None = None  # starting probability; None: the share of positives

    def __post_init__(self):
        if self.policy not in ("leaf", "level", "symmetric") or not 1 <= self.depth <= MAX_DEPTH or not 2 <= self.bins <= MAX_BINS:
            raise ValueError(f"policy {self.policy}, depth {self.depth} or bins {self.bins} out of range")


@dataclass
class Tree:
    """Node ``i`` has children ``2i + 1`` and ``2i + 2``; rows with ``x <= cut`` go left, missing values too."""

    cuts: dict[int, tuple[int, int, float]] = field(default_factory=dict)  # node: feature, bin, gain
    values: dict[int, float] = field(default_factory=dict)  # leaves
    covers: dict[int, float] = field(default_factory=dict)  # rows of every node

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of every row; inner nodes are at most ``depth`` levels deep."""
        at = np.zeros(len(bins), np.int64)
        if not self.cuts:
            return at
        size = max(self.cuts) + 1
        feature, cut = np.full(size, -1), np.zeros(size, np.int64)
        for node, (f, b, _) in self.cuts.items():
            feature[node], cut[node] = f, b
        moving = np.arange(len(bins))
        while len(moving):
            node = at[moving]
            moving = moving[(node < size) & (feature[np.minimum(node, size - 1)] >= 0)]
            node = at[moving]
            at[moving] = 2 * node + 1 + (bins[moving, feature[node]] > cut[node])
        return at

    def margins(self, bins: np.ndarray) -> np.ndarray:
        at = self.nodes_of(bins)
        table = np.zeros(int(at.max(initial=0)) + 1)
        for node, v in self.values.items():
            if node < len(table):
                table[node] = v
        return table[at]


def bin_edges(df: DataFrame, features: str, dims: int, bins: int) -> list[list[float]]:
    """Up to ``bins - 1`` distinct inner quantiles of each slot; a value goes to the first bin whose edge is not below it."""
    probs = [k / bins for k in range(1, bins)]
    cells = vector_to_array(F.col(features))
    out: list[list[float]] = []
    for start in range(0, dims, 100):
        part = range(start, min(start + 100, dims))
        row = df.select(*[F.nullif(cells[k], F.lit(float("nan"))).alias(f"c{k}") for k in part]).agg(*[
            F.percentile_approx(f"c{k}", F.array(*map(F.lit, probs)), 50 * bins).alias(f"e{k}") for k in part]).first()
        out += [sorted(set(row[f"e{k}"] or [])) for k in part]
    return out


def binned(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Bin numbers, a byte a slot; a missing value counts as below every edge."""
    cols = [np.where(np.isnan(x[:, k]), 0, np.searchsorted(np.asarray(e, float), x[:, k], side="left")) for k, e in enumerate(edges)]
    return np.stack(cols, 1).astype(np.uint8) if cols else np.zeros((len(x), 0), np.uint8)


def bytes_of(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    column = batch["bins"]
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return flat.reshape(-1, dims)


def gradients(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1.0 / (1.0 + np.exp(-margin))
    return (p - y) * w, p * (1 - p) * w


def _shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def _strength(g, h, rule: Growth):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(h + rule.l2 > 0, _shrunk(g, rule.l1) ** 2 / (h + rule.l2), 0.0)


def best_cuts(sums: np.ndarray, rule: Growth) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain of every (node, bin) cut, left sums and totals, from sums of shape (nodes, bins, 3)."""
    left = sums.cumsum(1)
    total = left[:, -1]
    right = total[:, None] - left
    gain = 0.5 * (_strength(left[..., 0], left[..., 1], rule) + _strength(right[..., 0], right[..., 1], rule)
                  - _strength(total[:, 0], total[:, 1], rule)[:, None])
    fits = (left[..., 2] >= rule.min_rows) & (right[..., 2] >= rule.min_rows) & (left[..., 1] >= rule.min_weight) & (right[..., 1] >= rule.min_weight)
    return np.where(fits, gain, -np.inf), left, total


def level_sums(rows: DataFrame, dims: int, width: int, nodes: list[int], tree: Tree, before: list[Tree], rule: Growth, draw: int,
               columns: list[int]) -> DataFrame:
    """``feature, sums``: per task and feature the sums over its rows, ``(nodes, width, 3)`` doubles as bytes."""
    slot = {n: i for i, n in enumerate(nodes)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(columns), len(nodes) * width, STATS))
        lookup = np.full(max(nodes) + 1, -1)
        lookup[nodes] = [slot[n] for n in nodes]
        seen = False
        for batch in batches:
            if not len(batch):
                continue
            bins = bytes_of(batch, dims)
            margin = np.asarray(batch["margin"]) + sum(t.margins(bins) for t in before)
            g, h = gradients(margin, np.asarray(batch["label"]), np.asarray(batch["weight"]))
            at = tree.nodes_of(bins)
            place = np.where(at < len(lookup), lookup[np.minimum(at, len(lookup) - 1)], -1)
            keep = place >= 0
            if rule.rows < 1.0:
                keep &= _drawn(np.asarray(batch["row"]), draw) < rule.rows
            bins, place, g, h = bins[keep], place[keep], g[keep], h[keep]
            seen |= bool(len(bins))
            for k, f in enumerate(columns):
                key = place * width + bins[:, f]
                for j, v in enumerate((g, h, None)):
                    sums[k, :, j] += np.bincount(key, v, minlength=sums.shape[1])
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(columns, pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())], names=["feature", "sums"])

    return rows.mapInArrow(run, "feature int, sums binary")


def _drawn(row: np.ndarray, draw: int) -> np.ndarray:
    """A number in [0, 1) for a row and tree that no partitioning changes."""
    x = row.astype(np.uint64) + np.uint64((draw * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).astype(float) / 2.0**64


def level_cuts(sums: DataFrame, nodes: int, width: int, rule: Growth) -> list[tuple]:
    """(node slot, feature, bin, gain, left sums, totals) of each feature's best cut in each node; symmetric growth takes one bin for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for f, blob in zip(batch["feature"].to_pylist(), batch["sums"].to_pylist()):
                part = np.frombuffer(blob).reshape(nodes, width, STATS)
                held[f] = held[f] + part if f in held else part.copy()
        out = []
        for f, total in held.items():
            gain, left, whole = best_cuts(total, rule)
            if rule.policy == "symmetric":
                at = np.full(nodes, int(np.argmax(np.where(np.isfinite(gain), gain, 0.0).sum(0))))
            else:
                at = gain.argmax(1)
            for i in range(nodes):
                if whole[i, 2] > 0:
                    out.append((i, f, int(at[i]), float(gain[i, at[i]]), left[i, at[i]].tolist(), whole[i].tolist()))
        cols = list(zip(*out)) if out else [[]] * 6
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["node", "feature", "bin", "gain", "left", "total"])

    dealt = sums.repartition("feature").mapInArrow(run, "node int, feature int, bin int, gain double, left array<double>, total array<double>")
    return [tuple(r) for r in dealt.collect()]


def grow(rows: DataFrame, dims: int, width: int, before: list[Tree], rule: Growth, number: int, seed: int = 42) -> Tree:
    """One tree; a pass over the rows per level."""
    rng = np.random.default_rng(seed * 1_000_003 + number)
    columns = sorted(rng.choice(dims, max(1, math.ceil(rule.features * dims)), replace=False).tolist()) if rule.features < 1 else list(range(dims))
    tree, stats, nodes = Tree(), {}, [0]
    for _ in range(rule.depth):
        found = level_cuts(level_sums(rows, dims, width, nodes, tree, before, rule, seed + number, columns), len(nodes), width, rule)
        best: dict[int, tuple] = {}
        if rule.policy == "symmetric":
            score: dict[tuple[int, int], float] = {}
            for i, f, b, gain, _, _ in found:
                score[f, b] = score.get((f, b), 0.0) + (gain if math.isfinite(gain) else 0.0)
            if score:
                top = max(score, key=lambda k: (score[k], -k[0], -k[1]))
                if score[top] > rule.min_gain:
                    best = {i: row for row in found for i in [row[0]] if (row[1], row[2]) == top and math.isfinite(row[3])}
        else:
            for row in found:
                i, f, b, gain = row[:4]
                if gain > rule.min_gain and math.isfinite(gain) and (i not in best or (gain, -f, -b) > (best[i][3], -best[i][1], -best[i][2])):
                    best[i] = row
        for row in found:
            stats.setdefault(nodes[row[0]], row[5])
        following = []
        for i, (_, f, b, gain, left, total) in sorted(best.items()):
            node = nodes[i]
            tree.cuts[node] = (f, b, gain)
            stats[2 * node + 1], stats[2 * node + 2] = left, [t - v for t, v in zip(total, left)]
            following += [2 * node + 1, 2 * node + 2]
        if not following:
            break
        nodes = following
    if rule.policy == "leaf":
        tree.cuts = best_first(tree.cuts, rule.leaves)
    inner = set(tree.cuts)
    reached = {0} | {c for n in inner for c in (2 * n + 1, 2 * n + 2)}
    for node in reached & set(stats):
        g, h, n = stats[node]
        tree.covers[node] = n
        if node not in inner:
            tree.values[node] = float(-rule.step * _shrunk(g, rule.l1) / (h + rule.l2)) if h + rule.l2 > 0 else 0.0
    return tree


def best_first(cuts: dict[int, tuple[int, int, float]], leaves: int) -> dict[int, tuple[int, int, float]]:
    """The cuts that are made when the leaf with the greatest gain is always cut next."""
    kept, heap, count = {}, [], 1
    if 0 in cuts:
        heap = [(-cuts[0][2], 0)]
    while heap and count < leaves:
        _, node = heapq.heappop(heap)
        kept[node] = cuts[node]
        count += 1
        for child in (2 * node + 1, 2 * node + 2):
            if child in cuts:
                heapq.heappush(heap, (-cuts[child][2], child))
    return kept


class HistogramBoosting(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasPredictionCol, HasRawPredictionCol, HasProbabilityCol):
    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, growth=None, edges=None, seed=42):
        super().__init__()
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol="prediction", rawPredictionCol="rawPrediction", probabilityCol="probability",
                  **({"weightCol": weightCol} if weightCol else {}))
        self.growth, self.edges, self.seed = growth or Growth(), edges, seed

    def prepared(self, df: DataFrame) -> tuple[DataFrame, list[list[float]], float]:
        """Binned rows, written once: ``bins, label, weight, row, margin``; the edges; the starting margin."""
        features, label = self.getFeaturesCol(), F.col(self.getLabelCol()).cast("double")
        weight = F.col(self.getWeightCol()).cast("double") if self.isDefined("weightCol") else F.lit(1.0)
        first = df.select(vector_to_array(F.col(features)).alias("x")).first()
        if first is None:
            raise ValueError("no rows to learn from")
        edges = self.edges or bin_edges(df, features, len(first["x"]), self.growth.bins)
        share = self.growth.base
        if share is None:
            share = df.agg((F.sum(label * weight) / F.sum(weight)).alias("p")).first()["p"]
        share = min(max(share, 1e-9), 1 - 1e-9)
        start = math.log(share / (1 - share))

        @F.pandas_udf("binary")
        def encoded(x: pd.Series) -> pd.Series:
            return pd.Series([r.tobytes() for r in binned(np.stack(x.to_numpy()), edges)] if len(x) else [], dtype=object)

        path = scratch_path(df.sparkSession, "binned")
        df.select(
            encoded(vector_to_array(F.col(features))).alias("bins"), label.alias("label"), weight.alias("weight"),
            F.xxhash64(vector_to_array(F.col(features)), F.monotonically_increasing_id()).alias("row"), F.lit(start).alias("margin")).write.parquet(path)
        return df.sparkSession.read.parquet(path), edges, start

    def _fit(self, df: DataFrame) -> "BoostedModel":
        rule = self.growth
        rows, edges, start = self.prepared(df)
        dims, width = len(edges), max((len(e) + 1 for e in edges), default=1)
        trees: list[Tree] = []
        held: list[Tree] = []
        for number in range(rule.trees):
            tree = grow(rows, dims, width, held, rule, number, self.seed)
            if not tree.cuts:
                break
            trees.append(tree)
            held.append(tree)
            if len(held) == HELD and number + 1 < rule.trees:
                rows, held = self._advanced(rows, held, dims), []
        model = BoostedModel._of(trees, edges, start)
        return model._set(**{p.name: v for p, v in self.extractParamMap().items() if model.hasParam(p.name)})

    @staticmethod
    def _advanced(rows: DataFrame, trees: list[Tree], dims: int) -> DataFrame:
        """The rows with the trees' margins added, written so that neither lineage nor passes grow with the trees."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    bins = bytes_of(batch, dims)
                    margin = np.asarray(batch["margin"]) + sum(t.margins(bins) for t in trees)
                    yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margin))

        path = scratch_path(rows.sparkSession, "margins")
        rows.mapInArrow(run, rows.schema).write.parquet(path)
        return rows.sparkSession.read.parquet(path)


class BoostedModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    """Trees and edges are one parameter, so that the model is saved like any other."""

    state = Param(Params._dummy(), "state", "trees and edges as JSON", TypeConverters.toString)

    @classmethod
    def _of(cls, trees: list[Tree], edges: list[list[float]], start: float) -> "BoostedModel":
        packed = [{k: [[n, *(v if isinstance(v, tuple) else (v,))] for n, v in getattr(t, k).items()] for k in ("cuts", "values", "covers")} for t in trees]
        return cls()._set(state=json.dumps({"trees": packed, "edges": edges, "start": start}), featuresCol="features", labelCol="label")

    def parts(self) -> tuple[list[Tree], list[list[float]], float]:
        s = json.loads(self.getOrDefault(self.state))
        trees = [Tree({n: (f, b, g) for n, f, b, g in t["cuts"]}, {n: v for n, v in t["values"]}, {n: c for n, c in t["covers"]}) for t in s["trees"]]
        return trees, s["edges"], s["start"]

    @property
    def treeWeights(self) -> list[float]:
        return [1.0] * len(self.parts()[0])

    @property
    def featureImportances(self) -> DenseVector:
        """Share of the total gain."""
        trees, edges, _ = self.parts()
        gain = np.zeros(len(edges))
        for t in trees:
            for f, _, g in t.cuts.values():
                gain[f] += g
        return Vectors.dense(gain / gain.sum() if gain.sum() > 0 else gain)

    def leaf_paths(self) -> tuple[list, float]:
        """Leaves as ``(value, [(feature, low, high, cover share)])``, and the mean margin by covers."""
        trees, edges, start = self.parts()
        leaves, base = [], start
        for tree in trees:
            stack = [(0, {})]
            while stack:
                node, held = stack.pop()
                if node not in tree.cuts:
                    value = tree.values.get(node, 0.0)
                    leaves.append((value, [(f, lo, hi, share) for f, (lo, hi, share) in held.items()]))
                    base += value * math.prod(share for *_, share in held.values())
                    continue
                f, b, _ = tree.cuts[node]
                cut = edges[f][b]
                for child, left in ((2 * node + 1, True), (2 * node + 2, False)):
                    lo, hi, share = held.get(f, (-math.inf, math.inf, 1.0))
                    share *= tree.covers[child] / tree.covers[node]
                    stack.append((child, {**held, f: (lo, min(hi, cut), share) if left else (max(lo, cut), hi, share)}))
        return leaves, base

    def _transform(self, df: DataFrame) -> DataFrame:
        trees, edges, start = self.parts()

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            bins = binned(np.stack(x.to_numpy()), edges)
            return pd.Series(start + sum((t.margins(bins) for t in trees), np.zeros(len(bins))))

        raw, p = self.getRawPredictionCol(), self.getProbabilityCol()
        out = df.withColumn(raw, margin(vector_to_array(F.col(self.getFeaturesCol()))))
        out = out.withColumn(p, 1.0 / (1.0 + F.exp(-F.col(raw)))).withColumn(self.getPredictionCol(), (F.col(raw) > 0).cast("double"))
        return out.withColumn(p, array_to_vector(F.array(1.0 - F.col(p), F.col(p)))).withColumn(raw, array_to_vector(F.array(-F.col(raw), F.col(raw))))
