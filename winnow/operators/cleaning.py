"""Fit on train, transform anything: imputation and outlier treatment."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.scalar import clip
from winnow.operators.describe import most_common
from winnow.operators.kernels import chunks, exact_quantiles, unpivot
from winnow.roles import ColumnRoles, categorical_columns, is_integral, numeric_columns
from winnow.session import stored


@dataclass
class CleanerModel:
    """Frozen train statistics; ``transform`` is a single projection."""

    fills: dict[str, object] = field(default_factory=dict)
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)
    outlier_ranges: dict[str, list[tuple[float, float]]] = field(default_factory=dict)
    replacements: dict[str, float] = field(default_factory=dict)

    def _clean(self, name: str, dtype) -> Column:
        cell = F.col(name)
        if self.fills.get(name) is not None:
            cell = F.coalesce(cell, F.lit(self.fills[name]))
        if name in self.bounds:
            low, high = self.bounds[name]
            if low is not None and high is not None:
                if is_integral(dtype):
                    low, high = math.trunc(low), math.trunc(high)
                cell = clip(cell, low, high)
        if name in self.outlier_ranges:
            value, fill = self.replacements[name], self.fills.get(name)
            filled = f"`{name}`" if fill is None else f"coalesce(`{name}`, {float(fill)!r}D)"
            odd = F.expr(_inside(filled, self.outlier_ranges[name]))
            cell = F.when(odd, F.lit(float(round(value)) if is_integral(dtype) else value)).otherwise(cell)
        return cell.alias(name)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[self._clean(f.name, f.dataType) for f in df.schema])


@dataclass
class BasicCleaner:
    """Defaults as documented: median fill, then z-score clipping at 3.

    ``cat_fill='mode'`` uses the train mode, any other text is the fill value itself.
    The target, the ids, the group and the time column are never touched.
    """

    num_fill: str = "median"
    cat_fill: str = "mode"
    outlier_method: str | None = "zscore"
    outlier_threshold: float = 3.0
    winsorize_limits: tuple[float, float] = (0.01, 0.99)
    apply_outlier_treatment: bool = True
    iforest_contamination: float = 0.05
    iforest_trees: int = 100
    iforest_sample: int = 256
    seed: int = 42

    def fit(self, train: DataFrame, roles: ColumnRoles | None = None) -> CleanerModel:
        reserved = roles.reserved if roles else ()
        numeric, categorical = numeric_columns(train, reserved), categorical_columns(train, reserved)
        method = self.outlier_method if self.apply_outlier_treatment else None
        probs = []
        if self.num_fill == "median":
            probs.append(0.5)
        if method == "iqr":
            probs += [0.25, 0.75]
        elif method == "winsorize":
            probs += list(self.winsorize_limits)
        whole = train
        if not train.is_cached and (numeric or categorical):
            train = stored(train.select(*numeric, *categorical), "train")
        quantiles = exact_quantiles(train, numeric, probs, durable=False) if probs else {}
        at = lambda c, p: quantiles[c][probs.index(p)]
        means: dict[str, tuple] = {}
        if self.num_fill == "mean" or method == "zscore":
            for part in chunks(numeric, 100):
                row = train.agg(*[
                    e for c in part for e in (
                        F.avg(F.col(c).cast("double")).alias(f"{c}__m"), F.stddev_samp(F.col(c).cast("double")).alias(f"{c}__s"),
                    )
                ]).first()
                means.update({c: (row[f"{c}__m"], row[f"{c}__s"]) for c in part})
        model = CleanerModel()
        for c in numeric:
            model.fills[c] = at(c, 0.5) if self.num_fill == "median" else means[c][0]
        if categorical:
            if self.cat_fill == "mode":
                model.fills.update({r["feature"]: r["value"] for r in most_common(train, categorical).collect()})
            else:
                model.fills.update(dict.fromkeys(categorical, self.cat_fill))
        if method == "zscore":
            for c in numeric:
                m, s = means[c]
                if m is not None and s is not None:
                    model.bounds[c] = (m - self.outlier_threshold * s, m + self.outlier_threshold * s)
        elif method == "iqr":
            for c in numeric:
                q1, q3 = at(c, 0.25), at(c, 0.75)
                if q1 is not None:
                    model.bounds[c] = (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        elif method == "winsorize":
            for c in numeric:
                model.bounds[c] = tuple(at(c, p) for p in self.winsorize_limits)
        elif method == "iforest":
            self._fit_forest(whole, numeric, model)
        return model

    # ------------------------------------------------------------ isolation forest

    def _fit_forest(self, train: DataFrame, numeric: Sequence[str], model: CleanerModel) -> None:
        """A forest over one column is a step function of the value.

        Every tree grows from rows of its own, those with the least digests of all their cells: a plain sample that no
        partitioning changes. The steps are then counted over all train rows, so the contamination threshold is exact. Two jobs per
        20 columns, and one for the sample.
        """
        pool = hashed_rows(train, numeric, self.iforest_trees * self.iforest_sample, self.seed)
        for part in chunks(list(numeric), 20):
            data = train.select(*[F.col(c).cast("double").alias(c) for c in part])
            steps = {}
            for c in part:
                values = pool[c].dropna().to_numpy(dtype=float)
                values = values[np.isfinite(values)]
                if len(values) and values.min() < values.max():
                    steps[c] = _forest_steps(values, self.iforest_trees, self.iforest_sample, self.seed)
            if not steps:
                continue
            edges = [np.array(cuts) for cuts, _ in steps.values()]

            def tally(frames, edges=edges):
                total = [np.zeros(len(e) + 1, dtype=np.int64) for e in edges]
                for pdf in frames:
                    for i, e in enumerate(edges):
                        values = pdf.iloc[:, i].dropna().to_numpy(dtype=float)
                        total[i] += np.bincount(np.searchsorted(e, values, side="right"), minlength=len(e) + 1)
                for i, t in enumerate(total):
                    hit = np.flatnonzero(t)
                    yield pd.DataFrame({"c": i, "b": hit, "n": t[hit]})

            # one row per column and interval reaches the driver
            table = data.select(*steps).mapInPandas(tally, "c int, b int, n long").groupBy("c", "b").agg(F.sum("n").alias("n")).toPandas()
            for i, (c, (cuts, depth)) in enumerate(steps.items()):
                counts = np.zeros(len(depth), dtype=np.int64)
                mine = table[table["c"] == i]
                counts[mine["b"]] = mine["n"]
                model.outlier_ranges[c] = _odd_ranges([-math.inf, *cuts, math.inf], depth, counts, self.iforest_contamination)
                model.replacements[c] = model.fills[c]


def hashed_rows(df: DataFrame, columns: Sequence[str], count: int, seed: int) -> pd.DataFrame:
    """``count`` rows in the order of their digests, the least first (all rows if there are fewer); equal rows share a digest.

    Only rows below a threshold that lets slightly more through reach the driver; it is raised until there are enough.
    """
    cells = [F.col(f"`{c}`").cast("string") for c in df.columns]
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns], F.xxhash64(F.lit(seed), *cells).alias("_h"))
    share = 1.2 * count / max(df.count(), 1) + 1e-9
    while True:
        low = 2**63 - 1 if share >= 1 else int(share * 2**64) - 2**63
        few = rows.filter(F.col("_h") <= F.lit(low)).groupBy("_h").agg(*[F.any_value(F.col(f"`{c}`")).alias(c) for c in columns], F.count(F.lit(1)).alias("_n"))
        found = few.toPandas().sort_values("_h")
        if found["_n"].sum() >= count or share >= 1:
            return found.loc[found.index.repeat(found["_n"].clip(upper=count))].head(count).reset_index(drop=True)
        share *= 2


def _odd_ranges(splits: list[float], depth: np.ndarray, counts: np.ndarray, share: float) -> list[tuple[float, float]]:
    """Runs of intervals whose mean depth lies below the ``share`` quantile over all rows."""
    limit = _weighted_quantile(depth, counts, share)
    ranges, start = [], None
    for i, odd in enumerate([*(depth < limit), False]):
        if odd and start is None:
            start = i
        elif not odd and start is not None:
            ranges.append((splits[start], splits[i]))
            start = None
    return ranges


def _forest_steps(pool: np.ndarray, trees: int, sample: int, seed: int) -> tuple[list[float], np.ndarray]:
    """Breakpoints and the mean path length of every interval between them."""
    rng = np.random.default_rng(seed)
    size = min(sample, len(pool))
    limit = math.ceil(math.log2(max(size, 2)))
    steps = []

    def grow(x: np.ndarray, depth: int, leaves: list) -> None:
        if depth >= limit or len(x) <= 1 or x[0] == x[-1]:
            leaves.append((x[0] if len(x) else -math.inf, depth + _unsplit_depth(len(x))))
            return
        cut = rng.uniform(x[0], x[-1])
        k = int(np.searchsorted(x, cut, side="right"))
        k = min(max(k, 1), len(x) - 1)
        grow(x[:k], depth + 1, leaves)
        mark = len(leaves)
        grow(x[k:], depth + 1, leaves)
        leaves[mark] = (cut, leaves[mark][1])

    for t in range(trees):
        leaves: list[tuple[float, float]] = []
        # rows of its own as long as there are enough, else drawn again from all
        own = pool[t * size:(t + 1) * size] if len(pool) >= trees * size else rng.choice(pool, size, replace=False)
        grow(np.sort(own), 0, leaves)
        steps.append((np.array([s for s, _ in leaves[1:]]), np.array([d for _, d in leaves])))
    cuts = np.unique(np.concatenate([s for s, _ in steps]))
    left = np.concatenate([[-math.inf], cuts])
    total = sum(d[np.searchsorted(s, left, side="right")] for s, d in steps)
    return [float(c) for c in cuts], total / len(steps)


def _unsplit_depth(n: int) -> float:
    """Mean depth of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n if n > 2 else 1.0


def _weighted_quantile(values: np.ndarray, weights: np.ndarray, q: float) -> float:
    order = np.argsort(values, kind="stable")
    upto = np.cumsum(weights[order])
    spot = q * (upto[-1] - 1)
    pick = lambda r: values[order][int(np.searchsorted(upto, r, side="right"))]
    lo, hi = pick(math.floor(spot)), pick(math.ceil(spot))
    return float(lo + (hi - lo) * (spot - math.floor(spot)))


def _inside(value: str, ranges: Sequence[tuple[float, float]]) -> str:
    """SQL text of ``value`` lying in one of the half-open ranges."""
    tests = []
    for low, high in ranges:
        ends = [f"{value} >= {low!r}D"] if not math.isinf(low) else []
        ends += [f"{value} < {high!r}D"] if not math.isinf(high) else []
        tests.append("(" + " AND ".join(ends or ["true"]) + ")")
    return " OR ".join(tests) or "false"


def clip_columns(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    return CleanerModel(bounds=bounds).transform(df)


def outlier_share(df: DataFrame, model: CleanerModel) -> DataFrame:
    """(feature, share of values a fitted forest would replace)."""
    flags = [
        F.when(F.col(c).isNotNull(), F.expr(_inside(f"`{c}`", ranges)).cast("double")).alias(c)
        for c, ranges in model.outlier_ranges.items()
    ]
    return unpivot(df.select(*flags), list(model.outlier_ranges)).groupBy("feature").agg(F.avg("value").alias("share"))
