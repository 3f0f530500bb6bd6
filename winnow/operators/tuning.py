"""Hyper-parameter search with early stopping: rungs over nested row shares, trials drawn from a density ratio.

A trial is first fitted on a small share of the rows; only the better ones go on to the next, larger share. A row's share is
drawn from the digest of its id, so the shares are nested and a lost executor draws the same rows. Rows are written once by
share, so that a rung reads its own files only.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.operators.kernels import uniform_key
from winnow.operators.models import Fitted, estimator, fold_value, side_by_side
from winnow.operators.splits import row_kfold
from winnow.session import scratch_path

DRAWS = 24  # candidates a new trial is chosen from
FEW = 10  # trials drawn at random before any density is trusted


# ---------------------------------------------------------------- parameter spaces


@dataclass(frozen=True)
class Span:
    """Numbers from ``low`` to ``high``; ``wide`` spans are searched by their logarithm."""

    low: float
    high: float
    whole: bool = False
    wide: bool = False

    def unit(self, value: float) -> float:
        a, b, v = (math.log(x) if self.wide else x for x in (self.low, self.high, value))
        return 0.5 if a == b else (v - a) / (b - a)

    def value(self, unit: float):
        a, b = (math.log(x) if self.wide else x for x in (self.low, self.high))
        v = a + min(1.0, max(0.0, unit)) * (b - a)
        v = min(self.high, max(self.low, math.exp(v) if self.wide else v))
        return int(round(v)) if self.whole else v


Space = Mapping[str, Span | Sequence]


def space_of(grid: Mapping[str, Sequence]) -> dict[str, Span | list]:
    """Lists of numbers become spans from the least to the greatest, other lists stay choices."""
    out: dict[str, Span | list] = {}
    for name, values in grid.items():
        numbers = all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in values)
        if not numbers or len(values) < 2:
            out[name] = list(values)
            continue
        low, high = min(values), max(values)
        out[name] = Span(low, high, all(isinstance(v, int) for v in values), low > 0 and high / low >= 100)
    return out


def random_point(space: Space, rng: np.random.Generator) -> dict:
    return {k: s.value(rng.random()) if isinstance(s, Span) else s[int(rng.integers(len(s)))] for k, s in space.items()}


class Density:
    """Product kernels around finished trials, one more as wide as the space."""

    def __init__(self, space: Space, points: Sequence[Mapping]):
        self.space, self.n = space, len(points)
        numbers = [k for k, s in space.items() if isinstance(s, Span)]
        self.at = {k: np.array([space[k].unit(p[k]) for p in points] + [0.5]) for k in numbers}
        shrink = max(self.n, 1) ** (-1.0 / (len(space) + 4))
        self.width = {}
        for k in numbers:
            spread = float(np.std(self.at[k][:-1])) if self.n > 1 else 0.3
            self.width[k] = np.append(np.full(self.n, max(1.06 * spread * shrink, 1.0 / min(100, 2 + self.n))), 1.0)
        self.hits = {
            k: np.array([[1.0 if p[k] == v else 0.0 for v in s] for p in points] + [[1.0 / len(s)] * len(s)])
            for k, s in space.items() if not isinstance(s, Span)
        }
        blur = 1.0 / (self.n + 1)
        self.hits = {k: (1 - blur) * h + blur / h.shape[1] for k, h in self.hits.items()}

    def draw(self, rng: np.random.Generator) -> dict:
        i = int(rng.integers(self.n + 1))
        out = {}
        for k, s in self.space.items():
            if isinstance(s, Span):
                u = next((u for u in rng.normal(self.at[k][i], self.width[k][i], 50) if 0 <= u <= 1), rng.random())
                out[k] = s.value(float(u))
            else:
                out[k] = s[int(rng.choice(len(s), p=self.hits[k][i]))]
        return out

    def log(self, point: Mapping) -> float:
        total = np.zeros(self.n + 1)
        for k, s in self.space.items():
            if isinstance(s, Span):
                z = (s.unit(point[k]) - self.at[k]) / self.width[k]
                total += -0.5 * z * z - np.log(self.width[k])
            else:
                total += np.log(self.hits[k][:, list(s).index(point[k])])
        top = total.max()
        return float(top + np.log(np.exp(total - top).mean()))


def proposed(space: Space, finished: Sequence[tuple[Mapping, float]], rng: np.random.Generator) -> dict:
    """The drawn point that the good trials' density favours most over the others'."""
    if len(finished) < FEW:
        return random_point(space, rng)
    ranked = sorted(finished, key=lambda t: -t[1])
    cut = min(25, math.ceil(0.15 * len(ranked)))
    good, bad = (Density(space, [p for p, _ in part]) for part in (ranked[:cut], ranked[cut:]))
    return max((good.draw(rng) for _ in range(DRAWS)), key=lambda p: good.log(p) - bad.log(p))


# ---------------------------------------------------------------- rungs


@dataclass
class Trial:
    number: int
    bracket: int
    params: dict
    values: dict[int, float] = field(default_factory=dict)  # by rung

    @property
    def last(self) -> int:
        return max(self.values, default=-1)


def brackets(rungs: int, eta: int) -> list[tuple[int, int]]:
    """(first rung, trials) of each bracket; every bracket costs about as many rows."""
    top = rungs - 1
    return [(top - s, math.ceil((top + 1) / (s + 1) * eta**s)) for s in range(top, -1, -1)]


@dataclass
class Study:
    trials: list[Trial]
    rungs: int

    @property
    def best(self) -> Trial:
        """The best of the trials that went furthest."""
        reached = max(t.last for t in self.trials)
        return max((t for t in self.trials if t.last == reached), key=lambda t: (_number(t.values[reached]), -t.number))

    def table(self) -> list[tuple[int, int, int]]:
        """(bracket, rung, trials evaluated)."""
        counts: dict[tuple[int, int], int] = {}
        for t in self.trials:
            for r in t.values:
                counts[t.bracket, r] = counts.get((t.bracket, r), 0) + 1
        return sorted((b, r, n) for (b, r), n in counts.items())


def _number(v: float | None) -> float:
    return -math.inf if v is None or math.isnan(v) else v


def run_study(space: Space, evaluate: Callable[[list[tuple[dict, int]]], list[float]], trials: int, rungs: int, eta: int = 3,
              pruner: str = "hyperband", sampler: str = "tpe", seed: int = 42, timeout: float | None = None) -> Study:
    """``evaluate`` scores (parameters, rung) pairs, higher is better.

    ``hyperband``: brackets of different daring are repeated; of each rung the best ``1 / eta`` go on.
    ``median`` / ``percentile``: a trial goes on while it is no worse than half (a quarter) of what earlier ones reached
    on that rung. ``none``: every trial is judged on the last rung. At most ``trials`` trials are started; after
    ``timeout`` seconds none is.
    """
    if pruner not in ("hyperband", "median", "percentile", "none") or sampler not in ("tpe", "random"):
        raise ValueError(f"unknown pruner {pruner} or sampler {sampler}")
    rng, began, done = np.random.default_rng(seed), time.monotonic(), []

    def fresh(bracket: int) -> Trial:
        known: list[tuple[Mapping, float]] = []
        for rung in range(rungs - 1, -1, -1):  # the highest rung with enough trials: values of different rungs do not compare
            known = [(t.params, _number(t.values[rung])) for t in done if rung in t.values]
            if len(known) >= FEW:
                break
        point = proposed(space, known, rng) if sampler == "tpe" else random_point(space, rng)
        done.append(Trial(len(done), bracket, point))
        return done[-1]

    def on() -> bool:
        return len(done) < trials and (timeout is None or time.monotonic() - began < timeout)

    def judge(group: list[Trial], rung: int) -> None:
        for t, value in zip(group, evaluate([(t.params, rung) for t in group])):
            t.values[rung] = value

    if pruner == "hyperband":
        plan, turn = brackets(rungs, eta), 0
        while on():
            first, count = plan[turn % len(plan)]
            group = [fresh(turn) for _ in range(min(count, trials - len(done)))]
            for rung in range(first, rungs):
                judge(group, rung)
                group = sorted(group, key=lambda t: (-_number(t.values[rung]), t.number))[:max(1, len(group) // eta)]
            turn += 1
    else:
        floor = {"median": 50, "percentile": 25, "none": 0}[pruner]
        while on():
            trial = fresh(0)
            for rung in range(rungs - 1 if pruner == "none" else 0, rungs):
                earlier = [_number(t.values[rung]) for t in done[:-1] if rung in t.values]
                judge([trial], rung)
                if len(earlier) >= 5 and _number(trial.values[rung]) < np.percentile(earlier, floor):
                    break
    return Study(done, rungs)


# ---------------------------------------------------------------- on Spark


def rung_of(row_id: str, rungs: int, eta: int, seed: int) -> Column:
    """The first rung whose share holds the row; rung ``r`` holds ``eta ** (r + 1 - rungs)`` of all rows."""
    drawn = uniform_key(F.concat_ws("|", F.col(row_id).cast("string"), F.lit(f"rung{seed}"))) / float(2**52)
    out = F.lit(rungs - 1)
    for r in range(rungs - 2, -1, -1):
        out = F.when(drawn < float(eta) ** (r + 1 - rungs), r).otherwise(out)
    return out


@dataclass
class Tuned:
    params: dict
    value: float
    model: Fitted
    study: Study
    rung_rows: list[int]  # rows of each rung

    def table(self, spark) -> DataFrame:
        """``bracket, rung, trials, rows``: what the search has looked at."""
        return spark.createDataFrame([(b, r, n, self.rung_rows[r]) for b, r, n in self.study.table()], "bracket int, rung int, trials int, rows long")

    @property
    def cost(self) -> float:
        """Rows fitted, as a share of fitting every trial on all rows."""
        spent = sum(n * self.rung_rows[r] for _, r, n in self.study.table())
        return spent / (len(self.study.trials) * self.rung_rows[-1])


def tune(df: DataFrame, family: str, space: Space, row_id: str, label: str = "label", features: str = "features", trials: int = 100,
         folds: int = 5, rungs: int = 4, eta: int = 3, metric: str = "roc_auc", pruner: str = "hyperband", sampler: str = "tpe",
         parallelism: int = 4, seed: int = 42, timeout: float | None = None, weight: str | None = None, **fixed) -> Tuned:
    """Search ``space`` by cross-validated ``metric`` and fit the best point on all rows.

    Trials of one rung run side by side. A fold of a small share may lack a class; such a trial counts as the worst.
    """
    spark = df.sparkSession
    names = [features, label, *([weight] if weight else [])]
    dealt = row_kfold(df.withColumn(label, F.col(label).cast("double")), row_id, folds, seed)
    path = scratch_path(spark, "rungs")
    dealt.select(*names, "fold", rung_of(row_id, rungs, eta, seed).alias("rung")).write.partitionBy("rung").parquet(path)
    rows = spark.read.parquet(path)
    sizes = {(r["rung"], r["fold"]): r["n"] for r in rows.groupBy("rung", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    upto = [sum(n for (k, _), n in sizes.items() if k <= r) for r in range(rungs)]

    def one(job: tuple[dict, int, int]) -> float:
        params, rung, fold = job
        share = rows.filter(F.col("rung") <= rung)
        held = share.filter(F.col("fold") == fold)
        n = sum(c for (k, f), c in sizes.items() if k <= rung and f != fold)
        try:
            return fold_value(share.filter(F.col("fold") != fold), held, n, family, metric, features, label, weight, seed, {**fixed, **params})
        except Exception:
            classes = share.groupBy("fold").agg(F.count_distinct(label).alias("c")).filter("c < 2").count()
            if classes or n == 0:  # a share too small to be split
                return math.nan
            raise

    def evaluate(points: list[tuple[dict, int]]) -> list[float]:
        found = side_by_side(spark, one, [(p, r, k) for p, r in points for k in range(folds)], parallelism)
        return [float(np.mean(found[i * folds:(i + 1) * folds])) for i in range(len(points))]

    study = run_study(space, evaluate, trials, rungs, eta, pruner, sampler, seed, timeout)
    best = study.best
    model = estimator(family, upto[-1], features, label, weight, seed, **{**fixed, **best.params}).fit(rows)
    return Tuned(best.params, best.values[best.last], Fitted(family, model), study, upto)
