"""Kernel support vector machines: explicit feature maps in front of a linear machine.

A kernel matrix over all rows grows with their square. A map of bounded size whose inner products estimate the kernel
turns the problem into a linear one that is fitted in passes over the rows: random Fourier features for the rbf kernel, landmark rows
(Nystroem) for the polynomial and the sigmoid kernel.
"""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol, HasWeightCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KERNELS = ("rbf", "poly", "sigmoid")
MAX_COMPONENTS = 4096  # the map travels in the plan


def kernel_matrix(x: np.ndarray, y: np.ndarray, kernel: str, gamma: float, degree: int, coef0: float) -> np.ndarray:
    if kernel == "rbf":
        gap = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T
        return np.exp(-gamma * np.maximum(gap, 0))
    inner = gamma * (x @ y.T) + coef0
    return inner**degree if kernel == "poly" else np.tanh(inner)


@dataclass
class KernelMap:
    """``apply`` turns rows into ``width`` features whose inner products estimate the kernel."""

    kernel: str
    gamma: float
    degree: int = 3
    coef0: float = 0.0
    points: np.ndarray | None = None  # frequencies, or landmark rows
    second: np.ndarray | None = None  # phases, or the whitening of the landmarks' own kernel matrix

    @property
    def width(self) -> int:
        return len(self.points) if self.kernel == "rbf" else self.second.shape[1]

    def apply(self, x: np.ndarray) -> np.ndarray:
        if self.kernel == "rbf":
            return np.sqrt(2.0 / len(self.points)) * np.cos(x @ self.points.T + self.second)
        return kernel_matrix(x, self.points, self.kernel, self.gamma, self.degree, self.coef0) @ self.second

    @classmethod
    def fourier(cls, dims: int, gamma: float, components: int, seed: int) -> KernelMap:
        rng = np.random.default_rng(seed)
        return cls("rbf", gamma, points=rng.normal(0, np.sqrt(2 * gamma), (components, dims)), second=rng.uniform(0, 2 * np.pi, components))

    @classmethod
    def nystroem(cls, rows: np.ndarray, kernel: str, gamma: float, degree: int, coef0: float) -> KernelMap:
        """Directions of the landmarks' kernel matrix with a positive share; a sigmoid kernel's negative ones are left out."""
        values, vectors = np.linalg.eigh(kernel_matrix(rows, rows, kernel, gamma, degree, coef0))
        held = values > max(values.max(), 0) * 1e-10
        return cls(kernel, gamma, degree, coef0, rows, vectors[:, held] / np.sqrt(values[held]))


def entry_variance(df: DataFrame, features: str) -> tuple[int, float]:
    """Number of slots, and the variance over all cells of all rows."""
    row = df.select(Summarizer.metrics("count", "mean", "variance").summary(F.col(features)).alias("s")).first()["s"]
    mean, n = np.array(row["mean"]), row["count"]
    within = np.array(row["variance"]) * (n - 1) / n if n > 1 else np.zeros(len(mean))
    return len(mean), float((within + mean**2).mean() - mean.mean() ** 2)


def landmark_rows(df: DataFrame, features: str, count: int, seed: int) -> np.ndarray:
    """``count`` distinct rows with the least digests: a sample that no copy or partitioning moves."""
    rows = df.select(F.xxhash64(vector_to_array(F.col(features)), F.lit(seed)).alias("h"), vector_to_array(F.col(features)).alias("x"))
    least = [r["h"] for r in rows.select("h").distinct().orderBy("h").limit(count).collect()]
    kept = rows.filter(F.col("h").isin(least)).groupBy("h").agg(F.any_value("x").alias("x")).orderBy("h")
    return np.array([r["x"] for r in kept.collect()], float)


class KernelSVC(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasPredictionCol, HasRawPredictionCol):
    """``gamma``: a number, ``scale`` (1 / slots / variance) or ``auto`` (1 / slots)."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, kernel="rbf", gamma="scale", degree=3, coef0=0.0, components=256,
                 regParam=0.0, maxIter=100, tol=1e-6, seed=42):
        super().__init__()
        if kernel not in KERNELS or not 0 < components <= MAX_COMPONENTS:
            raise ValueError(f"kernel {kernel} with {components} components; kernels are {KERNELS}, components at most {MAX_COMPONENTS}")
        self._set(featuresCol=featuresCol, labelCol=labelCol, rawPredictionCol="rawPrediction", predictionCol="prediction", **({"weightCol": weightCol} if weightCol else {}))
        self.kernel, self.gamma, self.degree, self.coef0, self.components = kernel, gamma, degree, coef0, components
        self.fitting, self.seed = {"regParam": regParam, "maxIter": maxIter, "tol": tol, "standardization": False}, seed

    def map_of(self, df: DataFrame) -> KernelMap:
        features, gamma = self.getFeaturesCol(), self.gamma
        if gamma in ("scale", "auto") or self.kernel == "rbf":
            dims, variance = entry_variance(df, features)
            gamma = 1.0 / (dims * variance if gamma == "scale" and variance > 0 else dims) if gamma in ("scale", "auto") else gamma
        if self.kernel == "rbf":
            return KernelMap.fourier(dims, gamma, self.components, self.seed)
        return KernelMap.nystroem(landmark_rows(df, features, self.components, self.seed), self.kernel, gamma, self.degree, self.coef0)

    def _fit(self, df: DataFrame) -> "KernelSVCModel":
        fitted = self.map_of(df)

        @F.pandas_udf("array<double>")
        def mapped(x: pd.Series) -> pd.Series:
            return pd.Series(list(fitted.apply(np.stack(x.to_numpy())))) if len(x) else pd.Series([], dtype=object)

        weight = [self.getWeightCol()] if self.isDefined("weightCol") else []
        rows = df.select(self.getLabelCol(), *weight, array_to_vector(mapped(vector_to_array(F.col(self.getFeaturesCol())))).alias("_kernel"))
        rows = rows.persist()
        linear = LinearSVC(featuresCol="_kernel", labelCol=self.getLabelCol(), **({"weightCol": weight[0]} if weight else {}), **self.fitting).fit(rows)
        rows.unpersist()
        model = KernelSVCModel._of(fitted, linear.coefficients.toArray(), float(linear.intercept))
        return model._set(**{p.name: v for p, v in self.extractParamMap().items() if model.hasParam(p.name)})


class KernelSVCModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Margin of the mapped row; the whole model is one parameter, so that it is saved like any other."""

    state = Param(Params._dummy(), "state", "map and weights as JSON", TypeConverters.toString)

    @classmethod
    def _of(cls, fitted: KernelMap, weights: np.ndarray, intercept: float) -> "KernelSVCModel":
        packed = lambda a: [list(a.shape), base64.b64encode(np.ascontiguousarray(a, "<f8").tobytes()).decode()]
        text = json.dumps({
            "kernel": fitted.kernel, "gamma": fitted.gamma, "degree": fitted.degree, "coef0": fitted.coef0, "points": packed(fitted.points),
            "second": packed(fitted.second), "weights": packed(weights), "intercept": intercept})
        return cls()._set(state=text, featuresCol="features", labelCol="label")

    def _parts(self) -> tuple[KernelMap, np.ndarray, float]:
        s = json.loads(self.getOrDefault(self.state))
        opened = lambda v: np.frombuffer(base64.b64decode(v[1]), "<f8").reshape(v[0])
        fitted = KernelMap(s["kernel"], s["gamma"], s["degree"], s["coef0"], opened(s["points"]), opened(s["second"]))
        return fitted, opened(s["weights"]), s["intercept"]

    @property
    def featureImportances(self) -> DenseVector:
        """Share of each slot in the weighted frequencies or landmarks."""
        fitted, weights, _ = self._parts()
        pull = weights if fitted.kernel == "rbf" else fitted.second @ weights
        size = np.abs(pull[:, None] * fitted.points).sum(0)
        return Vectors.dense(size / size.sum() if size.sum() > 0 else size)

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted, weights, intercept = self._parts()

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            return pd.Series(fitted.apply(np.stack(x.to_numpy())) @ weights + intercept if len(x) else [], dtype=float)

        raw = self.getRawPredictionCol()
        out = df.withColumn(raw, margin(vector_to_array(F.col(self.getFeaturesCol()))))
        return out.withColumn(self.getPredictionCol(), (F.col(raw) > 0).cast("double")).withColumn(raw, array_to_vector(F.array(-F.col(raw), F.col(raw))))
