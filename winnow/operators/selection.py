"""Feature selection: each step works on the survivors of the one before."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.operators.describe import feature_profile
from winnow.operators.kernels import WIDE_LIMIT, chunks, exact_quantiles, pairwise_corr, safe_corr, stats_to_rows, unpivot
from winnow.roles import ColumnRoles, categorical_columns, numeric_columns


def _num(c: str) -> Column:
    return F.col(c).cast("double")


def _collect(df: DataFrame, key: str, value: str) -> dict:
    """Driver copy of a table with one row per feature."""
    return {r[key]: r[value] for r in df.collect()}


def _concat(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


# ---------------------------------------------------------------- what the steps measure


def missing_ratios(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    parts = []
    for part in chunks(list(columns)):
        wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in part])
        parts.append(stats_to_rows(wide, part, {"ratio": lambda c: F.col(c) / F.col("_n")}))
    return _concat(parts)


def duplicate_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, kept): columns equal on every row to an earlier one, NULL equal to NULL.

    A sum of salted row hashes proposes candidates in one scan; only those are compared.
    """
    types = dict(df.dtypes)
    # the row hash over all columns weighs each cell, so that a permuted column differs; the text tells -0.0 from 0.0
    salted = df.select(*[F.col(c) for c in columns], F.xxhash64(*[F.col(c) for c in columns]).alias("_salt"))
    cell = lambda c: F.xxhash64(
        F.col(c), *([F.when(F.col(c) == 0, F.col(c).cast("string"))] if types[c] in ("double", "float") else []), F.col("_salt"))
    prints: dict[str, tuple] = {}
    for part in chunks(list(columns), WIDE_LIMIT // 3):
        hashed = salted.select(*[cell(c).alias(f"h{i}") for i, c in enumerate(part)])
        # a 64-bit hash is added up in three pieces, so that no sum overflows
        row = hashed.agg(*[F.sum(F.shiftrightunsigned(f"h{i}", at).bitwiseAND(F.lit((1 << 22) - 1))) for i in range(len(part)) for at in (0, 22, 44)]).first()
        prints.update({c: tuple(row[3 * i:3 * i + 3]) for i, c in enumerate(part)})
    groups: dict[tuple, list[str]] = {}
    for c in columns:
        groups.setdefault((types[c], prints[c]), []).append(c)
    pairs = [(later, g[0]) for g in groups.values() for later in g[1:]]
    if not pairs:
        none = F.lit(None).cast("string")
        return df.sparkSession.range(0).select(none.alias("feature"), none.alias("kept"))
    parts = []
    for part in chunks(pairs):
        wide = df.agg(*[
            F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"d{i}") for i, (a, b) in enumerate(part)
        ])
        rows = F.array(*[
            F.struct(F.lit(a).alias("feature"), F.lit(b).alias("kept"), F.col(f"d{i}").alias("d"))
            for i, (a, b) in enumerate(part)
        ])
        parts.append(wide.select(F.inline(rows)))
    return _concat(parts).filter("d = 0").drop("d")


def scaled_variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population variance of each column scaled to [0, 1]; NULL reads 0."""
    parts = []
    for part in chunks(list(columns), 100):
        row = df.agg(*[e for c in part for e in (
            F.min(F.coalesce(_num(c), F.lit(0.0))).alias(f"{c}__a"), F.max(F.coalesce(_num(c), F.lit(0.0))).alias(f"{c}__b"))]).first()
        cells = []
        for c in part:
            low, high = row[f"{c}__a"], row[f"{c}__b"]
            width = (high - low) if low is not None and high > low else 1.0
            cells.append(F.var_pop((F.coalesce(_num(c), F.lit(0.0)) - F.lit(low or 0.0)) / F.lit(width)).alias(c))
        parts.append(stats_to_rows(df.agg(*cells), part, {"variance": F.col}))
    return _concat(parts)


def outlier_ratios(df: DataFrame, columns: Sequence[str], method: str = "iqr", durable: bool = True) -> DataFrame:
    """Share of all rows outside the IQR fence, or more than 3 deviations from the mean."""
    if method == "iqr":
        lines = exact_quantiles(df, columns, (0.25, 0.75), durable=durable)
        bounds = {c: (a - 1.5 * (b - a), b + 1.5 * (b - a)) for c, (a, b) in lines.items() if a is not None}
    else:
        bounds = {}
        for part in chunks(list(columns), 100):
            row = df.agg(*[e for c in part for e in (F.avg(_num(c)).alias(f"{c}__m"), F.stddev_samp(_num(c)).alias(f"{c}__s"))]).first()
            for c in part:
                m, s = row[f"{c}__m"], row[f"{c}__s"]
                if m is not None and s is not None:
                    bounds[c] = (m - 3 * s, m + 3 * s)
    parts = []
    for part in chunks(list(columns)):
        flag = lambda c: (
            F.when(_num(c) < bounds[c][0], 1.0).when(_num(c) > bounds[c][1], 1.0).otherwise(0.0) if c in bounds else F.lit(0.0)
        )
        parts.append(stats_to_rows(df.agg(*[F.avg(flag(c)).alias(c) for c in part]), part, {"ratio": F.col}))
    return _concat(parts)


def mutual_information(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Mutual information with the target in nats; NULL is the level ``MISSING``. One shuffle."""
    cells = (
        unpivot(df, columns, [F.col(target).alias("y")], "string", value="category").filter("y IS NOT NULL")
        .groupBy("feature", F.coalesce("category", F.lit("MISSING")).alias("category"), "y")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    # sum n log n over the joint, the categories and the classes: no join of the tables
    part = lambda keys: (
        cells.groupBy("feature", *keys).agg(F.sum("n").alias("n")).groupBy("feature")
        .agg(F.sum(F.col("n") * F.log("n")).alias("s"), F.sum("n").alias("t"))
    )
    joint, rows, classes = part(["category", "y"]), part(["category"]), part(["y"])
    tables = (
        joint.select("feature", "t", F.col("s").alias("xy")).join(rows.select("feature", F.col("s").alias("x")), "feature")
        .join(classes.select("feature", F.col("s").alias("y")), "feature")
    )
    t = F.col("t")
    return tables.select("feature", F.greatest((F.col("xy") - F.col("x") - F.col("y")) / t + F.log(t), F.lit(0.0)).alias("mi"))


def filled_target_corr(df: DataFrame, columns: Sequence[str], target: str, durable: bool = True) -> DataFrame:
    """|Pearson| of the median-filled column with the target."""
    medians = exact_quantiles(df, columns, (0.5,), durable=durable)
    parts = []
    for part in chunks(list(columns), 60):
        wide = df.agg(*[
            F.abs(safe_corr(F.coalesce(_num(c), F.lit(medians[c][0])), _num(target))).alias(c) for c in part
        ])
        parts.append(stats_to_rows(wide, part, {"r": F.col}))
    return _concat(parts)


def zero_filled_corr(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """|Pearson| of every pair of columns, NULL read as 0."""
    filled = df.select(*[F.coalesce(_num(c), F.lit(0.0)).alias(c) for c in columns])
    return pairwise_corr(filled, list(combinations(columns, 2))).select("feature_a", "feature_b", F.abs("r").alias("r"))


def drop_correlated(
    columns: Sequence[str], corr: dict[tuple[str, str], float | None], relevance: dict[str, float | None], limit: float
) -> dict[str, str]:
    """Sequential choice over the k x k matrix: of each pair above the limit drop the one less
    related to the target, the later one on a tie; a dropped column settles no further pair."""
    gone: dict[str, str] = {}
    for j, later in enumerate(columns):
        for earlier in columns[:j]:
            r = corr.get((earlier, later))
            if r is None or r <= limit or later in gone or earlier in gone:
                continue
            a, b = relevance.get(later) or 0.0, relevance.get(earlier) or 0.0
            loser, winner = (later, earlier) if a <= b else (earlier, later)
            gone[loser] = winner
    return gone


# ---------------------------------------------------------------- the selector


@dataclass
class SelectorModel:
    kept: list[str]
    dropped: dict[str, str]
    passthrough: list[str]
    pca: PipelineModel | None = None
    pca_inputs: list[str] = field(default_factory=list)
    components: int = 0
    pca_signs: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        extra = [c for c in self.passthrough if c in df.columns]
        if self.pca is None:
            return df.select(*extra, *self.kept)
        rows = self.pca.transform(df.withColumns({c: F.coalesce(_num(c), F.lit(0.0)) for c in self.pca_inputs}))
        cells = vector_to_array("_pc")
        rest = [c for c in self.kept if c not in self.pca_inputs]
        return rows.select(*extra, *rest, *[(cells[i] * self.pca_signs[i]).alias(f"PC_{i + 1:03d}") for i in range(self.components)])

    def report(self, df: DataFrame) -> DataFrame:
        """Per feature: dtype, missing and unique ratios, selected or not, and why."""
        columns = [*self.kept, *self.dropped]
        reasons = df.sparkSession.createDataFrame(
            [(c, int(c not in self.dropped), self.dropped.get(c)) for c in columns], "feature string, selected int, reason string"
        )
        profile = feature_profile(df, columns).select("feature", "dtype", "na_ratio", "nunique", "unique_ratio")
        return profile.join(reasons, "feature")


@dataclass
class SmartFeatureSelector:
    """Missing, duplicate, variance, outlier, relevance, collinearity, then optional PCA."""

    missing_thresh: float = 0.3
    duplicate: bool = True
    near_zero_var_thresh: float = 0.01
    outlier_method: str = "iqr"
    outlier_thresh: float = 0.5
    correlation_thresh: float = 0.95
    target_correlation_min: float = 0.02
    pca_components: int | None = None
    pca_variance: float = 0.95

    def fit(self, train: DataFrame, roles: ColumnRoles, keep_cached: bool = False) -> SelectorModel:
        """The steps scan the table about ten times, so it is cached meanwhile (memory, then
        disk) unless the caller already did, or stored it."""
        if keep_cached:
            return self._fit(train, roles)
        held = train.persist()
        try:
            return self._fit(held, roles)
        finally:
            held.unpersist()

    def _fit(self, train: DataFrame, roles: ColumnRoles) -> SelectorModel:
        numeric = numeric_columns(train, roles.reserved)
        categorical = categorical_columns(train, roles.reserved)
        order = [c for c in train.columns if c in numeric or c in categorical]
        dropped: dict[str, str] = {}
        left = lambda names: [c for c in names if c not in dropped]

        for c, ratio in _collect(missing_ratios(train, order), "feature", "ratio").items():
            if ratio > self.missing_thresh:
                dropped[c] = f"missing: {ratio:.2f}"
        if self.duplicate and left(order):
            for c, kept in _collect(duplicate_columns(train, left(order)), "feature", "kept").items():
                dropped[c] = f"duplicate of {kept}"
        if left(numeric):
            for c, v in _collect(scaled_variances(train, left(numeric)), "feature", "variance").items():
                if v is None or v <= self.near_zero_var_thresh:
                    dropped[c] = "near-zero variance"
        if left(numeric):
            for c, r in _collect(outlier_ratios(train, left(numeric), self.outlier_method, durable=False), "feature", "ratio").items():
                if r > self.outlier_thresh:
                    dropped[c] = f"outliers: {r:.2f}"
        relevance: dict[str, float] = {}
        if roles.target:
            if left(categorical):
                for c, mi in _collect(mutual_information(train, left(categorical), roles.target), "feature", "mi").items():
                    if mi < self.target_correlation_min:
                        dropped[c] = f"low mutual information: {mi:.4f}"
            if left(numeric):
                relevance = _collect(filled_target_corr(train, left(numeric), roles.target, durable=False), "feature", "r")
                for c, r in relevance.items():
                    if r is not None and r < self.target_correlation_min:
                        dropped[c] = f"low target correlation: {r:.4f}"
            names = left(numeric)
            if len(names) > 1:
                corr = {(r["feature_a"], r["feature_b"]): r["r"] for r in zero_filled_corr(train, names).collect()}
                for c, winner in drop_correlated(names, corr, relevance, self.correlation_thresh).items():
                    dropped[c] = f"correlated with {winner}"
        passthrough = [c for c in roles.reserved if c in train.columns]
        model = SelectorModel(left(order), dropped, passthrough)
        if self.pca_components is not None and left(numeric):
            self._fit_pca(train, left(numeric), model)
        return model

    def _fit_pca(self, train: DataFrame, numeric: list[str], model: SelectorModel) -> None:
        """Components of the columns, missing cells as 0: ``pca_components`` of them, or as many as explain ``pca_variance`` when it is <= 0."""
        n = len(numeric) if self.pca_components <= 0 else min(self.pca_components, len(numeric))
        data = train.withColumns({c: F.coalesce(_num(c), F.lit(0.0)) for c in numeric})
        stages = [
            VectorAssembler(inputCols=numeric, outputCol="_x"),
            StandardScaler(withMean=True, withStd=False, inputCol="_x", outputCol="_centred"),
            PCA(k=n, inputCol="_centred", outputCol="_pc"),
        ]
        model.pca, model.pca_inputs = Pipeline(stages=stages).fit(data), numeric
        # the sign of a component is open: its largest weight (the first of equal ones) counts as positive
        weights = model.pca.stages[-1].pc.toArray()
        model.pca_signs = [1.0 if w[np.argmax(np.abs(w))] >= 0 else -1.0 for w in weights.T]
        if self.pca_components <= 0:
            total, k = 0.0, 0
            for share in model.pca.stages[-1].explainedVariance.toArray():
                total, k = total + share, k + 1
                if total >= self.pca_variance:
                    break
            n = k
        model.components = n


def stable_subset(importances: DataFrame, top_k: int = 60, threshold: float = 0.6) -> DataFrame:
    """``(feature, fold, importance)`` -> best ``top_k`` by mean with enough positive folds.

    A feature that is absent from a fold counts as 0 there.
    """
    folds = importances.agg(F.count_distinct("fold").alias("folds")).scalar()
    table = importances.groupBy("feature").agg(
        (F.sum("importance") / folds).alias("mean_importance"), (F.count_if(F.col("importance") > 0) / folds).alias("positive_share")
    )
    return table.orderBy(F.desc("mean_importance"), "feature").limit(top_k).filter(F.col("positive_share") >= threshold)


def quality_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """How many columns are over 10 % NULL, near constant, or highly correlated with an earlier one."""
    missing = _collect(missing_ratios(df, columns), "feature", "ratio")
    numeric = [c for c in numeric_columns(df) if c in set(columns)]
    wide = df.agg(*[F.var_pop(_num(c)).alias(c) for c in numeric]).first()
    pairs = pairwise_corr(df, list(combinations(numeric, 2))).filter(F.abs("r") > 0.8)
    return {
        "high_null": sum(r > 0.1 for r in missing.values()),
        "low_variance": sum((wide[c] or 0.0) <= 0.01 for c in numeric),
        "high_correlation": pairs.select("feature_b").distinct().count(),
    }


def split_by_type(selected: DataFrame, df: DataFrame, top_k: int) -> dict[str, list[str]]:
    """The best ``top_k`` features as numeric and categorical lists."""
    names = [r[0] for r in selected.orderBy(F.desc("importance"), "feature").limit(top_k).select("feature").collect()]
    numeric = set(numeric_columns(df))
    return {"num_cols": [c for c in names if c in numeric], "cat_cols": [c for c in names if c not in numeric]}


def rank_within(df: DataFrame, group: str, by: str, item: str) -> DataFrame:
    """1-based rank per group; one row per (group, item)."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(by), item)))
