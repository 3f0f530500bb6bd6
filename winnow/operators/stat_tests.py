"""Statistical tests: one long aggregate per family, finished on one row per feature."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.dist import p_chi2, p_f, p_norm, p_t
from winnow.operators.kernels import (
    chunks, contingency, moments_by_group, order_edges, pairwise_corr, pieces_for, point_gap_bucket,
    prefix_sums, safe_corr, stats_to_rows,
)
from winnow.session import scratch_path, stored

ALPHA = 0.05
MEET_ROWS = 250_000  # rows one task brings together by id
STRIPE_ROWS = 20_000  # points one numpy call counts, beyond which the plane is cut further


def _flag(p: Column) -> Column:
    return (p < ALPHA).alias("significant")


def significant(result: DataFrame) -> DataFrame:
    return result.filter("significant")


# ---------------------------------------------------------------- categorical


def chi_square(df: DataFrame, categories: Sequence[str], target: str) -> DataFrame:
    """Independence of each categorical column and the target; Yates' correction at one degree.

    Cells with no rows need no materialising: chi2 = N (sum O^2/(R C) - 1), and in a
    2x2 table all four deviations have the same size.
    """
    cells = contingency(df, categories, target)
    rows = cells.groupBy("feature", "category").agg(F.sum("n").alias("r"))
    cols = cells.groupBy("feature", "y").agg(F.sum("n").alias("c"))
    inv_r = rows.groupBy("feature").agg(
        F.count(F.lit(1)).alias("kr"), F.sum(1.0 / F.col("r")).alias("ir"), F.sum("r").alias("total")
    )
    inv_c = cols.groupBy("feature").agg(F.count(F.lit(1)).alias("kc"), F.sum(1.0 / F.col("c")).alias("ic"))
    n, o, r, c = (F.col(x).cast("double") for x in ("total", "n", "r", "c"))
    gap = F.abs(o - r * c / n)
    folded = (
        cells.join(rows, ["feature", "category"]).join(cols, ["feature", "y"]).join(inv_r, "feature")
        .groupBy("feature").agg(F.sum(o * o / (r * c)).alias("q"), F.max(gap).alias("gap"))
    )
    plain = F.greatest(F.col("total") * (F.col("q") - 1.0), F.lit(0.0))
    less = F.col("gap") - F.least(F.col("gap"), F.lit(0.5))
    yates = less * less * F.col("total") * F.col("ir") * F.col("ic")
    dof = (F.col("kr") - 1) * (F.col("kc") - 1)
    out = folded.join(inv_r, "feature").join(inv_c, "feature").filter(dof > 0).select(
        "feature", F.when(dof == 1, yates).otherwise(plain).alias("chi2"), dof.alias("dof"), F.col("total").alias("n"),
    )
    return out.withColumn("p_value", p_chi2("chi2", F.col("dof").cast("double"))).select("*", _flag(F.col("p_value")))


def conversion_rates(df: DataFrame, categories: Sequence[str], target: str, min_rows: int = 30) -> DataFrame:
    """Per category: rate, rows, difference from overall, pooled two-proportion z against overall.

    Categories below ``min_rows`` are listed without a test.
    """
    cells = contingency(df, categories, target)
    table = cells.groupBy("feature", "category").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("x")
    )
    totals = table.groupBy("feature").agg(F.sum("n").alias("nn"), F.sum("x").alias("xx"))
    n, x, nn, xx = (F.col(c).cast("double") for c in ("n", "x", "nn", "xx"))
    pooled = (x + xx) / (n + nn)
    error = F.sqrt(pooled * (1.0 - pooled) * (1.0 / n + 1.0 / nn))
    diff = x / n - xx / nn
    out = table.join(totals, "feature").select(
        "feature", "category", F.col("n"), F.col("x").alias("converted"), (x / n).alias("rate"),
        (xx / nn).alias("overall_rate"), diff.alias("diff"),
        F.when(F.col("n") >= min_rows, diff / F.nullif(error, F.lit(0.0))).alias("z"),
    )
    return out.withColumn("p_value", p_norm("z")).select("*", _flag(F.col("p_value")))


# ---------------------------------------------------------------- means


def t_test(df: DataFrame, numeric: Sequence[str], group: str, equal_var: bool = False) -> DataFrame:
    """Two-group t test per numeric column; columns without exactly two usable groups give no row."""
    stats = moments_by_group(df, numeric, group)
    first = lambda c: F.min_by(c, "grp")
    last = lambda c: F.max_by(c, "grp")
    two = stats.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"), F.min("n").alias("least"),
        F.min("grp").alias("group_a"), F.max("grp").alias("group_b"),
        first("n").alias("n_a"), last("n").alias("n_b"), first("mean").alias("mean_a"), last("mean").alias("mean_b"),
        first("var").alias("var_a"), last("var").alias("var_b"),
    ).filter("k = 2 AND least >= 2")
    na, nb, va, vb = (F.col(c).cast("double") for c in ("n_a", "n_b", "var_a", "var_b"))
    if equal_var:
        dof = na + nb - 2.0
        square = ((na - 1.0) * va + (nb - 1.0) * vb) / dof * (1.0 / na + 1.0 / nb)
    else:
        square = va / na + vb / nb
        dof = square * square / F.nullif(
            (va / na) * (va / na) / (na - 1.0) + (vb / nb) * (vb / nb) / (nb - 1.0), F.lit(0.0)
        )
    out = two.select(
        "feature", "group_a", "group_b", "n_a", "n_b", "mean_a", "mean_b",
        ((F.col("mean_a") - F.col("mean_b")) / F.nullif(F.sqrt(square), F.lit(0.0))).alias("t"), dof.alias("dof"),
    )
    return out.withColumn("p_value", p_t("t", "dof")).select("*", _flag(F.col("p_value")))


def anova(df: DataFrame, numeric: Sequence[str], group: str) -> DataFrame:
    """One-way F test per numeric column from group moments."""
    stats = moments_by_group(df, numeric, group)
    means = stats.groupBy("feature").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"))
    d = F.col("mean") - F.col("grand")
    folded = stats.join(means, "feature").groupBy("feature").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"), F.sum(F.col("n") * d * d).alias("between"),
        F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("within"),
    ).filter("groups >= 2 AND n > groups")
    d1, d2 = (F.col("groups") - 1).cast("double"), (F.col("n") - F.col("groups")).cast("double")
    out = folded.select(
        "feature", "groups", "n", ((F.col("between") / d1) / F.nullif(F.col("within") / d2, F.lit(0.0))).alias("f"),
        d1.alias("df_between"), d2.alias("df_within"),
    )
    return out.withColumn("p_value", p_f("f", "df_between", "df_within")).select("*", _flag(F.col("p_value")))


def group_count(df: DataFrame, group: str, limit: int = 100) -> int:
    """Distinct non-null groups, counted up to ``limit``."""
    return df.select(group).filter(F.col(group).isNotNull()).distinct().limit(limit).count()


def compare_means(df: DataFrame, numeric: Sequence[str], group: str, equal_var: bool = False) -> DataFrame:
    """t test for two groups, ANOVA beyond, in one layout ``(test, feature, statistic, …)``."""
    if group_count(df, group) <= 2:
        return t_test(df, numeric, group, equal_var).select(
            F.lit("ttest").alias("test"), "feature", F.col("t").alias("statistic"), F.lit(1.0).alias("df1"),
            F.col("dof").alias("df2"), "p_value", "significant",
        )
    return anova(df, numeric, group).select(
        F.lit("anova").alias("test"), "feature", F.col("f").alias("statistic"), F.col("df_between").alias("df1"),
        F.col("df_within").alias("df2"), "p_value", "significant",
    )


def choose_groups(df: DataFrame, categorical: Sequence[str], target: str) -> dict[str, str | None]:
    """t test: the target if it has at most two values, else the first binary categorical
    column; ANOVA: the first categorical column with 3 to 10 values."""
    columns = [target, *categorical]
    row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    binary = [c for c in categorical if row[c] == 2]
    several = [c for c in categorical if 3 <= row[c] <= 10]
    return {
        "ttest": target if row[target] <= 2 else (binary[0] if binary else None),
        "anova": several[0] if several else None,
    }


# ---------------------------------------------------------------- correlation


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return pairwise_corr(df, list(combinations(columns, 2)))


def _null_masks(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Column -> representative of the columns NULL on the same rows; None without NULLs."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    nullable = [c for c in columns if row[c]]
    same: set[tuple[str, str]] = set()
    for part in chunks(list(combinations(nullable, 2))):
        got = df.agg(*[
            F.count_if(F.col(a).isNull() != F.col(b).isNull()).alias(f"d{i}") for i, (a, b) in enumerate(part)
        ]).first()
        same |= {p for i, p in enumerate(part) if got[i] == 0}
    masks: dict[str, str | None] = dict.fromkeys(columns)
    for c in nullable:
        masks[c] = next((a for a in nullable if (a, c) in same), c)
    return masks


def average_ranks(long: DataFrame, keys: Sequence[str], value: str, task_rows: int | None = None) -> DataFrame:
    """(keys, value, rank): mean rank of every distinct value, from its histogram."""
    hist = long.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    before = prefix_sums(hist, keys, value, {"_before": F.col("_n")}, task_rows=task_rows, durable=True)
    return before.select(*keys, value, (F.col("_before") + (F.col("_n") + 1) / 2.0).alias("rank"))


def spearman(df: DataFrame, columns: Sequence[str], row_id: str, task_rows: int | None = None) -> DataFrame:
    """Pearson on average ranks, each pair ranked over the rows where both are present.

    A column is ranked once per distinct NULL pattern of its partners. The columns are stored once; each ranking is a
    table of distinct values that Spark joins as its size asks for. Rows of one id count once; they meet in parts of
    at most about ``MEET_ROWS`` rows, so no task's memory grows with the table.
    """
    data = stored(df.select(F.col(row_id).alias("_id"), *[F.col(c).cast("double").alias(c) for c in dict.fromkeys(columns)]), "spearman")
    masks = _null_masks(data, columns)
    pairs = list(combinations(columns, 2))
    variants: dict[tuple[str, str | None], int] = {}

    def variant(c: str, other: str) -> int:
        mask = masks[other] if masks[other] != masks[c] else None
        return variants.setdefault((c, mask), len(variants))

    sides = [(variant(a, b), variant(b, a)) for a, b in pairs]
    value = {i: F.col(c) if m is None else F.when(F.col(m).isNotNull(), F.col(c)) for (c, m), i in variants.items()}
    cells = F.array(*[F.struct(F.lit(i).alias("v"), x.alias("x")) for i, x in value.items()])
    path = scratch_path(df.sparkSession, "ranks")
    average_ranks(data.select(F.inline(cells)).filter("x IS NOT NULL"), ["v"], "x", task_rows).write.partitionBy("v").parquet(path)
    # a folder of its own for each ranking, so that its size is known when the join is planned
    ranked = {r["v"] for r in df.sparkSession.read.schema("x double, rank double, v int").parquet(path).select("v").distinct().collect()}
    wide = data
    for i, x in value.items():
        if i in ranked:
            ranks = df.sparkSession.read.schema("x double, rank double").parquet(f"{path}/v={i}").select(F.col("x").alias(f"x{i}"), F.col("rank").alias(f"r{i}"))
            wide = wide.withColumn(f"y{i}", x).join(ranks, F.col(f"y{i}") == F.col(f"x{i}"), "left").drop(f"x{i}", f"y{i}")
        else:
            wide = wide.withColumn(f"r{i}", F.lit(None).cast("double"))
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), pieces_for(data.count(), MEET_ROWS))
    wide = wide.select("_id", *[f"r{i}" for i in value]).repartition(parts, "_id").groupBy("_id").agg(*[F.max(f"r{i}").alias(f"r{i}") for i in value])
    named = pairwise_corr(wide, [(f"r{i}", f"r{j}") for i, j in sides])
    lookup = F.create_map(*[F.lit(x) for (i, j), (a, b) in zip(sides, pairs) for x in (f"r{i}|r{j}", f"{a}|{b}")])
    names = F.split(F.element_at(lookup, F.concat_ws("|", "feature_a", "feature_b")), r"\|")
    return named.select(names[0].alias("feature_a"), names[1].alias("feature_b"), "r")


def _dominated(y: np.ndarray, w: np.ndarray) -> int:
    """Sum over points, in array order, of w times the weight of earlier points with smaller y."""
    y = np.unique(y, return_inverse=True)[1].astype(np.int64)
    w = w.astype(np.int64)
    total = 0
    for b in range(int(y.max()).bit_length() - 1, -1, -1):
        # points are grouped by the bits above b; in each group ones see the zeros before them
        order = np.argsort(y >> (b + 1), kind="stable")
        yo, wo = y[order], w[order]
        one, group = (yo >> b) & 1, yo >> (b + 1)
        zeros = np.where(one == 0, wo, 0)
        upto = np.cumsum(zeros) - zeros
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        base = np.repeat(upto[starts], np.diff(np.r_[starts, len(group)]))
        hit = one == 1
        total += int(np.dot(wo[hit].astype(object), (upto - base)[hit].astype(object))) if hit.any() else 0
    return total


def _stripe_count(pdf: pd.DataFrame) -> pd.DataFrame:
    # among equal x the larger y comes first, so that only strictly smaller x count
    pdf = pdf.sort_values(["x", "y"], ascending=[True, False])
    return pd.DataFrame({"c": [Decimal(_dominated(pdf["y"].to_numpy(), pdf["w"].to_numpy()))]})


def _stripes(points: DataFrame, stripe: str) -> int:
    """Concordant weight inside each stripe; a stripe is bounded by its bucket."""
    parts = points.groupBy(stripe).applyInPandas(_stripe_count, "c decimal(38,0)")
    return int(parts.agg(F.sum("c")).first()[0] or 0)


def concordant(points: DataFrame, task_rows: int | None = None) -> int:
    """Weight of pairs of points with both coordinates strictly smaller, ``points(x, y, w)``.

    The plane is cut into value buckets on both axes. A pair lies in one x bucket, or in
    one y bucket across x buckets, or in two cells apart on both axes; the first two are
    counted stripe by stripe, the last by the same count over the cell table. Buckets
    holding one value contribute nothing on their own axis and are left out there, so
    ties never fill a stripe. No pair is ever written out.
    """
    task_rows = task_rows or STRIPE_ROWS
    n = points.count()
    if n <= task_rows:
        return _stripes(points.withColumn("s", F.lit(0)), "s") if n else 0
    # at most a quarter as many cells as points, so that the recursion shrinks
    pieces = max(2, min(pieces_for(n, task_rows), int(n**0.5) // 4))
    ex, ey = order_edges(points, pieces, "x", "y")
    cut = point_gap_bucket(point_gap_bucket(points, "x", ex, "bx"), "y", ey, "by")
    same_x = _stripes(cut.filter("bx % 2 = 0").select("bx", "x", "y", "w"), "bx")
    across = cut.filter("by % 2 = 0").groupBy("by", F.col("bx").alias("x"), "y").agg(F.sum("w").alias("w"))
    same_y = _stripes(across, "by")
    cells = cut.groupBy(F.col("bx").cast("double").alias("x"), F.col("by").cast("double").alias("y")).agg(
        F.sum("w").alias("w")
    )
    return same_x + same_y + concordant(cells, task_rows)


def kendall_pair(df: DataFrame, a: str, b: str, task_rows: int | None = None) -> float | None:
    """tau-b over all rows where both are present, ties weighted."""
    points = stored(
        df.select(F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
        .filter("x IS NOT NULL AND y IS NOT NULL").groupBy("x", "y").agg(F.count(F.lit(1)).alias("w")), "points"
    )
    pairs = F.col("w").cast("decimal(38,0)") * (F.col("w") - 1)
    whole = points.agg(F.sum("w").alias("n"), F.sum(pairs).alias("t")).first()
    along = lambda c: int(points.groupBy(c).agg(F.sum("w").alias("w")).agg(F.sum(pairs)).first()[0] or 0) // 2
    n, txy = whole["n"] or 0, int(whole["t"] or 0) // 2
    tx, ty = along("x"), along("y")
    all_pairs = n * (n - 1) // 2
    if all_pairs in (tx, ty):
        return None
    c = concordant(points, task_rows)
    d = all_pairs - tx - ty + txy - c
    return (c - d) / (float(all_pairs - tx) ** 0.5 * float(all_pairs - ty) ** 0.5)


def kendall(df: DataFrame, columns: Sequence[str], task_rows: int | None = None) -> DataFrame:
    """Pairs are independent chains of jobs, so a few run side by side, over columns that are stored once."""
    df = stored(df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys(columns)]), "kendall")
    pairs = list(combinations(columns, 2))
    with ThreadPoolExecutor(4) as pool:
        values = list(pool.map(lambda p: kendall_pair(df, *p, task_rows), pairs))
    rows = [(a, b, v) for (a, b), v in zip(pairs, values)]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, r double")


def correlation_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson", row_id: str | None = None) -> DataFrame:
    if method == "pearson":
        return pearson(df, columns)
    if method == "spearman":
        return spearman(df, columns, row_id)
    if method == "kendall":
        return kendall(df, columns)
    raise ValueError(f"unknown correlation method {method}")


def high_corr_pairs(corr: DataFrame, min_corr: float = 0.05) -> DataFrame:
    return corr.filter(F.abs("r") >= min_corr).orderBy(F.desc(F.abs("r")), "feature_a", "feature_b")


def target_correlations(df: DataFrame, columns: Sequence[str], target: str, min_corr: float = 0.05) -> DataFrame:
    parts = []
    for part in chunks(list(columns), 60):
        wide = df.agg(*[safe_corr(F.col(c), F.col(target)).alias(c) for c in part])
        parts.append(stats_to_rows(wide, part, {"r": F.col}))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.filter(F.abs("r") >= min_corr).orderBy(F.desc(F.abs("r")), "feature")




def top_target_matrix(df: DataFrame, columns: Sequence[str], target: str, top: int = 30) -> DataFrame:
    """Pearson matrix of the ``top`` columns most correlated with the target."""
    best = [r["feature"] for r in target_correlations(df, columns, target, 0.0).limit(top).collect()]
    return pearson(df, best)
