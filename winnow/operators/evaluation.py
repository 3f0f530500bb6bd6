"""Ranking, calibration and lift metrics, exact on any number of rows.

Ranking metrics read the histogram of distinct scores with cumulated counts; it is
built by a map-side-combined aggregate, so equal scores never sit in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.scalar import SEGMENT_EDGES, SEGMENT_LABELS, assign_segment, right_closed_index
from winnow.operators.kernels import exact_quantiles, order_statistics, prefix_sums, row_positions, stats_to_rows


def score_curve(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), task_rows: int | None = None) -> DataFrame:
    """Per distinct score: pos, neg, tp / fp counted at ``score >= threshold``, and the key's
    positives and negatives ``p`` / ``n``."""
    keys = list(keys)
    hist = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*keys, F.col(score).alias("threshold"))
        .agg(F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg"))
        .withColumn("_down", -F.col("threshold"))
    )
    above = prefix_sums(
        hist, keys, "_down", {"_p": F.col("pos"), "_n": F.col("neg")}, task_rows=task_rows, durable=True, totals=True
    )
    return above.select(
        *keys, "threshold", "pos", "neg", (F.col("_p") + F.col("pos")).alias("tp"), (F.col("_n") + F.col("neg")).alias("fp"),
        F.col("_p_total").alias("p"), F.col("_n_total").alias("n"),
    )


def auc_of(pos: str = "pos", neg: str = "neg", tp: str = "tp") -> Column:
    """Ties count half; one class only -> NULL."""
    wins = F.sum(F.col(neg) * (F.col(tp) - F.col(pos) / 2.0))
    return wins / F.nullif(F.sum(pos).cast("double") * F.sum(neg), F.lit(0.0))


def average_precision_of() -> Column:
    """Sum of recall steps times precision."""
    return F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))) / F.nullif(F.sum("pos").cast("double"), F.lit(0.0))


def auc(df: DataFrame, score: str, label: str, **kw) -> DataFrame:
    return score_curve(df, score, label, **kw).agg(auc_of().alias("auc"))


def average_precision(df: DataFrame, score: str, label: str, **kw) -> DataFrame:
    return score_curve(df, score, label, **kw).agg(average_precision_of().alias("average_precision"))


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.nullif(F.col(whole).cast("double"), F.lit(0.0))


def roc_points(df: DataFrame, score: str, label: str, **kw) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score."""
    curve = score_curve(df, score, label, **kw)
    return curve.select("threshold", _share("fp", "n").alias("fpr"), _share("tp", "p").alias("tpr"))


def pr_points(df: DataFrame, score: str, label: str, **kw) -> DataFrame:
    """(threshold, precision, recall) per distinct score."""
    curve = score_curve(df, score, label, **kw)
    return curve.select(
        "threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), _share("tp", "p").alias("recall")
    )


def ks_of() -> Column:
    return F.max(F.abs(_share("tp", "p") - _share("fp", "n")))


def ks(df: DataFrame, score: str, label: str, **kw) -> DataFrame:
    return score_curve(df, score, label, **kw).agg(ks_of().alias("ks"))


def brier_of(score: str, label: str) -> Column:
    gap = F.col(label) - F.col(score)
    return F.avg(gap * gap)


def brier(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.agg(brier_of(score, label).alias("brier"))


def ece_from_bins(df: DataFrame, index: Column, score: str, label: str) -> DataFrame:
    bins = (
        df.select(index.alias("bin"), F.col(score).alias("p"), F.col(label).alias("y")).filter("bin IS NOT NULL")
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("p"), F.avg("y").alias("y"))
    )
    return bins.agg((F.sum(F.col("n") * F.abs(F.col("p") - F.col("y"))) / F.sum("n")).alias("ece"))


def ece_edges(df: DataFrame, score: str, label: str, edges: Sequence[float] = SEGMENT_EDGES) -> DataFrame:
    return ece_from_bins(df, right_closed_index(F.col(score), edges), score, label)


def ece_quantile(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Quantile bins; equal edges collapse."""
    line = exact_quantiles(df, [score], [i / bins for i in range(bins + 1)])[score]
    edges = sorted(set(line))
    index = right_closed_index(F.col(score), edges) if len(edges) > 1 else F.lit(0)
    return ece_from_bins(df, index, score, label)


# ---------------------------------------------------------------- lift


def top_cuts(df: DataFrame, score: str, row_id: str, tops: Sequence[int], n: int) -> list[Column]:
    """For each ``top`` a predicate true on exactly the ``top`` best rows, ties by smallest id.

    The cut score is an exact order statistic. The id that ends the tied rows is found by their positions in the id's
    own order, so ids of any type do; rows without an id come first and together.
    """
    inside = sorted({t for t in tops if 0 < t <= n})
    if not inside:
        return [F.lit(t > n) if t > 0 else F.lit(False) for t in tops]
    values = order_statistics(df, {score: lambda _: [n - t for t in inside]})[score][1]
    cut = {t: values[n - t] for t in inside}
    above = df.agg(*[F.count_if(F.col(score) > s).alias(f"c{t}") for t, s in cut.items()]).first()
    tied = df.select(F.col(row_id).alias("id"), F.explode(F.filter(F.array(*[
        F.struct(F.lit(t).alias("t"), F.lit(t - above[f"c{t}"] - 1).alias("k"), (F.col(score) == s).alias("here")) for t, s in cut.items()
    ]), lambda x: x["here"])).alias("x")).select("id", "x.t", "x.k")
    placed = row_positions(tied, "id", "id", ["t"])
    last = {r["t"]: r["id"] for r in placed.filter(F.col("pos") == F.col("k")).select("t", "id").collect()}
    out = []
    for t in tops:
        if t <= 0 or t > n:
            out.append(F.lit(t > n))
            continue
        first = F.col(row_id).isNull()
        upto = first if last[t] is None else first | (F.col(row_id) <= F.lit(last[t]))
        out.append((F.col(score) > cut[t]) | ((F.col(score) == cut[t]) & upto))
    return out


def lift_table_at(df: DataFrame, score: str, label: str, row_id: str, tops: Sequence[int], n: int) -> DataFrame:
    """(top_n, lift) for each of ``tops``, in one aggregate."""
    flags = top_cuts(df, score, row_id, tops, n)
    y = F.col(label).cast("double")
    wide = df.agg(F.avg(y).alias("base"), *[F.avg(F.when(f, y)).alias(f"r{i}") for i, f in enumerate(flags)])
    names = [str(i) for i in range(len(tops))]
    return stats_to_rows(wide, names, {
        "top_n": lambda i: F.lit(int(tops[int(i)])).cast("long"),
        "lift": lambda i: F.col(f"r{i}") / F.nullif(F.col("base"), F.lit(0.0)),
    }, name="slot")


def lift_at_k(df: DataFrame, score: str, label: str, row_id: str, k: float | int = 0.1) -> DataFrame:
    """``k``: a share of the rows (float) or a number of rows (int)."""
    scored = df.filter(F.col(score).isNotNull())
    n = scored.count()
    top = math.floor(k * n) if isinstance(k, float) else int(k)
    return lift_table_at(scored, score, label, row_id, [top], n).select("top_n", "lift")


def decile_lift(df: DataFrame, score: str, label: str, row_id: str) -> DataFrame:
    scored = df.filter(F.col(score).isNotNull())
    n = scored.count()
    table = lift_table_at(scored, score, label, row_id, [n * i // 10 for i in range(1, 11)], n)
    return table.select((F.col("slot").cast("int") + 1).alias("decile"), "top_n", "lift")


def lift_table(df: DataFrame, segment: str, label: str) -> DataFrame:
    """Rows, rate, lift over the base rate and share of all rows per segment."""
    seg = df.filter(F.col(segment).isNotNull() & F.col(label).isNotNull())
    counts = seg.groupBy(segment).agg(F.count(F.lit(1)).alias("count"), F.sum(F.col(label).cast("double")).alias("_y"))
    # both totals in one subquery: it reads the same exchange as the table itself
    whole = counts.agg(F.struct(F.sum("count").alias("n"), F.sum("_y").alias("y"))).scalar()
    rate = F.col("_y") / F.col("count")
    return counts.select(
        segment, "count", rate.alias("conv_rate"), (rate / F.nullif(whole["y"] / whole["n"], F.lit(0.0))).alias("lift"),
        (100.0 * F.col("count") / whole["n"]).alias("pct_total"),
    )


# ---------------------------------------------------------------- thresholds


def _confusion(score: str, label: str, threshold: float) -> dict[str, Column]:
    hit, y = F.col(score) >= threshold, F.col(label) == 1
    return {"tp": F.count_if(hit & y), "fp": F.count_if(hit & ~y), "fn": F.count_if(~hit & y), "tn": F.count_if(~hit & ~y)}


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    ratio = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn),
        "specificity": ratio(tn, tn + fp), "f1": ratio(2.0 * tp, 2.0 * tp + fp + fn),
    }


def threshold_sweep(df: DataFrame, score: str, label: str, thresholds: Sequence[float]) -> DataFrame:
    """Confusion counts and rates at each threshold, one scan."""
    names = [str(i) for i in range(len(thresholds))]
    wide = df.agg(*[
        e.alias(f"{k}{i}") for i, t in enumerate(thresholds) for k, e in _confusion(score, label, t).items()
    ])
    cell = lambda k: (lambda i: F.col(f"{k}{i}"))
    counts = stats_to_rows(wide, names, {
        "threshold": lambda i: F.lit(float(thresholds[int(i)])), **{k: cell(k) for k in ("tp", "fp", "fn", "tn")},
    }, name="slot").drop("slot")
    rates = _rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    return counts.select("*", *[e.alias(k) for k, e in rates.items()])


def classification_metrics(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    return threshold_sweep(df, score, label, [threshold])


# ---------------------------------------------------------------- segments


def segment_metrics(df: DataFrame, score: str, label: str, segment: str, threshold: float = 0.5) -> DataFrame:
    """AUC, average precision, Brier, accuracy, mean score and rate — per segment and over all rows."""
    base = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull() & F.col(segment).isNotNull())
    both = base.select(score, label, F.inline(F.array(
        F.struct(F.col(segment).alias("segment")), F.struct(F.lit("ALL").alias("segment")),
    )))
    ranked = score_curve(both, score, label, ["segment"]).groupBy("segment").agg(
        auc_of().alias("auc"), average_precision_of().alias("average_precision")
    )
    right = (F.col(score) >= threshold) == (F.col(label) == 1)
    plain = both.groupBy("segment").agg(
        F.count(F.lit(1)).alias("count"), brier_of(score, label).alias("brier"),
        F.avg(right.cast("double")).alias("accuracy"), F.avg(score).alias("mean_score"), F.avg(label).alias("rate"),
    )
    return plain.join(ranked, "segment")


def evaluate_all(
    df: DataFrame, score: str, label: str, row_id: str, edges: Sequence[float] = SEGMENT_EDGES,
    labels: Sequence[str] = SEGMENT_LABELS, top: float = 0.1,
) -> DataFrame:
    """Long ``(metric, value)``: ranking, calibration, lift and per-segment rates."""
    curve = score_curve(df, score, label)
    seg = df.withColumn("_seg", assign_segment(F.col(score), edges, labels))
    ranked = curve.agg(auc_of().alias("roc_auc"), average_precision_of().alias("pr_auc"), ks_of().alias("ks"))
    single = [
        stats_to_rows(ranked, ["roc_auc", "pr_auc", "ks"], {"value": F.col}, name="metric"),
        brier(df, score, label).select(F.lit("brier").alias("metric"), F.col("brier").alias("value")),
        ece_edges(df, score, label, edges).select(F.lit("ece").alias("metric"), F.col("ece").alias("value")),
        lift_at_k(df, score, label, row_id, top).select(
            F.lit(f"lift_at_{round(top * 100)}").alias("metric"), F.col("lift").alias("value")),
        lift_table(seg, "_seg", label).select(F.inline(F.array(
            F.struct(F.concat(F.lit("lift_"), F.col("_seg")).alias("metric"), F.col("lift").alias("value")),
            F.struct(F.concat(F.lit("cr_"), F.col("_seg")).alias("metric"), F.col("conv_rate").alias("value")),
        ))),
    ]
    out = single[0]
    for more in single[1:]:
        out = out.unionByName(more)
    return out
