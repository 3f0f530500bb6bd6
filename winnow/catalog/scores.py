"""Evaluation, segments and calibration tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from winnow.catalog.registry import union_sql
from winnow.catalog.registry import cut_small, lead_query
from winnow.functions import scalar as S
from winnow.operators import calibration as C
from winnow.operators import evaluation as E
from winnow.sources.tables import leads

SCORED = ("lead_id", "score", "target")
CURVE = """h AS (SELECT score AS threshold, sum(target) AS pos, sum(1 - target) AS neg FROM leads GROUP BY 1),
curve AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp,
  sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM h)
"""
AUC = "sum(neg * (tp - pos / 2.0::DOUBLE)) / (any_value(p) * CAST(any_value(n) AS DOUBLE))"
AP = "sum(pos * (tp / CAST(tp + fp AS DOUBLE))) / any_value(p)"
SEG = "CASE WHEN score < 0.25 THEN 'Low' WHEN score < 0.75 THEN 'Medium' ELSE 'High' END"
BIN = "CASE WHEN score <= 0 OR score > 1 THEN NULL WHEN score <= 0.25 THEN 'Low' WHEN score <= 0.75 THEN 'Medium' ELSE 'High' END"


def scored(spark, path, *more):
    return leads(spark, path, *SCORED, *more)


@lead_query("auc", CURVE + f"SELECT round({AUC}, 6) AS auc FROM curve")
def auc(spark, path):
    return E.auc(scored(spark, path), "score", "target")


@lead_query("average_precision", CURVE + f"SELECT round({AP}, 6) AS average_precision FROM curve")
def average_precision(spark, path):
    return E.average_precision(scored(spark, path), "score", "target")


@lead_query("ks", CURVE + "SELECT round(max(abs(tp / CAST(p AS DOUBLE) - fp / CAST(n AS DOUBLE))), 6) AS ks FROM curve")
def ks(spark, path):
    return E.ks(scored(spark, path), "score", "target")


@lead_query("brier", "SELECT round(avg(pow(target - score, 2)), 6) AS brier FROM leads")
def brier(spark, path):
    return E.brier(scored(spark, path), "score", "target")


@lead_query("roc_points", CURVE + """
SELECT threshold, round(fp / CAST(n AS DOUBLE), 6) AS fpr, round(tp / CAST(p AS DOUBLE), 6) AS tpr FROM curve""")
def roc_points(spark, path):
    return E.roc_points(scored(spark, path), "score", "target")


@lead_query("pr_points", CURVE + """
SELECT threshold, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, round(tp / CAST(p AS DOUBLE), 6) AS recall FROM curve""")
def pr_points(spark, path):
    return E.pr_points(scored(spark, path), "score", "target")


def _ece_sql(bins: str) -> str:
    return f"""b AS (SELECT {bins} AS bin, count(*) AS n, avg(score) AS p, avg(target) AS y FROM leads GROUP BY 1)
SELECT round(sum(n * abs(p - y)) / sum(n), 6) AS ece FROM b"""


@lead_query("ece_edges", _ece_sql("CASE WHEN score <= 0.25 THEN 0 WHEN score <= 0.75 THEN 1 ELSE 2 END"))
def ece_edges(spark, path):
    return E.ece_edges(scored(spark, path), "score", "target")


@lead_query("ece_quantile", "e AS (SELECT " + ", ".join(f"quantile_cont(score, {i / 10}) AS e{i}" for i in range(1, 10)) + " FROM leads),\n"
    "b AS (SELECT CASE " + " ".join(f"WHEN score <= e{i} THEN {i}" for i in range(1, 10)) + " ELSE 10 END AS bin, count(*) AS n,"
    " avg(score) AS p, avg(target) AS y FROM leads, e GROUP BY 1)\nSELECT round(sum(n * abs(p - y)) / sum(n), 6) AS ece FROM b")
def ece_quantile(spark, path):
    return E.ece_quantile(scored(spark, path), "score", "target")


RANKED = """r AS (SELECT target, row_number() OVER (ORDER BY score DESC, lead_id) AS pos, count(*) OVER () AS n,
  avg(target) OVER () AS base FROM leads)"""


@lead_query("lift_at_k", f"""{RANKED}
SELECT any_value(CAST(n // 10 AS BIGINT)) AS top_n, round(avg(target) / any_value(base), 6) AS lift FROM r WHERE pos <= n // 10""")
def lift_at_k(spark, path):
    return E.lift_at_k(scored(spark, path), "score", "target", "lead_id", 0.1)


@lead_query("decile_lift", f"""{RANKED}
SELECT d AS decile, any_value(n * d // 10) AS top_n, round(avg(target) / any_value(base), 6) AS lift
FROM r, range(1, 11) AS t(d) WHERE pos <= n * d // 10 GROUP BY d""")
def decile_lift(spark, path):
    return E.decile_lift(scored(spark, path), "score", "target", "lead_id")


LIFT = f"""SELECT {SEG} AS segment, count(*) AS count, round(avg(target), 6) AS conv_rate,
  round(avg(target) / (SELECT avg(target) FROM leads), 6) AS lift,
  round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM leads), 6) AS pct_total FROM leads GROUP BY 1"""


@lead_query("lift_table", LIFT)
def lift_table(spark, path):
    df = scored(spark, path).withColumn("segment", S.assign_segment(F.col("score")))
    return E.lift_table(df, "segment", "target")


@lead_query("evaluate_all", CURVE.strip() + f""",
lt AS ({LIFT}), {RANKED}
SELECT 'roc_auc' AS metric, round({AUC}, 6) AS value FROM curve
UNION ALL SELECT 'pr_auc', round({AP}, 6) FROM curve
UNION ALL SELECT 'ks', round(max(abs(tp / CAST(p AS DOUBLE) - fp / CAST(n AS DOUBLE))), 6) FROM curve
UNION ALL SELECT 'brier', round(avg(pow(target - score, 2)), 6) FROM leads
UNION ALL SELECT 'ece', round(sum(n * abs(p - y)) / sum(n), 6) FROM (SELECT CASE WHEN score <= 0.25 THEN 0 WHEN score <= 0.75 THEN 1
  ELSE 2 END AS bin, count(*) AS n, avg(score) AS p, avg(target) AS y FROM leads GROUP BY 1)
UNION ALL SELECT 'lift_at_10', round(avg(target) / any_value(base), 6) FROM r WHERE pos <= n // 10
UNION ALL SELECT 'lift_' || segment, lift FROM lt
UNION ALL SELECT 'cr_' || segment, conv_rate FROM lt""")
def evaluate_all(spark, path):
    return E.evaluate_all(scored(spark, path), "score", "target", "lead_id")


def _confusion_sql(thresholds) -> str:
    rate = lambda a, b, n: f"round(coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0), 6) AS {n}"
    return f"""c AS (SELECT CAST(t AS DOUBLE) AS threshold, count(*) FILTER (score >= t AND target = 1) AS tp, count(*) FILTER (score >= t AND target = 0) AS fp,
  count(*) FILTER (score < t AND target = 1) AS fn, count(*) FILTER (score < t AND target = 0) AS tn
  FROM leads, (SELECT CAST(unnest({list(thresholds)}) AS DOUBLE) AS t) GROUP BY t)
SELECT threshold, tp, fp, fn, tn, {rate('tp + tn', 'tp + tn + fp + fn', 'accuracy')}, {rate('tp', 'tp + fp', 'precision')},
  {rate('tp', 'tp + fn', 'recall')}, {rate('tn', 'tn + fp', 'specificity')}, {rate('2 * tp', '2 * tp + fp + fn', 'f1')} FROM c"""


THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


@lead_query("classification_metrics", _confusion_sql([0.5]))
def classification_metrics(spark, path):
    return E.classification_metrics(scored(spark, path), "score", "target")


@lead_query("threshold_sweep", _confusion_sql(THRESHOLDS))
def threshold_sweep(spark, path):
    return E.threshold_sweep(scored(spark, path), "score", "target", THRESHOLDS)


@lead_query("segment_metrics", f"""
s AS (SELECT {SEG} AS segment, score, target FROM leads UNION ALL SELECT 'ALL', score, target FROM leads),
h AS (SELECT segment, score, sum(target) AS pos, sum(1 - target) AS neg FROM s GROUP BY 1, 2),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER a AS p, sum(neg) OVER a AS n FROM h
  WINDOW w AS (PARTITION BY segment ORDER BY score DESC), a AS (PARTITION BY segment)),
m AS (SELECT segment, CASE WHEN any_value(p) * any_value(n) > 0 THEN round({AUC}, 6) END AS auc,
  CASE WHEN any_value(p) > 0 THEN round({AP}, 6) END AS average_precision FROM curve GROUP BY segment)
SELECT s.segment, count(*) AS count, round(avg(pow(target - score, 2)), 6) AS brier,
  round(avg(CASE WHEN (score >= 0.5) = (target = 1) THEN 1 ELSE 0 END), 6) AS accuracy, round(avg(score), 6) AS mean_score,
  round(avg(target), 6) AS rate, any_value(auc) AS auc, any_value(average_precision) AS average_precision
FROM s JOIN m ON m.segment = s.segment GROUP BY s.segment""")
def segment_metrics(spark, path):
    df = scored(spark, path).withColumn("seg", S.assign_segment(F.col("score")))
    return E.segment_metrics(df, "score", "target", "seg")


# ---------------------------------------------------------------- segments and bins


@lead_query("assign_segments", f"SELECT lead_id, {SEG} AS segment FROM leads")
def assign_segments(spark, path):
    return scored(spark, path).select("lead_id", S.assign_segment(F.col("score")).alias("segment"))


@lead_query("probability_binning", f"SELECT lead_id, {BIN} AS bin FROM leads")
def probability_binning(spark, path):
    return scored(spark, path).select("lead_id", S.cut_right_closed(F.col("score")).alias("bin"))


@lead_query("bin_stats", f"""
b AS (SELECT {BIN} AS bin, score, target FROM leads)
SELECT bin, count(*) AS count, round(avg(target), 6) AS mean_true, round(avg(score), 6) AS mean_pred, round(min(score), 6) AS min_pred,
  round(max(score), 6) AS max_pred, round(100.0::DOUBLE * count(*) / (SELECT count(bin) FROM b), 6) AS percent,
  round(avg(target) - avg(score), 6) AS calibration_error FROM b WHERE bin IS NOT NULL GROUP BY bin""")
def bin_stats(spark, path):
    return C.bin_stats(scored(spark, path), "score", "target")


HALF = "score / 2.0::DOUBLE"


@lead_query("binwise_metrics", f"""
s AS (SELECT {SEG.replace('score', HALF)} AS segment, {HALF} AS p, target FROM leads),
l AS (SELECT * FROM (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High')) AS v(position, segment))
SELECT CAST(position AS BIGINT) AS position, l.segment, count(target) AS count, round(coalesce(avg(target), 0), 6) AS conversion_rate,
  round(coalesce(avg(p), 0), 6) AS mean_score, round(100.0::DOUBLE * count(target) / (SELECT count(*) FROM s), 6) AS percent
FROM l LEFT JOIN s ON s.segment = l.segment GROUP BY 1, 2""")
def binwise_metrics(spark, path):
    """Halved scores leave the High segment empty."""
    return C.binwise_metrics(scored(spark, path).withColumn("score", F.col("score") / 2), "score", "target")


RATE = {s: f"avg(target) FILTER ({SEG} = '{s}')" for s in ("Low", "Medium", "High")}
SIZE = {s: f"count(*) FILTER ({SEG} = '{s}')" for s in ("Low", "Medium", "High")}


@lead_query("segment_order", f"""
SELECT round({RATE['Low']}, 6) AS rate_low, round({RATE['Medium']}, 6) AS rate_medium, round({RATE['High']}, 6) AS rate_high,
  CAST(CASE WHEN {RATE['Low']} < {RATE['Medium']} AND {RATE['Medium']} < {RATE['High']} THEN 1 ELSE 0 END AS BIGINT) AS ordered FROM leads""")
def segment_order(spark, path):
    return C.segment_order(scored(spark, path), "score", "target")


@lead_query("segment_coverage", f"""
c AS (SELECT count(*) AS n, {SIZE['Low']} AS n_low, {SIZE['Medium']} AS n_medium, {SIZE['High']} AS n_high FROM leads),
t AS (SELECT *, CAST(CASE WHEN n < 100 THEN greatest(2, floor(n * 0.05)) WHEN n < 1000 THEN greatest(5, floor(n * 0.02)) ELSE 10 END AS BIGINT)
  AS threshold FROM c)
SELECT *, CAST(CASE WHEN least(n_low, n_medium, n_high) >= threshold THEN 1 ELSE 0 END AS BIGINT) AS covered FROM t""")
def segment_coverage(spark, path):
    return C.segment_coverage(scored(spark, path), "score", "target")


@lead_query("calibrator_metrics", union_sql([f"""
SELECT '{n}' AS candidate, round(avg(pow(target - s, 2)), 6) AS brier, count(*) AS n, """.strip() + ", ".join(
    f"count(*) FILTER ({SEG.replace('score', 's')} = '{g}') AS n_{g.lower()}, round(avg(target) FILTER ({SEG.replace('score', 's')} = '{g}'), 6) AS rate_{g.lower()}"
    for g in ("Low", "Medium", "High")) + f" FROM (SELECT target, {e} AS s FROM leads)" for n, e in (("raw", "score"), ("squared", "score * score"))]))
def calibrator_metrics(spark, path):
    """What the calibrator decision reads, for two candidate scores."""
    df = scored(spark, path).withColumn("squared", F.col("score") * F.col("score"))
    one = lambda name, c: C.calibrator_metrics(df, c, "target").withColumn("candidate", F.lit(name))
    return one("raw", "score").unionByName(one("squared", "squared"))


@lead_query("reliability_bins", """
b AS (SELECT least(CAST(floor(score * 10) AS BIGINT), 9) AS bin, score, target FROM leads)
SELECT bin, round(bin / 10.0::DOUBLE, 6) AS bin_min, round((bin + 1) / 10.0::DOUBLE, 6) AS bin_max, count(*) AS count,
  round(avg(target), 6) AS true_rate, round(avg(score), 6) AS avg_pred, round(abs(avg(target) - avg(score)), 6) AS error FROM b GROUP BY bin""")
def reliability_bins(spark, path):
    return C.reliability_bins(scored(spark, path), "score", "target")


@lead_query("segment_migration", f"""
SELECT {SEG} AS segment_before, {SEG.replace('score', '(score * score)')} AS segment_after, count(*) AS count FROM leads GROUP BY 1, 2""")
def segment_migration(spark, path):
    df = scored(spark, path).withColumn("squared", F.col("score") * F.col("score"))
    return C.segment_migration(df, "score", "squared")


@lead_query("score_positions", """
SELECT lead_id, row_number() OVER (ORDER BY score, lead_id) - 1 AS pos FROM leads""")
def score_positions(spark, path):
    """Global order of all rows from prefix counts over score buckets, never one window."""
    from winnow.operators.kernels import row_positions

    return row_positions(scored(spark, path), "score", "lead_id", task_rows=5000).select("lead_id", "pos")


@lead_query("isotonic_mean", """
SELECT count(*) AS n, round(avg(target), 6) AS mean_calibrated, round(avg(target), 6) AS mean_target FROM leads""")
def isotonic_mean(spark, path):
    """An isotonic fit keeps the mean: calibrated scores average to the conversion rate."""
    df = scored(spark, path)
    out = C.fit_isotonic(df, "score", "target").transform(df, "score")
    return out.agg(F.count(F.lit(1)).alias("n"), F.avg("calibrated").alias("mean_calibrated"), F.avg("target").alias("mean_target"))


RANKED_BY = """r AS (SELECT target, row_number() OVER (ORDER BY score DESC, {id}) AS pos, count(*) OVER () AS n,
  avg(target) OVER () AS base FROM leads)"""


@lead_query("lift_at_k_text_ids", RANKED_BY.format(id="'lead-' || lead_id") + """
SELECT any_value(CAST(n // 10 AS BIGINT)) AS top_n, round(avg(target) / any_value(base), 6) AS lift FROM r WHERE pos <= n // 10""")
def lift_at_k_text_ids(spark, path):
    """Text ids, ties in their own order, the order cut into buckets."""
    df = scored(spark, path).withColumn("lead_id", F.concat(F.lit("lead-"), F.col("lead_id").cast("string")))
    with cut_small(spark):
        return E.lift_at_k(df, "score", "target", "lead_id", 0.1)


@lead_query("decile_lift_wide_ids", RANKED_BY.format(id="lead_id") + """
SELECT d AS decile, any_value(n * d // 10) AS top_n, round(avg(target) / any_value(base), 6) AS lift
FROM r, range(1, 11) AS t(d) WHERE pos <= n * d // 10 GROUP BY d""")
def decile_lift_wide_ids(spark, path):
    """Ids above 2^53, which a double cannot tell apart."""
    df = scored(spark, path).withColumn("lead_id", F.col("lead_id") + F.lit(2**60))
    with cut_small(spark):
        return E.decile_lift(df, "score", "target", "lead_id")


@lead_query("isotonic_points", """
p AS (SELECT row_number() OVER (ORDER BY score) AS k, score, y, w FROM (
  SELECT score, CAST(sum(target) AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS w FROM leads GROUP BY score)),
c AS (SELECT k, score, sum(y) OVER (ORDER BY k) AS sy, sum(w) OVER (ORDER BY k) AS sw, y, w FROM p),
m AS (SELECT a.k AS a, b.k AS b, (b.sy - a.sy + a.y) / (b.sw - a.sw + a.w) AS mean FROM c a JOIN c b ON a.k <= b.k),
l AS (SELECT a, b, min(mean) OVER (PARTITION BY a ORDER BY b DESC) AS least FROM m)
SELECT score, round(max(least) OVER (PARTITION BY b ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 6) AS calibrated
FROM l JOIN p ON p.k = l.b QUALIFY row_number() OVER (PARTITION BY b ORDER BY a) = 1""")
def isotonic_points(spark, path):
    """Fitted values at every distinct score, against the max-min formula."""
    df = scored(spark, path)
    return C.fit_isotonic(df, "score", "target").transform(df.select("score").distinct(), "score").select("score", "calibrated")
