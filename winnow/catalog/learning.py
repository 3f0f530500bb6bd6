"""Search, boosting, kernels and ordered encodings: queries whose SQL restates what a fixed model or one round does."""

from __future__ import annotations

from datetime import timedelta

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from winnow.catalog.registry import cut_small, lead_query, query
from winnow.operators import features as FE
from winnow.session import scratch_path
from winnow.sources.tables import leads, table
from winnow.streaming.scoring import read_record_stream, score_available

INPUTS = """x AS (SELECT lead_id, record_type, target, total_price / 200000.0::DOUBLE AS price, acctbal / 5000.0::DOUBLE AS balance,
  coalesce(qty_sum, 0) / 100.0::DOUBLE AS quantity FROM leads)"""
NAMES = ("price", "balance", "quantity")


def inputs(spark, path, *more):
    df = leads(spark, path, "lead_id", "target", "total_price", "acctbal", "qty_sum", *more).select(
        "lead_id", "target", *more, (F.col("total_price") / 200000.0).alias("price"), (F.col("acctbal") / 5000.0).alias("balance"),
        (F.coalesce("qty_sum", F.lit(0.0)) / 100.0).alias("quantity"))
    return VectorAssembler(inputCols=list(NAMES), outputCol="features").transform(df)


# ---------------------------------------------------------------- search


@lead_query("search_rungs", """
r AS (SELECT CAST('0x' || substr(md5(concat(lead_id, '|rung42')), 1, 13) AS BIGINT) / pow(2.0, 52) AS drawn FROM leads),
n AS (SELECT CAST(k AS BIGINT) AS rung, count(*) AS rows FROM r, range(3) t(k) WHERE k = 2 OR drawn < pow(3.0, k - 2) GROUP BY k),
t(bracket, rung, trials) AS (VALUES (0, 0, 7), (0, 1, 2), (0, 2, 1))
SELECT CAST(bracket AS BIGINT) AS bracket, CAST(rung AS BIGINT) AS rung, CAST(trials AS BIGINT) AS trials, rows FROM t JOIN n USING (rung)""")
def search_rungs(spark, path):
    """Trials and rows on every rung of a search over all leads: a third of the trials goes on to three times the rows."""
    from winnow.operators.tuning import Span, tune

    df = inputs(spark, path).withColumn("label", (F.col("price") + 0.5 * F.col("quantity") + 0.3 * F.col("target") > 1.0).cast("int"))
    found = tune(df, "ridge_lr", {"C": Span(0.01, 100.0, wide=True)}, "lead_id", trials=7, folds=2, rungs=3, max_iter=5)
    return found.table(spark)


# ---------------------------------------------------------------- boosting

EDGES = {"price": (0.25, 0.5, 0.75, 1.0, 1.5), "balance": (-0.1, 0.3, 0.7, 1.1, 1.5), "quantity": (0.4, 0.8, 1.2, 1.6, 2.0)}


@lead_query("boosted_root_cuts", INPUTS + ", b AS (\n" + "\nUNION ALL ".join(
    f"SELECT '{f}' AS feature, len(list_filter([{', '.join(f'{e}::DOUBLE' for e in edges)}], lambda e: e < {f})) AS bin, 0.5 - target AS g, 0.25 AS h FROM x"
    for f, edges in EDGES.items()) + """),
s AS (SELECT feature, bin, sum(g)::DOUBLE AS g, sum(h)::DOUBLE AS h FROM b GROUP BY feature, bin),
c AS (SELECT feature, bin, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY feature) AS g, sum(h) OVER (PARTITION BY feature) AS h
  FROM s WINDOW w AS (PARTITION BY feature ORDER BY bin)),
e AS (SELECT *, 0.5 * (gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) AS gain FROM c WHERE hl >= 1 AND h - hl >= 1)
SELECT feature, CAST(bin AS BIGINT) AS bin, round(gain, 6) AS gain, round(-0.1 * gl / (hl + 1), 6) AS left_value, round(-0.1 * (g - gl) / (h - hl + 1), 6) AS right_value
FROM e QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, bin) = 1""")
def boosted_root_cuts(spark, path):
    """The first round's best cut of every feature, its gain and leaf values, from one pass over all leads."""
    from winnow.operators.boosting import Growth, HistogramBoosting, Tree, level_cuts, level_sums

    rule = Growth("level", l2=1.0, min_weight=1.0, step=0.1, base=0.5)
    boost = HistogramBoosting(labelCol="target", growth=rule, edges=[list(EDGES[f]) for f in NAMES])
    rows, _, _ = boost.prepared(inputs(spark, path))
    found = level_cuts(level_sums(rows, 3, 6, [0], Tree(), [], rule, 0, [0, 1, 2]), 1, 6, rule)
    value = lambda s: float(-rule.step * s[0] / (s[1] + rule.l2))
    out = [(NAMES[f], b, gain, value(left), value([t - v for t, v in zip(total, left)])) for _, f, b, gain, left, total in found]
    return spark.createDataFrame(out, "feature string, bin long, gain double, left_value double, right_value double")


# ---------------------------------------------------------------- kernels

POINTS, SHARES = ((0.5, 0.2, 0.4), (1.2, -0.1, 1.0), (0.1, 1.5, 0.2)), (0.7, -0.4, 0.25)


@lead_query("kernel_scores", INPUTS + """
SELECT lead_id, round(1 / (1 + exp(-m)), 6) AS probability FROM (SELECT lead_id, -0.3 + """ + " + ".join(
    f"{w} * pow(0.5 * ({a} * price + {b} * balance + {c} * quantity) + 1, 2)" for (a, b, c), w in zip(POINTS, SHARES)) + " AS m FROM x)")
def kernel_scores(spark, path):
    """All leads scored by a fixed machine with a polynomial kernel and three landmarks."""
    from winnow.operators.kernelmaps import KernelMap, KernelSVCModel
    from winnow.operators.models import positive_probability

    fixed = KernelMap("poly", 0.5, 2, 1.0, np.array(POINTS), np.eye(3))
    model = KernelSVCModel._of(fixed, np.array(SHARES), -0.3)
    return model.transform(inputs(spark, path)).select("lead_id", positive_probability(model).alias("probability"))


# ---------------------------------------------------------------- ordered target statistics

ORDERED = """
o AS (SELECT lead_id, record_type, target, substr(md5(concat(lead_id, '|42')), 1, 13) AS h, avg(target) OVER () AS prior FROM leads)
SELECT lead_id, record_type, round((coalesce(sum(target) OVER w, 0) + prior) / (count(target) OVER w + 1), 6) AS record_type_ots
FROM o WINDOW w AS (PARTITION BY record_type ORDER BY h, lead_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@lead_query("ordered_target_encode", ORDERED)
def ordered_target_encode(spark, path):
    df = leads(spark, path, "lead_id", "record_type", "target")
    return FE.ordered_target_encode(df, "record_type", "target", "lead_id").select("lead_id", "record_type", "record_type_ots")


@lead_query("ordered_target_encode_cut", ORDERED)
def ordered_target_encode_cut(spark, path):
    """The same with every order cut into pieces."""
    with cut_small(spark):
        df = leads(spark, path, "lead_id", "record_type", "target")
        return FE.ordered_target_encode(df, "record_type", "target", "lead_id").select("lead_id", "record_type", "record_type_ots")


# ---------------------------------------------------------------- permutation


def donor_sql(n: str, seed: int, walks: int, source: str) -> str:
    """CTEs that follow the keyed bijection of ``source``'s ``i``, round by round; ``donors`` ends with ``i, j``."""
    from winnow.operators.kernels import FEISTEL_PRIME as p
    from winnow.operators.kernels import FEISTEL_ROUNDS, feistel_keys

    out = [f"q0 AS (SELECT i, side, n, i // side AS a, i % side AS b, false AS done FROM {source}, (SELECT CAST(ceil(sqrt({n})) AS BIGINT) AS side, {n} AS n))"]
    for k in range(walks * FEISTEL_ROUNDS):
        x, y, z = feistel_keys(seed)[k % FEISTEL_ROUNDS]
        last = "b * side + (a + m) % side < n" if k % FEISTEL_ROUNDS == FEISTEL_ROUNDS - 1 else "false"
        mixed = f"(SELECT *, ((b * b) % {p} * {x} % {p} + b * {y} % {p} + {z}) % side AS m FROM q{k})"
        out.append(f"q{k + 1} AS (SELECT i, side, n, if(done, a, b) AS a, if(done, b, (a + m) % side) AS b, done OR ({last}) AS done FROM {mixed})")
    out.append(f"donors AS (SELECT i, a * side + b AS j FROM q{walks * FEISTEL_ROUNDS})")
    return ",\n".join(out)


MARGIN = "1.5::DOUBLE * {price} + -0.8::DOUBLE * {balance} + 0.4::DOUBLE * {quantity} - 1.2"
SCORED = "SELECT '' AS feature, label, " + MARGIN.format(price="price", balance="balance", quantity="quantity") + " AS s FROM r" + "".join(
    f" UNION ALL SELECT '{f}', r.label, " + MARGIN.format(**{c: ("d" if c == f else "r") + "." + c for c in NAMES})
    + " FROM r JOIN donors USING (i) JOIN r d ON d.i = j" for f in NAMES)


@lead_query("permutation_importance", INPUTS + """,
r AS (SELECT *, CASE WHEN price + 0.5 * quantity + 0.3 * target > 1.0 THEN 1 ELSE 0 END AS label, row_number() OVER (ORDER BY lead_id) - 1 AS i FROM x),
""" + donor_sql("(SELECT count(*) FROM x)", 42, 6, "r") + ", scored AS (" + SCORED + """),
ranked AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY s) + (count(*) OVER (PARTITION BY feature, s) - 1) / 2.0::DOUBLE AS k FROM scored),
u AS (SELECT feature, (sum(k) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE) / (sum(label) * (count(*) - sum(label))::DOUBLE) AS auc FROM ranked GROUP BY feature)
SELECT feature, round((SELECT auc FROM u WHERE feature = '') - auc, 6) AS importance, 0.0::DOUBLE AS std FROM u WHERE feature <> ''""")
def permutation_importance(spark, path):
    """AUC that a fixed scorer loses when a column is shuffled over all rows by a keyed bijection."""
    from winnow.operators import importance as I

    df = inputs(spark, path).drop("features").withColumn("label", (F.col("price") + 0.5 * F.col("quantity") + 0.3 * F.col("target") > 1.0).cast("int"))
    margin = F.expr(MARGIN.format(price="price", balance="balance", quantity="quantity").replace("::DOUBLE", "D"))
    score = lambda d: d.withColumn("p", margin)
    return I.permutation_importance(df, NAMES, score, "label", "lead_id", repeats=1)


# ---------------------------------------------------------------- votes and experts

LINES = {
    "a": {"price": 1.5, "balance": -0.8, "quantity": 0.4}, "b": {"price": -0.2, "balance": 0.1, "quantity": 2.0},
    "c": {"price": 0.3, "balance": 1.1, "quantity": -0.5},
}


def line_sql(name: str) -> str:
    """Probability of a fixed logistic scorer, the same text for both engines."""
    return "1 / (1 + exp(-(" + " + ".join(f"CAST({w} AS DOUBLE) * {c}" for c, w in LINES[name].items()) + ")))"


class Line:
    """A fixed scorer with the interface of a fitted family."""

    def __init__(self, name: str):
        self.name = name

    def transform(self, df, out: str = "probability_1"):
        return df.withColumn(out, F.expr(line_sql(self.name)))


@lead_query("voting_weights", INPUTS + f""",
s AS (SELECT CASE WHEN price + 0.5 * quantity + 0.3 * target > 1.0 THEN 1 ELSE 0 END AS label, {line_sql('a')} AS a, {line_sql('b')} AS b FROM x),
c AS (SELECT k AS candidate, label, a * ((k / 10.0::DOUBLE) / (k / 10.0::DOUBLE + (1 - k / 10.0::DOUBLE)))
  + b * ((1 - k / 10.0::DOUBLE) / (k / 10.0::DOUBLE + (1 - k / 10.0::DOUBLE))) AS s FROM s, range(11) t(k)),
r AS (SELECT *, rank() OVER (PARTITION BY candidate ORDER BY s) + (count(*) OVER (PARTITION BY candidate, s) - 1) / 2.0::DOUBLE AS k FROM c)
SELECT candidate, round((sum(k) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE) / (sum(label) * (count(*) - sum(label))::DOUBLE), 6) AS value
FROM r GROUP BY candidate""")
def voting_weights(spark, path):
    """AUC of every weighting of two fixed scorers, in one pass over all leads."""
    from winnow.operators import models as M

    df = inputs(spark, path).withColumn("label", (F.col("price") + 0.5 * F.col("quantity") + 0.3 * F.col("target") > 1.0).cast("int"))
    both, columns = M.add_probabilities(df, {"a": Line("a"), "b": Line("b")})
    return M.candidate_scores(both, columns, "label", M.weight_candidates(2))


@lead_query("source_experts", INPUTS.replace("record_type,", "record_type, source,") + f"""
SELECT lead_id, source, round(CASE source WHEN '1-URGENT' THEN {line_sql('b')} WHEN '3-MEDIUM' THEN {line_sql('c')} ELSE {line_sql('a')} END, 6) AS probability FROM x""")
def source_experts(spark, path):
    """Every lead goes to its source's scorer, else to the general one."""
    from winnow.operators import models as M

    model = M.SourceExperts("source", Line("a"), {"1-URGENT": Line("b"), "3-MEDIUM": Line("c")})
    return model.transform(inputs(spark, path, "source"), "probability").select("lead_id", "source", "probability")


# ---------------------------------------------------------------- components


@lead_query("pca_projection", INPUTS + """,
m AS (SELECT avg(price) AS mp, avg(quantity) AS mq, var_samp(price) AS a, var_samp(quantity) AS c, covar_samp(price, quantity) AS b FROM x),
e AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l FROM m),
u AS (SELECT *, b / sqrt(b * b + (l - a) * (l - a)) AS ux, (l - a) / sqrt(b * b + (l - a) * (l - a)) AS uy FROM e),
s AS (SELECT *, CASE WHEN abs(ux) >= abs(uy) THEN sign(ux) ELSE sign(uy) END AS s1, CASE WHEN abs(uy) >= abs(ux) THEN sign(-uy) ELSE sign(ux) END AS s2 FROM u)
SELECT lead_id, round(s1 * ((price - mp) * ux + (quantity - mq) * uy), 6) AS PC_001, round(s2 * (-(price - mp) * uy + (quantity - mq) * ux), 6) AS PC_002 FROM x, s""")
def pca_projection(spark, path):
    """Two columns turned to their principal axes; of each axis the largest weight counts as positive."""
    from winnow.operators.selection import SmartFeatureSelector
    from winnow.roles import ColumnRoles

    df = inputs(spark, path).select("lead_id", "target", "price", "quantity")
    roles = ColumnRoles(target="target", group=None, time=None, source=None, ids=("lead_id",))
    model = SmartFeatureSelector(pca_components=2, target_correlation_min=0.0, near_zero_var_thresh=0.0, outlier_thresh=1.1, correlation_thresh=1.1).fit(df, roles)
    return model.transform(df).select("lead_id", "PC_001", "PC_002")


# ---------------------------------------------------------------- history on a stream

PAST = "(PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {} DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"


@query("stream_account_history", f"""
SELECT event_id, row_number() OVER o - 1 AS cum_leads_account,
  coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER o)) // 86400000000, -1) AS days_since_prev_lead,
  count(*) OVER {PAST.format(2)} AS "lead_cnt_2D", count(*) OVER {PAST.format(7)} AS "lead_cnt_7D",
  count(*) FILTER (event_type = 'click') OVER {PAST.format(7)} AS "lead_cnt_click_7D"
FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, CAST(event_id AS VARCHAR))""")
def stream_account_history(spark, path):
    """Every event's history per user, from files that arrive in two lots: the query stops between them and goes on from its checkpoint."""
    from winnow.streaming.history import stream_history

    base = scratch_path(spark, "history")
    events = table(spark, path, "events").select("event_id", "ts", "user_id", "event_type")
    ends = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle, closing = ends["a"] + (ends["b"] - ends["a"]) / 2, ends["b"] + timedelta(days=3)
    last = spark.createDataFrame([(None, closing, -1, None)], events.schema)  # moves the watermark past every event
    history = lambda d: stream_history(d, "user_id", "ts", "event_id", (2, 7), "event_type", ("click",), "2 days")
    for lot in (events.filter(F.col("ts") < F.lit(middle)), events.filter(F.col("ts") >= F.lit(middle)).unionByName(last)):
        lot.write.mode("append").parquet(base + "/in")
        score_available(spark, read_record_stream(spark, base + "/in", events.schema, "parquet"), history, base + "/out", base + "/state")
    return spark.read.parquet(base + "/out").filter(F.col("user_id") >= 0).select(
        "event_id", "cum_leads_account", "days_since_prev_lead", "lead_cnt_2D", "lead_cnt_7D", "lead_cnt_click_7D")


# ---------------------------------------------------------------- profiles that merge


@lead_query("merged_profile", "\nUNION ALL ".join(f"""
SELECT '{c}' AS feature, count(*) AS rows, count({c}) AS count, count(*) - count({c}) AS missing, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std,
  round(CAST(min({c}) AS DOUBLE), 3) AS min, round(CAST(max({c}) AS DOUBLE), 3) AS max FROM leads WHERE created_at >= TIMESTAMP '1994-01-01'""".strip()
    for c in ("total_price", "acctbal", "qty_sum")), digits=3)
def merged_profile(spark, path):
    """Stored daily states of the leads from 1994 on, merged: the exact part of the profile."""
    from winnow.operators import profiles as P

    base = scratch_path(spark, "profiles")
    P.store_states(P.daily_states(leads(spark, path, "created_at", "total_price", "acctbal", "qty_sum"), "created_at", ["total_price", "acctbal", "qty_sum"]), base)
    return P.merged_profile(P.stored_states(spark, base, "1994-01-01"), ()).drop("nunique")
