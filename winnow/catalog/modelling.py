"""Selection, imbalance, importance, training and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from winnow.catalog.registry import lead_query, query, split_leads, train_of, union_sql
from winnow.functions.scalar import assign_segment
from winnow.operators import imbalance as IM
from winnow.operators import importance as I
from winnow.operators import selection as FS
from winnow.plans.scoring import linear_scorer, score_columns
from winnow.roles import ColumnRoles
from winnow.session import scratch_path
from winnow.sources.tables import CATEGORICAL, NUMERIC, leads, table
from winnow.streaming.scoring import read_record_stream, score_available

FEATURES = (*CATEGORICAL, *NUMERIC)


# ---------------------------------------------------------------- selection


@lead_query("select_missing", union_sql([f"""
SELECT '{c}' AS feature, round(CAST(count(*) - count({c}) AS DOUBLE) / count(*), 6) AS ratio FROM train""".strip() for c in FEATURES]))
def select_missing(spark, path):
    return FS.missing_ratios(train_of(split_leads(spark, path, *FEATURES)), FEATURES)


DUPES = "total_price AS price_copy, CASE WHEN source = '5-LOW' THEN acctbal + 1 ELSE acctbal END AS acctbal_near, qty_sum AS qty_copy"


@lead_query("select_duplicates", f"""
d AS (SELECT *, {DUPES} FROM leads)
SELECT feature, kept FROM (
  SELECT 'price_copy' AS feature, 'total_price' AS kept, count(*) FILTER (price_copy IS DISTINCT FROM total_price) AS n FROM d
  UNION ALL SELECT 'acctbal_near', 'acctbal', count(*) FILTER (acctbal_near IS DISTINCT FROM acctbal) FROM d
  UNION ALL SELECT 'qty_copy', 'qty_sum', count(*) FILTER (qty_copy IS DISTINCT FROM qty_sum) FROM d) WHERE n = 0""")
def select_duplicates(spark, path):
    """Two true copies and one near copy."""
    df = leads(spark, path, "source", *NUMERIC).select(
        *NUMERIC, F.col("total_price").alias("price_copy"),
        F.when(F.col("source") == "5-LOW", F.col("acctbal") + 1).otherwise(F.col("acctbal")).alias("acctbal_near"),
        F.col("qty_sum").alias("qty_copy"),
    )
    return FS.duplicate_columns(df, df.columns)


@lead_query("select_variance", "z AS (SELECT " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in NUMERIC) + " FROM train),\nb AS (SELECT "
    + ", ".join(f"min({c}) AS a_{c}, max({c}) AS b_{c}" for c in NUMERIC) + " FROM z)\n"
    + union_sql([f"SELECT '{c}' AS feature, round(var_pop(({c} - a_{c}) / (b_{c} - a_{c})), 6) AS variance FROM z, b" for c in NUMERIC]))
def select_variance(spark, path):
    return FS.scaled_variances(train_of(split_leads(spark, path, *NUMERIC)), NUMERIC)


@lead_query("select_outlier_ratio", "q AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in NUMERIC) + " FROM train)\n" + union_sql([f"""
SELECT '{c}' AS feature, round(avg(CASE WHEN {c} < a_{c} - 1.5 * (b_{c} - a_{c}) OR {c} > b_{c} + 1.5 * (b_{c} - a_{c}) THEN 1.0 ELSE 0.0 END), 6)
  AS ratio FROM train, q""".strip() for c in NUMERIC]))
def select_outlier_ratio(spark, path):
    return FS.outlier_ratios(train_of(split_leads(spark, path, *NUMERIC)), NUMERIC)


@lead_query("mutual_information", union_sql([f"""
SELECT '{c}' AS feature, round(greatest(sum(n / t * ln(n * t / (r * k))), 0), 6) AS mi FROM (
  SELECT CAST(count(*) AS DOUBLE) AS n, sum(count(*)) OVER (PARTITION BY coalesce({c}, 'MISSING')) AS r,
    sum(count(*)) OVER (PARTITION BY target) AS k, sum(count(*)) OVER () AS t
  FROM train GROUP BY coalesce({c}, 'MISSING'), target)""".strip() for c in CATEGORICAL]))
def mutual_information(spark, path):
    df = train_of(split_leads(spark, path, "target", *CATEGORICAL))
    return FS.mutual_information(df, CATEGORICAL, "target")


@lead_query("select_target_corr", "m AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in NUMERIC) + " FROM train)\n" + union_sql(
    [f"SELECT '{c}' AS feature, round(abs(corr(coalesce(CAST({c} AS DOUBLE), m_{c}), target)), 6) AS r FROM train, m" for c in NUMERIC]))
def select_target_corr(spark, path):
    return FS.filled_target_corr(train_of(split_leads(spark, path, "target", *NUMERIC)), NUMERIC, "target")


@lead_query("select_multicollinear", union_sql([
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(abs(corr(coalesce({a}, 0), coalesce({b}, 0))), 6) AS r FROM train"
    for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]]))
def select_multicollinear(spark, path):
    """The pair matrix the sequential choice reads."""
    return FS.zero_filled_corr(train_of(split_leads(spark, path, *NUMERIC)), NUMERIC)


ROLES = ColumnRoles(target="target", group="account_id", time="created_at", ids=("lead_id",))
REPORTED = ("source", "channel", "total_price", "line_cnt", "qty_sum", "price_copy", "flat")


@lead_query("selection_report", "t AS (SELECT *, total_price AS price_copy, 7 AS flat FROM train),\nr AS (" + union_sql([f"""
SELECT '{c}' AS feature, '{"categorical" if c in CATEGORICAL else "numeric"}' AS dtype, round(1.0 - CAST(count({c}) AS DOUBLE) / count(*), 6) AS na_ratio,
  count(DISTINCT {c}) AS nunique, round(CAST(count(DISTINCT {c}) AS DOUBLE) / count(*), 6) AS unique_ratio FROM t""".strip() for c in REPORTED])
    + """)
SELECT r.*, CAST(CASE WHEN feature IN ('price_copy', 'flat') THEN 0 ELSE 1 END AS BIGINT) AS selected,
  CASE feature WHEN 'price_copy' THEN 'duplicate of total_price' WHEN 'flat' THEN 'near-zero variance' END AS reason FROM r""")
def selection_report(spark, path):
    """A copied and a constant column are dropped; relevance thresholds off, so the rest stays."""
    df = train_of(split_leads(spark, path, "lead_id", "account_id", "created_at", "target", *REPORTED[:5])).select(
        "*", F.col("total_price").alias("price_copy"), F.lit(7).alias("flat")
    ).select("lead_id", "account_id", "created_at", "target", *REPORTED)
    model = FS.SmartFeatureSelector(target_correlation_min=-1.0, correlation_thresh=1.1).fit(df, ROLES)
    return model.report(df)


IMPORTANCES = """imp AS (SELECT channel AS feature, CAST(lead_id % 5 AS BIGINT) AS fold, avg(target) - 0.3::DOUBLE AS importance
  FROM leads GROUP BY 1, 2)"""


def _fold_table(spark, path):
    """Conversion rate per channel and residue class, read as a feature's importance per fold."""
    df = leads(spark, path, "lead_id", "channel", "target")
    return df.groupBy(F.col("channel").alias("feature"), (F.col("lead_id") % 5).alias("fold")).agg(
        (F.avg("target") - 0.3).alias("importance")
    )


@lead_query("stable_subset", IMPORTANCES + """,
t AS (SELECT feature, avg(importance) AS m, avg(CASE WHEN importance > 0 THEN 1.0 ELSE 0.0 END) AS s FROM imp GROUP BY feature
  ORDER BY m DESC, feature LIMIT 4)
SELECT feature, round(m, 6) AS mean_importance, round(CAST(s AS DOUBLE), 6) AS positive_share FROM t WHERE s >= 0.6""")
def stable_subset(spark, path):
    return FS.stable_subset(_fold_table(spark, path), top_k=4)


STABILITY = """st AS (SELECT feature, avg(importance) AS m, stddev_samp(importance) AS s FROM imp GROUP BY feature),
stab AS (SELECT feature, m, s, least(greatest(1 - s / (m + 1e-10::DOUBLE), 0), 1) AS stability FROM st)
"""


@lead_query("importance_stability", IMPORTANCES + ",\n" + STABILITY + """
SELECT feature, round(m, 6) AS mean_importance, round(s, 6) AS std_importance, round(stability, 6) AS stability FROM stab""")
def importance_stability(spark, path):
    return I.importance_stability(_fold_table(spark, path))


@lead_query("select_features", IMPORTANCES + ",\n" + STABILITY + """
SELECT feature, round(m, 6) AS mean_importance, round(stability, 6) AS stability FROM stab WHERE stability >= 0.5""")
def select_features(spark, path):
    table_ = I.importance_stability(_fold_table(spark, path))
    return I.select_features(table_, 0.5).select("feature", "mean_importance", "stability")


METHODS = """a AS (SELECT record_type AS feature, avg(target) AS imp FROM leads GROUP BY 1),
b AS (SELECT record_type AS feature, avg(score) AS imp FROM leads GROUP BY 1),
m AS (SELECT 'rate' AS method, * FROM a UNION ALL SELECT 'score', * FROM b)
"""


@lead_query("rank_methods", METHODS + """
SELECT method, feature, round(imp, 6) AS importance, row_number() OVER (PARTITION BY method ORDER BY imp DESC, feature) AS rank FROM m""")
def rank_methods(spark, path):
    df = leads(spark, path, "record_type", "target", "score").groupBy(F.col("record_type").alias("feature"))
    wide = df.agg(F.avg("target").alias("rate"), F.avg("score").alias("score"))
    long = wide.unpivot("feature", ["rate", "score"], "method", "importance")
    return I.method_ranks(long).select("method", "feature", "importance", "rank")


# ---------------------------------------------------------------- imbalance


@lead_query("class_weights", """
SELECT CAST(target AS BIGINT) AS target, count(*) AS n, round((SELECT count(*) FROM leads) / CAST(2 * count(*) AS DOUBLE), 6) AS weight
FROM leads GROUP BY target""")
def class_weights(spark, path):
    return IM.class_weights(leads(spark, path, "target"), "target")


@lead_query("oversample_replicate", """
o AS (SELECT lead_id, target, row_number() OVER (PARTITION BY target ORDER BY substr(md5(concat(lead_id, '|42')), 1, 13), lead_id) - 1 AS pos,
  count(*) OVER (PARTITION BY target) AS n FROM leads),
t AS (SELECT max(n) AS top FROM o)
SELECT lead_id, CAST(target AS BIGINT) AS target, CAST(unnest(range(CASE WHEN pos < top % n THEN top // n + 1 ELSE top // n END)) AS BIGINT) AS copy
FROM o, t""")
def oversample_replicate(spark, path):
    return IM.oversample(leads(spark, path, "lead_id", "target"), "target", "lead_id")


@lead_query("undersample", """
o AS (SELECT lead_id, target, row_number() OVER (PARTITION BY target ORDER BY substr(md5(concat(lead_id, '|42')), 1, 13), lead_id) - 1 AS pos,
  count(*) OVER (PARTITION BY target) AS n FROM leads)
SELECT lead_id, CAST(target AS BIGINT) AS target FROM o WHERE pos < (SELECT min(n) FROM o)""")
def undersample(spark, path):
    return IM.undersample(leads(spark, path, "lead_id", "target"), "target", "lead_id")


@lead_query("smote_classes", """
won AS (SELECT CASE WHEN score >= 0.85 THEN 1 ELSE 0 END AS label FROM leads),
c AS (SELECT label, count(*) AS n FROM won GROUP BY label)
SELECT CAST(label AS BIGINT) AS label, n AS observed, (SELECT max(n) FROM c) - n AS synthetic FROM c""")
def smote_classes(spark, path):
    """Rows per class after exact nearest-neighbour oversampling of the rare class."""
    from winnow.operators.synthetic import smote

    df = leads(spark, path, "lead_id", "score", "total_price", "acctbal", "source").withColumn(
        "label", F.when(F.col("score") >= 0.85, 1).otherwise(0)
    )
    out = smote(df, "label", "lead_id", ("total_price", "acctbal"), ("source",))
    return out.groupBy("label").agg(
        F.count_if(F.col("synthetic") == 0).alias("observed"), F.count_if(F.col("synthetic") == 1).alias("synthetic")
    )


# ---------------------------------------------------------------- scoring

WEIGHTS, INTERCEPT = {"price": 1.5, "balance": -0.8, "quantity": 0.4}, -1.2


def _inputs(df, *more):
    return df.select(
        "lead_id", *more, (F.col("total_price") / 200000.0).alias("price"), (F.col("acctbal") / 5000.0).alias("balance"),
        (F.coalesce("qty_sum", F.lit(0.0)) / 100.0).alias("quantity"),
    )


@lead_query("batch_score", """
p AS (SELECT lead_id, 1 / (1 + exp(-(-1.2::DOUBLE + 1.5::DOUBLE * (total_price / 200000.0::DOUBLE) + -0.8::DOUBLE * (acctbal / 5000.0::DOUBLE)
  + 0.4::DOUBLE * (coalesce(qty_sum, 0) / 100.0::DOUBLE)))) AS p FROM leads)
SELECT lead_id, round(p, 6) AS conversion_probability, CASE WHEN p < 0.25 THEN 'Low' WHEN p < 0.75 THEN 'Medium' ELSE 'High' END AS segment FROM p""")
def batch_score(spark, path):
    """A fixed logistic scorer, saved and loaded as a pipeline model."""
    from pyspark.ml import PipelineModel

    out = scratch_path(spark, "scorer")
    linear_scorer(WEIGHTS, INTERCEPT).write().save(out)
    rows = _inputs(leads(spark, path, "lead_id", "total_price", "acctbal", "qty_sum"))
    return score_columns(rows, PipelineModel.load(out), "lead_id")


@query("stream_scoring", """
WITH p AS (SELECT event_id AS lead_id, 1 / (1 + exp(-(-1.0::DOUBLE + 0.05::DOUBLE * value))) AS p FROM events)
SELECT lead_id, round(p, 6) AS conversion_probability, CASE WHEN p < 0.25 THEN 'Low' WHEN p < 0.75 THEN 'Medium' ELSE 'High' END AS segment FROM p""")
def stream_scoring(spark, path):
    """Events arriving as JSON files, scored by the batch function with an available-now trigger."""
    base = scratch_path(spark, "stream")
    table(spark, path, "events").select("event_id", "value").write.json(base + "/in")
    rows = read_record_stream(spark, base + "/in", "event_id bigint, value double")
    model = linear_scorer({"value": 0.05}, -1.0)
    return score_available(
        spark, rows, lambda d: score_columns(d, model, "event_id"), base + "/out", base + "/state"
    )


# ---------------------------------------------------------------- training


@query("model_train_score")
def model_train_score(spark, path):
    """Clean, derive, select, train, calibrate on train and validation; score every lead."""
    from winnow.config import TrainConfig
    from winnow.plans.jobs import train_job

    df = split_leads(spark, path, "lead_id", "account_id", "created_at", "source", "channel", "target", *NUMERIC).withColumn(
        "signal", F.pmod(F.col("lead_id") * 7919, F.lit(700)) / 700.0 + F.col("target") * 0.4
    )
    trained = train_job(df, ROLES, TrainConfig(family="baseline_lr", params={"max_iter": 50}))
    return trained.scorer.transform(df.drop("split"), ["target"])


def _encoded(spark, path):
    """Whole leads, filled and assembled; the label follows price and quantity."""
    from pyspark.ml.feature import VectorAssembler

    df = leads(spark, path, "lead_id", "source", "target", "total_price", "acctbal", "qty_sum").select(
        "lead_id", "source", (F.col("total_price") / 200000.0).alias("price"), (F.col("acctbal") / 5000.0).alias("balance"),
        (F.coalesce("qty_sum", F.lit(0.0)) / 100.0).alias("quantity"), "target",
    ).withColumn("label", (F.col("price") + 0.5 * F.col("quantity") + 0.3 * F.col("target") > 1.0).cast("int"))
    return VectorAssembler(inputCols=["price", "balance", "quantity"], outputCol="features").transform(df)


NAMES = ("price", "balance", "quantity")


@query("tree_attribution")
def tree_attribution(spark, path):
    """Mean absolute Shapley value per feature of a boosted model, over all rows."""
    from winnow.operators.models import fit_family

    df = _encoded(spark, path)
    fitted = fit_family(df, "lightgbm", trees=5, depth=3)
    return I.attribution_importance(df, fitted.model, NAMES)


@query("isolation_outliers")
def isolation_outliers(spark, path):
    """Share of train values a fitted isolation forest would replace, per column."""
    from winnow.operators.cleaning import BasicCleaner, outlier_share

    columns = ("total_price", "acctbal", "qty_sum")
    df = train_of(split_leads(spark, path, *columns)).select(*columns)
    model = BasicCleaner(outlier_method="iforest").fit(df, ROLES)
    return outlier_share(df, model)


@lead_query("segment_conversion_scored", """
p AS (SELECT target, 1 / (1 + exp(-(-1.2::DOUBLE + 1.5::DOUBLE * (total_price / 200000.0::DOUBLE) + -0.8::DOUBLE * (acctbal / 5000.0::DOUBLE)
  + 0.4::DOUBLE * (coalesce(qty_sum, 0) / 100.0::DOUBLE)))) AS p FROM leads)
SELECT CASE WHEN p < 0.25 THEN 'Low' WHEN p < 0.75 THEN 'Medium' ELSE 'High' END AS segment, count(*) AS count, round(avg(target), 6) AS conv_rate
FROM p GROUP BY 1""")
def segment_conversion_scored(spark, path):
    """Metrics beside the scores when the target is present."""
    rows = _inputs(leads(spark, path, "lead_id", "total_price", "acctbal", "qty_sum", "target"), "target")
    scored = linear_scorer(WEIGHTS, INTERCEPT).transform(rows)
    return scored.groupBy(assign_segment(F.col("conversion_probability")).alias("segment")).agg(
        F.count(F.lit(1)).alias("count"), F.avg("target").alias("conv_rate")
    )
