"""Scans, projections, joins, sets, descriptive aggregates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from winnow import roles as R
from winnow.catalog.registry import TRAIN_CUTOFF, VAL_CUTOFF, lead_query, query, split_leads, union_sql
from winnow.functions import scalar as S
from winnow.operators import describe as D
from winnow.operators import splits as SP
from winnow.session import scratch_path
from winnow.sources import files
from winnow.sources.tables import CATEGORICAL, NUMERIC, leads, table


# ---------------------------------------------------------------- scans


@query("scan_csv_typed", """
SELECT CAST(o_orderkey AS BIGINT) AS lead_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
  o_totalprice AS total_price, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at FROM orders""")
def scan_csv_typed(spark, path):
    """Write orders as ';' text with literal NULL cells, read back with a type map."""
    out = scratch_path(spark, "orders-csv")
    o = table(spark, path, "orders")
    o.select(
        F.col("o_orderkey").cast("string").alias("lead_id"),
        F.when(F.col("o_orderstatus") == "P", "NULL").otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("o_totalprice").cast("string").alias("total_price"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    ).write.option("sep", ";").option("header", True).csv(out)
    types = {"lead_id": "int64", "status": "category", "total_price": "float64"}
    return files.read_datamart(spark, out, types, dates=("created_at",))


@query("scan_json", """
SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k
FROM events GROUP BY event_type""")
def scan_json(spark, path):
    """Events written as JSON lines, read with a schema; the nested text parsed too."""
    out = scratch_path(spark, "events-json")
    table(spark, path, "events").select("event_id", "event_type", "props").write.json(out)
    rows = files.read_records(spark, out, "event_id bigint, event_type string, props string")
    k = F.from_json("props", "k bigint")["k"]
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("sum_k"))


@query("null_literals", """
SELECT CAST(o_orderkey AS BIGINT) AS lead_id, CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderpriority END AS source
FROM orders""")
def null_literals(spark, path):
    o = table(spark, path, "orders").select(
        F.col("o_orderkey").alias("lead_id"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "NULL").otherwise(F.col("o_orderpriority")).alias("source"),
    )
    return files.apply_type_map(o, {})


@query("type_map_cast", """
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, TRY_CAST(p_brand AS DOUBLE) AS brand_number,
  CAST(p_size AS BIGINT) AS size_number, CAST(NULL AS VARCHAR) AS bad_date FROM part""")
def type_map_cast(spark, path):
    raw = table(spark, path, "part").select(
        "p_partkey", F.col("p_brand").alias("brand_number"), F.col("p_size").cast("string").alias("size_number"),
        F.concat(F.lit("31-"), F.col("p_brand")).alias("bad_date"),
    )
    types = {"brand_number": "float64", "size_number": "int16"}
    return files.apply_type_map(raw, types, dates=("bad_date",))


@lead_query("read_split_partition", "SELECT lead_id, account_id, total_price FROM train", total_price=2)
def read_split_partition(spark, path):
    """Split stored by partition; reading one set prunes the others."""
    out = scratch_path(spark, "split")
    files.write_split(split_leads(spark, path, "lead_id", "account_id", "total_price"), out)
    return files.read_split(spark, out, "train").select("lead_id", "account_id", "total_price")


# ---------------------------------------------------------------- projections and filters


@lead_query("project_roles", """
SELECT lead_id, CAST(target AS BIGINT) AS target, total_price, source, channel FROM leads""", total_price=2)
def project_roles(spark, path):
    df = leads(spark, path, "lead_id", "created_at", "target", "total_price", "source", "channel")
    roles = R.ColumnRoles.infer(df, target="target", time="created_at", ids=("lead_id",))
    return R.project_roles(df, roles, "numeric", "categorical")


@query("exclude_columns", """
SELECT o_orderstatus, o_totalprice, o_orderpriority FROM orders""", o_totalprice=2)
def exclude_columns(spark, path):
    return R.exclude_columns(table(spark, path, "orders"), drop=("o_orderkey", "o_custkey"))


@lead_query("filter_time_range", f"""
SELECT lead_id, source FROM leads
WHERE created_at > TIMESTAMP '{TRAIN_CUTOFF}' AND created_at <= TIMESTAMP '{VAL_CUTOFF}' AND source = '1-URGENT'""")
def filter_time_range(spark, path):
    t = F.col("created_at")
    ntz = lambda s: F.lit(s).cast("timestamp_ntz")
    return leads(spark, path, "lead_id", "source", "created_at").filter(
        (t > ntz(TRAIN_CUTOFF)) & (t <= ntz(VAL_CUTOFF)) & (F.col("source") == "1-URGENT")
    ).select("lead_id", "source")


@query("clean_names", r"""
WITH c AS (SELECT p_partkey, trim(regexp_replace(concat(' {"', p_name, '": [', p_type, ']}'),
    '["{}\[\]&%+''\\/<>*^|?!\s_]+', '_', 'g'), '_') AS name FROM part)
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, CASE WHEN name = '' THEN 'feature' ELSE name END AS name FROM c""")
def clean_names(spark, path):
    text = F.concat(F.lit(' {"'), F.col("p_name"), F.lit('": ['), F.col("p_type"), F.lit("]}"))
    return table(spark, path, "part").select("p_partkey", S.clean_name(text).alias("name"))


# ---------------------------------------------------------------- joins and sets


@lead_query("semi_join_groups", """
SELECT lead_id, account_id FROM leads WHERE account_id IN
  (SELECT account_id FROM leads GROUP BY account_id HAVING sum(target) >= 3)""")
def semi_join_groups(spark, path):
    df = leads(spark, path, "lead_id", "account_id", "target")
    good = df.groupBy("account_id").agg(F.sum("target").alias("n")).filter("n >= 3")
    return df.join(good, "account_id", "left_semi").select("lead_id", "account_id")


@query("anti_join_groups", """
SELECT CAST(c_custkey AS BIGINT) AS account_id FROM customer WHERE NOT EXISTS
  (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def anti_join_groups(spark, path):
    won = table(spark, path, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("account_id"))
    return table(spark, path, "customer").select(F.col("c_custkey").alias("account_id")).join(won, "account_id", "left_anti")


@query("full_outer_combine", """
WITH a AS (SELECT o_orderpriority AS feature, avg(o_totalprice) / 100000 AS imp FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1),
b AS (SELECT o_orderpriority AS feature, count(*) / 10000.0 AS imp FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1)
SELECT coalesce(a.feature, b.feature) AS feature, round(a.imp, 6) AS imp_a, round(CAST(b.imp AS DOUBLE), 6) AS imp_b,
  round(CASE WHEN a.imp IS NULL THEN b.imp WHEN b.imp IS NULL THEN a.imp ELSE (a.imp + b.imp) / 2 END, 6) AS mean_importance
FROM a FULL OUTER JOIN b ON a.feature = b.feature""")
def full_outer_combine(spark, path):
    from winnow.operators.importance import combine_methods

    o = table(spark, path, "orders").withColumnRenamed("o_orderpriority", "feature")
    a = o.filter("feature <> '5-LOW'").groupBy("feature").agg((F.avg("o_totalprice") / 100000).alias("importance"))
    b = o.filter("feature <> '1-URGENT'").groupBy("feature").agg((F.count(F.lit(1)) / F.lit(10000.0)).alias("importance"))
    return combine_methods({"a": a, "b": b}).select(
        "feature", F.col("importance_a").alias("imp_a"), F.col("importance_b").alias("imp_b"), "mean_importance"
    )


ROW_SPLIT = f"""rs AS (SELECT account_id, CASE WHEN created_at <= TIMESTAMP '{TRAIN_CUTOFF}' THEN 'train'
  WHEN created_at <= TIMESTAMP '{VAL_CUTOFF}' THEN 'validation' ELSE 'test' END AS split FROM leads)"""


def _row_split(spark, path, *columns):
    return SP.time_split(leads(spark, path, "account_id", "created_at", *columns), "created_at", TRAIN_CUTOFF, VAL_CUTOFF)


@lead_query("split_overlap_check", ROW_SPLIT + """
SELECT account_id, count(DISTINCT split) AS sets FROM rs GROUP BY account_id HAVING count(DISTINCT split) > 1""")
def split_overlap_check(spark, path):
    """A row-wise time split on purpose, so that there are overlaps to find."""
    return SP.split_overlap(_row_split(spark, path), "account_id")


@lead_query("union_splits", """
SELECT lead_id, split, CAST(target AS VARCHAR) AS label FROM splits WHERE split = 'train'
UNION ALL SELECT lead_id, split, CAST(NULL AS VARCHAR) AS label FROM splits WHERE split = 'test'""")
def union_splits(spark, path):
    df = split_leads(spark, path, "lead_id", "target").select("lead_id", "split", F.col("target").cast("string").alias("label"))
    held = df.filter("split = 'test'").drop("label")
    return df.filter("split = 'train'").unionByName(held, allowMissingColumns=True)


@lead_query("intersect_groups", ROW_SPLIT + """
SELECT account_id FROM rs WHERE split = 'train' INTERSECT SELECT account_id FROM rs WHERE split = 'test'""")
def intersect_groups(spark, path):
    df = _row_split(spark, path)
    return df.filter("split = 'train'").select("account_id").intersect(df.filter("split = 'test'").select("account_id"))


@lead_query("except_groups", ROW_SPLIT + """
SELECT account_id FROM rs WHERE split = 'validation' EXCEPT SELECT account_id FROM rs WHERE split = 'train'""")
def except_groups(spark, path):
    df = _row_split(spark, path)
    return df.filter("split = 'validation'").select("account_id").subtract(df.filter("split = 'train'").select("account_id"))


# ---------------------------------------------------------------- descriptive aggregates


@lead_query("describe_numeric", union_sql([f"""
SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std,
  round(CAST(min({c}) AS DOUBLE), 3) AS min, round(quantile_cont({c}, 0.25), 3) AS q25, round(quantile_cont({c}, 0.5), 3) AS q50,
  round(quantile_cont({c}, 0.75), 3) AS q75, round(CAST(max({c}) AS DOUBLE), 3) AS max FROM leads""".strip() for c in NUMERIC]),
    digits=3)
def describe_numeric(spark, path):
    return D.describe_numeric(leads(spark, path, *NUMERIC), NUMERIC)


@lead_query("value_counts", union_sql([f"""
SELECT '{c}' AS feature, {c} AS value, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM leads), 6) AS pct
FROM leads WHERE {c} IS NOT NULL GROUP BY {c}""".strip() for c in CATEGORICAL]))
def value_counts(spark, path):
    return D.value_counts(leads(spark, path, *CATEGORICAL), CATEGORICAL)


@lead_query("missing_stats", union_sql([f"""
SELECT '{c}' AS feature, count(*) - count({c}) AS missing, round(100.0 * (count(*) - count({c})) / count(*), 6) AS pct
FROM leads""".strip() for c in ("lead_id", *CATEGORICAL, *NUMERIC)]))
def missing_stats(spark, path):
    return D.missing_stats(leads(spark, path, "lead_id", *CATEGORICAL, *NUMERIC))


@lead_query("target_distribution", """
SELECT CAST(target AS BIGINT) AS target, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM leads), 6) AS pct
FROM leads GROUP BY target""")
def target_distribution(spark, path):
    return D.target_distribution(leads(spark, path, "target"), "target")


SOURCE_RATE = """SELECT source, count(*) AS count, CAST(sum(target) AS BIGINT) AS converted,
  round(CAST(sum(target) AS DOUBLE) / count(*), 6) AS rate,
  round(100.0 * count(*) / (SELECT count(*) FROM leads), 6) AS pct_total FROM leads GROUP BY source"""


@lead_query("source_conversion", SOURCE_RATE)
def source_conversion(spark, path):
    return D.conversion_by(leads(spark, path, "source", "target"), "source", "target")


@lead_query("top_sources", f"SELECT source, rate FROM ({SOURCE_RATE}) ORDER BY rate DESC, source LIMIT 3")
def top_sources(spark, path):
    rates = D.conversion_by(leads(spark, path, "source", "target"), "source", "target")
    return D.top_k(rates, F.desc("rate"), 3, "source").select("source", "rate")


COHORT_NAMES = {"source": "source", "channel": "channel", "record_type": "record_type",
                "created_at_month": "strftime(created_at, '%Y-%m')"}
COHORTS = ",\n".join(["cohorts AS (" + union_sql([f"""
SELECT '{n}' AS cohort_type, {e} AS cohort_value, count(*) AS count, CAST(sum(target) AS BIGINT) AS converted,
  CAST(sum(target) AS DOUBLE) / count(*) AS rate, 100.0 * count(*) / sum(count(*)) OVER () AS pct_total
FROM leads WHERE {e} IS NOT NULL GROUP BY 1, 2""".strip() for n, e in COHORT_NAMES.items()]) + ")"])


def _cohorts(spark, path):
    df = leads(spark, path, "source", "channel", "record_type", "created_at", "target")
    variables = {c: F.col(c) for c in CATEGORICAL} | {"created_at_month": F.date_format("created_at", "yyyy-MM")}
    return D.cohort_analysis(df, variables, "target")


@lead_query("cohort_grouping_sets", COHORTS + """
SELECT cohort_type, cohort_value, count, converted, round(rate, 6) AS rate, round(CAST(pct_total AS DOUBLE), 6) AS pct_total
FROM cohorts""")
def cohort_grouping_sets(spark, path):
    return _cohorts(spark, path)


@lead_query("top_cohorts", COHORTS + """
SELECT cohort_type, cohort_value, round(rate, 6) AS rate, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY cohort_type ORDER BY rate DESC, cohort_value) AS rank
  FROM cohorts WHERE count >= 5) WHERE rank <= 10""")
def top_cohorts(spark, path):
    return D.top_cohorts(_cohorts(spark, path)).select("cohort_type", "cohort_value", "rate", "rank")


PROFILED = ("source", "channel", "record_type", "total_price", "acctbal", "line_cnt", "qty_sum", "disc_avg", "target")


def _profile_sql(c: str) -> str:
    numeric = c not in CATEGORICAL
    stats = ["avg", "stddev_samp", "min", "max", "skewness", "kurtosis"]
    names = ["mean", "std", "min", "max", "skew", "kurtosis"]
    moments = ", ".join(
        f"round(CAST({s}({c}) AS DOUBLE), 3) AS {n}" if numeric else f"CAST(NULL AS DOUBLE) AS {n}" for s, n in zip(stats, names)
    )
    kind = "numeric" if numeric else "categorical"
    top = "CAST(NULL AS VARCHAR)" if numeric else (
        f"(SELECT {c} FROM leads WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)")
    return f"""SELECT '{c}' AS feature, '{kind}' AS dtype, round(1.0 - CAST(count({c}) AS DOUBLE) / count(*), 6) AS na_ratio,
  count(DISTINCT {c}) AS nunique, round(CAST(count(DISTINCT {c}) AS DOUBLE) / count(*), 6) AS unique_ratio, {moments},
  {top} AS top_value, round(CAST((SELECT max(n) FROM (SELECT count(*) AS n FROM leads WHERE {c} IS NOT NULL GROUP BY {c})) AS DOUBLE)
    / count(*), 6) AS top_ratio FROM leads"""


@lead_query("feature_profile", union_sql([_profile_sql(c) for c in PROFILED]),
            mean=3, std=3, min=3, max=3, skew=3, kurtosis=3)
def feature_profile(spark, path):
    out = D.feature_profile(leads(spark, path, *PROFILED), PROFILED)
    return out.withColumn("top_value", F.when(F.col("dtype") == "categorical", F.col("top_value")))


@lead_query("skew_kurtosis", union_sql([f"""
SELECT '{c}' AS feature, round(skewness({c}), 6) AS skew, round(kurtosis({c}), 6) AS kurtosis FROM leads""".strip() for c in NUMERIC]))
def skew_kurtosis(spark, path):
    return D.skew_kurtosis(leads(spark, path, *NUMERIC), NUMERIC)


@lead_query("crosstab", """
SELECT source, count(*) FILTER (target = 0) AS n_0, count(*) FILTER (target = 1) AS n_1 FROM leads GROUP BY source""")
def crosstab(spark, path):
    return D.crosstab(leads(spark, path, "source", "target"), "source", "target")


@lead_query("top_variance", f"""
SELECT feature, round(variance, 2) AS variance FROM ({union_sql([f"SELECT '{c}' AS feature, var_samp({c}) AS variance FROM leads" for c in NUMERIC])})
ORDER BY variance DESC, feature LIMIT 3""", variance=2)
def top_variance(spark, path):
    scaled = leads(spark, path, *NUMERIC)
    return D.top_variance(scaled, NUMERIC, 3)


# ---------------------------------------------------------------- minimum slice, the entry query


@lead_query("split_clean_conversion", """
med AS (SELECT median(qty_sum) AS m FROM train),
filled AS (SELECT split, source, target, coalesce(qty_sum, m) AS qty FROM splits, med),
base AS (SELECT split, avg(target) AS base FROM filled GROUP BY split)
SELECT filled.split, source, count(*) AS count, round(avg(target), 6) AS rate, round(avg(target) / any_value(base), 6) AS lift,
  round(avg(qty), 6) AS mean_qty FROM filled JOIN base ON base.split = filled.split GROUP BY filled.split, source""")
def split_clean_conversion(spark, path):
    """Leak-safe split, train-median fill, conversion and lift per source and set."""
    from winnow.operators.cleaning import BasicCleaner

    df = split_leads(spark, path, "account_id", "created_at", "source", "target", "qty_sum")
    roles = R.ColumnRoles(target="target", group="account_id", time="created_at")
    model = BasicCleaner(outlier_method=None).fit(df.filter("split = 'train'").select("qty_sum"), roles)
    cells = model.transform(df).groupBy("split", "source").agg(
        F.count(F.lit(1)).alias("count"), F.sum("target").alias("y"), F.avg("qty_sum").alias("mean_qty")
    )
    whole = Window.partitionBy("split")  # a handful of rows: one per set and source
    base = F.sum("y").over(whole) / F.sum("count").over(whole)
    return cells.select(
        "split", "source", "count", (F.col("y") / F.col("count")).alias("rate"),
        (F.col("y") / F.col("count") / base).alias("lift"), "mean_qty",
    )
