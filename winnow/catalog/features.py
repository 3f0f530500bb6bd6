"""Feature engineering queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from winnow.catalog.registry import lead_query, query, split_leads, train_of
from winnow.functions import scalar as S
from winnow.operators import features as FE
from winnow.session import stored
from winnow.sources.tables import NUMERIC, leads, table

SOURCES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
WINDOWS = (30, 90, 180)


@lead_query("temporal_parts", """
SELECT lead_id, year(created_at) AS lead_year, month(created_at) AS lead_month, quarter(created_at) AS lead_quarter,
  CAST(week(created_at) AS BIGINT) AS lead_weekofyear, isodow(created_at) - 1 AS lead_weekday,
  CAST(CASE WHEN isodow(created_at) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend FROM leads""")
def temporal_parts(spark, path):
    df = leads(spark, path, "lead_id", "created_at")
    return df.select("lead_id", *S.temporal_parts(F.col("created_at")))


@query("temporal_buckets", """
SELECT event_id, year(ts) AS ts_Year, month(ts) AS ts_Month, day(ts) AS ts_Day, isodow(ts) - 1 AS ts_DayOfWeek,
  quarter(ts) AS ts_Quarter, dayofyear(ts) AS ts_DayOfYear, week(ts) AS ts_WeekOfYear, strftime(ts, '%Y%m') AS ts_YearMonth,
  CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS ts_IsWeekend,
  CAST(CASE WHEN isodow(ts) < 6 THEN 1 ELSE 0 END AS BIGINT) AS ts_IsBusinessDay,
  CASE WHEN month(ts) IN (3,4,5) THEN 'Spring' WHEN month(ts) IN (6,7,8) THEN 'Summer'
    WHEN month(ts) IN (9,10,11) THEN 'Fall' ELSE 'Winter' END AS ts_Season,
  CASE WHEN day(ts) <= day(last_day(ts)) / 3.0 THEN 'Early' WHEN day(ts) <= 2 * day(last_day(ts)) / 3.0 THEN 'Mid'
    ELSE 'Late' END AS ts_MonthPart,
  CASE WHEN hour(ts) < 6 THEN 'Night' WHEN hour(ts) < 12 THEN 'Morning' WHEN hour(ts) < 18 THEN 'Afternoon'
    ELSE 'Evening' END AS ts_DayPart FROM events""")
def temporal_buckets(spark, path):
    return table(spark, path, "events").select("event_id", *S.temporal_buckets(F.col("ts"), "ts"))


@lead_query("parse_yearmonth", """
SELECT lead_id, CASE WHEN day(created_at) <> 13 THEN strftime(date_trunc('month', created_at), '%Y-%m-%d') END AS ym
FROM leads""")
def parse_yearmonth(spark, path):
    """Month and year packed into an integer; day 13 is packed with month 13, which does not parse."""
    t = F.col("created_at")
    packed = F.when(F.dayofmonth(t) == 13, 13).otherwise(F.month(t)) * 10000 + F.year(t)
    return leads(spark, path, "lead_id", "created_at").select("lead_id", S.parse_yearmonth(packed).alias("ym"))


BY_TIME = "PARTITION BY account_id ORDER BY created_at"


@lead_query("cum_leads", f"""
SELECT lead_id, row_number() OVER ({BY_TIME}, lead_id) - 1 AS cum_leads_account FROM leads""")
def cum_leads(spark, path):
    df = leads(spark, path, "lead_id", "account_id", "created_at")
    return FE.account_history(df, "account_id", "created_at", "lead_id").select("lead_id", "cum_leads_account")


@lead_query("days_since_prev", f"""
SELECT lead_id, CAST(coalesce(floor((epoch_us(created_at) - lag(epoch_us(created_at)) OVER ({BY_TIME}, lead_id))
  / 86400000000), -1) AS BIGINT) AS days_since_prev_lead FROM leads""")
def days_since_prev(spark, path):
    df = leads(spark, path, "lead_id", "account_id", "created_at")
    return FE.account_history(df, "account_id", "created_at", "lead_id").select("lead_id", "days_since_prev_lead")


def _frame(days: int) -> str:
    return f"({BY_TIME} RANGE BETWEEN INTERVAL {days} DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"


def _rolling_sql() -> str:
    cells = []
    for w in WINDOWS:
        label = FE.window_label(w)
        cells.append(f'count(*) OVER {_frame(w)} AS "lead_cnt_{label}"')
        cells += [f"""count(*) FILTER (WHERE source = '{s}') OVER {_frame(w)} AS "lead_cnt_{s}_{label}\"""" for s in SOURCES]
    return "SELECT lead_id, " + ",\n  ".join(cells) + " FROM leads"


def _rolling(spark, path):
    df = leads(spark, path, "lead_id", "account_id", "created_at", "source")
    return FE.account_history(df, "account_id", "created_at", "lead_id", WINDOWS, "source", SOURCES)


@lead_query("rolling_counts", _rolling_sql())
def rolling_counts(spark, path):
    out = _rolling(spark, path)
    return out.select("lead_id", *[FE.q(c) for c in out.columns if c.startswith("lead_cnt_")])


@query("rolling_counts_events", """
SELECT event_id, count(*) OVER w1 AS lead_cnt_1D, count(*) OVER w7 AS lead_cnt_7D FROM events
WINDOW w1 AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING),
  w7 AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""")
def rolling_counts_events(spark, path):
    """Sub-day timestamps, few keys."""
    df = table(spark, path, "events").select("event_id", "user_id", "ts")
    return FE.account_history(df, "user_id", "ts", "event_id", (1, 7)).select("event_id", "lead_cnt_1D", "lead_cnt_7D")


@lead_query("rolling_ratios", "r AS (" + _rolling_sql() + ")\nSELECT lead_id, " + ",\n  ".join(
    f"""round(coalesce(CAST("lead_cnt_{s}_{FE.window_label(w)}" AS DOUBLE) / nullif("lead_cnt_{FE.window_label(w)}", 0), 0), 6)
  AS "ratio_{s}_{FE.window_label(w)}\"""" for w in WINDOWS for s in SOURCES) + " FROM r")
def rolling_ratios(spark, path):
    out = FE.source_ratios(_rolling(spark, path), WINDOWS, SOURCES)
    return out.select("lead_id", *[FE.q(c) for c in out.columns if c.startswith("ratio_")])


@lead_query("source_onehot", """
top AS (SELECT source FROM train GROUP BY source HAVING count(*) > 0.01 * (SELECT count(*) FROM train)),
s AS (SELECT lead_id, CASE WHEN source IN (SELECT source FROM top) THEN source ELSE 'Other' END AS src FROM leads)
SELECT lead_id, """ + ", ".join(f"""CAST(CASE WHEN src = '{s}' THEN 1 ELSE 0 END AS BIGINT) AS "is_src_{s}\"""" for s in (*SOURCES, "Other"))
    + " FROM s")
def source_onehot(spark, path):
    df = split_leads(spark, path, "lead_id", "source")
    out = FE.source_onehot(df, "source", FE.top_sources(train_of(df), "source"))
    return out.select("lead_id", *[FE.q(c) for c in out.columns if c.startswith("is_src_")])


@lead_query("freq_encode", """
f AS (SELECT concat(source, '_', channel) AS k, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM train) AS v FROM train GROUP BY 1)
SELECT lead_id, concat(source, '_', channel) AS src_chan_cross, round(coalesce(v, 0), 6) AS src_chan_freq_enc
FROM leads LEFT JOIN f ON k = concat(source, '_', channel)""")
def freq_encode(spark, path):
    df = split_leads(spark, path, "lead_id", "source", "channel").withColumn(
        "src_chan_cross", FE.cross_column("source", "channel")
    )
    state = FE.fit_frequencies(train_of(df), "src_chan_cross", "src_chan_freq_enc")
    return state.transform(df).select("lead_id", "src_chan_cross", "src_chan_freq_enc")


@lead_query("rare_bucket", """
rare AS (SELECT record_type FROM train GROUP BY record_type HAVING count(*) < 430)
SELECT lead_id, CASE WHEN record_type IN (SELECT record_type FROM rare) THEN 'RARE' ELSE record_type END
  AS RecordType_bucketed FROM leads""")
def rare_bucket(spark, path):
    df = split_leads(spark, path, "lead_id", "record_type")
    rare = FE.fit_rare_levels(train_of(df), "record_type", 430)
    return FE.bucket_rare(df, "record_type", rare, "RecordType_bucketed").select("lead_id", "RecordType_bucketed")


@lead_query("account_total_leads", """
t AS (SELECT account_id, count(*) AS n FROM train GROUP BY account_id)
SELECT lead_id, coalesce(n, 0) AS account_total_leads FROM leads LEFT JOIN t USING (account_id)""")
def account_total_leads(spark, path):
    df = split_leads(spark, path, "lead_id", "account_id")
    return FE.fit_account_totals(train_of(df), "account_id").transform(df).select("lead_id", "account_total_leads")


def _daily_sql() -> str:
    day = ", ".join(f"count(*) FILTER (WHERE source = '{s}') AS s{i}" for i, s in enumerate(SOURCES))
    safe = lambda s: s.replace(" ", "_").replace("-", "_")
    cells = ", ".join(
        f"""CAST(sum(s{i}) OVER (ORDER BY d RANGE BETWEEN INTERVAL {w - 1} DAY PRECEDING AND CURRENT ROW) AS BIGINT)
  AS "lead_cnt_{safe(s)}_{FE.window_label(w)}\"""" for w in WINDOWS for i, s in enumerate(SOURCES))
    return f"""dd AS (SELECT CAST(created_at AS DATE) AS d, {day} FROM leads GROUP BY 1),
rolled AS (SELECT d, {cells} FROM dd)
SELECT lead_id, rolled.* EXCLUDE (d) FROM leads JOIN rolled ON d = CAST(created_at AS DATE)"""


@lead_query("rolling_daily_by_source", _daily_sql())
def rolling_daily_by_source(spark, path):
    df = leads(spark, path, "lead_id", "created_at", "source")
    out = FE.rolling_daily_by_source(df, "created_at", "source", FE.levels(df, "source"), WINDOWS)
    return out.drop("created_at", "source")


def _ratio_sql(a: str, b: str) -> str:
    return (f"round(CASE WHEN {a} IS NULL OR {b} IS NULL THEN 0 ELSE least(greatest(CAST({a} AS DOUBLE) / (CASE WHEN {b} = 0 THEN 1e-8::DOUBLE ELSE CAST({b} AS DOUBLE) END + 1e-8::DOUBLE),"
            f" -1e6::DOUBLE), 1e6::DOUBLE) END, 4) + 0 AS {a}_DIV_{b}")


@lead_query("pairwise_ratios", "SELECT lead_id, " + ",\n ".join(_ratio_sql(a, b) for a, b in combinations(NUMERIC, 2)) + " FROM leads", digits=4)
def pairwise_ratios(spark, path):
    out = FE.pairwise_ratios(leads(spark, path, "lead_id", *NUMERIC), NUMERIC)
    return out.select("lead_id", *[c for c in out.columns if "_DIV_" in c])


@lead_query("pairwise_products", "SELECT lead_id, " + ",\n ".join(
    f"round(CASE WHEN {a} IS NULL OR {b} IS NULL THEN 0 ELSE least(greatest(CAST({a} AS DOUBLE) * {b}, -1e9::DOUBLE), 1e9::DOUBLE) END, 6) + 0 AS {a}_X_{b}"
    for a, b in combinations(NUMERIC, 2)) + " FROM leads", digits=6)
def pairwise_products(spark, path):
    out = FE.pairwise_products(leads(spark, path, "lead_id", *NUMERIC), NUMERIC)
    return out.select("lead_id", *[c for c in out.columns if "_X_" in c])


@lead_query("robust_scale", "f AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in NUMERIC) + " FROM train),\nfilled AS (SELECT lead_id, split, "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in NUMERIC) + " FROM splits, f),\nst AS (SELECT "
    + ", ".join(f"median({c}) AS c_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}" for c in NUMERIC)
    + " FROM filled WHERE split = 'train')\nSELECT lead_id, " + ", ".join(f"round(({c} - c_{c}) / s_{c}, 6) + 0 AS {c}_scaled" for c in NUMERIC)
    + " FROM filled, st")
def robust_scale(spark, path):
    df = stored(split_leads(spark, path, "lead_id", *NUMERIC), "leads")
    out = FE.fit_robust_scale(train_of(df), NUMERIC).transform(df)
    return out.select("lead_id", *[f"{c}_scaled" for c in NUMERIC])


@lead_query("onehot", "SELECT lead_id, " + ", ".join(
    f"""CAST(CASE WHEN source = '{s}' THEN 1 ELSE 0 END AS BIGINT) AS "source_{s}\"""" for s in SOURCES) + " FROM leads")
def onehot(spark, path):
    df = split_leads(spark, path, "lead_id", "source")
    out = FE.onehot(df, "source", FE.levels(train_of(df), "source"))
    return out.select("lead_id", *[FE.q(c) for c in out.columns if c.startswith("source_")])


@lead_query("target_encode", """
p AS (SELECT avg(target) AS prior FROM train),
t AS (SELECT record_type, (sum(target) + 10.0::DOUBLE * any_value(prior)) / (count(*) + 10.0::DOUBLE) AS te FROM train, p GROUP BY record_type)
SELECT lead_id, record_type, round(coalesce(te, prior), 6) AS record_type_te FROM leads LEFT JOIN t USING (record_type), p""")
def target_encode(spark, path):
    df = split_leads(spark, path, "lead_id", "record_type", "target")
    state = FE.fit_target_encoding(train_of(df), "record_type", "target")
    return state.transform(df).select("lead_id", "record_type", "record_type_te")


HOT = "(PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL {} DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"


@query("rolling_counts_hot", f"""
SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS cum_leads_account,
  count(*) OVER {HOT.format(1)} AS lead_cnt_1D, count(*) OVER {HOT.format(7)} AS lead_cnt_7D FROM events""")
def rolling_counts_hot(spark, path):
    """A handful of keys holding everything: each is cut into time buckets, none is one task."""
    df = table(spark, path, "events").select("event_id", "event_type", "ts")
    out = FE.account_history(df, "event_type", "ts", "event_id", (1, 7), task_rows=1000)
    return out.select("event_id", "cum_leads_account", "lead_cnt_1D", "lead_cnt_7D")
