"""Splits, folds and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from winnow.catalog.registry import TRAIN_CUTOFF, VAL_CUTOFF, cut_small, lead_query, split_leads, train_of
from winnow.operators import splits as SP
from winnow.operators.cleaning import BasicCleaner
from winnow.roles import ColumnRoles
from winnow.session import stored
from winnow.sources.tables import leads

TEST_CUTOFF = "1997-12-31"
ROLES = ColumnRoles(target="target", group="account_id", time="created_at", ids=("lead_id",))


# ---------------------------------------------------------------- splits


@lead_query("time_group_split", "SELECT lead_id, account_id, split FROM splits")
def time_group_split(spark, path):
    return split_leads(spark, path, "lead_id", "account_id").select("lead_id", "account_id", "split")


@lead_query("time_split", f"""
SELECT lead_id, CASE WHEN created_at <= TIMESTAMP '{TRAIN_CUTOFF}' THEN 'train'
  WHEN created_at <= TIMESTAMP '{VAL_CUTOFF}' THEN 'validation' ELSE 'test' END AS split
FROM leads WHERE created_at <= TIMESTAMP '{TEST_CUTOFF}'""")
def time_split(spark, path):
    df = leads(spark, path, "lead_id", "created_at")
    return SP.time_split(df, "created_at", TRAIN_CUTOFF, VAL_CUTOFF, TEST_CUTOFF).select("lead_id", "split")


STRATUM = """CASE WHEN rate <= 0 THEN 0 WHEN rate <= 0.2 THEN 1 WHEN rate <= 0.4 THEN 2 WHEN rate <= 0.6 THEN 3
  WHEN rate <= 0.8 THEN 4 ELSE 5 END"""
DIGEST = "substr(md5(concat(account_id, '|42')), 1, 13)"


@lead_query("stratified_group_split", f"""
g AS (SELECT account_id, avg(target) AS rate FROM leads GROUP BY account_id),
r AS (SELECT account_id, {STRATUM} AS stratum FROM g),
o AS (SELECT account_id, row_number() OVER (PARTITION BY stratum ORDER BY {DIGEST}, account_id) - 1 AS pos,
  count(*) OVER (PARTITION BY stratum) AS n FROM r),
l AS (SELECT account_id, CASE WHEN pos < floor(n * 0.2 + 0.5) THEN 'test'
  WHEN pos < floor(n * 0.2 + 0.5) + floor(n * 0.15 + 0.5) THEN 'validation' ELSE 'train' END AS split FROM o)
SELECT lead_id, split FROM leads JOIN l USING (account_id)""")
def stratified_group_split(spark, path):
    df = leads(spark, path, "lead_id", "account_id", "target")
    return SP.stratified_group_split(df, "account_id", "target").select("lead_id", "split")


@lead_query("date_based_split", """
f AS (SELECT account_id, min(CASE WHEN created_at <= TIMESTAMP '1995-06-30' THEN 0
    WHEN created_at > TIMESTAMP '1995-09-30' AND created_at <= TIMESTAMP '1996-03-31' THEN 1
    WHEN created_at > TIMESTAMP '1996-06-30' AND created_at <= TIMESTAMP '2000-12-31' THEN 2 END) AS p
  FROM leads GROUP BY account_id)
SELECT lead_id, CASE p WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END AS split
FROM leads JOIN f USING (account_id) WHERE p IS NOT NULL""")
def date_based_split(spark, path):
    df = leads(spark, path, "lead_id", "account_id", "created_at")
    return SP.date_based_split(
        df, "created_at", "account_id", "1995-06-30", "1995-09-30", "1996-03-31", "1996-06-30", "2000-12-31"
    ).select("lead_id", "split")


TAIL = """CASE WHEN pos >= n - floor(n * 0.2) THEN 'test'
  WHEN pos >= n - floor(n * 0.2) - floor(n * 0.15) THEN 'validation' ELSE 'train' END"""


@lead_query("percentage_split", f"""
g AS (SELECT account_id, max(created_at) AS last FROM leads GROUP BY account_id),
o AS (SELECT account_id, row_number() OVER (ORDER BY last, account_id) - 1 AS pos, count(*) OVER () AS n FROM g)
SELECT lead_id, {TAIL} AS split FROM leads JOIN o USING (account_id)""")
def percentage_split(spark, path):
    df = leads(spark, path, "lead_id", "account_id", "created_at")
    return SP.percentage_split(df, "created_at", "account_id").select("lead_id", "split")


@lead_query("percentage_split_text_ids", f"""
g AS (SELECT 'acc-' || account_id AS account_id, max(created_at) AS last FROM leads GROUP BY account_id),
o AS (SELECT account_id, row_number() OVER (ORDER BY last, account_id) - 1 AS pos, count(*) OVER () AS n FROM g)
SELECT lead_id, {TAIL} AS split FROM leads JOIN o ON o.account_id = 'acc-' || leads.account_id""")
def percentage_split_text_ids(spark, path):
    """Text accounts, the order of accounts cut into buckets."""
    df = leads(spark, path, "lead_id", "account_id", "created_at").withColumn("account_id", F.concat(F.lit("acc-"), F.col("account_id").cast("string")))
    with cut_small(spark, 100):
        return SP.percentage_split(df, "created_at", "account_id").select("lead_id", "split")


@lead_query("percentage_split_rows", f"""
o AS (SELECT lead_id, row_number() OVER (ORDER BY created_at, lead_id) - 1 AS pos, count(*) OVER () AS n FROM leads)
SELECT lead_id, {TAIL} AS split FROM o""")
def percentage_split_rows(spark, path):
    df = leads(spark, path, "lead_id", "created_at")
    return SP.percentage_split(df, "created_at", "lead_id", grouped=False).select("lead_id", "split")


@lead_query("group_kfold", f"""
g AS (SELECT account_id, avg(target) AS rate, count(*) AS c FROM leads GROUP BY account_id),
r AS (SELECT account_id, {STRATUM} * 5 + CASE WHEN c <= 1 THEN 0 WHEN c <= 4 THEN 1 WHEN c <= 16 THEN 2
  WHEN c <= 64 THEN 3 ELSE 4 END AS stratum FROM g),
o AS (SELECT account_id, row_number() OVER (PARTITION BY stratum ORDER BY {DIGEST}, account_id) - 1 AS pos FROM r)
SELECT lead_id, pos % 5 AS fold FROM leads JOIN o USING (account_id)""")
def group_kfold(spark, path):
    df = leads(spark, path, "lead_id", "account_id", "target")
    return SP.group_kfold(df, "account_id", "target").select("lead_id", "fold")


@lead_query("group_kfold_cut", f"""
g AS (SELECT account_id, avg(target) AS rate, count(*) AS c FROM leads GROUP BY account_id),
r AS (SELECT account_id, {STRATUM} * 5 + CASE WHEN c <= 1 THEN 0 WHEN c <= 4 THEN 1 WHEN c <= 16 THEN 2
  WHEN c <= 64 THEN 3 ELSE 4 END AS stratum FROM g),
o AS (SELECT account_id, row_number() OVER (PARTITION BY stratum ORDER BY {DIGEST}, account_id) - 1 AS pos FROM r)
SELECT lead_id, pos % 5 AS fold FROM leads JOIN o USING (account_id)""")
def group_kfold_cut(spark, path):
    """The same folds where the order of accounts is cut into buckets."""
    with cut_small(spark, 100):
        return group_kfold(spark, path)


@lead_query("row_kfold", """
SELECT lead_id, CAST('0x' || substr(md5(concat(lead_id, '|42')), 1, 8) AS BIGINT) % 5 AS fold FROM leads""")
def row_kfold(spark, path):
    return SP.row_kfold(leads(spark, path, "lead_id"), "lead_id").select("lead_id", "fold")


@lead_query("stratified_row_kfold", """
SELECT lead_id, (row_number() OVER (PARTITION BY target
  ORDER BY substr(md5(concat(lead_id, '|42')), 1, 13), lead_id) - 1) % 5 AS fold FROM leads""")
def stratified_row_kfold(spark, path):
    df = leads(spark, path, "lead_id", "target")
    return SP.stratified_row_kfold(df, "lead_id", "target").select("lead_id", "fold")


@lead_query("force_balance", f"""
g AS (SELECT account_id, min(created_at) AS first FROM leads GROUP BY account_id),
s AS (SELECT *, CASE WHEN first <= TIMESTAMP '{TRAIN_CUTOFF}' THEN 'train' ELSE 'validation' END AS split FROM g),
o AS (SELECT account_id, split, row_number() OVER (PARTITION BY split ORDER BY first, account_id) - 1 AS pos,
  count(*) OVER (PARTITION BY split) AS n FROM s)
SELECT lead_id, CASE WHEN split = 'validation' AND pos >= n - ceil(0.1 * n) THEN 'test' ELSE split END AS split
FROM leads JOIN o USING (account_id)""")
def force_balance(spark, path):
    """The validation cutoff lies after the last lead, so the test set has to be filled."""
    df = leads(spark, path, "lead_id", "account_id", "created_at")
    out = SP.time_group_split(df, "created_at", "account_id", TRAIN_CUTOFF, "2010-01-01", force_balance=True)
    return out.select("lead_id", "split")


@lead_query("split_report", """
SELECT split, count(*) AS rows, count(DISTINCT account_id) AS groups, round(avg(target), 6) AS target_rate,
  strftime(min(created_at), '%Y-%m-%d %H:%M:%S') AS first_time, strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS last_time
FROM splits GROUP BY split""")
def split_report(spark, path):
    df = split_leads(spark, path, "account_id", "created_at", "target")
    return SP.split_report(df, "account_id", "target", "created_at")


# ---------------------------------------------------------------- cleaning

CLEANED = ("total_price", "acctbal", "line_cnt", "qty_sum", "disc_avg")
DIGITS = {"total_price": 2, "acctbal": 2, "line_cnt": 4, "qty_sum": 4, "disc_avg": 6}


def _clean(spark, path, **options):
    df = stored(split_leads(spark, path, "lead_id", *CLEANED), "leads")
    model = BasicCleaner(**options).fit(train_of(df).select(*CLEANED), ROLES)
    return model.transform(df).select("lead_id", *CLEANED)


def _fill_sql(fill: str, bounds: str | None) -> str:
    stats, cells = [], []
    for c in CLEANED:
        stats.append(f"{fill.format(c=c)} AS f_{c}")
        value = f"coalesce(CAST({c} AS DOUBLE), f_{c})"
        if bounds:
            low, high = (b.format(c=c) for b in bounds.split("|"))
            stats += [f"{low} AS lo_{c}", f"{high} AS hi_{c}"]
            cut = "trunc" if c == "line_cnt" else ""
            value = f"least(greatest({value}, {cut}(lo_{c})), {cut}(hi_{c}))"
        cells.append(f"round({value}, {DIGITS[c]}) AS {c}")
    cells = [x.replace("CAST(line_cnt AS DOUBLE)", "line_cnt::DOUBLE") for x in cells]
    return f"st AS (SELECT {', '.join(stats)} FROM train)\nSELECT lead_id, {', '.join(cells)} FROM splits, st"


IQR = "quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
IQR_HIGH = "quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"


@lead_query("impute_median", _fill_sql("median({c})", None), **DIGITS)
def impute_median(spark, path):
    return _clean(spark, path, outlier_method=None).withColumn("line_cnt", F.col("line_cnt").cast("double"))


@lead_query("impute_mean", _fill_sql("avg({c})", None), **DIGITS)
def impute_mean(spark, path):
    return _clean(spark, path, num_fill="mean", outlier_method=None).withColumn("line_cnt", F.col("line_cnt").cast("double"))


@lead_query("clip_zscore", _fill_sql("median({c})", "avg({c}) - 3 * stddev_samp({c})|avg({c}) + 3 * stddev_samp({c})"), **DIGITS)
def clip_zscore(spark, path):
    return _clean(spark, path, outlier_method="zscore")


@lead_query("clip_iqr", _fill_sql("median({c})", f"{IQR}|{IQR_HIGH}"), **DIGITS)
def clip_iqr(spark, path):
    return _clean(spark, path, outlier_method="iqr")


@lead_query("winsorize", _fill_sql("median({c})", "quantile_cont({c}, 0.01)|quantile_cont({c}, 0.99)"), **DIGITS)
def winsorize(spark, path):
    return _clean(spark, path, outlier_method="winsorize")


def _holed(spark, path):
    """Leads whose source is missing where it reads 2-HIGH, and channel where it reads MACHINERY."""
    df = split_leads(spark, path, "lead_id", "source", "channel")
    return df.withColumn("source", F.when(F.col("source") != "2-HIGH", F.col("source"))).withColumn(
        "channel", F.when(F.col("channel") != "MACHINERY", F.col("channel"))
    )


HOLED = """h AS (SELECT lead_id, split, CASE WHEN source <> '2-HIGH' THEN source END AS source,
  CASE WHEN channel <> 'MACHINERY' THEN channel END AS channel FROM splits)"""


def _mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM h WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@lead_query("mode_fill", f"""{HOLED}
SELECT lead_id, coalesce(source, {_mode_sql('source')}) AS source, coalesce(channel, {_mode_sql('channel')}) AS channel FROM h""")
def mode_fill(spark, path):
    df = _holed(spark, path)
    model = BasicCleaner(outlier_method=None).fit(train_of(df).select("source", "channel"), ROLES)
    return model.transform(df).select("lead_id", "source", "channel")


@lead_query("impute_constant", f"""{HOLED}
SELECT lead_id, coalesce(source, 'missing') AS source, coalesce(channel, 'missing') AS channel FROM h""")
def impute_constant(spark, path):
    df = _holed(spark, path)
    model = BasicCleaner(cat_fill="missing", outlier_method=None).fit(train_of(df).select("source", "channel"), ROLES)
    return model.transform(df).select("lead_id", "source", "channel")
