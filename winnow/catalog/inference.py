"""Statistical tests and feature selection."""

from __future__ import annotations

from itertools import combinations

from winnow.catalog.registry import union_sql
from winnow.catalog.registry import lead_query
from winnow.operators import stat_tests as ST
from winnow.sources.tables import CATEGORICAL, NUMERIC, leads


def _chi_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, round(CASE WHEN dof = 1 THEN yates ELSE plain END, 4) AS chi2, dof, n FROM (
  SELECT sum(pow(o - e, 2) / e) AS plain, sum(pow(abs(o - e) - least(abs(o - e), 0.5), 2) / e) AS yates,
    (count(DISTINCT cat) - 1) * (count(DISTINCT y) - 1) AS dof, CAST(sum(o) AS BIGINT) AS n FROM (
    SELECT r.cat, k.y, coalesce(x.o, 0) AS o, r.r * k.k / CAST(t.t AS DOUBLE) AS e
    FROM (SELECT {c} AS cat, count(*) AS r FROM leads GROUP BY 1) r CROSS JOIN (SELECT target AS y, count(*) AS k FROM leads GROUP BY 1) k
    CROSS JOIN (SELECT count(*) AS t FROM leads) t
    LEFT JOIN (SELECT {c} AS cat, target AS y, count(*) AS o FROM leads GROUP BY 1, 2) x ON x.cat = r.cat AND x.y = k.y))"""


@lead_query("chi_square", "u AS (SELECT *, CASE WHEN source = '1-URGENT' THEN 'yes' ELSE 'no' END AS urgent FROM leads)\n"
            + union_sql([_chi_sql(c).replace("FROM leads", "FROM u") for c in (*CATEGORICAL, "urgent")]), chi2=4)
def chi_square(spark, path):
    """Three many-valued columns and a binary one, which takes the corrected form."""
    from pyspark.sql import functions as F

    df = leads(spark, path, *CATEGORICAL, "target").withColumn(
        "urgent", F.when(F.col("source") == "1-URGENT", "yes").otherwise("no")
    )
    return ST.chi_square(df, [*CATEGORICAL, "urgent"], "target").select("feature", "chi2", "dof", "n")


def _t_sql(c: str, equal: bool) -> str:
    if equal:
        square, dof = "((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb)", "na + nb - 2"
    else:
        square, dof = "va / na + vb / nb", "pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1))"
    return f"""SELECT '{c}' AS feature, CAST(na AS BIGINT) AS n_a, CAST(nb AS BIGINT) AS n_b, round(ma, 3) AS mean_a, round(mb, 3) AS mean_b,
  round((ma - mb) / sqrt({square}), 6) AS t, round({dof}, 3) AS dof FROM (SELECT
  CAST(count({c}) FILTER (target = 0) AS DOUBLE) AS na, CAST(count({c}) FILTER (target = 1) AS DOUBLE) AS nb,
  avg({c}) FILTER (target = 0) AS ma, avg({c}) FILTER (target = 1) AS mb,
  var_samp({c}) FILTER (target = 0) AS va, var_samp({c}) FILTER (target = 1) AS vb FROM leads)"""


T_COLUMNS = ("feature", "n_a", "n_b", "mean_a", "mean_b", "t", "dof")


@lead_query("ttest_welch", union_sql([_t_sql(c, False) for c in NUMERIC]), mean_a=3, mean_b=3, dof=3)
def ttest_welch(spark, path):
    return ST.t_test(leads(spark, path, "target", *NUMERIC), NUMERIC, "target").select(*T_COLUMNS)


@lead_query("ttest_student", union_sql([_t_sql(c, True) for c in NUMERIC]), mean_a=3, mean_b=3, dof=3)
def ttest_student(spark, path):
    return ST.t_test(leads(spark, path, "target", *NUMERIC), NUMERIC, "target", equal_var=True).select(*T_COLUMNS)


def _anova_sql(c: str, cells: str) -> str:
    return f"""SELECT {cells} FROM (
  SELECT '{c}' AS feature, count(*) AS groups, CAST(sum(n) AS BIGINT) AS n, sum(n * pow(m - g, 2)) AS ssb, sum((n - 1) * coalesce(v, 0)) AS ssw
  FROM (SELECT source, count({c}) AS n, avg({c}) AS m, var_samp({c}) AS v FROM leads WHERE {c} IS NOT NULL GROUP BY source),
    (SELECT avg({c}) AS g FROM leads))"""


F_STAT = "round((ssb / (groups - 1)) / (ssw / (n - groups)), 6)"


@lead_query("anova", union_sql([_anova_sql(c, f"feature, groups, n, {F_STAT} AS f, CAST(groups - 1 AS DOUBLE) AS df_between, CAST(n - groups AS DOUBLE) AS df_within") for c in NUMERIC]))
def anova(spark, path):
    return ST.anova(leads(spark, path, "source", *NUMERIC), NUMERIC, "source").drop("p_value", "significant")


@lead_query("ttest_redirect", union_sql([_anova_sql(
    c, f"'anova' AS test, feature, {F_STAT} AS statistic, CAST(groups - 1 AS DOUBLE) AS df1, CAST(n - groups AS DOUBLE) AS df2") for c in NUMERIC]))
def ttest_redirect(spark, path):
    """Five sources: a requested t test becomes ANOVA."""
    return ST.compare_means(leads(spark, path, "source", *NUMERIC), NUMERIC, "source").drop("p_value", "significant")


@lead_query("conversion_rate_z", union_sql([f"""
SELECT '{c}' AS feature, {c} AS category, n, x AS converted, round(x / CAST(n AS DOUBLE), 6) AS rate, round(p, 6) AS overall_rate,
  round(x / CAST(n AS DOUBLE) - p, 6) AS diff, CASE WHEN n >= 30 THEN round((x / CAST(n AS DOUBLE) - p)
    / sqrt(((x + xx) / CAST(n + nn AS DOUBLE)) * (1 - (x + xx) / CAST(n + nn AS DOUBLE)) * (1.0::DOUBLE / n + 1.0::DOUBLE / nn)), 6) END AS z
FROM (SELECT {c}, count(*) AS n, CAST(sum(target) AS BIGINT) AS x FROM leads GROUP BY 1),
  (SELECT count(*) AS nn, sum(target) AS xx, avg(target) AS p FROM leads)""".strip() for c in CATEGORICAL]))
def conversion_rate_z(spark, path):
    return ST.conversion_rates(leads(spark, path, "target", *CATEGORICAL), CATEGORICAL, "target").drop("p_value", "significant")


def _corr_sql(table: str = "leads") -> str:
    return union_sql([f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r FROM {table}" for a, b in combinations(NUMERIC, 2)])


ROUND_R = "SELECT feature_a, feature_b, round(r, 6) AS r FROM ("


@lead_query("corr_pearson", ROUND_R + _corr_sql() + ")")
def corr_pearson(spark, path):
    return ST.pearson(leads(spark, path, *NUMERIC), NUMERIC)


@lead_query("corr_pearson_matrix", ROUND_R + _corr_sql() + ")")
def corr_pearson_matrix(spark, path):
    """The same table from one matrix of sums, the form used for many columns."""
    from winnow.operators.kernels import pairwise_corr

    return pairwise_corr(leads(spark, path, *NUMERIC), list(combinations(NUMERIC, 2)), few=0)


@lead_query("top_target_matrix", """
c AS (SELECT * FROM (VALUES """ + ", ".join(f"('{c}', (SELECT abs(corr({c}, target)) FROM leads))" for c in (*NUMERIC, "score")) + """) AS v(feature, r)
  ORDER BY r DESC, feature LIMIT 3)
SELECT feature_a, feature_b, round(r, 6) AS r FROM (SELECT least(a.feature, b.feature) AS x, greatest(a.feature, b.feature) AS y FROM c a, c b
  WHERE a.feature < b.feature) p JOIN (""" + union_sql([f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r FROM leads"
    for a, b in combinations((*NUMERIC, "score"), 2)]) + """) m ON x = least(feature_a, feature_b) AND y = greatest(feature_a, feature_b)""")
def top_target_matrix(spark, path):
    from pyspark.sql import functions as F

    columns = (*NUMERIC, "score")
    out = ST.top_target_matrix(leads(spark, path, "target", *columns), columns, "target", 3)
    # names in the order of the column list
    order = F.array(*[F.lit(c) for c in columns])
    swap = F.array_position(order, F.col("feature_a")) > F.array_position(order, F.col("feature_b"))
    return out.select(
        F.when(swap, F.col("feature_b")).otherwise(F.col("feature_a")).alias("feature_a"),
        F.when(swap, F.col("feature_a")).otherwise(F.col("feature_b")).alias("feature_b"), "r",
    )


@lead_query("high_corr_pairs", f"SELECT * FROM ({ROUND_R}{_corr_sql()})) WHERE abs(r) >= 0.05")
def high_corr_pairs(spark, path):
    return ST.high_corr_pairs(ST.pearson(leads(spark, path, *NUMERIC), NUMERIC))


@lead_query("target_corr", "SELECT feature, round(r, 6) AS r FROM (" + union_sql(
    [f"SELECT '{c}' AS feature, corr({c}, target) AS r FROM leads" for c in (*NUMERIC, "score")]) + ") WHERE abs(r) >= 0.005")
def target_corr(spark, path):
    df = leads(spark, path, "target", "score", *NUMERIC)
    return ST.target_correlations(df, (*NUMERIC, "score"), "target", 0.005)


def _rank(c: str) -> str:
    return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE"


@lead_query("corr_spearman", union_sql([f"""
SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr(x, y), 6) AS r FROM (
  SELECT {_rank(a)} AS x, {_rank(b)} AS y FROM leads WHERE {a} IS NOT NULL AND {b} IS NOT NULL)""".strip() for a, b in combinations(NUMERIC, 2)]))
def corr_spearman(spark, path):
    return ST.spearman(leads(spark, path, "lead_id", *NUMERIC), NUMERIC, "lead_id")


KENDALL = ("total_price", "acctbal", "qty_sum")


def _kendall_cell(a: str, b: str) -> str:
    both = f"p.{a} IS NOT NULL AND p.{b} IS NOT NULL AND q.{a} IS NOT NULL AND q.{b} IS NOT NULL"
    s = f"sign(p.{a} - q.{a})", f"sign(p.{b} - q.{b})"
    return (f"sum({s[0]} * {s[1]}) FILTER ({both}) / sqrt(CAST(count(*) FILTER ({both} AND p.{a} <> q.{a}) AS DOUBLE))"
            f" / sqrt(CAST(count(*) FILTER ({both} AND p.{b} <> q.{b}) AS DOUBLE)) AS {a}__{b}")


@lead_query("corr_kendall", "t AS MATERIALIZED (SELECT " + ", ".join(KENDALL) + " FROM leads),\npairs AS (SELECT "
            + ",\n ".join(_kendall_cell(a, b) for a, b in combinations(KENDALL, 2)) + " FROM t p, t q)\n"
            + union_sql([f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round({a}__{b}, 6) AS r FROM pairs" for a, b in combinations(KENDALL, 2)]))
def corr_kendall(spark, path):
    """All rows: stripes of bounded size, no pair written out."""
    return ST.kendall(leads(spark, path, *KENDALL), KENDALL)
