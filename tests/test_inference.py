"""Statistical tests and metrics: hand-computed and tabulated values."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from winnow.functions import dist
from winnow.operators import evaluation as E
from winnow.operators import stat_tests as ST
from winnow.operators.calibration import binwise_metrics, segment_order


def test_tail_probabilities_against_tables():
    close = lambda a, b: abs(a - b) < 5e-5
    assert close(dist.norm_two_sided(1.959964), 0.05) and close(dist.norm_two_sided(2.575829), 0.01)
    assert close(dist.chi2_tail(3.841459, 1), 0.05) and close(dist.chi2_tail(18.307038, 10), 0.05) and close(dist.chi2_tail(2.558212, 10), 0.99)
    assert close(dist.t_two_sided(2.228139, 10), 0.05) and close(dist.t_two_sided(12.706205, 1), 0.05)
    assert close(dist.f_tail(4.964603, 1, 10), 0.05) and close(dist.f_tail(3.325835, 5, 10), 0.05)
    assert dist.chi2_tail(0.0, 3) == 1.0 and dist.t_two_sided(0.0, 5) == 1.0


@pytest.mark.parametrize("args", [(0.3, 1), (5.0, 3), (40.0, 7)])
def test_tails_agree_with_the_jvm_library(spark, args):
    x, k = args
    lib = spark.sparkContext._jvm.org.apache.commons.math3.distribution
    assert abs(dist.chi2_tail(x, k) - (1 - lib.ChiSquaredDistribution(float(k)).cumulativeProbability(x))) < 1e-12
    assert abs(dist.t_two_sided(x, k) - 2 * lib.TDistribution(float(k)).cumulativeProbability(-x)) < 1e-12
    assert abs(dist.f_tail(x, k, 9) - (1 - lib.FDistribution(float(k), 9.0).cumulativeProbability(x))) < 1e-12


def test_yates_by_hand(spark):
    """[[10, 20], [30, 40]]: chi2 with correction is n(|ad-bc| - n/2)^2 / (r1 r2 c1 c2)."""
    rows = [("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 30 + [("b", 1)] * 40 + [(None, 1)] * 5
    out = ST.chi_square(spark.createDataFrame(rows, "g string, y int"), ["g"], "y").first()
    assert out["dof"] == 1 and out["n"] == 100
    assert out["chi2"] == pytest.approx(100 * (abs(10 * 40 - 20 * 30) - 50) ** 2 / (30 * 70 * 40 * 60))
    assert out["p_value"] == pytest.approx(dist.chi2_tail(out["chi2"], 1)) and not out["significant"]


def test_chi_square_with_empty_cells(spark):
    rows = [("a", 0)] * 12 + [("b", 1)] * 8 + [("c", 0)] * 5 + [("c", 1)] * 5
    out = ST.chi_square(spark.createDataFrame(rows, "g string, y int"), ["g"], "y").first()
    obs = np.array([[12, 0], [0, 8], [5, 5]], float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0) / obs.sum()
    assert out["dof"] == 2 and out["chi2"] == pytest.approx(((obs - exp) ** 2 / exp).sum()) and out["significant"]


def test_constant_category_gives_no_test(spark):
    assert ST.chi_square(spark.createDataFrame([("a", 0), ("a", 1)], "g string, y int"), ["g"], "y").count() == 0


def test_t_anova_redirect(spark):
    rng = np.random.default_rng(42)
    pdf = pd.DataFrame({"x": np.r_[rng.normal(10, 2, 100), rng.normal(12, 2, 100)], "two": ["Group1"] * 100 + ["Group2"] * 100,
                        "four": list("ABCD") * 50})
    pdf["z"] = pdf["four"].map({"A": 10, "B": 11, "C": 13, "D": 15}) + rng.normal(size=200)
    df = spark.createDataFrame(pdf)
    t = ST.t_test(df, ["x"], "two").first()
    a, b = pdf["x"][:100], pdf["x"][100:]
    want = (a.mean() - b.mean()) / math.sqrt(a.var() / 100 + b.var() / 100)
    assert t["t"] == pytest.approx(want) and t["significant"] and (t["n_a"], t["n_b"]) == (100, 100)
    student = ST.t_test(df, ["x"], "two", equal_var=True).first()
    f = ST.anova(df, ["x"], "two").first()
    assert student["t"] ** 2 == pytest.approx(f["f"]) and student["p_value"] == pytest.approx(f["p_value"])
    assert ST.t_test(df, ["z"], "four").count() == 0
    redirected = ST.compare_means(df, ["z"], "four").first()
    assert redirected["test"] == "anova" and redirected["significant"]
    assert ST.compare_means(df, ["x"], "two").first()["test"] == "ttest"
    assert ST.choose_groups(df, ["two", "four"], "two") == {"ttest": "two", "anova": "four"}


def test_rates_against_overall(spark):
    rows = [("big", int(i < 30)) for i in range(50)] + [("rest", int(i < 20)) for i in range(100)] + [("few", 1)] * 10
    out = {r["category"]: r for r in ST.conversion_rates(spark.createDataFrame(rows, "c string, y int"), ["c"], "y").collect()}
    pooled = (30 + 60) / (50 + 160)
    want = (30 / 50 - 60 / 160) / math.sqrt(pooled * (1 - pooled) * (1 / 50 + 1 / 160))
    assert out["big"]["z"] == pytest.approx(want) and out["big"]["significant"]
    assert out["few"]["z"] is None and out["few"]["rate"] == 1.0


def test_constant_columns_have_no_correlation(spark):
    df = spark.createDataFrame([(float(i), 5.0, None if i < 3 else 1.0 * i) for i in range(9)], "a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in ST.pearson(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] is None and got["b", "c"] is None and got["a", "c"] == pytest.approx(1.0)
    assert ST.kendall_pair(df, "a", "b") is None
    assert ST.high_corr_pairs(ST.pearson(df, ["a", "b", "c"]), 0.5).count() == 1


# ---------------------------------------------------------------- metrics


def scores(spark, rows):
    return spark.createDataFrame([(i, float(p), int(y)) for i, (p, y) in enumerate(rows)], "id long, score double, label int")


def test_ties_in_auc_and_average_precision(spark):
    df = scores(spark, [(0.9, 1), (0.8, 1), (0.8, 0), (0.8, 0), (0.3, 1), (0.1, 0)])
    # pairs: 0.9 beats 3; 0.8 ties 2, beats 1; 0.3 beats 1, loses 2
    assert E.auc(df, "score", "label").first()[0] == pytest.approx((3 + 2 * 0.5 + 1 + 1) / 9)
    # thresholds 0.9, 0.8, 0.3: recall steps 1/3 each, precision 1, 2/4, 3/5
    assert E.average_precision(df, "score", "label").first()[0] == pytest.approx((1 + 0.5 + 0.6) / 3)
    assert E.ks(df, "score", "label").first()[0] == pytest.approx(1 / 3)


@pytest.mark.parametrize("task_rows", [30, 100_000])
def test_curve_is_the_same_in_pieces(spark, task_rows):
    rng = np.random.default_rng(1)
    s = np.where(np.arange(900) % 3 == 0, 0.5, rng.random(900).round(3))
    y = (rng.random(900) < s).astype(int)
    df = scores(spark, zip(s, y)).repartition(5)
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert E.auc(df, "score", "label", task_rows=task_rows).first()[0] == pytest.approx(want, abs=1e-12)


def test_one_class_and_empty_input(spark):
    one = scores(spark, [(0.2, 1), (0.4, 1)])
    assert E.auc(one, "score", "label").first()[0] is None
    assert E.average_precision(one, "score", "label").first()[0] == 1.0
    empty = one.filter("id > 5")
    assert E.auc(empty, "score", "label").first()[0] is None and E.brier(empty, "score", "label").first()[0] is None
    seg = E.segment_metrics(one.withColumn("s", F.lit("Low")), "score", "label", "s").collect()
    assert {r["segment"] for r in seg} == {"Low", "ALL"} and all(r["auc"] is None for r in seg)


def test_lift_breaks_ties_by_id(spark):
    df = scores(spark, [(0.5, 0), (0.5, 1), (0.5, 1), (0.5, 0), (0.1, 0), (0.9, 1)])
    assert E.lift_at_k(df, "score", "label", "id", 3).first()["lift"] == pytest.approx((2 / 3) / 0.5)
    assert E.lift_at_k(df, "score", "label", "id", 0.5).first()["top_n"] == 3
    table = E.decile_lift(df, "score", "label", "id").orderBy("decile").collect()
    assert table[-1]["lift"] == pytest.approx(1.0) and table[0]["lift"] is None
    zero = scores(spark, [(0.5, 0), (0.4, 0)])
    assert E.lift_at_k(zero, "score", "label", "id", 1).first()["lift"] is None


def test_zero_division_reads_zero(spark):
    row = E.classification_metrics(scores(spark, [(0.1, 0), (0.2, 0)]), "score", "label").first()
    assert row["precision"] == 0.0 and row["recall"] == 0.0 and row["f1"] == 0.0 and row["accuracy"] == 1.0


def test_quantile_bins_with_equal_edges(spark):
    df = scores(spark, [(0.5, i % 2) for i in range(20)])
    assert E.ece_quantile(df, "score", "label").first()[0] == pytest.approx(0.0)


def test_segment_rates_rise(spark):
    rng = np.random.default_rng(3)
    rows = [(p, int(rng.random() < r)) for p, r in ((0.1, 0.1), (0.5, 0.4), (0.9, 0.8)) for _ in range(300)]
    df = scores(spark, rows)
    table = binwise_metrics(df, "score", "label").orderBy("position").collect()
    assert [r["segment"] for r in table] == ["Low", "Medium", "High"] and [r["count"] for r in table] == [300, 300, 300]
    assert all(abs(r["conversion_rate"] - w) < 0.1 for r, w in zip(table, (0.1, 0.4, 0.8)))
    assert segment_order(df, "score", "label").first()["ordered"] == 1
