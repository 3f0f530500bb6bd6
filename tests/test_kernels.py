"""Kernels at tiny task sizes, so that every distributed branch runs, against numpy / pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from winnow.operators import kernels as K
from winnow.operators import stat_tests as ST


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, one key and one instant."""
    rng = np.random.default_rng(7)
    n = 3000
    pdf = pd.DataFrame({"id": rng.permutation(n), "v": rng.normal(size=n), "k": rng.integers(0, 40, n)})
    pdf.loc[: n // 3, "v"] = 0.5
    pdf.loc[: n // 3, "k"] = 7
    pdf["w"] = rng.integers(1, 5, n)
    return pdf, spark.createDataFrame(pdf).repartition(5).cache()


def test_order_statistics_selects_exactly(skewed):
    pdf, df = skewed
    ranks = [0, 1, 700, 1499, 1500, 2000, 2999]
    n, got = K.order_statistics(df, {"v": lambda n: ranks}, gather=20)["v"]
    assert n == 3000
    want = np.sort(pdf["v"].to_numpy())
    assert [got[r] for r in ranks] == [want[r] for r in ranks]


@pytest.mark.parametrize("task_rows", [100, 10_000])
def test_exact_quantiles(skewed, task_rows, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr(K, "GATHER_ROWS", 20)
    probs = (0.01, 0.25, 0.5, 0.75, 0.99)
    got = K.exact_quantiles(df, ["v", "w"], probs, task_rows)
    for c in ("v", "w"):
        assert np.allclose(got[c], np.quantile(pdf[c], probs), rtol=0, atol=1e-12)


def test_quantiles_of_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    for task_rows in (1, 100):
        assert K.exact_quantiles(df, ["a", "b"], (0.5,), task_rows) == {"a": [None], "b": [1.5]}


@pytest.mark.parametrize("task_rows", [50, 10_000])
def test_prefix_sums_with_hot_value(skewed, task_rows):
    pdf, df = skewed
    got = K.prefix_sums(df, [], "v", {"before": F.col("w")}, "id", task_rows, maxima={"top": F.col("v")}).toPandas()
    want = pdf.sort_values(["v", "id"])
    want["before"] = want["w"].cumsum() - want["w"]
    want["top"] = want["v"].shift(1)
    both = got.merge(want, on="id", suffixes=("", "_w"))
    assert (both["before"] == both["before_w"]).all()
    assert np.allclose(both["top"].to_numpy(float), both["top_w"].to_numpy(float), equal_nan=True)


def test_prefix_sums_by_key(skewed):
    pdf, df = skewed
    got = K.row_positions(df, "v", "id", keys=["k"], task_rows=60).toPandas().set_index("id")["pos"]
    want = pdf.sort_values(["v", "id"]).set_index("id").groupby("k").cumcount()
    assert (got.sort_index() == want.sort_index()).all()


def test_positions_do_not_depend_on_partitioning(skewed):
    _, df = skewed
    a = K.row_positions(df.repartition(3), "v", "id", task_rows=100).toPandas().set_index("id")["pos"]
    b = K.row_positions(df.repartition(11), "v", "id", task_rows=100).toPandas().set_index("id")["pos"]
    assert (a.sort_index() == b.sort_index()).all()
    assert sorted(a) == list(range(len(a)))


def test_point_gap_bucket_isolates_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (-5, 0, 1, 2, 3, 9)], "x double")
    got = {r["x"]: r["b"] for r in K.point_gap_bucket(df, "x", [0.0, 2.0], "b").collect()}
    assert got == {-5.0: 0, 0.0: 1, 1.0: 2, 2.0: 3, 3.0: 4, 9.0: 4}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 17, 1000])
def test_feistel_donors_are_bijections(spark, n):
    for seed in range(3):
        got = [r[0] for r in spark.range(n).select(K.feistel_donor(F.col("id"), n, seed)).collect()]
        assert sorted(got) == list(range(n))


def test_feistel_donors_have_no_order(spark):
    """Neighbours' donors are unrelated, also along a period, and seeds differ."""
    n = 20_000
    rows = spark.range(n).select("id", K.feistel_donor(F.col("id"), n, 1).alias("a"), K.feistel_donor(F.col("id"), n, 2).alias("b")).orderBy("id").toPandas()
    for lag in (1, 7, 100, 141, 142):
        assert abs(np.corrcoef(rows["a"][:-lag], rows["a"][lag:])[0, 1]) < 0.03
        steps = np.diff(rows["a"].to_numpy()[::lag])
        assert len(np.unique(steps)) > 0.9 * len(steps) * (1 - len(steps) / (4 * n))
    assert abs(np.corrcoef(rows["id"], rows["a"])[0, 1]) < 0.03 and abs(np.corrcoef(rows["a"], rows["b"])[0, 1]) < 0.03


def _tau_b(x, y):
    dx, dy = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
    return (dx * dy).sum() / np.sqrt((dx != 0).sum() * float((dy != 0).sum()))


@pytest.mark.parametrize("task_rows", [80, 100_000])
def test_kendall_matches_all_pairs(spark, task_rows):
    rng = np.random.default_rng(3)
    n = 900
    x = np.where(np.arange(n) % 3 == 0, 1.0, rng.normal(size=n).round(1))
    y = (x + rng.normal(size=n)).round(1)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).repartition(4)
    assert ST.kendall_pair(df, "x", "y", task_rows) == pytest.approx(_tau_b(x, y), abs=1e-12)


@pytest.mark.parametrize("task_rows", [40, 100_000])
def test_spearman_with_nulls_and_ties(spark, task_rows):
    rng = np.random.default_rng(5)
    n = 400
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n).round(1), "b": rng.normal(size=n), "c": rng.normal(size=n)})
    pdf.loc[: n // 3, "a"] = 0.0
    pdf["b"] = pdf["b"].where(pdf["id"] % 7 != 0)
    pdf["c"] = pdf["c"].where(pdf["id"] % 5 != 0)
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in ST.spearman(df, ["a", "b", "c"], "id", task_rows).collect()}
    for (a, b), r in got.items():
        ok = pdf[[a, b]].dropna().rank()
        assert r == pytest.approx(ok[a].corr(ok[b]), abs=1e-9)
    assert len(got) == 3


def test_many_pairs_in_one_pass(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(300, 5)) + 1e6, columns=list("abcde"))
    pdf["b"] += 3 * pdf["a"]
    pdf["c"] = pdf["c"].where(rng.random(300) < 0.7)
    pdf["d"] = pdf["d"].where(rng.random(300) < 0.8)
    pdf["e"] = 4.0
    df = spark.createDataFrame(pdf).repartition(6).replace(float("nan"), None)
    pairs = [(x, y) for i, x in enumerate("abcde") for y in "abcde"[i + 1:]]
    want = pdf.corr()
    for few in (0, 100):
        got = {(r["feature_a"], r["feature_b"]): r["r"] for r in K.pairwise_corr(df, pairs, few).collect()}
        assert set(got) == set(pairs)
        for (x, y), r in got.items():
            assert (r is None) if "e" in (x, y) else r == pytest.approx(want.loc[x, y], abs=1e-9)
