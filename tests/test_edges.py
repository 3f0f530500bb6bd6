"""Opaque ids, special values, rows without keys; the cut branch and the single window agree."""

import math

import pytest
from pyspark.sql import functions as F

from winnow.operators import evaluation as E
from winnow.operators import features as FE
from winnow.operators import kernels as K
from winnow.operators import selection as FS
from winnow.operators.calibration import fit_isotonic, pool
from winnow.roles import TEST_EXCLUDED, rename_clean
from winnow.sources import files


@pytest.mark.parametrize("make", [lambda k: f"lead-{k:04d}", lambda k: 2**60 + k, lambda k: k])
@pytest.mark.parametrize("task_rows", ["40", "1000000"])
def test_lift_with_any_id(spark, make, task_rows):
    rows = [(make(k), 0.5 if k % 3 else 0.1 * (k % 7), k % 2) for k in range(400)]
    df = spark.createDataFrame(rows, "id string, score double, y int" if isinstance(rows[0][0], str) else "id long, score double, y int")
    spark.conf.set("spark.winnow.taskRows", task_rows)
    try:
        got = {r.decile: r.lift for r in E.decile_lift(df, "score", "y", "id").collect()}
        none = E.lift_at_k(df.limit(9), "score", "y", "id", 0.1).collect()
    finally:
        spark.conf.unset("spark.winnow.taskRows")
    best = sorted(rows, key=lambda r: (-r[1], r[0]))
    for d in range(1, 11):
        top = best[:400 * d // 10]
        assert got[d] == pytest.approx(sum(r[2] for r in top) / len(top) / 0.5)
    assert none[0].top_n == 0 and none[0].lift is None


@pytest.mark.parametrize("task_rows", [20, 10_000])
def test_positions_with_special_values(spark, task_rows):
    special = [None, float("nan"), float("inf"), float("-inf"), 1.0]
    rows = [(f"k{k:03d}", special[k % 5] if k < 200 else float(k)) for k in range(300)]
    df = spark.createDataFrame(rows, "id string, v double")
    got = {r.id: r.pos for r in K.row_positions(df, "v", "id", task_rows=task_rows).collect()}
    rank = lambda v: (0, 0) if v is None else (2, 0) if math.isnan(v) else (1, v)
    want = {i: p for p, (i, _) in enumerate(sorted(rows, key=lambda r: (rank(r[1]), r[0])))}
    assert got == want


@pytest.mark.parametrize("task_rows", [5, 10_000])
def test_quantiles_with_special_values(spark, task_rows, monkeypatch):
    monkeypatch.setattr(K.order_statistics, "__defaults__", (3,))
    values = [None, float("nan"), float("-inf"), float("-inf"), 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, float("inf"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert K.exact_quantiles(df, ["v"], (0.0, 0.5, 1.0), task_rows)["v"] == [float("-inf"), 3.5, float("inf")]


@pytest.mark.parametrize("frame_rows", [5, 1000])
def test_history_keeps_rows_without_id(spark, frame_rows):
    rows = [(None if k in (3, 7) else k, "a", f"2024-01-{k % 28 + 1:02d} 00:00:00") for k in range(60)]
    df = spark.createDataFrame(rows, "id long, account string, t string").withColumn("t", F.col("t").cast("timestamp"))
    out = FE.account_history(df, "account", "t", "id", [7], task_rows=frame_rows, frame_rows=frame_rows)
    assert out.count() == 60 and out.agg(F.sum("cum_leads_account")).first()[0] == 60 * 59 // 2


def test_stable_subset_counts_absent_folds(spark):
    df = spark.createDataFrame([("a", 0, 0.9), ("b", 0, 0.5), ("b", 1, 0.5), ("b", 2, 0.5)], "feature string, fold int, importance double")
    got = {r.feature: (r.mean_importance, r.positive_share) for r in FS.stable_subset(df, threshold=0.0).collect()}
    assert got["a"] == pytest.approx((0.3, 1 / 3)) and got["b"] == pytest.approx((0.5, 1.0))


def test_isotonic_equals_pooling_all(spark):
    rows = [(k / 997.0 + 1e-9 * (k % 2), (k * 7919) % 13 < 3 + k % 11) for k in range(900)]
    df = spark.createDataFrame([(s, int(y)) for s, y in rows], "score double, y int")
    import numpy as np

    want = {}
    ordered = sorted(rows)
    for a, b, m, _ in pool(np.array([float(y) for _, y in ordered]), np.ones(len(ordered))):
        want |= {ordered[k][0]: m for k in range(a, b + 1)}
    got = {r.score: r.calibrated for r in fit_isotonic(df, "score", "y").transform(df, "score").collect()}
    assert got == pytest.approx(want)


def test_unknown_level_names_and_numbers(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert FE.levels(df, "c") == ["Unknown", "a"]
    assert [tuple(r) for r in FE.onehot(df, "c", FE.levels(df, "c")).collect()] == [("a", 0, 1), (None, 1, 0)]
    assert rename_clean(spark.createDataFrame([(1, 2, 3)], ["a b", "a-b", "%"])).columns == ["a_b", "a_b_2", "column"]
    assert {"SystemModstamp", "BranchName", "Branch_Name__c"} < set(TEST_EXCLUDED)
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write("id;x;y\n1;2.5;NULL\n2;NULL;q\n")
    assert dict(files.read_datamart(spark, path, {"id": "int64"}).dtypes) == {"id": "bigint", "x": "double", "y": "string"}


def test_read_or_split(spark, tmp_path):
    raw = lambda: spark.range(4).withColumn("split", F.when(F.col("id") < 3, "train").otherwise("test"))
    assert files.read_or_split(spark, str(tmp_path / "none"), raw, lambda d: d, "train").count() == 3
    files.write_split(raw(), str(tmp_path / "stored"))
    assert files.read_or_split(spark, str(tmp_path / "stored"), lambda: 1 / 0, lambda d: d, "test").count() == 1
