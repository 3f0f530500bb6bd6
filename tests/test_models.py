"""Imbalance, models, calibration, importance, selection, jobs, streaming."""

import numpy as np
import pandas as pd
import pytest
from frames import pipeline_leads, to_spark
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from winnow.operators import calibration as C
from winnow.operators import evaluation as E
from winnow.operators import imbalance as IM
from winnow.operators import importance as I
from winnow.operators import models as M
from winnow.operators import selection as FS
from winnow.operators import synthetic as SY
from winnow.roles import ColumnRoles

ROLES = ColumnRoles(
    target="Target_IsConverted", group="account_Id", time="LeadCreatedDate", source="Source_Final__c", ids=("LeadId",)
)


@pytest.fixture(scope="module")
def labelled(spark):
    """x0 decides, x1 helps, x2 is noise; 25 % positives."""
    rng = np.random.default_rng(0)
    n = 1500
    x = rng.normal(size=(n, 3))
    p = 1 / (1 + np.exp(-(2.5 * x[:, 0] + 0.8 * x[:, 1] - 1.8)))
    pdf = pd.DataFrame(x, columns=["x0", "x1", "x2"]).assign(id=np.arange(n), label=(rng.random(n) < p).astype(int))
    pdf["src"] = rng.choice(["Web", "App", "Tiny"], n, p=[0.6, 0.38, 0.02])
    df = spark.createDataFrame(pdf)
    return VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(df).repartition(4).cache()


def auc_value(df, score):
    return E.auc(df, score, "label").first()["auc"]


# ---------------------------------------------------------------- imbalance


def _brute(x, c, k, penalty):
    gaps = ((x[:, None] - x[None]) ** 2).sum(2) + penalty**2 * (c[:, None] != c[None]).sum(2)
    np.fill_diagonal(gaps, np.inf)
    return np.sort(np.sqrt(gaps), axis=1)[:, :k]


@pytest.mark.parametrize("slice_rows", [40, 4000])
def test_nearest_is_exact(spark, slice_rows):
    rng = np.random.default_rng(2)
    n = 500
    x = np.vstack([rng.normal(size=(n // 2, 2)), rng.normal(0.0, 0.01, size=(n - n // 2, 2)) + 5])
    c = rng.choice(["a", "b"], size=(n, 1))
    pts = spark.createDataFrame([(f"{i:04d}", x[i].tolist(), c[i].tolist(), 1) for i in range(n)], "p string, x array<double>, c array<string>, m long")
    got = SY.nearest(pts, 5, 0.7, 1, slice_rows).toPandas()
    assert (got.groupby("q").size() == 5).all() and got["q"].nunique() == n
    dist = np.stack([g["dist"].sort_values().to_numpy() for _, g in got.sort_values("q").groupby("q")])
    assert np.allclose(dist, _brute(x, c, 5, 0.7), atol=1e-9)


def test_smote_equalises_and_stays_inside(spark):
    rng = np.random.default_rng(4)
    n = 600
    pdf = pd.DataFrame({"id": np.arange(n), "y": (np.arange(n) % 10 == 0).astype(int), "a": rng.normal(size=n), "b": rng.normal(size=n),
                        "c": rng.choice(["u", "v", "w"], n)})
    pdf.loc[pdf["y"] == 1, "a"] += 4
    copies = pdf.index[pdf["y"] == 1][:20]
    pdf.loc[copies, ["a", "b", "c"]] = [4.0, 0.0, "u"]
    out = SY.smote(spark.createDataFrame(pdf), "y", "id", ["a", "b"], ["c"], slice_rows=25).toPandas()
    assert (out["y"].value_counts() == n - n // 10).all()
    real, made = pdf[pdf["y"] == 1], out[out["synthetic"] == 1]
    assert (out["synthetic"] == 0).sum() == n and made["id"].isna().all()
    for col in "ab":
        assert made[col].between(real[col].min() - 1e-9, real[col].max() + 1e-9).all()
    assert set(made["c"]) <= {"u", "v", "w"}
    # a third of the minority are copies, so a third of the synthetic rows are copies too
    same = ((made["a"] == 4.0) & (made["b"] == 0.0)).mean()
    assert abs(same - 1 / 3) < 0.05


def test_weights_and_replication(labelled):
    sizes = IM.class_sizes(labelled, "label")
    weights = IM.add_class_weights(labelled, "label").groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert all(abs(r["w"] - sum(sizes.values()) / 2) < 1e-6 for r in weights)
    over = IM.oversample(labelled, "label", "id").groupBy("label").count().collect()
    assert {r["count"] for r in over} == {max(sizes.values())}
    under = IM.undersample(labelled, "label", "id").groupBy("label").count().collect()
    assert {r["count"] for r in under} == {min(sizes.values())}


# ---------------------------------------------------------------- models


@pytest.mark.parametrize("family,params", [
    ("baseline_lr", {}), ("svm", {"max_iter": 50}), ("random_forest", {"trees": 20, "depth": 5}), ("lightgbm", {"trees": 10, "depth": 3}),
])
def test_families_rank_well(labelled, family, params):
    fitted = M.fit_family(labelled, family, **params)
    out = fitted.transform(labelled, "p")
    assert set(out.columns) - set(labelled.columns) == {"p"}
    assert auc_value(out, "p") > 0.85
    assert out.filter("p < 0 OR p > 1").count() == 0


def test_vote_weights_and_stacking(labelled):
    models = M.fit_families(labelled, {"baseline_lr": {}, "random_forest": {"trees": 10, "depth": 4}})
    scored, columns = M.add_probabilities(labelled, models)
    scored = scored.cache()
    weights, best = M.optimize_weights(scored, columns, "label")
    singles = [auc_value(scored, c) for c in columns]
    assert abs(sum(weights) - 1) < 1e-9 and best >= max(singles) - 1e-12
    assert abs(best - auc_value(scored.withColumn("v", M.vote(columns, weights)), "v")) < 1e-12
    three = M.weight_candidates(3)
    assert len(three) == 101 and all(abs(sum(w) - 1) < 1e-9 for w in three)
    f1 = M.candidate_scores(scored, columns, "label", [[1, 0], [0, 1]], "f1").orderBy("candidate").collect()
    one = E.classification_metrics(scored, columns[0], "label").first()["f1"]
    assert abs(f1[0]["value"] - one) < 1e-12
    stacked = M.fit_stacking(labelled, {"baseline_lr": {}, "random_forest": {"trees": 5, "depth": 3}}, "id", folds=2)
    out = stacked.transform(labelled, "p")
    assert auc_value(out, "p") > 0.85 and set(out.columns) - set(labelled.columns) == {"p"}


def test_bounds_hold_and_leave_the_winner_open(spark):
    """Three models, 101 weightings: same winner as the exact curves of all, from few of them."""
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 1500)
    p = np.clip(rng.normal(0.4 + 0.2 * y[:, None], [0.2, 0.3, 0.5]), 0, 1)
    df = spark.createDataFrame([(int(a), *map(float, r)) for a, r in zip(y, p)] + [(None, 0.5, 0.5, 0.5), (1, None, 0.1, 0.2)], "label int, a double, b double, c double").cache()
    columns, candidates = ["a", "b", "c"], M.weight_candidates(3)
    exact = {r["candidate"]: r["value"] for r in M.candidate_scores(df.dropna(), columns, "label", candidates).collect()}
    bounds = {r["candidate"]: r for r in M.auc_bounds(df, columns, "label", candidates).collect()}
    assert all(bounds[i]["low"] - 1e-12 <= exact[i] <= bounds[i]["high"] + 1e-12 for i in exact)
    floor = max(r["low"] for r in bounds.values())
    assert sum(r["high"] >= floor for r in bounds.values()) < 30
    winner = max(exact, key=lambda i: (exact[i], -i))
    weights, value = M.optimize_weights(df.dropna(), columns, "label")
    assert weights == candidates[winner] and value == pytest.approx(exact[winner])
    assert M.optimize_weights(df.filter("label = 1"), columns, "label") == ([1 / 3] * 3, 0.0)


def test_experts_fall_back(labelled):
    model = M.fit_source_experts(labelled, "src", ["Web", "App", "Tiny"], "baseline_lr")
    assert set(model.experts) == {"Web", "App"}
    out = model.transform(labelled, "p")
    general = model.general.transform(labelled, "p")
    a = {r["id"]: r["p"] for r in out.filter("src = 'Tiny'").select("id", "p").collect()}
    b = {r["id"]: r["p"] for r in general.filter("src = 'Tiny'").select("id", "p").collect()}
    assert a == b and len(a) > 0


def test_search_picks_a_grid_point(labelled):
    point, value, fitted = M.search(labelled, "baseline_lr", {"C": [0.01, 1.0], "l1_ratio": [0.0, 1.0]}, "id", trials=3, folds=2)
    assert point["C"] in (0.01, 1.0) and value > 0.85
    assert auc_value(fitted.transform(labelled, "p"), "p") > 0.85


# ---------------------------------------------------------------- calibration


@pytest.fixture(scope="module")
def miscalibrated(spark):
    rng = np.random.default_rng(9)
    n = 3000
    true = rng.random(n)
    pdf = pd.DataFrame({"id": np.arange(n), "score": true**2, "label": (rng.random(n) < true).astype(int)})
    return spark.createDataFrame(pdf).repartition(4).cache()


@pytest.mark.parametrize("fit", [C.fit_isotonic, C.fit_platt])
def test_calibration_moves_towards_the_rate(miscalibrated, fit):
    out = fit(miscalibrated, "score", "label").transform(miscalibrated, "score").cache()
    row = out.agg(F.avg("score").alias("s"), F.avg("calibrated").alias("c"), F.avg("label").alias("y"),
                  F.min("calibrated").alias("lo"), F.max("calibrated").alias("hi")).first()
    assert abs(row["c"] - row["y"]) < abs(row["s"] - row["y"]) and abs(row["c"] - row["y"]) < 0.01
    assert 0 <= row["lo"] <= row["hi"] <= 1
    p = out.orderBy("score").toPandas()["calibrated"].to_numpy()
    assert (np.diff(p) >= -1e-12).all()
    assert E.brier(out, "calibrated", "label").first()[0] < E.brier(out, "score", "label").first()[0]


def test_calibrator_decision():
    s = C.CalibratorScore
    assert C.decide(s(0.100, True, True), s(0.1005, False, True)) == "sigmoid"
    assert C.decide(s(0.1005, False, True), s(0.100, True, True)) == "isotonic"
    assert C.decide(s(0.1005, True, True), s(0.100, True, False)) == "sigmoid"
    assert C.decide(s(0.1005, True, True), s(0.100, True, True)) == "isotonic"
    assert C.decide(s(0.2, True, True), s(0.1, False, False)) == "isotonic"
    assert [C.coverage_threshold(n) for n in (10, 90, 100, 900, 1000)] == [2, 4, 5, 18, 10]


def test_choose_and_compare(miscalibrated):
    best, name = C.choose_calibrator(miscalibrated, "score", "label")
    out = best.transform(miscalibrated, "score").cache()
    table = {(r["dataset"], r["metric"]): r for r in C.compare_sets({"v": out}, "score", "calibrated", "label").collect()}
    assert name in ("sigmoid", "isotonic") and table["v", "brier"]["calibrated"] < table["v", "brier"]["raw"]
    assert abs(table["v", "auc"]["raw"] - auc_value(out, "score")) < 1e-12


# ---------------------------------------------------------------- importance


@pytest.mark.parametrize("family,params", [("lightgbm", {"trees": 6, "depth": 3}), ("random_forest", {"trees": 6, "depth": 4})])
def test_tree_attributions_add_up(spark, labelled, family, params):
    fitted = M.fit_family(labelled, family, **params)
    leaves, base = I.tree_paths(fitted.model, spark)
    rows = labelled.limit(50).cache()
    x = np.array(rows.select("x0", "x1", "x2").collect(), dtype=float)
    phi = I.attribute(x, leaves)
    out = fitted.model.transform(rows).select("_m_raw", "_m_probability").collect()
    want = [r["_m_raw"][1] if family == "lightgbm" else r["_m_probability"][1] for r in out]
    assert np.allclose(phi.sum(axis=1) + base, want, atol=1e-9)
    table = {r["feature"]: r["importance"] for r in I.tree_importance(labelled, fitted.model, ["x0", "x1", "x2"]).collect()}
    assert max(table, key=table.get) == "x0"


def test_linear_permutation_and_folds(labelled):
    fitted = M.fit_family(labelled, "baseline_lr")
    names = ["x0", "x1", "x2"]
    lin = {r["feature"]: r["importance"] for r in I.linear_importance(labelled, fitted.model, names).collect()}
    assert lin["x0"] > lin["x1"] > lin["x2"]
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    score = lambda d: fitted.transform(assembler.transform(d), "p")
    perm = {r["feature"]: r for r in I.permutation_importance(labelled.drop("features"), names, score, "label", "id", 3).collect()}
    assert perm["x0"]["importance"] > perm["x1"]["importance"] > abs(perm["x2"]["importance"])
    folds = I.fold_importances(labelled, "baseline_lr", names, "id", folds=3).cache()
    stable = {r["feature"]: r["stability"] for r in I.importance_stability(folds).collect()}
    assert folds.count() == 9 and 0 <= min(stable.values()) and stable["x0"] > 0.8


def test_shadows_reject_noise(labelled):
    out = {r["feature"]: r["decision"] for r in I.shadow_selection(
        labelled.drop("features"), ["x0", "x1", "x2"], "label", "id", rounds=7, trees=10, depth=4).collect()}
    assert out["x0"] == "confirmed" and out["x2"] != "confirmed"
    assert I.binomial_tail(0, 5) == 1.0 and I.binomial_tail(5, 5) == 1 / 32
    assert I.discoveries({"a": 0.01, "b": 0.04, "c": 0.03, "d": 0.9}, 0.05) == {"a"} and I.discoveries({"a": 0.03, "b": 0.04}, 0.05) == {"a", "b"}


def test_shuffled_columns_lose_their_relation(spark):
    """Copies of equal columns differ: noise that is correlated with other noise cannot hide among the copies."""
    df = spark.range(2000).select(F.col("id").alias("_i"), F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    out = I.shuffled_columns(df, 2000, ["x", "y"], 5).toPandas()
    assert sorted(out["shadow_x"]) == sorted(out["shadow_y"]) == list(range(2000)) and set(out["_i"]) == set(range(2000))
    assert abs(np.corrcoef(out["shadow_x"], out["shadow_y"])[0, 1]) < 0.08 and abs(np.corrcoef(out["_i"], out["shadow_x"])[0, 1]) < 0.08


def test_shadows_reject_correlated_noise(labelled):
    rows = labelled.drop("features").withColumn("x3", F.col("x2") + 0.01 * F.rand(1)).withColumn("x4", -F.col("x2"))
    out = {r["feature"]: r for r in I.shadow_selection(rows, ["x0", "x1", "x2", "x3", "x4"], "label", "id", rounds=12, trees=10, depth=4).collect()}
    assert out["x0"]["decision"] == "confirmed" and all(out[c]["decision"] != "confirmed" for c in ("x2", "x3", "x4"))
    assert all(r["rounds"] < 12 for r in out.values() if r["decision"] == "rejected") or out["x2"]["hits"] < 6


def test_rank_agreement_and_overlap(spark):
    rows = [("a", f, v) for f, v in zip("wxyz", (4.0, 3.0, 2.0, 1.0))] + [("b", f, v) for f, v in zip("wxy", (1.0, 2.0, 3.0))]
    ranks = I.method_ranks(spark.createDataFrame(rows, "method string, feature string, importance double"))
    r = I.rank_agreement(ranks, "a", "b").first()["r"]
    want = pd.DataFrame({"a": [1, 2, 3, 4], "b": [3, 2, 1, 5]}).corr("spearman").iloc[0, 1]
    assert abs(r - want) < 1e-12
    assert {x[0] for x in I.top_overlap(ranks, "a", "b", 2).collect()} == {"x"}


# ---------------------------------------------------------------- selection


def test_selector_drops_what_it_should(spark):
    rng = np.random.default_rng(42)
    n = 500
    f1, f2 = rng.normal(size=n), rng.normal(5, 2, n)
    pdf = pd.DataFrame({
        "LeadId": np.arange(n), "num_feature1": f1, "num_feature2": f2, "duplicate_col": f1, "useless_col": 5.0,
        "missing_col": np.where(rng.random(n) < 0.6, rng.normal(size=n), np.nan), "low_corr_col": rng.random(n),
        "high_corr_col": 0.95 * f1 + rng.normal(0, 0.05, n), "cat_feature1": rng.choice(list("ABC"), n),
        "Target_IsConverted": ((f1 > 0) & (f2 > 5)).astype(int),
    })
    df = to_spark(spark, pdf)
    model = FS.SmartFeatureSelector().fit(df, ROLES)
    assert {"duplicate_col", "useless_col", "missing_col"} <= set(model.dropped)
    assert len({"num_feature1", "high_corr_col"} & set(model.dropped)) == 1
    assert "num_feature2" in model.kept and "Target_IsConverted" in model.transform(df).columns
    report = {r["feature"]: r for r in model.report(df).collect()}
    assert report["duplicate_col"]["reason"] == "duplicate of num_feature1" and report["num_feature2"]["selected"] == 1
    assert FS.quality_counts(df, ["num_feature1", "high_corr_col", "missing_col", "useless_col"]) == {
        "high_null": 1, "low_variance": 1, "high_correlation": 1}
    pca = FS.SmartFeatureSelector(pca_components=2, target_correlation_min=0.0).fit(df, ROLES)
    parts = pca.transform(df)
    assert [c for c in parts.columns if c.startswith("PC_")] == ["PC_001", "PC_002"]
    assert abs(parts.agg(F.avg("PC_001")).first()[0]) < 1e-9


def test_correlated_choice_is_sequential():
    corr = {("a", "b"): 0.99, ("a", "c"): 0.99, ("b", "c"): 0.99}
    assert FS.drop_correlated(["a", "b", "c"], corr, {"a": 0.5, "b": 0.4, "c": 0.6}, 0.95) == {"b": "a", "a": "c"}
    assert FS.drop_correlated(["a", "b"], {("a", "b"): 0.99}, {"a": 0.5, "b": 0.5}, 0.95) == {"b": "a"}
    assert FS.drop_correlated(["a", "b"], {("a", "b"): None}, {}, 0.95) == {}


# ---------------------------------------------------------------- jobs


@pytest.fixture(scope="module")
def trained(spark):
    from winnow.config import SplitConfig, TrainConfig
    from winnow.plans.jobs import split_and_clean, train_job

    df = to_spark(spark, pipeline_leads()).cache()
    data, _, meta = split_and_clean(df, ROLES, SplitConfig("2023-07-31", "2023-12-31", "2024-12-31"))
    assert meta["rows"] == {"train": 500, "validation": 300, "test": 200}
    data = data.cache()
    return df, data, train_job(data, ROLES, TrainConfig(family="random_forest", params={"trees": 20, "depth": 5}))


def test_training_and_scoring_agree(spark, trained, tmp_path):
    df, data, result = trained
    out = result.scorer.transform(df, ["Target_IsConverted"])
    assert out.columns == ["LeadId", "Target_IsConverted", "raw_score", "conversion_probability", "segment"]
    assert out.count() == 1000 and out.filter("conversion_probability < 0 OR conversion_probability > 1").count() == 0
    from winnow.plans.jobs import evaluate_job

    tables = evaluate_job(data, ROLES, result.scorer)
    metrics = {r["metric"]: r["value"] for r in tables["test"].collect()}
    assert tables["comparison"].count() == 4 and tables["test_bins"].count() > 0
    assert metrics["roc_auc"] > 0.6 and 0 <= metrics["ece"] < 0.25
    result.scorer.save(str(tmp_path / "scorer"))
    from winnow.plans.scoring import Scorer

    again = Scorer.load(str(tmp_path / "scorer")).transform(df)
    a = out.select("LeadId", "conversion_probability").toPandas().set_index("LeadId").sort_index()
    b = again.select("LeadId", "conversion_probability").toPandas().set_index("LeadId").sort_index()
    assert np.allclose(a, b)


def test_stream_equals_batch(spark, trained, tmp_path):
    from winnow.streaming.scoring import read_record_stream, score_available

    df, _, result = trained
    df.withColumn("LeadCreatedDate", F.date_format("LeadCreatedDate", "yyyy-MM-dd'T'HH:mm:ss")).repartition(5).write.json(str(tmp_path / "in"))
    rows = read_record_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=2)
    got = score_available(spark, rows, result.scorer.transform, str(tmp_path / "out"), str(tmp_path / "state"))
    a = got.select("LeadId", "conversion_probability", "segment").toPandas().sort_values("LeadId").reset_index(drop=True)
    b = result.scorer.transform(df).select("LeadId", "conversion_probability", "segment").toPandas().sort_values("LeadId").reset_index(drop=True)
    assert len(a) == 1000 and np.allclose(a["conversion_probability"], b["conversion_probability"]) and (a["segment"] == b["segment"]).all()


def test_fit_ignores_later_sets(spark, trained):
    """Changing validation and test rows changes nothing learned from train."""
    from winnow.operators.cleaning import BasicCleaner

    _, data, _ = trained
    noisy = data.withColumn("num_feature1", F.when(F.col("split") == "train", F.col("num_feature1")).otherwise(1e6))
    fit = lambda d: BasicCleaner().fit(d.filter("split = 'train'").drop("split"), ROLES)
    assert fit(data) == fit(noisy)
    sel = lambda d: FS.SmartFeatureSelector().fit(d.filter("split = 'train'").drop("split"), ROLES)
    assert sel(data).dropped == sel(noisy).dropped


def test_statistics_and_importance_jobs(trained):
    from winnow.config import ImportanceConfig
    from winnow.plans.jobs import auto_select, describe_job, importance_job, run_tests, train_experts

    df, data, _ = trained
    roles = ColumnRoles.infer(df, "Target_IsConverted", "account_Id", "LeadCreatedDate", "Source_Final__c", ("LeadId",))
    tables = describe_job(df, roles)
    assert {"numeric", "categorical", "missing", "target", "source", "cohorts", "top_cohorts"} <= set(tables)
    assert all(t.count() > 0 for t in tables.values())
    tests = run_tests(data, roles)
    assert set(tests) == {"chi_square", "conversion", "ttest", "anova", "correlation", "high_correlation", "target_correlation"}
    assert tests["chi_square"].filter("feature = 'cat_feature1' AND significant").count() == 1
    kept, model, report = auto_select(data, roles)
    assert "split" not in model.kept and report.count() == len(model.kept) + len(model.dropped)
    out = importance_job(data, roles, ImportanceConfig(family="baseline_lr", folds=2, filter_features=False, params={"max_iter": 30}))
    assert {"attribution", "selected", "permutation", "combined"} == set(out)
    assert out["attribution"].count() > 3 and out["permutation"].count() >= 3
    encoder, experts = train_experts(data, roles, "baseline_lr", max_iter=20)
    assert len(experts.experts) == 4
