import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from winnow.operators import tuning as T
from winnow.operators.kernelmaps import KernelMap, KernelSVC, KernelSVCModel, kernel_matrix
from winnow.operators.models import fit_family


def test_brackets_and_table():
    assert T.brackets(4, 3) == [(0, 27), (1, 12), (2, 6), (3, 4)]
    seen = []
    study = T.run_study({"x": T.Span(0, 1)}, lambda jobs: [seen.append(len(jobs)) or p["x"] for p, _ in jobs], 49, 4)
    assert study.table() == [
        (0, 0, 27), (0, 1, 9), (0, 2, 3), (0, 3, 1), (1, 1, 12), (1, 2, 4), (1, 3, 1), (2, 2, 6), (2, 3, 2), (3, 3, 4)]


@pytest.mark.parametrize("pruner", ["hyperband", "median"])
def test_planted_point_is_found_at_under_a_third_of_the_rows(pruner):
    """A grid of 900 points with one best place; small shares are noisy."""
    grid = {"a": list(range(30)), "b": list(range(15)), "kind": ["u", "v"]}
    space = {"a": T.Span(0, 29, whole=True), "b": T.Span(0, 14, whole=True), "kind": grid["kind"]}
    shares, spent = [1 / 27, 1 / 9, 1 / 3, 1.0], [0.0]
    noise = np.random.default_rng(7)

    def evaluate(jobs):
        spent[0] += sum(shares[r] for _, r in jobs)
        return [
            1 - abs(p["a"] - 21) / 30 - abs(p["b"] - 4) / 15 - (0.3 if p["kind"] == "u" else 0) + noise.normal(0, 0.03 * (1 - shares[r])) for p, r in jobs]

    study = T.run_study(space, evaluate, 150, 4, pruner=pruner)
    best = study.best.params
    assert abs(best["a"] - 21) <= 1 and abs(best["b"] - 4) <= 1 and best["kind"] == "v"
    assert spent[0] < 150 / (3 if pruner == "hyperband" else 1.5)


def test_density_search_beats_random_draws():
    space = {"x": T.Span(1e-4, 1e2, wide=True), "y": T.Span(0.0, 1.0), "c": ["a", "b", "c"]}
    score = lambda p: -abs(math.log10(p["x"]) + 1) - 3 * abs(p["y"] - 0.8) - (p["c"] != "b")
    run = lambda sampler, seed: T.run_study(space, lambda jobs: [score(p) for p, _ in jobs], 60, 1, pruner="none", sampler=sampler, seed=seed)
    best = {s: np.mean([score(run(s, seed).best.params) for seed in range(8)]) for s in ("tpe", "random")}
    assert best["tpe"] > best["random"] + 0.1
    assert run("tpe", 3).best.params == run("tpe", 3).best.params


def test_values_missing_on_a_rung_lose_and_timeouts_stop():
    study = T.run_study({"x": [1, 2, 3]}, lambda jobs: [math.nan if p["x"] == 1 else p["x"] for p, _ in jobs], 30, 2, sampler="random")
    assert study.best.params["x"] == 3
    assert len(T.run_study({"x": [1]}, lambda jobs: [0.0] * len(jobs), 30, 2, timeout=0.0, pruner="none").trials) == 0
    with pytest.raises(ValueError):
        T.run_study({}, lambda jobs: [], 1, 1, pruner="no such")


def test_spaces_of_grids():
    space = T.space_of({"C": [0.001, 100.0], "depth": [3, 5, 9], "kernel": ["rbf"], "gamma": ["scale", 0.1]})
    assert space["C"].wide and space["depth"] == T.Span(3, 9, whole=True) and space["kernel"] == ["rbf"] and space["gamma"] == ["scale", 0.1]
    assert all(space["C"].low <= space["C"].value(u) <= space["C"].high for u in (-1, 0, 0.3, 1, 2))
    assert space["C"].unit(space["C"].value(0.3)) == pytest.approx(0.3)


@pytest.fixture(scope="module")
def planted(spark):
    """Two useful columns and twenty of noise: a strong penalty on absolute weights is best."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 22))
    y = (x[:, 0] - x[:, 1] + rng.normal(0, 1.0, 1500) > 0).astype(int)
    df = spark.createDataFrame([(i, int(t), *map(float, r)) for i, (r, t) in enumerate(zip(x, y))], ["id", "label", *[f"c{k}" for k in range(22)]])
    return VectorAssembler(inputCols=[f"c{k}" for k in range(22)], outputCol="features").transform(df).persist()


def test_search_on_rows(spark, planted):
    space = {"C": T.Span(0.0005, 50.0, wide=True)}
    found = T.tune(planted, "lasso_lr", space, "id", trials=8, folds=2, rungs=2, eta=3, max_iter=20)
    assert found.cost < 0.8 and found.value > 0.8
    table = {(r["bracket"], r["rung"]): r for r in found.table(spark).collect()}
    share = planted.filter(T.rung_of("id", 2, 3, 42) == 0).count()
    assert table[0, 0]["rows"] == share and table[0, 1]["rows"] == 1500 and table[0, 0]["trials"] == 3
    assert found.model.transform(planted).filter("probability_1 between 0 and 1").count() == 1500


def test_nested_shares(spark):
    rows = spark.range(27_000).select(F.col("id"), T.rung_of("id", 4, 3, 42).alias("rung"))
    sizes = {r["rung"]: r["count"] for r in rows.groupBy("rung").count().collect()}
    upto = np.cumsum([sizes[r] for r in range(4)]) / 27_000
    assert np.allclose(upto, [1 / 27, 1 / 9, 1 / 3, 1], atol=0.01)


@pytest.mark.parametrize("kernel", ["rbf", "poly", "sigmoid"])
def test_maps_estimate_their_kernel(kernel):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 4))
    made = KernelMap.fourier(4, 0.3, 4000, 5) if kernel == "rbf" else KernelMap.nystroem(x[:100], kernel, 0.2, 2, 1.0 if kernel == "poly" else 0.0)
    z, want = made.apply(x), kernel_matrix(x, x, kernel, 0.3 if kernel == "rbf" else 0.2, 2, 1.0 if kernel == "poly" else 0.0)
    error = np.abs(z @ z.T - want).mean()
    assert error < (0.02 if kernel == "rbf" else 1e-6 if kernel == "poly" else 0.25)  # a sigmoid kernel has negative directions


def test_rings_need_a_kernel(spark, tmp_path):
    rng = np.random.default_rng(0)
    angle, ring = rng.uniform(0, 2 * np.pi, 600), rng.integers(0, 2, 600)
    radius = 1 + 2 * ring + rng.normal(0, 0.2, 600)
    rows = spark.createDataFrame([(float(a), float(b), int(t)) for a, b, t in zip(radius * np.cos(angle), radius * np.sin(angle), ring)], "x double, y double, label int")
    rows = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(rows).persist()

    def auc(**params):
        fitted = fit_family(rows, "svm", max_iter=25, **params)
        got = fitted.transform(rows, "p").select("label", "p").toPandas()
        a, b = got[got.label == 1].p.to_numpy(), got[got.label == 0].p.to_numpy()
        return float((a[:, None] > b[None]).mean() + 0.5 * (a[:, None] == b[None]).mean()), fitted

    assert auc()[0] < 0.65
    assert auc(kernel="poly", degree=2, components=40)[0] > 0.95
    best, fitted = auc(kernel="rbf", components=150, gamma=0.5)
    assert best > 0.95
    fitted.model.save(str(tmp_path / "svc"))
    again = KernelSVCModel.load(str(tmp_path / "svc"))
    same = again.transform(fitted.model.transform(rows).select("features", F.col("_m_raw").alias("was"))).filter(F.col("_m_raw") == F.col("was")).count()
    assert same == 600 and abs(sum(fitted.model.featureImportances) - 1) < 1e-9


def test_a_constant_table_and_bad_kernels(spark):
    with pytest.raises(ValueError):
        KernelSVC(kernel="cosine")
    rows = spark.createDataFrame([(1.0, 0), (1.0, 1)] * 5, "x double, label int")
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    for kernel in ("rbf", "poly", "sigmoid"):
        assert fit_family(rows, "svm", max_iter=5, kernel=kernel, components=4).transform(rows).count() == 10
