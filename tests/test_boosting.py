import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from winnow.operators import importance as I
from winnow.operators.boosting import BoostedModel, Growth, HistogramBoosting, Tree, best_cuts, best_first, binned, grow
from winnow.operators.models import fit_family


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 4)).round(2)
    x[rng.random(2000) < 0.1, 2] = np.nan
    p = 1 / (1 + np.exp(-(2 * (x[:, 0] > 0.3) + 1.5 * (x[:, 1] > 0) * (x[:, 0] < 0) - 1)))
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(p=p, label=(rng.random(2000) < p).astype(int), w=rng.integers(1, 4, 2000).astype(float))
    df = spark.createDataFrame(pdf)
    return VectorAssembler(inputCols=list("abcd"), outputCol="features", handleInvalid="keep").transform(df).repartition(5).cache()


def plain_tree(bins, g, h, rule, width):
    """Recursive growth over rows, best leaf first."""
    def best(mask):
        out = None
        for f in range(bins.shape[1]):
            for b in range(width - 1):
                left = mask & (bins[:, f] <= b)
                right = mask & ~left
                if min(left.sum(), right.sum()) < rule.min_rows or min(h[left].sum(), h[right].sum()) < rule.min_weight:
                    continue
                s = lambda m: max(abs(g[m].sum()) - rule.l1, 0) ** 2 / (h[m].sum() + rule.l2)
                gain = 0.5 * (s(left) + s(right) - s(mask))
                if gain > rule.min_gain and (out is None or gain > out[0] + 1e-9):
                    out = (gain, f, b, left, right)
        return out

    open_leaves, done = {0: (np.ones(len(g), bool), 0)}, {}
    found = {0: best(open_leaves[0][0])}
    count = 1
    while count < rule.leaves:
        usable = [n for n in open_leaves if found[n] and open_leaves[n][1] < rule.depth]
        if not usable:
            break
        n = max(usable, key=lambda n: (found[n][0], -n))
        gain, f, b, left, right = found[n]
        done[n] = (f, b)
        depth = open_leaves.pop(n)[1]
        for child, mask in ((2 * n + 1, left), (2 * n + 2, right)):
            open_leaves[child], found[child] = (mask, depth + 1), best(mask)
        count += 1
    values = {}
    for n, (m, _) in open_leaves.items():
        t = np.sign(g[m].sum()) * max(abs(g[m].sum()) - rule.l1, 0)
        values[n] = -rule.step * t / (h[m].sum() + rule.l2)
    return done, values


@pytest.mark.parametrize("rule", [
    Growth(trees=1, depth=3, leaves=5, bins=12, l2=0.5, min_rows=20), Growth("level", trees=1, depth=3, leaves=99, bins=9, l1=2.0, l2=1.0, min_gain=1.0, min_weight=3.0)])
def test_first_tree_equals_plain_growth(rows, rule):
    boost = HistogramBoosting(weightCol="w", growth=rule)
    held, edges, start = boost.prepared(rows)
    width = max(len(e) + 1 for e in edges)
    tree = grow(held, 4, width, [], rule, 0)
    local = held.toPandas()
    bins = np.stack([np.frombuffer(b, np.uint8) for b in local["bins"]])
    y, w = local["label"].to_numpy(), local["weight"].to_numpy()
    p = 1 / (1 + np.exp(-start))
    cuts, values = plain_tree(bins, (p - y) * w, np.full(len(y), p * (1 - p)) * w, rule, width)
    assert {n: c[:2] for n, c in tree.cuts.items()} == cuts and len(cuts) > 2
    assert tree.values.keys() == values.keys() and all(tree.values[n] == pytest.approx(values[n]) for n in values)
    leaf = tree.nodes_of(bins)
    assert all(tree.covers[n] == (leaf == n).sum() for n in values)


def test_symmetric_levels_share_their_cut(rows):
    boost = HistogramBoosting(growth=Growth("symmetric", trees=1, depth=3, bins=10))
    held, edges, _ = boost.prepared(rows)
    tree = grow(held, 4, 10, [], boost.growth, 0)
    for level in ((1, 2), (3, 4, 5, 6)):
        assert len({tree.cuts[n][:2] for n in level if n in tree.cuts}) == 1


@pytest.mark.parametrize("family", ["lightgbm", "xgboost", "catboost"])
def test_families_learn_save_and_explain(spark, rows, family, tmp_path):
    fitted = fit_family(rows, family, trees=20, depth=3, step=0.3)
    out = fitted.transform(rows.withColumnRenamed("p", "true"), "p").select("label", "p", "true").toPandas()

    def auc(score):
        pos, neg = score[out.label == 1].to_numpy(), score[out.label == 0].to_numpy()
        return (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()

    assert auc(out.p) > auc(out.true) - 0.02  # as good as the probabilities the labels were drawn from
    fitted.model.save(str(tmp_path / family))
    again = BoostedModel.load(str(tmp_path / family)).transform(rows.select("features", "label"))
    assert np.allclose(sorted(again.select(F.col("_m_probability")).toPandas()["_m_probability"].map(lambda v: v[1])), sorted(out.p))
    gain = fitted.model.featureImportances.toArray()
    assert gain.sum() == pytest.approx(1) and gain[:2].sum() > 0.7
    leaves, base = fitted.model.leaf_paths()
    x = np.nan_to_num(np.stack([r["features"].toArray() for r in rows.select("features").limit(50).collect()]), nan=-1e9)
    trees, edges, start = fitted.model.parts()
    margin = start + sum(t.margins(binned(x, edges)) for t in trees)
    assert np.allclose(I.attribute(x, leaves).sum(1) + base, margin)


def test_margins_are_written_on_the_way_and_partitions_do_not_matter(rows):
    rule = Growth(trees=20, depth=2, bins=8, rows=0.999999, features=0.5, step=0.5)
    edges = [[-1.0, 0.0, 1.0]] * 4
    one = HistogramBoosting(growth=rule, edges=edges).fit(rows)
    two = HistogramBoosting(growth=rule, edges=edges).fit(rows.repartition(2))
    a, b = one.parts()[0], two.parts()[0]
    assert len(a) == len(b) == 20 and [t.cuts.keys() for t in a] == [t.cuts.keys() for t in b]
    assert all(x.values[n] == pytest.approx(y.values[n]) for x, y in zip(a, b) for n in x.values)


def test_degenerate_tables(spark):
    make = lambda data: VectorAssembler(inputCols=["x"], outputCol="features", handleInvalid="keep").transform(spark.createDataFrame(data, "x double, label int"))
    flat = make([(1.0, 0), (1.0, 1), (1.0, 1), (1.0, 0)])
    model = HistogramBoosting(growth=Growth(trees=3)).fit(flat)
    assert model.parts()[0] == [] and model.transform(flat).filter("prediction = 0").count() == 4
    pure = make([(1.0, 1), (2.0, 1), (None, 1)])
    assert HistogramBoosting(growth=Growth(trees=2)).fit(pure).transform(pure).filter("prediction = 1").count() == 3
    with pytest.raises(ValueError):
        HistogramBoosting().fit(flat.limit(0))
    with pytest.raises(ValueError):
        Growth(policy="none")


def test_kernels():
    assert binned(np.array([[np.nan], [0.0], [1.0], [1.5], [9.0]]), [[1.0, 2.0]]).ravel().tolist() == [0, 0, 0, 1, 2]
    gain, _, total = best_cuts(np.array([[[1.0, 1, 4], [-2.0, 1, 4]]]), Growth(l2=0.0, min_weight=0.0))
    assert total.tolist() == [[-1.0, 2.0, 8.0]] and gain[0, 0] == pytest.approx(0.5 * (1 + 4 - 0.5)) and gain[0, 1] == -np.inf
    cuts = {0: (0, 0, 5.0), 1: (0, 0, 1.0), 2: (0, 0, 2.0), 5: (0, 0, 9.0)}
    assert set(best_first(cuts, 4)) == {0, 2, 5} and Tree().margins(np.zeros((2, 1), np.uint8)).tolist() == [0.0, 0.0]
