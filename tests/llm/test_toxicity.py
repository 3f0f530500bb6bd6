"""Gradients against differences; windows; held-out accuracy; odd rows."""

import numpy as np
import pyarrow as pa

from winnow.llm import toxicity as tx
from winnow.llm.words import Words


def test_gradients_against_differences():
    net = tx.Network(tx.Shape(window=6, stride=4, word=3, char=3, hidden=3))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = Words(pa.array(["a bc def gh", "zz yy xx a bc qq rr"], pa.large_string()), fold="unicode")
    _, first, length = tx.windows(words.offsets, net.shape)
    at, here = tx.grid(first, length, words.codes, 6)
    codes, y = tx.word_codes(words.distinct), np.array([1, 0, 1.0])

    def loss():
        x, _ = net.inputs(codes)
        s, _ = net.pooled({w: x @ net.p[f"in_{w}"] + net.p[f"gate_{w}"] for w in "fb"}, at, here)
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    for name, grad in net.gradients(codes, at, here, y, np.ones(3)).items():
        value = net.p[name]
        for spot in map(tuple, np.argwhere(np.abs(grad) > 0)[:5]):
            was = value[spot]
            value[spot] = was + 1e-3
            up = loss()
            value[spot] = was - 1e-3
            down = loss()
            value[spot] = was
            assert abs((up - down) / 2e-3 - grad[spot]) < 1e-4 + 0.02 * abs(grad[spot]), name


def test_windows_cover_all_words():
    offsets = np.array([0, 0, 5, 69, 300])
    owner, first, length = tx.windows(offsets, tx.Shape())
    seen = np.zeros(300, int)
    for o, f, n in zip(owner, first, length):
        assert offsets[o] <= f and f + n <= offsets[o + 1]
        seen[f:f + n] += 1
    assert seen.min() == 1 and 0 not in owner


def planted(n, rng):
    plain = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(n):
        words = list(rng.choice(plain, rng.integers(20, 300)))
        if k % 4 == 0:
            for _ in range(3):
                words[rng.integers(len(words))] = "vile" + rng.choice(["ra", "to", "mi"])
        rows.append((" ".join(words), int(k % 4 == 0)))
    return rows


def test_learned_words_and_unseen_forms():
    rng = np.random.default_rng(2)
    net = tx.fit(*map(list, zip(*planted(400, rng))))
    held = planted(200, rng)
    score = tx.text_scores(net, pa.array([t for t, _ in held], pa.large_string()))
    assert np.mean((score >= tx.THRESHOLD) == np.array([y for _, y in held])) > 0.97
    new = tx.text_scores(net, pa.array(["w1 w2 vileso w3", "w1 w2 w3 w4"], pa.large_string()))
    assert new[0] > new[1]


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(k, t, y) for k, (t, y) in enumerate(planted(120, rng))]
    odd = [(1000, None, 1), (1001, "", 0), (1002, " \n", None), (None, "w1 w2", 0), (1003, "w1 " * 40000 + "vilera vileto", 1), (1004, "w1", 0), (1004, "w1", 0)]
    docs = spark.createDataFrame([(i, t, 0) for i, t, _ in rows + odd], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows + odd], "doc_id long, toxic int")
    net = tx.train(docs, labels)
    got = tx.score(docs, net).collect()
    assert len(got) == len(rows + odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1000].score == by[1001].score == by[1002].score == 0 and by[1003].predicted == 1
    kept = tx.clean(docs, net)
    assert kept.columns == docs.columns and kept.count() == sum(1 - r.predicted for r in got)
    assert tx.score(docs.limit(0), tx.train(docs.limit(0), labels)).count() == 0
