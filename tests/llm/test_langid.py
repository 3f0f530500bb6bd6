"""Forward-backward against enumeration; held-out accuracy; code-switched words; odd rows."""

import itertools
import zlib

import numpy as np

from winnow.llm import langid


def test_posteriors_against_enumeration():
    rng = np.random.default_rng(1)
    model = langid.ChainModel(["a", "b", "c"])
    model.moves = rng.normal(size=(3, 3)).astype(np.float32)
    offsets = np.array([0, 4, 4, 5, 8])
    scores = rng.normal(size=(8, 3)).astype(np.float32)
    got = model.posteriors(scores, offsets)
    for a, b in zip(offsets[:-1], offsets[1:]):
        want = np.zeros((b - a, 3))
        for path in itertools.product(range(3), repeat=int(b - a)):
            v = np.exp(sum(scores[a + t, k] for t, k in enumerate(path)) + sum(model.moves[i, j] for i, j in zip(path, path[1:])))
            for t, k in enumerate(path):
                want[t, k] += v
        if b > a:
            np.testing.assert_allclose(got[a:b], want / want.sum(1, keepdims=True), rtol=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, most=100)
    rows = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert set(rows) == set(truth)
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1
    out = [i for i, r in rows.items() if r.held_out]
    assert np.mean([rows[i].lang_pred == truth[i] for i in out]) > 0.97
    fr = next(r.text for r in docs.filter("lang = 'fr' and n_chars > 800").limit(1).collect()).split()[:40]
    en = next(r.text for r in docs.filter("lang = 'en' and n_chars > 800").limit(1).collect()).split()[:40]
    mixed = spark.createDataFrame([(1, " ".join(fr + en))], "doc_id long, text string")
    words = langid.label_words(mixed, model).orderBy("position").collect()
    assert np.mean([w.lang == ("fr" if w.position < 40 else "en") for w in words]) > 0.8


def test_odd_rows(spark):
    rows = [(1, "the and of words", "en"), (2, "le la des mots", "fr"), (3, None, None), (4, "", "en"), (5, "12 ... !", "fr"),
            (None, "the of", None), (7, "word " * 50000, None), (7, "word " * 50000, None), (8, "12a34", "en")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    got = langid.predict(docs, langid.train(docs)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[3].lang_pred == by[4].lang_pred == by[5].lang_pred == "und" and by[3].score == 0
    assert by[8].lang_pred in ("en", "fr") and by[7].lang_pred in ("en", "fr")
    none = docs.filter("lang is null")
    assert {r.lang_pred for r in langid.predict(none, langid.train(none)).collect()} == {"und"}
    assert langid.predict(docs.limit(0), langid.train(docs.limit(0))).count() == 0
