"""Fingerprints against the plain definition, the block tables against all pairs."""

import hashlib

import numpy as np
import pyarrow as pa

from winnow.llm import simhash


def by_hand(rows):
    rows = sorted(rows, key=lambda r: r[0])
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1] or ""
        t = t or ""
        h = len(t) // 2
        yield i, len(t), hashlib.sha256((t[:len(t) - h] + nxt[:h]).encode()).hexdigest(), t, nxt


def test_with_next(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in simhash.with_next(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(got) == len(rows)
    for i, n, sha, text, nxt in by_hand(rows):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.fingerprint == simhash.hexes(simhash.fingerprints(pa.array([text])))[0]
        if text == nxt:
            assert r.near_next == 1
    long = [r for r in got.values() if r.n_chars > 300]
    assert np.mean([r.near_edited > r.near_next for r in long if r.near_next < 0.9]) > 0.97


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "x"), (4, "äö ü"), (5, "a b c d"), (6, "a b c d")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, range int")
    got = {r.doc_id: r for r in simhash.with_next(docs).collect()}
    for i, n, sha, *_ in by_hand(rows):
        assert (got[i].n_chars, got[i].edited_sha256) == (n, sha)
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[5].fingerprint == got[6].fingerprint and got[5].near_next == 1
    assert simhash.with_next(docs.limit(0)).count() == 0
    assert [r.doc_id for r in simhash.with_next(docs.limit(1)).collect()] == [1]
    repeated = spark.createDataFrame([(None, "n"), (7, "b"), (7, "a"), (7, "a")], "doc_id long, text string")
    assert simhash.with_next(repeated).count() == 4


def test_block_tables_find_all(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2, (40, 128))
    rows = [base]
    for flips in (1, 2, 3, 4, 5):
        other = base.copy()
        for row in other:
            row[rng.choice(128, flips, replace=False)] ^= 1
        rows.append(other)
    bits = np.concatenate(rows)
    prints = [f"{int(''.join(map(str, b)), 2):032x}" for b in bits]
    want = {(prints[i], prints[j], int(d)) for i in range(len(bits)) for j in range(len(bits)) if 0 < (d := (bits[i] != bits[j]).sum()) <= 3}
    frame = spark.createDataFrame([(p,) for p in prints], "print string")
    for radius, blocks in ((3, 5), (3, 4), (2, 6)):
        got = [tuple(r) for r in simhash.neighbours(frame, frame, radius, blocks).collect()]
        assert len(got) == len(set(got)) and set(got) == {w for w in want if w[2] <= radius}
