"""Sketches, links and components against brute force; odd rows."""

import re

import numpy as np
import pytest

from winnow.llm import neardup as nd


def brute(rows, width, percent):
    """doc -> (set size, least linked doc), by all pairs of full sets."""
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus(rng, n=160):
    words = [f"w{k}" for k in range(500)]
    base = [list(rng.choice(words, rng.integers(1, 120))) for _ in range(12)]
    rows = []
    for k in range(n):
        own = list(base[k % 12]) if k % 4 else list(rng.choice(words, 60))
        for _ in range(k % 6):
            own[rng.integers(len(own))] = str(rng.choice(words))
        rows.append((k * 3, " ".join(own).upper() if k % 9 == 0 else "\t".join(own)))
    return rows


@pytest.mark.parametrize("width", [4, 5])
@pytest.mark.parametrize("tile", [256, 3])
def test_against_all_pairs(spark, width, tile, monkeypatch):
    monkeypatch.setattr(nd, "TILE_SETS", tile)
    rows = corpus(np.random.default_rng(width))
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, set string, bands int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(docs, nd.NearDup(width=width)).collect()}
    want = brute(rows, width, 80)
    assert got == want
    kept = nd.deduplicate(docs, nd.NearDup(width=width))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {c for _, c in want.values()}


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:320], rng.integers(0, 2**63, 80).astype(np.uint64)])
    one = a[:1]
    got = nd.sketches(np.concatenate([a, b, one]), np.array([0, 400, 800, 801]), 252)
    assert (got != nd.EMPTY).all()
    assert abs((got[0] == got[1]).mean() - 320 / 480) < 0.12
    assert (nd.sketches(a[::-1].copy(), np.array([0, 400]), 252)[0] == got[0]).all()
    assert (nd.sketches(a[:0], np.array([0, 0]), 8) == nd.EMPTY).all()


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 103), (103, 101), (7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in nd.components(frame).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 103: 100}


def test_odd_rows(spark):
    rows = [(5, None), (6, ""), (7, " \n"), (None, "a b c d e f"), (9, "a b c d e f"), (None, "only here is this text"), (3, "x y"), (4, "X  y"),
            (8, "same same"), (8, "same same"), (10, "long " + " ".join(f"v{k}" for k in range(50000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(docs).collect())
    assert got == [(False, 0, 1, None, True), (False, 0, 2, 9, False), (True, 3, 1, 3, True), (True, 4, 1, 3, False), (True, 5, 0, 5, True),
                   (True, 6, 0, 6, True), (True, 7, 0, 7, True), (True, 8, 1, 8, True), (True, 8, 1, 8, True), (True, 9, 2, 9, True), (True, 10, 49997, 10, True)]
    assert nd.deduplicate(docs).count() == 9
    assert nd.near_duplicates(docs.limit(0)).count() == 0


def test_texts_under_one_id_meet_their_own_sets_only(spark):
    words = [[f"w{g}x{k}" for k in range(40)] for g in range(30)]
    texts = [" ".join(w + t) for w in words for t in ([], ["more"])]
    for doc in (None, 5):
        docs = spark.createDataFrame([(doc, t) for t in texts + texts[:1] * 9], "doc_id long, text string")
        signed = nd.signatures(docs, nd.NearDup(), "doc_id", "text").filter("set is not null")
        wanted = signed.selectExpr("set", "doc_id as rep", "hash as rep_hash").distinct()
        assert {r.text for r in nd.of_representatives(docs, wanted, "doc_id", "text").collect()} == set(texts)
        edges = nd.links(docs, signed.selectExpr("set", "doc_id as rep", "hash as rep_hash", "n", "bands").dropDuplicates(["set"]), nd.NearDup(), "doc_id", "text")
        assert len({frozenset(r) for r in edges.collect()}) == 30


def test_keys_are_exchanged_once_and_shingles_twice(spark):
    words = [f"w{k}" for k in range(60)]
    docs = spark.createDataFrame([(k, " ".join(words[: 60 - k % 3])) for k in range(12)] + [(50, "far from all the others")], "doc_id long, text string")
    signed = nd.signatures(docs, nd.NearDup(), "doc_id", "text").filter("set is not null")
    sets = signed.selectExpr("set", "doc_id as rep", "hash as rep_hash", "n", "bands").dropDuplicates(["set"])
    held = {}
    for r in sets.selectExpr("xxhash64(set) as member", "n", "bands").collect():
        for band, key in enumerate(r.bands):
            held.setdefault((key & -2) if band < 7 else (key | 1), set()).add((r.member, r.n))
    got = {(r.bucket, r.member, r.n, r.early) for r in nd.buckets(sets, 7).collect()}
    assert got == {(b, m, n, b % 2 == 0) for b, s in held.items() if len(s) > 1 for m, n in s} and {g[3] for g in got} == {True, False}

    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        dealt = nd.starred(nd.mixed(nd.buckets(sets, 7), None))
        plan = nd.compared(docs, sets, dealt, nd.NearDup(), "doc_id", "text")._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    depth = lambda line: len(re.match(r"[ :+\-]*", line)[0])
    at = next(k for k, line in enumerate(plan) if "MapInArrow" in line)
    above, least = [], depth(plan[at])
    for line in reversed(plan[:at]):
        if depth(line) < least:
            above.append(line)
            least = depth(line)
    assert sum("Exchange hashpartitioning" in line for line in above) == 2
