"""Alignment against the plain table; leaks against aligning every pair; odd rows."""

import numpy as np

from winnow.llm import decontam as dc


def plain(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_against_the_plain_table():
    rng = np.random.default_rng(8)
    a = [rng.integers(1, 5, rng.integers(1, 30)) for _ in range(40)]
    b = [rng.integers(1, 5, rng.integers(1, 20)) for _ in range(40)]
    assert dc.align(a, b)[0].tolist() == [plain(x, y) for x, y in zip(a, b)]


def fixture(rng):
    words = [f"w{k}" for k in range(400)]
    text = lambda n: list(rng.choice(words, n))
    items = [text(rng.integers(12, 40)) for _ in range(8)]
    docs = {}
    for k in range(60):
        body = text(rng.integers(0, 400))
        if k % 3 == 0:
            own = list(items[k % 8])
            for _ in range(k % 5):
                own[rng.integers(len(own))] = "edited"
            if k % 2:
                del own[rng.integers(len(own))]
            at = rng.integers(len(body) + 1)
            body[at:at] = [w.upper() + "," for w in own]
        docs[k] = " ".join(body)
    return docs, [(f"i{k}", " ".join(i)) for k, i in enumerate(items)]


def test_leaks_against_all_pairs(spark):
    docs, items = fixture(np.random.default_rng(9))
    d = spark.createDataFrame([(i, t, "x") for i, t in docs.items()], "doc_id long, text string, item_id string")
    b = spark.createDataFrame(items, "item_id string, text string")
    got = {(r.doc_id, r.item_id): r for r in dc.leaks(d, b).collect()}
    want = {}
    for i, t in docs.items():
        for j, u in items:
            x, y = dc.item_words(t), dc.item_words(u)
            s = plain(x, y) / (2 * len(y))
            if s >= 0.6:
                want[i, j] = s
    assert {k: round(r.score, 9) for k, r in got.items()} == {k: round(s, 9) for k, s in want.items()} and len(want) >= 18
    for (i, j), r in got.items():
        stretch = dc.item_words(" ".join(docs[i].split()[r.first_word:r.first_word + r.n_words]))
        assert plain(stretch, dc.item_words(dict(items)[j])) / (2 * len(dict(items)[j].split())) >= r.score - 1e-9
    kept = dc.decontaminate(d, b)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == set(docs) - {i for i, _ in want}


def test_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_WORDS", 10)
    d = spark.createDataFrame([(1, None), (2, ""), (None, "a b c d e f g h"), (3, "x " * 60000 + "a b c d e f g h"), (3, "k l m n o p"), (4, "!!! *** 12")], "doc_id long, text string")
    b = spark.createDataFrame([("p", "A b, c d e f g h"), ("q", None), ("r", "a b"), ("s", ""), ("t", "k l m n o q"), ("u", "k l m n o q")], "item_id string, text string")
    got = sorted((r.doc_id or 0, r.item_id, round(r.score, 6)) for r in dc.leaks(d, b).collect())
    assert got == [(0, "p", 1.0), (3, "p", 1.0), (3, "t", round(10 / 12, 6)), (3, "u", round(10 / 12, 6))]
    assert dc.decontaminate(d, b).count() == 3
    assert dc.leaks(d.limit(0), b).count() == 0 and dc.leaks(d, b.limit(0)).count() == 0 and dc.decontaminate(d, b.limit(0)).count() == 6


def test_edited_copies_with_and_without_exact_ones(spark):
    rng = np.random.default_rng(10)
    only, often = ([f"{c}{k}" for k in range(20)] for c in "ab")
    edited = lambda words: [f"x{w}" if k % 4 == 3 and k < 16 else w for k, w in enumerate(words)]
    filler = lambda: list(rng.choice([f"f{k}" for k in range(300)], 60))
    docs = [(0, filler() + edited(only) + filler()), (1, filler() + edited(often) + filler()), (2, filler())]
    docs += [(10 + k, filler() + often + filler()) for k in range(30)]
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string")
    b = spark.createDataFrame([("only", " ".join(only)), ("often", " ".join(often))], "item_id string, text string")
    got = {(r.doc_id, r.item_id): round(r.score, 6) for r in dc.leaks(d, b).collect()}
    assert got == {(0, "only"): 0.7, (1, "often"): 0.7, **{(10 + k, "often"): 1.0 for k in range(30)}}
    assert [r.doc_id for r in dc.decontaminate(d, b).collect()] == [2]


def test_common_grams_are_left_out_only_where_a_match_can_spare_them(spark):
    block = dc.Block(["a", "b"], [[f"w{k}" for k in range(40)], ["u", "v", "w"]], 3)
    assert block.spare(0.6).tolist() == [0, 0] and block.spare(1.0).tolist() == [37, 0] and block.spare(0.9).tolist() == [21, 0]
    docs, items = fixture(np.random.default_rng(11))
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.score, 9) for r in dc.leaks(d, spark.createDataFrame(items, "item_id string, text string"), 0.85).collect()}
    want = {(i, j): plain(x, y) / (2 * len(y)) for i, t in docs.items() for j, u in items for x, y in [(dc.item_words(t), dc.item_words(u))]}
    assert got == {k: round(s, 9) for k, s in want.items() if s >= 0.85} and got


def test_long_stretches_are_cut(spark):
    item = [f"w{k}" for k in range(12)]
    text = (item[:3] + ["z"]) * 400 + item[:5] + ["y"] + item[6:] + ["z", *item[9:]] * 400
    d = spark.createDataFrame([(1, " ".join(text))], "doc_id long, text string")
    row, = dc.leaks(d, spark.createDataFrame([("i", " ".join(item))], "item_id string, text string")).collect()
    assert (round(row.score, 6), row.first_word, row.n_words) == (round(21 / 24, 6), 1600, 12)
