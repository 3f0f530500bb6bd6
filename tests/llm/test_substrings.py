import hashlib
import random

import numpy as np
import pytest

from winnow.llm import substrings
from winnow.llm.substrings import Repeats


def brute(rows, length):
    """Every string of every text, in order of id."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        body = (text or "").encode()
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - length + 1):
            if body[i:i + length] in seen:
                gone[i:i + length] = True
            seen.add(body[i:i + length])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((doc, len(body), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def got(spark, rows, parts=4, **rule):
    docs = spark.createDataFrame([(d, t, 1, b"x", 2) for d, t in rows], "doc_id long, text string, part int, kept binary, id int").repartition(parts)
    found = substrings.without_repeats(docs, Repeats(**rule)).collect()
    for r in found:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in found), key=lambda r: (r[0] is not None, r[0] or 0))


def corpus(seed, docs=60, length=20):
    """Random words; some documents quote others, repeat themselves or a common line."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randrange(1, 7)))
    line = " ".join(word() for _ in range(8))
    texts = []
    for _ in range(docs):
        text = " ".join(word() for _ in range(draw.randrange(1, 60)))
        if texts and draw.random() < 0.6:
            other = draw.choice(texts)
            a = draw.randrange(len(other) + 1)
            text = text[:30] + other[a:a + draw.randrange(length * 4)] + text[30:]
        if draw.random() < 0.3:
            text += line + word()
        if draw.random() < 0.2:
            text += text[:draw.randrange(60)] + "\0" + text[-40:]
        texts.append(text)
    return [(d * 3 - 20, t) for d, t in enumerate(texts)]


EDGES = [(1, None), (None, "x" * 90), (2, ""), (3, "ab" * 100), (4, "ab" * 100), (5, "aaaa"), (6, "a" * 500), (7, "é" * 60), (8, "xé" + "é" * 40), (9, "x" * 31)]


@pytest.mark.parametrize("rule", [
    {"length": 20, "gram": 8}, {"length": 20, "gram": 4, "block": 300, "share": 2000, "merge": 500},
    {"length": 20, "gram": 8, "block": 700, "share": 1500, "merge": 3000, "hot": 2},
])
def test_equals_brute_force(spark, rule):
    rows = corpus(rule["gram"]) + [(d + 1000 if d is not None else None, t) for d, t in EDGES]
    want = brute(rows, 20)
    assert sum(r[2] for r in want) > 1000
    assert got(spark, rows, **rule) == want


def test_long_texts_and_a_large_group_of_copies(spark):
    draw = random.Random(5)
    long = "".join(draw.choice("abcdefgh ") for _ in range(40_000))
    rows = [(k, long[:3000]) for k in range(40)] + [(100, long), (101, "y" + long[500:] + long[:700]), (102, "z" * 20_000)]
    assert got(spark, rows, block=9000, share=60_000, merge=20_000) == brute(rows, 100)


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "q" * 50 + "r" * 60), (1, "q" * 50 + "r" * 60), (2, "q" * 50 + "r" * 60), (3, "short")]
    assert [r[2] for r in got(spark, rows)] == [0, 0, 110, 0]


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.without_repeats(docs).count() == 0
    assert [r["n_bytes"] for r in substrings.without_repeats(spark.createDataFrame([(1, None)], docs.schema)).collect()] == [0]


def suffixes(strings, first):
    """Plain order of all suffixes: an end sorts by its number before all bytes."""
    rows = [(tuple(s[i:]) , k, i) for k, s in enumerate(strings, first) for i in range(len(s) + 1)]
    return sorted(rows, key=lambda r: [(1, b) for b in r[0]] + [(0, r[1])])


def test_merge_orders_suffixes_as_a_sort_does():
    draw = random.Random(3)
    sets = [[bytes(draw.choice(b"ab\0") for _ in range(draw.randrange(1, 40))) for _ in range(draw.randrange(1, 9))] for _ in range(4)]
    made, before = [], 0
    for strings in sets:
        held = np.frombuffer(b"".join(strings), np.uint8)
        symbols, rows, whose = substrings.transform(held, np.array(list(map(len, strings))))
        plain = suffixes(strings, 0)
        assert [int(s) for s in symbols] == [strings[k][i - 1] if i else 0 for _, k, i in plain]
        assert [(int(r), int(w)) for r, w in zip(rows, whose)] == [(n, k) for n, (_, k, i) in enumerate(plain) if i == 0]
        made.append((symbols, rows, whose))
    everything = [s for strings in sets for s in strings]
    for length in (1, 3, 4, 11):
        merge = substrings.Merge(made)
        order, heads = merge.repeated(length)
        string, offset = merge.places([np.array(list(map(len, strings))) for strings in sets])
        found = [everything[s][o:o + length] for s, o in zip(string[order], offset[order])]
        groups = {}
        for k, s in enumerate(everything):
            for i in range(len(s) - length + 1):
                groups.setdefault(s[i:i + length], []).append((k, i))
        want = sorted((g for g, at in groups.items() if len(at) > 1))
        assert [found[h] for h in heads] == want
        cuts = [*heads, len(order)]
        assert [sorted(zip(string[order[a:b]].tolist(), offset[order[a:b]].tolist())) for a, b in zip(cuts, cuts[1:])] == [sorted(groups[g]) for g in want]
