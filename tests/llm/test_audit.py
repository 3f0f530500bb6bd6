import re
from itertools import permutations

from winnow.llm import audit

WORDS = [f"w{k}" for k in range(120)]


def brute(rows, labels):
    """Every document walked through every order."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    docs = []
    for doc, text, source in rows:
        text, words = text or "", re.findall(r"[^\x20\x09-\x0D]+", text or "")
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
            fails.add("C")
        if any(c in "#$%&*|" for c in text):
            fails.add("D")
        if doc is not None and any(o is not None and o < doc and (t or "") == text for o, t, _ in rows):
            fails.add("E")
        docs.append((source or "", fails, doc in good, doc in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = list(mine)
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                before = len([d for d in mine if f in d[1]]) - len(gone)
                left = [d for d in left if f not in d[1]]
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), before, sum(d[1] == {f} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    share = {}
    for (part, order, step), row in out.items():
        share[part, order[step - 1]] = share.get((part, order[step - 1]), 0) + row[1]
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


ROWS = [
    (1, " ".join(WORDS * 2), "a"), (2, " ".join(WORDS * 2), "b"), (2, " ".join(WORDS * 2), "a"), (2, " ".join(WORDS * 2), "a"),
    (3, None, None), (4, "", ""), (None, "", "a"), (None, "ABC # x", "a"), (5, "Ünter\x0bden\x1cA B C D", "b"),
    (6, "x " * 30000, "c"), (7, "|" + " ".join(WORDS) + "\n" + " ".join(w + "z" for w in WORDS), "c"), (-9, "x " * 30000, "b"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 1), (6, None, 1), (None, 1, 1), (99, 1, 1)]


def test_edges_against_a_walk_through_all_orders(spark):
    docs = spark.createDataFrame([(*r, 1, 2) for r in ROWS], "doc_id long, text string, source string, hash int, failed int")
    got = audit.audit(docs, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")).collect()
    want = brute(ROWS, LABELS)
    assert len(got) == len(want)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(docs, labels).count() == 0
    some = spark.createDataFrame([(1, "x", "s")], docs.schema)
    assert audit.audit(some, labels).count() == 600
