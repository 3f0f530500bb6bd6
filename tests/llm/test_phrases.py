import random
import re
from collections import Counter

import pyarrow as pa

from winnow.llm import phrases


def brute(rows, least, top):
    """All phrases of up to four words, counted piece by piece."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    out = []
    for lang in n:
        here = {w: a for (g, w), a in f.items() if g == lang and a >= least and len(w) > 1}
        found = []
        for w, a in here.items():
            longer = [b for v, b in here.items() if len(v) > len(w) and any(v[i:i + len(w)] == w for i in range(len(v)))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            found.append((-score, -a, " ".join(w).encode(), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
        for rank, row in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, row[2].decode(), *row[3:]))
    return sorted(out)


def texts(seed, count, longest=40):
    draw = random.Random(seed)
    words = ["a", "b", "A", "c", "é", "\x1c", "zz", "ab", "x\x85y"]
    joins = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", " ? ", "\x0b"]
    def line():
        return "".join(draw.choice(words) + draw.choice(joins) for _ in range(draw.randrange(longest)))
    return [(draw.choice(["en", "en", "en", "de", None]), draw.choice([line(), line(), line(), None, "", "..", "a b c zz"])) for _ in range(count)]


def check(spark, rows, parts=3, **rule):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, len int").repartition(parts)
    rule = phrases.Mining(**rule)
    got = sorted(tuple(r) for r in phrases.collocations(docs, rule).collect())
    assert got == brute(rows, rule.least, rule.top)
    return got


def test_counts_equal_brute_force(spark):
    assert len(check(spark, texts(1, 300), least=6, top=50)) > 40


def test_a_saturated_sieve_changes_nothing(spark):
    check(spark, texts(2, 200), least=5, shards=2, slots=2)


def test_ties_repeats_and_a_long_text(spark):
    rows = [("en", "one two three four. " * 40), ("en", "two one four three " * 3000)] + [("fr", "le chat\nLE CHAT le")] * 30
    check(spark, rows, parts=4, shards=4)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(docs).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None), ("en", "")], docs.schema)).count() == 0


def test_sums_leave_a_task_in_small_batches():
    names = [f"w{k}" for k in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 1000), pa.array([1] * 1000, pa.int32()), pa.array(names), pa.array(range(1000))], schema=phrases.SPELLED)
    for most in (300, 5000):
        out = list(phrases.folded(iter([batch] * 7), most, 64))
        assert max(map(len, out)) <= 64
        total = Counter()
        for part in out:
            total.update(dict(zip(part["phrase"].to_pylist(), part["c"].to_pylist())) if len(set(part["phrase"].to_pylist())) == len(part) else {"twice": 1})
        assert total == Counter({f"w{k}": 7 * k for k in range(1000)})
    assert sum(map(len, phrases.folded(iter([batch] * 7), 5000))) == 1000
    assert max(map(len, phrases.folded(iter([pa.concat_batches([batch] * 40)])))) <= phrases.SENT


def test_sums_travel_as_a_blob_for_each_bucket():
    names = [f"w{k}" for k in range(1000)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"] * 1000), pa.array([1] * 1000, pa.int32()), pa.array(names), pa.array(range(1000)), pa.array([k % 7 for k in range(1000)], pa.int32())],
        schema=phrases.DEALT)
    sent = [row for part in phrases.by_bucket(iter([batch] * 9)) for row in part.to_pylist()]
    assert sorted(row["bucket"] for row in sent) == list(range(7))  # and not a row for each of the 1000
    found = Counter()
    for bucket in range(7):
        blobs = pa.RecordBatch.from_pylist([row for row in sent if row["bucket"] == bucket] * 2, pa.schema([("bucket", pa.int32()), ("blob", pa.binary())]))
        for part in phrases.added(iter([blobs]), 300):
            assert all(int(name[1:]) % 7 == bucket for name in part["phrase"].to_pylist())
            found.update(dict(zip(part["phrase"].to_pylist(), part["f"].to_pylist())))
    assert found == Counter({f"w{k}": 18 * k for k in range(1000) if 18 * k >= 300})


def test_sums_of_a_bucket_fold_while_they_are_read(monkeypatch):
    monkeypatch.setattr(phrases, "KEPT", 50)
    tables = [pa.RecordBatch.from_arrays([pa.array(["en"] * 40), pa.array([1] * 40, pa.int32()), pa.array([f"w{(k + j) % 90}" for k in range(40)]), pa.array([1] * 40)],
                                         schema=phrases.SPELLED) for j in range(90)]
    blobs = [phrases.squeezed(t.serialize().to_pybytes()) for t in tables]
    batch = pa.RecordBatch.from_arrays([pa.array([0] * 90, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])
    assert {r["phrase"]: r["f"] for part in phrases.added(iter([batch]), 1) for r in part.to_pylist()} == {f"w{k}": 40 for k in range(90)}
    assert list(phrases.added(iter([]), 1)) == []
