"""Segmented encoding against direct encoding; packing against its contract."""

import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from winnow.llm import packing
from winnow.llm.tokens import TokenEncoder

ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a \nb", "a \n b", "foo\n\n bar,\nBaz.", "it's  don't 12,5  x", "tab\t\tx y",
       "é  b c", "é x", "x  y", "end \n", "<|endoftext|> z", "a\x1fb c", "ÀB ÇD.\nÉf, q", "!? , .", "a\x85 b", "I'LL We're", "Σας ΟΔΟΣ"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_segments_equal_direct_encoding(name, sf):
    import pyarrow.parquet as pq

    texts = ODD + [t or "" for t in pq.read_table(f"{sf}/documents.parquet")["text"].to_pylist()][:80]
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    ids, ends = TokenEncoder(path).encode(pa.array(texts, pa.large_string()))
    for text, a, b in zip(texts, ends[:-1], ends[1:]):
        assert ids[a:b].tolist() == plain.encode(text, add_special_tokens=False).ids, text


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_new_stretches_share_texts(name):
    rng = np.random.default_rng(5)
    letters = list("abcxyzABC éßñ中ж07'-.,;!?\"%\t\u0301\U0001f600") + ["'s", "I'll", "<|endoftext|>"]
    words = ["".join(rng.choice(letters, rng.integers(1, 9))) for _ in range(4000)]
    texts = [" ".join(words[k:k + 40]) for k in range(0, 4000, 40)] + ODD + [t + "\n" + t for t in words[:50]]
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    for remembered in (600_000, 300):
        encoder = TokenEncoder(path, remembered)
        for _ in range(2):
            for start in range(0, len(texts), 30):
                part = texts[start:start + 30]
                ids, ends = encoder.encode(pa.array(part, pa.large_string()))
                assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want[start:start + 30]
    encoder = TokenEncoder(path)
    encoder.tokenizer = Counting(encoder.tokenizer)
    rare = " ".join(f"w{k}x{k * k}" for k in range(5000))
    ids, _ = encoder.encode(pa.array([rare], pa.large_string()))
    assert ids.tolist() == plain.encode(rare, add_special_tokens=False).ids
    assert encoder.tokenizer.texts < 100  # and not one for each of the 5000


def test_column_generation_meets_demand():
    rng = np.random.default_rng(3)
    sizes, demand = np.arange(1, 65), rng.integers(0, 40, 64)
    plan = packing.solve(demand, sizes, 64)
    assert (sum(p * n for p, n in plan) == demand).all()
    assert all(p @ sizes <= 64 for p, _ in plan)
    assert sum(n for _, n in plan) <= math.ceil(demand @ sizes / 64) * 1.03 + 1
    assert packing.solve(np.zeros(4, np.int64), np.arange(1, 5), 4) == []


def test_knapsack_against_enumeration():
    best, taken = packing.knapsack(np.array([0.34, 0.5, 0.9]), np.array([3, 5, 7]), 11)
    brute = max(a * 0.34 + b * 0.5 + c * 0.9 for a in range(4) for b in range(3) for c in range(2) if 3 * a + 5 * b + 7 * c <= 11)
    assert best == pytest.approx(brute) and taken @ np.array([3, 5, 7]) <= 11


def packed(df, tokenizer, texts):
    plain = Tokenizer.from_file(tokenizer)
    rows = [r.asDict() for r in df.collect()]
    want = {}
    for i, t in texts:
        want.setdefault(i, []).append(plain.encode(t or "", add_special_tokens=False).ids + [1])
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert {k: sum(map(len, v)) for k, v in want.items()} == {k: sum(r["length"] for r in v) for k, v in by_doc.items()}
    for i, own in want.items():
        cut = sorted(zlib.crc32(np.array(w[s:s + 2048], "<u4").tobytes()) for w in own for s in range(0, len(w), 2048))
        assert cut == sorted(r["ids_crc32"] for r in by_doc[i])
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by_seq.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 2048
    return by_seq


def test_packing_of_odd_rows(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [(1, "a b c"), (2, None), (3, ""), (None, "null id"), (1, "a b c"), (9, "word " * 9000)] + [(100 + k, "x y z") for k in range(60)]
    docs = spark.createDataFrame([(i, t, 5, "k") for i, t in texts], "doc_id long, text string, sequence_id int, kind string")
    packed(packing.pack(docs, path), path, texts)
    assert packing.pack(docs.limit(0), path).count() == 0


def test_packing_fills_sequences(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    filled = packed(packing.pack(docs, path), path, [(r.doc_id, r.text) for r in docs.collect()])
    tokens = sum(n for spans in filled.values() for _, n in spans)
    assert tokens / (2048 * len(filled)) > 0.95
