"""Token files: the hash is minimal and perfect, files give back every id."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from winnow.llm import tokenfile
from winnow.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20000])
def test_perfect_hash(n):
    keys = tokenfile.key_hash(np.arange(n) * 3 - n)
    table = tokenfile.PerfectHash.build(keys)
    assert sorted(table.slot(keys).tolist()) == list(range(n))


def test_perfect_hash_with_keys_left_over(monkeypatch):
    monkeypatch.setattr(tokenfile, "LEVELS", 1)
    keys = tokenfile.key_hash(np.arange(500))
    table = tokenfile.PerfectHash.build(keys)
    assert len(table.rest) and sorted(table.slot(keys).tolist()) == list(range(500))


def expected(rows):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    return [(i, plain.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows]


def test_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    folder = scratch_path(spark, "files")
    tokenfile.write(docs, folder, PATH)
    got = sorted(tuple(r) for r in tokenfile.read(spark, docs, folder, keep_ids=True).collect())
    at = 0
    for (i, ids), row in zip(expected(sorted((r.doc_id, r.text) for r in docs.collect())), got, strict=True):
        assert row == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        at += len(ids)
    strangers = spark.createDataFrame([(10**9 + k,) for k in range(2000)], "doc_id long")
    assert tokenfile.located(strangers, folder).count() == 0


def test_odd_rows(spark):
    rows = [(None, "n 1"), (None, "n 2"), (5, None), (-3, ""), (7, "same"), (7, "same")] + [(9, f"hot {k}") for k in range(300)] + [(11, "long " * 30000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, key int")
    folder = scratch_path(spark, "files")
    tokenfile.write(docs, folder, PATH, shards=16)
    got = tokenfile.read(spark, docs, folder).collect()
    assert sorted((r.key is not None, r.key or 0, r.ids_crc32) for r in got) == sorted(
        (i is not None, i or 0, zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in expected(rows))
    spans = sorted((r.start, r.n_tokens, r.key is not None, r.key or 0) for r in got)
    assert spans[0][0] == 0 and all(a[0] + a[1] == b[0] and a[2:] <= b[2:] for a, b in zip(spans, spans[1:]))


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    folder = scratch_path(spark, "files")
    assert tokenfile.write(docs, folder, PATH)["shards"] == []
    assert tokenfile.read(spark, docs, folder).count() == 0
