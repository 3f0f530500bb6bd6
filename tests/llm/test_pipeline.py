"""The pipeline's stages on a small corpus with planted cases, each against a plain rule."""

import numpy as np

import corpus_pipeline as cp
from winnow.llm import toxicity


def test_stages(spark, tmp_path):
    rng = np.random.default_rng(6)
    words = [f"word{k}" for k in range(900)]
    plain = {k: list(rng.choice(words, 80)) for k in range(240)}
    toxic = {k for k in range(0, 240, 6)}
    for k in toxic:
        for at in rng.choice(80, 6, replace=False):
            plain[k][at] = "vile" + str(rng.choice(["ra", "to", "mi"]))
    item = list(rng.choice(words, 30))
    plain[31][20:20] = item
    plain[37][5:5] = [*item[:10], "changed", *item[11:]]
    plain[43] = [*plain[41][:-1], "ending"]
    plain[47] = list(plain[41])
    plain[49][3] = "write.to@me.example.org"
    text = {k: " ".join(v) for k, v in plain.items()} | {300: None, 301: ""}
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or ""), "x") for k, t in text.items()], "doc_id long, text string, lang string, source string, n_chars long, set string")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 0, int(k in toxic)) for k in plain], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, " ".join(item))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    seen, now = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in cp.STAGES:
        now = cp.pinned(stage(spark, now, folder), f"test-{name}")
        seen[name] = {r.doc_id: r for r in now.collect()}
        if name != "packing":
            assert now.columns == docs.columns
    everything = set(text)
    assert len(set(seen["toxicity"]) & toxic) <= 2 and len(everything - toxic - set(seen["toxicity"])) <= 4
    first = set(seen["toxicity"])
    group = sorted({41, 43, 47} & first)
    assert set(seen["near_duplicates"]) == first - set(group[1:])
    assert set(seen["decontamination"]) == set(seen["near_duplicates"]) - {31, 37}
    assert set(seen["pii"]) == set(seen["decontamination"]) == set(seen["packing"])
    if 49 in seen["pii"]:
        r = seen["pii"][49]
        assert "write.to@me" not in r.text and r.n_chars == len(r.text) and " ".join(plain[49]).split("write")[0] == r.text[:r.text.index("@")].rpartition(" ")[0] + " "
    assert cp.run(spark, folder).count() == len(seen["packing"])
    assert toxicity.THRESHOLD == 0.3
