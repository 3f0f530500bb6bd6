"""Licence scan against a plain scan of every part with every template; odd rows."""

import re

from winnow.llm import licenses


def pairs_of(text):
    w = re.sub(r"[\W_]+", " ", text.lower()).split()
    return {f"{a} {b}" for a, b in zip(w, w[1:])}


def brute(text, threshold=0.8):
    lines = re.split(r"\r?\n", text)
    parts = {text, *re.split(r"\n[ \t\r]*\n", text), *lines, *(s for x in lines for s in re.split(r"(?<=[.!?;:])[ \t]+", x))}
    found = {}
    for part in parts:
        p = pairs_of(part)
        for name, template in licenses.TEMPLATES:
            t = pairs_of(template)
            d = 2 * len(p & t) / max(1, len(p) + len(t))
            if d >= threshold:
                found[name] = max(found.get(name, 0), d)
    return found


def test_against_brute_force(spark):
    mit = next(t for n, t in licenses.TEMPLATES if t.startswith("Permission is hereby granted, free of charge"))
    edited = mit.replace("obtaining", "receiving").replace("whom the Software", "whom this Software")
    texts = {1: "code\n\n# " + mit.replace(", ", ",\n# ") + "\n\nmore code", 2: "Some words. released UNDER the mit license! End", 3: edited,
             4: None, 5: "", 6: "license", 7: "Licensed under the Apache License, Version 2.0.\r\nLicensed under CC BY-NC 4.0.", 8: "word " * 40000,
             9: "Licensed under the Python License, Version 2.0.", 10: "under the the the license"}
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t in texts.items()] + [(2, texts[2], "x", 0.1)], "doc_id long, text string, license string, dice double")
    got = {}
    for r in licenses.scan(docs).collect():
        got.setdefault(r.doc_id, {})[r.license] = round(r.dice, 9)
    assert got == {i: {n: round(d, 9) for n, d in f.items()} for i, t in texts.items() if (f := brute(t or ""))}
    assert set(got) >= {1, 2, 3, 7}
    assert licenses.scan(docs.limit(0)).count() == 0 and licenses.scan(docs, templates=[]).count() == 0


def test_signs_are_needed():
    for name, pairs in licenses.template_rows(licenses.TEMPLATES):
        least = -(-len(pairs) * 2 // 3)
        assert len(licenses.signs(pairs, 0.8)) == len(pairs) - least + 1, name
