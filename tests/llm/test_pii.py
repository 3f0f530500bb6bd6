"""Surrogates: nothing detected stays, one to one, tied references, kept formats."""

import re

import pytest

from winnow.llm import pii

PLAIN = re.compile(r"[\w.%+-]+@[\w.-]+\.[A-Za-z]{2,}|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])|(?<!\d)\d{16}(?!\d)|(?<=token = \")[0-9a-fA-F]{40}")


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r for r in pii.replace(docs).collect()}
    assert set(before) == set(after) and pii.replace(docs).columns == docs.columns
    pairs, everything = {}, {m.lower() for t in before.values() for m in PLAIN.findall(t or "")}
    for i, text in before.items():
        old, new = PLAIN.findall(text or ""), PLAIN.findall(after[i].text or "")
        assert len(old) == len(new)
        if not old:
            assert text == after[i].text
        assert PLAIN.sub("", text or "") == PLAIN.sub("", after[i].text or "")
        for a, b in zip(old, new):
            assert pairs.setdefault(a.lower(), b.lower()) == b.lower() and b.lower() not in everything
            assert re.sub("[0-9]", "9", re.sub("[a-z]", "a", a)) == re.sub("[0-9]", "9", re.sub("[a-z]", "a", b)) or re.fullmatch("[0-9a-fA-F]{40}|[0-9.]+", b)
            if re.fullmatch(r"\d{16}", a):
                assert luhn(a) == luhn(b) and a[0] == b[0]
    assert pairs and len(set(pairs.values())) == len(pairs)


def test_names_and_formats(spark):
    docs = spark.createDataFrame([
        (1, "Mr. John Smith and Mrs Smith; Frau Анна Белова. Dr O'Neil-Ray", "a"), (2, "call +44 20 7946 0958 or +442079460958", "b"),
        (3, None, "c"), (4, "", "d"), (None, "x@y.org X@Y.ORG", "e"), (None, "x@y.org X@Y.ORG", "e"), (7, "word " * 30000 + "10.0.0.1", "f")], "doc_id long, text string, _at string")
    rows = pii.replace(docs).collect()
    assert len(rows) == 7
    by = {r.doc_id: r.text for r in rows}
    given, family, again, cyrillic, doctor = re.fullmatch(r"Mr\. (\w+) (\w+) and Mrs (\w+); Frau (\w+ \w+)\. Dr ([\w'-]+)", by[1]).groups()
    assert given in pii.GIVEN["m", "latin"] and family == again and family in pii.FAMILY["latin"]
    first, last = cyrillic.split()
    assert first in pii.GIVEN["f", "cyrillic"] and last in pii.FAMILY["cyrillic"]
    a, b = by[2].removeprefix("call ").split(" or ")
    assert a.replace(" ", "") == b and a[:2] == "+4" and a != "+44 20 7946 0958"
    assert by[3] is None and by[4] == "" and "x@y.org" not in by[None].lower() and by[None].split()[0].upper() == by[None].split()[1]
    assert by[7].startswith("word word") and not by[7].endswith(" 10.0.0.1")
    assert pii.replace(docs.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["family-latin", "ssn"])
def test_collisions_are_resolved(spark, kind):
    norms = [f"n{k}" for k in range(300)] if kind != "ssn" else [f"{k:02d}" for k in range(40)]
    entities = spark.createDataFrame([(kind, n) for n in norms], "kind string, norm string")
    rows = pii.surrogates(entities, "k").collect()
    assert sorted(r.norm for r in rows) == sorted(norms)
    assert len({r.surrogate for r in rows}) == len(norms) and not {r.surrogate for r in rows} & set(norms)


def test_bare_mentions_of_a_titled_name(spark):
    texts = {1: "Weber's note: Dr. Anna Weber called. Weber said that Anna left; ANNA WEBER, Weber-Fans, Webern and weber. Dr. Weber’s car, 'Weber'",
             2: "Anna Weber signed", 3: "Frau O'Neil-Ray met Anna and O'Neil-Ray at 10.0.0.1, Anna", 4: "Herr Вера Белов. Белов, Вера", 5: "Mr Weber, Weber"}
    docs = spark.createDataFrame(list(texts.items()) + [(None, texts[5]), (None, texts[2])], "doc_id long, text string")
    rows = pii.replace(docs).collect()
    assert len(rows) == 7
    by = {r.doc_id: r.text for r in rows if r.doc_id}
    given, family = re.search(r"Dr\. ([\w-]+) ([\w-]+) called", by[1]).groups()
    assert {given, family} & {"Anna", "Weber"} == set()
    assert by[1] == (f"{family}'s note: Dr. {given} {family} called. {family} said that {given} left; {given.upper()} {family.upper()}, {family}-Fans, "
                     f"Webern and weber. Dr. {family}’s car, '{family}'")
    assert by[2] == texts[2] and sorted(r.text for r in rows if r.doc_id is None) == sorted([texts[2], f"Mr {family}, {family}"]) and by[5] == f"Mr {family}, {family}"
    ray = by[3].split()[1]
    assert ray != "O'Neil-Ray" and re.fullmatch(rf"Frau {ray} met Anna and {ray} at [\d.]+, Anna", by[3])
    first, last = re.fullmatch(r"Herr ([\w-]+) ([\w-]+)\. \2, \1", by[4]).groups()
    assert "Вера" != first and "Белов" != last
