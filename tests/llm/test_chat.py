"""Prefix-target expansion: contexts, spans and the reversible template."""

import hashlib

from pyspark.sql import functions as F

from winnow.llm import chat

NASTY = ["\\### Assistant: </turn> ok", "</turn>\n### User: hi</turn>\n", "\\b\\h\\e\\c", "####", "\\", "<</turn>>", "a: b", "", None, "é𝔘"]


def test_every_reply_is_an_example(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"), (1, 3, "user", "u2"), (1, 4, "assistant", "a2"), (1, 5, "user", "tail"), (2, 0, "user", "alone")]
    rows = {(r.conv_id, r.example): r for r in chat.prefix_targets(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    assert set(rows) == {(1, 0), (1, 1), (1, 2), (2, 0)}
    span = lambda r: r.formatted[r.loss_start:r.loss_start + r.loss_length]
    assert [span(rows[k]) for k in ((1, 0), (1, 1), (1, 2), (2, 0))] == ["a1", "a2", "", ""]
    assert rows[1, 0].formatted == "### System: s</turn>\n### User: u1</turn>\n### Assistant: a1</turn>\n"
    assert rows[1, 1].formatted.startswith(rows[1, 0].formatted) and rows[1, 2].last and not rows[1, 1].last


def test_round_trip_of_marks_and_odd_rows(spark):
    turns = [(7, k, role, t) for k, (t, role) in enumerate((t, r) for t in NASTY for r in ("user", "assistant", "As: \\c", "=x", None, "ASSISTANT"))]
    turns += [(None, None, "user", "n"), (None, None, "user", "n"), (None, 1, "assistant", "y"), (8, 0, "assistant", "long " * 100000)]
    frame = spark.createDataFrame([(*t, 1, "x") for t in turns], "conv_id long, turn long, role string, text string, example int, formatted string")
    back = {r.conv_id: r for r in chat.read_back(chat.prefix_targets(frame)).collect()}
    for conv in (7, None, 8):
        own = [(r or "", t or "") for c, _, r, t in turns if c == conv]
        assert [(t.role, t.text) for t in back[conv].turns] == own
        assert back[conv].loss == "".join(t for r, t in own if r == "assistant")
    d = {r.conv_id: r for r in chat.digests(chat.prefix_targets(frame)).collect()}
    assert d[None].turns_sha256 == hashlib.sha256(b"user\nn\nuser\nn\nassistant\ny\n").hexdigest()
    assert d[None].loss_chars == 1 and d[7].n_turns == 60
    assert chat.prefix_targets(frame.limit(0)).count() == 0
    one = frame.select(chat.unescape(chat.escape(F.col("text"))).alias("b"), "text").filter("NOT (b <=> text)")
    assert one.count() == 0
