"""Chat formatting: every assistant turn becomes an example of its own.

An example holds the formatted turns before it as context and the reply as the only trainable
span. The template is ``### Role: text</turn>`` and a newline, once a turn. Inside texts and roles the
marks are written as escapes, so that formatted text can be read back without loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_END = "</turn>\n"
ROLES = ("system", "user", "assistant", "tool")


def escape(text: Column) -> Column:
    """Replace the template's marks; a backslash first, so that the codes stay unambiguous."""
    for mark, code in (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e")):
        text = F.replace(text, F.lit(mark), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`; the backslash last."""
    for mark, code in (("</turn>", "\\e"), ("###", "\\h"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(mark))
    return text


def head(role: Column) -> Column:
    """A known role with a capital letter, any other after ``=`` with its colons escaped."""
    own = F.concat(F.lit("="), F.replace(escape(role), F.lit(":"), F.lit("\\c")))
    return F.concat(F.lit("### "), F.when(role.isin(*ROLES), F.initcap(role)).otherwise(own), F.lit(": "))


def role_of(heading: Column) -> Column:
    own = unescape(F.replace(F.substr(heading, F.lit(2)), F.lit("\\c"), F.lit(":")))
    return F.when(F.startswith(heading, F.lit("=")), own).otherwise(F.lower(heading))


def prefix_targets(
    conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", trainable: str = "assistant",
) -> DataFrame:
    """One row per trainable turn: the conversation up to and with that turn, and its trainable span.

    Columns: ``conv``, ``example`` (from 0), ``n_turns`` (turns held), ``formatted``, ``loss_start`` and
    ``loss_length`` (code points of ``formatted``; escaped text of the reply alone), ``last`` (this
    row holds the whole conversation). Turns after the last reply, or a conversation without a reply, end up
    in one further row whose ``loss_length`` is 0, so no turn is lost.

    Null role or text: empty. Null ``conv``: one conversation of its own. Null turns come first; turns of equal
    number are ordered by role, then text, and repeated rows stay. No rows in, no rows out. Other columns are
    not read. A conversation is one value (its whole text is formatted), so it stays in one task; nothing
    else is gathered. Context is repeated in each example, which is what the expansion asks for.
    """
    rows = conversations.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("row"),
    )
    turns = rows.groupBy("conv").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    body = turns.select(
        "conv", F.transform("turns", lambda t: t["role"] == trainable).alias("trains"),
        F.transform("turns", lambda t: F.struct(head(t["role"]).alias("head"), escape(t["text"]).alias("text"))).alias("parts"),
    ).select(
        "conv", "trains", "parts",
        F.transform("parts", lambda p: F.concat(p["head"], p["text"], F.lit(TURN_END))).alias("segments"),
    )
    upto = F.sequence(F.lit(1), F.size("segments"))
    ends = F.filter(upto, lambda k: F.element_at("trains", k) | (k == F.size("segments")))
    at = F.element_at("parts", F.col("n_turns"))
    replies = F.element_at("trains", F.col("n_turns"))
    formatted = F.concat_ws("", F.slice("segments", F.lit(1), F.col("n_turns")))
    return (
        body.select("conv", "trains", "parts", "segments", F.posexplode(ends).alias("example", "n_turns"))
        .select(
            "conv", F.col("example").cast("long"), F.col("n_turns").cast("long"),
            (F.col("n_turns") == F.size("segments")).alias("last"), formatted.alias("formatted"),
            F.when(replies, F.length(at["text"])).otherwise(0).cast("long").alias("loss_length"),
        )
        .withColumn("loss_start", F.length("formatted") - F.length(F.lit(TURN_END)) - F.col("loss_length"))
        .select(F.col("conv").alias(conv), "example", "n_turns", "formatted",
                F.col("loss_start").cast("long").alias("loss_start"), "loss_length", "last")
    )


def read_back(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Conversations parsed from formatted examples: all turns, and all text under the loss mask.

    The expansion leaves rows of a conversation in one partition, so the grouping adds no exchange;
    contexts are cut down to the loss span before it.
    """
    span = F.substring(F.col("formatted"), F.col("loss_start").cast("int") + 1, F.col("loss_length").cast("int"))
    kept = examples.select(conv, F.struct(
        "example", unescape(span).alias("loss"), F.when(F.col("last"), F.col("formatted")).alias("whole"),
        F.length("formatted").cast("long").alias("chars"),
    ).alias("row"))
    gathered = kept.groupBy(conv).agg(F.sort_array(F.collect_list("row")).alias("rows"))
    segments = F.split(F.element_at("rows", -1)["whole"], TURN_END, -1)
    cut = F.slice(segments, 1, F.size(segments) - 1)

    def parsed(segment: Column) -> Column:
        colon = F.locate(": ", segment)
        return F.struct(
            role_of(F.substring(segment, F.lit(5), colon - 5)).alias("role"),
            unescape(F.substring(segment, colon + 2, F.length(segment))).alias("text"),
        )

    return gathered.select(
        conv, F.transform(cut, parsed).alias("turns"),
        F.concat_ws("", F.transform("rows", lambda r: r["loss"])).alias("loss"),
        F.aggregate("rows", F.lit(0).cast("long"), lambda a, r: a + r["chars"]).alias("formatted_chars"),
    )


def digests(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Per conversation: counts and digests of what the formatted examples hold."""
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read_back(examples, conv).select(
        conv, F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
