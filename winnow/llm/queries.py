"""Registered queries of the corpus operators, with SQL where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import audit, chat, decontam, langid, licenses, neardup, packing, phrases, pii, simhash, substrings, tokenfile, toxicity
from winnow.llm.tables import pinned
from winnow.session import scratch_path, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


OP1_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e') AS body,
    replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\e'), ':', '\c') AS own
  FROM rows),
sized AS (
  SELECT *, 4 + CASE WHEN role IN ('system', 'user', 'assistant', 'tool') THEN length(role) ELSE 1 + length(own) END
    + 2 + length(body) + 8 AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM marked),
upto AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS held FROM sized)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(held) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM upto GROUP BY conv_id
"""


@register("op1_chat_prefix_targets", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that spells out the template's own marks."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return chat.digests(chat.prefix_targets(rows.unionByName(planted)))


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 4
      THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
runs AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM runs a JOIN runs b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, shared.b FROM reach JOIN shared ON shared.a = reach.other)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM sets JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id) USING (doc_id)
"""


@register("op10_near_duplicates", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, linked from four fifths of their union on."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.NearDup(width=4))


@register("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 2048 byte-level tokens; every document closed by id 1."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048, 1).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@register("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back through their index."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "token-files")
    tokenfile.write(docs, folder, public_tokenizers.path("word_bpe_49k.json"), 1)
    return tokenfile.read(spark, docs, folder).withColumnRenamed("key", "doc_id")


@register("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, edited documents and next documents.

    ``near_fingerprints`` counts, for ids divisible by 20, the other fingerprints of the corpus within three bits.
    """
    made = pinned(simhash.with_next(table(spark, sf_dir, "documents")), "fingerprints")
    prints = made.select("doc_id", F.col("fingerprint").alias("print"))
    near = simhash.neighbours(prints.filter("doc_id % 20 = 0"), prints).groupBy("query").agg(F.count("*").alias("near"))
    asked = F.when(F.col("doc_id") % 20 == 0, F.coalesce("near", F.lit(0)))
    return made.join(near, made["fingerprint"] == near["query"], "left").select(*made.columns, asked.alias("near_fingerprints"))


@register("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by a chain fitted on about 250 labelled documents a language."""
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


@register("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a network fitted on about 1200 labelled documents of each label."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op9_sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(n)}, [{', '.join(map(quoted, p))}])" for n, p in licenses.template_rows(licenses.TEMPLATES))
    return rf"""
WITH known(license, known) AS (VALUES {known}),
lines AS (SELECT doc_id, text, string_split_regex(text, '\r?\n') AS ls FROM documents WHERE text IS NOT NULL),
marked AS (SELECT doc_id, regexp_replace(unnest(ls), '([.!?;:])[ \t]+', '\1' || chr(1), 'g') AS l FROM lines),
parts AS (
  SELECT doc_id, text AS part FROM lines
  UNION SELECT doc_id, unnest(string_split_regex(text, '\n[ \t\r]*\n')) FROM lines
  UNION SELECT doc_id, unnest(ls) FROM lines
  UNION SELECT doc_id, unnest(string_split(l, chr(1))) FROM marked),
words AS (
  SELECT doc_id, part, string_split(trim(regexp_replace(lower(part), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM parts),
pairs AS (
  SELECT doc_id, part, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs
  FROM words WHERE len(w) > 1),
scored AS (
  SELECT doc_id, license, part, CAST(2 * len(list_intersect(pairs, known)) AS DOUBLE) / (len(pairs) + len(known)) AS dice
  FROM pairs JOIN known ON len(pairs) BETWEEN len(known) * 0.6 AND len(known) * 1.6),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, part) AS k FROM scored WHERE dice >= 0.8)
SELECT doc_id, license, round(dice, 6) AS dice, trim(part) AS part FROM best WHERE k = 1
"""


@register("op9_license_scan", op9_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences found in all documents."""
    return licenses.scan(table(spark, sf_dir, "documents")).withColumn("dice", F.round("dice", 6))


@register("op4_pii_surrogates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs).withColumn("n_chars", F.length("text").cast("long"))


@register("op2_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all benchmark items in all documents."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents),
counted AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    min(doc_id) OVER (PARTITION BY text) AS first FROM docs),
known AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
flagged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN first < doc_id THEN 'E' ELSE '' END AS failed
  FROM counted LEFT JOIN known USING (doc_id)),
cells AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM flagged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS own, left(filter_order, step - 1) AS before FROM orders, range(1, 6) t(step)),
seen AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, own, n, good, toxic, failed, contains(failed, own) AS hit,
    translate(failed, before, '') <> failed AS gone
  FROM steps, cells),
sums AS (
  SELECT part, filter_order, step, any_value(own) AS own, CAST(coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (hit AND gone), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (failed = own), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (hit AND NOT gone), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (hit AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step)
SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM sums
"""


@register("op11_filter_audit", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents, in all 120 orders, for every source."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, range(1, 5) t(k) WHERE len(w) >= k),
f AS (SELECT lang, k AS size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
long AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cuts AS (
  SELECT long.lang, long.phrase, long.a, k, h.a AS l, t.a AS r, CAST(2000000::HUGEINT * long.a // (h.a::HUGEINT + t.a) AS BIGINT) AS score
  FROM long JOIN range(1, 4) c(k) ON k < long.size JOIN f h ON h.lang = long.lang AND h.phrase = array_to_string(w[1:k], ' ')
  JOIN f t ON t.lang = long.lang AND t.phrase = array_to_string(w[k + 1:long.size], ' ')),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covered AS (
  SELECT DISTINCT s.lang, s.phrase FROM long s JOIN long b ON b.lang = s.lang AND b.size > s.size AND 100 * b.a::HUGEINT >= 80 * s.a::HUGEINT
  AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM least ANTI JOIN covered USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@register("op12_phrases", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language, counted over all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
strings AS (SELECT doc_id, i, substring(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 99, 0))) AS i FROM docs)),
later AS (SELECT doc_id, i FROM strings QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
opened AS (SELECT *, CAST(i > coalesce(lag(i) OVER o + 100, -1) AS INTEGER) AS new FROM later WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM opened) GROUP BY doc_id, run),
bounds AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS start, a AS stop, b - a AS gone, 1 AS span
  FROM (SELECT doc_id, a, b FROM runs UNION ALL SELECT doc_id, n AS a, n AS b FROM docs))
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(sum(gone) AS BIGINT) AS n_removed, count(*) FILTER (gone > 0) AS n_spans,
  sha256(unhex(string_agg(substring(h, 2 * start + 1, 2 * (stop - start)), '' ORDER BY start, stop))) AS kept_sha256
FROM docs JOIN bounds USING (doc_id) GROUP BY doc_id, n
"""


@register("op13_repeated_substrings", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without strings of 100 bytes that start earlier too."""
    return substrings.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of the corpus pipeline."""
    return corpus_pipeline.run(tune(spark), sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
