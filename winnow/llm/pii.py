"""Personal data: detection and keyed, type-consistent surrogates.

Detection, surrogates, collision checks and rewriting are DataFrame expressions. One entity has one surrogate in the
whole corpus (a keyed digest of its normal form), so references stay tied; two entities of a kind never share one, and no
surrogate is an entity that the corpus holds. Names are detected by a title before them (one or two capitalised words); where a text has such a
name, its words are replaced wherever the same text says them. Names without any title in their text are not detected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.tables import pinned

# Surrogate names by gender and script, and titles with the gender they tell.
GIVEN = {
    ("f", "latin"): "Anna Clara Elena Ida Julia Laura Lena Maria Nina Nora Olivia Paula Rosa Sara Sofia Vera",
    ("m", "latin"): "Adam Carlos David Emil Felix Hugo Ivan Jonas Karl Leon Marco Oscar Paul Ruben Simon Victor",
    ("u", "latin"): "Alex Andrea Camille Charlie Dominique Jamie Jean Kai Kim Luca Noa Robin Sacha Sam Toni Valentine",
    ("f", "cyrillic"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга",
    ("m", "cyrillic"): "Антон Борис Виктор Денис Егор Иван Павел Роман",
    ("u", "cyrillic"): "Женя Саша Валя Слава Паша Никита Шура Тоня",
}
FAMILY = {"latin": "Albers Bauer Costa Duval Engel Ferrer Gomez Hansen Ibarra Jensen Keller Lambert Moreau Novak Otto Peters Rossi Santos Torres Weber",
          "cyrillic": "Белов Волков Громов Зуев Котов Лебедев Орлов Соколов"}
TITLES = {"m": "Mr Herr Sr Señor Monsieur", "f": "Mrs Ms Miss Frau Sra Señora Mme Madame", "u": "Dr Prof"}

WORD = r"\p{Lu}[\p{L}'’-]{1,40}"
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)",
    "secret": r"(?<![0-9A-Za-z])(?=[A-Fa-f]*[0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])",
    "phone": r"(?<![\d+])\+\d{1,3}[ .-]?\(\d{1,4}\)[ .-]?\d{2,4}[ .-]?\d{2,5}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d(])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<!\d|\d-)\d{3}[.-]\d{3}[.-]\d{4}(?!\d|-\d)",
    "ssn": r"(?<!\d|\d-)\d{3}-\d{2}-\d{4}(?!\d|-\d)",
    "card": r"(?<!\d)\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?!\d)",
    "name": r"(?<!\p{L})(?:" + "|".join(t for v in TITLES.values() for t in v.split()) + r")\.? " + WORD + r"(?: " + WORD + ")?",
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
BARE, TAIL = r"(?<!\p{L})" + WORD, "(?:['’]s|['’-]+)$"


def alternation(words: str) -> str:
    return f"^(?:{'|'.join(words.split())})\\b"


def kind_of(mention: Column) -> Column:
    """The kind of a detected mention, from its shape."""
    digits = F.length(F.regexp_replace(mention, "[^0-9]", ""))
    return (
        F.when(F.contains(mention, F.lit("@")), "email")
        .when(F.regexp_like(mention, F.lit(r"^\p{L}+\.? \p{Lu}")), "name")
        .when(F.regexp_like(mention, F.lit(r"^(?:\d{1,3}\.){3}\d{1,3}$")), "ip")
        .when(F.regexp_like(mention, F.lit(r"^[+(]|^\d{3}[.-]\d{3}[.-]\d{4}$")), "phone")
        .when(F.regexp_like(mention, F.lit(r"^\d{3}-\d{2}-\d{4}$")), "ssn")
        .when(F.regexp_like(mention, F.lit("^[0-9 -]+$")) & (digits <= 23), "card")
        .otherwise("secret")
    )


def stem(word: Column) -> Column:
    """A name's word without a possessive ending or closing marks."""
    return F.regexp_replace(word, TAIL, "")


def proper(word: Column) -> Column:
    return F.array_join(F.transform(F.split(word, "-"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, F.lit(2), F.length(p)))), "-")


def parts_of(mention: Column) -> Column:
    """Entities of a mention in normal form: ``array<struct<kind, norm>>``.

    Numbers lose their format; addresses and secrets their case. A name gives a family name (its last word) and,
    where there are two, a given name of the title's gender; each in its script and without a possessive ending. A family name is
    the same entity with any title.
    """
    kind = kind_of(mention)
    digits, lower = F.regexp_replace(mention, "[^0-9]", ""), F.lower(mention)
    norm = F.when(kind.isin("phone", "ssn", "card"), digits).when(kind == "ip", mention).otherwise(lower)
    words = F.split(F.regexp_replace(mention, r"^\p{L}+\.? ", ""), " ")
    script = lambda w: F.when(F.regexp_like(w, F.lit(r"^\p{IsCyrillic}")), "cyrillic").otherwise("latin")
    gender = F.when(F.regexp_like(mention, F.lit(alternation(TITLES["f"]))), "f").when(F.regexp_like(mention, F.lit(alternation(TITLES["m"]))), "m").otherwise("u")
    last = F.element_at(words, -1)
    first = F.element_at(words, 1)
    family = F.struct(F.concat(F.lit("family-"), script(last)).alias("kind"), F.lower(stem(last)).alias("norm"))
    given = F.struct(F.concat(F.lit("given-"), gender, F.lit("-"), script(first)).alias("kind"), F.lower(stem(first)).alias("norm"))
    return F.when(kind == "name", F.when(F.size(words) > 1, F.array(family, given)).otherwise(F.array(family))).otherwise(
        F.array(F.struct(kind.alias("kind"), norm.alias("norm"))))


def luhn_sum(digits: Column) -> Column:
    """Checksum of digits read from the right, the last one included undoubled."""
    at = F.sequence(F.lit(1), F.length(digits))
    value = lambda k: F.substring(F.reverse(digits), k, F.lit(1)).cast("int")
    each = F.transform(at, lambda k: F.when(k % 2 == 1, value(k)).otherwise(F.when(value(k) > 4, value(k) * 2 - 9).otherwise(value(k) * 2)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The replacement in normal form: a keyed digest turned into characters of the same classes.

    Letters stay letters, digits digits, marks and lengths stay. Phones keep the country code's first digit and cards
    their first digit and the outcome of the check digit. Address octets are 1 to 254. Names come from lists by gender and script; later
    attempts join more of them.
    """
    stem = F.concat_ws("|", F.lit(key), kind, norm, attempt.cast("string"))
    hex_ = F.concat(F.sha2(stem, 256), F.sha2(F.concat(stem, F.lit("|2")), 256))
    byte = lambda k: F.conv(F.substring(hex_, (F.pmod(k - 1, F.lit(62)) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")
    wide = lambda k: byte(k) * 256 + byte(k + 31)

    def turned(k: Column) -> Column:
        c = F.substring(norm, k, F.lit(1))
        digit = F.pmod(wide(k), F.lit(10)).cast("string")
        letter = F.char(F.pmod(wide(k), F.lit(26)) + 97)
        hexed = F.substring(F.lit("0123456789abcdef"), F.pmod(wide(k), F.lit(16)) + 1, F.lit(1))
        return F.when(kind == "secret", hexed).when(F.regexp_like(c, F.lit("[0-9]")), digit).when(F.regexp_like(c, F.lit("[a-z]")), letter).otherwise(c)

    spelled = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.greatest(F.length(norm), F.lit(1))), turned))
    domain_end = F.regexp_extract(norm, r"(\.[a-z]+)$", 1)
    email = F.concat(F.substring(spelled, F.lit(1), F.length(spelled) - F.length(domain_end)), domain_end)
    numbered = F.concat(F.substring(norm, 1, 1), F.substring(spelled, F.lit(2), F.length(spelled)))
    body = F.substring(numbered, F.lit(1), F.length(numbered) - 1)
    valid = F.pmod(luhn_sum(norm), F.lit(10)) == 0
    check = F.pmod(-luhn_sum(F.concat(body, F.lit("0"))), F.lit(10))
    last = F.when(valid, check).otherwise(F.pmod(check + 1 + F.pmod(wide(F.lit(7)), F.lit(9)), F.lit(10)))
    ip = F.concat_ws(".", *[(F.pmod(wide(F.lit(k)), F.lit(254)) + 1).cast("string") for k in range(1, 5)])

    def listed(words: str) -> Column:
        own = F.array(*map(F.lit, words.split()))
        pick = lambda k: F.element_at(own, (F.pmod(wide(k), F.size(own)) + 1).cast("int"))
        return F.lower(F.concat_ws("-", F.transform(F.sequence(F.lit(1), attempt + 1), pick)))

    out = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", F.concat(body, last.cast("string"))) \
        .when(kind == "phone", numbered)
    for script, words in FAMILY.items():
        out = out.when(kind == f"family-{script}", listed(words))
    for (gender, script), words in GIVEN.items():
        out = out.when(kind == f"given-{gender}-{script}", listed(words))
    return out.otherwise(spelled)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, norm, surrogate`` for distinct entities, one to one within a kind.

    A surrogate that another entity of the kind has, or that is itself an entity of the corpus, is drawn anew with the next
    attempt number; the least entity of those that meet keeps it. It goes on until none is left.
    """
    real = pinned(entities.select("kind", "norm").distinct(), "entities")
    settled, left, attempt = None, real, 0
    while True:
        drawn = left.select("kind", "norm", surrogate(F.col("kind"), F.col("norm"), F.lit(attempt), key).alias("surrogate"))
        taken = real.select("kind", F.col("norm").alias("surrogate"))
        if settled is not None:
            taken = taken.unionByName(settled.select("kind", "surrogate"))
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        won = free.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm")).select("kind", "norm", "surrogate")
        settled = pinned(won if settled is None else settled.unionByName(won), "surrogates")
        left = pinned(left.join(settled.select("kind", "norm"), ["kind", "norm"], "left_anti"), "left")
        if left.isEmpty():
            return settled
        attempt += 1


def dressed(mention: Column, found: Column) -> Column:
    """The surrogate in the mention's own format: digits into its digits' places, capitals where it has them.

    ``found`` maps a kind to the surrogate of the mention's entity of that kind.
    """
    kind = kind_of(mention)
    value = F.element_at(F.map_values(found), 1)
    upto = lambda k: F.length(F.regexp_replace(F.substring(mention, F.lit(1), k), "[^0-9]", ""))
    c = lambda k: F.substring(mention, k, F.lit(1))
    filled = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.length(mention)), lambda k: F.when(
        F.regexp_like(c(k), F.lit("[0-9]")), F.substring(value, upto(k), F.lit(1))).otherwise(c(k))))
    upper = F.when((mention == F.upper(mention)) & (mention != F.lower(mention)), F.upper(value)).otherwise(value)
    cased = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.length(mention)), lambda k: F.when(
        F.regexp_like(c(k), F.lit("[A-Z]")), F.upper(F.substring(value, k, F.lit(1)))).otherwise(F.substring(value, k, F.lit(1)))))
    entries = F.map_entries(found)
    of = lambda start: F.array_join(F.transform(F.filter(entries, lambda e: F.startswith(e["key"], F.lit(start))), lambda e: e["value"]), "")
    title = F.regexp_extract(mention, r"^\p{L}+\.? ", 0)
    tail = lambda w: F.regexp_extract(w, TAIL, 0)
    given, family = proper(of("given")), F.concat(proper(of("family")), tail(mention))
    name = F.concat(title, F.when(given == "", family).otherwise(F.concat(given, tail(F.regexp_replace(mention, r" [^ ]*$", "")), F.lit(" "), family)))
    return F.when(kind == "name", name).when(kind.isin("phone", "ssn", "card"), filled).when(kind == "email", cased).otherwise(upper)


def bare(gap: Column, names: Column) -> Column:
    """A stretch between mentions with the names of its text replaced where they stand without a title.

    ``names`` maps a word of a name in normal form to its surrogate. A compound that is no name itself is looked through part by part.
    """
    def one(word: Column, other: Column) -> Column:
        value = proper(F.element_at(names, F.lower(stem(word))))
        cased = F.when((word == F.upper(word)) & (F.length(stem(word)) > 1), F.upper(value)).otherwise(value)
        return F.coalesce(F.when(F.regexp_like(word, F.lit(r"^\p{Lu}")), F.concat(cased, F.regexp_extract(word, TAIL, 0))), other)

    new = F.transform(F.regexp_extract_all(gap, F.lit(BARE), 0), lambda w: one(w, F.array_join(F.transform(F.split(w, "-", -1), lambda p: one(p, p)), "-")))
    return woven(F.split(gap, BARE, -1), new)


def woven(gaps: Column, between: Column) -> Column:
    """Stretches of a text and what stands between them."""
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(gaps) - 1).alias("gap"), between.alias("new"))
    return F.concat(F.concat_ws("", F.transform(pairs, lambda z: F.concat(z["gap"], z["new"]))), F.element_at(gaps, -1))


def replace(docs: DataFrame, key: str = "surrogate-key", id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, all columns in order, with every detected entity in ``text`` replaced.

    Texts without an entity pass through one scan. From the others go the distinct entities (their surrogates), and mentions that
    are brought together again by the row's id and two hashes of its text; only those texts are shuffled. A word of a detected name is
    replaced everywhere in its text, with or without a title, by the same surrogate; a word that is both a family and a
    given name there takes the family name's where it stands alone.
    Null and empty texts stay. Rows of one id and text are rewritten alike. No rows in, no rows out. Columns may
    have any name; helper columns are prefixed ``_pii_``.
    """
    body = F.col(f"`{text}`")
    # every kind has a digit, an @ or a title; texts without are told by cheap scans
    titles = [F.contains(body, F.lit(f"{t}{end}")) for v in TITLES.values() for t in v.split() for end in (" ", ". ")]
    quick = F.regexp_like(body, F.lit("[0-9@]")) | reduce(Column.__or__, titles)
    has = F.coalesce(quick & F.regexp_like(body, F.lit(ANY)), F.lit(False))
    names = [f"`{c}`" for c in docs.columns]
    keys = ["_pii_id", "_pii_a", "_pii_b"]
    marked = docs.filter(has).withColumns({
        "_pii_id": F.col(f"`{id}`"), "_pii_a": F.xxhash64(body), "_pii_b": F.xxhash64(body, F.lit(1))})
    said = pinned(marked.select(*keys, F.posexplode(F.regexp_extract_all(body, F.lit(ANY), 0)).alias("at", "mention")).distinct(), "mentions")
    forms = said.select("mention").distinct()
    pieces = forms.select("mention", F.explode(parts_of(F.col("mention"))).alias("p")).select("mention", "p.*")
    known = surrogates(pieces, key)
    named = F.when(F.regexp_like("kind", F.lit("^(?:family|given)-")), F.struct("norm", "kind", "surrogate"))
    new = pieces.join(known, ["kind", "norm"]).groupBy("mention").agg(F.map_from_entries(F.collect_set(F.struct("kind", "surrogate"))).alias("found"), F.collect_set(named).alias("names")) \
        .select("mention", dressed(F.col("mention"), F.col("found")).alias("new"), "names")
    lists = said.join(new, "mention").groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("at", "new"))).alias("_pii_new"), F.sort_array(F.flatten(F.collect_list("names"))).alias("_pii_names"))
    # sorted, so that equal words are neighbours and the first of them counts
    first = F.filter("_pii_names", lambda x, k: (k == 0) | (F.get("_pii_names", k - 1)["norm"] != x["norm"]))
    lists = lists.select(*[F.col(k).alias(f"{k}2") for k in keys], "_pii_new",
                         F.map_from_entries(F.transform(first, lambda x: F.struct(x["norm"], x["surrogate"]))).alias("_pii_names"))
    gaps = F.split(body, ANY, -1)
    gaps = F.when(F.size("_pii_names") > 0, F.transform(gaps, lambda g: bare(g, F.col("_pii_names")))).otherwise(gaps)
    rewrite = woven(gaps, F.transform("_pii_new", lambda x: x["new"]))
    joined = marked.join(lists, F.col("_pii_id").eqNullSafe(F.col("_pii_id2")) & (F.col("_pii_a") == F.col("_pii_a2")) & (F.col("_pii_b") == F.col("_pii_b2")))
    rewritten = joined.select(*[rewrite.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
    return docs.filter(~has).select(*names).unionByName(rewritten)
