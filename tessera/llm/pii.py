"""Personal data in texts, and the terms that give it away.

Base spans (e-mail, ip, card, phone) come from patterns; what they find are the
protected *entities*: each value by itself, and each kind of value, which pools
the evidence of values that occur once.  The *terms* are the corpus' words of
four letters or more, lower-cased.  A term ``t`` discloses an entity ``e`` if
knowing ``t`` leaves at most ``BITS`` bits of uncertainty about ``e``:
``-log2 P(e | t) <= BITS``, where ``P`` is not the share of the rows with ``t``
that hold ``e`` but a lower confidence bound of it (Wilson, ``Z`` standard
errors), and at least ``WITNESSES`` different texts hold both.  So a word seen
once or twice is no proof, and the limits do not depend on the size of the
table: documents without the term change nothing.  All places of a disclosing
term in the texts with its entity are spans too, and go with the value.

Near copies are one witness.  A text's mark is the least hash of its neighbouring
terms, which near copies nearly always share and other texts nearly never.

DataFrame operations only.  The patterns are written so that the Java regex
engine neither backtracks over long runs nor recurses: possessive, and held to
the start of a run (or the end of the match before) by a look-behind.  Only
entities with enough witnesses are paired with terms, pairs are counted before
each shuffle, so an entity of a third of all rows sends a row for each of its
terms and task; words of the corpus are only counted where they are in such
a pair.  Texts are never shuffled for finding base spans.

Spans are code points, the end exclusive, by start, then kind.  Defined cases:
a null text is empty; a null ``doc_id`` stays; equal rows get equal spans and
are one witness; an entity of every row has no term unless a word is as good as
only there; an empty table is empty; other columns are kept by
:func:`sanitise`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.broadcast import checked_broadcast
from .shared import fresh, materialize, with_facts

KINDS = ["email", "ip", "card", "phone", "term"]
LABELS = ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[TERM]"]
BITS, Z, WITNESSES = 1.0, 1.645, 3
# The base patterns, and what a match must be besides.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PARTS = r"^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])){3}$"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"\p{L}{4,}+"

_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _places(text: Column, pattern: str, span, keep, kind: str, needs: str) -> Column:
    """``span(start, end, match)`` of each match that ``keep`` accepts, by one fold over the gaps and matches of a text.

    Every match holds ``needs``, which is faster to look for.
    """
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        new = F.when(x["hit"].isNotNull() & keep(x["hit"]), F.concat(acc["out"], F.array(span(start, end, x["hit"])))).otherwise(acc["out"])
        return F.struct(end.alias("at"), new.alias("out"))

    none = F.array().cast(kind)
    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(text.contains(needs) & text.rlike(pattern), found).otherwise(none)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    """Whether the digits of a card number add up."""
    digits = F.reverse(_digits(hit))
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(digits, i, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def base_spans(text: Column) -> Column:
    """Base spans ``(start, kind, end)`` in order; kinds as in ``KINDS``."""
    rules = [(EMAIL, lambda h: F.lit(True), "@"), (IP, lambda h: h.rlike(IP_PARTS), "."), (CARD, _luhn, ""),
             (PHONE, lambda h: F.length(_digits(h)).between(10, 15), "+")]
    found = [_places(text, pattern, lambda a, b, _, k=k: F.struct(a.alias("start"), F.lit(k).alias("kind"), b.alias("end")), keep, _SPANS, needs)
             for k, (pattern, keep, needs) in enumerate(rules)]
    return F.array_sort(F.concat(*found))


def _words(text: Column) -> Column:
    """The terms of a text in order, with repeats."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower)


def _mark(words: Column, otherwise: Column) -> Column:
    """The least hash of two neighbouring terms."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1)))
    return F.when(F.size(words) > 1, F.array_min(pairs)).otherwise(otherwise)


def entity_rows(docs: DataFrame) -> DataFrame:
    """``_row, doc_id, text_hash, base`` of every document, and of those with base spans ``text, entities, terms, mark``."""
    found = docs.withColumn("base", base_spans(F.col("text")))
    held = F.size("base") > 0
    values = F.transform("base", lambda s: F.lower(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])))
    kinds = F.transform("base", lambda s: F.element_at(F.array(*map(F.lit, LABELS)), s["kind"] + 1))  # a label is no value
    found = found.withColumn("words", F.when(held, _words(F.col("text"))))
    columns = {"text": F.col("text"), "entities": F.array_distinct(F.concat(values, kinds)), "terms": F.array_distinct("words"),
               "mark": _mark(F.col("words"), F.col("text_hash"))}
    found = found.select("doc_id", "text_hash", "base", *(F.when(held, c).alias(name) for name, c in columns.items()))
    return materialize(found.withColumn("_row", F.monotonically_increasing_id()), "pii")


def lower_bound(both: Column, rows: Column) -> Column:
    """Wilson's lower bound of the chance behind ``both`` of ``rows``."""
    p, z2 = both / rows, Z * Z
    return (p + z2 / (2 * rows) - Z * F.sqrt(p * (1 - p) / rows + z2 / (4 * rows * rows))) / (1 + z2 / rows)


def disclosing(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``entity, term`` of the terms that disclose an entity."""
    holding = rows.where(F.size("base") > 0)
    known = holding.select(F.explode("entities").alias("entity"), "mark").distinct().groupBy("entity").agg(
        F.count(F.lit(1)).alias("witnesses")).where(F.col("witnesses") >= WITNESSES).select("entity")
    known, _ = checked_broadcast(materialize(known, "pii-entities"))
    each = holding.select("_row", "mark", "terms", F.explode("entities").alias("entity")).join(known, "entity").select(
        "entity", "mark", F.explode("terms").alias("term"))
    pairs = materialize(each.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both")).where(F.col("both") >= WITNESSES), "pii-pairs")
    asked, _ = checked_broadcast(materialize(pairs.select("term").distinct(), "pii-terms"))
    words = docs.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))
    with_term = words.join(asked, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("rows"))
    bound = lower_bound(F.col("both").cast("double"), F.col("rows").cast("double"))
    likely = pairs.join(with_term, "term").where(-F.log2(bound) <= BITS).select("entity", "term")
    likely, _ = checked_broadcast(materialize(likely, "pii-likely"))
    witnesses = each.join(likely, ["entity", "term"]).distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("witnesses"))
    return materialize(witnesses.where(F.col("witnesses") >= WITNESSES).select("entity", "term"), "pii-told")


def find_personal(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, base, spans`` of every document: base spans, and all spans, as ``(start, kind, end)`` in order."""
    docs = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_hash"))
    rows = entity_rows(docs)
    told = disclosing(docs, rows)
    holding = rows.where(F.size("base") > 0)
    told, _ = checked_broadcast(told)
    asked = holding.select("_row", "terms", F.explode("entities").alias("entity")).select(
        "_row", "entity", F.explode("terms").alias("term")).join(told, ["entity", "term"]).select("_row", "term").distinct()
    asked = materialize(asked, "pii-asked")
    # places by running sums over the gaps and words of a text
    parts = F.arrays_zip(F.transform(F.split("text", WORD, -1), F.length).alias("gap"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("hit"))
    place = holding.join(asked.select("_row").distinct(), "_row", "left_semi").select("_row", F.posexplode(parts).alias("pos", "part")).select(
        "_row", "pos", "part.gap", "part.hit")
    length = F.coalesce(F.length("hit"), F.lit(0))
    place = place.withColumn("end", F.sum(F.col("gap") + length).over(Window.partitionBy("_row").orderBy("pos")).cast("int"))
    place = place.where(F.col("hit").isNotNull()).select("_row", F.lower("hit").alias("term"), (F.col("end") - length).alias("start"), "end")
    span = F.struct("start", F.lit(KINDS.index("term")).alias("kind"), "end")
    spans = place.join(asked, ["_row", "term"]).select("_row", span.alias("s")).groupBy("_row").agg(F.collect_list("s").alias("spans"))
    free = F.filter("spans", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"])))
    return rows.select("_row", "doc_id", "text_hash", "base").join(spans, "_row", "left").select(
        "doc_id", "text_hash", "base", F.array_sort(F.concat("base", F.coalesce(free, F.array().cast(_SPANS)))).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by the label of its kind (of spans that overlap, the first)."""
    labels = F.array(*map(F.lit, LABELS))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.element_at(labels, s["kind"] + 1)).alias("out"))
                      ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame) -> DataFrame:
    """All documents, columns as in ``docs``, with personal data and disclosing terms replaced; ``n_chars`` follows the text."""
    facts = find_personal(docs).where(F.size("spans") > 0).select("doc_id", "text_hash", "spans")
    joined, about = with_facts(docs, facts)
    (name,) = fresh("text")
    joined = joined.withColumn(name, F.when(about["spans"].isNotNull(), sanitised(docs["text"], about["spans"])).otherwise(docs["text"]))
    columns = {c: docs[c] for c in docs.columns} | {"text": F.col(name)}
    if "n_chars" in columns:
        chars = F.length(name).cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(about["spans"].isNotNull(), chars).otherwise(docs["n_chars"])
    return joined.select(*(column.alias(c) for c, column in columns.items()))
