"""Quality rules: what a text shows by itself, and lines that many documents of a host share.

By itself: word, symbol, repeated-line and repeated-window counts.  Across
documents: lines are normalised (lower case, one space between words) and
hashed; for each host the distinct documents with a line are counted (equal
texts are one document).  A line found in at least ``LINE_DOCS`` documents of a
host is removed, however large or small the host is; a share of the host's
documents may be asked for besides (``LINE_SHARE``: none).  It stays in the text
that holds it first (by ``doc_id``): boilerplate goes from all other documents,
and of near copies, whose lines are all frequent, the first one stays whole.  A
document is depleted if fewer than ``MIN_WORDS`` words or ``MIN_SHARE`` of its
words remain.  The table's ``source`` is the host.

Counts combine before each shuffle, keyed by line and host, so neither a hot
host nor a line of every document meets in one task.

Defined cases: a null text is empty (no words, so it fails); a null host is a
host of its own; a null ``doc_id`` is kept as it is and comes last; equal texts
of a host give equal results; lines without a word are never counted or removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .shared import arrow_tasks, materialize, tidy, with_facts

LINE_SHARE, LINE_DOCS = 0.0, 5
MIN_WORDS, MIN_SHARE = 20, 0.2
REPEAT_WINDOW, REPEAT_PERCENT = 8, 30
_BLANK = " \t\n\x0b\x0c\r"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def line_hash(line: str) -> int | None:
    """Hash of a normalised line; None for a line without a word."""
    words = line.lower().encode().split()  # of bytes: at the six ASCII blanks
    return xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63) if words else None


def _lines(text: str) -> tuple[int, dict[int, int]]:
    """Lines equal to an earlier one, and the words on each distinct normalised line (all its places together)."""
    seen, repeated, counts = set(), 0, {}
    for line in text.split("\n"):
        if not line.strip(_BLANK):
            continue
        if line in seen:
            repeated += 1
        seen.add(line)
        h = line_hash(line)
        if h is not None:
            counts[h] = counts.get(h, 0) + len(line.encode().split())
    return repeated, counts


def _base(column: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of each text but the lines."""
    data, offsets = textops.utf8(column)
    out = {k: np.zeros(len(column), np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_repeat_words")}
    for i, j in textops.slices(offsets):
        part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        sums = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[off])
        starts, ends, first = textops.words(part, off)
        out["n_words"][i:j] = np.diff(first)
        out["word_chars"][i:j] = sums(~textops._SPACE[part] & ((part & 0xC0) != 0x80))
        out["n_symbols"][i:j] = sums(_SYMBOL[part])
        hashes, rows = textops.windows(textops.word_hashes(part, starts, ends), first, REPEAT_WINDOW)
        order = np.lexsort((hashes, rows))
        same = (hashes[order][1:] == hashes[order][:-1]) & (rows[order][1:] == rows[order][:-1])
        twice = np.zeros(len(hashes), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        # windows of a row are in order, so window k of a row starts at its word k
        full = np.maximum(np.diff(first) - REPEAT_WINDOW + 1, 0)
        at = (np.arange(len(hashes)) - (np.cumsum(full) - full)[rows] + first[:-1][rows])[twice]
        steps = np.zeros(len(starts) + 1, np.int64)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + REPEAT_WINDOW, -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(steps[:-1]) > 0)])
        out["n_repeat_words"][i:j] = np.diff(covered[first])
    return out


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, source, text_hash``, the base counts, and distinct line hashes with their words."""

    def task(batches):
        for batch in batches:
            ids, hosts, hashes, column = (batch.column(k) for k in range(4))
            base = _base(column)
            lines = [_lines(x or "") for x in column.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [ids, hosts, hashes, *(pa.array(base[k]) for k in ("n_words", "word_chars", "n_symbols")),
                 pa.array([x for x, _ in lines], pa.int64()), pa.array(base["n_repeat_words"]),
                 pa.array([list(x) for _, x in lines], pa.list_(pa.int64())),
                 pa.array([list(x.values()) for _, x in lines], pa.list_(pa.int64()))],
                ["doc_id", "source", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "line_words"])

    return arrow_tasks(docs).select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        tidy(task), "doc_id bigint, source string, text_hash bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
              "n_dup_lines bigint, n_repeat_words bigint, lines array<bigint>, line_words array<bigint>")


def frequent_lines(measured: DataFrame, share: float = LINE_SHARE, least: int = LINE_DOCS) -> DataFrame:
    """``source, line, holder`` of the lines above the limits; ``holder`` is the hash of the text that holds a line first."""
    texts = measured.select("source", "text_hash").distinct().groupBy("source").agg(F.count(F.lit(1)).alias("docs"))
    first = F.min(F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("first")
    each = measured.select("source", "text_hash", "doc_id", F.explode("lines").alias("line")).groupBy("source", "line", "text_hash").agg(first)
    counts = each.groupBy("source", "line").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("first", "text_hash")).alias("holder")).where(F.col("n") >= least)
    same = F.col("c.source").eqNullSafe(F.col("t.source"))
    return (counts.alias("c").join(texts.alias("t"), same).where(F.col("n") > share * F.col("docs"))
            .select("c.source", "line", F.col("holder.text_hash").alias("holder")))


def judge(docs: DataFrame, share: float = LINE_SHARE, least: int = LINE_DOCS) -> DataFrame:
    """Counts and verdicts of every document: ``base_failed``, ``kept``, and ``removed`` (its lines above the limits)."""
    rows = materialize(measure(docs).withColumn("_row", F.monotonically_increasing_id()), "quality")
    frequent = frequent_lines(rows, share, least).select(F.col("source").alias("_host"), "line", "holder")
    each = rows.select("_row", "source", "text_hash", F.inline(F.arrays_zip(F.col("lines").alias("line"), F.col("line_words").alias("words"))))
    gone = (each.join(frequent, (each["source"].eqNullSafe(frequent["_host"])) & (each["line"] == frequent["line"]))
            .where(~F.col("text_hash").eqNullSafe(F.col("holder"))).groupBy("_row").agg(F.sum("words").alias("gone"), F.collect_list(each["line"]).alias("removed")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    depleted = F.col("gone").isNotNull() & ((left < MIN_WORDS) | (left < MIN_SHARE * F.col("n_words")))
    return rows.join(gone, "_row", "left").select(
        "doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "removed")


def clean(docs: DataFrame, share: float = LINE_SHARE, least: int = LINE_DOCS) -> DataFrame:
    """The documents that are kept, without their lines above the limits; columns as in ``docs``.

    ``n_chars`` follows the text where a line went.
    """
    facts = judge(docs, share, least).where(~F.col("kept") | F.col("removed").isNotNull()).select("doc_id", "text_hash", "kept", "removed")
    joined, about = with_facts(docs, facts)
    kept = joined.where(about["kept"].isNull() | about["kept"])
    names, at = docs.columns, docs.columns.index("text")

    def strip(batches):
        for batch in batches:
            texts, removed = batch.column(at), batch.column(len(names))
            if removed.null_count < len(removed):
                gone = [None if x is None else set(x) for x in removed.to_pylist()]
                new = [t if not g else "\n".join(x for x in t.split("\n") if line_hash(x) not in g)
                       for t, g in zip(texts.to_pylist(), gone)]
                columns = [pa.array(new, texts.type) if c == "text" else batch.column(k) for k, c in enumerate(names)]
                if "n_chars" in names:
                    k = names.index("n_chars")
                    chars = [old if not g else len(t) for old, g, t in zip(batch.column(k).to_pylist(), gone, new)]
                    columns[k] = pa.array(chars, batch.column(k).type)
            else:
                columns = [batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return kept.select(*(docs[c] for c in names), about["removed"]).mapInArrow(tidy(strip), docs.schema)
