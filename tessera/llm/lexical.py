"""Ranked lexical search over a length-stratified index.

Terms are maximal runs of ASCII letters and digits and of all other
characters beyond ASCII, A-Z folded.  With ``N`` documents that have a term,
``L`` terms in them and ``n`` in one document, its length normaliser is
``m = 25 + (75 * n * N) div L``.  A document's score for an item sums
``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` over the item's terms, repeats
included, with ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``.

All documents of one ``m`` are a *stratum*.  Within it an occurrence count
fixes the impact of a term, so postings are kept by term and ``tf``, and an
impact is computed once for each of these, not for each document.  Strata are cut
into blocks of bounded size; a block is a row of the index: ``m``, the ids of
its documents, and its postings (an Arrow stream of ``term, tf, docs``).  Rows
are dealt to tasks by length and a salt, so a hot stratum is built by many.

Searching reads the index once and keeps the postings of the items' terms,
which give ``df``.  The greatest ``tf`` of each term bounds what any
document of a block can score.  Blocks of greatest bound are visited first;
the least of the best scores found there is a floor for each item.  Then a
block is only visited for items whose bound reaches their floor, which each
task raises as it goes.  Scores are summed for a whole block at once.  All of
it is exact: a block or document is left out only below ``k`` others.

Items are the query set, read in blocks of about
``ITEM_BLOCK`` distinct texts and sent to all tasks; each block is run against the whole index.

Defined cases: a null text, or one without terms, is no document and no query
(its rows get no results); very long texts are a block of their own; repeated
rows of documents are ranked each, repeated rows of items answered each; a null
``doc_id`` is ranked behind others of its score; other columns are ignored,
whatever their names; of an empty table on either side nothing is found.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops
from .shared import arrow_tasks, materialize, tidy

TOP = 10
PART_BYTES = 16 << 20  # text of a task that builds blocks
BLOCK_DOCS, BLOCK_BYTES = 4096, 2 << 20  # a block of a stratum, unless one text is longer
ITEM_BLOCK, ITEM_BYTES = 2000, 32 << 20  # items run against the index at a time
FIRST = 3  # blocks visited first for each item
_COLUMNS = 256  # items scored at a time
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
# ``words`` sees folded bytes, so A-Z are not separators there
_FOLDED = textops._LOWER


def spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, starts and ends of all terms, and each row's first term (one more entry closes the last row)."""
    data, offsets = textops.utf8(texts)
    data = _FOLDED[data]
    return data, *textops.words(data, offsets, _SEPARATOR)


def term_array(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms in order, and how many each row has."""
    data, starts, ends, first = spans(texts)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[~_SEPARATOR[data]])))
    return terms, np.diff(first)


@dataclass(frozen=True)
class LexicalIndex:
    """``blocks(block, m, doc_ids, postings)`` of ``docs`` documents with ``terms`` terms."""

    blocks: DataFrame
    docs: int
    terms: int

    def postings(self) -> DataFrame:
        """``m, term, tf, doc_ids``: the index as rows."""

        def task(batches):
            for batch in batches:
                for m, ids, blob in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                    table = pa.ipc.open_stream(blob.as_buffer()).read_all().combine_chunks()
                    docs = table.column("docs").combine_chunks()
                    named = pa.ListArray.from_arrays(docs.offsets, ids.values.take(docs.flatten()))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(table.num_rows, m)), table.column("term").cast(pa.string()).combine_chunks(),
                                                      table.column("tf").combine_chunks(), named], ["m", "term", "tf", "doc_ids"])

        return self.blocks.select("m", "doc_ids", "postings").mapInArrow(task, "m bigint, term string, tf bigint, doc_ids array<bigint>")


def _blob(table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write(table)
    return sink.getvalue().to_pybytes()


def block_postings(texts: pa.Array) -> pa.RecordBatch:
    """``term, tf, docs`` of a block; ``docs`` are places of its rows."""
    terms, sizes = term_array(texts)
    coded = terms.dictionary_encode()
    rows = len(sizes)
    key, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * rows + np.repeat(np.arange(rows), sizes), return_counts=True)
    code, doc = key // rows, key % rows
    by = np.lexsort((doc, tf, code))
    code, doc, tf = code[by], doc[by], tf[by]
    first = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])]))
    docs = pa.ListArray.from_arrays(pa.array(np.concatenate([first, [len(doc)]]), pa.int32()), pa.array(doc, pa.int32()))
    return pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(code[first])), pa.array(tf[first].astype(np.int64)), docs], ["term", "tf", "docs"])


def _build_task(batches):
    """Blocks of a task's rows ``doc_id, text, m``, which are sorted by ``m``."""

    def block():
        table = pa.Table.from_batches(held).combine_chunks()
        ids = pa.array([table.column(0).to_pylist()], pa.list_(pa.int64()))
        blob = _blob(block_postings(table.column(1)))
        return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65]), pa.array([m]), ids, pa.array([blob], pa.binary())],
                                          ["block", "m", "doc_ids", "postings"])

    held, m, size = [], None, 0
    for batch in batches:
        norms = batch.column(2).to_numpy()
        lengths = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(lengths)])
        a = 0
        while a < len(norms):
            if held and (norms[a] != m or size >= BLOCK_BYTES or sum(x.num_rows for x in held) >= BLOCK_DOCS):
                yield block()
                held, size = [], 0
            m = int(norms[a])
            b = int(np.searchsorted(norms, m, "right"))
            b = min(b, a + BLOCK_DOCS, a + max(1, int(np.searchsorted(before[a + 1 :], before[a] + BLOCK_BYTES, "right"))))
            held.append(batch.slice(a, b - a))
            size += int(before[b] - before[a])
            a = b
    if held:
        yield block()


def build_index(docs: DataFrame) -> LexicalIndex:
    """Index every document (two passes over the texts, the second moves them once)."""
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))

    def count(batches):
        for batch in batches:
            _, _, _, first = spans(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(first))], ["doc_id", "text", "n"])

    def size(batches):
        for batch in batches:
            data, _, _, first = spans(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(first)), pc.binary_length(batch.column(0).fill_null("")).cast(pa.int64())], ["n", "bytes"])

    # lengths by eighths of an octave: some hundred rows whatever the table
    octave = F.floor(8 * F.log2("n")).cast("int")
    lengths = (arrow_tasks(docs).select("text").mapInArrow(tidy(size), "n bigint, bytes bigint").where("n > 0")
               .groupBy(octave.alias("octave")).agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms"), F.sum("bytes").alias("bytes"))
               .orderBy("octave").collect())
    total, terms = sum(r.docs for r in lengths), sum(r.terms for r in lengths)
    spark = docs.sparkSession
    if not total:
        return LexicalIndex(spark.createDataFrame([], "block bigint, m bigint, doc_ids array<bigint>, postings binary"), 0, 0)
    base, salts, parts, room = {}, {}, 0, 0
    for r in lengths:
        if not room or r.bytes > room:  # begin new tasks; what is left of the last one's room takes the next small octaves
            salts[r.octave] = -(-r.bytes // PART_BYTES)
            base[r.octave] = parts
            parts += salts[r.octave]
            room = salts[r.octave] * PART_BYTES - r.bytes if salts[r.octave] == 1 else 0
        else:
            base[r.octave], salts[r.octave] = parts - 1, 1
            room -= r.bytes
    last = max(base)
    place = lambda known: F.element_at(F.array(*(F.lit(known.get(k, 0)) for k in range(last + 1))), octave + 1)
    rows = arrow_tasks(docs).mapInArrow(tidy(count), "doc_id bigint, text string, n bigint").where("n > 0")
    part = place(base) + F.pmod(F.xxhash64(F.monotonically_increasing_id()), place(salts)).cast("int")
    rows = (rows.withColumn("part", part).withColumn("m", F.expr(f"25 + (75 * n * {total}L) div {terms}L"))
            .repartitionById(parts, "part").sortWithinPartitions("m").select("doc_id", "text", "m"))
    blocks = rows.mapInArrow(tidy(_build_task), "block bigint, m bigint, doc_ids array<bigint>, postings binary")
    return LexicalIndex(materialize(blocks, "lexical", **{"parquet.block.size": 32 << 20}), total, terms)


class Queries:
    """A block of distinct item texts: their vocabulary, and for each term the items that hold it."""

    def __init__(self, texts: list[str]):
        terms, sizes = term_array(pa.array(texts, pa.string()))
        coded = terms.dictionary_encode()
        self.items = len(texts)
        self.vocabulary = coded.dictionary
        key, self.times = np.unique(coded.indices.to_numpy().astype(np.int64) * self.items + np.repeat(np.arange(self.items), sizes), return_counts=True)
        self.item = key % self.items
        self.first = np.searchsorted(key // self.items, np.arange(len(self.vocabulary) + 1))

    def pairs(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For places in ``item`` and ``times`` of all the terms' entries: those places, and the number of the term."""
        sizes = self.first[terms + 1] - self.first[terms]
        which = np.repeat(np.arange(len(terms)), sizes)
        return np.arange(len(which)) - (np.cumsum(sizes) - sizes)[which] + self.first[terms][which], which


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    return (10**9 * tf) // (1000 * tf + 8 * m)


def matching(index: LexicalIndex, queries: Queries) -> DataFrame:
    """``block, m, doc_ids, terms, dfs, postings``: blocks with the postings of the queries' terms only, terms as numbers."""

    def task(batches):
        for batch in batches:
            kept = []
            for blob in batch.column(3):
                table = pa.ipc.open_stream(blob.as_buffer()).read_all().combine_chunks()
                number = pc.index_in(table.column("term"), value_set=queries.vocabulary)
                known = pc.is_valid(number)
                table = pa.table({"term": number, "tf": table.column("tf"), "docs": table.column("docs")}).filter(known).combine_chunks()
                term = table.column("term").to_numpy()
                first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
                docs = pc.list_value_length(table.column("docs")).to_numpy()
                df = np.add.reduceat(docs, first) if len(first) else first
                kept.append((term[first].tolist(), df.tolist(), _blob(table.to_batches()[0]) if len(term) else None))
            some = pa.array([k for k, x in enumerate(kept) if x[2]], pa.int64())
            names, dfs, blobs = zip(*(x for x in kept if x[2])) if len(some) else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(some) for k in range(3)), pa.array(names, pa.list_(pa.int32())), pa.array(dfs, pa.list_(pa.int64())),
                 pa.array(blobs, pa.binary())], ["block", "m", "doc_ids", "terms", "dfs", "postings"])

    found = arrow_tasks(index.blocks).select("block", "m", "doc_ids", "postings").mapInArrow(
        task, "block bigint, m bigint, doc_ids array<bigint>, terms array<int>, dfs array<bigint>, postings binary")
    return materialize(found, "matching", **{"parquet.block.size": 32 << 20})


def term_weights(found: DataFrame, queries: Queries, docs: int) -> np.ndarray:
    """The weight of each term of the vocabulary."""
    df = dict(found.select(F.inline(F.arrays_zip("terms", "dfs"))).groupBy("terms").agg(F.sum("dfs")).collect())
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(k, 0) + 1))) for k in range(len(queries.vocabulary))], np.int64)


@dataclass
class Scorer:
    """Bounds and scores of a block's documents."""

    queries: Queries
    weights: np.ndarray

    def load(self, m: int, blob):
        table = pa.ipc.open_stream(blob.as_buffer()).read_all().combine_chunks()
        docs = table.column("docs").combine_chunks()
        term, tf = table.column("term").to_numpy(), table.column("tf").to_numpy()
        return term, self.weights[term] * impacts(tf, m), docs.offsets.to_numpy(), docs.flatten().to_numpy()

    def bounds(self, term: np.ndarray, value: np.ndarray) -> np.ndarray:
        """What no document of the block exceeds, for each item."""
        last = np.flatnonzero(np.concatenate([term[1:] != term[:-1], [True]]))  # of a term, the greatest tf
        at, which = self.queries.pairs(term[last])
        out = np.zeros(self.queries.items, np.int64)
        np.add.at(out, self.queries.item[at], self.queries.times[at] * value[last][which])
        return out

    def best(self, block, ids: np.ndarray, unnamed: np.ndarray, wanted: np.ndarray, floor: np.ndarray, k: int):
        """``(item, doc_id place, score)`` of the ``k`` best documents of each ``wanted`` item with at least its floor.

        Raises ``floor`` to the last of ``k``.
        """
        term, value, offsets, docs = block
        q = self.queries
        first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        ends = np.concatenate([first[1:], [len(term)]])
        found = []
        for a in range(0, len(wanted), _COLUMNS):
            some = wanted[a : a + _COLUMNS]
            column = np.full(q.items, -1)
            column[some] = np.arange(len(some))
            scores = np.zeros((len(ids), len(some)), np.int64)
            for begin, end in zip(first.tolist(), ends.tolist()):
                own = slice(q.first[term[begin]], q.first[term[begin] + 1])
                at = column[q.item[own]]
                times = q.times[own][at >= 0]
                at = at[at >= 0]
                if not len(at):
                    continue
                for g in range(begin, end):
                    scores[docs[offsets[g] : offsets[g + 1], None], at] += value[g] * times
            for c, item in enumerate(some.tolist()):
                mine = scores[:, c]
                rows = np.flatnonzero(mine >= max(int(floor[item]), 1))
                if len(rows) > k:
                    least = np.partition(mine[rows], len(rows) - k)[len(rows) - k]
                    rows = rows[mine[rows] >= least]
                    rows = rows[np.lexsort((ids[rows], unnamed[rows], -mine[rows]))[:k]]
                if len(rows) == k:
                    floor[item] = max(floor[item], mine[rows].min())
                found.append((np.full(len(rows), item), rows, mine[rows]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else None


def _first_blocks(found: DataFrame, scorer: Scorer) -> dict[int, list[int]]:
    """For each item the ``FIRST`` blocks of greatest bound, as items of each block (``FIRST`` times the items, at most)."""

    def task(batches):
        bound = np.zeros((FIRST, scorer.queries.items), np.int64)
        name = np.zeros_like(bound)
        every = np.arange(scorer.queries.items)
        for batch in batches:
            for block, m, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                new = scorer.bounds(*scorer.load(m, blob)[:2])
                worst = bound.argmin(0)
                better = every[new > bound[worst, every]]
                bound[worst[better], better], name[worst[better], better] = new[better], block
        yield pa.RecordBatch.from_arrays([pa.array(np.tile(every, FIRST)), pa.array(bound.ravel()), pa.array(name.ravel())], ["item", "bound", "block"])

    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "block"))
    rows = found.select("block", "m", "postings").mapInArrow(task, "item bigint, bound bigint, block bigint").where("bound > 0").withColumn(
        "rank", rank).where(F.col("rank") <= FIRST).select("block", "item").collect()
    out: dict[int, list[int]] = {}
    for block, item in rows:
        out.setdefault(block, []).append(item)
    return out


def _visit(found: DataFrame, scorer: Scorer, floor: np.ndarray, k: int, only: dict[int, list[int]] | None = None) -> DataFrame:
    """``item, doc_id, score``: the ``k`` best of each block that reach the floor."""

    def task(batches):
        mine = floor.copy()
        for batch in batches:
            out = []
            for name, m, listed, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                block = scorer.load(m, blob)
                ids = listed.values.fill_null(0).to_numpy()
                unnamed = listed.values.is_null().to_numpy(zero_copy_only=False)
                if only is None:
                    bound = scorer.bounds(*block[:2])
                    wanted = np.flatnonzero((bound >= mine) & (bound > 0))
                else:
                    wanted = np.array(only[name], np.int64)
                best = scorer.best(block, ids, unnamed, wanted, mine, k) if len(wanted) else None
                if best is not None:
                    item, rows, score = best
                    out.append(pa.RecordBatch.from_arrays([pa.array(item), listed.values.take(pa.array(rows)), pa.array(score)], ["item", "doc_id", "score"]))
            yield from out

    rows = found
    if only is not None:
        blocks = found.sparkSession.createDataFrame([(x,) for x in only], "block bigint")
        rows = found.join(F.broadcast(blocks), "block", "left_semi")
    return arrow_tasks(rows).select("block", "m", "doc_ids", "postings").mapInArrow(task, "item bigint, doc_id bigint, score bigint")


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: LexicalIndex, items: DataFrame, k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item, best first."""
    spark = items.sparkSession
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    distinct = items.where("text IS NOT NULL").select("text").distinct()
    count, size = distinct.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-count // ITEM_BLOCK), -(-size // ITEM_BYTES))
    out = None
    for b in range(blocks):
        texts = [r[0] for r in distinct.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()]
        queries = Queries(texts)
        if not index.docs or not len(queries.vocabulary):
            continue
        found = matching(index, queries)
        scorer = Scorer(queries, term_weights(found, queries, index.docs))
        floor = np.zeros(len(texts), np.int64)
        first = _ranked(_visit(found, scorer, floor, k, _first_blocks(found, scorer)), k)
        for item, score in first.where(F.col("rank") == k).select("item", "score").collect():
            floor[item] = score
        best = _ranked(_visit(found, scorer, floor, k), k)
        asked = spark.createDataFrame(list(enumerate(texts)), "item bigint, asked string")
        rows = best.join(F.broadcast(asked), "item").select("asked", "rank", "doc_id", "score")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = spark.createDataFrame([], "asked string, rank int, doc_id bigint, score bigint")
    out = materialize(out, "ranked")
    return items.join(out, items["text"] == out["asked"]).select("item_id", "rank", "doc_id", "score")
