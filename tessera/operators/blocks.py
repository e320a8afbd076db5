"""Postings in blocks: the documents of a term in a block of documents as one row.

A saved table keeps its postings so, and saving and merging move them so::

    shard, field, term   of all entries (term NULL: a norm)
    doc                  least document of the row
    n, tf, dl            number of its postings, their greatest tf and least dl
    entries              an array of its postings, ascending by document: one number each
                         (NULL: the row is one posting, ``doc, tf, dl``)
    docs, tfs, dls       arrays of their doc, tf and dl instead, in tables written before
                         there were entries

One row per posting would be the dearest part of a save: strings compared a
dozen times and written once for each posting.  A task gathers what its
documents have of a term instead, so the shuffle, the sort by term and the
files hold a row per term and block.  The documents of a row lie in one range of
:data:`tessera.operators.build.DOCS_PER_RANGE` documents, so ``doc`` tells the
range of all of them.  A block is bounded in tokens and documents, and with it
memory and the longest row.  An entry is ``document - doc``, ``tf`` and ``dl`` in
17, 15 and 31 bits: writers pay for each element of an array, so one array costs
a third of three.  A posting whose ``tf`` needs more bits is a row of its own.
Where ``tf`` (or ``dl``) of the row is NULL, so it is in all its entries.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import build
from .build import field_values
from .spec import IndexSpec

# A block ends with the Arrow batch that fills it; output batches hold so many postings or little more.
BLOCK_TOKENS, BLOCK_DOCS, BATCH_POSTINGS = 12_000_000, 60_000, 100_000
# Bits of an entry's document (from the row's least one), tf and dl.
DOC_BITS, TF_BITS, DL_BITS = 17, 15, 31
STORED_SCHEMA = "shard int, field string, term string, doc bigint, n bigint, tf bigint, dl bigint, entries array<bigint>"
# With what earlier tables have.
BLOCK_SCHEMA = f"{STORED_SCHEMA}, docs array<bigint>, tfs array<int>, dls array<int>"

# The tasks' functions travel with them: saving needs this package on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def stored_blocks(docs: DataFrame, spec: IndexSpec) -> DataFrame:
    """Postings and norms of every text and keyword field (the rows of
    :func:`tessera.operators.build.index_rows` with norms) in blocks, as they are stored."""
    fields = [(name, name in spec.text) for name in spec.indexed]
    values = [field_values(docs, spec, name).alias(f"_f{i}") for i, (name, _) in enumerate(fields)]
    per_range = build.DOCS_PER_RANGE
    if per_range > 1 << DOC_BITS:
        raise ValueError(f"a range may hold {1 << DOC_BITS} documents at most: {per_range}")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens, rows = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(_counted(batch, len(fields)))
            rows += batch.num_rows
            tokens += sum(int(length.sum()) for length, _, _, _ in held[-1][2])
            if tokens >= BLOCK_TOKENS or rows >= BLOCK_DOCS:
                yield from _block(held, fields, per_range)
                held, tokens, rows = [], 0, 0
        if held:
            yield from _block(held, fields, per_range)

    return docs.select("shard", "doc", *values).mapInArrow(blocks, STORED_SCHEMA)


def index_blocks(docs: DataFrame, spec: IndexSpec) -> DataFrame:
    """:func:`stored_blocks` with the postings of every row as arrays."""
    rows = stored_blocks(docs, spec)
    return as_blocks(rows.withColumns({"docs": F.lit(None), "tfs": F.lit(None), "dls": F.lit(None)}))


def _entry(e: Column) -> tuple[Column, Column, Column]:
    """``doc, tf, dl`` of an entry of the row at hand."""
    return (F.col("doc") + F.shiftright(e, TF_BITS + DL_BITS),
            F.when(F.col("tf").isNotNull(), F.shiftright(e, DL_BITS).bitwiseAND(F.lit((1 << TF_BITS) - 1)).cast("int")),
            F.when(F.col("dl").isNotNull(), e.bitwiseAND(F.lit((1 << DL_BITS) - 1)).cast("int")))


def as_blocks(rows: DataFrame) -> DataFrame:
    """Stored postings with ``n`` and the arrays ``docs, tfs, dls`` in every row, whatever it was stored as."""
    return rows.withColumns({
        "n": F.coalesce("n", F.lit(1).cast("bigint")),
        "docs": F.coalesce("docs", F.transform("entries", lambda e: _entry(e)[0]), F.array("doc")),
        "tfs": F.coalesce("tfs", F.transform("entries", lambda e: _entry(e)[1]), F.array(F.col("tf").cast("int"))),
        "dls": F.coalesce("dls", F.transform("entries", lambda e: _entry(e)[2]), F.array(F.col("dl").cast("int"))),
    }).drop("entries")


def posting_rows(blocks: DataFrame) -> DataFrame:
    """One row per posting (or norm): its ``doc, tf, dl`` and the other columns of the blocks."""
    others = [c for c in blocks.columns if c not in ("doc", "n", "tf", "dl", "docs", "tfs", "dls", "entries")]

    def posting(doc: Column, tf: Column, dl: Column) -> Column:
        return F.struct(doc.alias("doc"), tf.cast("bigint").alias("tf"), dl.cast("bigint").alias("dl"))

    # what index_blocks gives has arrays only, what it is made of entries only
    packed = [F.transform("entries", lambda e: posting(*_entry(e)))] if "entries" in blocks.columns else []
    postings = F.coalesce(
        *packed, F.transform(F.arrays_zip("docs", "tfs", "dls"), lambda z: posting(z["docs"], z["tfs"], z["dls"])),
        F.array(posting(F.col("doc"), F.col("tf"), F.col("dl"))))
    return blocks.select(*others, F.inline(postings))


def _counted(batch: pa.RecordBatch, n_fields: int) -> tuple[np.ndarray, np.ndarray, list]:
    """``shard, doc`` of a batch of documents and of each field the lengths, the terms, and their postings:
    ``code * rows + row`` in order, and tf.  A document lies in one batch, so its counts are whole."""
    n, out = batch.num_rows, []
    for i in range(n_fields):
        values = batch.column(2 + i)
        length = pc.list_value_length(values).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        terms = values.flatten().dictionary_encode()
        # a posting is a distinct (term, document)
        key, tf = np.unique(terms.indices.to_numpy().astype(np.int64) * n + np.repeat(np.arange(n), length), return_counts=True)
        out.append((length, terms.dictionary.cast(pa.string()), key, tf.astype(np.int32)))
    # copies: what is held of a batch does not keep its buffers
    return batch.column(0).to_numpy().copy(), batch.column(1).to_numpy().copy(), out


def _block(batches: list, fields: list[tuple[str, bool]], per_range: int) -> Iterator[pa.RecordBatch]:
    """Rows of one block of documents, of its counted batches."""
    shard, doc = (np.concatenate([b[k] for b in batches]) for k in (0, 1))
    n_docs = len(doc)
    first = np.cumsum([0] + [len(b[0]) for b in batches])
    order = np.lexsort((doc, shard))
    shard, doc = shard[order], doc[order]
    place = np.empty(n_docs, np.int64)
    place[order] = np.arange(n_docs)
    # documents of one range of a shard
    cell = np.cumsum(np.append(False, (shard[1:] != shard[:-1]) | (doc[1:] // per_range != doc[:-1] // per_range)))

    def starts(code: np.ndarray, row: np.ndarray) -> np.ndarray:
        of = cell[row]
        return np.append(np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (of[1:] != of[:-1]))), len(row))

    def norms(field: str | None, row: np.ndarray, length: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        runs = starts(np.zeros(len(row), np.int64), row)
        yield from _rows(shard, doc, field, pa.nulls(len(runs) - 1, pa.string()), runs, row, None, length)

    yield from norms(None, np.arange(n_docs), None)
    for i, (name, text) in enumerate(fields):
        counted = [b[2][i] for b in batches]
        sized = np.empty(n_docs, np.int64)
        sized[place] = np.concatenate([length for length, _, _, _ in counted])
        if not sized.any():
            continue
        has = np.flatnonzero(sized)
        yield from norms(name, has, sized[has] if text else None)
        codes, rows = [], []
        for (_, _, key, _), lo, hi in zip(counted, first, first[1:]):
            code, row = np.divmod(key, hi - lo)
            codes.append(pa.DictionaryArray.from_arrays(pa.array(code.astype(np.int32)), counted[len(codes)][1]))
            rows.append(place[lo + row])
        codes = pa.chunked_array(codes).unify_dictionaries()
        terms = codes.chunk(0).dictionary
        by_term = _in_order(terms)
        rank = np.empty(len(terms), np.int64)
        rank[by_term] = np.arange(len(terms))
        code, row = rank[np.concatenate([c.indices.to_numpy() for c in codes.chunks])], np.concatenate(rows)
        # documents by (shard, doc), so a term's are in order
        by_key = np.argsort(code * n_docs + row)
        code, row, tf = code[by_key], row[by_key], np.concatenate([x[3] for x in counted])[by_key]
        runs = starts(code, row)
        if (wide := np.flatnonzero(tf >= 1 << TF_BITS)).size:
            runs = np.union1d(runs, [wide, wide + 1])  # rows of their own
        yield from _rows(shard, doc, name, terms.take(pa.array(by_term[code[runs[:-1]]])), runs, row, tf, sized[row] if text else None)


def _in_order(terms: pa.Array) -> np.ndarray:
    """Order of the terms by their first 16 bytes: the sort behind the shuffle merges runs that are in order,
    which takes a fraction of its comparisons.  No result depends on it."""
    _, offsets, data = terms.cast(pa.large_string()).buffers()
    offsets = np.frombuffer(offsets, np.int64, len(terms) + 1, 8 * terms.offset)
    data = np.append(np.frombuffer(data, np.uint8) if data is not None else [], np.zeros(1)).astype(np.uint8)
    at = offsets[:-1, None] + np.arange(16)
    head = np.ascontiguousarray(np.where(at < offsets[1:, None], data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)).view(">u8")
    return np.lexsort((head[:, 1].astype(np.uint64), head[:, 0].astype(np.uint64)))


def _rows(shard: np.ndarray, doc: np.ndarray, field: str | None, term: pa.Array, starts: np.ndarray, row: np.ndarray,
          tf: np.ndarray | None, dl: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Block rows, in batches of about BATCH_POSTINGS postings.  Row ``r`` has the postings ``starts[r]`` to ``starts[r + 1]``."""
    at, n = starts[:-1], np.diff(starts)
    doc, shard = doc[row], shard[row[at]]
    least, none = doc[at], pa.nulls(len(at), pa.int64())
    entries = (doc - np.repeat(least, n)) << TF_BITS + DL_BITS
    if tf is not None:
        entries |= tf.astype(np.int64) << DL_BITS
    if dl is not None:
        entries |= dl
    columns = [pa.array(shard), pa.nulls(len(at), pa.string()) if field is None else pa.repeat(field, len(at)), term, pa.array(least), pa.array(n),
               none if tf is None else pa.array(np.maximum.reduceat(tf, at).astype(np.int64)), none if dl is None else pa.array(np.minimum.reduceat(dl, at))]
    names = ["shard", "field", "term", "doc", "n", "tf", "dl", "entries"]
    lo, end = 0, len(at)
    while lo < end:
        hi = min(end, max(lo + 1, int(np.searchsorted(starts, starts[lo] + BATCH_POSTINGS))))
        many = n[lo:hi] > 1
        offsets = np.append(0, np.cumsum(np.where(many, n[lo:hi], 0))).astype(np.int32)
        packed = entries[starts[lo]:starts[hi]][np.repeat(many, n[lo:hi])]
        yield pa.record_batch([*(c.slice(lo, hi - lo) for c in columns), pa.ListArray.from_arrays(pa.array(offsets), pa.array(packed), mask=pa.array(~many))], names)
        lo = hi
