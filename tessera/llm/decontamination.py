"""Documents that hold test items, found by pigeonhole pieces and verified by Myers' bit-parallel distance.

Texts and items are sequences of words (runs of letters and digits, lower
case).  An item of ``n`` words may be off by ``k = n // EDITS_PER`` word edits.
Cut into ``k + 1`` pieces, an item within ``k`` edits of a passage leaves at
least one piece in it unchanged; every exact hit of a piece is therefore a
candidate, and only those are verified.  The passage around a hit is searched
with Myers' algorithm (one machine word, or a long integer, per step).

Items are the query set.  Rows that repeat an item are one, counted; items are
read in blocks of ``BLOCK_ITEMS``, each sent
to all tasks, so what is broadcast has a fixed bound; every block is run over
all documents.  The documents are never shuffled.

Defined cases: a null or wordless item matches nothing; items of fewer than
``EDITS_PER`` words must occur exactly; repeated items and documents are
reported each; a null text holds nothing; ``doc_id`` may be null; other columns
are ignored, or kept by ``without_leaks``, whatever their names; very long items
are searched like others; of an empty table nothing is found.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_tasks, tidy

EDITS_PER = 5  # one edit for so many words
BLOCK_ITEMS = 20_000
_WORD = re.compile(r"[^\W_]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def budget(n: int) -> int:
    """Edits allowed for an item of ``n`` words."""
    return n // EDITS_PER


def pieces(n: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of an item of ``n`` words."""
    k = budget(n) + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def best_match(item: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``text``, and where that part ends (Myers 1999)."""
    m = len(item)
    peq: dict[int, int] = {}
    for i, w in enumerate(item):
        peq[w] = peq.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text):
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full  # a match may begin anywhere, so no carry comes in
        pv, mv = mh | (~(xv | ph) & full), ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Finds a block of items in texts."""

    def __init__(self, items: list[tuple[int, str | None, int]]):
        self.names: dict[str, int] = {}
        self.items: list[tuple[int, list[int]]] = []
        self.rows: list[int] = []  # how often each item is asked
        table: dict[int, list[tuple[int, int]]] = {}  # hash of a piece -> (item, start)
        self.lengths: set[int] = set()
        for item_id, text, rows in items:
            words = [self.names.setdefault(w, len(self.names) + 1) for w in words_of(text)]
            if not words:
                continue
            at = len(self.items)
            self.items.append((item_id, words))
            self.rows.append(rows)
            for start, length in pieces(len(words)):
                h = int(self._hash(np.array(words[start : start + length], np.uint64), length)[0])
                table.setdefault(h, []).append((at, start))
                self.lengths.add(length)
        self.hashes = np.array(sorted(table), np.uint64)
        self.places = [table[h] for h in self.hashes.tolist()]

    @staticmethod
    def _hash(ids: np.ndarray, length: int) -> np.ndarray:
        out = np.full(len(ids) - length + 1, np.uint64(length))
        for k in range(length):
            out = (out ^ ids[k : len(ids) - length + 1 + k]) * _MULT
            out ^= out >> np.uint64(29)
        return out

    def find(self, text: str | None) -> list[tuple[int, int, int, int, int]]:
        """``(item_id, rows, distance, first word, last word + 1)`` of each item that the text holds (its best place)."""
        words = words_of(text)
        get = self.names.get
        ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        spots: set[tuple[int, int]] = set()
        for length in self.lengths:
            if len(ids) < length or not len(self.hashes):
                continue
            at = np.flatnonzero(known[length:] - known[:-length] == length)  # all words known to some item
            if not len(at):
                continue
            values = self._hash(ids, length)[at]
            place = np.minimum(np.searchsorted(self.hashes, values), len(self.hashes) - 1)
            hit = self.hashes[place] == values
            for pos, p in zip(at[hit].tolist(), place[hit].tolist()):
                spots.update((i, pos - start) for i, start in self.places[p])
        best: dict[int, tuple[int, int, int]] = {}
        done: dict[int, int] = {}
        for i, begin in sorted(spots):
            item = self.items[i][1]
            k = budget(len(item))
            if i in done and begin <= done[i]:
                continue  # the passage searched before covers this alignment
            a, b = max(0, begin - 2 * k), min(len(ids), begin + len(item) + 2 * k)
            done[i] = begin + k
            distance, end = best_match(item, ids[a:b].tolist())
            if distance <= k and (i not in best or distance < best[i][0]):
                best[i] = (distance, max(a, a + end - len(item)), a + end)
        return [(self.items[i][0], self.rows[i], *x) for i, x in best.items()]


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, distance, first_word, end_word``: one row for each document and item it holds."""
    found = None
    for block in _blocks(items):
        part = _in_block(docs, block)
        found = part if found is None else found.unionByName(part)
    return found


def _blocks(items: DataFrame):
    """Lists of ``(item_id, text, rows)``, each of about ``BLOCK_ITEMS`` different items; repeated rows are one item."""
    items = items.groupBy(F.col("item_id").cast("bigint").alias("item_id"), "text").agg(F.count(F.lit(1)).alias("rows"))
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    for k in range(blocks):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()]


def _in_block(docs: DataFrame, items: list[tuple[int, str | None, int]]) -> DataFrame:
    def task(batches):
        matcher = Matcher(items)
        for batch in batches:
            rows = []
            for r, text in enumerate(batch.column(1).to_pylist()):
                rows += [(r, *x) for x in matcher.find(text)]
            if rows:
                row, item, asked, distance, first, end = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(item, pa.int64()), pa.array(asked, pa.int64()), pa.array(distance, pa.int32()),
                     pa.array(first, pa.int64()), pa.array(end, pa.int64())], ["doc_id", "item_id", "rows", "distance", "first_word", "end_word"])

    return arrow_tasks(docs).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        tidy(task), "doc_id bigint, item_id bigint, rows bigint, distance int, first_word bigint, end_word bigint").select(
        "doc_id", "item_id", "distance", "first_word", "end_word", F.explode(F.sequence(F.lit(1), "rows")).alias("row")).drop("row")


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item; columns as in ``docs``.  Rows are judged where they lie, without a shuffle."""
    at = docs.columns.index("text")
    for block in _blocks(items):
        docs = arrow_tasks(docs).mapInArrow(tidy(_clean_task(block, at)), docs.schema)
    return docs


def _clean_task(items: list[tuple[int, str | None, int]], at: int):
    def task(batches):
        matcher = Matcher(items)
        for batch in batches:
            yield batch.filter(pa.array([not matcher.find(x) for x in batch.column(at).to_pylist()], pa.bool_()))

    return task
