"""Near copies by 64-bit SimHash fingerprints, compared bit plane by bit plane.

A fingerprint has a bit set where over half of the text's three-word shingles
(repeats included) have it set in their XXH64.  Fingerprints link at
``RADIUS`` differing bits or fewer.

Equal fingerprints are one row before anything is compared.  Cut into
``PARTS`` parts, two fingerprints within the radius agree in all but
``RADIUS`` of them; so each fingerprint goes to one bucket for every choice of
``PARTS - RADIUS`` parts, and only fingerprints of a bucket are compared, all
of them.  Buckets beyond ``BLOCK`` rows are dealt to blocks and each pair of
blocks is a task's unit (a *cell*), so no task holds more than two blocks.

Comparison is bit-sliced.  Plane ``p`` of a run of rows holds bit ``p`` of 64
rows in each word; row ``i`` meets row ``i + d`` of its cell by shifting the
plane by ``d`` lanes.  Differing bits are counted for 64 pairs at a time by a
carry-save counter of two bits and an overflow flag, and a block of lanes is
abandoned as soon as every pair in it has passed the radius.

Pairs found only join their rows in a forest of the cells at hand, and each row
sends one link to its root: a bucket of near copies costs its rows, not its
pairs, and connectedness is kept exactly.

Defined cases: words are runs without space and ``\\x09-\\x0D``, A-Z folded; a
text of one or two words is one shingle; null, empty or wordless texts have
fingerprint zero, linked like any other.  Very long texts are hashed in steps.
Repeated rows (and ties) share a fingerprint and a component.  A null
``doc_id`` never names a component unless all its rows are null.  Other columns
are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.broadcast import checked_broadcast
from .components import components
from .shared import arrow_tasks, materialize, tidy

SHINGLE, SEED, RADIUS, PARTS = 3, 42, 3, 5
BITS = 64
BLOCK = 8192  # rows of one bucket that are compared with as many others in one task
HOT_ROWS = 10_000  # documents of a fingerprint from which on its component is sent to every task
_STEP = 1 << 17  # shingles counted at a time
_WORDS = 16  # words of a block of lanes
_LANES = 64 * _WORDS
_UNITS = 512  # blocks of lanes compared at a time
_PLANES = 8  # planes between two looks at which blocks are still open
U64 = np.uint64


def shingle_hashes(text: bytes | None) -> list[int]:
    """XXH64 of the shingles of a UTF-8 text, in order, repeats included."""
    words = (text or b"").lower().split()  # of bytes: A-Z, and the six ASCII blanks
    if len(words) < SHINGLE:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    runs = zip(*(words[k:] for k in range(SHINGLE)))
    return [xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in runs]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The fingerprint of each row, whose hashes follow one another (``sizes`` of them; none: zero)."""
    counts = np.zeros((len(sizes), BITS), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    for a in range(0, len(hashes), _STEP):
        part, own = hashes[a : a + _STEP], rows[a : a + _STEP]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        bits = np.unpackbits(part.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    over = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (as a signed 64-bit integer) of every document."""

    def task(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            step: list[int] = []
            prints, sizes, rows = [], [], 0
            for k, text in enumerate(texts):
                hashes = shingle_hashes(text)
                step += hashes
                sizes.append(len(hashes))
                if len(step) >= _STEP or k == len(texts) - 1:
                    prints.append(majority(np.array(step, U64), np.array(sizes, np.int64)))
                    step, sizes = [], []
            found = np.concatenate(prints).view(np.int64) if prints else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fingerprint"])

    return arrow_tasks(docs).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        tidy(task), "doc_id bigint, fingerprint bigint")


def part_masks() -> list[int]:
    """For each choice of ``PARTS - RADIUS`` parts, the bits it fixes."""
    cuts = [BITS * k // PARTS for k in range(PARTS + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [reduce(int.__or__, chosen) for chosen in combinations(parts, PARTS - RADIUS)]


def bit_planes(prints: np.ndarray, room: int) -> np.ndarray:
    """``planes[p]`` with bit ``p`` of row ``64 * w + l`` as bit ``l`` of word ``w``, for ``room`` rows (zero behind the last)."""
    bits = np.zeros((room, BITS), np.uint8)
    bits[: len(prints)] = np.unpackbits(prints.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def _shifted(plane: np.ndarray, at: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Words of a plane from word ``at`` on, moved down by ``bits`` lanes."""
    return (plane[at] >> bits) | ((plane[at + 1] << U64(1)) << (U64(63) - bits))


def within_radius(planes: np.ndarray, start: np.ndarray, shift: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Of the ``wanted`` pairs of each unit, those within the radius.

    A unit is ``_LANES`` lanes from word ``start`` on against those ``shift``
    lanes further; ``wanted`` has a bit for each of its pairs.
    """
    out = np.zeros_like(wanted)
    live = np.flatnonzero(wanted.any(1))
    words = np.arange(_WORDS)
    low = mid = over = None
    here = there = bits = None
    for p in range(BITS):
        if p % _PLANES == 0:
            if p:
                open_ = (~over & wanted[live]).any(1)
                live, low, mid, over = live[open_], low[open_], mid[open_], over[open_]
            else:
                low, mid, over = (np.zeros((len(live), _WORDS), U64) for _ in range(3))
            if not len(live):
                return out
            here = start[live][:, None] + words
            there = here + (shift[live] // 64)[:, None]
            bits = (shift[live] % 64).astype(U64)[:, None]
        carry = planes[p][here] ^ _shifted(planes[p], there, bits)
        low, carry = low ^ carry, low & carry
        mid, carry = mid ^ carry, mid & carry
        over |= carry  # a fourth difference
    out[live] = ~over & wanted[live]
    return out


class Forest:
    """Rows joined in trees of height one."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                return
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def joined_rows(prints: np.ndarray, cell: np.ndarray, block: np.ndarray, within: np.ndarray) -> np.ndarray:
    """For each row, a row of the same cell that it is connected with (itself if with none before it).

    Rows of a ``cell`` follow one another.  Where ``within`` is not set, only
    rows of different ``block`` are compared.  ``RADIUS`` is three: the
    counter holds two bits.
    """
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    size = np.diff(np.concatenate([first, [len(cell)]]))
    big = np.argsort(-size, kind="stable")  # rows with a row ``d`` behind them in their cell are in front
    order = np.concatenate([np.arange(first[k], first[k] + size[k]) for k in big])
    most, size = int(size[big[0]]), size[big]
    room = 64 * (-(-(len(order) + most) // 64)) + 2 * _LANES
    planes = bit_planes(prints[order], room)
    names, parts, both = np.full(room, -1, np.int64), np.zeros(room, np.int64), np.zeros(room, bool)
    names[: len(order)], parts[: len(order)], both[: len(order)] = np.repeat(np.arange(len(big)), size), block[order], within[order]
    size = np.repeat(size, size)
    forest = Forest(len(order))

    def compare(units):
        starts, shifts = (np.concatenate(x) for x in zip(*units))
        lanes = starts[:, None] * 64 + np.arange(_LANES)
        far = lanes + shifts[:, None]
        wanted = (names[lanes] == names[far]) & (names[lanes] >= 0) & (both[lanes] | (parts[lanes] != parts[far]))
        hits = within_radius(planes, starts, shifts, np.packbits(wanted, axis=1, bitorder="little").view("<u8"))
        some = np.flatnonzero(hits.any(1))
        unit, lane = np.nonzero(np.unpackbits(hits[some].view(np.uint8), axis=1, bitorder="little"))
        a = lanes[some[unit], lane]
        forest.join(a, a + shifts[some[unit]])

    units, waiting = [], 0
    for d in range(1, most):
        active = int(np.searchsorted(-size, -d, "left"))  # rows of cells larger than d
        starts = np.arange(0, -(-active // _LANES)) * _WORDS
        for k in range(0, len(starts), _UNITS):
            units.append((starts[k : k + _UNITS], np.full(len(starts[k : k + _UNITS]), d)))
            waiting += len(units[-1][0])
            if waiting >= _UNITS:
                compare(units)
                units, waiting = [], 0
    if units:
        compare(units)
    out = np.empty(len(order), np.int64)
    out[order] = order[forest.root]
    return out


def _links_task(batches):
    """Links of the cells in a task's rows, which are sorted by cell."""
    rest, least = None, 1 << 16
    for batch in batches:
        rest = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        if rest.num_rows < least:
            continue
        cell = _cells(rest)
        cut = int(np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))[-1])
        if cut:
            yield from _links(rest.slice(0, cut))
            rest = rest.slice(cut)
    if rest is not None and rest.num_rows:
        yield from _links(rest)


def _cells(batch) -> np.ndarray:
    """A number for each row's cell."""
    keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
    new = np.zeros(batch.num_rows, bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new)


def _links(batch):
    cell = _cells(batch)
    prints = batch.column(5).to_numpy(zero_copy_only=False)
    i, j, block = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4))
    root = joined_rows(prints.view(U64), cell, block, i == j)
    moved = root != np.arange(len(root))
    yield pa.RecordBatch.from_arrays([pa.array(prints[moved]), pa.array(prints[root[moved]])], ["u", "v"])


def linked(distinct: DataFrame) -> DataFrame:
    """``u, v``: pairs of fingerprints, as many as connect all those within the radius of each other."""
    tables = F.array(*(F.struct(F.lit(k).alias("choice"), F.col("fingerprint").bitwiseAND(_signed(mask)).alias("bits"))
                       for k, mask in enumerate(part_masks())))
    rows = distinct.select("fingerprint", F.inline(tables))
    busy = rows.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(
        "choice", "bits", F.ceil(F.col("rows") / BLOCK).alias("blocks"))
    rows = rows.join(busy, ["choice", "bits"]).withColumn("block", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")))
    cell = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda other: F.struct(
        F.least("block", other).alias("i"), F.greatest("block", other).alias("j")))
    cells = rows.select("choice", "bits", F.inline(cell), "block", "fingerprint")
    return arrow_tasks(cells.repartition("choice", "bits", "i", "j").sortWithinPartitions("choice", "bits", "i", "j")).mapInArrow(
        _links_task, "u bigint, v bigint")


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document; the fingerprint as 16 hexadecimal digits."""
    rows = materialize(fingerprints(docs), "fingerprints")
    distinct = materialize(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")), "distinct")
    roots = components(linked(distinct.select("fingerprint")))
    named = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", "rows", F.coalesce("root", "fingerprint").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(named.join(ids, "root").select("fingerprint", "component_id", "rows"), "components")
    # A hot fingerprint's documents get their component where they lie; the others meet it by a shuffle.
    hot, _ = checked_broadcast(named.where(F.col("rows") >= HOT_ROWS).select(
        F.col("fingerprint").alias("hot"), F.struct("component_id").alias("known")))
    cold = named.where(F.col("rows") < HOT_ROWS).select(F.col("fingerprint").alias("cold"), F.col("component_id").alias("own"))
    rows = rows.join(hot, rows["fingerprint"] == hot["hot"], "left")
    key = F.when(F.col("hot").isNull(), F.col("fingerprint")).otherwise(F.xxhash64(F.monotonically_increasing_id()))
    rows = rows.withColumn("key", key).join(cold, F.col("key") == F.col("cold"), "left")
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                       F.when(F.col("hot").isNull(), F.col("own")).otherwise(F.col("known.component_id")).alias("component_id"))
