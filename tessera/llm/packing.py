"""Best-fit packing of token pieces into fixed-length sequences, by hierarchical residual packing.

Items are dealt to groups by a hash of their row.  Each group is packed
best-fit, longest item first.  A group then closes its bins but for the
``CARRY`` emptiest; those go up as items (their fill is their length), ``FAN``
groups at a time, and are packed again, until one group is left.  After a
best-fit round at most one bin of a group is half full or less, and only such
bins can still be merged, so a short carry loses next to nothing while no
group ever holds more than about ``GROUP_ITEMS`` items.  Groups are decided by
hash, so their mixes of lengths are alike and a hot source spreads over all.

The result says where each piece lies; ``sequences`` puts the ids together.

Defined cases: a null text is an empty one (the end id alone); an item longer
than the capacity raises; a null length raises; an empty table packs to none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_tasks, materialize, tidy
from .tokens import ROWS, Encoder, read_vocabulary

GROUP_ITEMS = 2000
CARRY = 64
FAN = 4


def token_pieces(docs: DataFrame, vocabulary_path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """``doc_id, piece, start, length, ids``: every document's ids and the end id, cut only where longer than ``capacity``."""
    vocabulary, tail = read_vocabulary(vocabulary_path), np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def encode(batches):
        encoder = Encoder.of(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                ids, texts = batch.column(0).slice(first, ROWS), batch.column(1).slice(first, ROWS)
                raw = [x + tail for x in encoder.encode(texts)]
                cut = [(i, k, x[a : a + step]) for i, x in enumerate(raw) for k, a in enumerate(range(0, len(x), step))]
                rows, pieces, parts = zip(*cut)
                pieces = np.array(pieces, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)), pa.array(pieces), pa.array(pieces.astype(np.int64) * capacity),
                     pa.array([len(x) // 4 for x in parts], pa.int64()), pa.array(parts, pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"])

    return arrow_tasks(docs).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        tidy(encode), "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each item, and each bin's fill."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some open bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        room -= size
        if not by_room[room]:
            rooms |= 1 << room
        by_room[room].append(b)
    return bins, offsets, np.array(fill, np.int64)


def pack(items: DataFrame, capacity: int = 4096, size: str = "length") -> DataFrame:
    """All columns of ``items`` and ``sequence_id``, ``offset`` (in place of columns of these names).

    Names that begin with ``__pack_`` are the operator's own.
    """
    items = items.drop("sequence_id", "offset")
    items = materialize(items.withColumn("__pack_row", F.monotonically_increasing_id()), "pieces")
    names = [c for c in items.columns if c != "__pack_row"]
    n = items.count()
    groups = max(1, -(-n // GROUP_ITEMS))

    def place(table: pa.Table) -> pa.Table:
        group, rows = table.column("__pack_group")[0].as_py(), table.column("__pack_row").to_numpy()
        if table.column(size).null_count:
            raise ValueError(f"an item has no {size}")
        lengths = table.column(size).to_numpy()
        if len(lengths) and (lengths.max() > capacity or lengths.min() < 1):
            raise ValueError(f"an item's {size} is not between 1 and {capacity}")
        order = np.argsort(rows, kind="stable")
        bins, offsets, fill = best_fit(lengths[order], capacity)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        open_ = np.zeros(len(fill), bool)
        open_[np.argsort(fill, kind="stable")[:CARRY]] = True
        open_ &= fill < capacity
        bins, offsets = bins[back], offsets[back]
        return (table.drop_columns(["__pack_group", "__pack_row"]).append_column("__pack_bin", pa.array((group << 20) + bins))
                .append_column("offset", pa.array(offsets)).append_column("__pack_fill", pa.array(fill[bins]))
                .append_column("__pack_open", pa.array(open_[bins])))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema if f.name != "__pack_row")
    dealt = items.withColumn("__pack_group", F.pmod(F.xxhash64("__pack_row"), F.lit(groups)))
    placed = materialize(
        dealt.groupBy("__pack_group").applyInArrow(place, f"{kinds}, __pack_bin bigint, offset bigint, __pack_fill bigint, __pack_open boolean"), "packed")
    merged = merge_open(placed, groups, capacity)
    if merged is None:
        return placed.select(*names, F.col("__pack_bin").alias("sequence_id"), "offset")
    return placed.join(merged, "__pack_bin", "left").select(
        *names, F.coalesce("__pack_top", "__pack_bin").alias("sequence_id"), (F.col("offset") + F.coalesce("__pack_shift", F.lit(0))).alias("offset"))


def merge_open(placed: DataFrame, groups: int, capacity: int) -> DataFrame | None:
    """``_bin, _top, _shift`` of the open bins after the rounds above the first; a merged bin takes its first part's number."""

    def merge(table: pa.Table) -> pa.Table:
        ids, fills = table.column("__pack_bin").to_numpy(), table.column("__pack_fill").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, fills = ids[order], fills[order]
        bins, shifts, total = best_fit(fills, capacity)
        first = np.empty(len(total), np.int64)
        first[bins[shifts == 0]] = ids[shifts == 0]
        open_ = np.zeros(len(total), bool)
        open_[np.argsort(total, kind="stable")[:CARRY]] = True
        return pa.table({"__pack_bin": ids, "__pack_top": first[bins], "__pack_shift": shifts, "__pack_fill": total[bins], "__pack_open": open_[bins] & (total[bins] < capacity)})

    open_bins = placed.where("__pack_open").groupBy("__pack_bin").agg(F.first("__pack_fill").alias("__pack_fill"))
    rounds = []
    while groups > 1:
        groups = -(-groups // FAN)
        level = len(rounds) + 1
        group = F.floor(F.shiftright("__pack_bin", 20) / FAN**level)
        done = materialize(open_bins.withColumn("__pack_group", group).groupBy("__pack_group").applyInArrow(
            merge, "__pack_bin bigint, __pack_top bigint, __pack_shift bigint, __pack_fill bigint, __pack_open boolean"), f"merge{level}")
        rounds.append(done)
        open_bins = done.where("__pack_open AND __pack_shift = 0").select(F.col("__pack_top").alias("__pack_bin"), "__pack_fill")
    if not rounds:
        return None
    whole = rounds.pop().select("__pack_bin", "__pack_top", "__pack_shift")
    for done in reversed(rounds):
        up = whole.select(F.col("__pack_bin").alias("__pack_mid"), F.col("__pack_top").alias("__pack_up"), F.col("__pack_shift").alias("__pack_more"))
        whole = done.join(up, done["__pack_top"] == up["__pack_mid"], "left").select(
            "__pack_bin", F.coalesce("__pack_up", "__pack_top").alias("__pack_top"), (F.col("__pack_shift") + F.coalesce("__pack_more", F.lit(0))).alias("__pack_shift"))
    return whole


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, doc_ids, ids``: the ids of each sequence in order of offset (at most ``capacity`` of them)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "piece", F.col("doc_id").alias("doc"), F.col("ids").alias("raw"))))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.col("p.doc").alias("doc_ids"),
        F.aggregate("p.raw", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))
