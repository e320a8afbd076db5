"""Shards by a weighted hash tree: region, rack, shard.

A row descends the tree.  At each level the children draw by hash of the row's
key and their own name: child ``c`` of weight ``w`` draws ``-ln(u(key, c)) / w``
and the smallest draw wins, so a child is chosen in proportion to its weight
and a row's draws at other children never change.  Raising a child's weight
therefore only moves rows into it, at that level; rows that change subtree
descend the new one, nothing else moves.  A shard added in a region of its own
takes rows into itself alone.

All of it is one projection (no shuffle); numbering rows inside a shard is one
shuffle on ``(shard, block)`` with blocks by hash, so no shard is one task.

Defined cases: a null key draws as the empty string; a null text has size 1
and checksum 0; equal rows land together and are numbered one after another;
an empty table stays empty; extra columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize

BLOCK_ROWS = 50_000
LEAST_BLOCKS = 64  # blocks of a shard, also for small tables


@dataclass(frozen=True)
class Leaf:
    """A shard and its place; weights are those of whole subtrees' sums."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(shards: int, base: int = 8) -> list[Leaf]:
    """``base`` shards, four a region and two a rack, and every further shard in a region of its own; equal weights.

    From ``base`` shards on, one more takes rows only into itself.
    """
    regions = [s // 4 if s < base else base // 4 + s - base for s in range(shards)]
    return [Leaf(f"g{g}", f"g{g}/k{s // 2}", s) for s, g in enumerate(regions)]


def _draw(key: Column, name: str, weight: float) -> Column:
    """The draw of one child: exponential with rate ``weight``."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11).cast("double")
    return -F.log((bits + 0.5) / float(1 << 53)) / weight


def _choose(key: Column, children: dict[str, float]) -> Column:
    """The name of the winning child."""
    if len(children) == 1:
        return F.lit(next(iter(children)))
    draws = [F.struct(_draw(key, name, w).alias("d"), F.lit(name).alias("n")) for name, w in sorted(children.items())]
    return F.least(*draws)["n"]


def assign(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of each key."""
    if not leaves or any(x.weight <= 0 for x in leaves):
        raise ValueError("a tree needs shards of positive weight")
    key = F.coalesce(key.cast("string"), F.lit(""))

    def descend(prefix: tuple[str, ...], under: list[Leaf]) -> Column:
        depth = len(prefix)
        names = [(x.region, x.rack, f"{x.rack}/s{x.shard}")[depth] for x in under]
        weights: dict[str, float] = {}
        for name, x in zip(names, under):
            weights[name] = weights.get(name, 0.0) + x.weight
        if depth == 2:
            if len(weights) != len(under):
                raise ValueError("a shard is named twice")
            number = {f"{x.rack}/s{x.shard}": x.shard for x in under}
            if len(number) == 1:
                return F.lit(next(iter(number.values())))
            win, out = _choose(key, weights), None
            for name, s in number.items():
                out = F.when(win == name, F.lit(s)) if out is None else out.when(win == name, F.lit(s))
            return out
        below = {name: descend((*prefix, name), [x for x, n in zip(under, names) if n == name]) for name in weights}
        if len(below) == 1:
            return next(iter(below.values()))
        win, out = _choose(key, weights), None
        for name, column in below.items():
            out = F.when(win == name, column) if out is None else out.when(win == name, column)
        return out

    return descend((), leaves)


def number_in_shards(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` and ``slot``: gapless numbers from 0 inside each shard, by blocks of rows (a hash of ``order``)."""
    blocks = max(LEAST_BLOCKS, -(-rows.count() // BLOCK_ROWS))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    counts = rows.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("shard", "_block", (F.sum("_n").over(Window.partitionBy("shard").orderBy("_block")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("shard", "_block").orderBy(*order)) - 1
    return rows.withColumn("_inside", inside).join(before, ["shard", "_block"]).withColumn(
        "slot", (F.col("_before") + F.col("_inside")).cast("bigint")).drop("_block", "_inside", "_before")


def shard_documents(docs: DataFrame, leaves: list[Leaf], grown: list[Leaf]) -> DataFrame:
    """``doc_id, size, text_crc32, shard, grown_shard, slot`` of every document, placed by ``doc_id``."""
    text = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        assign(F.col("doc_id"), leaves).cast("int").alias("shard"), assign(F.col("doc_id"), grown).cast("int").alias("grown_shard"))
    return number_in_shards(materialize(rows, "shards"), ["doc_id", "text_crc32", "size"])
