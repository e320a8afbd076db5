import math
import zlib
from collections import Counter

import pytest
import xxhash
from helpers import clashing, docs_of
from pyspark.sql import functions as F

from tessera.llm import sharding as s


def placed(spark, n, leaves):
    return {r.id: r.s for r in spark.range(n).select("id", s.assign(F.col("id"), leaves).alias("s")).collect()}


def test_shares_follow_weights(spark):
    leaves = [s.Leaf("a", "a1", 0, 1.0), s.Leaf("a", "a2", 1, 2.0), s.Leaf("b", "b1", 2, 4.0), s.Leaf("b", "b1", 3, 1.0)]
    count = Counter(placed(spark, 40_000, leaves).values())
    for leaf in leaves:
        assert abs(count[leaf.shard] / 40_000 - leaf.weight / 8) < 0.01


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    before = s.topology(8)
    old = placed(spark, 20_000, before)
    new = placed(spark, 20_000, s.topology(9))
    assert all(new[i] in (old[i], 8) for i in old) and 0.08 < sum(new[i] == 8 for i in old) / len(old) < 0.14
    # a heavier shard inside a rack: its region, and inside that region its rack, only gain
    heavier = [s.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 0 else 1.0) for x in before]
    new = placed(spark, 20_000, heavier)
    region = {x.shard: x.region for x in before}
    rack = {x.shard: x.rack for x in before}
    for i in old:
        if region[old[i]] != region[new[i]]:
            assert region[new[i]] == "g0"
        elif rack[old[i]] != rack[new[i]]:
            assert rack[new[i]] == "g0/k0"
        elif old[i] != new[i]:
            assert new[i] == 0


@pytest.mark.parametrize("shards", [8, 9, 12])
def test_one_more_shard_takes_rows_only_into_itself(spark, shards):
    old, new = placed(spark, 5_000, s.topology(shards)), placed(spark, 5_000, s.topology(shards + 1))
    assert all(new[i] in (old[i], shards) for i in old) and any(new[i] == shards for i in old)


def test_shards_equal_a_descent_in_python(spark):
    """The draws themselves: XXH64 of the child's name, seeded by that of the key."""
    leaves = [s.Leaf("a", "a1", 0, 1.0), s.Leaf("a", "a1", 1, 2.5), s.Leaf("a", "a2", 2, 1.0), s.Leaf("b", "b1", 3, 4.0), s.Leaf("c", "c1", 4, 0.5), s.Leaf("c", "c2", 5, 0.5)]

    def draw(key, name, weight):
        bits = xxhash.xxh64_intdigest(name, xxhash.xxh64_intdigest(key, 42)) >> 11
        return -math.log((bits + 0.5) / 2**53) / weight

    def descend(key, under, depth=0):
        if depth == 3:
            return under[0].shard
        children = {}
        for x in under:
            children.setdefault((x.region, x.rack, f"{x.rack}/s{x.shard}")[depth], []).append(x)
        best = min(children, key=lambda n: (draw(key, n, sum(x.weight for x in children[n])), n))
        return descend(key, children[best], depth + 1)

    got = placed(spark, 3_000, leaves)
    assert got == {i: descend(str(i), leaves) for i in range(3_000)}


def test_rows_and_slots(spark):
    texts = [None, "", "é😀", "x" * 100_000, *(f"text {k}" for k in range(500))]
    ids = [None, None, *range(len(texts) - 2)]
    texts, ids = texts + [texts[7]] * 3, ids + [ids[7]] * 3
    rows = s.shard_documents(clashing(docs_of(spark, texts, ids)), s.topology(8), s.topology(9)).collect()
    assert len(rows) == len(texts)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts))
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({(r.doc_id, r.shard, r.grown_shard) for r in rows}) == len(set(ids))


def test_empty_and_wrong_trees(spark):
    assert s.shard_documents(docs_of(spark, []), s.topology(8), s.topology(9)).collect() == []
    with pytest.raises(ValueError):
        s.assign(F.col("id"), [])
    with pytest.raises(ValueError):
        s.assign(F.col("id"), [s.Leaf("a", "b", 0, 0.0)])
    with pytest.raises(ValueError):
        s.assign(F.col("id"), [s.Leaf("a", "b", 0), s.Leaf("a", "b", 0)])
