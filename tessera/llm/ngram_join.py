"""Documents linked by the Jaccard similarity of their five-word shingle sets (0.75 or more), exactly.

Grouped prefix join.  Documents with equal sets are one *class* first.  Under
one global order of shingles, two sets can only reach the similarity if their
*prefixes* (the first ``n - ceil(3n/4) + 1`` shingles) meet.  The order is
rare first: (1) shingles whose hash lies in the lowest ``LOW`` of the hash
range, by the number of classes with them, (2) such shingles that a batch of
classes already holds many times (*hot*), by hash, (3) all others, by hash.
Any fixed order is right; this one keeps passages that many documents share
out of prefixes, and lets counting look at ``LOW`` of the shingles only.

Hashes are counted in buckets of the hash range, packed as arrays; hot ones
are known before and never sent there, so a bucket holds few entries of any
one shingle.  Shingles of a single class link nothing and go no further than
their bucket; they only move the others back in the prefix.

Classes with the same prefix and size become one *group*.  Groups that meet in
a prefix shingle are compared by size and by position (how much can still be
shared behind it).  First each shingle's groups are only compared with its
earliest group (a star); pairs are expanded to members and verified on whole
sets, and links give components.  Then the members of all groups that meet are
compared with those of other components, so a large group of near copies costs
its star, and no link between different components is lost.  Here a *sketch*
also counts: one bit for each of ``SKETCH`` hash cells, the parity of a set's
shingles in it.  Cells where two sets differ are no more than shingles in only
one of them, and those may be ``(n + m) / 7`` at most.

Defined cases: words are runs without space and ``\\x09-\\x0D``, A-Z folded;
a text of fewer than five words is one shingle; without words (or null) it is
empty and linked with nothing (``component_id`` is its own ``doc_id``).
Repeated rows are one class.  A null ``doc_id`` never names a component unless
all its rows are null.  Sets and classes are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..plans.broadcast import checked_broadcast
from . import textops
from .components import components
from .shared import arrow_tasks, materialize, tidy, with_facts

SHINGLE = 5
LOW = 0.4
HOT_IN_BATCH = 12
MOST_HOT = 1_000_000  # hot shingles known to every task (8 MB); of more, the most frequent
BUCKET_ENTRIES = 500_000
CUT = np.uint64(int(LOW * (1 << 64)))
BLOCK = 2000  # classes of one shingle that are compared with as many others in one task
SKETCH = 1024
LONGS = SKETCH // 64


def prefix_length(n):
    """Shingles of the prefix of a set of ``n``."""
    return n - (3 * n + 3) // 4 + 1


def sketches(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each set, the parities of its hashes in ``SKETCH`` cells, as ``LONGS`` integers."""
    out = np.zeros((len(bounds) - 1, LONGS), np.int64)
    cells = ((hashes >> np.uint64(10)) % np.uint64(SKETCH)).astype(np.int64)
    for a in range(0, len(out), 1000):
        b = min(a + 1000, len(out))
        rows = np.repeat(np.arange(b - a), np.diff(bounds[a : b + 1]))
        count = np.bincount(rows * SKETCH + cells[bounds[a] : bounds[b]], minlength=(b - a) * SKETCH)
        out[a:b] = np.packbits((count & 1).astype(np.uint8)).view(np.int64).reshape(-1, LONGS)
    return out


def shingle_classes(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n, class, sketch, stored``: each document's set size and class.

    ``stored`` (once per class and task, with ``sketch``) has the set's hashes
    below ``CUT``, or the least of all where those are fewer than its prefix.
    """

    def task(batches):
        seen: set[int] = set()
        for batch in batches:
            for i, hashes, bounds in textops.shingle_sets(batch.column(2), SHINGLE):
                n = np.diff(bounds)
                low = np.concatenate([[0], np.cumsum(hashes < CUT)])
                keep = np.minimum(n, np.maximum(np.diff(low[bounds]), prefix_length(n)))
                classes = textops.hash_of(hashes, bounds).view(np.int64)
                stored, marks = [], sketches(hashes, bounds)
                for c, size, a, k in zip(classes.tolist(), n.tolist(), bounds.tolist(), keep.tolist()):
                    stored.append(hashes[a : a + k].tobytes() if size and c not in seen else None)
                    seen.add(c)
                if len(seen) > 1_000_000:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, len(n)), batch.column(1).slice(i, len(n)), pa.array(n.astype(np.int64)), pa.array(classes),
                     pa.array([None if x is None else m for x, m in zip(stored, marks)], pa.list_(pa.int64())), pa.array(stored, pa.binary())],
                    ["doc_id", "text_hash", "n", "class", "sketch", "stored"])

    return arrow_tasks(docs).select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        tidy(task), "doc_id bigint, text_hash bigint, n bigint, class bigint, sketch array<bigint>, stored binary")


def _stored(batch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """All stored hashes of a batch, and the row of each."""
    blobs = batch.column(column).to_pylist()
    return (np.frombuffer(b"".join(blobs), np.uint64),
            np.repeat(np.arange(len(blobs)), np.array([len(x) // 8 for x in blobs], np.int64)))


def hot_shingles(stored: DataFrame) -> np.ndarray:
    """Hashes that a single batch of classes holds ``HOT_IN_BATCH`` times or more."""

    def task(batches):
        for batch in batches:
            hashes, _ = _stored(batch, 0)
            values, counts = np.unique(hashes[hashes < CUT], return_counts=True)
            many = counts >= HOT_IN_BATCH
            yield pa.RecordBatch.from_arrays([pa.array(values[many].view(np.int64)), pa.array(counts[many])], ["h", "n"])

    hot = materialize(stored.select("stored").mapInArrow(task, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")), "hot")
    found = hot.count()
    if found > MOST_HOT:
        hot = hot.where(F.col("n") > hot.approxQuantile("n", [1 - MOST_HOT / found], 0.001)[0])
    return np.sort(np.array([r[0] for r in hot.select("h").collect()], np.int64).view(np.uint64))


class Order:
    """The global order of shingles, and the bucket of each."""

    def __init__(self, hot: np.ndarray, buckets: int):
        self.hot = hot
        self.width = np.uint64(int(CUT) // buckets + 1)

    def is_hot(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hot, hashes), len(self.hot) - 1)
        return self.hot[at] == hashes

    def counted(self, batch, column: int):
        """Hashes, their rows, and whether they are counted in buckets."""
        hashes, rows = _stored(batch, column)
        return hashes, rows, (hashes < CUT) & ~self.is_hot(hashes)


def shared_shingles(stored: DataFrame, order: Order) -> DataFrame:
    """``class, h, df`` for the counted shingles of two classes or more."""

    def deal(batches):
        for batch in (x.slice(k, 2500) for x in batches for k in range(0, x.num_rows, 2500)):
            hashes, rows, counted = order.counted(batch, 1)
            names = hashes[counted]
            classes = batch.column(0).to_numpy()[rows[counted]]
            by = np.argsort(names, kind="stable")
            names, classes = names[by], classes[by]
            bucket = (names // order.width).astype(np.int32)
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            starts, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]
            if not len(bucket):
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[starts]), pa.array([names[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                 pa.array([classes[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())], ["bucket", "names", "classes"])

    def count(table: pa.Table) -> pa.Table:
        names = np.frombuffer(b"".join(table.column("names").to_pylist()), np.uint64)
        classes = np.frombuffer(b"".join(table.column("classes").to_pylist()), np.int64)
        by = np.argsort(names, kind="stable")
        names, classes = names[by], classes[by]
        twin = np.zeros(len(names) + 1, bool)
        twin[1:-1] = names[1:] == names[:-1]
        some = twin[:-1] | twin[1:]
        names, classes = names[some], classes[some]
        by = np.lexsort((classes, names))
        names, classes = names[by], classes[by]
        fresh = np.ones(len(names), bool)
        fresh[1:] = (names[1:] != names[:-1]) | (classes[1:] != classes[:-1])
        names, classes = names[fresh], classes[fresh]
        _, at, df = np.unique(names, return_inverse=True, return_counts=True)
        df = df[at]
        many = df > 1
        return pa.table({"class": classes[many], "h": names[many].view(np.int64), "df": df[many].astype(np.int64)})

    return (stored.select("class", "stored").mapInArrow(tidy(deal), "bucket int, names binary, classes binary")
            .groupBy("bucket").applyInArrow(count, "class bigint, h bigint, df bigint"))


def class_sizes(stored: DataFrame, order: Order) -> DataFrame:
    """``class, n, counted, behind``: sizes, counted shingles, and the rest of a prefix where those do not fill it."""

    def task(batches):
        for batch in batches:
            n = batch.column(1).to_numpy()
            hashes, rows, counted = order.counted(batch, 2)
            own = np.bincount(rows[counted], minlength=len(n))
            bounds = np.searchsorted(rows, np.arange(len(n) + 1))
            need = prefix_length(n) - own
            behind: list[list[int]] = [[] for _ in range(len(n))]
            for r in np.flatnonzero(need > 0):
                left = hashes[bounds[r] : bounds[r + 1]][~counted[bounds[r] : bounds[r + 1]]]  # hot ones come first: they are below CUT
                behind[r] = left[: need[r]].view(np.int64).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own.astype(np.int64)), pa.array(behind, pa.list_(pa.int64()))],
                                             ["class", "n", "counted", "behind"])

    return (stored.select("class", "n", "stored").mapInArrow(tidy(task), "class bigint, n bigint, counted bigint, behind array<bigint>")
            .dropDuplicates(["class"]))


def prefixes(shared: DataFrame, sizes: DataFrame) -> DataFrame:
    """``class, n, own, h, pos``: prefix shingles that may meet others; ``own`` shingles of the class alone come before them."""
    length = F.col("n") - F.ceil(3 * F.col("n") / 4) + 1
    mine = Window.partitionBy("class")
    first = (shared.join(sizes.select("class", "n", "counted"), "class")
             .withColumn("own", F.col("counted") - F.count(F.lit(1)).over(mine))
             .withColumn("pos", F.col("own") + F.row_number().over(mine.orderBy("df", "h")))
             .where(F.col("pos") <= length).select("class", "n", "own", "h", "pos"))
    then = sizes.where(F.size("behind") > 0).select("class", "n", "counted", F.posexplode("behind").alias("k", "h")).select(
        "class", "n", F.lit(None).cast("bigint").alias("own"), "h", (F.col("counted") + F.col("k") + 1).alias("pos"))
    return first.unionByName(then)


def grouped(prefix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(postings, members)``: prefix shingles ``h, group, n, pos`` and ``group, class``.

    Classes with the same size and prefix, all of it shared, are one group.
    """
    whole = prefix.groupBy("class", "n").agg(F.max("own").alias("own"), F.count(F.lit(1)).alias("k"),
                                             F.array_sort(F.collect_list(F.struct("pos", "h"))).alias("p"))
    full = F.col("k") == F.col("n") - F.ceil(3 * F.col("n") / 4) + 1
    groups = materialize(whole.select(F.when(full, F.xxhash64("n", "p.h")).otherwise(F.col("class")).alias("group"), "class", "n", "p"), "groups")
    first = groups.groupBy("group", "n").agg(F.min("class").alias("class"))
    postings = groups.join(first.select("group", "class"), ["group", "class"]).select("group", "n", F.inline("p")).select("h", "group", "n", "pos")
    return materialize(postings, "postings"), groups.select("group", "class")


def _possible(a: str, b: str):
    """Whether the sizes and positions of two groups allow the similarity (7 * shared >= 3 * (n + n))."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = 1 + F.least(n - F.col(f"{a}.pos"), m - F.col(f"{b}.pos"))
    return (4 * F.greatest(n, m) * 3 <= 16 * F.least(n, m)) & (7 * most >= 3 * (n + m))


def star_pairs(postings: DataFrame) -> DataFrame:
    """Each shingle's earliest group against its others: ``a, b`` (groups)."""
    hubs = postings.groupBy("h").agg(F.min(F.struct("pos", "n", "group")).alias("hub"), F.count(F.lit(1)).alias("k")).where("k > 1").select(
        "h", "hub.pos", "hub.n", "hub.group")
    return (hubs.alias("x").join(postings.alias("y"), F.col("x.h") == F.col("y.h"))
            .where((F.col("x.group") != F.col("y.group")) & _possible("x", "y"))
            .select(F.least("x.group", "y.group").alias("a"), F.greatest("x.group", "y.group").alias("b")).distinct())


def other_pairs(postings: DataFrame, members: DataFrame, stored: DataFrame, roots: DataFrame) -> DataFrame:
    """All pairs ``u, v`` of classes that meet in a shingle, can be similar, and are not yet one component.

    The classes of a shingle are dealt to blocks of about ``BLOCK``; each pair
    of blocks is compared on its own, so a task holds two blocks at most.
    """
    rows = members.join(roots, members["class"] == roots["node"], "left").select("group", "class", F.coalesce("root", "class").alias("part"))
    rows = postings.join(rows, "group").select("h", "class", "n", "pos", "part")
    mixed = rows.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q")
    rows = rows.join(mixed.select("h", F.ceil(F.col("k") / BLOCK).alias("blocks")), "h").withColumn(
        "block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    rows = materialize(rows, "mixed")
    marks = stored.select("class", "sketch").dropDuplicates(["class"])
    cell = F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda j: F.struct(
        F.least("block", j).alias("i"), F.greatest("block", j).alias("j"))))
    cells = (rows.join(marks, "class").withColumn("cell", cell)
             .select("h", "cell.i", "cell.j", "class", "n", "pos", "part", "block", "sketch")
             .repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "n"))
    return _ordered(arrow_tasks(cells).mapInArrow(tidy(_compare_cells), "u bigint, v bigint"))


def _compare_cells(batches):
    """Pairs of each cell; a cell's rows follow one another, by size."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        keys = np.stack([table.column(k).to_numpy() for k in range(3)])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist()]
        yield from _compare(table.slice(0, cuts[-1]), [*cuts])
        rest = table.slice(cuts[-1])
    if rest is not None:
        yield from _compare(rest, [0, rest.num_rows])


def _compare(table: pa.Table, cuts: list[int]):
    if not table.num_rows:
        return
    i, j, classes, n, pos, part, block = (table.column(k).to_numpy() for k in range(1, 8))
    marks = table.column("sketch").combine_chunks()
    sketch = marks.flatten().to_numpy().view(np.uint64).reshape(-1, LONGS)
    found = []
    for a, b in zip(cuts, cuts[1:]):
        if part[a] == part[b - 1] and (part[a:b] == part[a]).all():
            continue
        if b - a <= 48:
            x, y = np.triu_indices(b - a, 1)
            found.append(_alike(x + a, y + a, i, j, n, pos, part, block, sketch))
            continue
        last = a + np.searchsorted(n[a:b], 4 * n[a:b] // 3, "right")
        for x in range(a, b):
            y = np.arange(x + 1, last[x - a])
            if len(y):
                found.append(_alike(x, y, i, j, n, pos, part, block, sketch))
    if found:
        u, v = np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
        yield pa.RecordBatch.from_arrays([pa.array(classes[u]), pa.array(classes[v])], ["u", "v"])


def _alike(x, y, i, j, n, pos, part, block, sketch):
    """Those of the rows ``x`` and ``y`` that may be similar (``n[x] <= n[y]``)."""
    total = n[x] + n[y]
    good = (part[x] != part[y]) & (4 * n[x] >= 3 * n[y]) & (7 * (1 + np.minimum(n[x] - pos[x], n[y] - pos[y])) >= 3 * total)
    good &= (i[y] == j[y]) | (block[x] != block[y])
    y = y[good]
    x, total = (x[good] if isinstance(x, np.ndarray) else x), total[good]
    differ = np.bitwise_count(sketch[x] ^ sketch[y]).sum(-1, dtype=np.int64)
    keep = 7 * differ <= total
    y = y[keep]
    return (x[keep] if isinstance(x, np.ndarray) else np.full(len(y), x)), y


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links among ``pairs(u, v)`` of classes, by their whole sets."""
    pairs = materialize(pairs, "pairs")
    asked = pairs.select(F.col("u").alias("class")).unionByName(pairs.select(F.col("v").alias("class"))).distinct()
    texts = classes.where("n > 0").join(asked, "class", "left_semi").groupBy("class").agg(F.min("text_hash").alias("text_hash"))
    texts, _ = checked_broadcast(materialize(texts.select("text_hash").distinct(), "asked"))

    def sets(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, hashes, bounds in textops.shingle_sets(batch.column(0), SHINGLE):
                classes = textops.hash_of(hashes, bounds).view(np.int64).tolist()
                new = [i for i, c in enumerate(classes) if c not in seen and not seen.add(c)]
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), lists], ["class", "shingles"]).take(pa.array(new, pa.int64()))

    found = (docs.select("text", F.xxhash64("text").alias("text_hash")).join(texts, "text_hash", "left_semi").select("text")
             .mapInArrow(tidy(sets), "class bigint, shingles array<bigint>").dropDuplicates(["class"]))
    found = materialize(found, "sets")
    left = found.select(F.col("class").alias("u"), F.col("shingles").alias("x"))
    right = found.select(F.col("class").alias("v"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "u").join(right, "v").where(7 * shared >= 3 * (F.size("x") + F.size("y"))).select("u", "v")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id`` of every document."""
    docs = docs.select("doc_id", "text")
    classes = materialize(shingle_classes(docs), "classes")
    stored = classes.where("stored IS NOT NULL").select("class", "n", "stored")
    entries = stored.agg(F.sum(F.octet_length("stored"))).first()[0] or 0
    buckets = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), entries // 8 // BUCKET_ENTRIES + 1)
    order = Order(hot_shingles(stored), buckets)
    prefix = prefixes(shared_shingles(stored, order), materialize(class_sizes(stored, order), "sizes"))
    postings, members = grouped(prefix)

    least = members.groupBy("group").agg(F.min("class").alias("least"))
    a = least.select(F.col("group").alias("a"), F.col("least").alias("u"))
    b = members.select(F.col("group").alias("b"), F.col("class").alias("v"))
    stars = star_pairs(postings)
    inside = members.join(least, "group").where("class <> least").select(F.col("least").alias("u"), F.col("class").alias("v"))
    pairs = _ordered(stars.join(a, "a").join(b, "b").select("u", "v").unionByName(inside))
    first = verified(pairs, docs, classes)
    roots = materialize(components(first), "roots")

    more = other_pairs(postings, members, classes.where("stored IS NOT NULL"), roots)
    more = _apart(more, roots).join(pairs, ["u", "v"], "left_anti")
    roots = components(verified(more, docs, classes).unionByName(
        roots.select(F.col("node").alias("u"), F.col("root").alias("v"))))

    named = classes.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    named = named.join(roots, named["class"] == roots["node"], "left").select("class", "doc_id", F.coalesce("root", "class").alias("part"))
    ids = named.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    named = materialize(named.join(ids, "part").select("class", "component_id"), "components")
    return classes.join(named, "class", "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of classes that are not in one component."""
    x, y = roots.select(F.col("node").alias("u"), F.col("root").alias("ru")), roots.select(F.col("node").alias("v"), F.col("root").alias("rv"))
    return pairs.join(x, "u", "left").join(y, "v", "left").where(
        F.coalesce("ru", "u") != F.coalesce("rv", "v")).select("u", "v")


def first_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the least ``doc_id``, and every document without words; columns as in ``docs``.

    Rows of the ``doc_id`` that stays are one document and all stay; where a
    component's ``doc_id`` are all null, its rows stay.
    """
    going = near_duplicates(docs).where("component_id IS NOT NULL AND (doc_id IS NULL OR doc_id <> component_id)")
    joined, about = with_facts(docs, going.select("doc_id", "text_hash"))
    return joined.where(about["text_hash"].isNull()).select(*(docs[c] for c in docs.columns))
