"""What each of several filters removes, alone and behind the others, kept up to date from a stream of files.

Every document has a *mask*: the filters it fails.  Filters A to D look at its
text, E fails a document whose text a smaller ``doc_id`` has, anywhere in the
table.  All that an audit reports, for every order of the filters, follows from
how many documents (and how many labelled good or toxic) of each part have each
mask.  So the stream only keeps those *part counters*.

E is what changes as files arrive.  A query over all files, as available-now
micro-batches, keeps for each text (by its SHA-256) the least ``doc_id`` so far
and the rows that have it.  A row behind it counts with E.  When a smaller id
arrives, the rows that led so far are retracted from the counters and
counted again with E.  Retractions and additions are signed rows; each
micro-batch adds them up and writes its part counters under its number, so a
batch that is run again after a failure replaces its own.  State (RocksDB, with
a log of changes) and progress lie in the shared folder: another run over the
same folder takes up files that came since.

A group of the stateful operator costs far more than a text, so it is keyed by
*slices* of the texts' hashes and its state lists the texts of a slice.  There
is a slice for every ``SLICE_ROWS`` rows that the table has when its folder is
begun, so a state stays small whatever the table's size.

Before the rows are keyed, each task finds the least id of each text
among up to ``LOCAL_ROWS`` rows.  Rows behind that one fail E whatever comes,
so they pass by the state, dealt over ``SALTS`` groups.  A text that is a third
of all rows sends a row or two of each such stretch to its state.

Defined cases: a null text is empty; a null source is the part ``""``; a null
``doc_id`` is not smaller than any other and has no smaller one, so it
neither fails E nor makes others fail, and it has no labels; rows with the
same ``doc_id`` and text are counted each and do not fail E for each other; of
several labels of a ``doc_id`` any 1 counts.  Very long texts are only hashed
and split.  Columns beyond these are ignored, whatever their names.  An empty
table has no parts and gives no rows.
"""

from __future__ import annotations

import contextlib
import uuid
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..plans.broadcast import checked_broadcast
from .shared import arrow_tasks, materialize, shared_dir

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
COPY = 1 << FILTERS.index("E")
BATCHES = 4  # micro-batches that the files present are dealt to
LOCAL_ROWS = 100_000
SALTS = 1024
SLICE_ROWS = 200
MOST_LABELS = 200_000  # labelled documents sent to every task; of more, both sides are shuffled
_FACTS = "slice int, key binary, mask int, part string, doc_id bigint, rows bigint"
_DELTAS = "part string, mask int, doc_id bigint, delta bigint"
_STATE = "texts array<binary>, least array<bigint>, masks array<int>, parts array<string>, rows array<bigint>"
_COUNTERS = "part string, mask int, docs bigint, good bigint, toxic bigint"
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # many small stores: no disk set aside for each
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
}


def masks(docs: DataFrame) -> DataFrame:
    """``key, mask, part, doc_id``: each row's text hash and the filters A to D that it fails."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), "")
    sizes = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("distinct")))[0]
    capitals = F.length(F.regexp_replace("t", "[^A-Z]+", ""))
    fails = [F.col("sizes.all") < MIN_WORDS, 100 * F.col("sizes.distinct") < DISTINCT_PERCENT * F.col("sizes.all"),
             100 * capitals.cast("bigint") > CAPITAL_PERCENT * F.length("t").cast("bigint"), F.col("t").rlike("[#$%&*|]")]
    mask = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    return (docs.select(text.alias("t"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("doc_id").cast("bigint").alias("doc_id"))
            .withColumn("sizes", sizes)
            .select(F.unhex(F.sha2("t", 256)).alias("key"), mask.cast("int").alias("mask"), "part", "doc_id"))


def _local_task(slices: int):
    """Rows that lead their text within a stretch, by slice, and the settled others (negative slices)."""

    def task(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= LOCAL_ROWS:
                yield _led(pa.Table.from_batches(held), slices)
                held, rows = [], 0
        if rows:
            yield _led(pa.Table.from_batches(held), slices)

    return task


def _led(table: pa.Table, slices: int) -> pa.RecordBatch:
    frame = table.to_pandas(integer_object_nulls=True)
    frame["text"] = pd.factorize(frame["key"])[0]
    ids = pd.Series(frame["doc_id"].array, dtype="Int64")
    frame["doc_id"] = ids
    least = ids.groupby(frame["text"]).transform("min")
    leads = (ids == least).fillna(False).astype(bool)
    behind = (ids > least).fillna(False).astype(bool)
    frame["mask"] += COPY * behind.astype(int)
    keys = np.frombuffer(b"".join(frame["key"]), "<u8").reshape(len(frame), -1)[:, 0]
    salt = -1 - ids.fillna(0).astype("int64") % SALTS
    frame["slice"] = salt.where(~leads, (keys % np.uint64(slices)).astype(np.int64))
    frame.loc[~leads, "key"] = b""
    out = frame.groupby(["slice", "text", "mask", "part", "doc_id"], dropna=False, sort=False).agg(key=("key", "first"), rows=("key", "size")).reset_index()
    return pa.RecordBatch.from_arrays(
        [pa.array(out["slice"], pa.int32()), pa.array(out["key"], pa.binary()), pa.array(out["mask"], pa.int32()), pa.array(out["part"], pa.string()),
         pa.array(out["doc_id"], pa.int64()), pa.array(out["rows"], pa.int64())], ["slice", "key", "mask", "part", "doc_id", "rows"])


def lead(known, arrived):
    """State and signed counter rows after ``arrived`` rows of one text.

    ``known`` is None or ``(least, mask, {part: rows})``; ``arrived`` are
    ``(doc_id, mask, part, rows)``.  Deltas are ``(part, mask, doc_id, delta)``.
    """
    arrived = list(arrived)
    mask = arrived[0][1]
    least = min(x[0] for x in arrived)
    deltas, own = [], {}
    if known is not None:
        if least < known[0]:
            for part, n in known[2].items():
                deltas += [(part, mask, known[0], -n), (part, mask | COPY, known[0], n)]
        else:
            least, own = known[0], dict(known[2])
    for doc_id, _, part, n in arrived:
        deltas.append((part, mask | COPY if doc_id > least else mask, doc_id, n))
        if doc_id == least:
            own[part] = own.get(part, 0) + n
    return (least, mask, own), deltas


def _settle(key, frames, state):
    names = ["part", "mask", "doc_id", "delta"]
    if key[0] < 0:
        for frame in frames:
            yield frame[["part", "mask", "doc_id", "rows"]].set_axis(names, axis=1)
        return
    arrived: dict[bytes, list] = {}
    for frame in frames:
        for text, *row in zip(*(frame[c].tolist() for c in ("key", "doc_id", "mask", "part", "rows"))):
            arrived.setdefault(text, []).append(row)
    known: dict[bytes, tuple] = {}
    if state.exists:
        for text, least, mask, part, rows in zip(*state.get):
            known.setdefault(bytes(text), (least, mask, {}))[2][part] = rows
    out = []
    for text, rows in arrived.items():
        known[text], deltas = lead(known.get(text), rows)
        out += deltas
    flat = [(text, least, mask, part, rows) for text, (least, mask, own) in known.items() for part, rows in own.items()]
    state.update(tuple(list(x) for x in zip(*flat)))
    yield pd.DataFrame(out, columns=names)


def label_marks(labels: DataFrame) -> DataFrame:
    """``doc_id, good, toxic`` of the documents with either, once each."""
    one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    marks, _ = checked_broadcast(materialize(marks.where("good OR toxic"), "marks"), MOST_LABELS)
    return marks


def _count(deltas: DataFrame, marks: DataFrame) -> DataFrame:
    """Signed part counters of signed rows; equal rows are added up before they meet the labels."""
    rows = deltas.groupBy("part", "mask", "doc_id").agg(F.sum("delta").alias("delta"))
    of = lambda c: F.sum(F.when(F.col(c), F.col("delta")).otherwise(0))
    return rows.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("delta").alias("docs"), of("good").alias("good"), of("toxic").alias("toxic"))


@contextlib.contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the start of a query, which keeps its own copy."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def update(spark: SparkSession, path: str, labels: DataFrame, folder: str, files_per_batch: int | None = None) -> None:
    """Bring the part counters in ``folder`` up to date with all files of ``path``.

    Files that an earlier call took in are not read again.  Without
    ``files_per_batch`` the files present are dealt to ``BATCHES`` batches.
    """
    path = path.rstrip("/")
    table = spark.read.parquet(path)
    if files_per_batch is None:
        files_per_batch = max(1, -(-len(table.inputFiles()) // BATCHES))
    marks = label_marks(labels)

    def add(batch: DataFrame, number: int) -> None:
        _count(batch, marks).write.mode("overwrite").parquet(f"{folder}/counters/batch={number}")

    spark.createDataFrame([], _COUNTERS).write.mode("overwrite").parquet(f"{folder}/counters/batch=-1")
    spark.createDataFrame([(max(1, table.count() // SLICE_ROWS),)], "slices int").write.mode("ignore").parquet(f"{folder}/settings")
    slices = spark.read.schema("slices int").parquet(f"{folder}/settings").first()[0]
    # a pattern, since a stream's plain path must be a folder and a table may be one file; files count however old they are
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch).option(
        "maxFileAge", "36500d").parquet(f"{path[:-1]}[{path[-1]}]")
    rows = arrow_tasks(masks(stream)).mapInArrow(_local_task(slices), _FACTS)
    deltas = rows.groupBy("slice").applyInPandasWithState(_settle, _DELTAS, _STATE, "append", GroupStateTimeout.NoTimeout)
    with _settings(spark, _SETTINGS):
        query = (deltas.writeStream.foreachBatch(add).outputMode("append").option("checkpointLocation", f"{folder}/progress")
                 .trigger(availableNow=True).start())
        query.awaitTermination()


def part_counters(spark: SparkSession, folder: str) -> DataFrame:
    """``part, mask, docs, good, toxic`` over all batches."""
    rows = spark.read.schema(_COUNTERS).parquet(f"{folder}/counters")
    return rows.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("docs", "good", "toxic"))).where("docs <> 0")


def orders(spark: SparkSession) -> DataFrame:
    """For every order of the filters, step and mask: what becomes of a document with that mask (a fixed table)."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[f] for f in order), 0
        share = 1
        for k in range(2, len(FILTERS) + 1):
            share *= k
        for step, f in enumerate(order, 1):
            bit = 1 << f
            for mask in range(1 << len(FILTERS)):
                fails, gone = bool(mask & bit), bool(mask & before)
                rows.append((name, step, mask, not mask & (before | bit), fails and not gone, fails and gone, mask == bit,
                             share // mask.bit_count() if fails else 0))  # in so many orders it is the first that the mask fails
            before |= bit
    return spark.createDataFrame(rows, "filter_order string, step int, mask int, stays boolean, goes boolean, late boolean, only boolean, share int")


def report(spark: SparkSession, counters: DataFrame) -> DataFrame:
    """One row for each part, order and step."""
    of = lambda flag, n="docs": F.sum(F.when(F.col(flag), F.col(n)).otherwise(0)).cast("bigint")
    return counters.join(F.broadcast(orders(spark)), "mask").groupBy("part", "filter_order", "step").agg(
        of("stays").alias("kept"), of("goes").alias("removed"), of("late").alias("redundant"), of("only").alias("unique_fails"),
        of("goes", "good").alias("good_lost"), of("goes", "toxic").alias("toxic_lost"),
        F.sum(F.col("share") * F.col("docs")).cast("bigint").alias("shapley"))


def audit(spark: SparkSession, path: str, labels: DataFrame, folder: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """The report over all files of the table at ``path``; ``folder`` keeps state for later calls."""
    folder = folder or f"{shared_dir(spark)}/llm-audit-{uuid.uuid4().hex}"
    update(spark, path, labels, folder, files_per_batch)
    return report(spark, part_counters(spark, folder))
