"""Saved tables: Parquet datasets in generations, published by a manifest.

Layout under ``<base>/<table>/``::

    docs/gen=<g>/shard=<s>/doc_range=<r>/...
                                     doc, <spec columns> (r = doc / 100,000)
    points/<field>/gen=<g>/...       value, shard, doc of a numeric field
                                     (sorted by value)
    postings/gen=<g>/bucket=<b>/...  shard, field, term, doc, n, tf, dl, docs, tfs, dls, entries:
                                     the postings of a term in a block of
                                     documents (see ``operators/blocks.py``;
                                     sorted by term, field, shard, doc)
    postings/gen=<g>/bucket=-1/...   norms: a posting per document and field
                                     (term NULL, dl = field length)
    terms/gen=<g>/bucket=<b>/...     shard, field, term, doc_range, df, max_tf,
                                     min_dl (the term dictionary: documents of a
                                     range with the term, its greatest count and
                                     the least length there; sorted by term,
                                     field, shard, doc_range)
    stats/gen=<g>/...                shard, field, n_docs, sum_dl
    _manifest/gen=<g>/...            one row per published generation
    _manifest/_claims/<g>            generation numbers that writers took
    _manifest/_commits/<seq>         commits in order, one file each

A generation is visible only once its manifest row exists, and the manifest
row is written last.  A reader lists the manifest once when it opens the table
and keeps that set of generations (a snapshot); data of a failed or later write
is filtered out by ``gen``.  An overwrite publishes a new *base* generation; a
compaction publishes one that ``replaces`` others.  Older files stay for
readers that opened before, until :func:`vacuum`.

Any number of writers may work on a table.  Each takes a generation number of
its own by creating a file that must not exist, and commits by creating the
file of the next commit.  A writer that finds it there has lost the race: an
append numbers its rows again behind the winner's and writes them anew, an
overwrite or a compaction takes the next commit.  The file system must create
files exclusively (HDFS and local disks do; of object stores, those with
conditional writes).
"""

from __future__ import annotations

import contextlib
import itertools
import json
import time
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import staging_dir, table_path
from ..operators.blocks import BLOCK_SCHEMA, posting_rows, stored_blocks
from ..operators.build import (
    DEFAULT_BUCKETS, DOC_RANGE, Index, bucket_of, doc_range_of, points_of, stats_from_norms,
)
from ..operators.spec import IndexSpec
from ..plans.broadcast import checked_broadcast, max_broadcast_rows

# Largest stats table kept on the driver after open (rows).
LOCAL_STATS_ROWS = 100_000
# Partition of the postings directory holding the norm rows.
NORMS_BUCKET = -1
_POSTINGS_SCHEMA = f"{BLOCK_SCHEMA}, bucket int"

_MANIFEST_SCHEMA = (
    "kind string, spec string, num_buckets int, num_shards int, doc_rows bigint, created string, epoch bigint, "
    "stream string, schema string, replaces string, seq bigint"
)
# Shuffle keys of the norms, and shuffle partitions of postings where the session does not have more.
NORMS_KEYS, MOST_PARTITIONS = 8, 1024
# Documents of a postings directory, as written; a table has DEFAULT_BUCKETS of them at least.
BUCKET_BYTES, MOST_BUCKETS = 2 << 30, 65_536
# Documents that a task gathers postings of at least, as written: about a block (files are often split smaller).
GATHER_BYTES = 32 << 20
# A commit whose manifest row does not come within so many seconds is taken for dead.
COMMIT_SECONDS = 60.0
ATTEMPTS = 100
_DATASETS = ("docs", "postings", "terms", "stats")


class LostRace(Exception):
    """Another writer committed first."""


class Superseded(RuntimeError):
    """Another writer replaced what was being merged."""


def read_manifest(spark: SparkSession, path: str) -> list[dict]:
    """Published generations, oldest first (one small row per write)."""
    gens = _subfolders(spark, f"{path}/_manifest", "gen=")
    if not gens:
        return []
    # a manifest that cannot be read raises: taking it for "no table" would
    # let an append publish a new base and hide earlier data
    rows = spark.read.schema(_MANIFEST_SCHEMA + ", gen int").option("basePath", f"{path}/_manifest").parquet(*gens).collect()
    return sorted((r.asDict() for r in rows), key=lambda r: (r["gen"] if r["seq"] is None else r["seq"], r["gen"]))


def _subfolders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Folders below ``path`` whose name starts with ``prefix``; none if it does not exist."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [x.getPath().toString() for x in fs.listStatus(p) if x.isDirectory() and x.getPath().getName().startswith(prefix)]


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists.  Of several writers one succeeds."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p.getParent())
    try:
        if fs.getScheme() == "file":
            # the local file system's own create looks first and writes then
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(p.toUri().getPath()).toPath(), spark.sparkContext._gateway.new_array(
                jvm.java.nio.file.attribute.FileAttribute, 0))
        else:
            fs.create(p, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def _bytes_below(spark: SparkSession, path: str) -> int:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def _bucket_count(spark: SparkSession, docs_path: str) -> int:
    """Postings directories for documents of this size: postings take about as much room as these."""
    return min(MOST_BUCKETS, max(DEFAULT_BUCKETS, -(-_bytes_below(spark, docs_path) // BUCKET_BYTES)))


def _gather_tasks(spark: SparkSession, docs_path: str) -> int:
    """Most tasks that gather postings: the more documents one has, the fewer rows hold a term, but no core is left idle."""
    return max(2 * spark.sparkContext.defaultParallelism, _bytes_below(spark, docs_path) // GATHER_BYTES)


def _file_names(spark: SparkSession, path: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []


def _next_gen(spark: SparkSession, path: str, manifest: list[dict]) -> int:
    """A generation number that no published, failed or running write has; it is this writer's from now on."""
    gen = max((m["gen"] for m in manifest), default=-1) + 1
    while any(_exists(spark, f"{path}/{d}/gen={gen}") for d in (*_DATASETS, "_manifest")) or not _create_new(spark, f"{path}/_manifest/_claims/{gen}"):
        gen += 1
    return gen


def _committed(spark: SparkSession, path: str) -> tuple[list[dict], int]:
    """The manifest with all commits begun so far, and the number of the next one.

    A commit is begun by its file and done with its row; in between its
    writer only writes that row, which is waited for.
    """
    until = time.monotonic() + COMMIT_SECONDS
    while True:
        begun = {int(x) for x in _file_names(spark, f"{path}/_manifest/_commits") if x.isdigit()}
        manifest = read_manifest(spark, path)
        open_ = begun - {m["seq"] for m in manifest}
        if not open_:
            return manifest, max(begun, default=max((m["gen"] for m in manifest), default=-1)) + 1
        if time.monotonic() > until:
            raise RuntimeError(f"commit {min(open_)} of another writer did not finish; if that writer is gone, delete "
                               f"{path}/_manifest/_commits/{min(open_)}")
        time.sleep(0.1)


def _since_base(manifest: list[dict]) -> list[dict]:
    """Entries from the newest base on that did not come from a compaction."""
    start = 0
    for i, m in enumerate(manifest):
        if m["kind"] == "base" and not m["replaces"]:
            start = i
    return manifest[start:]


def _live(manifest: list[dict]) -> list[dict]:
    """Generations from the newest base onwards that none has replaced."""
    entries = _since_base(manifest)
    gone = {g for m in entries if m["replaces"] for g in json.loads(m["replaces"])}
    return [m for m in entries if m["gen"] not in gone]


def _write_stats(stats: DataFrame, out: str, name: str) -> int:
    """Write the (tiny) stats and return the shard-count bound seen while
    writing (max shard + 1), without a second job."""
    obs = Observation(name)
    # the aggregate runs in parallel; only its (shards x fields) rows meet in one file
    (stats.repartition(1).observe(obs, F.max("shard").alias("top"))
     .write.mode("errorifexists").parquet(out))
    top = obs.get["top"]
    return int(top) + 1 if top is not None else 0


def _publish(spark: SparkSession, path: str, gen: int, kind: str, spec: IndexSpec, num_buckets: int,
             num_shards: int, doc_rows: int, epoch: int | None, stream: str | None, schema: str, seq: int,
             replaces: list[int] | None = None) -> None:
    """Commit ``gen`` as commit ``seq``; raises :class:`LostRace` if that is another writer's."""
    if not _create_new(spark, f"{path}/_manifest/_commits/{seq}"):
        raise LostRace
    row = [(kind, json.dumps(spec.to_dict()), num_buckets, num_shards, doc_rows,
            datetime.now(timezone.utc).isoformat(), epoch, stream, schema, json.dumps(replaces) if replaces else None, seq)]
    (spark.createDataFrame(row, _MANIFEST_SCHEMA).coalesce(1)
     .write.mode("errorifexists").parquet(f"{path}/_manifest/gen={gen}"))


def _write_postings(blocks: DataFrame, out: str, num_buckets: int) -> None:
    """Cluster postings by term: rebalance their blocks on ``bucket`` (AQE
    splits a hot bucket and coalesces small ones), sort inside each task, and
    write one directory per bucket.  Lookups prune directories by bucket and
    row groups by term.  Norm rows (term NULL) go to ``bucket=-1``.

    Blocks come in the order of their terms, so what a shuffle partition of one bucket
    gets from a task is a sorted run: there are enough partitions for most to
    have one bucket, and the sort compares the term before the field."""
    bucket = F.when(F.col("term").isNull(), F.lit(NORMS_BUCKET)).otherwise(bucket_of(F.col("term"), num_buckets))
    # norms are as many as documents x fields: their directory is one, but not their shuffle key
    spread = F.when(F.col("term").isNull(), F.pmod(F.xxhash64("shard", "doc"), F.lit(NORMS_KEYS))).otherwise(F.lit(0))
    partitions = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(4 * num_buckets, MOST_PARTITIONS))
    (blocks.withColumn("bucket", bucket).withColumn("_spread", spread)
     .hint("rebalance", partitions, "bucket", "_spread").drop("_spread")
     .sortWithinPartitions("bucket", "term", "field", "shard", "doc")
     .write.mode("errorifexists").partitionBy("bucket").parquet(out))


def _write_terms(spark: SparkSession, postings_path: str, out: str) -> None:
    """The term dictionary of one generation: document frequency, greatest
    count and least length per ``(field, term, shard, doc_range)``, read from
    the written postings: the blocks tell them without their arrays.  A
    search looks up its terms here instead of counting matching postings a
    second time.
    """
    rows = spark.read.schema(_POSTINGS_SCHEMA).parquet(postings_path).where(F.col("bucket") != NORMS_BUCKET)
    _write_dictionary(rows.select("bucket", "field", "term", "shard", doc_range_of(F.col("doc")).alias(DOC_RANGE), F.coalesce("n", F.lit(1)).alias("df"),
                                  F.col("tf").alias("max_tf"), F.col("dl").alias("min_dl")), out)


def _write_dictionary(terms: DataFrame, out: str) -> None:
    """Write dictionary rows, summed, clustered by bucket like the postings: one
    directory per bucket, sorted by term.  Terms are spread over buckets by
    their hash, so dealing by bucket is even and one shuffle serves the sums too."""
    (terms.repartition("bucket").groupBy("bucket", "field", "term", "shard", DOC_RANGE)
     .agg(F.sum("df").cast("bigint").alias("df"), F.max("max_tf").alias("max_tf"), F.min("min_dl").alias("min_dl"))
     .sortWithinPartitions("bucket", "term", "field", "shard", DOC_RANGE)
     .write.mode("errorifexists").partitionBy("bucket").parquet(out))


_TERMS_SCHEMA = "shard int, field string, term string, doc_range bigint, df bigint, max_tf bigint, min_dl bigint, bucket int"
_STATS_SCHEMA = "shard int, field string, n_docs bigint, sum_dl bigint"
# Fixed schemas of the datasets whose layout does not depend on the input (a
# generation of an empty input has no files to infer them from).
_SCHEMAS = {"postings": _POSTINGS_SCHEMA, "terms": _TERMS_SCHEMA, "stats": _STATS_SCHEMA}


def _ddl(types: str) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in json.loads(types).items())


def _read_gens(spark: SparkSession, path: str, dataset: str, gens: list[int]) -> DataFrame:
    """One dataset over the given generations only: nothing else is listed,
    and unpublished directories never take part in schema inference."""
    base = f"{path}/{dataset}"
    reader = spark.read.option("basePath", base)
    if dataset in _SCHEMAS:
        reader = reader.schema(_SCHEMAS[dataset] + ", gen int")
    return reader.parquet(*[f"{base}/gen={g}" for g in gens])


def _read_docs(spark: SparkSession, path: str, live: list[dict], spec: IndexSpec) -> DataFrame:
    """Documents of the live generations, with the types in the manifest."""
    base, folders = f"{path}/docs", [f"{path}/docs/gen={m['gen']}" for m in live]
    docs = spark.read.schema(_docs_schema(live[-1]["schema"]) + ", gen int").option("basePath", base).parquet(*folders)
    return docs.select("shard", "doc", DOC_RANGE, *spec.columns)


def _docs_schema(types: str) -> str:
    columns = _ddl(types)
    return f"doc bigint, {columns + ', ' if columns else ''}shard int, {DOC_RANGE} bigint"


def _write_docs(docs: DataFrame, out: str) -> None:
    """Rows come in blocks of consecutive ids of a shard, so a task fills few directories."""
    (docs.withColumn(DOC_RANGE, doc_range_of(F.col("doc"))).sortWithinPartitions("shard", "doc")
     .write.mode("errorifexists").partitionBy("shard", DOC_RANGE).parquet(out))


def _write_points(docs: DataFrame, spec: IndexSpec, path: str, gen: int) -> None:
    """One dataset for each numeric field, range-partitioned and sorted by
    value: an exact lookup reads the row groups that can hold the value."""
    for name in spec.numeric:
        rows = points_of(docs, name)
        (rows.repartitionByRange("value", "shard", "doc").sortWithinPartitions("value", "shard", "doc")
         .write.mode("errorifexists").parquet(f"{path}/points/{name}/gen={gen}"))


def _read_points(spark: SparkSession, path: str, docs: DataFrame, spec: IndexSpec, gens: list[int]) -> dict[str, DataFrame]:
    out = {}
    for name in spec.numeric:
        base = f"{path}/points/{name}"
        schema = points_of(docs, name).schema
        out[name] = spark.read.schema(schema).parquet(*[f"{base}/gen={g}" for g in gens]).select("value", "shard", "doc")
    return out


def _shard_offsets(spark: SparkSession, path: str, live: list[dict]) -> DataFrame:
    """Next free doc id of every shard over the live generations."""
    gens = [m["gen"] for m in live]
    return (
        _read_gens(spark, path, "stats", gens).where(F.col("field").isNull())
        .groupBy("shard").agg(F.sum("n_docs").cast("bigint").alias("_offset"))
    )


def _column_types(df: DataFrame, spec: IndexSpec) -> str:
    """Names and types of the spec's columns, as recorded in the manifest."""
    return json.dumps({c: df.schema[c].dataType.simpleString() for c in spec.columns}, sort_keys=True)


def _check_written(written: DataFrame, rows: int, offsets: DataFrame | None) -> None:
    """Raise unless the written documents are ``rows`` rows numbered densely
    in each shard (from the shard's offset): count, least, largest and sum of
    the ids of a shard must be those of a gapless run.  Reads two columns."""
    doc = F.col("doc").cast("decimal(20,0)")
    shards = written.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min(doc).alias("lo"), F.max(doc).alias("hi"), F.sum(doc).alias("s"))
    if offsets is not None:
        shards = shards.join(offsets, "shard", "left")
    first = F.coalesce(F.col("_offset"), F.lit(0)) if offsets is not None else F.lit(0)
    gapless = (F.col("lo") == first) & (F.col("hi") == first + F.col("n") - 1) & (2 * F.col("s") == (F.col("lo") + F.col("hi")) * F.col("n"))
    n, bad = shards.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.count_if(F.coalesce(~gapless, F.lit(True)) | F.col("shard").isNull()), F.lit(0))).first()
    if n != rows or bad:
        raise ValueError(f"not published: {n} rows written of {rows}, {bad} shards without dense document ids "
                         "(the input gave other rows when it was read again)")


def save(index: Index, table: str, mode: str = "errorifexists", epoch: int | None = None, stream: str | None = None,
         merge_factor: int | None = None) -> int:
    """Write an index built by :func:`tessera.build_index`; returns the
    number of documents written (counted during the write, one pass).

    ``mode``: ``errorifexists`` (new table), ``append`` (create if missing;
    doc ids continue after each shard's last one), ``overwrite`` (new base
    generation; readers that opened earlier keep their snapshot).

    ``stream`` and ``epoch`` name a micro-batch; one that a live generation
    holds already is not written again.  Nothing is published unless as many
    rows were written as the index has, with dense ids in every shard.

    With ``merge_factor`` an append is followed by :func:`merge_tiers`; if
    another writer is at the same generations, they are left to it.
    """
    if mode not in ("errorifexists", "error", "append", "overwrite"):
        raise ValueError(f"unsupported mode: {mode}")
    _check_factor(merge_factor)
    path = table_path(index.sparkSession, table)
    for _ in range(ATTEMPTS):
        try:
            rows = _save_once(index, table, path, mode, epoch, stream)
        except LostRace:
            continue
        if merge_factor is not None and mode == "append":
            with contextlib.suppress(Superseded):  # the rows are published; the merge is another writer's
                merge_tiers(index.sparkSession, table, merge_factor)
        return rows
    raise RuntimeError(f"gave up after {ATTEMPTS} lost races for {table}")


def _save_once(index: Index, table: str, path: str, mode: str, epoch: int | None, stream: str | None) -> int:
    """Write one generation and commit it, unless another commit came before it that matters."""
    spark = index.sparkSession
    manifest, seq = _committed(spark, path)
    if manifest and mode in ("errorifexists", "error"):
        raise ValueError(f"table {table} exists; use mode='append' or 'overwrite'")
    gen = _next_gen(spark, path, manifest)
    docs, types = index.docs, _column_types(index.docs, index.spec)
    kind, offsets, num_buckets = "base", None, index.num_buckets
    if manifest and mode == "append":
        live = _live(manifest)
        old_spec = IndexSpec.from_dict(json.loads(live[-1]["spec"]))
        if old_spec != index.spec:
            raise ValueError("appended data must use the table's IndexSpec")
        if num_buckets not in (None, live[-1]["num_buckets"]):
            raise ValueError("appended data must use the table's bucket count")
        num_buckets = live[-1]["num_buckets"]
        if live[-1]["schema"] != types:
            raise ValueError(f"appended data must have the table's column types: {live[-1]['schema']}, got {types}")
        if epoch is not None and any(m["epoch"] == epoch and m["stream"] == stream for m in _since_base(manifest)):
            return 0  # this micro-batch was already published
        offsets, _ = checked_broadcast(_shard_offsets(spark, path, live))
        docs = (docs.join(offsets, "shard", "left")
                .withColumn("doc", F.col("doc") + F.coalesce(F.col("_offset"), F.lit(0)))
                .drop("_offset"))
        kind = "append"

    # 1. documents; ids are fixed from here on (postings derive from the
    #    written rows, never from a recomputation of the input).
    obs = Observation(f"tessera_rows_{table}_{gen}")
    docs_path = f"{path}/docs/gen={gen}"
    _write_docs(docs.select("shard", "doc", *index.spec.columns).observe(obs, F.count(F.lit(1)).alias("rows")), docs_path)
    rows = int(obs.get["rows"])
    written = spark.read.schema(_docs_schema(types)).parquet(docs_path)
    _check_written(written, docs.count(), offsets)
    if mode != "overwrite" and _committed(spark, path)[1] != seq:
        raise LostRace  # rather now than after the postings are written
    _write_points(written, index.spec, path, gen)
    # 2. postings and norms of the written documents, in one job (the text
    #    is tokenized once); 3. stats aggregated from the norms.
    num_buckets = num_buckets or _bucket_count(spark, docs_path)
    postings_path = f"{path}/postings/gen={gen}"
    _write_postings(stored_blocks(written.coalesce(_gather_tasks(spark, docs_path)), index.spec), postings_path, num_buckets)
    _write_terms(spark, postings_path, f"{path}/terms/gen={gen}")
    norms = posting_rows(spark.read.schema(_POSTINGS_SCHEMA).parquet(postings_path).where(F.col("bucket") == NORMS_BUCKET))
    shards = _write_stats(stats_from_norms(norms), f"{path}/stats/gen={gen}", f"tessera_stats_{table}_{gen}")
    # 4. publish.  What an overwrite writes does not depend on other commits.
    while True:
        try:
            _publish(spark, path, gen, kind, index.spec, num_buckets, shards, rows, epoch, stream, types, seq)
            return rows
        except LostRace:
            if mode != "overwrite":
                raise
            _, seq = _committed(spark, path)


def open_index(spark: SparkSession, table: str) -> Index:
    """Open a saved table as of now (snapshot of its published generations)."""
    path = table_path(spark, table)
    manifest = read_manifest(spark, path)
    if not manifest:
        raise ValueError(f"no table {table} under {path}")
    live = _live(manifest)
    gens = [m["gen"] for m in live]
    spec = IndexSpec.from_dict(json.loads(live[-1]["spec"]))
    num_buckets = live[-1]["num_buckets"]
    docs = _read_docs(spark, path, live, spec)
    blocks = _read_gens(spark, path, "postings", gens).where(F.col("bucket") != NORMS_BUCKET)
    terms = _read_gens(spark, path, "terms", gens).select("shard", "field", "term", DOC_RANGE, "df", "max_tf", "min_dl", "bucket", "gen")
    stats = (_read_gens(spark, path, "stats", gens)
             .groupBy("shard", "field")
             .agg(F.sum("n_docs").cast("bigint").alias("n_docs"), F.sum("sum_dl").cast("bigint").alias("sum_dl")))
    num_shards = max(m["num_shards"] for m in live)
    if num_shards * (len(spec.indexed) + 1) <= min(LOCAL_STATS_ROWS, max_broadcast_rows(spark)):
        # Proven bound (shards x (indexed fields + 1)): sum the generations
        # once at open and keep the snapshot's stats as a local relation, so
        # a search does not rescan and re-aggregate them.
        stats = spark.createDataFrame(stats.collect(), _STATS_SCHEMA)
    return Index(
        docs=docs,
        points=_read_points(spark, path, docs, spec, gens),
        postings=posting_rows(blocks).select("shard", "doc", "field", "term", "tf", "dl", "bucket", "gen"),
        blocks=blocks,
        stats=stats,
        spec=spec,
        num_buckets=num_buckets,
        bucketed=True,
        num_shards=num_shards,
        table=table,
        generations=tuple(gens),
        terms=terms,
        # a dictionary without ranges (of a generation before commits had numbers) plans nothing by ranges
        num_docs=sum(m["doc_rows"] for m in live) if all(m["seq"] is not None for m in live) else None,
    )


def _tier(live: list[dict], parts: int) -> list[dict]:
    """The smallest generations that must become one so that ``parts`` are left."""
    if len(live) <= max(1, parts):
        return []
    return sorted(live, key=lambda m: (m["doc_rows"], m["gen"]))[: len(live) - max(1, parts) + 1]


def _size_class(rows: int, factor: int) -> int:
    """How often ``rows`` can be divided by ``factor``."""
    out = 0
    while rows >= factor:
        rows //= factor
        out += 1
    return out


def _full_tier(live: list[dict], factor: int) -> list[dict]:
    """Of the size classes with ``factor`` generations or more, those of the smallest; empty if there is none."""
    classes: dict[int, list[dict]] = {}
    for m in live:
        classes.setdefault(_size_class(m["doc_rows"], factor), []).append(m)
    full = [k for k, members in classes.items() if len(members) >= factor]
    return classes[min(full)] if full else []


def _check_factor(factor: int | None) -> None:
    if factor is not None and factor < 2:
        raise ValueError(f"merge_factor must be 2 or more: {factor}")


def _check_merged(written: DataFrame, sources: DataFrame) -> int:
    """Raise unless the written documents have the ids of the sources: for each shard
    their number, least, largest, sum and a sum of their hashes.  Reads two columns of
    both.  Returns the rows."""
    def ids(rows):
        doc = F.col("doc").cast("decimal(38,0)")
        return {r[0]: tuple(r)[1:] for r in rows.groupBy("shard").agg(
            F.count(F.lit(1)), F.min("doc"), F.max("doc"), F.sum(doc), F.sum(F.xxhash64("doc").cast("decimal(38,0)"))).collect()}

    a, b = ids(written), ids(sources)
    if a != b:
        raise ValueError(f"not published: the merged documents differ in shards {sorted(k for k in a.keys() | b.keys() if a.get(k) != b.get(k))[:5]}")
    return sum(x[0] for x in a.values())


def compact(spark: SparkSession, table: str, parts: int = 1) -> Index:
    """Merge the smallest live generations so that at most ``parts`` are left; hits and ids unchanged.

    Only the merged generations are read and rewritten; others stay as they
    are.  Appends that are committed meanwhile stay too.  Raises if another
    compaction or an overwrite took a merged generation away meanwhile.
    """
    path = table_path(spark, table)
    manifest, seq = _committed(spark, path)
    live = _live(manifest)
    if not live:
        raise ValueError(f"no table {table} under {path}")
    tier = _tier(live, parts)
    if tier:
        _merge(spark, path, table, manifest, seq, tier)
    return open_index(spark, table)


def merge_tiers(spark: SparkSession, table: str, factor: int = 10) -> int:
    """Merge generations of like size wherever there are ``factor`` of them; returns the number of merges.

    A generation's size class is the number of times its rows can be divided
    by ``factor``.  A class with ``factor`` members becomes one generation of
    a higher class, so at most ``(factor - 1) * (log_factor(rows) + 1)``
    generations are left, and a row is rewritten at most once for each class,
    however many appends there are.  Hits and ids are unchanged.  Of writers
    that merge the same generations one succeeds; the others raise
    :class:`Superseded`.
    """
    _check_factor(factor)
    path = table_path(spark, table)
    for merges in itertools.count():
        manifest, seq = _committed(spark, path)
        if not manifest:
            raise ValueError(f"no table {table} under {path}")
        tier = _full_tier(_live(manifest), factor)
        if not tier:
            return merges
        _merge(spark, path, table, manifest, seq, tier)


def _merge(spark: SparkSession, path: str, table: str, manifest: list[dict], seq: int, tier: list[dict]) -> None:
    """Write the generations of ``tier`` as one and commit it in their place."""
    live = _live(manifest)
    gens = [m["gen"] for m in tier]
    spec, num_buckets, types = IndexSpec.from_dict(json.loads(live[-1]["spec"])), live[-1]["num_buckets"], live[-1]["schema"]
    gen = _next_gen(spark, path, manifest)
    sources = _read_docs(spark, path, tier, spec).drop(DOC_RANGE)
    _write_docs(sources.repartitionByRange("shard", "doc"), f"{path}/docs/gen={gen}")
    written = spark.read.schema(_docs_schema(types)).parquet(f"{path}/docs/gen={gen}")
    rows = _check_merged(written, sources)
    _write_points(written, spec, path, gen)
    # postings and norms are carried over; dictionaries and stats are additive
    _write_postings(_read_gens(spark, path, "postings", gens).drop("gen"), f"{path}/postings/gen={gen}", num_buckets)
    if all(m["seq"] is not None for m in tier):
        _write_dictionary(_read_gens(spark, path, "terms", gens), f"{path}/terms/gen={gen}")
    else:
        _write_terms(spark, f"{path}/postings/gen={gen}", f"{path}/terms/gen={gen}")
    stats = _read_gens(spark, path, "stats", gens).groupBy("shard", "field").agg(
        F.sum("n_docs").cast("bigint").alias("n_docs"), F.sum("sum_dl").cast("bigint").alias("sum_dl"))
    shards = _write_stats(stats, f"{path}/stats/gen={gen}", f"tessera_cstats_{table}_{gen}")
    kind = "base" if len(tier) == len(live) else "merge"
    while True:
        try:
            _publish(spark, path, gen, kind, spec, num_buckets, shards, rows, None, None, types, seq, replaces=gens)
            return
        except LostRace:
            manifest, seq = _committed(spark, path)
            if not set(gens) <= {m["gen"] for m in _live(manifest)}:
                raise Superseded(f"another writer replaced generations of {table} while they were merged") from None


def vacuum(spark: SparkSession, table: str, older_than: float = 7 * 86_400.0) -> list[int]:
    """Delete the data of generations that no reader can open any more; returns their numbers.

    A generation that was replaced or overwritten, or never published, goes
    ``older_than`` seconds after that, so a reader that opened the table
    within that time still answers.  Staged rows of the session's staging
    folder go by the same age: choose it above the longest build or job.
    """
    path = table_path(spark, table)
    manifest, _ = _committed(spark, path)
    live = {m["gen"] for m in _live(manifest)}
    now = time.time()
    died: dict[int, float] = {}
    for i, m in enumerate(manifest):
        at = datetime.fromisoformat(m["created"]).timestamp()
        taken = json.loads(m["replaces"]) if m["replaces"] else [x["gen"] for x in manifest[:i]] if m["kind"] == "base" else []
        for g in taken:
            died.setdefault(g, at)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folders = [f"{path}/{d}" for d in _DATASETS]
    points = hadoop(f"{path}/points")
    fs = points.getFileSystem(conf)
    folders += [x.getPath().toString() for x in fs.listStatus(points)] if fs.exists(points) else []
    gone = set()
    for folder in folders:
        for child in _subfolders(spark, folder, "gen="):
            gen, at = int(child.rsplit("=", 1)[1]), hadoop(child)
            since = died.get(gen, fs.getFileStatus(at).getModificationTime() / 1000)
            if gen not in live and now - since >= older_than:
                fs.delete(at, True)
                gone.add(gen)
    staged = hadoop(staging_dir(spark))
    other = staged.getFileSystem(conf)
    for x in other.listStatus(staged) if other.exists(staged) else []:
        if now - x.getModificationTime() / 1000 >= older_than:
            other.delete(x.getPath(), True)
    return sorted(gone)
