"""Turn a DataFrame into an index: documents, postings and per-shard stats.

Everything here is lazy DataFrame code; ``tessera.sources.store.save`` writes
the three datasets.  Shape of an index:

``docs``      shard int, doc bigint, <spec columns>
``postings``  shard int, doc bigint, field string, term string, tf bigint, dl bigint
              (one row per distinct term of a text field in a document, or per
              distinct value of a keyword field; dl is the token count of the
              field, NULL for keywords)
``stats``     shard int, field string, n_docs bigint, sum_dl bigint
              (field NULL: all documents of the shard; additive over appends)
``terms``     shard int, field string, term string, df bigint (saved indexes
              only: the term dictionary; additive over appends)
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import stage
from ..functions.text import tokens
from .numbering import number_by_input_partition, number_within
from .spec import IndexSpec

DEFAULT_BUCKETS = 64
# Saved documents lie in directories of this many consecutive ids of a shard.
DOC_RANGE = "doc_range"
DOCS_PER_RANGE = 100_000


def bucket_of(term_col: Column, num_buckets: int) -> Column:
    """Postings bucket of a term.  Applied to a literal it is constant-folded
    by Catalyst, so ``bucket == bucket_of(lit(t))`` prunes partitions."""
    return F.pmod(F.xxhash64(term_col), F.lit(num_buckets)).cast("int")


def doc_range_of(doc: Column) -> Column:
    """Directory of a document id within its shard."""
    return F.floor(doc / DOCS_PER_RANGE).cast("bigint")


@dataclass
class Index:
    """An index as three DataFrames plus its spec.

    ``bucketed`` is true when ``postings`` carries the partition column
    ``bucket`` (a saved index); term lookups then prune by bucket.
    ``num_shards`` is an upper bound on the shard count when known; it sizes
    broadcasts of per-shard tables.
    """

    docs: DataFrame
    postings: DataFrame
    stats: DataFrame
    spec: IndexSpec
    num_buckets: int | None = DEFAULT_BUCKETS
    bucketed: bool = False
    num_shards: int | None = None
    table: str | None = None
    generations: tuple = field(default_factory=tuple)
    # Saved indexes: document frequency per (shard, field, term, doc_range),
    # with the greatest tf and least dl there, one row per generation,
    # partitioned by ``bucket`` like the postings (the term dictionary).  None
    # for an in-memory index: counted from postings.
    terms: DataFrame | None = None
    # Saved indexes: documents of the snapshot, from the manifest, and the
    # documents and generations of terms that were asked for before (the
    # snapshot never changes).
    num_docs: int | None = None
    known_sizes: dict[tuple[str, str], tuple[int, tuple[int, ...]]] = field(default_factory=dict)
    # Saved indexes: ``value, shard, doc`` of each numeric field, sorted by
    # value.  None for an in-memory index: numeric terms filter ``docs``.
    points: dict[str, DataFrame] | None = None
    # Saved indexes: the postings as they are stored, a row per term and block
    # of documents (see :mod:`tessera.operators.blocks`); ``postings`` are
    # their rows.  None for an in-memory index.
    blocks: DataFrame | None = None

    @property
    def sparkSession(self):
        return self.docs.sparkSession

    # -- searching -----------------------------------------------------------
    def search(self, query=None):
        from .search import Search

        return Search(self, query)

    def search_many(self, lookups: DataFrame, k: int | None = None):
        from .batch import search_many

        return search_many(self, lookups, k)

    # -- metadata ------------------------------------------------------------
    def shards(self) -> DataFrame:
        """One row per shard with its document count (from ``stats``)."""
        return (
            self.stats.where(F.col("field").isNull())
            .groupBy("shard")
            .agg(F.sum("n_docs").cast("bigint").alias("n_docs"))
        )

    def fields(self) -> list[str]:
        """Stored field names, from the spec: no job, empty index allowed.
        Point-only (numeric, not stored) fields are left out."""
        return list(self.spec.stored)

    def visible_docs(self) -> DataFrame:
        """``docs`` with only the columns readers see (stored and numeric)."""
        return self.docs.select("shard", "doc", *self.spec.doc_columns)

    # -- caching -------------------------------------------------------------
    def cache(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> "Index":
        """Keep the datasets in executor memory across searches."""
        for df in self._frames():
            df.persist(level)
        return self

    def unpersist(self) -> "Index":
        for df in self._frames():
            df.unpersist()
        return self

    def _frames(self) -> list[DataFrame]:
        points = list((self.points or {}).values())
        return [df for df in (self.docs, self.postings, self.stats, self.terms, *points) if df is not None]

    def with_frames(self, **kw) -> "Index":
        return replace(self, known_sizes={}, **kw)


def _field_tokens(df: DataFrame, name: str) -> Column:
    dt = df.schema[name].dataType
    if isinstance(dt, T.ArrayType):
        # Multi-valued text: the values are analysed one after another.
        return F.flatten(F.transform(F.col(name), lambda v: F.coalesce(tokens(v), F.array().cast("array<string>"))))
    return tokens(name)


def _keyword_values(df: DataFrame, name: str) -> Column:
    dt = df.schema[name].dataType
    if isinstance(dt, T.ArrayType):
        return F.array_distinct(F.array_compact(F.col(name)))
    return F.when(F.col(name).isNotNull(), F.array(F.col(name)))


def field_values(df: DataFrame, spec: IndexSpec, name: str) -> Column:
    """``array<string>`` of a text field's tokens or a keyword field's distinct values."""
    return _field_tokens(df, name) if name in spec.text else _keyword_values(df, name)


def _bind(value: Column, fn) -> Column:
    """``fn(v)`` with ``v`` bound to ``value`` once per row.

    A lambda variable holds a value; an expression referred to inside a
    lambda (or twice after projections are merged by the optimizer) would be
    evaluated again at each use."""
    return F.get(F.transform(F.array(value), fn), 0)


def _entry(term: Column, tf: Column, dl: Column) -> Column:
    return F.struct(term.cast("string").alias("term"), tf.cast("bigint").alias("tf"), dl.cast("bigint").alias("dl"))


def _text_entries(tokens_col: Column, norms: bool) -> Column:
    """``array<struct<term, tf, dl>>`` of one text field of one document,
    computed inside the row (no shuffle): the distinct tokens with their
    counts, plus the norm entry (term NULL) when ``norms``.

    The tokens are sorted, so equal tokens form runs; ``e`` holds the
    0-based end of each run and a count is the distance to the previous end.
    An empty or NULL field gives NULL (no rows).
    """

    def per_doc(s: Column) -> Column:
        n = F.size(s)
        ends = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == n - 1) | (F.get(s, i) != F.get(s, i + 1)))
        runs = _bind(ends, lambda e: F.transform(e, lambda x, j: _entry(
            F.get(s, x), x - F.coalesce(F.get(e, j - 1), F.lit(-1)), n)))
        if norms:
            runs = F.concat(F.array(_entry(F.lit(None), F.lit(None), n)), runs)
        return F.when(n > 0, runs)

    return _bind(F.sort_array(tokens_col), per_doc)


def _keyword_entries(values: Column, norms: bool) -> Column:
    entries = F.transform(values, lambda v: _entry(v, F.lit(1), F.lit(None)))
    if norms:
        entries = F.when(F.size(values) > 0, F.concat(F.array(_entry(F.lit(None), F.lit(None), F.lit(None))), entries))
    return entries


def index_rows(docs: DataFrame, spec: IndexSpec, norms: bool = False) -> DataFrame:
    """Postings of every text and keyword field:
    ``shard, doc, field, term, tf, dl``.

    Text: term counts are computed inside each document's row (sorted tokens,
    run lengths), so no shuffle is needed and a very common term is never a
    hot key.  Keyword: one row per distinct value, ``tf = 1``, ``dl`` NULL.

    With ``norms`` the frame also holds one *norm* row per document and
    field it has (``term`` and ``tf`` NULL, ``dl`` = field length) and one per
    document with ``field`` NULL.  Saving writes these rows by way of
    :func:`tessera.operators.blocks.index_blocks`.
    """
    parts = []
    for name in spec.text:
        entries = _text_entries(_field_tokens(docs, name), norms)
        parts.append(docs.select("shard", "doc", F.lit(name).alias("field"), F.inline(entries)))
    for name in spec.keyword:
        entries = _keyword_entries(_keyword_values(docs, name), norms)
        parts.append(docs.select("shard", "doc", F.lit(name).alias("field"), F.inline(entries)))
    if norms:
        parts.append(docs.select("shard", "doc", F.lit(None).cast("string").alias("field"),
                                 F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("tf"),
                                 F.lit(None).cast("bigint").alias("dl")))
    if not parts:
        spark = docs.sparkSession
        return spark.createDataFrame([], "shard int, doc bigint, field string, term string, tf bigint, dl bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def points_of(docs: DataFrame, name: str) -> DataFrame:
    """``value, shard, doc`` of a numeric field; an array gives each distinct value."""
    if isinstance(docs.schema[name].dataType, T.ArrayType):
        rows = docs.select(F.explode(F.array_distinct(F.col(name))).alias("value"), "shard", "doc")
    else:
        rows = docs.select(F.col(name).alias("value"), "shard", "doc")
    return rows.where(F.col("value").isNotNull())


def postings_of(docs: DataFrame, spec: IndexSpec) -> DataFrame:
    """Postings of every text and keyword field (see :func:`index_rows`)."""
    return index_rows(docs, spec)


def stats_from_norms(norms: DataFrame) -> DataFrame:
    """Per-shard stats from norm rows: one partial aggregate, shards x
    (fields + 1) rows out."""
    return norms.groupBy("shard", "field").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"), F.sum("dl").cast("bigint").alias("sum_dl"))


def stats_of(docs: DataFrame, spec: IndexSpec) -> DataFrame:
    """Per shard and field: documents having the field and their total length.

    One pass over ``docs`` and one aggregate with map-side combine; the
    result has shards x (fields + 1) rows.
    """
    per_doc = [F.col("shard")]
    aggs = [F.count(F.lit(1)).alias("_n_all")]
    for i, name in enumerate(spec.text):
        per_doc.append(F.size(_field_tokens(docs, name)).alias(f"_l{i}"))
        aggs += [F.count_if(F.col(f"_l{i}") > 0).alias(f"_n{i}"),
                 F.sum(F.when(F.col(f"_l{i}") > 0, F.col(f"_l{i}"))).alias(f"_s{i}")]
    for j, name in enumerate(spec.keyword):
        per_doc.append(F.size(_keyword_values(docs, name)).alias(f"_k{j}"))
        aggs.append(F.count_if(F.col(f"_k{j}") > 0).alias(f"_m{j}"))
    grouped = docs.select(*per_doc).groupBy("shard").agg(*aggs)
    rows = [F.struct(F.lit(None).cast("string").alias("field"), F.col("_n_all").alias("n_docs"),
                     F.lit(None).cast("bigint").alias("sum_dl"))]
    for i, name in enumerate(spec.text):
        rows.append(F.struct(F.lit(name).alias("field"), F.col(f"_n{i}").alias("n_docs"),
                             F.col(f"_s{i}").cast("bigint").alias("sum_dl")))
    for j, name in enumerate(spec.keyword):
        rows.append(F.struct(F.lit(name).alias("field"), F.col(f"_m{j}").alias("n_docs"),
                             F.lit(None).cast("bigint").alias("sum_dl")))
    return (
        grouped.select("shard", F.inline(F.array(*rows)))
        .where(F.col("n_docs") > 0)
        .select("shard", "field", F.col("n_docs").cast("bigint").alias("n_docs"), "sum_dl")
    )


def number_docs(df: DataFrame, shard_by=None, num_shards: int | None = None, order_by=None,
                num_partitions: int | None = None) -> tuple[DataFrame, int | None]:
    """Add ``shard`` (int) and ``doc`` (bigint, dense from 0 in each shard).

    * no ``shard_by`` and no ``order_by``: shard = input partition, doc =
      insertion order (no shuffle);
    * ``shard_by`` (a Column with values in ``[0, num_shards)``, anything else
      raises) and/or ``order_by`` (column names, ascending): one shuffle,
      balanced even when one shard holds most rows.
    Placement that follows the input's partitions or row order is written once
    before anything else reads it, so every later pass sees the same ids.
    Returns the numbered frame and an upper bound on the shard count.
    """
    if shard_by is None and order_by is None:
        placed = stage(number_by_input_partition(df, "shard", "doc").withColumn("shard", F.col("shard").cast("int")), "placement")
        return placed, None
    if shard_by is None:
        bound = None
        df = df.withColumn("shard", F.spark_partition_id().cast("int"))
    else:
        if isinstance(shard_by, str):
            shard_by = F.col(shard_by)
        bound = num_shards
        shard = shard_by.cast("int")
        wrong = F.raise_error(F.concat(F.lit(f"shard_by must be in [0, {num_shards}), got "),
                                       F.coalesce(shard.cast("string"), F.lit("NULL"))))
        df = df.withColumn("shard", F.when(shard.between(0, num_shards - 1), shard).otherwise(wrong.cast("int")))
    if order_by is None:
        df = df.withColumn("_ins", F.monotonically_increasing_id())
        order = ["_ins"]
    else:
        order = list(order_by) if isinstance(order_by, (list, tuple)) else [order_by]
        if not all(isinstance(c, str) for c in order):
            raise TypeError("order_by takes column names (ascending); add computed keys with withColumn first")
    if shard_by is None or order_by is None:
        df = stage(df, "placement")  # range partitioning reads its input twice
    out = number_within(df, "shard", order, "doc", num_partitions=num_partitions)
    return out.drop("_ins") if order_by is None else out, bound


def build_index(
    df: DataFrame,
    spec: IndexSpec,
    shard_by=None,
    num_shards: int | None = None,
    order_by=None,
    num_buckets: int | None = None,
    num_partitions: int | None = None,
) -> Index:
    """Index ``df`` according to ``spec``.  Runs the job that fixes document
    ids (see :func:`number_docs`); postings and stats are lazy.

    ``shard_by``/``num_shards`` place rows in shards (default: the input
    partition, as the reference does); ``order_by`` fixes the document order
    inside a shard (default: insertion order).  Use a unique ordering key for
    repeatable ids.  ``num_buckets`` is the number of postings directories of a
    saved table; without it, saving derives it from the size of the documents.
    """
    spec.validate(df.schema)
    if shard_by is not None and num_shards is None:
        raise ValueError("num_shards is required with shard_by (an upper bound on shard values + 1)")
    numbered, bound = number_docs(df, shard_by, num_shards, order_by, num_partitions)
    docs = numbered.select("shard", "doc", *spec.columns)
    return Index(
        docs=docs,
        postings=postings_of(docs, spec),
        stats=stats_of(docs, spec),
        spec=spec,
        num_buckets=num_buckets,
        bucketed=False,
        num_shards=bound,
    )
