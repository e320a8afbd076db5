"""Many term lookups over one index in one job (the tests' lookup loops).

The lookups are a DataFrame ``(query_id, field, term)``; ``term`` is a string
and is cast to the column's type for numeric fields (a value that does not
parse or does not fit matches nothing).  Text and keyword lookups join the
postings; numeric ones join ``docs``.  The lookups side is broadcast only
after a bounded row-count check; larger sets use a shuffle join.  On a saved
index such a set is parted first, by the term dictionary: lookups of terms in
more than ``HEAVY_DOCS`` documents, which are few however many lookups there
are, go to the postings where they lie, so no common word's postings meet in
one task, and only the others are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import stage
from ..plans.broadcast import checked_broadcast
from .blocks import posting_rows
from .build import Index, bucket_of, points_of
from .search import _bm25

HEAVY_DOCS = 100_000


def search_many(index: Index, lookups: DataFrame, k: int | None = None) -> DataFrame:
    """Hits of every lookup: ``query_id, shard, doc, score`` (+ ``rank`` with
    ``k``: the k best per ``query_id`` and shard, score descending then doc).

    A ``query_id`` may have several lookups; each ``(query_id, field, term)``
    is one, with its own document frequencies, and gives its own hits.
    Repeated lookups count once.  Numeric arrays match by any element.
    """
    spark = index.sparkSession
    spec = index.spec
    qid_type = lookups.schema["query_id"].dataType.simpleString()
    lk = lookups.select("query_id", "field", F.col("term").cast("string").alias("term")).distinct()
    lk, small = checked_broadcast(lk)

    parts = []
    if spec.indexed:
        side = lk.where(F.col("field").isin(*spec.indexed)).withColumn("_text", F.col("field").isin(list(spec.text)))
        keys = ["field", "term"]
        if index.bucketed:
            # the bucket lets partition pruning skip directories at run time
            side = side.withColumn("bucket", bucket_of(F.col("term"), index.num_buckets))
            keys.append("bucket")
        for group in [side] if small or index.terms is None else _by_weight(index, side, keys):
            parts.append(_scored(index, group, keys))
    doc_types = {f.name: f.dataType for f in index.docs.schema.fields}
    for name in spec.numeric:
        dtype = doc_types[name]
        many = isinstance(dtype, T.ArrayType)
        base = dtype.elementType if many else dtype
        side = lk.where(F.col("field") == name).select(
            "query_id", F.expr(f"try_cast(term AS {base.simpleString()})").alias("_v")).distinct()
        points = (index.points[name] if index.points is not None else points_of(index.docs, name)).withColumnRenamed("value", "_v")
        parts.append(points.join(side, "_v").select("query_id", "shard", "doc", F.lit(1.0).alias("score")))
    if not parts:
        return spark.createDataFrame([], f"query_id {qid_type}, shard int, doc bigint, score double")
    hits = reduce(lambda a, b: a.unionByName(b), parts)
    if k is None:
        return hits
    w = Window.partitionBy("query_id", "shard").orderBy(F.desc("score"), F.asc("doc"))
    return hits.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def _by_weight(index: Index, side: DataFrame, keys: list[str]) -> list[DataFrame]:
    """The lookups of common terms, to be broadcast if they are few, and the others."""
    terms = side.select(*keys).distinct()
    heavy = index.terms.join(terms, keys).groupBy(*keys).agg(F.sum("df").alias("_docs")).where(F.col("_docs") > HEAVY_DOCS).select(*keys)
    heavy, _ = checked_broadcast(stage(heavy, "heavy"))
    common, few = checked_broadcast(stage(side.join(heavy, keys, "left_semi"), "lookups"))
    return [common, side.join(heavy, keys, "left_anti")] if few else [side]


def _scored(index: Index, side: DataFrame, keys: list[str]) -> DataFrame:
    """``query_id, shard, doc, score`` of the hits of text and keyword lookups."""
    rows = index.postings.join(side, keys) if index.blocks is None else posting_rows(index.blocks.join(side, keys))
    stats = index.stats.where(F.col("field").isNotNull())
    lookup = ["query_id", "field", "term", "shard"]
    if index.terms is not None:
        # Document frequencies from the term dictionary (same pruning).
        per_lookup = index.terms.join(side, keys).groupBy(*lookup).agg(F.sum("df").alias("_df"))
    else:
        per_lookup = rows.groupBy(*lookup).agg(F.count(F.lit(1)).alias("_df"))
    dfs = per_lookup.join(stats, ["shard", "field"]).select(
        *lookup, "_df", F.col("n_docs").alias("_n"), (F.col("sum_dl") / F.col("n_docs")).alias("_avgdl"))
    return rows.join(dfs, lookup).select(
        "query_id", "shard", "doc",
        _bm25(F.col("_text"), F.col("tf").cast("double"), F.col("dl").cast("double"),
              F.col("_n").cast("double"), F.col("_df").cast("double"), F.col("_avgdl")).alias("score"),
    )
