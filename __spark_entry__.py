"""

Every query reads the given tables (whole tables, whole texts) and builds or
opens an index over them.  Placement for all document indexes:
``shard = pmod(key, 3)``, documents numbered by key inside a shard, so the
oracles can write ``key % 3`` and ``row_number() - 1``.  Scores are rounded to
6 decimals on both sides.
"""

from __future__ import annotations

import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera import (
    IndexSpec, base_dir, build_index, compact, ensure_local_dirs, index_stream, match_all, must, open_index, save,
    search_many, should, term,
)

# The training-data operators are a subpackage of their own, which may be absent; if it is there, whatever it
# cannot import is an error.
_llm_spec = importlib.util.find_spec("tessera.llm")
if _llm_spec is not None and _llm_spec.origin is not None:
    import corpus_pipeline
    from tessera.llm import queries as llm
else:
    corpus_pipeline = llm = None

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

DOC_SPEC = IndexSpec(text=["text"], keyword=["lang", "source"], numeric=["n_chars"],
                     stored=["doc_id", "lang", "source"])
PART_SPEC = IndexSpec(text=["p_name"], keyword=["p_brand", "p_type"], numeric=["p_size", "p_retailprice"],
                      stored=["p_partkey", "p_name"])
BATCH_TERMS = ["the", "of", "de", "and", "to", "in", "zzzzqq"]
# The int lookups of the reference's batch test (its string
# lookups are a prefix followed by each of them).
REF_INTS = [3, 100, 9999, 19999, 39999, 53245, 9876523]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _halves(spark, sf):
    """Filters of the first and the second half of the documents by key."""
    half = (_read(spark, sf, "documents").agg(F.max("doc_id")).first()[0] + 1) // 2
    return F.col("doc_id") < half, F.col("doc_id") >= half


def _by_key(df: DataFrame, spec: IndexSpec, key: str):
    return build_index(df, spec, shard_by=F.pmod(F.col(key), F.lit(3)), num_shards=3, order_by=[key])


def _docs_index(spark, sf_dir, where=None):
    d = _read(spark, sf_dir, "documents")
    if where is not None:
        d = d.where(where)
    return _by_key(d, DOC_SPEC, "doc_id")


def _part_index(spark, sf_dir):
    return _by_key(_read(spark, sf_dir, "part"), PART_SPEC, "p_partkey")


def _score() -> F.Column:
    return F.round("score", 6).alias("score")


def _table(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


THE = term("text", "the")
DE = term("text", "de")
NESTED = must(THE, should(term("lang", "de"), term("source", "src3")))


def _hits(q):
    return lambda spark, sf: _docs_index(spark, sf).search(q).hits().select("shard", "doc", "doc_id", _score())


def q_p1_match_all(spark, sf):
    return _part_index(spark, sf).search(match_all()).hits().select("shard", "doc", "p_partkey", _score())


def q_p13_default(spark, sf):
    return _part_index(spark, sf).search().hits().select("shard", "doc", "p_partkey", _score())


def q_p2_term_string(spark, sf):
    idx = _by_key(_read(spark, sf, "customer"), IndexSpec(keyword=["c_mktsegment"], stored=["c_custkey"]), "c_custkey")
    return idx.search(term("c_mktsegment", "BUILDING")).hits().select("shard", "doc", "c_custkey", _score())


def q_p2_multivalued(spark, sf):
    per_customer = _read(spark, sf, "orders").groupBy("o_custkey").agg(
        F.collect_set("o_orderpriority").alias("priorities"))
    idx = _by_key(per_customer, IndexSpec(keyword=["priorities"], stored=["o_custkey"]), "o_custkey")
    return idx.search(term("priorities", "1-URGENT")).hits().select("o_custkey")


def q_p3_term_int(spark, sf):
    return _part_index(spark, sf).search(term("p_size", 11)).hits().select("shard", "doc", "p_partkey", _score())


def q_p4_term_long(spark, sf):
    idx = _by_key(_read(spark, sf, "orders"), IndexSpec(numeric=["o_custkey"], stored=["o_orderkey"]), "o_orderkey")
    return idx.search(term("o_custkey", 0)).hits().select("shard", "doc", "o_orderkey", _score())


def q_p5_term_float(spark, sf):
    part = _read(spark, sf, "part").select("p_partkey", F.col("p_retailprice").cast("float").alias("price_f"))
    idx = _by_key(part, IndexSpec(numeric=["price_f"], stored=["p_partkey"]), "p_partkey")
    return idx.search(term("price_f", 900.1)).hits().select("shard", "doc", "p_partkey", _score())


def q_p6_term_double(spark, sf):
    return _part_index(spark, sf).search(term("p_retailprice", 900.1)).hits().select(
        "shard", "doc", "p_partkey", _score())


def q_p7_term_text(spark, sf):
    return _docs_index(spark, sf).search(THE).hits().select("shard", "doc", "doc_id")


def q_p8_must(spark, sf):
    return _hits(must(term("lang", "en"), THE))(spark, sf)


def q_p11_chained(spark, sf):
    s = _docs_index(spark, sf).search(THE).query(term("lang", "en"))
    return s.hits().select("shard", "doc", "doc_id", _score())


def q_p9_should(spark, sf):
    return _hits(should(term("source", "src1"), DE))(spark, sf)


def q_p10_must_simplify(spark, sf):
    return _hits(must(None, match_all(), THE))(spark, sf)


def q_p12_replace(spark, sf):
    s = _docs_index(spark, sf).search(THE).replace(DE)
    return s.hits().select("shard", "doc", "doc_id", _score())


def q_p14_nested(spark, sf):
    return _docs_index(spark, sf).search(NESTED).hits().select("shard", "doc", "doc_id")


def q_r1_bm25(spark, sf):
    return _hits(THE)(spark, sf)


def q_r1_bm25_bool(spark, sf):
    return _hits(NESTED)(spark, sf)


def q_r1_const(spark, sf):
    return q_p3_term_int(spark, sf)


def q_r2_rank(spark, sf):
    return _docs_index(spark, sf).search(THE).ranked().select("shard", "doc", _score(), "rank")


def q_r3_topk_per_shard(spark, sf):
    return _docs_index(spark, sf).search(THE).top_k_per_shard(10).select("shard", "doc", "doc_id", _score(), "rank")


def q_r4_take(spark, sf):
    return _docs_index(spark, sf).search(THE).take(10).select("shard", "doc", "doc_id", _score())


def q_r5_topk_global(spark, sf):
    return _docs_index(spark, sf).search(THE).top_k(10).select("shard", "doc", "doc_id", _score())


def q_d1_project(spark, sf):
    return _docs_index(spark, sf).search(DE).project(
        "shard", "doc", F.concat_ws(" -> ", F.col("doc").cast("string"), F.col("source")).alias("line"))


def q_d2_doc_ids(spark, sf):
    return _docs_index(spark, sf).search(DE).doc_ids()


def q_d3_field_names(spark, sf):
    return _docs_index(spark, sf).search(DE).field_names().select(
        "shard", "doc", F.explode("fields").alias("field"))


def q_d4_late_fetch(spark, sf):
    return _docs_index(spark, sf).search(DE).top_k_per_shard(10).select(
        "shard", "doc", "lang", "source", _score(), "rank")


def q_a1_count(spark, sf):
    return _docs_index(spark, sf).search(THE).count_frame()


def q_a3_totals_per_shard(spark, sf):
    return _docs_index(spark, sf).search(THE).totals_per_shard()


def q_a4_cached(spark, sf):
    idx = _docs_index(spark, sf).cache()
    first = idx.search(DE).count()  # warms the cache; the second search reuses it
    assert first >= 0
    return idx.search(THE).hits().select("shard", "doc", "doc_id")


def _lookups(spark):
    return spark.createDataFrame([(i + 1, "text", t) for i, t in enumerate(BATCH_TERMS)],
                                 "query_id int, field string, term string")


def q_b1_batch_terms(spark, sf):
    return search_many(_docs_index(spark, sf), _lookups(spark)).select("query_id", "shard", "doc", _score())


def q_b1_batch_topk(spark, sf):
    return search_many(_docs_index(spark, sf), _lookups(spark), k=10).select(
        "query_id", "shard", "doc", _score(), "rank")


def _saved_docs(spark, sf, mode_steps):
    """Run save steps (list of (where, mode)) on a fresh table; return it open."""
    ensure_local_dirs(spark)
    t = _table("docs")
    for where, mode in mode_steps:
        save(_docs_index(spark, sf, where), t, mode=mode)
    return t


def q_w1_save_open(spark, sf):
    t = _saved_docs(spark, sf, [(None, "errorifexists")])
    return open_index(spark, t).visible_docs().select("shard", "doc", "doc_id", "lang", "source", "n_chars")


def q_w2_mapping(spark, sf):
    d = _read(spark, sf, "documents").select(
        "doc_id", F.upper("lang").alias("lang_code"), "source", "text", "n_chars")
    spec = IndexSpec(text=["text"], keyword=["lang_code"], numeric=["n_chars"], stored=["doc_id", "lang_code"])
    return _by_key(d, spec, "doc_id").visible_docs()


def q_w3_shard_counts(spark, sf):
    return _docs_index(spark, sf).shards()


def q_w4_doc_ids(spark, sf):
    return _docs_index(spark, sf).docs.select("doc_id", "shard", "doc")


def q_w5a_append(spark, sf):
    first, second = _halves(spark, sf)
    t = _saved_docs(spark, sf, [(first, "errorifexists"), (second, "append")])
    return open_index(spark, t).docs.select("shard", "doc", "doc_id")


def q_w5b_overwrite(spark, sf):
    first, second = _halves(spark, sf)
    t = _saved_docs(spark, sf, [(first, "errorifexists"), (second, "overwrite")])
    return open_index(spark, t).docs.select("shard", "doc", "doc_id")


def q_w5a_stream_append(spark, sf):
    """Documents arrive as a file stream; each micro-batch is appended."""
    ensure_local_dirs(spark)
    t = _table("stream")
    schema = _read(spark, sf, "documents").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/documents*.parquet")
    q = index_stream(stream, t, DOC_SPEC, shard_by=F.pmod(F.col("doc_id"), F.lit(3)), num_shards=3,
                     order_by=["doc_id"], trigger={"availableNow": True})
    q.awaitTermination()
    return open_index(spark, t).docs.select("shard", "doc", "doc_id")


def q_w6_row_count(spark, sf):
    ensure_local_dirs(spark)
    spec = IndexSpec(keyword=["l_returnflag", "l_linestatus"], numeric=["l_quantity"],
                     stored=["l_orderkey", "l_linenumber"])
    rows = save(build_index(_read(spark, sf, "lineitem"), spec), _table("lineitem"))
    return spark.createDataFrame([(rows,)], "rows bigint")


def q_w7_compact(spark, sf):
    first, second = _halves(spark, sf)
    odd = F.col("n_chars") % 2 == 1
    t = _saved_docs(spark, sf, [(first & odd, "errorifexists"), (first & ~odd, "append"), (second & odd, "append"), (second & ~odd, "append")])
    idx = compact(spark, t)
    return idx.search(THE).hits().select("shard", "doc", "doc_id", _score())


def q_w7_compact_parts(spark, sf):
    """Four generations merged to two: ids stay as they were appended."""
    first, second = _halves(spark, sf)
    odd = F.col("n_chars") % 2 == 1
    t = _saved_docs(spark, sf, [(first & odd, "errorifexists"), (first & ~odd, "append"), (second & odd, "append"), (second & ~odd, "append")])
    idx = compact(spark, t, parts=2)
    assert len(idx.generations) == 2
    return idx.search(THE).hits().select("shard", "doc", "doc_id", _score())


def q_w7_merge_tiers(spark, sf):
    """Four appends, each followed by merges of generations of like size: hits and ids as if none had been merged."""
    ensure_local_dirs(spark)
    first, second = _halves(spark, sf)
    odd = F.col("n_chars") % 2 == 1
    t = _table("tiers")
    for where in (first & odd, first & ~odd, second & odd, second & ~odd):
        save(_docs_index(spark, sf, where), t, mode="append", merge_factor=2)
    idx = open_index(spark, t)
    assert len(idx.generations) < 4
    return idx.search(THE).hits().select("shard", "doc", "doc_id", _score())


def q_w8_postings(spark, sf):
    return _docs_index(spark, sf).postings.select("shard", "doc", "field", "term", "tf", "dl")


def q_w8_term_stats(spark, sf):
    return _docs_index(spark, sf).stats.select("shard", "field", "n_docs", "sum_dl")


def q_w8_doc_freq(spark, sf):
    """The term dictionary of a saved index: documents per (shard, field, term)."""
    first, second = _halves(spark, sf)
    t = _saved_docs(spark, sf, [(first, "errorifexists"), (second, "append")])
    return open_index(spark, t).terms.groupBy("shard", "field", "term").agg(F.sum("df").cast("bigint").alias("df"))


def q_b1_batch_saved(spark, sf):
    t = _saved_docs(spark, sf, [(None, "errorifexists")])
    return search_many(open_index(spark, t), _lookups(spark), k=10).select(
        "query_id", "shard", "doc", _score(), "rank")


def q_b1_batch_ints_strings(spark, sf):
    """The reference's batch test shape: 7 int and 7 string lookups, top 10,
    on a saved index (numeric field ``p_size``, keyword field ``p_brand``)."""
    ensure_local_dirs(spark)
    t = _table("part")
    save(_part_index(spark, sf), t)
    lookups = spark.createDataFrame(
        [(i + 1, "p_size", str(v)) for i, v in enumerate(REF_INTS)]
        + [(101 + i, "p_brand", f"Brand#{v}") for i, v in enumerate(REF_INTS)],
        "query_id int, field string, term string")
    return search_many(open_index(spark, t), lookups, k=10).select("query_id", "shard", "doc", _score(), "rank")


def _two_generations(spark, sf):
    first, second = _halves(spark, sf)
    t = _saved_docs(spark, sf, [(first, "errorifexists"), (second, "append")])
    return open_index(spark, t)


def q_a1_count_saved(spark, sf):
    """Count of a term on a saved index of two generations: answered from the
    term dictionary (no postings scan)."""
    return _two_generations(spark, sf).search(THE).count_frame()


def q_a3_totals_saved(spark, sf):
    return _two_generations(spark, sf).search(term("lang", "fr")).totals_per_shard()


def q_d4_late_fetch_saved(spark, sf):
    """Top 10 per shard with stored fields on a saved index of two
    generations: the two-phase fetch (survivors first, then a pushed
    ``(shard, doc)`` filter on ``docs``)."""
    return _two_generations(spark, sf).search(DE).top_k_per_shard(10).select(
        "shard", "doc", "lang", "source", _score(), "rank")


def q_p3_term_int_saved(spark, sf):
    """An int term on a saved index: a filter pushed to the ``docs`` scan."""
    ensure_local_dirs(spark)
    t = _table("part")
    save(_part_index(spark, sf), t)
    return open_index(spark, t).search(term("p_size", 11)).hits().select("shard", "doc", "p_partkey", _score())


def q_r5_topk_saved(spark, sf):
    t = _saved_docs(spark, sf, [(None, "errorifexists")])
    return open_index(spark, t).search(NESTED).top_k(10).select("shard", "doc", "doc_id", _score())


def q_s2_shards(spark, sf):
    t = _saved_docs(spark, sf, [(None, "errorifexists")])
    return open_index(spark, t).shards()


def q_s3_fields(spark, sf):
    t = _saved_docs(spark, sf, [(None, "errorifexists")])
    return spark.createDataFrame([(f,) for f in open_index(spark, t).fields()], "field string")


def _ids(index, key="doc_id"):
    """One row about the document ids of an index: rows, distinct ids, shards
    whose ids are not 0 .. n - 1, rows out of key order inside their shard."""
    before = F.lag(key).over(Window.partitionBy("shard").orderBy("doc"))
    docs = index.docs.select("shard", "doc", (before > F.col(key)).alias("late"))
    shards = docs.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc").alias("ids"), F.min("doc").alias("lo"),
                                       F.max("doc").alias("hi"), F.count_if("late").alias("late"))
    return shards.agg(F.sum("n").cast("bigint").alias("n_rows"), F.sum("ids").cast("bigint").alias("n_ids"),
                      F.count_if((F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1)).cast("bigint").alias("not_dense"),
                      F.sum("late").cast("bigint").alias("out_of_order"))


def _shuffled_docs(spark, sf):
    """Documents after a shuffle, so partitions and row order are not the file's."""
    d = _read(spark, sf, "documents")
    return d.groupBy("doc_id").agg(*(F.first(c).alias(c) for c in d.columns if c != "doc_id"))


def _saved_ids(spark, sf, **placement):
    ensure_local_dirs(spark)
    t = _table("docs")
    save(build_index(_shuffled_docs(spark, sf), DOC_SPEC, **placement), t)
    return _ids(open_index(spark, t))


def q_w4_order_only(spark, sf):
    """Order without a shard key, on a shuffled input: no row lost, ids dense and in order."""
    return _saved_ids(spark, sf, order_by=["doc_id"], num_partitions=8)


def q_w4_shard_only(spark, sf):
    """A shard key without an order, on a shuffled input: no id given twice."""
    placed = _saved_ids(spark, sf, shard_by=F.pmod("doc_id", F.lit(3)), num_shards=3, num_partitions=8)
    return placed.drop("out_of_order")


def q_w3_default(spark, sf):
    """Default placement (input partition, insertion order) of a shuffled input."""
    return _saved_ids(spark, sf).drop("out_of_order")


def q_w5a_two_streams(spark, sf):
    """Two streams append to one table; their batch numbers are the same."""
    ensure_local_dirs(spark)
    t = _table("streams")
    schema = _read(spark, sf, "documents").schema
    for k, where in enumerate(_halves(spark, sf)):
        stream = spark.readStream.schema(schema).parquet(f"{sf}/documents*.parquet").where(where)
        index_stream(stream, t, DOC_SPEC, shard_by=F.pmod(F.col("doc_id"), F.lit(3)), num_shards=3, order_by=["doc_id"],
                     trigger={"availableNow": True}, checkpoint_location=f"{base_dir(spark)}/{t}-checkpoint-{k}").awaitTermination()
    return open_index(spark, t).docs.select("shard", "doc", "doc_id")


def _saved(spark, sf, index_of):
    ensure_local_dirs(spark)
    t = _table("saved")
    save(index_of(spark, sf), t)
    return open_index(spark, t)


def _orders_index(spark, sf):
    return _by_key(_read(spark, sf, "orders"), IndexSpec(numeric=["o_custkey"], stored=["o_orderkey"]), "o_orderkey")


def q_p2_saved(spark, sf):
    idx = _saved(spark, sf, lambda s, f: _by_key(_read(s, f, "customer"), IndexSpec(keyword=["c_mktsegment"], stored=["c_custkey"]), "c_custkey"))
    return idx.search(term("c_mktsegment", "BUILDING")).hits().select("shard", "doc", "c_custkey", _score())


def q_p4_saved(spark, sf):
    return _saved(spark, sf, _orders_index).search(term("o_custkey", 0)).hits().select("shard", "doc", "o_orderkey", _score())


def q_p5_saved(spark, sf):
    def prices(s, f):
        part = _read(s, f, "part").select("p_partkey", F.col("p_retailprice").cast("float").alias("price_f"))
        return _by_key(part, IndexSpec(numeric=["price_f"], stored=["p_partkey"]), "p_partkey")

    return _saved(spark, sf, prices).search(term("price_f", 900.1)).hits().select("shard", "doc", "p_partkey", _score())


def q_p6_saved(spark, sf):
    return _saved(spark, sf, _part_index).search(term("p_retailprice", 900.1)).hits().select("shard", "doc", "p_partkey", _score())


def q_p8_saved(spark, sf):
    return _two_generations(spark, sf).search(must(term("lang", "en"), THE)).hits().select("shard", "doc", "doc_id", _score())


def q_p9_saved(spark, sf):
    return _two_generations(spark, sf).search(should(term("source", "src1"), DE)).hits().select("shard", "doc", "doc_id", _score())


def q_r2_saved(spark, sf):
    return _two_generations(spark, sf).search(THE).ranked().select("shard", "doc", _score(), "rank")


def q_r4_saved(spark, sf):
    return _two_generations(spark, sf).search(THE).take(10).select("shard", "doc", "doc_id", _score())


def q_d1_saved(spark, sf):
    return _two_generations(spark, sf).search(DE).project(
        "shard", "doc", F.concat_ws(" -> ", F.col("doc").cast("string"), F.col("source")).alias("line"))


def q_d2_saved(spark, sf):
    return _two_generations(spark, sf).search(DE).doc_ids()


def q_i1_saved(spark, sf):
    return _two_generations(spark, sf).search(THE).hits().join(_read(spark, sf, "labels"), "doc_id").select(
        "shard", "doc", "doc_id", "quality", "toxic", _score())


def q_i2_saved(spark, sf):
    return _two_generations(spark, sf).search(THE).hits().groupBy("lang").agg(
        F.count(F.lit(1)).alias("hits"), F.round(F.max("score"), 6).alias("max_score"))


def q_b1_repeated_id(spark, sf):
    """One query id with a text and a keyword lookup, one of them given twice."""
    lookups = spark.createDataFrame([(1, "text", "the"), (1, "lang", "fr"), (1, "lang", "fr"), (2, "text", "de")],
                                    "query_id int, field string, term string")
    return search_many(_two_generations(spark, sf), lookups).select("query_id", "shard", "doc", _score())


def q_b1_array_ints(spark, sf):
    """Lookups of a multi-valued int field: the parts of each order."""
    parts = _read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_linenumber").cast("int")).alias("lines"))
    idx = _by_key(parts, IndexSpec(numeric=["lines"], stored=["l_orderkey"]), "l_orderkey")
    lookups = spark.createDataFrame([(1, "lines", "7"), (2, "lines", "6"), (3, "lines", "99"), (4, "lines", "x")],
                                    "query_id int, field string, term string")
    return search_many(idx, lookups).select("query_id", "shard", "doc", _score())


def q_s5_snapshot(spark, sf):
    ensure_local_dirs(spark)
    t = _table("docs")
    first, second = _halves(spark, sf)
    save(_docs_index(spark, sf, first), t)
    before = open_index(spark, t)
    save(_docs_index(spark, sf, second), t, mode="append")
    return before.search(THE).hits().select("shard", "doc", "doc_id", _score())


def q_i1_hits_join_labels(spark, sf):
    hits = _docs_index(spark, sf).search(THE).hits()
    return hits.join(_read(spark, sf, "labels"), "doc_id").select(
        "shard", "doc", "doc_id", "quality", "toxic", _score())


def q_i2_hits_by_lang(spark, sf):
    hits = _docs_index(spark, sf).search(THE).hits()
    return hits.groupBy("lang").agg(F.count(F.lit(1)).alias("hits"), F.round(F.max("score"), 6).alias("max_score"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: BM25 top-10 per shard for the term 'the' over documents."""
    return q_r3_topk_per_shard(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
    if llm is not None:
        found |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return found


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

_D = r"""d AS (
  SELECT doc_id, lang, source, text, n_chars,
         CAST(doc_id % 3 AS INTEGER) AS shard,
         row_number() OVER (PARTITION BY doc_id % 3 ORDER BY doc_id) - 1 AS doc,
         regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS toks
  FROM documents {where}),
fs AS (SELECT shard, count(*) AS n, sum(len(toks)) AS sdl FROM d WHERE len(toks) > 0 GROUP BY shard)"""


def _docs_cte(where: str = "") -> str:
    return _D.replace("{where}", where)


def _text_leaf(name: str, word: str) -> str:
    return f"""{name}_m AS (SELECT shard, doc, len(list_filter(toks, lambda t: t = '{word}')) AS tf, len(toks) AS dl
  FROM d WHERE list_contains(toks, '{word}')),
{name}_q AS (SELECT shard, count(*) AS df FROM {name}_m GROUP BY shard),
{name} AS (SELECT m.shard, m.doc,
  ln(1 + (fs.n - q.df + 0.5) / (q.df + 0.5)) * (m.tf * 2.2 / (m.tf + 1.2 * (0.25 + 0.75 * m.dl / (fs.sdl / fs.n)))) AS s
  FROM {name}_m m JOIN {name}_q q USING (shard) JOIN fs USING (shard))"""


def _kw_leaf(name: str, col: str, value: str, src: str = "d") -> str:
    return f"""{name}_m AS (SELECT shard, doc FROM {src} WHERE {col} = '{value}'),
{name}_q AS (SELECT shard, count(*) AS df FROM {name}_m GROUP BY shard),
{name}_n AS (SELECT shard, count(*) AS n FROM {src} WHERE {col} IS NOT NULL GROUP BY shard),
{name} AS (SELECT m.shard, m.doc, ln(1 + (k.n - q.df + 0.5) / (q.df + 0.5)) AS s
  FROM {name}_m m JOIN {name}_q q USING (shard) JOIN {name}_n k USING (shard))"""


def _numbered(table: str, key: str, cols: str, name: str = "x") -> str:
    return (f"{name} AS (SELECT {cols}, CAST({key} % 3 AS INTEGER) AS shard, "
            f"row_number() OVER (PARTITION BY {key} % 3 ORDER BY {key}) - 1 AS doc FROM {table})")


def _single_text(word: str) -> str:
    """(shard, doc, doc_id, lang, source, s) of a text term."""
    return f"""WITH {_docs_cte()}, {_text_leaf('a', word)},
hits AS (SELECT d.shard, d.doc, d.doc_id, d.lang, d.source, a.s FROM d JOIN a USING (shard, doc))"""


_NESTED = f"""WITH {_docs_cte()}, {_text_leaf('a', 'the')}, {_kw_leaf('b', 'lang', 'de')}, {_kw_leaf('c', 'source', 'src3')},
hits AS (SELECT d.shard, d.doc, d.doc_id, a.s + (coalesce(b.s, 0) + coalesce(c.s, 0)) AS s
  FROM d JOIN a USING (shard, doc) LEFT JOIN b USING (shard, doc) LEFT JOIN c USING (shard, doc)
  WHERE b.s IS NOT NULL OR c.s IS NOT NULL)"""

_MUST_EN_THE = f"""WITH {_docs_cte()}, {_kw_leaf('b', 'lang', 'en')}, {_text_leaf('a', 'the')}
SELECT d.shard, d.doc, d.doc_id, round(b.s + a.s, 6) AS score
FROM d JOIN a USING (shard, doc) JOIN b USING (shard, doc)"""

_POSTINGS = """post AS (
  SELECT shard, doc, t AS term, count(*) AS tf, any_value(len(toks)) AS dl
  FROM (SELECT shard, doc, toks, unnest(toks) AS t FROM d) GROUP BY shard, doc, t)"""

_BATCH = f"""WITH {_docs_cte()}, {_POSTINGS},
lk AS (SELECT * FROM (VALUES {", ".join(f"({i + 1}, '{t}')" for i, t in enumerate(BATCH_TERMS))}) v(query_id, term)),
m AS (SELECT lk.query_id, post.* FROM post JOIN lk USING (term)),
q AS (SELECT query_id, shard, count(*) AS df FROM m GROUP BY query_id, shard),
hits AS (SELECT m.query_id, m.shard, m.doc,
  ln(1 + (fs.n - q.df + 0.5) / (q.df + 0.5)) * (m.tf * 2.2 / (m.tf + 1.2 * (0.25 + 0.75 * m.dl / (fs.sdl / fs.n)))) AS s
  FROM m JOIN q USING (query_id, shard) JOIN fs USING (shard))"""

_PART = _numbered("part", "p_partkey", "p_partkey, p_size, p_retailprice", "x")

_INT_LOOKUPS = ", ".join(f"({i + 1}, {v})" for i, v in enumerate(REF_INTS))
_BRAND_LOOKUPS = ", ".join(f"({101 + i}, 'Brand#{v}')" for i, v in enumerate(REF_INTS))
_BATCH_PART = f"""WITH {_numbered('part', 'p_partkey', 'p_partkey, p_size, p_brand', 'x')},
li AS (SELECT * FROM (VALUES {_INT_LOOKUPS}) v(query_id, val)),
ls AS (SELECT * FROM (VALUES {_BRAND_LOOKUPS}) v(query_id, term)),
bm AS (SELECT ls.query_id, x.shard, x.doc FROM x JOIN ls ON x.p_brand = ls.term),
bq AS (SELECT query_id, shard, count(*) AS df FROM bm GROUP BY query_id, shard),
bn AS (SELECT shard, count(*) AS n FROM x WHERE p_brand IS NOT NULL GROUP BY shard),
hits AS (
  SELECT li.query_id, x.shard, x.doc, 1.0::DOUBLE AS s FROM x JOIN li ON x.p_size = li.val
  UNION ALL
  SELECT bm.query_id, bm.shard, bm.doc, ln(1 + (bn.n - bq.df + 0.5) / (bq.df + 0.5)) AS s
  FROM bm JOIN bq USING (query_id, shard) JOIN bn USING (shard))"""

_BATCH_MIXED = f"""WITH {_docs_cte()}, {_text_leaf('a', 'the')}, {_kw_leaf('b', 'lang', 'fr')}, {_text_leaf('c', 'de')},
hits AS (SELECT 1 AS query_id, shard, doc, s FROM a UNION ALL SELECT 1, shard, doc, s FROM b UNION ALL SELECT 2, shard, doc, s FROM c)"""

# ids as the four generations were appended: first half odd and even, second half odd and even
_COMPACTED = """{the}, g AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id % 3
  ORDER BY doc_id >= (SELECT (max(doc_id) + 1) // 2 FROM documents), n_chars % 2 = 0, doc_id) - 1 AS place FROM documents)
SELECT hits.shard, g.place AS doc, hits.doc_id, round(s, 6) AS score FROM hits JOIN g USING (doc_id)"""
_FIRST = "doc_id < (SELECT (max(doc_id) + 1) // 2 FROM documents)"
_SECOND = "doc_id >= (SELECT (max(doc_id) + 1) // 2 FROM documents)"


def oracle_sql() -> dict[str, str]:
    the = _single_text("the")
    de = _single_text("de")
    o = {
        "p1_match_all": f"WITH {_PART} SELECT shard, doc, p_partkey, 1.0::DOUBLE AS score FROM x",
        "p13_default": f"WITH {_PART} SELECT shard, doc, p_partkey, 1.0::DOUBLE AS score FROM x",
        "p2_term_string": f"""WITH {_numbered('customer', 'c_custkey', 'c_custkey, c_mktsegment', 'x')},
{_kw_leaf('a', 'c_mktsegment', 'BUILDING', 'x')}
SELECT x.shard, x.doc, x.c_custkey, round(a.s, 6) AS score FROM x JOIN a USING (shard, doc)""",
        "p2_multivalued": """SELECT o_custkey FROM (SELECT o_custkey, list(o_orderpriority) AS p FROM orders GROUP BY o_custkey)
WHERE list_contains(p, '1-URGENT')""",
        "p3_term_int": f"WITH {_PART} SELECT shard, doc, p_partkey, 1.0::DOUBLE AS score FROM x WHERE p_size = 11",
        "p4_term_long": f"""WITH {_numbered('orders', 'o_orderkey', 'o_orderkey, o_custkey', 'x')}
SELECT shard, doc, o_orderkey, 1.0::DOUBLE AS score FROM x WHERE o_custkey = 0""",
        "p5_term_float": f"""WITH {_PART} SELECT shard, doc, p_partkey, 1.0::DOUBLE AS score FROM x
WHERE p_retailprice::FLOAT = 900.1::FLOAT""",
        "p6_term_double": f"WITH {_PART} SELECT shard, doc, p_partkey, 1.0::DOUBLE AS score FROM x WHERE p_retailprice = 900.1",
        "p7_term_text": f"{the} SELECT shard, doc, doc_id FROM hits",
        "p8_must": _MUST_EN_THE,
        "p11_chained": _MUST_EN_THE,
        "p9_should": f"""WITH {_docs_cte()}, {_kw_leaf('b', 'source', 'src1')}, {_text_leaf('a', 'de')}
SELECT d.shard, d.doc, d.doc_id, round(coalesce(b.s, 0) + coalesce(a.s, 0), 6) AS score
FROM d LEFT JOIN a USING (shard, doc) LEFT JOIN b USING (shard, doc) WHERE a.s IS NOT NULL OR b.s IS NOT NULL""",
        "p10_must_simplify": f"{the} SELECT shard, doc, doc_id, round(s, 6) AS score FROM hits",
        "p12_replace": f"{de} SELECT shard, doc, doc_id, round(s, 6) AS score FROM hits",
        "p14_nested": f"{_NESTED} SELECT shard, doc, doc_id FROM hits",
        "r1_bm25": f"{the} SELECT shard, doc, doc_id, round(s, 6) AS score FROM hits",
        "r1_bm25_bool": f"{_NESTED} SELECT shard, doc, doc_id, round(s, 6) AS score FROM hits",
        "r1_const": f"WITH {_PART} SELECT shard, doc, p_partkey, 1.0::DOUBLE AS score FROM x WHERE p_size = 11",
        "r2_rank": f"""{the} SELECT shard, doc, round(s, 6) AS score,
  row_number() OVER (PARTITION BY shard ORDER BY s DESC, doc) AS rank FROM hits""",
        "r3_topk_per_shard": f"""{the} SELECT shard, doc, doc_id, round(s, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY s DESC, doc) AS rank FROM hits) WHERE rank <= 10""",
        "r4_take": f"{the} SELECT shard, doc, doc_id, round(s, 6) AS score FROM hits ORDER BY shard, s DESC, doc LIMIT 10",
        "r5_topk_global": f"{the} SELECT shard, doc, doc_id, round(s, 6) AS score FROM hits ORDER BY s DESC, shard, doc LIMIT 10",
        "d1_project": f"{de} SELECT shard, doc, doc::VARCHAR || ' -> ' || source AS line FROM hits",
        "d2_doc_ids": f"{de} SELECT shard, doc FROM hits",
        "d3_field_names": f"""{de} SELECT shard, doc, 'doc_id' AS field FROM hits WHERE doc_id IS NOT NULL
UNION ALL SELECT shard, doc, 'lang' FROM hits WHERE lang IS NOT NULL
UNION ALL SELECT shard, doc, 'source' FROM hits WHERE source IS NOT NULL""",
        "d4_late_fetch": f"""{de} SELECT shard, doc, lang, source, round(s, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY s DESC, doc) AS rank FROM hits) WHERE rank <= 10""",
        "a1_count": f"{the} SELECT count(*) AS hits FROM hits",
        "a3_totals_per_shard": f"{the} SELECT shard, count(*) AS hits FROM hits GROUP BY shard",
        "a4_cached": f"{the} SELECT shard, doc, doc_id FROM hits",
        "b1_batch_terms": f"{_BATCH} SELECT query_id, shard, doc, round(s, 6) AS score FROM hits",
        "b1_batch_topk": f"""{_BATCH} SELECT query_id, shard, doc, round(s, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, shard ORDER BY s DESC, doc) AS rank FROM hits) WHERE rank <= 10""",
        "w1_save_open": f"WITH {_docs_cte()} SELECT shard, doc, doc_id, lang, source, n_chars FROM d",
        "w2_mapping": f"""WITH {_docs_cte()} SELECT shard, doc, doc_id, upper(lang) AS lang_code, n_chars FROM d""",
        "w3_shard_counts": f"WITH {_docs_cte()} SELECT shard, count(*) AS n_docs FROM d GROUP BY shard",
        "w4_doc_ids": f"WITH {_docs_cte()} SELECT doc_id, shard, doc FROM d",
        "w5a_append": f"WITH {_docs_cte()} SELECT shard, doc, doc_id FROM d",
        "w5b_overwrite": f"WITH {_docs_cte('WHERE ' + _SECOND)} SELECT shard, doc, doc_id FROM d",
        "w5a_stream_append": f"WITH {_docs_cte()} SELECT shard, doc, doc_id FROM d",
        "w6_row_count": "SELECT count(*) AS rows FROM lineitem",
        "w7_compact": _COMPACTED.replace("{the}", the),
        "w7_compact_parts": _COMPACTED.replace("{the}", the),
        "w7_merge_tiers": _COMPACTED.replace("{the}", the),
        "w8_postings": f"""WITH {_docs_cte()}, {_POSTINGS}
SELECT shard, doc, 'text' AS field, term, tf, dl FROM post
UNION ALL SELECT shard, doc, 'lang', lang, 1::BIGINT, NULL::BIGINT FROM d WHERE lang IS NOT NULL
UNION ALL SELECT shard, doc, 'source', source, 1::BIGINT, NULL::BIGINT FROM d WHERE source IS NOT NULL""",
        "w8_term_stats": f"""WITH {_docs_cte()}
SELECT shard, NULL::VARCHAR AS field, count(*) AS n_docs, NULL::BIGINT AS sum_dl FROM d GROUP BY shard
UNION ALL SELECT shard, 'text', count(*), sum(len(toks))::BIGINT FROM d WHERE len(toks) > 0 GROUP BY shard
UNION ALL SELECT shard, 'lang', count(*), NULL::BIGINT FROM d WHERE lang IS NOT NULL GROUP BY shard
UNION ALL SELECT shard, 'source', count(*), NULL::BIGINT FROM d WHERE source IS NOT NULL GROUP BY shard""",
        "s2_shards": f"WITH {_docs_cte()} SELECT shard, count(*) AS n_docs FROM d GROUP BY shard",
        "w8_doc_freq": f"""WITH {_docs_cte()}, {_POSTINGS}
SELECT shard, 'text' AS field, term, count(*) AS df FROM post GROUP BY shard, term
UNION ALL SELECT shard, 'lang', lang, count(*) FROM d WHERE lang IS NOT NULL GROUP BY shard, lang
UNION ALL SELECT shard, 'source', source, count(*) FROM d WHERE source IS NOT NULL GROUP BY shard, source""",
        "b1_batch_saved": f"""{_BATCH} SELECT query_id, shard, doc, round(s, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, shard ORDER BY s DESC, doc) AS rank FROM hits) WHERE rank <= 10""",
        "b1_batch_ints_strings": f"""{_BATCH_PART} SELECT query_id, shard, doc, round(s, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, shard ORDER BY s DESC, doc) AS rank FROM hits) WHERE rank <= 10""",
        "p3_term_int_saved": f"WITH {_PART} SELECT shard, doc, p_partkey, 1.0::DOUBLE AS score FROM x WHERE p_size = 11",
        "d4_late_fetch_saved": f"""{de} SELECT shard, doc, lang, source, round(s, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY s DESC, doc) AS rank FROM hits) WHERE rank <= 10""",
        "a1_count_saved": f"{the} SELECT count(*) AS hits FROM hits",
        "a3_totals_saved": f"""WITH {_docs_cte()} SELECT shard, count(*) AS hits FROM d WHERE lang = 'fr' GROUP BY shard""",
        "r5_topk_saved": f"{_NESTED} SELECT shard, doc, doc_id, round(s, 6) AS score FROM hits ORDER BY s DESC, shard, doc LIMIT 10",
        "s3_fields": "SELECT column_name AS field FROM (DESCRIBE documents) WHERE column_name IN ('doc_id', 'lang', 'source')",
        "w4_order_only": "SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids, 0::BIGINT AS not_dense, 0::BIGINT AS out_of_order FROM documents",
        "w4_shard_only": "SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids, 0::BIGINT AS not_dense FROM documents",
        "w3_default": "SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids, 0::BIGINT AS not_dense FROM documents",
        "b1_repeated_id": f"""{_BATCH_MIXED} SELECT query_id, shard, doc, round(s, 6) AS score FROM hits""",
        "b1_array_ints": """WITH o AS (SELECT l_orderkey, list(l_linenumber) AS lines FROM lineitem GROUP BY l_orderkey),
x AS (SELECT lines, CAST(l_orderkey % 3 AS INTEGER) AS shard, row_number() OVER (PARTITION BY l_orderkey % 3 ORDER BY l_orderkey) - 1 AS doc FROM o),
lk AS (SELECT * FROM (VALUES (1, 7), (2, 6), (3, 99)) v(query_id, val))
SELECT query_id, shard, doc, 1.0::DOUBLE AS score FROM x JOIN lk ON list_contains(lines, val)""",
        "s5_snapshot": f"""WITH {_docs_cte('WHERE ' + _FIRST)}, {_text_leaf('a', 'the')}
SELECT d.shard, d.doc, d.doc_id, round(a.s, 6) AS score FROM d JOIN a USING (shard, doc)""",
        "i1_hits_join_labels": f"""{the} SELECT hits.shard, hits.doc, hits.doc_id, labels.quality, labels.toxic,
  round(hits.s, 6) AS score FROM hits JOIN labels USING (doc_id)""",
        "i2_hits_by_lang": f"{the} SELECT lang, count(*) AS hits, round(max(s), 6) AS max_score FROM hits GROUP BY lang",
    }
    for key, same in {"p2_saved": "p2_term_string", "p4_saved": "p4_term_long", "p5_saved": "p5_term_float", "p6_saved": "p6_term_double",
                      "p8_saved": "p8_must", "p9_saved": "p9_should", "r2_saved": "r2_rank", "r4_saved": "r4_take", "d1_saved": "d1_project",
                      "d2_saved": "d2_doc_ids", "i1_saved": "i1_hits_join_labels", "i2_saved": "i2_hits_by_lang",
                      "w5a_two_streams": "w5a_append"}.items():
        o[key] = o[same]  # a saved index answers as one in memory
    if llm is not None:
        o |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            o["pipeline"] = corpus_pipeline.ORACLE_SQL
    return o
