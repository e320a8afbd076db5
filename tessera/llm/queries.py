"""Registered queries of the operators, with their parameters, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, filter_audit, lexical, ngram_join, packing, pii, quality, secrets, sharding, simhash, token_files, toxicity, url_filter

VOCABULARY = "word_bpe_49k.json"
END_ID, CAPACITY = 1, 4096
# The rules of the url query.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark, sf):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(_read(spark, sf, "pages"), rules)


def op2_benchmark_decontamination(spark, sf):
    return decontamination.leaks(_read(spark, sf, "documents"), _read(spark, sf, "benchmark"))


def op3_token_files(spark, sf):
    store = token_files.write_tokens(_read(spark, sf, "documents"), public_tokenizers.path(VOCABULARY), END_ID)
    return token_files.read_tokens(spark, store).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_best_fit_packing(spark, sf):
    return pack_documents(_read(spark, sf, "documents"))


def pack_documents(docs: DataFrame) -> DataFrame:
    """Placement of every piece, with a checksum in place of its ids."""
    pieces = packing.token_pieces(docs, public_tokenizers.path(VOCABULARY), CAPACITY, END_ID)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), CAPACITY)


def op5_hash_tree_shards(spark, sf):
    placed = sharding.shard_documents(_read(spark, sf, "documents"), sharding.topology(8), sharding.topology(9))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op6_ngram_jaccard_join(spark, sf):
    return ngram_join.near_duplicates(_read(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_toxicity(spark, sf):
    return toxicity.toxicity(_read(spark, sf, "documents"), _read(spark, sf, "labels"))


def op8_secret_scan(spark, sf):
    found = secrets.find_secrets(_read(spark, sf, "documents"))
    counts = [secrets.count_of(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(secrets.KINDS[:3])]
    return found.select("doc_id", *counts, *_digests(secrets.KINDS))


def op9_personal_data(spark, sf):
    found = pii.find_personal(_read(spark, sf, "documents"))
    counts = [secrets.count_of(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS[:4])]
    return found.select("doc_id", *counts, *_digests(pii.KINDS))


def _digests(kinds: list[str]):
    return (F.sha2(secrets.joined(F.col("base"), kinds), 256).alias("base_sha256"), secrets.joined(F.col("spans"), kinds).alias("spans"))


def op10_quality_rules(spark, sf):
    return quality.judge(_read(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_filter_audit(spark, sf):
    return filter_audit.audit(spark, f"{sf}/documents.parquet", _read(spark, sf, "labels")).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op12_ranked_search(spark, sf):
    return lexical.search(lexical.build_index(_read(spark, sf, "documents")), _read(spark, sf, "benchmark"))


def op13_simhash_near_dedup(spark, sf):
    return simhash.near_duplicates(_read(spark, sf, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}


_URL_SQL = """WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r(rhost, rpath, rverdict) AS (VALUES {rules}),
m AS (SELECT page_id, host, path, max_by(rhost || rpath, (length(rhost) + length(rpath)) * 10000 + length(rhost)) AS rule,
  max_by(rverdict, (length(rhost) + length(rpath)) * 10000 + length(rhost)) AS rverdict
  FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM m"""

_AUDIT_SQL = """WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
f AS (SELECT doc_id, part, CAST(len(ws) < 50 AS INTEGER) + 2 * CAST(100 * len(list_distinct(ws)) < 65 * len(ws) AS INTEGER)
  + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) AS INTEGER) + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
  + 16 * CAST(doc_id > min(doc_id) OVER (PARTITION BY t) AS INTEGER) AS mask FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS docs, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
x(filter_order, step, own, gone) AS (VALUES {steps})
SELECT part, filter_order, step, CAST(coalesce(sum(docs) FILTER (mask & (gone | own) = 0), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(docs) FILTER (mask & gone = 0 AND mask & own <> 0), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(docs) FILTER (mask & gone <> 0 AND mask & own <> 0), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(docs) FILTER (mask = own), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(good) FILTER (mask & gone = 0 AND mask & own <> 0), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(toxic) FILTER (mask & gone = 0 AND mask & own <> 0), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(docs * (120 // greatest(bit_count(mask), 1))) FILTER (mask & own <> 0), 0) AS BIGINT) AS shapley
FROM c, x GROUP BY part, filter_order, step"""

_SEARCH_SQL = """WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{term}') AS t FROM documents),
c AS (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM d WHERE len(t) > 0),
m AS (SELECT doc_id, 25 + (75 * len(t) * docs) // terms AS m FROM d, c WHERE len(t) > 0),
i AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{term}')) AS term FROM benchmark),
q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY item_id, term),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term, docs),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""


def _audit_steps():
    """``(order, step, bit of its filter, bits of the filters before)``."""
    for order in permutations("ABCDE"):
        bits = [1 << "ABCDE".index(f) for f in order]
        yield from (("".join(order), k + 1, bits[k], sum(bits[:k])) for k in range(5))


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": _URL_SQL.replace("{rules}", ", ".join(map(str, URL_RULES))),
            "op11_filter_audit": _AUDIT_SQL.replace("{steps}", ", ".join(map(str, _audit_steps()))),
            "op12_ranked_search": _SEARCH_SQL.replace("{term}", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")}
