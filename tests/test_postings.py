"""Postings, norms and stats of awkward texts == brute force in Python."""

from collections import Counter

import regex
from pyspark.sql import functions as F

from tessera import IndexSpec, build_index, open_index, save
from tessera.operators.build import index_rows, stats_from_norms

TEXTS = [
    "  ...leading and trailing separators!! ",
    "",
    None,
    "Ünïcode ÜNÏCODE straße 東京 東京 ２０２６ x1 X1",
    "a a a a b a",
    "--",
    "one",
    "Mixed-CASE mixed_case 3.14 3,14",
]
MULTI = [["b a", "A"], [], None, ["", None, "x y x"], ["z"], None, ["q"], ["Q q"]]
KEYS = [["k1", "k1", None], [], None, ["k2"], ["k1", "k3"], [None], ["k3"], ["k2", "k2"]]


def _tokens(s):
    return regex.findall(r"[\p{L}\p{N}]+", s.lower()) if s is not None else None


def _frame(spark):
    rows = [(i, t, m, k) for i, (t, m, k) in enumerate(zip(TEXTS, MULTI, KEYS))]
    return spark.createDataFrame(rows, "id long, body string, parts array<string>, tags array<string>")


SPEC = IndexSpec(text=["body", "parts"], keyword=["tags"], stored=["id"])


def _expected():
    post, norms = Counter(), Counter()
    for i, (t, m, k) in enumerate(zip(TEXTS, MULTI, KEYS)):
        shard = i % 2
        doc = i // 2
        norms[(shard, doc, None, None, None, None)] += 1
        fields = {
            "body": _tokens(t) or [],
            "parts": [tok for v in (m or []) if v is not None for tok in _tokens(v)],
        }
        for name, toks in fields.items():
            if toks:
                norms[(shard, doc, name, None, None, len(toks))] += 1
            for term, tf in Counter(toks).items():
                post[(shard, doc, name, term, tf, len(toks))] += 1
        vals = {v for v in (k or []) if v is not None}
        if vals:
            norms[(shard, doc, "tags", None, None, None)] += 1
        for v in vals:
            post[(shard, doc, "tags", v, 1, None)] += 1
    return post, norms


def _index(spark):
    return build_index(_frame(spark), SPEC, shard_by=F.pmod("id", F.lit(2)), num_shards=2, order_by=["id"])


def _rows(df):
    return Counter(tuple(r) for r in df.select("shard", "doc", "field", "term", "tf", "dl").collect())


def test_postings_and_norms_match_brute_force(spark):
    idx = _index(spark)
    post, norms = _expected()
    assert _rows(idx.postings) == post
    assert _rows(index_rows(idx.docs, SPEC, norms=True)) == post + norms


def test_stats_from_norms_equal_stats_of_docs(spark):
    idx = _index(spark)
    rows = index_rows(idx.docs, SPEC, norms=True).where(F.col("term").isNull())
    a = {tuple(r) for r in stats_from_norms(rows).select("shard", "field", "n_docs", "sum_dl").collect()}
    b = {tuple(r) for r in idx.stats.select("shard", "field", "n_docs", "sum_dl").collect()}
    assert a == b


def test_saved_postings_hide_norms(spark):
    idx = _index(spark)
    save(idx, "awkward")
    opened = open_index(spark, "awkward")
    post, _ = _expected()
    assert _rows(opened.postings) == post
    a = {tuple(r) for r in opened.stats.select("shard", "field", "n_docs", "sum_dl").collect()}
    b = {tuple(r) for r in idx.stats.select("shard", "field", "n_docs", "sum_dl").collect()}
    assert a == b


def test_split_tokens_equal_regex_extraction(spark):
    # The tokenizer splits on separator runs; it must give exactly the
    # maximal runs of letters and digits, on every document.
    from tessera import TOKEN_PATTERN, tokens

    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(
        "text", F.regexp_extract_all(F.lower("text"), F.lit(TOKEN_PATTERN), 0).alias("want"))
    assert d.where(~F.coalesce(tokens("text") == F.col("want"), F.lit(False))).count() == 0
    awkward = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "text string")
    got = [r[0] for r in awkward.select(tokens("text")).collect()]
    assert got == [_tokens(t) for t in TEXTS if t is not None]
