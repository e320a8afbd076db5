"""Plan shapes: pushdown, bucket pruning, partial top-k, late fetch."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tessera import IndexSpec, build_index, must, open_index, save, should, term

SPEC = IndexSpec(text=["text"], keyword=["lang", "source"], numeric=["n_chars"], stored=["doc_id", "lang", "source"])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def saved(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    t = "plans_" + uuid.uuid4().hex[:8]
    save(build_index(d, SPEC, shard_by=F.pmod("doc_id", F.lit(3)), num_shards=3, order_by=["doc_id"]), t)
    return open_index(spark, t)


def test_term_prunes_bucket_and_pushes_term(saved):
    p = plan(saved.search(term("text", "the")).scored())
    assert "PartitionFilters: [isnotnull(bucket" in p and "(bucket#" in p
    assert "EqualTo(term,the)" in p


def test_topk_per_shard_is_partial(saved):
    p = plan(saved.search(term("text", "the")).top_k_per_shard(10, fetch=False))
    assert p.count("WindowGroupLimit") >= 1


def test_late_fetch_prunes_directories_at_run_time(saved):
    s = saved.search(term("text", "the"))
    for df in (s.top_k_per_shard(10), s.top_k(10), s.take(10)):
        scan = next(x for x in plan(df).split("\n") if "FileScan" in x and "/docs/" in x)
        assert "dynamicpruning" in scan and "doc_range" in scan


def test_lazy(spark, saved):
    """No job runs before an action."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-test", "no action yet")
    try:
        s = saved.search(must(term("text", "the"), term("n_chars", 1172)))
        s.top_k(5), s.take(5), s.top_k_per_shard(5), s.hits(), s.count_frame(), s.totals_per_shard()
        assert list(tracker.getJobIdsForGroup("lazy-test")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_global_topk_takes_ordered(saved):
    p = plan(saved.search(term("text", "the")).top_k(10, fetch=False))
    assert "TakeOrderedAndProject" in p


def test_numeric_term_reads_points(saved):
    p = plan(saved.search(term("n_chars", 1172)).scored())
    assert "EqualTo(value,1172)" in p and "/points/n_chars/" in p and "/docs/" not in p


def test_single_term_has_no_doc_shuffle(saved):
    single = plan(saved.search(term("text", "the")).scored())
    assert not re.search(r"hashpartitioning\(shard#\d+, doc#\d+", single)
    tree = plan(saved.search(must(term("text", "the"), term("lang", "en"))).scored())
    assert re.search(r"hashpartitioning\(shard#\d+, doc#\d+", tree)


def test_bool_tree_scans_postings_once_per_role(saved):
    q = must(term("text", "the"), should(term("lang", "de"), term("source", "src3")))
    p = plan(saved.search(q).count_frame())
    # counting needs no statistics: stats are never read
    assert "/stats/" not in p


def test_saved_search_reads_postings_once(saved):
    # Document frequencies come from the term dictionary, not a second scan.
    p = plan(saved.search(must(term("text", "the"), term("lang", "en"))).scored())
    assert len(re.findall(r"FileScan parquet [^\n]*/postings/", p)) == 1
    assert len(re.findall(r"FileScan parquet [^\n]*/terms/", p)) == 1


def test_saved_term_count_reads_dictionary_only(saved):
    for q in (term("text", "the"), term("lang", "fr"), term("text", "zzzzqq")):
        p = plan(saved.search(q).count_frame()) + plan(saved.search(q).totals_per_shard())
        assert "/postings/" not in p and "/terms/" in p
        s = saved.search(q)
        assert s.count() == s._plan(False)[0].count()
        want = {tuple(r) for r in s._plan(False)[0].groupBy("shard").count().collect()}
        assert {tuple(r) for r in s.totals_per_shard().collect()} == want
