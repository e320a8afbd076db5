"""Searches planned with the term dictionary: the rarest clause first, ranges by their bounds, first shards only."""

import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from tessera import IndexSpec, Must, Should, build_index, match_all, must, open_index, save, should, term
from tessera.operators import build, search

SPEC = IndexSpec(text=["body"], keyword=["tag"], numeric=["n"], stored=["id"])
WORDS = ["the"] * 12 + ["of"] * 6 + ["and"] * 3 + [f"w{k}" for k in range(30)]


def rows(n=600):
    r = random.Random(3)
    return [(k, " ".join(r.choice(WORDS) for _ in range(r.randrange(1, 30))) + (" rare" if k % 60 == 7 else ""),
             r.choice(["x", "x", "y", None]), k % 50) for k in range(n)]


def made(spark, data):
    df = spark.createDataFrame(data, "id long, body string, tag string, n int")
    return build_index(df, SPEC, shard_by=F.pmod("id", F.lit(4)), num_shards=4, order_by=["id"])


@pytest.fixture(scope="module")
def pair(spark):
    """An index in memory, and the same saved in two generations, in ranges of 10 documents."""
    old, build.DOCS_PER_RANGE = build.DOCS_PER_RANGE, 10
    try:
        data, t = rows(), f"t_{uuid.uuid4().hex[:8]}"
        save(made(spark, data[:350]), t)
        save(made(spark, data[350:]), t, mode="append")
        yield made(spark, data), open_index(spark, t)
    finally:
        build.DOCS_PER_RANGE = old


def tree(r, depth=3):
    x = r.random()
    if depth == 0 or x < 0.4:
        return r.choice([term("body", r.choice(["the", "of", "and", "w3", "w9", "rare", "none"])), term("tag", r.choice(["x", "y"])),
                         term("n", r.randrange(60)), match_all(), term("body", "rare")])
    return (Must if x < 0.75 else Should)(*[tree(r, depth - 1) for _ in range(r.randrange(1, 4))])


def got(df):
    return [(r["shard"], r["doc"], round(r["score"], 9)) for r in df.collect()]


def test_random_trees_narrowed_and_not(pair, monkeypatch):
    """A saved index that filters every clause it can equals one in memory, which never does."""
    memory, saved = pair
    monkeypatch.setattr(search, "NARROW_GAIN", 0)
    r, filtered = random.Random(8), 0
    for _ in range(10):
        q = Must(tree(r, 2), tree(r, 2))
        leaves = search._classify(saved, q.leaves())
        filtered += bool(saved.search(q)._narrowed(leaves))
        assert sorted(got(saved.search(q).scored())) == sorted(got(memory.search(q).scored())), str(q)
        assert saved.search(q).count() == memory.search(q).count()
    assert filtered >= 2


def test_only_generations_that_hold_a_term_are_opened(spark, monkeypatch):
    """Three appends, one with the word: its postings and no others are scanned, and hits are those of all generations."""
    monkeypatch.setattr(search, "LEAST_GENERATIONS", 3)
    data, t = rows(60), f"t_{uuid.uuid4().hex[:8]}"
    data = [(k, body.replace(" rare", "") + (" rare" if k in (31, 35) else ""), tag, n) for k, body, tag, n in data]
    for k in range(0, 60, 20):
        save(made(spark, data[k:k + 20]), t, mode="append")
    memory, saved = made(spark, data), open_index(spark, t)
    assert len(saved.generations) == 3
    rare = term("body", "rare")
    plan = saved.search(rare).scored()._jdf.queryExecution().optimizedPlan().toString()
    assert saved.known_sizes["body", "rare"] == (2, (1,))
    assert len(re.findall(r"gen#\d+ (?:=|IN) \(?1\b", plan)) >= 2, plan  # postings and dictionary
    r = random.Random(5)
    for q in [rare, term("body", "none"), term("body", "the"), must(term("body", "the"), rare), should(rare, term("tag", "y")), tree(r), tree(r), tree(r)]:
        assert sorted(got(saved.search(q).scored())) == sorted(got(memory.search(q).scored())), str(q)
        assert saved.search(q).count() == memory.search(q).count()


def exchanged(df):
    """Rows written to shuffles when ``df`` runs."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_shuffled_rows_are_near_the_rarest_clause(pair):
    memory, saved = pair
    q = must(term("body", "the"), term("body", "rare"))
    everything = memory.search(q)
    rare, the = saved.search(term("body", "rare")).count(), saved.search(term("body", "the")).count()
    assert rare == 10 and the > 400
    plan = saved.search(q)
    moved = exchanged(plan._plan(False)[0])
    assert moved <= 6 * rare, moved  # both clauses' rows of the rare documents, and the counts of each
    assert exchanged(everything._plan(False)[0]) > the / 2
    assert sorted(got(plan.scored())) == sorted(got(everything.scored()))
    nested = must(term("body", "the"), should(term("body", "of"), term("tag", "x")), should(term("body", "rare"), term("body", "none")))
    assert sorted(got(saved.search(nested).scored())) == sorted(got(memory.search(nested).scored()))


@pytest.fixture
def ranges(pair, monkeypatch):
    monkeypatch.setattr(search, "LEAST_RANGES", 1)
    return pair


def test_bounds_are_never_exceeded(ranges):
    memory, saved = ranges
    r = random.Random(5)
    for _ in range(8):
        q = tree(r)
        if saved.search(q)._by_ranges() is None:
            continue
        bounds = {(x.shard, x.doc_range): x.bound for x in saved.search(q).range_bounds().collect()}
        for shard, doc, score in got(memory.search(q).scored()):
            assert score <= bounds[shard, doc // 10] + 1e-9, str(q)


def test_topk_with_bounds_equals_topk_without(ranges):
    memory, saved = ranges
    r, less = random.Random(11), 0
    for i in range(7):
        q = tree(r) if i else term("body", "the")
        k = r.choice([1, 3, 10])
        assert got(saved.search(q).top_k(k, fetch=False)) == got(memory.search(q).top_k(k, fetch=False)), (k, str(q))
        mine = saved.search(q).top_k_per_shard(k, fetch=False).orderBy("shard", "rank")
        assert got(mine) == got(memory.search(q).top_k_per_shard(k, fetch=False).orderBy("shard", "rank")), (k, str(q))
        only = saved.search(q)._bounded(k, False)._only
        less += only is not None and len(only) < saved.search(q).range_bounds().count()
    assert less >= 1


def test_ranges_are_pushed_to_the_postings(ranges):
    _, saved = ranges
    q = should(term("body", "rare"), term("body", "the"))
    saved.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = saved.search(q).top_k(3, fetch=False)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan" in x and "/postings/" in x)
    assert "GreaterThanOrEqual(doc," in scan and "EqualTo(shard," in scan


def test_many_runs_of_ranges_are_joined(ranges, monkeypatch):
    memory, saved = ranges
    monkeypatch.setattr(search, "MOST_RUNS", 1)
    q = should(term("body", "w3"), term("body", "rare"))
    assert got(saved.search(q).top_k(5, fetch=False)) == got(memory.search(q).top_k(5, fetch=False))
    monkeypatch.setattr(search, "MOST_RANGES", 3)
    assert saved.search(q)._bounded(5, False)._only is None  # too many for the driver: read all


def test_take_reads_the_first_shards_only(ranges):
    memory, saved = ranges
    r = random.Random(4)
    for i in range(5):
        q = tree(r) if i else term("body", "the")
        for n in (1, 200):
            assert got(saved.search(q).take(n, fetch=False)) == got(memory.search(q).take(n, fetch=False)), (n, str(q))
    s = saved.search(term("body", "the"))
    assert s._first_shards(10)._shards_to == 0 and s._first_shards(10**6) is s
    plan = s.take(10, fetch=False)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"LessThanOrEqual\(shard,0\)", plan)
    both = must(term("body", "the"), term("tag", "y"))  # their counts may overlap in little: the bound is not tight
    assert got(saved.search(both).take(10, fetch=False)) == got(memory.search(both).take(10, fetch=False))


def test_few_hits_are_fetched_without_moving_documents(ranges):
    memory, saved = ranges
    q = must(term("body", "the"), term("body", "rare"))
    hits = saved.search(q).hits()
    plan = hits._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan" in x and "/docs/" in x)
    assert "dynamicpruning" in scan
    assert re.search(r"BroadcastHashJoin \[shard#\d+, doc_range#", plan) and not re.search(r"SortMergeJoin \[shard#\d+, doc_range#", plan)
    want = sorted((r["shard"], r["doc"], r["id"]) for r in memory.search(q).hits().collect())
    assert sorted((r["shard"], r["doc"], r["id"]) for r in hits.collect()) == want
