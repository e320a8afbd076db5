import math
import random
import re

import pytest
from helpers import clashing, docs_of, lower_ascii, words

from tessera.llm import lexical as x

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(lower_ascii(text or ""))


def brute(texts, items, k=10):
    """``(item place, rank, doc place, score)``."""
    docs = [terms(t) for t in texts]
    n_docs, n_terms = sum(map(bool, docs)), sum(map(len, docs))
    df = {}
    for d in docs:
        for t in set(d):
            df[t] = df.get(t, 0) + 1
    out = []
    for i, item in enumerate(items):
        scored = []
        for j, d in enumerate(docs):
            if d:
                m = 25 + (75 * len(d) * n_docs) // n_terms
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) * ((10**9 * d.count(t)) // (1000 * d.count(t) + 8 * m))
                            for t in terms(item))
                scored.append((-score, j))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k]) if s < 0]
    return out


def corpus(seed):
    r = random.Random(seed)
    texts = [None, "", " -- \n", "a", "A", "é", "É é", "e-mail: A_b@c.d", "x" * 3000, "\x00nul\x00 it", "w1 " * 50]
    for k in range(150):
        n = r.choice([1, 5, 20, 20, 20, 60, 300])
        texts.append(" ".join(words(n, 100 * seed + k, 120)))
    texts += [texts[-1]] * 12 + [" ".join(words(9000, seed, 300))]
    r.shuffle(texts)
    items = [None, "", "--", "w1 W1 w2", "nothing here", texts[20], "é É a", " ".join(words(40, 7, 120)), "w5", " ".join(words(200, 8, 300)), "nul w3-w4"]
    return texts, items


def items_of(spark, items, ids=None):
    rows = [(i, t) for i, t in zip(range(len(items)) if ids is None else ids, items)]
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranks_equal_brute_force(spark, monkeypatch, seed):
    if seed == 2:
        monkeypatch.setattr(x, "BLOCK_DOCS", 3)
        monkeypatch.setattr(x, "PART_BYTES", 2000)
        monkeypatch.setattr(x, "_COLUMNS", 2)
    if seed == 3:
        monkeypatch.setattr(x, "BLOCK_BYTES", 500)
        monkeypatch.setattr(x, "ITEM_BLOCK", 3)
    texts, items = corpus(seed)
    index = x.build_index(clashing(docs_of(spark, texts)))
    got = sorted(map(tuple, x.search(index, clashing(items_of(spark, items))).collect()))
    assert got == sorted(brute(texts, items))
    got = sorted(map(tuple, x.search(index, items_of(spark, items), k=3).collect()))
    assert got == sorted(brute(texts, items, 3))


def test_index_holds_every_occurrence(spark):
    texts, _ = corpus(4)
    index = x.build_index(docs_of(spark, texts))
    rows = index.postings().collect()
    want = {}
    for j, t in enumerate(texts):
        d = terms(t)
        for w in set(d):
            want[w, j] = d.count(w)
    got = {(r.term, j): r.tf for r in rows for j in r.doc_ids}
    assert got == want and sum(len(r.doc_ids) for r in rows) == len(want)
    assert index.docs == sum(bool(terms(t)) for t in texts) and index.terms == sum(len(terms(t)) for t in texts)


def test_one_stratum_of_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(x, "BLOCK_DOCS", 50)
    monkeypatch.setattr(x, "PART_BYTES", 3000)
    texts = [" ".join(words(10, k, 60)) for k in range(400)] + [" ".join(words(30 + k, k, 60)) for k in range(200)]
    items = [" ".join(words(6, 900 + k, 60)) for k in range(5)]
    index = x.build_index(docs_of(spark, texts))
    assert index.blocks.count() > 8
    assert sorted(map(tuple, x.search(index, items_of(spark, items)).collect())) == sorted(brute(texts, items))


def test_few_blocks_are_visited_where_the_bound_tells(spark, monkeypatch):
    """Documents that cannot reach the floor are not scored."""
    monkeypatch.setattr(x, "BLOCK_DOCS", 20)
    rare = [f"rare{k}" for k in range(6)]
    texts = [" ".join(rare + words(5, k, 50)) for k in range(20)] + [" ".join(words(11 + k % 90, k, 50)) for k in range(900)]
    index = x.build_index(docs_of(spark, texts))
    queries = x.Queries([" ".join(rare) + " w1"])
    found = x.matching(index, queries)
    scorer = x.Scorer(queries, x.term_weights(found, queries, index.docs))
    first = x._first_blocks(found, scorer)
    assert 1 <= len(first) <= x.FIRST
    best = x._ranked(x._visit(found, scorer, __import__("numpy").zeros(1, "int64"), 10, first), 10).collect()
    assert {r.doc_id for r in best} <= set(range(20)) and len(best) == 10


def test_nulls_repeats_and_empty_tables(spark):
    t = " ".join(words(10, 1))
    docs = docs_of(spark, [t, t, t, None, "other words"], [None, 7, 7, 8, None])
    index = x.build_index(docs)
    rows = x.search(index, items_of(spark, [t, t, None], [None, 5, 6])).collect()
    assert sorted((str(r.item_id), r.rank, str(r.doc_id)) for r in rows) == sorted(
        (i, k, d) for i in ("None", "5") for k, d in ((1, "7"), (2, "7"), (3, "None")))
    assert x.search(index, items_of(spark, [])).collect() == []
    empty = x.build_index(docs_of(spark, [None, "--"]))
    assert empty.docs == 0 and x.search(empty, items_of(spark, [t])).collect() == [] and empty.postings().collect() == []
