import random

import pytest
from helpers import clashing, docs_of, words
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import decontamination as d


def part_distance(item, text):
    """Least edit distance of item to any part of text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=90), st.lists(st.integers(0, 4), max_size=60))
def test_myers_equals_the_full_table(item, text):
    assert d.best_match(item, text)[0] == part_distance(item, text)


def brute(texts, items):
    out = set()
    for i, t in enumerate(texts):
        for k, x in enumerate(items):
            x, w = d.words_of(x), d.words_of(t)
            if x and part_distance(x, w) <= d.budget(len(x)):
                out.add((i, k, part_distance(x, w)))
    return out


def corpus():
    r = random.Random(3)
    items = [" ".join(words(n, 100 + n)) for n in (3, 4, 9, 15, 40, 59, 70)] + [None, "", " .,- "]
    texts = [None, "", "...", " ".join(words(50, 1))]
    for seed in range(40):
        passage = (items[seed % 7]).split()
        for _ in range(r.randrange(0, max(2, len(passage) // 3))):
            at = r.randrange(len(passage) + 1)
            kind = r.randrange(3)
            if kind == 0:
                passage.insert(at, f"new{r.random()}")
            elif kind == 1 and at < len(passage):
                passage[at] = "other"
            elif at < len(passage) and len(passage) > 1:
                del passage[at]
        texts.append(" ".join(words(30, seed) + [w.upper() + "," for w in passage] + words(30, seed + 7)))
    texts.append(" ".join(words(20_000, 9)) + " " + items[4] + " " + items[4])  # long, twice
    return texts + texts[-2:], items


def test_leaks_equal_brute_force(spark):
    texts, items = corpus()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = [(r.doc_id, r.item_id, r.distance) for r in d.leaks(clashing(docs_of(spark, texts)), bench).collect()]
    want = brute(texts, items)
    assert len(got) == len(set(got)) and set(got) == want
    kept = {r.doc_id for r in d.without_leaks(docs_of(spark, texts), bench).collect()}
    assert kept == set(range(len(texts))) - {i for i, _, _ in want}


def test_blocks_of_items_and_columns(spark, monkeypatch):
    texts, items = corpus()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    whole = sorted(map(tuple, d.leaks(docs_of(spark, texts), bench).collect()))
    monkeypatch.setattr(d, "BLOCK_ITEMS", 3)
    assert sorted(map(tuple, d.leaks(docs_of(spark, texts), bench).collect())) == whole
    docs = clashing(docs_of(spark, texts[:6]))
    assert d.without_leaks(docs, bench).schema == docs.schema


@pytest.mark.parametrize("none", ["docs", "items"])
def test_empty(spark, none):
    docs = docs_of(spark, [] if none == "docs" else ["a b c"], [] if none == "docs" else [None])
    bench = spark.createDataFrame([] if none == "items" else [(1, "a b c")], "item_id bigint, text string")
    assert d.leaks(docs, bench).count() == 0
    assert d.without_leaks(docs, bench).count() == docs.count()


def test_repeated_items_are_matched_once_and_reported_each(spark, monkeypatch):
    """An item of most rows is one item of its block."""
    monkeypatch.setattr(d, "BLOCK_ITEMS", 2)
    asked = []
    monkeypatch.setattr(d, "_in_block", lambda docs, items, f=d._in_block: asked.append(len(items)) or f(docs, items))
    item, other = " ".join(words(20, 1)), " ".join(words(20, 2))
    items = spark.createDataFrame([(1, item)] * 50 + [(2, other), (None, item), (1, other)], "item_id bigint, text string")
    docs = docs_of(spark, [f"x {item} y", other, "none", f"x {item} y"], [0, 1, 2, 0])
    rows = d.leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id or 0) for r in rows) == sorted([(0, 1)] * 100 + [(0, 0)] * 2 + [(1, 2), (1, 1)])
    assert sum(asked) == 4
    assert [r.doc_id for r in d.without_leaks(docs, items).collect()] == [2]
