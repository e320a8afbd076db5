import random
import zlib

import pytest
from helpers import clashing, docs_of, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import toxicity as t


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for k, y in enumerate(b, 1):
            new.append(min(row[k - 1] + (x != y), row[k] + 1, new[k - 1] + 1))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text("abc", min_size=1, max_size=8), st.floats(1, 5), max_size=8),
       st.dictionaries(st.text("abc", min_size=4, max_size=6), st.floats(1, 5), max_size=4), st.lists(st.text("abcd", max_size=9), max_size=12))
def test_automaton_equals_all_distances(terms, stems, asked):
    a = t.Automaton(terms, stems)
    for word in asked + asked + list(terms):
        exact = max([terms.get(word, 0.0), *(w for s, w in stems.items() if word.startswith(s))])
        near = 0.0 if exact else max((w for x, w in terms.items() if len(x) >= t.FUZZY and distance(word, x) == 1), default=0.0)
        assert a.match(word) == (exact, near)


def test_little_memory_gives_the_same(monkeypatch):
    monkeypatch.setattr(t, "REMEMBER", 3)
    a = t.Automaton({"abcde": 2.0, "bad": 1.0}, {"stem": 3.0})
    for _ in range(2):
        assert [a.match(w) for w in ("abcde", "abxde", "abcd", "zabcde", "bad", "bat", "stemming", "ste", "")] == [
            (2.0, 0.0), (0.0, 2.0), (0.0, 2.0), (0.0, 2.0), (1.0, 0.0), (0.0, 0.0), (3.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_context_separates_quotation():
    a = t.Automaton({"moron": 4.0}, {})
    plain, quoted = t.features("he is a moron here", a), t.features('the word "moron" is old', a)
    said = t.features("they said moron once", a)
    direct = t.features("you moron", a)
    assert plain[0] > 0 and plain[4] == 0 and quoted[0] == 0 and quoted[4] > 0 and said[4] > 0
    assert direct[5] > 0 and plain[5] == 0
    assert t.features("what a m0ron", a)[0] == 0 and t.features("what a morron", a)[3] > 0
    assert t.features(None, a) == t.features("", a) == t.features("123", a) == [0.0] * 7


def corpus(n=700):
    r = random.Random(7)
    bad = ["grumblat", "snorfide", "vexalor"]
    texts, toxic = [], []
    for k in range(n):
        w = ["".join(chr(97 + int(c, 16)) for c in x[1:]) for x in words(60, k)]
        y = int(k % 7 == 0)
        if y:
            for _ in range(4):
                w.insert(r.randrange(len(w)), r.choice(bad))
        texts.append(" ".join(w))
        toxic.append(y)
    return texts, toxic


def test_held_out_accuracy_and_misspellings(spark):
    texts, toxic = corpus()
    more = [None, "", "...", "plain words only", "a grumbblat and a snorfde and a vexalorr"]
    docs = clashing(docs_of(spark, texts + more))
    labels = spark.createDataFrame([(i, 1, y, "x") for i, y in enumerate(toxic)] + [(3, 1, toxic[3], "x"), (None, 1, 1, "x"), (5, 1, None, "x"), (10**9, 1, 1, "x")],
                                   "doc_id bigint, quality int, toxic int, text string")
    rows = {r.doc_id: r for r in t.toxicity(docs, labels).collect()}
    assert len(rows) == len(texts) + len(more) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    held = [i for i in range(len(texts)) if rows[i].held_out]
    assert 0.1 < len(held) / len(texts) < 0.3
    assert sum(rows[i].predicted == toxic[i] for i in held) / len(held) > 0.98
    assert rows[len(texts)].score == rows[len(texts) + 1].score < 0.5
    assert rows[len(texts) + 4].score > rows[len(texts) + 3].score


def test_held_out_rule(spark):
    rows = spark.range(300).select("id", t.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_labels_never_change_scores_of_held_out_rows(spark):
    texts, toxic = corpus(300)
    docs = docs_of(spark, texts)
    flipped = [1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y for i, y in enumerate(toxic)]
    kind = "doc_id bigint, toxic int"
    a = t.toxicity(docs, spark.createDataFrame(list(enumerate(toxic)), kind)).orderBy("doc_id").collect()
    b = t.toxicity(docs, spark.createDataFrame(list(enumerate(flipped)), kind)).orderBy("doc_id").collect()
    assert a == b


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1), (2, 1)]])
def test_without_both_kinds_of_labels(spark, labels):
    rows = t.toxicity(docs_of(spark, ["a", None, "b"]), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    assert [r.score for r in rows] == [0.0] * 3
    assert t.toxicity(docs_of(spark, []), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect() == []


def test_rows_that_repeat_an_id_are_one_sample(spark):
    """A labelled id of most rows brings one text."""
    texts = ["first text"] * 300 + ["second text"] * 200 + [f"text {k}" for k in range(20)]
    ids = [1] * 500 + list(range(2, 22))
    labels = spark.createDataFrame([(k, 0, k % 2) for k in range(22)] + [(1, 0, 1)] * 3, "doc_id bigint, quality int, toxic int")
    rows = t.training_rows(docs_of(spark, texts, ids), labels).collect()
    kept = [k for k in range(1, 22) if zlib.crc32(str(k).encode()) % 5]
    assert len(rows) == len(kept) and sum(r.text in ("first text", "second text") for r in rows) == (1 in kept)
