import numpy as np
import public_tokenizers
import pytest
from helpers import clashing, docs_of, twins, words
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing, queries

PATH = public_tokenizers.path(queries.VOCABULARY)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_best_fit_equals_a_search_of_all_bins(sizes):
    bins, offsets, fill = packing.best_fit(np.array(sizes, np.int64), 30)
    rooms, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [r for r in rooms if r >= sizes[i]]
        if fits:
            rooms[rooms.index(min(fits))] -= sizes[i]
        else:
            rooms.append(30 - sizes[i])
    assert sorted(30 - f for f in fill.tolist()) == sorted(rooms)
    for i, (b, o) in enumerate(zip(bins.tolist(), offsets.tolist())):
        want.setdefault(b, []).append((o, sizes[i]))
    for parts in want.values():
        at = 0
        for o, s in sorted(parts):
            assert o == at
            at += s
        assert at <= 30


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("shape", ["mixed", "equal", "small", "over half"])
def test_many_groups_and_rounds(spark, monkeypatch, shape):
    monkeypatch.setattr(packing, "GROUP_ITEMS", 200)
    monkeypatch.setattr(packing, "CARRY", 8)
    r = np.random.default_rng(1)
    sizes = {"mixed": r.integers(1, 101, 3000), "equal": np.full(900, 40), "small": r.integers(1, 4, 900), "over half": r.integers(51, 101, 900)}[shape]
    items = spark.createDataFrame([(i, int(s), "x") for i, s in enumerate(sizes)], "item bigint, length bigint, offset string")
    rows = packing.pack(items, 100).collect()
    assert sorted((x.item, x.length) for x in rows) == list(enumerate(sizes.tolist()))
    used, least = check(rows, 100), -(-int(sizes.sum()) // 100)
    alone = len(packing.best_fit(sizes.astype(np.int64), 100)[2])  # one task, all items
    assert least <= used <= alone * 1.03 + 1


def test_documents(spark):
    texts = [None, "", "a", " ".join(words(9000, 1)), *twins(), *(" ".join(words(50 + 7 * s, s)) for s in range(60))]
    texts.append(texts[5])
    plain = Tokenizer.from_file(PATH)
    pieces = packing.token_pieces(clashing(docs_of(spark, texts, [*range(len(texts) - 2), None, 5])), PATH, 512)
    rows = packing.pack(pieces, 512).collect()
    check(rows, 512)
    ids = [*range(len(texts) - 2), None, 5]
    found = {}
    for r in rows:
        assert r.length == len(r.ids) // 4 and r.start == 512 * r.piece
        found.setdefault(r.doc_id, []).append((r.piece, bytes(r.ids)))
    for i, text in zip(ids, texts):
        want = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        cut = [(k, want[a : a + 2048]) for k, a in enumerate(range(0, len(want), 2048))]
        if ids.count(i) == 1:
            assert sorted(found[i]) == cut
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packing.pack(pieces, 512)).collect()}
    assert all(len(x) <= 2048 for x in whole.values())
    assert sum(map(len, whole.values())) == sum(4 * r.length for r in rows)


def test_empty_and_wrong_lengths(spark):
    items = spark.createDataFrame([], "item bigint, length bigint")
    assert packing.pack(items, 100).collect() == []
    for bad in (None, 0, 101):
        with pytest.raises(Exception, match="length"):
            packing.pack(spark.createDataFrame([(1, bad)], "item bigint, length bigint"), 100).collect()
