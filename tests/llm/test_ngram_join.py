import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import WORD, clashing, docs_of, lower_ascii, twins, words

from tessera.llm import ngram_join as j
from tessera.llm import textops
from tessera.llm.components import components


def shingles(text):
    w = WORD.findall(lower_ascii(text or ""))
    if len(w) >= 5:
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)] if w else [])


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def brute(texts):
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return [len(x) for x in sets], roots(len(sets), links)


def edited(base, edits, r):
    out = list(base)
    for _ in range(edits):
        out[r.randrange(len(out))] = f"n{r.random()}"
    return out


def corpus(seed):
    """Near copies (also of near copies), exact copies, a passage many share, short and awkward texts."""
    r = random.Random(seed)
    passage = words(60, 999)
    texts = [None, "", " \t\n", "a", "A", "a b", "a b c d", "A B c d", "a b c d e", "a b c d e f", "é ü ß x y z", "a b c d e f", "same same same same same same"]
    for k in range(12):
        base = words(r.randrange(6, 250), 1000 * seed + k)
        texts += [" ".join(base)] * r.randrange(1, 4)
        near = base
        for _ in range(r.randrange(6)):
            near = edited(near if r.random() < 0.5 else base, r.randrange(1, 2 + len(base) // 30), r)
            texts.append("\n".join(near) if r.random() < 0.3 else "  ".join(near).title())
    hub = words(150, seed + 77)
    texts += [" ".join(edited(hub, r.randrange(0, 9), r)) for _ in range(90)] + [" ".join(hub)] * 5
    texts += [" ".join(words(r.randrange(20, 120), 5000 + seed * 100 + k) + passage) for k in range(60)]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_all_pairs(spark, monkeypatch, seed):
    if seed == 2:
        monkeypatch.setattr(j, "HOT_IN_BATCH", 3)  # most shared shingles are hot
    if seed == 3:
        monkeypatch.setattr(j, "LOW", 0.1)
        monkeypatch.setattr(j, "CUT", np.uint64(int(0.1 * (1 << 64))))
    texts = corpus(seed)
    sizes, want = brute(texts)
    rows = j.near_duplicates(clashing(docs_of(spark, texts))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_shingles, r.component_id) == (sizes[r.doc_id], want[r.doc_id]), texts[r.doc_id]
    docs = docs_of(spark, texts)
    kept = j.first_of_each(docs)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {k for k, x in enumerate(want) if x == k}


def test_links_only_through_others(spark):
    """A chain: neighbours are linked, ends are not."""
    base = words(200, 5)
    texts = [" ".join(base[10 * k : 10 * k + 120]) for k in range(8)]
    sizes, want = brute(texts)
    assert set(want) == {0}
    assert {r.component_id for r in j.near_duplicates(docs_of(spark, texts)).collect()} == {0}


def test_the_bound_itself(spark):
    """Similarity of exactly 3/4, and just below."""
    base = words(400, 8, 10**9)
    texts = [" ".join(base[:67]), " ".join([*base[:58], *base[100:109]])]  # 63 shingles each, 54 shared of 72
    a, b = shingles(texts[0]), shingles(texts[1])
    assert 100 * len(a & b) == 75 * len(a | b)
    texts += [" ".join(base[200:267]), " ".join([*base[200:257], *base[300:310]])]
    got = {r.doc_id: r.component_id for r in j.near_duplicates(docs_of(spark, texts)).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3}


def test_null_and_repeated_ids(spark):
    t = " ".join(words(30, 1))
    docs = docs_of(spark, [t, t, t, None, "", t + " more", " ".join(words(40, 2))], [None, 7, 7, None, 9, 3, None])
    rows = sorted((str(r.doc_id), str(r.component_id), r.n_shingles) for r in j.near_duplicates(docs).collect())
    assert rows == sorted([("None", "3", 26), ("7", "3", 26), ("7", "3", 26), ("None", "None", 0), ("9", "9", 0), ("3", "3", 27), ("None", "None", 36)])
    assert sorted(str(r.doc_id) for r in j.first_of_each(docs).collect()) == ["3", "9", "None", "None"]


def test_words_that_polynomials_confuse(spark):
    a, b = twins()
    texts = [a, b, f"{a} x", f"{b} x", " ".join([a] * 7), " ".join([b] * 7)]
    assert [r.component_id for r in sorted(j.near_duplicates(docs_of(spark, texts)).collect())] == list(range(6))


def test_empty(spark):
    assert j.near_duplicates(docs_of(spark, [])).collect() == []
    assert j.near_duplicates(docs_of(spark, [None, ""])).count() == 2


def test_components_of_paths_stars_and_rings(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(100, 160)] + [(300 + i, 300 + (i + 1) % 40) for i in range(40)]
    links += [(r.randrange(400, 500), r.randrange(400, 500)) for _ in range(60)]
    r.shuffle(links)
    want = roots(500, links)
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {x: want[x] for pair in links if pair[0] != pair[1] for x in pair}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def test_sets_of_awkward_texts():
    texts = ["", None, "x", "a b c d e", "A B C D E", "a  b\tc\nd e f " * 3, "é " * 10, " ".join(words(5000, 4)), "z" * 5000 + " b c d e f", " lead trail "]
    many = texts * 40
    found = {}
    for first, hashes, bounds in textops.shingle_sets(pa.array(many, pa.string())):
        for i in range(len(bounds) - 1):
            found[first + i] = hashes[bounds[i] : bounds[i + 1]]
    assert len(found) == len(many)
    for i, t in enumerate(many):
        assert len(found[i]) == len(shingles(t)) and (np.diff(found[i].astype(object)) > 0).all()
    assert found[3].tolist() == found[4].tolist() and found[3].tolist() != found[2].tolist()
    sliced = pa.array(["junk", *texts], pa.string()).slice(1)
    for _, hashes, bounds in textops.shingle_sets(sliced):
        assert [len(shingles(t)) for t in texts] == np.diff(bounds).tolist()
