import random

import numpy as np
import pytest
import xxhash
from helpers import WORD, clashing, docs_of, lower_ascii, words

from tessera.llm import simhash as s


def fingerprint(text):
    w = WORD.findall(lower_ascii(text or ""))
    runs = [w[i : i + 3] for i in range(len(w) - 2)] if len(w) >= 3 else [w] if w else []
    h = [xxhash.xxh64_intdigest(" ".join(x).encode(), seed=42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(prints, ids, radius=3):
    """Least id reachable, by all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for k in range(len(prints)):
        groups.setdefault(find(k), []).append(ids[k])
    least = {r: min((x for x in g if x is not None), default=None) for r, g in groups.items()}
    return [least[find(k)] for k in range(len(prints))]


def corpus(seed):
    r = random.Random(seed)
    texts = [None, "", " \t\n", "a", "A", "a b", "A  b", "a b c", "é ü ß", "same same same same", "x\x1cy z w", "nul\x00 in it"]
    for k in range(14):
        base = words(r.randrange(3, 400), 100 * seed + k)
        texts += [" ".join(base)] * r.randrange(1, 4)
        for _ in range(r.randrange(8)):
            near = list(base)
            for _ in range(1 + len(near) // 150):
                near[r.randrange(len(near))] = f"n{r.random()}"
            texts.append(("\n" if r.random() < 0.3 else "  ").join(near).title())
    texts.append(" ".join(words(30_000, seed)))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_fingerprints_and_components_equal_all_pairs(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(s, "_STEP", 100)  # a text takes many steps
        monkeypatch.setattr(s, "HOT_ROWS", 2)
    texts = corpus(seed)
    prints = [fingerprint(t) for t in texts]
    want = components(prints, list(range(len(texts))))
    rows = s.near_duplicates(clashing(docs_of(spark, texts))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", want[r.doc_id]), texts[r.doc_id]
    assert len(set(want)) < len(set(prints))  # some are linked that are not equal


def near_prints(seed, n):
    """Random fingerprints, chains and stars of a few changed bits, and pairs just past the radius."""
    r = random.Random(seed)
    out = []
    while len(out) < n:
        x = r.getrandbits(64)
        out.append(x)
        for _ in range(r.randrange(5)):
            y = x
            for b in r.sample(range(64), r.randrange(1, 6)):
                y ^= 1 << b
            out.append(y)
            if r.random() < 0.5:
                x = y
    return list(dict.fromkeys(out))[:n]


def parts_of(prints, root):
    return components(prints, list(range(len(prints)))), root


@pytest.mark.parametrize("block", [8192, 7])
def test_links_connect_all_within_the_radius(spark, block, monkeypatch):
    """Also with buckets that are cut into many blocks."""
    monkeypatch.setattr(s, "BLOCK", block)
    hub = random.Random(9).getrandbits(64)
    prints = near_prints(3, 400) + [hub ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)][:300] + [0, 1, (1 << 64) - 1]
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    links = s.linked(spark.createDataFrame([(x,) for x in signed], "fingerprint bigint")).collect()
    at = {x: k for k, x in enumerate(signed)}
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in links:
        a, b = find(at[u]), find(at[v])
        root[max(a, b)] = min(a, b)
    assert [find(k) for k in range(len(prints))] == components(prints, list(range(len(prints))))
    assert len(links) <= len(prints) * len(s.part_masks()) * 60


def test_cells_of_many_sizes_equal_all_pairs():
    r = random.Random(5)
    cells = [near_prints(k, n) for k, n in enumerate([1, 2, 3, 1, 64, 65, 700, 1, 1500, 40])]
    prints = np.array([x for c in cells for x in c], np.uint64)
    cell = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    block = np.array([r.randrange(2) for _ in prints])
    within = cell % 2 == 0
    root = s.joined_rows(prints, cell, block, within)
    at = 0
    for k, c in enumerate(cells):
        links = [(a, b) for a in range(len(c)) for b in range(a) if (c[a] ^ c[b]).bit_count() <= 3 and (within[at] or block[at + a] != block[at + b])]
        mine = list(range(len(c)))

        def find(x):
            while mine[x] != x:
                x = mine[x]
            return x

        for a, b in links:
            mine[max(find(a), find(b))] = min(find(a), find(b))
        got = root[at : at + len(c)] - at
        assert (got >= 0).all() and (got < len(c)).all()
        assert {frozenset(np.flatnonzero(got == x).tolist()) for x in set(got.tolist())} == {
            frozenset(x for x in range(len(c)) if find(x) == y) for y in {find(x) for x in range(len(c))}}, k
        at += len(c)


def test_one_fingerprint_of_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(s, "HOT_ROWS", 100)
    texts = [" ".join(words(20, 1))] * 300 + [" ".join(words(20, 10 + k, 1 << 40)) for k in range(50)] + [None] * 150
    got = {r.doc_id: r.component_id for r in s.near_duplicates(docs_of(spark, texts)).collect()}
    assert got == dict(enumerate(components([fingerprint(t) for t in texts], list(range(len(texts))))))


def test_null_and_repeated_ids_and_empty_tables(spark):
    t, other = " ".join(words(30, 1)), " ".join(words(40, 2))
    docs = docs_of(spark, [t, t, t, None, "", other], [None, 7, 7, None, 9, None])
    rows = sorted((str(r.doc_id), str(r.component_id)) for r in s.near_duplicates(docs).collect())
    assert rows == sorted([("None", "7"), ("7", "7"), ("7", "7"), ("None", "9"), ("9", "9"), ("None", "None")])
    assert s.near_duplicates(docs_of(spark, [])).collect() == []


def test_fixed_digest():
    """XXH64 with seed 42 of a known text."""
    assert s.shingle_hashes(b"A b\x0bc") == [xxhash.xxh64_intdigest(b"a b c", seed=42)]
    assert s.shingle_hashes(None) == [] and s.shingle_hashes(b"x") == [xxhash.xxh64_intdigest(b"x", seed=42)]
