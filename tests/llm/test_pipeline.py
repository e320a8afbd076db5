"""The pipeline's stages, alone and one after another, against brute force."""

import random
import zlib

import corpus_pipeline as c
import numpy as np
import public_tokenizers
import pytest
import test_decontamination as leaks
import test_ngram_join as near
import test_pii as pii
import test_quality as quality
from helpers import clashing, docs_of, words
from tokenizers import Tokenizer

from tessera.llm import queries
from tessera.llm.pii import LABELS
from tessera.llm.quality import LINE_DOCS, LINE_SHARE

PLAIN = Tokenizer.from_file(public_tokenizers.path(queries.VOCABULARY))
ITEMS = [" ".join(words(n, 700 + n)) for n in (12, 30)] + [None, ""]


def corpus():
    r = random.Random(6)
    texts = [None, "", " \n", "x", "é " * 30, " ".join(words(40, 1, 1 << 40)) + " mail a.b@c.org or +1 (555) 123-4567"]
    footer = "all rights reserved by the makers of these pages and others"
    for k in range(40):
        base = words(r.randrange(25, 80), 40 + k, 1 << 40)
        lines = [" ".join(base[i : i + 9]) for i in range(0, len(base), 9)]
        texts.append("\n".join([*lines, *([footer] if k % 2 else [])]))
        if k % 5 == 0:
            texts.append(texts[-1])
        if k % 7 == 0:
            texts.append(texts[-1] + f" tail{k}")
    texts += [" ".join(words(20, 900 + k, 1 << 40)) + f" {ITEMS[k % 2]} " + " ".join(words(20, 990 + k, 1 << 40)) for k in range(4)]
    texts += [" ".join(words(9000, 77, 1 << 40))]
    texts += [f"{pii.prose(600 + k)} Hotperson hot@spot.org" for k in range(5)]
    r.shuffle(texts)
    return texts, [r.choice(["s0", "s0", "s1", None]) for _ in texts]


def kept_rows(rows):
    """``(id, text, source)`` that the first three stages keep, and then without personal data."""
    want = quality.verdicts([t for _, t, _ in rows], [s for *_, s in rows], LINE_SHARE, LINE_DOCS)
    rows = [(i, text, s) for (i, _, s), (_, kept, text) in zip(rows, want) if kept]
    _, root = near.brute([t for _, t, _ in rows])
    rows = [x for k, x in enumerate(rows) if root[k] == k]
    held = {i for i, *_ in leaks.brute([t for _, t, _ in rows], ITEMS)}
    rows = [x for k, x in enumerate(rows) if k not in held]
    out = []
    for (i, t, s), terms in zip(rows, pii.disclosed([t for _, t, _ in rows])):
        new, at = "", 0
        for a, k, b in sorted(pii.brute(t) + terms):
            if a >= at:
                new += t[at:a] + LABELS[k]
            at = max(at, b)
        out.append((i, new + t[at:], s))
    return out


def folder(spark, path, docs):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(ITEMS)), "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_run_equals_brute_force(spark, tmp_path):
    texts, sources = corpus()
    rows = c.run(spark, folder(spark, tmp_path, docs_of(spark, texts, sources=sources))).collect()
    want = {}
    for i, t, _ in kept_rows(list(zip(range(len(texts)), texts, sources))):
        ids = np.array([*PLAIN.encode(t, add_special_tokens=False).ids, 1], "<u4")
        for k, a in enumerate(range(0, len(ids), 4096)):
            want[i, k] = len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())
    assert {(r.doc_id, r.piece): (r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in places.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 4096
    assert 20 < len(want) < len(texts)


@pytest.mark.parametrize("name,stage", c.STAGES[:-1])
def test_stages_keep_the_columns_of_documents(spark, tmp_path, name, stage):
    """Nulls in every column, repeated rows and ids, extra columns, an empty table."""
    t = " ".join(words(60, 5, 1 << 40))
    docs = docs_of(spark, [t, t, None, "", t + " more", " ".join(words(40, 9, 1 << 40))], [None, 3, 3, None, 3, 8], ["s", None, "s", None, "s", "s"])
    sf = folder(spark, tmp_path, docs)
    wide = clashing(docs)
    out = stage(spark, wide, sf)
    assert out.schema == wide.schema
    rows = out.collect()
    assert sum(r.text == t for r in rows) >= 1 and any(r.doc_id == 8 for r in rows)
    assert stage(spark, docs.limit(0), sf).collect() == []


def test_run_of_an_empty_table(spark, tmp_path):
    assert c.run(spark, folder(spark, tmp_path, docs_of(spark, []))).collect() == []
