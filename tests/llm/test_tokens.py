import zlib

import numpy as np
import pytest
import public_tokenizers
from helpers import clashing, docs_of, twins, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import queries, token_files, tokens

PATH = public_tokenizers.path(queries.VOCABULARY)
VOCABULARY = tokens.read_vocabulary(PATH)
PLAIN = Tokenizer.from_file(PATH)
ODD = ["", " ", "\n", "a\tb\r\nc", "it's 'S I'LL don't", "a, b. c! d; e: f? g,, h..", "É é ñ ß µ ª ÿ Ā ſ K İ ΑΣ", "e\u0301 \u0301x", "<|endoftext|> x<|startoftext|>y",
       "😀 12 3.4", "\u00a0\u2003x\u0085y", "foo\x1cbar", "ABC Abc abc,"]


def ids_of(text):
    return np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_pieces_are_exact_for_the_vocabulary():
    assert tokens.exact_pieces(VOCABULARY)
    assert not tokens.exact_pieces(tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.sampled_from(ODD)), max_size=5))
def test_ids_equal_whole_texts(texts):
    got = tokens.Encoder.of(VOCABULARY).encode(texts)
    assert got == [ids_of(x)[:-1].tobytes() for x in texts]


def test_little_memory_gives_the_same(monkeypatch):
    monkeypatch.setattr(tokens, "KEEP", 5)
    encoder = tokens.Encoder(VOCABULARY)
    texts = [" ".join(words(200, s)) for s in range(4)] + ODD
    for _ in range(2):
        assert encoder.encode(texts) == [ids_of(x)[:-1].tobytes() for x in texts]
    assert len(encoder.known) < 1000


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_words_that_polynomials_confuse(n):
    a, b = twins(n)
    texts = [a, b, f"x {a} y", f"x {b} y", a + "a", f"{a}\n{b}"]
    assert tokens.Encoder(VOCABULARY).encode(texts) == [ids_of(x)[:-1].tobytes() for x in texts]


@pytest.mark.parametrize("bits", [0, 2, 6])
def test_words_that_share_a_hash(monkeypatch, bits):
    """With a first hash of very few bits every run has words that share it."""
    strong = tokens.textops.word_hashes
    monkeypatch.setattr(tokens.textops, "word_hashes", lambda *a, seed=0, **k: strong(*a, seed=seed, **k) if seed else strong(*a, **k) % np.uint64(1 << bits))
    encoder = tokens.Encoder(VOCABULARY)
    for texts in (["one"], ["two", "one two"], [" ".join(words(50, 1)), *ODD], ["one", None]):
        assert encoder.encode(texts) == [ids_of(x)[:-1].tobytes() for x in texts]


def test_another_vocabulary_encodes_whole_texts():
    vocabulary = tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    plain = Tokenizer.from_str(vocabulary)
    got = tokens.Encoder(vocabulary).encode([*ODD, None])
    assert got == [np.array(plain.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for x in [*ODD, None]]


def corpus():
    texts = [None, *ODD, " ".join(words(30_000, 1)), *twins(), *(" ".join(words(40 + s, s)) for s in range(300))]
    ids = [x * 7 for x in range(len(texts))][::-1]
    return texts + [texts[20]], ids + [ids[20]]


def test_round_trip(spark, monkeypatch):
    texts, ids = corpus()
    monkeypatch.setattr(token_files, "RANGE_DOCS", 50)
    monkeypatch.setattr(token_files, "BLOCK_DOCS", 7)
    store = token_files.write_tokens(clashing(docs_of(spark, texts, ids)), PATH)
    name, content = store.dictionary(spark)
    assert content and name == token_files.hash_of(content)
    rows = sorted(token_files.read_tokens(spark, store).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(ids)
    before = 0
    want = {i: ids_of(t) for i, t in zip(ids, texts)}
    for r in rows:
        assert r.start == before and r.n_tokens == len(want[r.doc_id]) and bytes(r.ids) == want[r.doc_id].tobytes()
        before += r.n_tokens
    blocks = store.blocks(spark).orderBy("part", "block").collect()
    assert [i for b in blocks for i in b.doc_ids] == sorted(ids) and max(len(b.doc_ids) for b in blocks) <= 7
    for i in (ids[0], ids[20], ids[-5]):
        found = token_files.read_document(spark, store, i)
        assert len(found) == ids.count(i) and all((x == want[i]).all() for x in found)
    assert token_files.read_document(spark, store, -1) == []


def test_null_ids_and_few_documents(spark):
    store = token_files.write_tokens(docs_of(spark, ["b", None, "a"], [None, 5, None]), PATH)
    rows = token_files.read_tokens(spark, store).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 5] and rows[2].n_tokens == 1 and rows[2].start == 4
    store = token_files.write_tokens(docs_of(spark, []), PATH)
    assert token_files.read_tokens(spark, store).count() == 0


@pytest.mark.parametrize("hot", [None, 5])
def test_one_id_of_a_third_of_all_rows(spark, monkeypatch, hot):
    """Its rows fill several ranges, still side by side and in order."""
    monkeypatch.setattr(token_files, "RANGE_DOCS", 20)
    ids = [hot] * 100 + [k for k in range(100, 300)]
    texts = [f"text {k} of many" for k in range(len(ids))]
    store = token_files.write_tokens(docs_of(spark, texts, ids), PATH)
    rows = token_files.read_tokens(spark, store).orderBy("start").collect()
    assert [r.doc_id for r in rows] == ids
    assert sorted(bytes(r.ids) for r in rows) == sorted(ids_of(t).tobytes() for t in texts)
    before = 0
    for r in rows:
        assert r.start == before
        before += r.n_tokens
    blocks = store.blocks(spark).collect()
    assert len({b.part for b in blocks if hot in b.doc_ids}) > 2
    assert max(len([i for b in blocks if b.part == p for i in b.doc_ids]) for p in {b.part for b in blocks}) <= 60


def test_a_block_of_another_dictionary_is_refused(spark):
    store = token_files.write_tokens(docs_of(spark, [" ".join(words(50, s)) for s in range(200)]), PATH)
    wrong = token_files.TokenStore(store.path + "-wrong")
    store.blocks(spark).withColumn("dictionary", F.lit("other")).write.parquet(f"{wrong.path}/blocks")
    spark.read.parquet(f"{store.path}/dictionary").write.parquet(f"{wrong.path}/dictionary")
    with pytest.raises(Exception, match="needs dictionary"):
        token_files.read_tokens(spark, wrong).collect()


def test_checksum_of_the_query(spark, tmp_path):
    texts, ids = corpus()
    docs_of(spark, texts, ids).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op3_token_files(spark, str(tmp_path)).collect():
        assert r.ids_crc32 == zlib.crc32(ids_of(texts[ids.index(r.doc_id)]).tobytes())
