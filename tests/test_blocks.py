"""Postings kept in blocks: fewer rows to shuffle, sort and write, the same postings."""

import uuid

import pytest
from pyspark.sql import functions as F

from tessera import IndexSpec, build_index, compact, open_index, save, should, table_path, term
from tessera.operators import blocks, build
from tessera.operators.build import index_rows

SPEC = IndexSpec(text=["body", "notes"], keyword=["tag", "tags"], numeric=["n"], stored=["id"])
SCHEMA = "id long, body string, notes array<string>, tag string, tags array<string>, n int"
DATA = [(k, [f"The the w{k % 7} ÉTÉ {'x ' * (k % 5)}", "", None, "..."][0 if k % 6 else k % 4], [f"a w{k % 3}", None] if k % 5 else None,
         ["u", "v", None][k % 3], ["p", None, "p", "q"] if k % 4 else [], k) for k in range(120)]


def _index(spark, data=DATA):
    df = spark.createDataFrame(data, SCHEMA)
    return build_index(df, SPEC, shard_by=F.pmod("id", F.lit(2)), num_shards=2, order_by=["id"], num_partitions=2)


def _rows(df):
    return sorted((tuple(r) for r in df.select("shard", "doc", "field", "term", "tf", "dl").collect()), key=str)


def _hits(idx):
    q = should(term("body", "the"), term("notes", "a"), term("tags", "p"))
    return sorted((r.shard, r.doc, r.id, round(r.score, 9)) for r in idx.search(q).hits().collect())


@pytest.mark.parametrize("tokens", [blocks.BLOCK_TOKENS, 1])
def test_blocks_hold_the_postings_and_norms_of_rows(spark, monkeypatch, tokens):
    monkeypatch.setattr(blocks, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(blocks, "BATCH_POSTINGS", 7)
    monkeypatch.setattr(build, "DOCS_PER_RANGE", 10)
    docs = _index(spark).docs.cache()
    made = blocks.index_blocks(docs, SPEC).cache()
    assert _rows(blocks.posting_rows(made)) == _rows(index_rows(docs, SPEC, norms=True))
    for r in made.collect():
        assert r.docs == sorted(set(r.docs)) and (r.doc, r.n) == (r.docs[0], len(r.docs))
        assert r.docs[0] // 10 == r.docs[-1] // 10  # one range
        assert r.tf == (None if r.term is None else max(r.tfs)) and r.dl == (None if None in r.dls else min(r.dls))


def test_saved_postings_are_fewer_rows_and_merge_as_blocks(spark):
    t = f"t_{uuid.uuid4().hex[:8]}"
    save(_index(spark, DATA[:60]), t)
    save(_index(spark, DATA[60:]), t, mode="append")
    path, memory = table_path(spark, t), _index(spark)
    stored = spark.read.parquet(f"{path}/postings")
    assert _rows(open_index(spark, t).postings) == _rows(memory.postings)
    # a task's documents of a term are one row, not one each
    assert stored.where("field = 'body' and term = 'the'").count() < memory.postings.where("field = 'body' and term = 'the'").count() / 4
    assert _hits(open_index(spark, t)) == _hits(memory)
    # a generation of a table written before there were blocks
    flat = blocks.posting_rows(spark.read.schema(f"{blocks.BLOCK_SCHEMA}, bucket int").parquet(f"{path}/postings/gen=0")).localCheckpoint()
    flat.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings/gen=0")
    assert _hits(open_index(spark, t)) == _hits(memory)
    merged = compact(spark, t)
    assert len(merged.generations) == 1
    assert _rows(merged.postings) == _rows(memory.postings) and _hits(merged) == _hits(memory)
    norms = spark.read.schema(f"{blocks.BLOCK_SCHEMA}, bucket int").parquet(f"{path}/postings/gen={merged.generations[0]}").where("bucket = -1")
    want = index_rows(memory.docs, SPEC, norms=True).where("term is null")
    assert _rows(blocks.posting_rows(norms)) == _rows(want)


@pytest.mark.parametrize("docs", [blocks.BLOCK_DOCS, 1])
def test_stored_rows_hold_one_number_per_posting(spark, monkeypatch, docs):
    """Several postings of a term are one array of numbers, a single one none; terms come in order from each task."""
    monkeypatch.setattr(blocks, "BLOCK_DOCS", docs)
    index = _index(spark)
    stored = blocks.stored_blocks(index.docs, SPEC).withColumn("task", F.spark_partition_id()).collect()
    assert {len(r.entries) if r.entries is not None else 1 for r in stored} == {r.n for r in stored}
    assert all((r.entries is None) == (r.n == 1) for r in stored)
    assert any(r.n > 10 for r in stored)
    for task in {r.task for r in stored}:
        terms = [r.term for r in stored if r.task == task and r.field == "body" and r.term is not None]
        assert terms == sorted(terms, key=str.encode) or docs == 1


def test_batches_of_a_block_are_gathered_together(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        docs = _index(spark).docs.coalesce(1)
        made = blocks.stored_blocks(docs, SPEC).where("field = 'body' and term = 'the'").collect()
        assert sorted(r.shard for r in made) == [0, 1]
        assert _rows(blocks.posting_rows(blocks.index_blocks(docs, SPEC))) == _rows(index_rows(docs, SPEC, norms=True))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_great_counts_and_earlier_generations(spark):
    """A tf beyond an entry's bits, and generations stored as three arrays, keep their postings; merges do too."""
    most = 1 << blocks.TF_BITS
    data = [(k, "z " * (most + k - 2) if k < 4 else "z y", None, "t", None, k) for k in range(8)]
    t = f"t_{uuid.uuid4().hex[:8]}"
    save(_index(spark, data[:4]), t)
    save(_index(spark, data[4:]), t, mode="append")
    path, want = table_path(spark, t), _rows(_index(spark, data).postings)
    assert max(r[4] for r in want) == most + 1 and _rows(open_index(spark, t).postings) == want
    stored = spark.read.schema(f"{blocks.BLOCK_SCHEMA}, bucket int").parquet(f"{path}/postings/gen=1")
    arrays = blocks.as_blocks(stored).localCheckpoint()
    assert set(arrays.columns) >= {"docs", "tfs", "dls"} and "entries" not in arrays.columns
    arrays.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings/gen=1")
    assert _rows(open_index(spark, t).postings) == want
    df = {r[0]: r[1] for r in open_index(spark, t).terms.where("field = 'body'").groupBy("term").agg(F.sum("df")).collect()}
    assert df == {"z": 8, "y": 4}
    merged = compact(spark, t)
    assert _rows(merged.postings) == want
    assert sorted((r.shard, r.field or "", r.n_docs, r.sum_dl or 0) for r in merged.stats.collect()) == sorted(
        (r.shard, r.field or "", r.n_docs, r.sum_dl or 0) for r in _index(spark, data).stats.collect())
