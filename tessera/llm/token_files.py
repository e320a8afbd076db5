"""Token-id files: one shared zstandard dictionary, every document a frame of its own.

A store is a Parquet dataset of *blocks* in ascending document order, and a
small dataset holding the dictionary.  A block has the compressed id arrays of
up to ``BLOCK_DOCS`` consecutive documents end to end (``payload``), the place
and length of each (``offsets``), their ids and token counts, and the hash of
the dictionary they need.  One document is read by pruning blocks on
``first_doc``/``last_doc`` and decompressing its own few bytes.

Writing is two passes over the documents (the dictionary's examples, then
all): the texts are encoded where they lie, and only compressed ids are
shuffled into order.  Cut points between ranges come from ``doc_id`` alone, so
every row's range is fixed by its id.  Spark writes the files, so a lost
executor's part is written again.

Defined cases: a null text has no ids but the end id; a null ``doc_id`` sorts
first; rows of one ``doc_id`` are kept side by side, over several ranges where
they are many; very long texts are a block of their own; other columns are
ignored, whatever their names; an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.broadcast import checked_broadcast
from .shared import arrow_tasks, shared_dir, tidy
from .tokens import ROWS, Encoder, read_vocabulary

EXAMPLES = 1000  # documents the dictionary is trained on, at most
EXAMPLE_CHARS = 65_536  # a document longer than this is no example (a dictionary serves short ones)
DICTIONARY_BYTES = 112_640
RANGE_DOCS, MOST_RANGES = 20_000, 20_000  # documents in a range of the sort, and ranges (beyond, they grow and spill)
_UNNAMED = -(1 << 63)  # a null ``doc_id`` among the others
BLOCK_DOCS, BLOCK_BYTES = 1024, 1 << 20

_BLOCKS = ("part int, block int, before bigint, first_doc bigint, last_doc bigint, dictionary string, doc_ids array<bigint>, "
           "n_tokens array<bigint>, offsets array<bigint>, payload binary")


@dataclass(frozen=True)
class TokenStore:
    """Where a store lies: ``blocks`` and ``dictionary`` below ``path``."""

    path: str

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_BLOCKS).parquet(f"{self.path}/blocks")

    def dictionary(self, spark: SparkSession) -> tuple[str, bytes]:
        row = spark.read.schema("dictionary string, content binary").parquet(f"{self.path}/dictionary").first()
        return row[0], bytes(row[1])


def hash_of(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()[:32]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from serialized id arrays; empty where they are too few to train one."""
    samples = [x for x in samples if len(x) >= 8]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _zstd(content: bytes):
    return zstandard.ZstdCompressionDict(content) if content else None


def _examples(docs: DataFrame, n: int, encode, most: int) -> list[bytes]:
    """Id arrays of about ``most`` documents, picked by a hash of their id and text."""
    short = docs.where(F.length("text").between(1, EXAMPLE_CHARS))
    share = int(min(1.0, most / max(n, 1)) * (1 << 40))
    picked = short.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) < share).limit(most)
    return encode([r[0] for r in picked.select("text").collect()])


def write_tokens(docs: DataFrame, vocabulary_path: str, end_id: int = 1, path: str | None = None,
                 examples: int = EXAMPLES) -> TokenStore:
    """Encode every whole text of ``docs(doc_id, text)`` and write a store."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/llm-tokens-{uuid.uuid4().hex}"
    docs = arrow_tasks(docs).select(F.col("doc_id").cast("bigint"), "text")
    vocabulary, tail = read_vocabulary(vocabulary_path), np.array([end_id], "<u4").tobytes()
    n = docs.count()
    content = train_dictionary([x + tail for x in _examples(docs, n, Encoder.of(vocabulary).encode, examples)])
    name = hash_of(content)
    spark.createDataFrame([(name, bytearray(content))], "dictionary string, content binary").write.parquet(f"{path}/dictionary")

    parts = max(1, -(-n // RANGE_DOCS))
    parts = min(parts, MOST_RANGES)
    named = docs.select(F.coalesce("doc_id", F.lit(_UNNAMED)).alias("doc_id"))
    cuts = named.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 1 / (4 * parts)) if parts > 1 else []
    cuts = np.sort(np.array(cuts, np.float64)).astype(np.int64)

    def encode(batches):
        encoder, packer = Encoder.of(vocabulary), zstandard.ZstdCompressor(level=3, dict_data=_zstd(content))
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                own, texts = batch.column(0).slice(first, ROWS), batch.column(1).slice(first, ROWS)
                raw = [x + tail for x in encoder.encode(texts)]
                known = own.fill_null(_UNNAMED).to_numpy(zero_copy_only=False)
                part, last = np.searchsorted(cuts, known, "left"), np.searchsorted(cuts, known, "right")
                for k in np.flatnonzero(last > part):  # an id that is itself a cut, once or often: its rows fill all ranges it touches
                    part[k] += zlib.crc32(raw[k]) % (last[k] - part[k] + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), own, pa.array([len(x) // 4 for x in raw], pa.int64()),
                     pa.array([packer.compress(x) for x in raw], pa.binary())],
                    ["part", "doc_id", "n_tokens", "frame"])

    def block(rows):
        """One row of ``_BLOCKS`` from documents of one range in order."""
        part, number, before, ids, counts, frames = rows
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in frames])]).astype(np.int64)
        real = [x for x in ids if x is not None]
        return pa.RecordBatch.from_pylist([{
            "part": part, "block": number, "before": before, "first_doc": real[0] if real else None, "last_doc": real[-1] if real else None,
            "dictionary": name, "doc_ids": ids, "n_tokens": counts, "offsets": offsets.tolist(), "payload": b"".join(frames)}],
            schema=pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64()),
                              ("dictionary", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
                              ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())]))

    def assemble(batches):
        part, number, before, ids, counts, frames, size = None, 0, 0, [], [], [], 0
        for batch in batches:
            for p, d, c, x in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if ids and (p != part or len(ids) >= BLOCK_DOCS or size + len(x) > BLOCK_BYTES):
                    yield block((part, number, before, ids, counts, frames))
                    number, before, ids, counts, frames, size = number + 1, before + sum(counts), [], [], [], 0
                if p != part:
                    part, number, before = p, 0, 0
                ids.append(d), counts.append(c), frames.append(x)
                size += len(x)
        if ids:
            yield block((part, number, before, ids, counts, frames))

    frames = docs.mapInArrow(tidy(encode), "part int, doc_id bigint, n_tokens bigint, frame binary")
    (frames.repartitionById(parts, "part").sortWithinPartitions("part", "doc_id", "n_tokens", "frame")
     .mapInArrow(tidy(assemble), _BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks"))
    return TokenStore(path)


def read_tokens(spark: SparkSession, store: TokenStore) -> DataFrame:
    """Every document of a store: ``doc_id, start, n_tokens, ids`` (``start``: ids of all documents before it)."""
    name, content = store.dictionary(spark)
    blocks = arrow_tasks(store.blocks(spark))
    # the ranges are few (documents / RANGE_DOCS); inside a range a block knows how many ids are before it
    last = F.struct("block", (F.col("before") + F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("t"))
    ranges = blocks.groupBy("part").agg(F.max(last)["t"].alias("t")).select(
        "part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("base"))
    ranges, _ = checked_broadcast(ranges)

    def decode(batches):
        unpacker = zstandard.ZstdDecompressor(dict_data=_zstd(content))
        for batch in batches:
            for base, need, ids, counts, offsets, payload in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if need != name:
                    raise ValueError(f"block needs dictionary {need}, the store has {name}")
                view = memoryview(payload)
                starts = base + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
                raw = [unpacker.decompress(view[a:b]) for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(starts), pa.array([len(x) // 4 for x in raw], pa.int64()),
                     pa.array(raw, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return (blocks.join(ranges, "part").select((F.col("base") + F.col("before")).alias("base"), "dictionary", "doc_ids", "n_tokens", "offsets", "payload")
            .mapInArrow(tidy(decode), "doc_id bigint, start bigint, n_tokens bigint, ids binary"))


def read_document(spark: SparkSession, store: TokenStore, doc_id: int) -> list[np.ndarray]:
    """The id arrays of one document (one entry for each row of that id); reads the blocks that can hold it."""
    name, content = store.dictionary(spark)
    unpacker = zstandard.ZstdDecompressor(dict_data=_zstd(content))
    near = store.blocks(spark).where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    hit = near.select("dictionary", F.posexplode("doc_ids").alias("k", "id"), "offsets", "payload").where(F.col("id") == doc_id)
    at = F.element_at("offsets", F.col("k") + 1)
    rows = hit.select("dictionary", F.substring(F.col("payload"), at.cast("int") + 1,
                                                (F.element_at("offsets", F.col("k") + 2) - at).cast("int"))).collect()
    if any(r[0] != name for r in rows):
        raise ValueError(f"a block needs another dictionary than {name}")
    return [np.frombuffer(unpacker.decompress(bytes(r[1])), "<u4") for r in rows]


