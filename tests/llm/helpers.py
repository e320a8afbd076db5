"""Small tables with awkward rows, shared by the operator tests."""

from __future__ import annotations

import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(n: int, seed: int, size: int = 4000) -> list[str]:
    r = random.Random(seed)
    return ["w%x" % r.randrange(size) for _ in range(n)]


def docs_of(spark, texts, ids=None, sources=None):
    """A documents table; more columns than needed, with names that operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    sources = sources or ["s0"] * len(texts)
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOCS)


def clashing(docs):
    """``docs`` with extra columns named like operators' own."""
    from pyspark.sql import functions as F

    for name in ("_row", "text_hash", "class", "group", "part", "h", "n", "pos", "kept", "removed", "spans", "base", "shard", "slot",
                 "start", "offset", "sequence_id", "score", "component_id", "ids", "value", "term", "_new"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    return docs


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def twins(n: int = 1024) -> tuple[str, str]:
    """Two words of two letters that every polynomial over their bytes modulo a power of two takes for one (Thue and Morse)."""
    bits = [k.bit_count() & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
