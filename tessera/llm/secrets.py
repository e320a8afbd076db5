"""Secrets in texts: fixed patterns, and strings that look random to character Markov models.

The patterns (*base*) label samples: the strings they find are random ones,
all other strings of eight characters or more are ordinary identifiers.
First-order Markov models are counted from all of them, over all documents: one
of ordinary strings, and one of random strings for each of ``ALPHABETS``, from
the samples that need that alphabet and a uniform prior over it, so alphabets
that the patterns do not find are known too.  A string of ``LEAST`` characters
or more outside the base spans is a secret too if the best log-likelihood ratio
of a random model to the ordinary one is above ``RATIO`` a character; for a
string under ``FULL`` characters, above what ``FULL`` characters would need.

One pass over the texts finds base spans, candidate strings and the counts;
only these are written.  Counts are summed by Spark (a few thousand pairs of
characters), and the ratio is then taken over the candidates alone.

Spans are places in code points, the end exclusive, and stand by start, then
kind.  Defined cases: a null text is empty; without a base match in the whole
table the random models are their priors; ``doc_id`` may be null; equal rows
give equal results; other columns are ignored, whatever their names; an empty
table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_tasks, materialize, tidy

# The base patterns.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more is the same as a run that is then found long enough
KINDS = ["assign", "access", "hex", "random"]
LEAST, FULL, RATIO, BACK_OFF, MEAN = 12, 20, 0.5, 1000.0, 32  # MEAN: length of a random string that the prior expects
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_DIGITS, _UPPER, _LOWER = ALPHABET[52:62], ALPHABET[:26], ALPHABET[26:52]
ALPHABETS = [_DIGITS + "abcdef", _DIGITS + "ABCDEF", _DIGITS + _LOWER, _DIGITS + _UPPER, ALPHABET[:62], ALPHABET[:62] + "+/=", ALPHABET[:62] + "_-=", ALPHABET]
_STRING = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
_SIZE = len(ALPHABET) + 1
_CODE = np.zeros(256, np.int64)  # 0: outside a string
_CODE[list(ALPHABET.encode())] = np.arange(1, _SIZE)


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """``(start, kind, end, start of the secret itself)`` in order."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def without(text: str, spans: list[tuple[int, int, int, int]]) -> str:
    """``text`` with blanks in place of its spans."""
    parts, at = [], 0
    for a, _, b, _ in spans:
        if b > at:
            parts += [text[at:a], " " * (b - max(a, at))]
            at = b
    return "".join([*parts, text[at:]])


def pair_counts(strings: list[str]) -> np.ndarray:
    """How often each character follows another (0: an end of a string)."""
    code = _CODE[np.frombuffer(("\n" + "\n".join(strings) + "\n").encode("ascii", "replace"), np.uint8)]
    return np.bincount(code[:-1] * _SIZE + code[1:], minlength=_SIZE * _SIZE)


def ratios(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Log of how much likelier each pair is in random strings than in ordinary ones.

    A character is as likely after another as counted, mixed with how likely
    it is anywhere (the weight of ``BACK_OFF`` counts; add-one smoothed), so a
    character that one kind of strings never holds tells in any place.
    """

    def logs(counts: np.ndarray) -> np.ndarray:
        pairs = counts.reshape(_SIZE, _SIZE)
        alone = (pairs.sum(0) + 1.0) / (pairs.sum() + _SIZE)
        return np.log((pairs + BACK_OFF * alone) / (pairs.sum(1, keepdims=True) + BACK_OFF))

    return logs(random) - logs(ordinary)


def alphabet_of(string: str) -> int:
    """The first of ``ALPHABETS`` that has all characters of ``string`` (but those in none)."""
    used = set(string) & set(ALPHABET)
    return next(k for k, letters in enumerate(ALPHABETS) if used <= set(letters))


def tables(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """:func:`ratios` for each alphabet: ``random`` has its counts, to which a uniform prior over the alphabet adds ``BACK_OFF`` counts."""
    out = np.empty((len(ALPHABETS), _SIZE * _SIZE))
    plain = ratios(np.zeros(_SIZE * _SIZE), ordinary)  # log of uniform over all, less that of ordinary strings
    for k, letters in enumerate(ALPHABETS):
        prior = np.zeros(_SIZE)
        prior[_CODE[list(letters.encode())]] = (1 - 1 / MEAN) / len(letters)
        prior[0] = 1 / MEAN
        pairs = random[k].reshape(_SIZE, _SIZE)
        chance = (pairs + BACK_OFF * prior) / (pairs.sum(1, keepdims=True) + BACK_OFF)
        out[k] = (np.log(np.maximum(chance, 1e-12)) + plain + np.log(_SIZE)).reshape(-1)
    return out


def scores(strings: list[str], tables: np.ndarray) -> np.ndarray:
    """The best log-likelihood ratio a character of each string."""
    code = _CODE[np.frombuffer(("\n" + "\n".join(strings) + "\n").encode("ascii"), np.uint8)]
    pairs = code[:-1] * _SIZE + code[1:]
    lengths = np.array([len(x) for x in strings])
    first = np.cumsum(lengths + 1) - lengths - 1
    return np.max([np.add.reduceat(t[pairs], first) for t in tables], axis=0) / lengths


def limits(lengths: np.ndarray) -> np.ndarray:
    """The ratio a character above which strings of these lengths are secrets."""
    return RATIO * np.maximum(1.0, FULL / lengths)


def score(string: str, table: np.ndarray) -> float:
    """Log-likelihood ratio a character."""
    code = _CODE[np.frombuffer(f"\n{string}\n".encode(), np.uint8)]
    return float(table[code[:-1], code[1:]].sum()) / max(1, len(string))


def _scored(string: str) -> bool:
    """Whether a string is a candidate: digits alone, under ``FULL`` of them, are a number (a random string is so once in 300 or less)."""
    return len(string) >= FULL or (len(string) >= LEAST and not string.isdigit())


_SPAN = "struct<start: int, kind: int, end: int>"


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, base, candidates`` of every document, and pair counts on some rows (``random``, ``ordinary``: pairs and counts)."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    candidate = pa.list_(pa.struct([("start", pa.int32()), ("string", pa.string())]))

    def task(batches):
        for batch in batches:
            base, candidates, hits, others = [], [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                spans = base_spans(text)
                base.append([{"start": a, "kind": k, "end": b} for a, k, b, _ in spans])
                hits += [text[s:b] for _, _, b, s in spans]
                text = without(text, spans)
                strings = _STRING.findall(text)
                others += strings
                if any(_scored(x) for x in strings):
                    candidates.append([{"start": m.start(), "string": m.group()} for m in _STRING.finditer(text) if _scored(m.group())])
                else:
                    candidates.append([])
            if not len(base):
                continue
            by = [[] for _ in ALPHABETS]
            for x in hits:
                by[alphabet_of(x)].append(x)
            counts = [np.concatenate([pair_counts(x) if x else np.zeros(_SIZE * _SIZE, np.int64) for x in by]), pair_counts(others)]
            pairs = [np.flatnonzero(x) for x in counts]
            first = [[{"pair": int(p), "n": int(c[p])} for p in ps] for c, ps in zip(counts, pairs)]
            kind = pa.list_(pa.struct([("pair", pa.int32()), ("n", pa.int64())]))
            rest = [None] * (len(base) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, span), pa.array(candidates, candidate),
                 pa.array([first[0], *rest], kind), pa.array([first[1], *rest], kind)],
                ["doc_id", "base", "candidates", "random", "ordinary"])

    pairs = "array<struct<pair: int, n: bigint>>"
    return arrow_tasks(docs).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        tidy(task), f"doc_id bigint, base array<{_SPAN}>, candidates array<struct<start: int, string: string>>, random {pairs}, ordinary {pairs}")


def model(scanned: DataFrame) -> np.ndarray:
    """The tables of ratios from all counts; where the patterns found nothing, random strings are those of the prior."""
    sums = []
    for name, size in (("random", len(ALPHABETS) * _SIZE * _SIZE), ("ordinary", _SIZE * _SIZE)):
        rows = scanned.where(F.col(name).isNotNull()).select(F.inline(name)).groupBy("pair").agg(F.sum("n").alias("n")).collect()
        counts = np.zeros(size, np.int64)
        counts[[r[0] for r in rows]] = [r[1] for r in rows]
        sums.append(counts)
    return tables(sums[0].reshape(len(ALPHABETS), -1), sums[1])


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans``: base spans and all spans of every document, as ``(start, kind, end)`` in order."""
    scanned = materialize(scan(docs), "secrets")
    table = model(scanned)
    rows = scanned.select("doc_id", "base", "candidates")
    def task(batches):
        for batch in batches:
            rows = batch.column(2).to_pylist()
            strings = [c["string"] for row in rows for c in row]
            found = iter(scores(strings, table) > limits(np.array([len(x) for x in strings])) if strings else [])
            out = [[{"start": c["start"], "kind": 3, "end": c["start"] + len(c["string"])} for c in row if next(found)] for row in rows]
            more = pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), more], ["doc_id", "base", "more"])

    found = rows.mapInArrow(task, f"doc_id bigint, base array<{_SPAN}>, more array<{_SPAN}>")
    return found.select("doc_id", "base", F.array_sort(F.concat("base", "more")).alias("spans"))


def joined(spans, kinds: list[str] = KINDS):
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans, kind: int):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
