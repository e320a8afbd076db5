"""Token ids of whole texts with the ``tokenizers`` library, inside Spark tasks.

The vocabulary file is a parameter; the driver reads it and its content goes
to the executors with the task, so executors need no copy of their own.

White space is a hard boundary of the vocabularies used here (their
pre-tokenizer drops it), so a text's ids are those of its words, one after
another.  Each worker therefore encodes a distinct word once and finds it again
by a 64-bit hash, checked by a second one; a run of texts in which two words
share the first but not the second is encoded text by text.  Words are split,
hashed and put together with numpy.
``exact_pieces`` checks that a vocabulary allows this (lower case, byte-level,
letters and marks apart); others encode whole texts.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

from . import textops

KEEP = 500_000  # distinct words a worker remembers (about 40 bytes each)
CHECK = 0x5851F42D4C957F2D  # seed of the second hash
RUN = 1 << 21  # bytes of text at a time
ROWS = 2000  # rows whose ids are in memory at a time
MARKS = frozenset(",.!?;:")
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in a byte-level model
_AS_BYTES = dict(zip(_PLAIN, _PLAIN)) | {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in set(_PLAIN))}


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def exact_pieces(vocabulary: str) -> bool:
    """Whether white space never takes part in a token of this vocabulary."""
    spec = json.loads(vocabulary)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    folds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    return (
        [x["type"] for x in steps] == ["Split", "ByteLevel"]
        and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        and steps[0]["pattern"].get("Regex", "").endswith("|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
        and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        and folds == ["NFC", "Replace", "Lowercase"]
        and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] or any(map(str.isspace, x["content"]))
                    for x in spec.get("added_tokens", []))
    )


class Known:
    """Ids of words by hash: a large sorted part, and a small one that new words are merged into."""

    def __init__(self):
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0
        empty = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint64)
        self.parts = [empty, empty]  # each: sorted hashes, place in the pool, number of ids, second hashes

    def __len__(self) -> int:
        return sum(len(x[0]) for x in self.parts)

    def find(self, hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        """Places and numbers of ids, place -1 where a hash is new; and whether a hash is that of another word."""
        place, number, other = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64), False
        for keys, at, n, second in self.parts:
            if len(keys):
                k = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[k] == hashes
                place[hit], number[hit] = at[k[hit]], n[k[hit]]
                other |= bool((second[k[hit]] != checks[hit]).any())
        return place, number, other

    def add(self, hashes: np.ndarray, checks: np.ndarray, ids: list[bytes]) -> None:
        new = np.frombuffer(b"".join(ids), "<u4")
        if self.used + len(new) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(len(self.pool), len(new)), np.uint32)])
        self.pool[self.used : self.used + len(new)] = new
        n = np.array([len(x) // 4 for x in ids], np.int32)
        fresh = hashes, self.used + np.cumsum(n, dtype=np.int64) - n, n, checks
        self.used += len(new)
        self.parts[1] = self._merged(self.parts[1], fresh)
        if len(self.parts[1][0]) > 50_000 + len(self.parts[0][0]) // 4:
            self.parts = [self._merged(*self.parts), tuple(x[:0] for x in fresh)]

    @staticmethod
    def _merged(a, b):
        order = np.argsort(np.concatenate([a[0], b[0]]), kind="stable")
        return tuple(np.concatenate([x, y])[order] for x, y in zip(a, b))


class Encoder:
    """Texts to ids; one per worker and vocabulary."""

    _made: dict[int, Encoder] = {}

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.by_piece = exact_pieces(vocabulary)
        self.known = Known()
        self.id_bytes = [k.to_bytes(4, "little") for k in range(self.tokenizer.get_vocab_size())]

    @classmethod
    def of(cls, vocabulary: str) -> Encoder:
        key = hash(vocabulary)
        if key not in cls._made:
            cls._made[key] = cls(vocabulary)
        return cls._made[key]

    def encode(self, texts) -> list[bytes]:
        """The ids of each text (a list or an Arrow column) as little-endian unsigned 32-bit integers; a null is an empty text."""
        column = texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.large_string())
        if not self.by_piece:
            return self._whole([x or "" for x in column.to_pylist()])
        data, offsets = textops.utf8(column)
        out: list[bytes] = []
        for i, j in textops.slices(offsets, RUN):
            out += self._run(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        return out

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _run(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        starts, ends, first = textops.words(data, offsets)
        hashes, at, which = np.unique(textops.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        checks = textops.word_hashes(data, starts, ends, seed=CHECK)
        place, number, other = self.known.find(hashes, checks[at])
        if other or (checks[at][which] != checks).any():
            return self._whole([data[a:b].tobytes().decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
        new = np.flatnonzero(place < 0)
        if len(new):
            if len(self.known) > KEEP:
                self.known = Known()
                place[:], new = -1, np.arange(len(hashes))
            raw = data.tobytes()
            self.known.add(hashes[new], checks[at[new]], self._words([raw[a:b].decode() for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist())]))
            place, number, _ = self.known.find(hashes, checks[at])
        counts = number[which]
        until = np.concatenate([[0], np.cumsum(counts)])
        ids = self.known.pool[np.repeat(place[which] - until[:-1], counts) + np.arange(until[-1])]
        raw, bounds = ids.astype("<u4").tobytes(), (4 * until[first]).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words.  Latin letters are one unit of the model (lower case, as bytes), a mark behind them a unit of its own."""
        parts, rest = {}, []
        for x in words:
            word, mark = (x[:-1], x[-1]) if x[-1] in MARKS else (x, "")
            if word.isalpha() and max(word) <= "\xff":
                parts[x] = (word.lower(), mark)
            else:
                rest.append(x)
        known, unit, id_bytes = {"": b""}, self.tokenizer.model.tokenize, self.id_bytes
        for word in {w for w, _ in parts.values()}:
            as_bytes = word if word.isascii() else word.encode().decode("latin-1").translate(_AS_BYTES)
            known[word] = b"".join([id_bytes[t.id] for t in unit(as_bytes)])
        rest += {m for _, m in parts.values() if m}
        whole = {x: b"".join([id_bytes[t] for t in done.ids])
                 for x, done in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False))}
        marks = whole | {"": b""}
        return [known[parts[x][0]] + marks[parts[x][1]] if x in parts else whole[x] for x in words]
