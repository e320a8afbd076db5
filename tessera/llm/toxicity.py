"""Toxicity of texts: a learned lexicon, misspellings of it, and the words around each hit.

The lexicon is learned from labelled documents: words, and beginnings of words
(*stems*), that toxic ones hold far more often than others.  It is kept as a
trie.  A Levenshtein automaton runs along the trie, so one walk over a word
finds the lexicon words within one edit of it (of ``FUZZY`` letters or more)
and the stems it begins with; the walk's state sets are made once and
remembered, so a word costs a few dictionary lookups.

Each hit has a context: ``WINDOW`` words on each side.  Quotation marks around
the hit or a reporting word near it make it a quoted hit; a word of address
near it makes it a direct one.  Sums of hits by kind are the features of a
logistic model, fitted on the same labelled documents.

Only the fit uses a bounded sample (``TRAIN_ROWS`` labelled documents, picked by
a hash of ``doc_id``).  Scores read whole texts, one pass, without a shuffle.

Defined cases: null, empty and wordless texts get the score of no hits; a null
``doc_id`` is scored as any other; labels that are null or whose document is
missing are not used; without both kinds of labelled documents every score is
0; repeated labels count once; rows that repeat a ``doc_id`` are one training
text (that of the least hash) and are scored each; of terms with equal weight
the first by name enters the lexicon; words over 24 letters are in no lexicon;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_tasks, materialize

TRAIN_ROWS = 24_000
LEXICON = 1500  # terms at most
STEM = range(4, 9)  # letters of a stem
LEAST_DOCS, LEAST_ODDS = 4, 1.5
FUZZY = 5  # letters of a word from which one edit is allowed
WINDOW = 6
NEAR = 0.5  # a misspelled word's share of the lexicon word's weight
REMEMBER = 400_000  # distinct words (and states) a worker remembers
# Words that report speech, and words of address, in the languages at hand.
REPORT = frozenset("said says say wrote writes called quote quoted quotes saying sagte sagt schrieb dit disait écrit dijo dice escribió".split())
ADDRESS = frozenset("you your you're u du dich dein sie ihr tu toi ton vous votre tú te usted ustedes".split())
_WORD = re.compile(r"[^\W\d_]+")
_QUOTES = "\"“”„«»‘’"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Automaton:
    """Lexicon trie and Levenshtein automaton (one edit), determinised as words come."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float]):
        self.child: list[dict[str, int]] = [{}]
        self.depth, self.term, self.stem = [0], [None], [None]
        for weights, store in ((terms, self.term), (stems, self.stem)):
            for word, weight in weights.items():
                store[self._node(word)] = weight
        self._reset()

    def _node(self, word: str) -> int:
        node = 0
        for c in word:
            if c not in self.child[node]:
                self.child[node][c] = len(self.child)
                self.child.append({})
                self.depth.append(self.depth[node] + 1)
                self.term.append(None)
                self.stem.append(None)
            node = self.child[node][c]
        return node

    def _reset(self) -> None:
        start = self._closed({(0, 0)})
        self.sets, self.number, self.step = [start], {start: 0}, [{}]
        self.known: dict[str, tuple[float, float]] = {}

    def _closed(self, states: set[tuple[int, int]]) -> frozenset:
        """With lexicon letters that the word lacks."""
        more = {(n, 1) for s, e in states if e == 0 for n in self.child[s].values()}
        return frozenset(states | {x for x in more if (x[0], 0) not in states})

    def _move(self, state: int, c: str) -> int:
        out = set()
        for node, edits in self.sets[state]:
            after = self.child[node].get(c)
            if after is not None:
                out.add((after, edits))
            if edits == 0:
                out.add((node, 1))
                out.update((n, 1) for n in self.child[node].values())
        best = self._closed({(n, e) for n, e in out if e == 0 or (n, 0) not in out})
        if best not in self.number:
            self.number[best] = len(self.sets)
            self.sets.append(best)
            self.step.append({})
        self.step[state][c] = self.number[best]
        return self.number[best]

    def match(self, word: str) -> tuple[float, float]:
        """Weight of the lexicon word or of the weightiest stem that ``word`` begins with, and that of a misspelled lexicon word; 0 for none."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > REMEMBER or len(self.sets) > REMEMBER:
                self._reset()
            found = self.known[word] = self._run(word)
        return found

    def _run(self, word: str) -> tuple[float, float]:
        state, exact, node = 0, 0.0, 0
        for c in word:
            if node is not None:
                node = self.child[node].get(c)
                if node is not None and self.stem[node] is not None:
                    exact = max(exact, self.stem[node])
            after = self.step[state].get(c)
            state = self._move(state, c) if after is None else after
            if not self.sets[state]:
                return exact, 0.0
        if node is not None and self.term[node] is not None:
            exact = max(exact, self.term[node])
        near = 0.0
        if not exact:
            for n, edits in self.sets[state]:
                if edits and self.term[n] is not None and self.depth[n] >= FUZZY:
                    near = max(near, self.term[n])
        return exact, near


#: Exact hits: sum, most, distinct; misspelled: sum; quoted; direct; length.
FEATURES = 7


def features(text: str | None, automaton: Automaton) -> list[float]:
    words = words_of(text)
    get, known = automaton.match, automaton.known
    hits = []
    for i, w in enumerate(words):
        found = known.get(w)
        if found is None:
            found = get(w)
        if found[0] or found[1]:
            hits.append((i, w, *found))
    out = [0.0] * FEATURES
    out[6] = math.log1p(len(words))
    if not hits:
        return out
    marks = None
    distinct = set()
    for i, w, exact, near in hits:
        around = words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]
        quoted = not REPORT.isdisjoint(around)
        if not quoted:
            if marks is None:
                marks = _quoted_words(text)
            quoted = i in marks
        if quoted:
            out[4] += exact or near
            continue
        out[0] += exact + NEAR * near  # the model may correct for misspellings by the fourth feature
        out[1] = max(out[1], exact, NEAR * near)
        out[3] += near
        if exact:
            distinct.add(w)
        if not ADDRESS.isdisjoint(around):
            out[5] += exact or near
    out[0], out[3], out[4], out[5] = (math.log1p(out[k]) for k in (0, 3, 4, 5))
    out[2] = math.log1p(len(distinct))
    return out


def _quoted_words(text: str) -> set[int]:
    """Numbers of the words of short quotations (up to ``2 * WINDOW`` words between two marks)."""
    if not any(q in text for q in _QUOTES):
        return set()
    quoted, count, opened = set(), 0, None
    for m in re.finditer(rf"[{_QUOTES}]|[^\W\d_]+", text.lower()):
        if m.group() not in _QUOTES:
            count += 1
        elif opened is None:
            opened = count
        else:
            if count - opened <= 2 * WINDOW:
                quoted.update(range(opened, count))
                opened = None
            else:
                opened = count
    return quoted


def held_out(doc_id) -> F.Column:
    """Whether a row's label is only for testing."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """``text, toxic`` of at most about ``most`` labelled documents that are not held out, one text for each ``doc_id``.

    A ``doc_id`` is picked by its hash; of rows that repeat it, the text of the
    least hash is taken before anything is counted or collected.
    """
    labels = (labels.select(F.col("doc_id").alias("_id"), "toxic").dropna().where(~held_out(F.col("_id")))
              .groupBy("_id").agg(F.max("toxic").alias("toxic")))
    share = int(min(1.0, most / max(1, labels.count())) * (1 << 40))
    picked = labels.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 40)) < share)
    # at most about ``most`` ids, whatever the size of the tables
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), "text").join(F.broadcast(picked), F.col("_doc") == F.col("_id"))
    one = rows.groupBy("_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("row"))
    return materialize(one.select("row.text", F.col("toxic").cast("int").alias("toxic")), "labelled")


def learn_lexicon(rows: DataFrame) -> tuple[dict[str, float], dict[str, float]] | None:
    """Words and stems with their log-odds, from document counts of ``rows(text, toxic)``."""

    def task(batches):
        for batch in batches:
            counts = (Counter(), Counter())
            sizes = [0, 0]
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(words_of(text))
                terms = {f"{w} " for w in words if 3 <= len(w) <= 24}
                for k in STEM:
                    terms.update(w[:k] for w in words if len(w) > k)
                counts[toxic > 0].update(terms)
                sizes[toxic > 0] += 1
            for toxic in (0, 1):
                if sizes[toxic]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(["", *counts[toxic]], pa.string()), pa.array([sizes[toxic], *counts[toxic].values()], pa.int64()),
                         pa.array([toxic] * (len(counts[toxic]) + 1), pa.int32())], ["term", "n", "toxic"])

    sums = rows.mapInArrow(task, "term string, n bigint, toxic int").groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
    sums = sums.where(F.col("bad") >= LEAST_DOCS).persist()
    try:
        total = sums.where("term = ''").first()
        if total is None or not total["good"]:
            return None
        odds = F.log((F.col("bad") + 0.5) / (total["bad"] + 1.0)) - F.log((F.col("good") + 0.5) / (total["good"] + 1.0))
        best = (sums.where("term <> ''").withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
                .orderBy(F.desc(F.col("bad") * F.col("odds")), "term").limit(LEXICON).collect())
    finally:
        sums.unpersist()
    terms = {r["term"][:-1]: r["odds"] for r in best if r["term"].endswith(" ")}
    stems = {r["term"]: r["odds"] for r in best if not r["term"].endswith(" ")}
    return terms, stems


def standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features by their spread in training, held to what a model can be asked about."""
    return np.clip((x - mean) / scale, -6, 6)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression on standardised features: weights (the last is the constant), means and scales."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1.0
    z = np.column_stack([standard(x, mean, scale), np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def toxicity(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    out = "doc_id bigint, score double"
    rows = training_rows(docs, labels, most)
    lexicon = learn_lexicon(rows)
    docs = arrow_tasks(docs).select(F.col("doc_id").cast("bigint"), "text")
    if lexicon is None:
        scored = docs.select("doc_id", F.lit(0.0).alias("score"))
    else:

        def of(automaton, column):
            return np.array([features(x, automaton) for x in column.to_pylist()], np.float64).reshape(-1, FEATURES)

        def train(batches):
            automaton = Automaton(*lexicon)
            for batch in batches:
                x = of(automaton, batch.column(0))
                yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])

        sample = rows.mapInArrow(train, "x array<double>, toxic int").collect()  # at most about ``most`` short rows
        w, mean, scale = fit(np.array([r[0] for r in sample]), np.array([float(r[1] > 0) for r in sample]))

        def task(batches):
            automaton = Automaton(*lexicon)
            for batch in batches:
                z = standard(of(automaton, batch.column(1)), mean, scale)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z @ w[:-1] + w[-1], -30, 30))))], ["doc_id", "score"])

        scored = docs.mapInArrow(task, out)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
