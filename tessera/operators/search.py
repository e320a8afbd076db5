"""Searching an index: query tree -> scored hits, as one DataFrame plan.

Plan shape (see README):
  postings scan (bucket pruning + pushed ``term IN``) -> broadcast join with
  the query's leaves -> per-(leaf, shard) document frequency (from the term
  dictionary of a saved index, else a partial aggregate of the matching
  postings; broadcast back) -> BM25 per posting -> one ``groupBy(shard, doc)``
  only when the tree has more than one leaf -> tree score -> filter.
Numeric leaves and match-all read ``docs`` (numeric filters pushed to the
scan).  Stored fields are joined last, after ranking and limits.

On a saved index the term dictionary also tells, before the postings are read:
* how many documents each clause of a ``Must`` has; the rarest clause's
  documents, where few enough to broadcast, filter the postings of the others
  as they are read, so what is shuffled is as large as the rarest clause;
* what no document of a range of ids can exceed (its terms' greatest counts
  and least lengths): top-k visits the most promising ranges first, and then
  only ranges that can still reach the k-th score found there;
* how many hits each shard has at least: ``take(n)`` reads no shard behind
  those that surely fill ``n``;
* which generations hold a term: of a table with many of them only those
  postings are opened.
These run a small job on the dictionary when the query is planned.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.query import MatchAll, Must, Query, Should, Term, must
from ..plans.broadcast import bounded_broadcast, max_broadcast_rows
from . import build
from .blocks import posting_rows
from .build import DOC_RANGE, Index, bucket_of, doc_range_of

# BM25 parameters (the library defaults of the reference's
# search engine): k1 = 1.2, b = 0.75.
K1 = 1.2
B = 0.75

# A clause filters others that are so many times larger.
NARROW_GAIN = 8
# Ranges of documents from which on top-k and take plan with the dictionary,
# bounds of ranges held by the driver at most, and runs of ranges in a filter.
LEAST_RANGES, MOST_RANGES, MOST_RUNS = 8, 200_000, 500
FIRST_RANGES = 2  # ranges visited first
# Generations from which on the dictionary tells which of them hold a term, before their postings are opened.
LEAST_GENERATIONS = 8

_INT_RANGE = {T.IntegerType: (-(2 ** 31), 2 ** 31 - 1), T.LongType: (-(2 ** 63), 2 ** 63 - 1)}


@dataclass(frozen=True)
class _Leaf:
    pos: int
    kind: str  # "post", "point", "num", "all", "none"
    field: str | None = None
    value: object = None
    text: bool = False
    pred: Column | None = None


def _numeric_predicate(dtype: T.DataType, name: str, value) -> Column | None:
    """Exact match at the column's width; None when the value cannot match."""
    if isinstance(value, str):
        return None
    is_array = isinstance(dtype, T.ArrayType)
    base = dtype.elementType if is_array else dtype
    if isinstance(base, (T.IntegerType, T.LongType)):
        if isinstance(value, float):
            if not value.is_integer():
                return None
            value = int(value)
        lo, hi = _INT_RANGE[type(base)]
        if not lo <= value <= hi:
            return None
        lit = F.lit(value).cast(base.simpleString())
    elif isinstance(base, T.FloatType):
        lit = F.lit(float(value)).cast("float")
    elif isinstance(base, T.DoubleType):
        lit = F.lit(float(value)).cast("double")
    else:
        return None
    return F.array_contains(F.col(name), lit) if is_array else (F.col(name) == lit)


def _classify(index: Index, leaves: list[Query]) -> list[_Leaf]:
    spec = index.spec
    doc_types = {f.name: f.dataType for f in index.docs.schema.fields}
    out = []
    for pos, q in enumerate(leaves):
        if isinstance(q, MatchAll):
            out.append(_Leaf(pos, "all"))
            continue
        assert isinstance(q, Term)
        kind = spec.kind(q.field)
        if kind in ("text", "keyword"):
            if isinstance(q.value, str):
                out.append(_Leaf(pos, "post", q.field, q.value, text=(kind == "text")))
            else:
                out.append(_Leaf(pos, "none"))
        elif kind == "numeric":
            pred = _numeric_predicate(doc_types[q.field], q.field, q.value)
            if pred is None:
                out.append(_Leaf(pos, "none"))
            elif index.points is not None:
                out.append(_Leaf(pos, "point", q.field, q.value, pred=_numeric_predicate(index.points[q.field].schema["value"].dataType, "value", q.value)))
            else:
                out.append(_Leaf(pos, "num", q.field, q.value, pred=pred))
        else:
            out.append(_Leaf(pos, "none"))
    return out


def _in_range(rows: DataFrame) -> DataFrame:
    return rows.withColumn(DOC_RANGE, doc_range_of(F.col("doc")))


def _null() -> Column:
    return F.lit(None).cast("double")


def _false() -> Column:
    return F.lit(False)


@dataclass
class _Compiled:
    score: Column      # NULL = no match
    bounded: bool      # every match matches at least one postings leaf
    implied: Column | None  # docs-side filter implied by the tree (None = none)


def _compile_tree(q: Query, leaves: list[_Leaf], counter: list[int]) -> _Compiled:
    if isinstance(q, (MatchAll, Term)):
        leaf = leaves[counter[0]]
        counter[0] += 1
        if leaf.kind in ("post", "point"):
            return _Compiled(F.col(f"_s{leaf.pos}"), True, None)
        if leaf.kind == "num":
            return _Compiled(F.when(leaf.pred, F.lit(1.0)), False, leaf.pred)
        if leaf.kind == "all":
            return _Compiled(F.lit(1.0), False, None)
        return _Compiled(_null(), True, _false())
    children = [_compile_tree(c, leaves, counter) for c in q.clauses]
    if not children:
        return _Compiled(_null(), True, _false())
    if isinstance(q, Must):
        # SQL '+' is NULL as soon as one child is NULL: exactly "all must match".
        score = reduce(lambda a, b: a + b, [c.score for c in children])
        implied = [c.implied for c in children if c.implied is not None]
        return _Compiled(score, any(c.bounded for c in children),
                         reduce(lambda a, b: a & b, implied) if implied else None)
    assert isinstance(q, Should)
    scores = [c.score for c in children]
    total = reduce(lambda a, b: a + b, [F.coalesce(s, F.lit(0.0)) for s in scores])
    score = F.when(F.coalesce(*scores).isNotNull(), total) if len(scores) > 1 else scores[0]
    if any(c.implied is None for c in children):
        implied = None
    else:
        implied = reduce(lambda a, b: a | b, [c.implied for c in children])
    return _Compiled(score, all(c.bounded for c in children), implied)


def _bm25(text: Column, tf: Column, dl: Column, n: Column, df: Column, avgdl: Column) -> Column:
    idf = F.log(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))
    norm = tf * F.lit(K1 + 1.0) / (tf + F.lit(K1) * (F.lit(1.0 - B) + F.lit(B) * dl / avgdl))
    return F.when(text, idf * norm).otherwise(idf)


def _size(q: Query, start: int, leaves: list[_Leaf], dfs: dict[int, int]) -> int | None:
    """Documents that ``q``, whose leaves begin at ``start``, matches at most; None if unknown."""
    if isinstance(q, (MatchAll, Term)):
        return 0 if leaves[start].kind == "none" else dfs.get(leaves[start].pos)
    sizes = [_size(c, at, leaves, dfs) for c, at in _clauses(q, start)]
    known = [x for x in sizes if x is not None]
    if isinstance(q, Must):
        return min(known, default=None) if q.clauses else 0
    return sum(known) if len(known) == len(sizes) else None


def _least(q: Query, start: int, leaves: list[_Leaf], dfs: dict[int, int], docs: int) -> int:
    """Documents of ``docs`` that ``q`` matches at least."""
    if isinstance(q, (MatchAll, Term)):
        return dfs.get(leaves[start].pos, 0) if leaves[start].kind == "post" else 0
    sizes = [_least(c, at, leaves, dfs, docs) for c, at in _clauses(q, start)]
    if not sizes:
        return 0
    return max(0, sum(sizes) - docs * (len(sizes) - 1)) if isinstance(q, Must) else max(sizes)


def _clauses(q: Query, start: int):
    """Clauses of ``q`` and where the leaves of each begin."""
    for c in q.clauses:
        yield c, start
        start += len(c.leaves())


@dataclass(frozen=True)
class _Narrow:
    """A clause of a ``Must`` that filters the leaves of its other clauses."""

    size: int
    clause: Query
    start: int


def _narrowings(q: Query, start: int, leaves: list[_Leaf], dfs: dict[int, int], outer: _Narrow | None = None) -> dict[int, _Narrow]:
    """For each leaf, the smallest clause that all its matches must have, if one is known."""
    if isinstance(q, (MatchAll, Term)):
        return {} if outer is None else {leaves[start].pos: outer}
    parts = [(c, at, _size(c, at, leaves, dfs) if isinstance(q, Must) else None) for c, at in _clauses(q, start)]
    rarest = min((x for x in parts if x[2] is not None), key=lambda x: x[2], default=None)
    out = {}
    for c, at, _ in parts:
        inner = outer
        if rarest is not None and at != rarest[1] and (outer is None or rarest[2] < outer.size):
            inner = _Narrow(rarest[2], rarest[0], rarest[1])
        out |= _narrowings(c, at, leaves, dfs, inner)
    return out


def _may_narrow(q: Query, start: int, leaves: list[_Leaf]) -> bool:
    """Whether some ``Must`` has two clauses with leaves in the dictionary."""
    if isinstance(q, (MatchAll, Term)):
        return False
    held = sum(any(leaves[i].kind == "post" for i in range(at, at + len(c.leaves()))) for c, at in _clauses(q, start))
    return (isinstance(q, Must) and held > 1) or any(_may_narrow(c, at, leaves) for c, at in _clauses(q, start))


def _runs(ranges: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """``(shard, first range, last range + 1)`` of consecutive ranges."""
    out: list[tuple[int, int, int]] = []
    for shard, r in sorted(ranges):
        if out and out[-1][0] == shard and out[-1][2] == r:
            out[-1] = (shard, out[-1][1], r + 1)
        else:
            out.append((shard, r, r + 1))
    return out


class Search:
    """An immutable query over an index.  Every method returns a new object or
    a DataFrame; nothing is cached or mutated (limits never leak into a later
    count)."""

    def __init__(self, index: Index, query: Query | None = None):
        self.index = index
        self._query = query
        self._only: list[tuple[int, int]] | None = None  # ranges of documents to look at
        self._shards_to: int | None = None  # last shard to look at

    # -- building the query (P11, P12, P13) ---------------------------------
    @property
    def current(self) -> Query:
        return self._query if self._query is not None else MatchAll()

    def query(self, q: Query) -> "Search":
        """Refine: the new query AND the current one."""
        return Search(self.index, must(q, self._query))

    def replace(self, q: Query) -> "Search":
        return Search(self.index, q)

    def __str__(self) -> str:
        return str(self.current)

    # -- core plan ----------------------------------------------------------
    def _lookup(self, post: list[_Leaf]) -> tuple[Column, DataFrame]:
        """The filter that finds the leaves' terms in postings or dictionary, and the leaves as a table."""
        idx = self.index
        terms = sorted({lf.value for lf in post})
        cond = F.col("term").isin(terms)
        if idx.bucketed:
            # bucket_of(literal) is constant-folded, so this is a partition filter.
            cond = F.col("bucket").isin(*[bucket_of(F.lit(t), idx.num_buckets) for t in terms]) & cond
        leaves_df = idx.sparkSession.createDataFrame(
            [(lf.pos, lf.field, lf.value, lf.text) for lf in post],
            "_leaf int, field string, term string, _text boolean",
        )
        return cond, leaves_df

    def _sizes(self, post: list[_Leaf]) -> dict[int, int]:
        """Documents with each leaf, from the dictionary."""
        return {pos: size for pos, (size, _) in self._held(post).items()}

    def _held(self, post: list[_Leaf]) -> dict[int, tuple[int, tuple[int, ...]]]:
        """Documents and generations with each leaf (a row of the dictionary's job for each leaf; remembered with the snapshot)."""
        known = self.index.known_sizes
        new = [lf for lf in post if (lf.field, lf.value) not in known]
        if new:
            cond, leaves_df = self._lookup(new)
            held = (self.index.terms.where(cond).join(F.broadcast(leaves_df), ["field", "term"])
                    .groupBy("_leaf").agg(F.sum("df"), F.sort_array(F.collect_set("gen"))).collect())
            found = {pos: (size, tuple(gens)) for pos, size, gens in held}
            known |= {(lf.field, lf.value): found.get(lf.pos, (0, ())) for lf in new}
        return {lf.pos: known[lf.field, lf.value] for lf in post}

    def _in_generations(self, rows: DataFrame, post: list[_Leaf]) -> DataFrame:
        """``rows`` of postings or dictionary, of the generations that hold one of the terms where there are many to choose from."""
        idx = self.index
        if idx.terms is None or len(idx.generations) < LEAST_GENERATIONS:
            return rows
        return rows.where(F.col("gen").isin(sorted({g for _, gens in self._held(post).values() for g in gens})))

    def _in_only(self, rows: DataFrame) -> DataFrame:
        """``rows`` of the ranges and shards to look at: pushed to the scan where they are few runs."""
        if self._shards_to is not None:
            rows = rows.where(F.col("shard") <= self._shards_to)
        if self._only is None:
            return rows
        runs = _runs(self._only)
        if not runs:
            return rows.where(_false())
        if len(runs) <= MOST_RUNS:
            per = build.DOCS_PER_RANGE
            return rows.where(reduce(lambda a, b: a | b, [
                (F.col("shard") == shard) & (F.col("doc") >= a * per) & (F.col("doc") < b * per) for shard, a, b in runs]))
        kept = self.index.sparkSession.createDataFrame(self._only, f"shard int, {DOC_RANGE} bigint")
        return _in_range(rows).join(F.broadcast(kept), ["shard", DOC_RANGE], "left_semi").drop(DOC_RANGE)

    def _leaf_rows(self, post: list[_Leaf], with_scores: bool, within: DataFrame | None = None) -> DataFrame:
        idx = self.index
        cond, leaves_df = self._lookup(post)
        # The leaves table is the query itself: its size is the query's.
        if idx.blocks is None:
            rows = self._in_only(idx.postings.where(cond)).join(F.broadcast(leaves_df), ["field", "term"])
        else:
            # all documents of a block lie in the range of its ``doc``
            rows = posting_rows(self._in_only(self._in_generations(idx.blocks.where(cond), post)).join(F.broadcast(leaves_df), ["field", "term"]))
        if within is not None:
            # documents of a clause whose size is known and within the broadcast limit
            rows = rows.join(F.broadcast(within), ["shard", "doc"], "left_semi")
        if not with_scores:
            return rows.select("shard", "doc", "_leaf", F.lit(1.0).alias("_score"))
        stats = idx.stats.where(F.col("field").isNotNull())
        if idx.terms is not None:
            # Term dictionary: the same pruned lookup on a small dataset, so
            # the matching postings are read once (for scoring) only.
            per_leaf = (self._in_generations(idx.terms.where(cond), post).join(F.broadcast(leaves_df), ["field", "term"])
                        .groupBy("_leaf", "field", "shard").agg(F.sum("df").alias("_df")))
        else:
            per_leaf = rows.groupBy("_leaf", "field", "shard").agg(F.count(F.lit(1)).alias("_df"))
        dfs = (
            per_leaf
            .join(stats, ["shard", "field"])
            .select("_leaf", "shard", "_df", F.col("n_docs").alias("_n"),
                    (F.col("sum_dl") / F.col("n_docs")).alias("_avgdl"))
        )
        dfs = bounded_broadcast(dfs, None if idx.num_shards is None else len(post) * idx.num_shards)
        return rows.join(dfs, ["_leaf", "shard"]).select(
            "shard", "doc", "_leaf",
            _bm25(F.col("_text"), F.col("tf").cast("double"), F.col("dl").cast("double"),
                  F.col("_n").cast("double"), F.col("_df").cast("double"), F.col("_avgdl")).alias("_score"),
        )

    def _narrowed(self, leaves: list[_Leaf]) -> dict[int, _Narrow]:
        """The clause that filters each leaf's postings, where one is worth it."""
        if self.index.terms is None or not _may_narrow(self.current, 0, leaves):
            return {}
        dfs = self._sizes([lf for lf in leaves if lf.kind == "post"])
        most = max_broadcast_rows(self.index.sparkSession)
        found = _narrowings(self.current, 0, leaves, dfs)
        return {pos: n for pos, n in found.items() if n.size <= most and dfs.get(pos, NARROW_GAIN * n.size) >= NARROW_GAIN * n.size}

    def _plan(self, with_scores: bool = True, keep: tuple = ()) -> tuple[DataFrame, bool]:
        """(shard, doc, score[, keep...]) of every match.

        Returns the frame and whether it was read from ``docs`` (then ``keep``
        columns are carried; otherwise they are not present).
        """
        idx = self.index
        q = self.current
        leaves = _classify(idx, q.leaves())
        compiled = _compile_tree(q, leaves, [0])
        post = [lf for lf in leaves if lf.kind in ("post", "point")]
        nums = sorted({lf.field for lf in leaves if lf.kind == "num"})
        docs = idx.docs

        candidates = None
        if post:
            narrowed = self._narrowed(leaves)
            filters: dict[_Narrow | None, DataFrame | None] = {None: None}
            for n in set(narrowed.values()):
                inner = Search(idx, n.clause)
                inner._only, inner._shards_to = self._only, self._shards_to
                filters[n] = inner._plan(False)[0].select("shard", "doc")
            parts = []
            for lf in post:
                if lf.kind == "point":
                    rows = self._in_only(idx.points[lf.field].where(lf.pred)).select("shard", "doc", F.lit(lf.pos).alias("_leaf"), F.lit(1.0).alias("_score"))
                    within = filters[narrowed.get(lf.pos)]
                    parts.append(rows if within is None else rows.join(F.broadcast(within), ["shard", "doc"], "left_semi"))
            for n, within in filters.items():
                terms = [lf for lf in post if lf.kind == "post" and narrowed.get(lf.pos) == n]
                if terms:
                    parts.append(self._leaf_rows(terms, with_scores, within))
            rows = reduce(lambda a, b: a.unionByName(b), parts)
            if len(leaves) == 1:
                # A single term: (shard, doc, field, term) is unique in postings.
                candidates = rows.select("shard", "doc", F.col("_score").alias(f"_s{post[0].pos}"))
            else:
                candidates = rows.groupBy("shard", "doc").agg(
                    *[F.max(F.when(F.col("_leaf") == lf.pos, F.col("_score"))).alias(f"_s{lf.pos}") for lf in post]
                )

        score = compiled.score
        if compiled.bounded and candidates is None:
            # Nothing can match (empty bool, unknown field, type mismatch).
            frame = docs.select("shard", "doc", *keep).where(_false())
            return frame.select("shard", "doc", _null().alias("score"), *keep), True
        if compiled.bounded and not nums:
            frame = candidates
            from_docs = False
        else:
            base = docs.select("shard", "doc", *sorted(set(nums) | set(keep)))
            if compiled.implied is not None:
                base = base.where(compiled.implied)
            if candidates is None:
                frame = base
            else:
                frame = base.join(candidates, ["shard", "doc"], "inner" if compiled.bounded else "left")
            from_docs = True
        out = frame.select("shard", "doc", score.cast("double").alias("score"), *(keep if from_docs else ()))
        return out.where(F.col("score").isNotNull()), from_docs

    # -- planning with the dictionary -----------------------------------------
    def _by_ranges(self) -> list[_Leaf] | None:
        """The leaves, if all are in the dictionary and the snapshot has ranges enough to choose from."""
        idx = self.index
        if idx.terms is None or self._only is not None or (idx.num_docs or 0) < LEAST_RANGES * build.DOCS_PER_RANGE:
            return None
        leaves = _classify(idx, self.current.leaves())
        return leaves if leaves and {lf.kind for lf in leaves} <= {"post", "none"} and any(lf.kind == "post" for lf in leaves) else None

    def range_bounds(self) -> DataFrame:
        """``shard, doc_range, bound``: what no score in a range exceeds, of the ranges that can have a hit.

        The score grows with a term's count and falls with the length, and the
        tree's score with its leaves', so the tree over the leaves' bounds is
        a bound.  Only for queries of text and keyword terms on a saved index.
        """
        idx = self.index
        leaves = _classify(idx, self.current.leaves())
        post = [lf for lf in leaves if lf.kind == "post"]
        cond, leaves_df = self._lookup(post)
        held = (idx.terms.where(cond).join(F.broadcast(leaves_df), ["field", "term"]).groupBy("_leaf", "_text", "field", "shard", DOC_RANGE)
                .agg(F.sum("df").alias("df"), F.max("max_tf").alias("tf"), F.min("min_dl").alias("dl")))
        stats = idx.stats.where(F.col("field").isNotNull())
        dfs = held.groupBy("_leaf", "field", "shard").agg(F.sum("df").alias("_df")).join(stats, ["shard", "field"]).select(
            "_leaf", "shard", "_df", F.col("n_docs").alias("_n"), (F.col("sum_dl") / F.col("n_docs")).alias("_avgdl"))
        score = _bm25(F.col("_text"), F.col("tf").cast("double"), F.col("dl").cast("double"),
                      F.col("_n").cast("double"), F.col("_df").cast("double"), F.col("_avgdl"))
        each = held.join(dfs, ["_leaf", "shard"]).select("shard", DOC_RANGE, "_leaf", score.alias("_score"))
        rows = each.groupBy("shard", DOC_RANGE).agg(
            *[F.max(F.when(F.col("_leaf") == lf.pos, F.col("_score"))).alias(f"_s{lf.pos}") for lf in post])
        bound = _compile_tree(self.current, leaves, [0]).score.cast("double")
        return rows.select("shard", DOC_RANGE, bound.alias("bound")).where(F.col("bound").isNotNull())

    def _bounded(self, k: int, per_shard: bool) -> "Search":
        """This search over the ranges that can hold one of the ``k`` best (of each shard)."""
        if self._by_ranges() is None:
            return self
        bounds = self.range_bounds().limit(MOST_RANGES + 1).collect()
        if len(bounds) > MOST_RANGES:
            return self
        ordered = sorted(bounds, key=lambda r: (-r["bound"], r["shard"], r[DOC_RANGE]))
        first: dict[int, list[tuple[int, int]]] = {}
        for r in ordered:
            own = first.setdefault(r["shard"] if per_shard else -1, [])
            if len(own) < FIRST_RANGES:
                own.append((r["shard"], r[DOC_RANGE]))
        probe = self._over([x for own in first.values() for x in own])
        if per_shard:
            w = Window.partitionBy("shard").orderBy(F.desc("score"), F.asc("doc"))
            rank = F.row_number().over(w)
            floor = dict(probe.scored().withColumn("rank", rank).where(F.col("rank") == k).select("shard", "score").collect())
        else:
            best = [r["score"] for r in probe.scored().select("score").orderBy(F.desc("score")).limit(k).collect()]
            floor = {-1: best[-1]} if len(best) == k and k else {}
        slack = 1e-9  # sums may round otherwise than bounds
        keep = [(r["shard"], r[DOC_RANGE]) for r in ordered
                if r["bound"] * (1 + slack) + slack >= floor.get(r["shard"] if per_shard else -1, float("-inf"))]
        return self._over(keep)

    def _over(self, ranges: list[tuple[int, int]]) -> "Search":
        out = Search(self.index, self._query)
        out._only, out._shards_to = ranges, self._shards_to
        return out

    def _first_shards(self, n: int) -> "Search":
        """This search over the first shards that surely have ``n`` hits."""
        leaves = self._by_ranges()
        if leaves is None or self.index.num_shards is None or self.index.num_shards > MOST_RANGES:
            return self
        cond, leaves_df = self._lookup([lf for lf in leaves if lf.kind == "post"])
        held: dict[int, dict[int, int]] = {}
        for shard, pos, df in (self.index.terms.where(cond).join(F.broadcast(leaves_df), ["field", "term"]).groupBy("shard", "_leaf")
                               .agg(F.sum("df")).collect()):
            held.setdefault(shard, {})[pos] = df
        docs = dict(self.index.shards().collect())
        total = 0
        for shard in sorted(held):
            total += _least(self.current, 0, leaves, held[shard], docs.get(shard, 0))
            if total >= n:
                out = Search(self.index, self._query)
                out._only, out._shards_to = self._only, shard
                return out
        return self

    # -- results ------------------------------------------------------------
    def scored(self) -> DataFrame:
        """(shard, doc, score) of every hit, no stored fields."""
        return self._plan(True)[0]

    def _stored(self) -> tuple:
        return tuple(self.index.spec.stored)

    def _fetch(self, ranked: DataFrame, bound: int | None) -> DataFrame:
        """Join ranked hits to their stored fields (late materialisation).

        A saved index keeps ``docs`` in directories by ``(shard, doc_range)``,
        and the join is on those columns too: where the hits are broadcast
        (a proven bound, as with top-k, or a small size seen at run time),
        only the directories that hold a hit are read.
        """
        stored = self._stored()
        if not stored:
            return ranked
        idx = self.index
        small = bounded_broadcast(_in_range(ranked) if idx.bucketed else ranked, bound)
        if not idx.bucketed:
            return small.join(idx.docs.select("shard", "doc", *stored), ["shard", "doc"])
        return small.join(idx.docs.select("shard", "doc", DOC_RANGE, *stored), ["shard", DOC_RANGE, "doc"]).drop(DOC_RANGE)

    def hits(self) -> DataFrame:
        """Every hit: shard, doc, score and the stored fields."""
        stored = self._stored()
        frame, from_docs = self._plan(True, stored)
        if from_docs:
            return frame
        leaves = self._by_ranges()
        bound = None
        if leaves is not None:
            # the dictionary tells how many hits there are at most: where those are few enough to be
            # broadcast, the documents stay where they lie and only the hits' directories are read
            bound = _size(self.current, 0, leaves, self._sizes([lf for lf in leaves if lf.kind == "post"]))
        return self._fetch(frame, bound)

    def count(self) -> int:
        return self.count_frame().first()[0]

    def _dictionary_rows(self) -> DataFrame | None:
        """Term dictionary rows of a single text / keyword term on a saved
        index (its hits per shard are the summed ``df``), else None."""
        idx = self.index
        if idx.terms is None:
            return None
        leaves = _classify(idx, self.current.leaves())
        if len(leaves) != 1 or leaves[0].kind != "post":
            return None
        lf = leaves[0]
        cond = ((F.col("bucket") == bucket_of(F.lit(lf.value), idx.num_buckets))
                & (F.col("term") == F.lit(lf.value)) & (F.col("field") == F.lit(lf.field)))
        return idx.terms.where(cond)

    def count_frame(self) -> DataFrame:
        """One row, ``hits``: number of matches; never capped, no scoring.
        A single term on a saved index reads only its dictionary rows."""
        rows = self._dictionary_rows()
        if rows is not None:
            return rows.agg(F.coalesce(F.sum("df"), F.lit(0)).cast("bigint").alias("hits"))
        return self._plan(False)[0].agg(F.count(F.lit(1)).alias("hits"))

    def totals_per_shard(self) -> DataFrame:
        """Total hits per shard, independent of any k (dictionary only for a
        single term on a saved index)."""
        rows = self._dictionary_rows()
        if rows is not None:
            return rows.groupBy("shard").agg(F.sum("df").cast("bigint").alias("hits"))
        return self._plan(False)[0].groupBy("shard").agg(F.count(F.lit(1)).alias("hits"))

    def ranked(self) -> DataFrame:
        """Every hit with ``rank`` (1-based) inside its shard: score
        descending, then doc.  Uses the balanced numbering of
        :func:`tessera.operators.numbering.number_within`, so a hot shard is
        spread over many tasks.

        The numbering writes the hits once to the staging folder, so the query
        itself runs once, and a lost executor does not rerun the search."""
        from .numbering import number_within

        scored = self.scored().withColumn("_neg", -F.col("score"))
        out = number_within(scored, "shard", ["_neg", "doc"], "_pos")
        return out.select("shard", "doc", "score", (F.col("_pos") + 1).cast("bigint").alias("rank"))

    def top_k_per_shard(self, k: int, fetch: bool = True) -> DataFrame:
        """At most k best hits per shard (``WindowGroupLimit`` keeps only k
        rows per shard in each task before the shuffle)."""
        w = Window.partitionBy("shard").orderBy(F.desc("score"), F.asc("doc"))
        top = (self._bounded(k, True).scored().withColumn("rank", F.row_number().over(w).cast("bigint"))
               .where(F.col("rank") <= k))
        if not fetch:
            return top
        shards = self.index.num_shards
        return self._fetch(top, k * shards if shards is not None else None)

    def take(self, n: int, fetch: bool = True) -> DataFrame:
        """The reference's ``take(n)``: best n of each shard, then the first n
        in shard order (not a global ranking)."""
        top = self._first_shards(n).scored().orderBy("shard", F.desc("score"), "doc").limit(n)
        out = self._fetch(top, n) if fetch else top
        return out.orderBy("shard", F.desc("score"), "doc")

    def top_k(self, k: int, fetch: bool = True) -> DataFrame:
        """Global top k over all shards (``TakeOrderedAndProject``)."""
        top = self._bounded(k, False).scored().orderBy(F.desc("score"), "shard", "doc").limit(k)
        out = self._fetch(top, k) if fetch else top
        return out.orderBy(F.desc("score"), "shard", "doc")

    # -- projections of hits (D1-D3) ----------------------------------------
    def project(self, *cols) -> DataFrame:
        return self.hits().select(*cols)

    def doc_ids(self) -> DataFrame:
        return self._plan(False)[0].select("shard", "doc")

    def field_names(self) -> DataFrame:
        """Per hit, the names of the stored fields it has (non-NULL)."""
        stored = self._stored()
        names = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in stored])) \
            if stored else F.array().cast("array<string>")
        return self.hits().select("shard", "doc", names.alias("fields"))
