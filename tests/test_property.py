"""Random query trees: Spark plan == brute-force evaluation in Python."""

import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera import IndexSpec, Must, Should, build_index, match_all, term

ROWS = [
    (0, "a b a c", "x", 1), (1, "b b d", "y", 2), (2, "c a", "x", 1), (3, "d", None, 3),
    (4, "a a a a e", "y", None), (5, "e c b", "z", 2), (6, "", "x", 1), (7, "f a", "y", 4),
    (8, "b c d e f", None, 2), (9, "a", "z", 1),
]
WORDS = ["a", "b", "c", "d", "e", "f", "zz"]


@pytest.fixture(scope="module")
def index(spark):
    df = spark.createDataFrame(ROWS, "id long, body string, tag string, n int")
    spec = IndexSpec(text=["body"], keyword=["tag"], numeric=["n"], stored=["id"])
    return build_index(df, spec, shard_by=F.pmod("id", F.lit(2)), num_shards=2, order_by=["id"])


def _stats():
    out = {}
    for s in (0, 1):
        docs = [r for r in ROWS if r[0] % 2 == s]
        lens = [len(re.findall(r"[a-z0-9]+", r[1])) for r in docs]
        n_text = sum(1 for x in lens if x > 0)
        out[s] = {"n_text": n_text, "avgdl": sum(lens) / n_text, "n_tag": sum(1 for r in docs if r[2] is not None),
                  "docs": docs}
    return out


STATS = _stats()


def leaf_score(q, row):
    if q.__class__.__name__ == "MatchAll":
        return 1.0
    s = STATS[row[0] % 2]
    if q.field == "body":
        if not isinstance(q.value, str):
            return None
        toks = re.findall(r"[a-z0-9]+", row[1])
        tf = toks.count(q.value)
        if tf == 0:
            return None
        df = sum(1 for r in s["docs"] if q.value in re.findall(r"[a-z0-9]+", r[1]))
        idf = math.log(1 + (s["n_text"] - df + 0.5) / (df + 0.5))
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(toks) / s["avgdl"]))
    if q.field == "tag":
        if not isinstance(q.value, str) or row[2] != q.value:
            return None
        df = sum(1 for r in s["docs"] if r[2] == q.value)
        return math.log(1 + (s["n_tag"] - df + 0.5) / (df + 0.5))
    if q.field == "n":
        v = q.value
        if isinstance(v, str) or row[3] is None:
            return None
        if isinstance(v, float) and not v.is_integer():
            return None
        return 1.0 if row[3] == v else None
    return None


def score(q, row):
    if isinstance(q, Must):
        parts = [score(c, row) for c in q.clauses]
        return None if not parts or any(p is None for p in parts) else sum(parts)
    if isinstance(q, Should):
        parts = [p for p in (score(c, row) for c in q.clauses) if p is not None]
        return sum(parts) if parts else None
    return leaf_score(q, row)


leaves = st.one_of(
    st.sampled_from(WORDS).map(lambda w: term("body", w)),
    st.sampled_from(["x", "y", "z", "w"]).map(lambda t: term("tag", t)),
    st.sampled_from([1, 2, 3, 2.0, 2.5, "2"]).map(lambda v: term("n", v)),
    st.just(match_all()),
    st.just(term("missing", "a")),
)
trees = st.recursive(
    leaves,
    lambda kids: st.one_of(st.lists(kids, max_size=3).map(lambda cs: Must(*cs)),
                           st.lists(kids, max_size=3).map(lambda cs: Should(*cs))),
    max_leaves=6,
)


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(q=trees)
def test_tree_matches_brute_force(index, q):
    got = {(r["id"]): r["score"] for r in index.search(q).hits().collect()}
    want = {row[0]: score(q, row) for row in ROWS if score(q, row) is not None}
    assert got.keys() == want.keys(), str(q)
    for k, v in want.items():
        assert math.isclose(got[k], v, rel_tol=1e-9, abs_tol=1e-12), (str(q), k)
    assert index.search(q).count() == len(want)
