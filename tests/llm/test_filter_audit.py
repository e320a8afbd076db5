import glob
import os
import random
import re
from itertools import permutations

import pytest
from helpers import WORD, clashing, docs_of, words

from tessera.llm import filter_audit as a

LABELS = "doc_id bigint, quality int, toxic int"


def text_mask(text):
    t = text or ""
    w = WORD.findall(t)
    return (len(w) < 50) + 2 * (100 * len(set(w)) < 65 * len(w)) + 4 * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t)) + 8 * bool(re.search("[#$%&*|]", t))


def brute(rows, labels):
    """Report of rows ``(doc_id, text, source)`` by applying the filters one after another."""
    good, toxic = ({d for d, *x in labels if d is not None and x[k] == 1} for k in (0, 1))
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    fails = []
    for d, t, s in rows:
        m = text_mask(t) + 16 * (d is not None and d > least[t or ""])
        fails.append((s or "", {f for k, f in enumerate("ABCDE") if m >> k & 1}, d))
    out, shapley = {}, {}
    for order in permutations("ABCDE"):
        alive = [True] * len(fails)
        for step, f in enumerate(order, 1):
            key = lambda p: (p, "".join(order), step)
            for i, (p, x, d) in enumerate(fails):
                row = out.setdefault(key(p), [0] * 6)
                if f in x and alive[i]:
                    alive[i] = False
                    row[1] += 1
                    row[4] += d in good
                    row[5] += d in toxic
                    shapley[p, f] = shapley.get((p, f), 0) + 1
                elif f in x:
                    row[2] += 1
                row[3] += x == {f}
                row[0] += alive[i]
    return {(p, o, s, *v, shapley.get((p, o[s - 1]), 0)) for (p, o, s), v in out.items()}


def corpus(seed):
    r = random.Random(seed)
    base = [None, "", " \n", "x", " ".join(words(60, seed)), "A B " * 40, " ".join(words(60, seed + 1)).upper(), " ".join(words(80, seed, 20)), "50 % off"]
    base += [" ".join(words(r.randrange(30, 90), 10 * seed + k, r.choice([30, 4000]))) + r.choice(["", "", " #", " $ |"]) for k in range(25)]
    rows = [(None, r.choice(base), "s1"), (5000, base[4], "s0"), (5000, base[4], "s0"), (5000, base[4], None), (7000, "é" * 300, "s2")]
    rows += [(k, r.choice(base), r.choice(["s0", "s0", "s1", None])) for k in range(150)]
    r.shuffle(rows)
    labels = [(k, r.choice([0, 1, None]), r.choice([0, 1])) for k in range(0, 150, 2)] + [(4, 1, 0), (None, 1, 1), (5000, 1, 1), (99999, 1, 1)]
    return rows, labels


def write(spark, rows, path, files, mode="append"):
    for k in range(files):
        part = rows[k::files]
        docs = docs_of(spark, [x[1] for x in part], [x[0] for x in part], [x[2] for x in part])
        clashing(docs).coalesce(1).write.mode(mode).parquet(path)


def result(df):
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {tuple(r) for r in df.select(columns).collect()}


@pytest.mark.parametrize("seed,local,slices", [(1, 100_000, 200), (2, 3, 2)])
def test_report_equals_brute_force(spark, tmp_path, monkeypatch, seed, local, slices):
    monkeypatch.setattr(a, "LOCAL_ROWS", local)
    monkeypatch.setattr(a, "SLICE_ROWS", slices)
    rows, labels = corpus(seed)
    path = str(tmp_path / "documents.parquet")
    write(spark, rows, path, 3)
    got = a.audit(spark, path, spark.createDataFrame(labels, LABELS), files_per_batch=1)
    assert got.count() == 600 * len({x[2] or "" for x in rows})
    assert result(got) == brute(rows, labels)


def test_smaller_ids_that_come_later_retract(spark, tmp_path):
    """Two runs over one folder, the second with smaller ids, equal one run over all."""
    t, u = " ".join(words(60, 1)), " ".join(words(70, 2))
    path, folder = str(tmp_path / "documents.parquet"), str(tmp_path / "audit")
    first = [(10, t, "s0"), (11, t, "s1"), (20, u, "s0")]
    second = [(1, t, "s2"), (10, t, "s0"), (21, u, "s0"), (2, "x", "s0")]
    labels = [(10, 1, 0), (1, 0, 1)]
    table = spark.createDataFrame(labels, LABELS)
    write(spark, first, path, 1)
    assert result(a.audit(spark, path, table, folder)) == brute(first, labels)
    before = set(glob.glob(f"{path}/*.parquet"))
    write(spark, second, path, 1)
    for file in set(glob.glob(f"{path}/*.parquet")) - before:
        os.utime(file, (10**9, 10**9))  # files that come later may be older
    assert result(a.audit(spark, path + "/", table, folder)) == brute(first + second, labels)
    assert result(a.audit(spark, path, table, folder)) == brute(first + second, labels)  # nothing new: nothing changes
    batches = spark.read.schema(a._COUNTERS + ", batch int").parquet(f"{folder}/counters")
    assert batches.where("docs < 0").count() > 0  # a retraction


def test_leads_of_one_text():
    state, deltas = a.lead(None, [(5, 3, "p", 2), (7, 3, "q", 1)])
    assert state == (5, 3, {"p": 2}) and deltas == [("p", 3, 5, 2), ("q", 19, 7, 1)]
    state, deltas = a.lead(state, [(5, 3, "q", 1), (6, 3, "q", 1)])
    assert state == (5, 3, {"p": 2, "q": 1}) and deltas == [("q", 3, 5, 1), ("q", 19, 6, 1)]
    state, deltas = a.lead(state, [(4, 3, "p", 1)])
    assert state == (4, 3, {"p": 1})
    assert sorted(deltas) == sorted([("p", 3, 5, -2), ("p", 19, 5, 2), ("q", 3, 5, -1), ("q", 19, 5, 1), ("p", 3, 4, 1)])


def test_one_file_and_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    write(spark, [], path, 1)
    labels = spark.createDataFrame([], LABELS)
    assert a.audit(spark, path, labels).collect() == []
    t = " ".join(words(60, 1))
    write(spark, [(1, t, "s0"), (2, t, "s0")], path, 1, "overwrite")
    one = glob.glob(f"{path}/*.parquet")[0]
    assert result(a.audit(spark, one, labels)) == brute([(1, t, "s0"), (2, t, "s0")], [])
