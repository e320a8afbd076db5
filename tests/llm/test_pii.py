import hashlib
import math
import random
import re

from helpers import clashing, docs_of, words
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import pii, queries

RULES = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for k, rule in enumerate(RULES):
        for m in re.finditer(rule, text or ""):
            hit, digits = m.group(), re.sub("[^0-9]", "", m.group())
            good = [True, k != 1 or all(int(p) <= 255 for p in hit.split(".")), 14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15][k]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


ODD = [None, "", "a@b.c_d@e.f x@y.z@w.q", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.255 1.2.3.4567 0255.1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111-1", "x4111111111111111 5500 0000 0000 0004 12",
       "+1 (555) 123-4567 +44 20 7946 0958. +1+12345678901", "é😀 bob@x.org 😀 +49 30 123456789", "a..b@c-d.e.", "@a.b a@b a@b.", ".@a.b 1 2 3 4 5 6 7 8 9 0 1 2 3 4", "9" * 60, "4" * 16 + "@a.bc",
       "+" + "1" * 16 + " +1 2 3 4 5 6 7 8 9 0", "a" * 50_000, "1" * 20_000, "a@b" + ".c" * 20_000, ("x@y.zz " * 300) + "\n" + "1.2.3.4 " * 200, "4111\n1111 1111 1111 1111", "+1\n2345678901"]


def spans_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return {r.i: [tuple(x) for x in r.b] for r in df.select("i", pii.base_spans(F.coalesce("text", F.lit(""))).alias("b")).collect()}


def test_base_spans_equal_brute_force(spark):
    got = spans_of(spark, ODD)
    for i, t in enumerate(ODD):
        assert got[i] == brute(t), (t or "")[:80]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("019.@+- ()a_%\n", max_size=40), min_size=150, max_size=200))
def test_base_spans_of_random_texts(spark, texts):
    got = spans_of(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == brute(t), t


def terms_of(text):
    return [x.lower() for x in re.findall(r"[^\W\d_]{4,}", text or "")]


def disclosed(texts):
    """Term spans of each text, by counting over all rows."""
    with_term, held = {}, []
    for t in texts:
        for w in set(terms_of(t)):
            with_term[w] = with_term.get(w, 0) + 1
        held.append({x for a, k, b in brute(t) for x in ((t or "")[a:b].lower(), pii.LABELS[k])})
    both, witnesses, seen = {}, {}, {}
    for t, entities in zip(texts, held):
        w = terms_of(t)
        near = frozenset(zip(w, w[1:])) or t  # texts here that share a neighbouring pair are copies
        for e in entities:
            seen.setdefault(e, set()).add(near)
            for x in set(w):
                both[e, x] = both.get((e, x), 0) + 1
                witnesses.setdefault((e, x), set()).add(near)

    def bound(k, n):
        p, z2 = k / n, pii.Z**2
        return (p + z2 / (2 * n) - pii.Z * math.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)

    told = {(e, w) for (e, w), k in both.items() if len(seen[e]) >= 3 and k >= 3 and bound(k, with_term[w]) >= 0.5 and len(witnesses[e, w]) >= 3}
    out = []
    for t, entities in zip(texts, held):
        spans = brute(t)
        out.append(sorted((m.start(), 4, m.end()) for m in re.finditer(r"[^\W\d_]{4,}", t or "")
                          if any((e, m.group().lower()) in told for e in entities) and not any(a < m.end() and b > m.start() for a, _, b in spans)))
    return out


def letters(k):
    return "".join(chr(97 + int(c, 16)) for c in f"{k:06x}")


def prose(seed, n=30):
    r = random.Random(seed)
    return " ".join(letters(r.randrange(1 << 24)) for _ in range(n))


def corpus():
    texts = [*ODD, *(" ".join(words(40, k)) for k in range(40))]
    texts += [f"{prose(k)} Patient Quillfeather wrote common words jq{k % 3}@mail.org about number {k}\nQuillfeather again" for k in range(12)]
    texts += [f"{prose(100 + k)} common words here and there {k}" for k in range(30)]
    texts += [f"{prose(200 + k)} Ask common Zanzibarov at 10.0.0.{k % 2} Zanzibarov" + " tail" * k for k in range(8)]
    texts += [f"{prose(300 + k)} two of Smallfry here me{k}@x.org" for k in range(2)]  # twice is no proof
    texts += [f"{prose(400 + k)} mostly Elsewhere here you{k % 1}@y.org" for k in range(4)] + [f"{prose(500 + k)} Elsewhere" for k in range(4)]
    return texts + [texts[60]] * 3


def test_terms_equal_brute_force(spark):
    texts = corpus()
    want = disclosed(texts)
    assert sum(map(len, want)) > 30
    masked = {t[a:b].lower() for t, spans in zip(texts, want) for a, _, b in spans}
    assert {"quillfeather", "zanzibarov"} <= masked and not masked & {"common", "words", "smallfry", "elsewhere"}
    rows = pii.find_personal(clashing(docs_of(spark, texts))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [tuple(x) for x in r.base] == brute(texts[r.doc_id])
        assert [tuple(x) for x in r.spans] == sorted(brute(texts[r.doc_id]) + want[r.doc_id]), texts[r.doc_id][:100]


def test_names_go_and_rare_words_stay_at_every_size(spark):
    """Names that stand with their value in five texts, words of one or two texts, and unrelated documents added."""
    names = [f"Name{letters(k)}" for k in range(20)]
    texts = [f"{prose(1000 + 10 * k + i, 40)}\n{name} {prose(7000 + 10 * k + i, 20)} p{k}@mail{k}.org" for k, name in enumerate(names) for i in range(5)]
    shares = []
    for more in (0, 400):
        every = texts + [prose(50_000 + k, 30) for k in range(more)]
        rows = [r for r in pii.find_personal(docs_of(spark, every)).collect() if r.doc_id < len(texts)]
        spans = {r.doc_id: {texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == 4} for r in rows}
        caught = sum(names[d // 5] in x for d, x in spans.items()) / len(texts)
        innocent = sum(len(x - {names[d // 5]}) for d, x in spans.items()) / (60 * len(texts))
        assert caught >= 0.9 and innocent <= 0.05
        shares.append(sum(map(len, spans.values())))
    assert shares[0] == shares[1]


def test_near_copies_are_one_witness(spark):
    base = prose(1, 80).split()
    texts = []
    for k in range(8):
        near = list(base)
        near[10 * k] = letters(90 + k)
        texts.append(" ".join(near) + " same@value.org")
    rows = pii.find_personal(docs_of(spark, texts + [prose(k) for k in range(2, 40)])).collect()
    assert all(len(r.spans) == len(r.base) for r in rows)


def test_hot_entity_empty_and_null(spark):
    """A value of two thirds of all rows; its own name is a term, common words are not."""
    texts = [f"{prose(k, 20)} common Hotperson hot@spot.org" for k in range(60)] + [f"{prose(100 + k, 20)} common" for k in range(30)] + [None, ""]
    found = pii.find_personal(docs_of(spark, texts, [None, *range(1, 92)]))
    rows = found.collect()
    assert len(rows) == 92
    for r in rows:
        t = texts[r.doc_id or 0]
        got = {t[s.start : s.end] for s in r.spans if s.kind == 4} if t else set()
        assert ("Hotperson" in got) == ("Hotperson" in (t or "")), t
    assert pii.find_personal(docs_of(spark, [])).collect() == []


def test_sanitise(spark):
    texts = corpus()
    want = disclosed(texts)
    docs = docs_of(spark, texts, [*range(len(texts) - 3), None, None, 5])
    out = pii.sanitise(docs)
    assert out.schema == docs.schema and out.count() == len(texts)
    for r in out.where("doc_id IS NOT NULL AND doc_id <> 5").collect():
        t = texts[r.doc_id]
        if t is None:
            assert r.text is None
            continue
        new, at = "", 0
        for a, k, b in sorted(brute(t) + want[r.doc_id]):
            if a >= at:
                new += t[at:a] + pii.LABELS[k]
            at = max(at, b)
        assert r.text == new + t[at:] and r.n_chars == len(r.text)
    wide = clashing(docs_of(spark, ["mail bob@x.org now"]))
    assert pii.sanitise(wide).collect()[0].text == "mail [EMAIL] now" and pii.sanitise(wide).schema == wide.schema
    assert pii.sanitise(docs_of(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = pii.find_personal(docs_of(spark, ["x@y.org"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query(spark, tmp_path):
    texts = corpus()
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op9_personal_data(spark, str(tmp_path)).collect():
        base = brute(texts[r.doc_id])
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for _, k, _ in base) for x in range(4))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
