import random
import re

import pytest
from helpers import WORD, clashing, docs_of, twins, words

from tessera.llm import quality as q


def base(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {k for places in at.values() if len(places) > 1 for i in places for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def norm(line):
    return " ".join(WORD.findall(line.lower()))


def verdicts(texts, sources, share, least):
    """Verdict and text that is left, by counting over all; ids are places."""
    hosts = {}
    for t, s in zip(texts, sources):
        hosts.setdefault(s, []).append(t)
    holder = {}
    for s, every in hosts.items():
        count, distinct = {}, list(dict.fromkeys(every))
        for t in distinct:
            for line in {norm(x) for x in (t or "").split("\n")} - {""}:
                count.setdefault(line, []).append(t)
        holder |= {(s, line): has[0] for line, has in count.items() if len(has) >= least and len(has) > share * len(distinct)}
    out = []
    for t, s in zip(texts, sources):
        n, _, _, _, rep = base(t)
        failed = n < 20 or 100 * rep > 30 * n
        goes = lambda x: holder.get((s, norm(x)), t) != t
        gone = [x for x in (t or "").split("\n") if goes(x)]
        left = n - sum(len(WORD.findall(x)) for x in gone)
        depleted = bool(gone) and (left < q.MIN_WORDS or left < q.MIN_SHARE * n)
        out.append((failed, not failed and not depleted, "\n".join(x for x in (t or "").split("\n") if not goes(x))))
    return out


def corpus():
    r = random.Random(4)
    common = [" ".join(words(n, 70 + n)) for n in (4, 12, 30)]
    texts = [None, "", "\n\n", "x " * 25, "é# *$ " * 30, " ".join(words(19, 1)), " ".join(words(20, 2)), "a b\na b\n \n \n a b", "\x1c x\x1c\n" * 3]
    loop = words(9, 5)
    texts += [" ".join(words(100, 6) + loop * 3), " ".join(words(20, 6) + loop * 3), " ".join(words(20_000, 7)), " ".join(words(8, 9) * 2)]
    for k in range(120):
        lines = [" ".join(words(r.randrange(3, 15), 100 * k + i)) for i in range(r.randrange(0, 5))]
        lines += r.sample(common, r.randrange(0, 4))
        r.shuffle(lines)
        texts.append("\n".join(x.upper() if r.random() < 0.2 else f"  {x} " if r.random() < 0.2 else x for x in lines))
    texts += ["a\u00a0b\u2003c d\n" * 3 + common[2] + f"\n\u00a0\u2003 {k}" for k in range(6)]  # other blanks are parts of words
    texts += ["\n".join([common[2], " ".join(words(6, 3))])] * 40  # many copies of one text count once
    sources = [r.choice(["s0", "s0", "s0", "s1", None]) for _ in texts]
    return texts, sources


def test_counts_and_verdicts_equal_brute_force(spark):
    texts, sources = corpus()
    for share, least in ((0.02, 20), (0.0, 5), (0.3, 2)):
        want = verdicts(texts, sources, share, least)
        rows = q.judge(clashing(docs_of(spark, texts, sources=sources)), share, least).collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(texts[r.doc_id]), texts[r.doc_id]
            assert (r.base_failed, r.kept) == want[r.doc_id][:2], texts[r.doc_id]
        docs = docs_of(spark, texts, sources=sources)
        kept = q.clean(docs, share, least)
        assert kept.schema == docs.schema
        got = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
        assert got == {i: (w[2], len(w[2])) for i, w in enumerate(want) if w[1]}


def test_null_and_repeated_ids_and_clashing_columns(spark):
    t = " ".join(words(40, 3))
    docs = docs_of(spark, [t, t, None, t], [None, None, None, 1])
    assert q.clean(docs).count() == 3
    wide = clashing(docs_of(spark, [t, "x"]))
    assert q.clean(wide).collect() == wide.where("doc_id = 0").collect()
    assert q.clean(docs_of(spark, [])).collect() == [] and q.judge(docs_of(spark, [])).collect() == []


def test_planted_lines_in_a_hot_and_a_small_host(spark):
    many, few = "this line is on many pages", "this line is on four pages"
    texts, sources = [], []
    for host, size in (("hot", 2000), ("small", 12)):
        for k in range(size):
            body = f"{' '.join(words(40, size + k, 1 << 40))}"
            texts.append(body + (f"\n{many}" if k < 5 else f"\n{few}" if k < 9 else ""))
            sources.append(host)
    out = q.clean(docs_of(spark, texts, sources=sources)).collect()
    assert len(out) == len(texts)
    for host in ("hot", "small"):
        assert sum(many in r.text for r in out if r.source == host) == 1  # in the text that holds it first
        assert sum(few in r.text for r in out if r.source == host) == 4


@pytest.mark.parametrize("variants", [2, 5, 20, 100])
def test_one_of_near_copies_stays(spark, variants):
    """Variants of one page with one line of their own; boilerplate of other pages still goes."""
    lines = [" ".join(words(8, 50 + k, 1 << 40)) for k in range(10)]
    texts = ["\n".join([*lines[:k % 10], f"variant number {k} of this page", *lines[k % 10 + 1 :]]) for k in range(variants)]
    footer = "all rights reserved by the makers of these pages"
    texts += [f"{' '.join(words(30, 900 + k, 1 << 40))}\n{footer}" for k in range(8)]
    out = {r.doc_id: r.text for r in q.clean(docs_of(spark, texts)).collect()}
    assert out[0] == texts[0]
    assert all(variants + k in out for k in range(8)) and [footer in out[variants + k] for k in range(8)] == [True] + [False] * 7
    if variants >= 20:
        assert len([k for k in out if k < variants]) < variants  # the others are depleted


def test_words_that_polynomials_confuse(spark):
    """Windows of different words are not repeats."""
    a, b = twins()
    texts = [" ".join([*(f"w{k}" for k in range(30)), a, *"ijklmno", b, *"ijklmno"])]
    (r,) = q.judge(docs_of(spark, texts)).collect()
    assert r.n_repeat_words == base(texts[0])[4] == 0
