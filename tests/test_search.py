"""Search semantics on the reference's own test inputs and on small frames."""

import math

import pytest
from pyspark.sql import functions as F

from tessera import IndexSpec, Must, Should, build_index, match_all, must, search_many, should, term

INTS = [3, 100, 9999, 19999, 39999, 53245, 9876523]


@pytest.fixture(scope="module")
def people(spark):
    # Six names in three partitions, exact stored string field.
    df = spark.createDataFrame([(f"Person{i}",) for i in range(1, 7)], "name string").repartition(3)
    return build_index(df, IndexSpec(keyword=["name"], stored=["name"]))


@pytest.fixture(scope="module")
def labelled(spark):
    # i = 1..500 written twice: `_all` = 测试<i>, `_name` = 名称<i>, age = i (indexed, not stored).
    rows = [(f"测试{i}", f"名称{i}", i) for _ in range(2) for i in range(1, 501)]
    df = spark.createDataFrame(rows, "_all string, _name string, age int")
    return build_index(df, IndexSpec(keyword=["_all", "_name"], numeric=["age"], stored=["_all", "_name"]))


def test_people_term_count(people):
    assert people.search(term("name", "Person1")).count() == 1
    assert people.search().count() == 6
    assert people.fields() == ["name"]
    assert people.shards().count() == 3


def test_labelled_lookups(labelled):
    assert labelled.search(match_all()).count() == 1000
    for v in INTS:
        expected = 2 if v in (3, 100) else 0
        assert labelled.search(term("age", v)).count() == expected
        assert labelled.search(term("_all", f"测试{v}")).count() == expected
    # point fields are not stored: not listed
    assert labelled.fields() == ["_all", "_name"]


def test_labelled_batch(spark, labelled):
    lk = spark.createDataFrame([(i, "age", str(v)) for i, v in enumerate(INTS)]
                               + [(10 + i, "_all", f"测试{v}") for i, v in enumerate(INTS)],
                               "query_id int, field string, term string")
    got = {r["query_id"]: r["n"] for r in search_many(labelled, lk, k=10).groupBy("query_id")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {0: 2, 1: 2, 10: 2, 11: 2}


@pytest.fixture(scope="module")
def small(spark):
    rows = [
        (0, "the cat sat on the mat", "en", 5, 1.5),
        (1, "The dog", "en", 7, 2.5),
        (2, "le chat", "fr", 5, 3.5),
        (3, None, "de", None, None),
    ]
    df = spark.createDataFrame(rows, "id long, body string, lang string, n int, w double")
    spec = IndexSpec(text=["body"], keyword=["lang"], numeric=["n", "w"], stored=["id", "lang"])
    return build_index(df, spec, shard_by=F.lit(0), num_shards=1, order_by=["id"])


def ids(search):
    return sorted(r["id"] for r in search.hits().collect())


def test_text_term_not_analysed(small):
    assert ids(small.search(term("body", "the"))) == [0, 1]
    assert ids(small.search(term("body", "The"))) == []  # query values are taken as given


def test_numeric_widths(small):
    assert ids(small.search(term("n", 5))) == [0, 2]
    assert ids(small.search(term("n", 5.0))) == [0, 2]
    assert ids(small.search(term("n", 5.5))) == []
    assert ids(small.search(term("n", "5"))) == []
    assert ids(small.search(term("n", 2 ** 40))) == []
    assert ids(small.search(term("w", 2.5))) == [1]
    assert ids(small.search(term("w", 3))) == []


def test_unknown_field_and_type_mismatch(small):
    assert ids(small.search(term("nope", "x"))) == []
    assert ids(small.search(term("lang", 3))) == []


def test_bool_semantics(small):
    assert ids(small.search(must(term("lang", "en"), term("body", "cat")))) == [0]
    assert ids(small.search(should(term("lang", "fr"), term("body", "dog")))) == [1, 2]
    assert ids(small.search(should())) == []
    assert ids(small.search(Must())) == []
    assert ids(small.search(should(match_all(), term("body", "cat")))) == [0, 1, 2, 3]
    assert ids(small.search(must(term("n", 5), should(term("lang", "fr"), term("lang", "de"))))) == [2]
    assert ids(small.search(should(term("n", 7), term("body", "chat")))) == [1, 2]


def test_scores(small):
    s = {r["id"]: r["score"] for r in small.search(Must(match_all(), term("n", 5))).hits().collect()}
    assert s == {0: 2.0, 2: 2.0}
    one = {r["id"]: r["score"] for r in small.search(term("lang", "en")).hits().collect()}
    twice = {r["id"]: r["score"] for r in small.search(Should(term("lang", "en"), term("lang", "en"))).hits().collect()}
    assert twice.keys() == one.keys()
    for k in one:
        assert math.isclose(twice[k], 2 * one[k])
    # keyword leaf: idf with N = 4 docs having lang, df = 2
    assert math.isclose(one[0], math.log(1 + (4 - 2 + 0.5) / (2 + 0.5)))


def test_chained_equals_must(small):
    a = small.search(term("body", "the")).query(term("lang", "en"))
    b = small.search(must(term("lang", "en"), term("body", "the")))
    assert sorted(a.scored().collect()) == sorted(b.scored().collect())
    assert str(small.search(term("body", "x")).replace(term("body", "y"))) == "term query body = y"


def test_limits_do_not_leak(small):
    s = small.search(match_all())
    assert s.take(1).count() == 1
    assert s.count() == 4
    assert s.top_k(2).count() == 2
    assert s.top_k_per_shard(3).count() == 3


def test_field_names_skip_nulls(small):
    got = {r["id"]: sorted(r["fields"]) for r in small.search().field_names().join(
        small.docs.select("shard", "doc", "id"), ["shard", "doc"]).collect()}
    assert got[0] == ["id", "lang"]


def test_multivalued(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x y", "y"], [1, 2]), (2, ["b"], None, [3])],
                               "id int, tags array<string>, notes array<string>, nums array<int>")
    idx = build_index(df, IndexSpec(keyword=["tags"], text=["notes"], numeric=["nums"], stored=["id"]))
    assert ids(idx.search(term("tags", "b"))) == [1, 2]
    assert ids(idx.search(term("notes", "y"))) == [1]
    assert ids(idx.search(term("nums", 3))) == [2]
    tf = idx.postings.where("field = 'notes' and term = 'y'").first()
    assert (tf["tf"], tf["dl"]) == (2, 3)


def test_ranked_equals_window_rank(spark):
    # The session has a checkpoint folder (conftest), so ranked() goes through
    # the checkpointed path; it must equal a plain row_number per shard.
    from pyspark.sql import Window

    assert spark.sparkContext.getCheckpointDir()
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spec = IndexSpec(text=["text"], keyword=["lang"], stored=["doc_id"])
    s = build_index(d, spec, shard_by=F.pmod("doc_id", F.lit(3)), num_shards=3, order_by=["doc_id"]).search(
        should(term("text", "the"), term("lang", "de")))
    w = Window.partitionBy("shard").orderBy(F.desc("score"), "doc")
    want = {tuple(r) for r in s.scored().select("shard", "doc", F.row_number().over(w).alias("rank")).collect()}
    got = {tuple(r) for r in s.ranked().select("shard", "doc", "rank").collect()}
    assert got == want and len(got) > 100
