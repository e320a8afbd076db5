"""Query model: constructors, simplification, rendering (P1, P8-P10, P13-P15)."""

import pytest

from tessera import MatchAll, Must, Should, Term, match_all, must, should, term


def test_must_drops_none_and_match_all():
    a, b = term("f", "x"), term("g", 1)
    assert must(None, match_all(), a) == a
    assert must() == MatchAll()
    assert must(None, match_all()) == MatchAll()
    assert must(a, None, b) == Must(a, b)


def test_should_keeps_clauses_as_given():
    a = term("f", "x")
    assert should(match_all(), a) == Should(MatchAll(), a)
    assert should() == Should()


def test_render():
    q = must(term("name", "Person3"), should(term("age", 3), term("w", 1.5)))
    assert str(term("name", "Person3")) == "term query name = Person3"
    assert str(q) == "bool must term query name = Person3 AND bool should term query age = 3 OR term query w = 1.5"
    assert str(match_all()) == "MatchAll()"


def test_term_types():
    with pytest.raises(TypeError):
        term("f", True)
    with pytest.raises(TypeError):
        term("f", None)
    with pytest.raises(TypeError):
        term("f", [1])
    assert Term("f", 3).value == 3


def test_leaves_count_repeats():
    x = term("f", "x")
    assert len(should(x, x).leaves()) == 2
    assert len(must(x, should(x, match_all())).leaves()) == 3


def test_clauses_must_be_queries():
    with pytest.raises(TypeError):
        Must("not a query")
