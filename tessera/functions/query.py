"""Query tree: match-all, exact term, AND (must) and OR (should).

Queries are small immutable values built on the driver.  They carry no data;
``tessera.operators.search`` compiles them to Spark ``Column`` expressions over
the index's postings and documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Union

TermValue = Union[str, int, float]


class Query:
    """Base class of every query node."""

    def leaves(self) -> list["Query"]:
        """Leaves in pre-order; a repeated leaf appears once per occurrence."""
        return [self]


@dataclass(frozen=True)
class MatchAll(Query):
    """Matches every document with a constant score of 1.0."""

    def __str__(self) -> str:
        return "MatchAll()"


@dataclass(frozen=True)
class Term(Query):
    """Exact value of one field.

    On a text field the value is compared with each token as given (it is not
    lower-cased or split); on a keyword field with the whole value; on a
    numeric field with the number, at the column's width.
    """

    field: str
    value: TermValue

    def __post_init__(self):
        if isinstance(self.value, bool) or not isinstance(self.value, (str, int, float)):
            raise TypeError(
                f"term value must be str, int or float, got {type(self.value).__name__}"
            )
        if not isinstance(self.field, str):
            raise TypeError("term field must be a string")

    def __str__(self) -> str:
        return f"term query {self.field} = {self.value}"


class _Bool(Query):
    clauses: tuple

    def leaves(self) -> list[Query]:
        out: list[Query] = []
        for c in self.clauses:
            out.extend(c.leaves())
        return out


@dataclass(frozen=True, init=False)
class Must(_Bool):
    """Every clause must match; the score is the sum of the clause scores.

    Built directly it keeps every clause (a MatchAll clause adds 1.0); use
    :func:`must` for the simplifying constructor.  No clause matches nothing.
    """

    clauses: tuple

    def __init__(self, *clauses: Query):
        _check_clauses(clauses)
        object.__setattr__(self, "clauses", tuple(clauses))

    def __str__(self) -> str:
        return "bool must " + " AND ".join(str(c) for c in self.clauses)


@dataclass(frozen=True, init=False)
class Should(_Bool):
    """At least one clause must match; matching clause scores add up."""

    clauses: tuple

    def __init__(self, *clauses: Query):
        _check_clauses(clauses)
        object.__setattr__(self, "clauses", tuple(clauses))

    def __str__(self) -> str:
        return "bool should " + " OR ".join(str(c) for c in self.clauses)


def _check_clauses(clauses) -> None:
    for c in clauses:
        if not isinstance(c, Query):
            raise TypeError(f"clause must be a Query, got {type(c).__name__}")


def match_all() -> MatchAll:
    return MatchAll()


def term(field: str, value: TermValue) -> Term:
    return Term(field, value)


def must(*queries: Query | None) -> Query:
    """AND with simplification: drop ``None`` and match-all clauses; none left
    gives match-all, one left gives that clause itself."""
    kept = [q for q in queries if q is not None and not isinstance(q, MatchAll)]
    if not kept:
        return MatchAll()
    if len(kept) == 1:
        return kept[0]
    return Must(*kept)


def should(*queries: Query) -> Should:
    """OR of the clauses as given (no simplification, unlike :func:`must`)."""
    return Should(*queries)
