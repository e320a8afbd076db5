"""Text analysis as Spark column expressions (JVM-side, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a maximal run of Unicode letters and digits, taken
# from the lower-cased text; the separator is its complement.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
SEPARATOR_PATTERN = r"[^\p{L}\p{N}]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """``array<string>`` of the tokens of ``text`` in order (NULL stays NULL).

    Splitting on runs of separators gives the same tokens as extracting every
    ``TOKEN_PATTERN`` match, plus an empty string where the text starts or
    ends with a separator; those are removed.  The split is about a fifth
    cheaper than the regex extraction.
    """
    return F.array_remove(F.split(F.lower(_col(text)), SEPARATOR_PATTERN), "")
