"""tessera: sharded search indexes on Spark DataFrames.

Build an index from any DataFrame, save it as Parquet, and answer exact-term,
AND and OR queries with BM25 scores, top-k, counts and batch lookups, all as
ordinary DataFrame plans.
"""

from .config import BASE_DIR_KEY, base_dir, ensure_local_dirs, table_path
from .functions.query import MatchAll, Must, Query, Should, Term, match_all, must, should, term
from .functions.text import TOKEN_PATTERN, tokens
from .operators.batch import search_many
from .operators.build import Index, build_index, postings_of, stats_of
from .operators.search import Search
from .operators.spec import IndexSpec
from .sources.store import compact, merge_tiers, open_index, read_manifest, save, vacuum
from .streaming.sink import index_stream

__all__ = [
    "BASE_DIR_KEY", "base_dir", "ensure_local_dirs", "table_path",
    "MatchAll", "Must", "Query", "Should", "Term", "match_all", "must", "should", "term",
    "TOKEN_PATTERN", "tokens",
    "search_many", "Index", "build_index", "postings_of", "stats_of", "Search", "IndexSpec",
    "compact", "merge_tiers", "open_index", "read_manifest", "save", "vacuum", "index_stream",
]
