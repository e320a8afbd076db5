"""Driver contract."""

import __spark_entry__ as E


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 30  # 10 per shard, 3 shards


def test_every_query_of_the_reference_has_an_oracle():
    own = {name for name in E.queries() if not name.startswith("op") and name != "pipeline"}
    assert own <= set(E.oracle_sql()) <= set(E.queries())
