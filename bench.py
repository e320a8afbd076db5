"""Benchmark: build, save, open and search an index over ``documents``.

Runs the workloads the reference times (index build, reader open, match-all
count, 7 int + 7 string lookups with top 10, searches) on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``
and prints one JSON line.

Method: first an untimed warm-up (JVM start, class loading, code generation)
builds and searches an index of the first 200 documents; its time is reported
as ``warmup_sec`` and not counted.  Build, save, open and compaction run once.
Each search is run ``$BENCH_RUNS`` times (default 3) and its median is
reported; ``first_run`` holds the first (cold-cache) time of each search.
Compaction merges a second table of six generations (written untimed): its
smallest four as one, then all as one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import tessera as ts  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="tessera-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tessera-bench")
        .config("spark.sql.shuffle.partitions", str(cpus * 2))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config(ts.BASE_DIR_KEY, f"{scratch}/tables")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ts.ensure_local_dirs(spark)

    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times: dict[str, float] = {}
    first: dict[str, float] = {}

    def once(fn):
        t0 = time.perf_counter()
        out = fn()
        return out, time.perf_counter() - t0

    def timed(name, fn):
        out, dt = once(fn)
        times[name] = round(dt, 3)
        return out

    def repeated(name, fn):
        samples = [once(fn)[1] for _ in range(runs)]
        first[name] = round(samples[0], 3)
        times[name] = round(statistics.median(samples), 3)

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spec = ts.IndexSpec(text=["text"], keyword=["lang", "source"], numeric=["n_chars"],
                        stored=["doc_id", "lang", "source"])
    n_shards = cpus

    def warmup():
        small = ts.build_index(docs.where(F.col("doc_id") < 200), spec, shard_by=F.pmod("doc_id", F.lit(2)),
                               num_shards=2, order_by=["doc_id"])
        ts.save(small, "warmup")
        w = ts.open_index(spark, "warmup")
        w.search(ts.must(ts.term("text", "the"), ts.term("lang", "en"))).top_k_per_shard(10).collect()
        w.search(ts.term("text", "the")).count()

    warmup_sec = round(once(warmup)[1], 3)

    def build():
        idx = ts.build_index(docs, spec, shard_by=F.pmod("doc_id", F.lit(n_shards)), num_shards=n_shards,
                             order_by=["doc_id"])
        return ts.save(idx, "documents")

    rows = timed("build_save", build)
    index = timed("open", lambda: ts.open_index(spark, "documents"))

    the, de = ts.term("text", "the"), ts.term("text", "de")
    nested = ts.must(the, ts.should(ts.term("lang", "de"), ts.term("source", "src3")))
    repeated("match_all_count", lambda: index.search().count())
    repeated("term_count", lambda: index.search(the).count())
    repeated("term_topk_per_shard", lambda: index.search(the).top_k_per_shard(10).collect())
    repeated("term_topk_global", lambda: index.search(the).top_k(10).collect())
    repeated("take", lambda: index.search(de).take(10).collect())
    repeated("must_hits", lambda: index.search(ts.must(ts.term("lang", "en"), the)).hits().count())
    repeated("should_hits", lambda: index.search(ts.should(ts.term("source", "src1"), de)).hits().count())
    repeated("nested_topk", lambda: index.search(nested).top_k_per_shard(10).collect())
    repeated("numeric_term", lambda: index.search(ts.term("n_chars", 1172)).hits().collect())
    repeated("totals_per_shard", lambda: index.search(the).totals_per_shard().collect())
    repeated("ranked", lambda: index.search(de).ranked().count())

    ints = [3, 100, 9999, 19999, 39999, 53245, 9876523]
    lookups = spark.createDataFrame(
        [(i, "n_chars", str(v)) for i, v in enumerate(ints)]
        + [(100 + i, "text", w) for i, w in enumerate(["the", "of", "de", "and", "to", "in", "zzzzqq"])],
        "query_id int, field string, term string",
    )
    repeated("batch_lookups_top10", lambda: ts.search_many(index, lookups, k=10).collect())

    # Merging: a table of six generations, its smallest four as one, then all as one.
    cuts = [0, 0.5, 0.8, 0.85, 0.9, 0.95, 1.0]
    for a, b in zip(cuts, cuts[1:]):
        part = docs.where((F.col("doc_id") >= int(a * rows)) & (F.col("doc_id") < int(b * rows)))
        ts.save(ts.build_index(part, spec, shard_by=F.pmod(F.col("doc_id"), F.lit(n_shards)), num_shards=n_shards, order_by=["doc_id"]),
                "generations", mode="append")
    timed("compact_to_3", lambda: ts.compact(spark, "generations", parts=3))
    timed("compact", lambda: ts.compact(spark, "generations"))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir).replace("sf", ""), "docs": rows, "cpus": cpus,
                      "runs": runs, "stat": "median", "first_run": first, "warmup_sec": warmup_sec}))
    spark.stop()


if __name__ == "__main__":
    main()
