"""Allow and block rules for urls, by a sorted sweep over canonical keys.

A rule ``(host, path)`` fits a host and all its subdomains if the url's path
starts with the rule's.  A host written backwards by label
(``com.example.www``) is a *node*; under one node, the paths a rule covers are
one interval ``[path, path + 0xFF)`` of the sorted keys ``(node, path)``, and
intervals nest or are apart, never cross.  A url stands as a point under each
of its host's nodes that has rules.

Points and interval ends are range-partitioned and sorted together (a
sort-merge range join).  The sweep's stack is its depth: starts add one, ends
take one away, and the top of the stack at a point of depth ``d`` is the last
start of depth ``d`` before it.  Blocks of the sort are swept on their own;
what is open where a block begins comes from small tables of block totals and
last starts.  A key shared by any number of urls is split among blocks, as the
row number is part of the sort key.

Everything is DataFrame operations; no side is broadcast by name.

Defined cases: a null url or one without ``://`` has empty host and path and
fits no rule; of the rules that fit, the longest string wins, then the longest
host, then block; a url that no rule fits gets ``default``; rules that are
null in any column are left out; repeated rules count once (block before
allow).  An empty rule path covers every path.  A
very long host has no nodes deeper than the deepest rule's.  Equal urls get
equal verdicts; other columns are ignored, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _node(labels: Column) -> Column:
    return F.concat_ws(".", F.reverse(labels))


def _key(path: Column, closing: bool = False) -> Column:
    raw = F.encode(path, "UTF-8")
    return F.concat(raw, F.lit(bytearray(b"\xff"))) if closing else raw


def longest_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``_row, rule, rule_verdict`` of the urls (``_row, host, path``) that some rule fits."""
    spark = urls.sparkSession
    rules = (rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").dropna()
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))  # "block" > "allow"
    rules = rules.select(_node(F.split("host", r"\.")).alias("node"), "path",
                         F.struct(F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"), "verdict").alias("top"))
    none = F.lit(None)
    kind = rules.schema["top"].dataType
    edges = rules.select("node", F.inline(F.array(
        F.struct(_key(F.col("path")).alias("key"), F.lit(0).alias("kind"), F.lit(1).alias("delta"), F.col("top")),
        F.struct(_key(F.col("path"), True).alias("key"), F.lit(2).alias("kind"), F.lit(-1).alias("delta"), none.cast(kind).alias("top")))),
    ).withColumn("_row", F.lit(-1).cast("bigint"))

    # a node deeper than every rule's is under none but theirs
    deepest = rules.agg(F.max(F.size(F.split("node", r"\.")))).first()[0] or 1
    labels = F.split("host", r"\.")
    points = urls.where("host <> ''").select("_row", "path", F.explode(F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - deepest + 1), F.size(labels)), lambda i: _node(F.slice(labels, i, F.size(labels))))).alias("node"))
    points = points.join(rules.select("node").distinct(), "node", "left_semi").select(
        "node", _key(F.col("path")).alias("key"), F.lit(1).alias("kind"), F.lit(0).alias("delta"), none.cast(kind).alias("top"), "_row")

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["node", "key", "kind", "_row"]
    events = materialize(edges.unionByName(points).repartitionByRange(n, *order).withColumn("block", F.spark_partition_id()), "sweep")

    totals = events.groupBy("block").agg(F.sum("delta").alias("delta"))
    opened = totals.select("block", (F.sum("delta").over(Window.orderBy("block")) - F.col("delta")).alias("open"))
    swept = (events.join(opened, "block")
             .withColumn("depth", F.col("open") + F.sum("delta").over(
                 Window.partitionBy("block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .withColumn("last", F.last("top", ignorenulls=True).over(
                 Window.partitionBy("block", "depth").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .where("kind < 2 AND depth > 0"))
    # what is open at the start of a block: for each depth, the last start in an earlier block
    starts = (swept.where("kind = 0").groupBy("block", "depth").agg(F.max_by("top", F.struct(*order)).alias("top")))
    asked = opened.where("open > 0").select("block", F.explode(F.sequence(F.lit(1).cast("bigint"), "open")).alias("depth"))
    earlier = Window.partitionBy("depth").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (asked.join(starts, ["block", "depth"], "full").withColumn("carried", F.last("top", ignorenulls=True).over(earlier))
               .select("block", "depth", "carried"))
    found = swept.where("kind = 1").join(carried, ["block", "depth"], "left").select(
        "_row", F.coalesce("last", "carried").alias("top"))
    best = F.max_by("top", F.struct(F.length("top.rule"), "top.host_length", "top.verdict"))
    return found.groupBy("_row").agg(best.alias("top")).select(
        "_row", F.col("top.rule").alias("rule"), F.col("top.verdict").alias("rule_verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page."""
    host, path = url_parts(F.col(url_col))
    urls = materialize(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")).withColumn(
        "_row", F.monotonically_increasing_id()), "urls")
    return urls.join(longest_rules(urls, rules), "_row", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict"))
