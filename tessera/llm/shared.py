"""Tables that cut lineage, kept in the folder the cluster shares."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.broadcast import checked_broadcast

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without that setting (tests), whose executors share the
    driver's disk, gets a folder of its own, once; a cluster must name one.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tessera-llm-")
        spark.conf.set(CHECKPOINT_DIR, named)
    return named.rstrip("/")


def materialize(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Readers then see fixed rows, whatever happens to executors later, and
    nothing upstream runs twice.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = "4m"


def arrow_tasks(docs: DataFrame) -> DataFrame:
    """``docs``, to be handed to Python tasks.

    Bounds the Arrow batches of the session by bytes (they are bounded by rows
    otherwise, and rows may be long texts), unless a setting other than
    Spark's own default was chosen.
    """
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, "64m").lower() in ("64m", "64mb", "67108864", "67108864b", "-1", "2147483647", "2147483647b"):
        conf.set(key, BATCH_BYTES)
    return docs


def tidy(task):
    """``task`` (a function of Arrow batches), giving the memory it freed back to the system.

    Python workers live on from task to task, and what the C library keeps of
    one stage would be missing in the next.
    """

    def run(batches):
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return run


MOST_FACTS = 200_000  # rows of facts sent to every task; of more, both sides are shuffled


def fresh(*names: str) -> list[str]:
    """Column names that no table has."""
    end = uuid.uuid4().hex
    return [f"{name}_{end}" for name in names]


def with_facts(docs: DataFrame, facts: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with ``facts(doc_id, text_hash, ...)`` about their ``doc_id`` and text (null where there are none).

    Also returns the added columns by their names in ``facts``.  Facts are
    about few documents.  Up to ``MOST_FACTS`` of them go to the documents,
    which are then not shuffled; the join is the same either way.
    """
    facts = materialize(facts.dropDuplicates(["doc_id", "text_hash"]), "facts")
    names = dict(zip(facts.columns, fresh(*facts.columns)))
    facts, _ = checked_broadcast(facts.select(*(F.col(c).alias(new) for c, new in names.items())), MOST_FACTS)
    about = docs["doc_id"].eqNullSafe(facts[names["doc_id"]]) & (F.xxhash64(docs["text"]) == facts[names["text_hash"]])
    joined = docs.join(facts, about, "left")
    return joined, {c: F.col(new) for c, new in names.items()}
