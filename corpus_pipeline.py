"""The corpus pipeline: documents to clean, mixed, sharded training documents.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor
kept; its result is written as Parquet and read again as the next one's input.
All stages but the last return the columns of documents, whatever these are
called and however many there are.

Defined cases of every stage: an empty table gives an empty one; a null text is
an empty one, which stays (it has no toxic word, no near copy and no benchmark
window, and fills no share of the mix); null and repeated ids are told apart by
their texts; extra columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.llm import decontaminate, mixing, neardup, sharding, toxicity
from pulsemart.llm.common import (
    bounded_batches, broadcast_small, documents, rows_again, stored, table, text_hash, whole_rows, working_tables,
)
from pulsemart.llm.scratch import Scratch

N_SHARDS = 24
KEY_BYTES = 48                       # an id and a text hash in memory
BATCH_BYTES = "2m"                   # texts sent to a Python task at a time


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold.  A row is kept or dropped in the
    scoring pass; of equal rows all or none stay."""
    labels = table(bounded_batches(spark, BATCH_BYTES), sf_dir, "labels")
    return toxicity.without_toxic_rows(docs, labels)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest (id, text hash); of
    equal rows one.  Documents without a word are near copies of nothing: all stay.

    What goes is listed by id and text hash.  A list within the bound is sent to the
    tasks; a longer one is joined, which shuffles the texts once.
    """
    with working_tables(bounded_batches(spark, BATCH_BYTES)):
        found = neardup.near_duplicates(docs).select("doc_id", "text_hash", "component", "kept")
        found = stored(found.filter("component is not null"), "near_found")
        kept = found.filter("kept").groupBy("component").agg(F.min("text_hash").alias("first"))
        lost = found.join(kept, "component").filter(~F.col("kept") | (F.col("text_hash") != F.col("first")))
        once = found.join(kept, "component").filter(F.col("kept") & (F.col("text_hash") == F.col("first")))
        again = once.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        columns = [F.col("doc_id").alias("d"), F.col("text_hash").alias("h")]
        listed = Scratch(spark, "pipeline_near").store(
            lost.select(*columns, F.lit(True).alias("lost")).distinct().unionByName(
                again.select(*columns, F.lit(False).alias("lost"))), "listed")
    rows = whole_rows(docs).join(broadcast_small(listed, KEY_BYTES), _own_key(), "left")
    single = rows_again(rows.filter("lost is null"), docs)
    equal = rows_again(rows.filter("not lost"), docs)
    if listed.filter("not lost").limit(1).count():
        single = single.unionByName(equal.dropDuplicates(["doc_id", "text"]))
    return single


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item, kept or dropped in the
    probing pass."""
    benchmark = table(bounded_batches(spark, BATCH_BYTES), sf_dir, "benchmark")
    return decontaminate.without_benchmark_rows(docs, benchmark)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; equal rows are taken equally often."""
    return mixing.mixed_rows(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot."""
    return sharding.shard_by_bytes(docs, N_SHARDS)


def _own_key():
    return F.col("row.doc_id").eqNullSafe(F.col("d")) & (text_hash(F.col("row.text")) == F.col("h"))


STAGES = [
    ("toxicity", without_toxic),
    ("minhash_near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

ORACLE_SQL = None                  # the trained classifier has no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
