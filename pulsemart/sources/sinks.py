"""Sinks: topics (S3), keyed tables and documents (S4, S5), the day-partitioned
tables (S4, S7-S9) and the console (S10).  Keyed tables lie in hash buckets
(``sources.buckets``): a batch rewrites only the buckets it hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.sources import buckets


def write_topics(routed: DataFrame, path: str, mode: str = "append") -> None:
    """S3 in file form: one JSON record (key, value) per row under ``path/topic=<name>/``."""
    routed.select("topic", "key", "value").write.mode(mode).partitionBy("topic").json(path)


def topic_options(bootstrap: str, topic: str | None = None) -> dict[str, str]:
    """Options of Spark's topic connector for a sink: the cluster, acknowledged by all
    replicas, and the topic unless rows carry a ``topic`` column."""
    options = {"kafka.bootstrap.servers": bootstrap, "kafka.acks": "all"}
    return {**options, "topic": topic} if topic else options


def send_topics(routed: DataFrame, bootstrap: str) -> None:
    """S3 to a named cluster: each record goes to its ``topic`` under its key, so
    the records of a key stay in order.  Spark's error is raised where the connector
    is missing."""
    records = routed.select("topic", F.col("key").cast("string").alias("key"), "value")
    records.write.format("kafka").options(**topic_options(bootstrap)).save()


def upsert(
    df: DataFrame, path: str, batch_id: int, key: str, order: str | None = None, tiebreak: str | None = None,
    n_buckets: int = buckets.BUCKETS,
) -> list[int]:
    """Upsert one batch of keyed rows; a replayed batch changes nothing.  Returns
    the buckets rewritten."""
    return buckets.merge(df, path, batch_id, key, order, tiebreak, n_buckets)


def upsert_documents(df: DataFrame, path: str, batch_id: int, id_col: str = "doc_id", **options) -> list[int]:
    """Like ``upsert``; a document without id gets a generated one."""
    return upsert(df.withColumn(id_col, F.coalesce(F.col(id_col), F.expr("uuid()"))), path, batch_id, id_col, **options)


def read_upserted(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as the committed batches left it: one row per key."""
    return buckets.read(spark, path)


# --- rollups: partial sums of a stream's batches -----------------------------------

BATCH_COL = "_batch"
COUNTS = "batch long, raw long, not_seen long, distinct long"


def write_rollup(sums: DataFrame, path: str, batch_id: int) -> None:
    """One batch's partial sums; a replayed batch replaces its own.  A few rows a batch
    (a row per hour it touches), in one file."""
    sums.coalesce(1).withColumn(BATCH_COL, F.lit(int(batch_id))).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(BATCH_COL).parquet(path)


def has_rollup(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether a batch's partial sums are there (file listing only)."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/{BATCH_COL}={int(batch_id)}/*.parquet")
    return len(fs.globStatus(p) or []) > 0


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The partial sums of all batches, to be added up."""
    return spark.read.parquet(path).drop(BATCH_COL)


def upper_case_columns(df: DataFrame) -> DataFrame:
    """Storage column names in upper case (the reference's table layout)."""
    return df.toDF(*[c.upper() for c in df.columns])


def console(df: DataFrame, n: int = 20) -> None:
    """Debug print."""
    df.show(n, truncate=False)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


# --- the DAU table: one row per (device, log day), partitioned by day ----------

DAU_PARTITION = "LOGDATE"


def write_dau_rows(rows: DataFrame, path: str) -> None:
    """S4 + P12 for the DAU table: append new device-days, upper-case columns,
    partitioned by log day so readers prune by date (S9)."""
    upper_case_columns(rows).write.mode("append").partitionBy(DAU_PARTITION).parquet(path)


def _has_data(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists and holds anything besides hidden/marker files
    (file listing only)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))


def read_dau_table(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame | None:
    """The stored DAU table with lower-case columns; ``days`` prunes
    partitions.  A table that holds no rows yet reads as None."""
    if not _has_data(spark, path):
        return None
    df = spark.read.parquet(path)
    # Partition discovery types the day folders as dates; the column is the
    # reference's yyyy-MM-dd string.  The filter reads only partition values,
    # so it still prunes folders.
    df = df.withColumn(DAU_PARTITION, F.col(DAU_PARTITION).cast("string"))
    if days is not None:
        df = df.where(F.col(DAU_PARTITION).isin(days))
    return df.toDF(*[c.lower() for c in df.columns])


ORDER_PARTITION = "CREATE_DATE"


def write_order_rows(rows: DataFrame, path: str) -> None:
    """S4 + P12 for the order table: upper-case columns, partitioned by day."""
    upper_case_columns(rows).write.mode("append").partitionBy(ORDER_PARTITION).parquet(path)


def read_order_table(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """The stored order table with lower-case columns; ``days`` prunes partitions."""
    df = spark.read.parquet(path).withColumn(ORDER_PARTITION, F.col(ORDER_PARTITION).cast("string"))
    if days is not None:
        df = df.where(F.col(ORDER_PARTITION).isin(days))
    return df.toDF(*[c.lower() for c in df.columns])


# --- small files of the DAU table -------------------------------------------------

TARGET_FILE_BYTES = 128 << 20     # about one file per 128 MB after compaction


def dau_day_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files per day partition of the DAU table (file listing only)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    out = {}
    prefix = f"{DAU_PARTITION}="
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            files = [f for f in fs.listStatus(st.getPath()) if not f.getPath().getName().startswith(("_", "."))]
            out[name[len(prefix):]] = len(files)
    return out


def compact_dau_days(spark: SparkSession, path: str, days: list[str] | None = None) -> list[str]:
    """Rewrite day partitions of the DAU table into files of about
    ``TARGET_FILE_BYTES`` (each micro-batch appends its own small files).

    The days' rows are first written to a staging table next to the table;
    then exactly those day partitions are replaced from it (dynamic partition
    overwrite) and the staging table is deleted.  A finished staging table
    found at start is applied first, so a run that died while replacing is
    completed by the next call -- the writer calls this before it reads the
    table.  The rows do not change, only their files.  Returns the days
    rewritten.
    """
    staging = f"{path.rstrip('/')}.compacting"
    fs, st_path = _fs(spark, staging)
    if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{staging}/_SUCCESS")):
        _replace_days(spark, path, staging)
    if fs.exists(st_path):
        fs.delete(st_path, True)
    if not days:
        return []
    table = read_dau_table(spark, path, days)
    if table is None:
        return []
    # Files per day from the day's size (listing only).  Each day is spread
    # over that many tasks by a hash of the device, so no task ever holds a
    # whole day; a small day stays one file.
    per_day = {}
    for d in days:
        dfs, dp = _fs(spark, f"{path.rstrip('/')}/{DAU_PARTITION}={d}")
        size = dfs.getContentSummary(dp).getLength() if dfs.exists(dp) else 0
        per_day[d] = max(1, -(-size // TARGET_FILE_BYTES))
    day_col, mid = F.col(DAU_PARTITION), F.col("MID")
    salt = F.lit(0)
    for d, n in per_day.items():
        if n > 1:
            salt = F.when(day_col == d, F.pmod(F.xxhash64(mid), F.lit(n))).otherwise(salt)
    rows = upper_case_columns(table).withColumn("_salt", salt)
    (
        rows.repartition(sum(per_day.values()), DAU_PARTITION, "_salt")
        .drop("_salt")
        .write.partitionBy(DAU_PARTITION)
        .parquet(staging)
    )
    _replace_days(spark, path, staging)
    fs.delete(st_path, True)
    return list(days)


def _replace_days(spark: SparkSession, path: str, staging: str) -> None:
    staged = spark.read.parquet(staging)
    staged = staged.withColumn(DAU_PARTITION, F.col(DAU_PARTITION).cast("string"))
    (
        staged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAU_PARTITION)
        .parquet(path)
    )
