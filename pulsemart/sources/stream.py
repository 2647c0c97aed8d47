"""Topic source (S1) and a time-ordered replay of tables into topic files.

``topic_stream`` yields a streaming DataFrame with one ``value`` string per
record -- what a Kafka topic carries -- from the named Kafka cluster or from the
named directory of text files (one JSON per line).

``replay`` turns a table into such a topic directory for the stream twins: one
range-partitioned write, then the files are dated in event-time order, because a
file source takes files in modification-time order (H1b).  Whatever number of
files a micro-batch takes, no later file holds an earlier row, so nothing is late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Files of JSON records repeat their field names: about a sixth of the text.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def topic_stream(
    spark: SparkSession,
    topic: str,
    path: str | None = None,
    bootstrap: str | None = None,
    max_per_trigger: int | None = None,
    max_bytes: int | None = None,
    keyed: bool = False,
) -> DataFrame:
    """A streaming DataFrame of (value) strings from ``topic``, with ``keyed`` of
    (key, value); a keyed topic directory holds JSON records of the two.

    ``bootstrap`` names a Kafka cluster: the topic is subscribed through Spark's
    connector (offsets tracked by the query checkpoint, not auto-committed --
    SURVEY D6/D7), and Spark's error is raised where the connector is missing.
    ``path`` names a directory of text files instead.  Exactly one is given.
    ``max_per_trigger`` bounds a micro-batch in offsets or files, ``max_bytes``
    (files only) in bytes.
    """
    if (bootstrap is None) == (path is None):
        raise ValueError("name either a Kafka cluster or a topic directory")
    if bootstrap is not None:
        reader = spark.readStream.format("kafka").options(**source_options(topic, bootstrap, max_per_trigger))
        columns = ["key", "value"] if keyed else ["value"]
        return reader.load().select(*[F.col(c).cast("string").alias(c) for c in columns])
    if keyed:
        reader = spark.readStream.format("json").schema("key string, value string")
    else:
        reader = spark.readStream.format("text")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.load(path)


def source_options(topic: str, bootstrap: str, max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of Spark's topic connector for a source."""
    options = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": "latest"}
    return {**options, "maxOffsetsPerTrigger": str(max_per_trigger)} if max_per_trigger else options


def replay(df: DataFrame, path: str, time_col: str, files: int, value_cols: list[str] | None = None) -> int:
    """Write ``df`` as JSON lines under ``path``, in about ``files`` files that
    follow each other in event time; returns how many were written.

    One job: rows are range-partitioned by time, so a file holds no row earlier
    than any row of the file before it.  Files already there stay the earlier ones.
    Rows without a time come first.  The columns are exchanged, not the longer JSON.
    Files are packed, and one task reads a packed file: ``files`` grows with the rows.
    """
    spark = df.sparkSession
    cols = value_cols or list(df.columns)
    payload = F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value")
    before = set(_list_names(spark, path))
    ranged = df.select(*dict.fromkeys([*cols, time_col])).repartitionByRange(files, time_col)
    ranged.select(payload).write.mode("append").options(**PACKED).text(path)
    new = sorted(n for n in _list_names(spark, path) if n.startswith("part-") and n not in before)
    _set_ages(spark, path, new)
    return len(new)


def publish(
    df: DataFrame, path: str, value_cols: list[str] | None = None, value=None, records_per_file: int = 0
) -> None:
    """Write ``df`` as one topic of JSON lines in a single job.

    For consumers that do not depend on arrival order (no watermark, or
    order carried inside the record), so no time slicing is needed.  The
    record is the JSON of ``value_cols`` (all columns by default) or the
    given ``value`` column.  ``records_per_file`` cuts a task's output into
    files of so many records, so that a byte-limited stream reads a topic in
    several micro-batches; nothing is shuffled for it.
    """
    if value is None:
        cols = value_cols or list(df.columns)
        value = F.to_json(F.struct(*[F.col(c) for c in cols]))
    out = df.select(value.alias("value"))
    out.write.mode("append").options(**PACKED).option("maxRecordsPerFile", str(records_per_file)).text(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (file listing only)."""
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def count_files(spark: SparkSession, path: str) -> int:
    """Data files of a topic directory (file listing only)."""
    return sum(not n.startswith(("_", ".")) for n in _list_names(spark, path))


def _set_ages(spark: SparkSession, path: str, names: list[str]) -> None:
    """Date the files a second apart in the order of their names (part numbers, so
    range order) and after all other files: a file source takes older files first."""
    fs, p = _fs(spark, path)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    others = [st.getModificationTime() for st in fs.listStatus(p) if st.getPath().getName() not in names]
    first = max([spark._jvm.System.currentTimeMillis() - 1000 * len(names), *[t + 1000 for t in others]])
    for i, name in enumerate(names):
        fs.setTimes(path_of(f"{path.rstrip('/')}/{name}"), first + 1000 * i, -1)
