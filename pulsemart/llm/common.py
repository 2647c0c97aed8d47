"""Column helpers and the shared scratch tables of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.session import drop_shuffles, work_dir

UPPER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_AZ = UPPER_AZ.lower()
SPACES = " \t\n\x0b\x0c\r"              # the class [\x20\x09-\x0D]
SPACE_RUN = r"[\x20\x09-\x0D]+"


def bounded_batches(spark: SparkSession, size: str) -> SparkSession:
    """Bounds the bytes of the Arrow batches that go to Python tasks: texts of a few
    kilobytes make Spark's batches of 10,000 rows tens of megabytes, several times
    over in a task that computes on them."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps read
    files that outlive any executor instead of recomputing the lineage."""
    spark = df.sparkSession
    path = work_dir(spark, "llm", name, fresh=True) + "/t"
    if _working:
        _working[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_working: list[list[str]] = []           # paths written inside the open ``working_tables`` blocks


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what ``stored`` wrote inside: for callers that have written the
    result by then.  Spark drops the shuffle files of the jobs that are over once the
    driver's garbage collector finds them unused."""
    _working.append([])
    try:
        yield
    finally:
        path_of, conf = spark._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
        for name in _working.pop():
            path = path_of(name)
            path.getFileSystem(conf).delete(path, True)
        drop_shuffles(spark)


def whole_rows(docs: DataFrame, *apart: str) -> DataFrame:
    """Each row as one struct ``row``: whatever its columns are called, none clashes.
    Columns named ``apart`` (a text that a task reads) are left out of it and follow
    as ``apart0``, ``apart1``, ..., so they are sent once."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in apart]
    return docs.select(F.struct(*rest, F.lit(0).alias("__end")).alias("row"), *[F.col(f"`{c}`").alias(f"apart{i}") for i, c in enumerate(apart)])


def rows_again(rows: DataFrame, docs: DataFrame, *apart: str) -> DataFrame:
    """The columns of ``docs``, in their order, from ``whole_rows(docs, *apart)``."""
    return rows.select(*[
        F.col(f"apart{apart.index(c)}" if c in apart else f"row.`{c}`").alias(c) for c in docs.columns
    ])


BROADCAST_BYTES = 32 << 20


def broadcast_small(keys: DataFrame, row_bytes: int) -> DataFrame:
    """``keys``, a stored table, marked for broadcast when its counted rows of
    ``row_bytes`` fit the bound."""
    return F.broadcast(keys) if keys.count() * row_bytes <= BROADCAST_BYTES else keys


def text_hash(c: Column) -> Column:
    """Tells rows of one id apart by their texts (null as empty)."""
    return F.xxhash64(F.coalesce(c, F.lit(""))).alias("text_hash")


def lower_az(c: Column) -> Column:
    """A-Z lower-cased, every other character kept.  ``lower`` does just that
    on pure ASCII and is far faster than ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER_AZ, LOWER_AZ)
    )


def words(c: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null gives none."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACE_RUN, -1), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda variable
    holds it, so references inside further lambdas don't compute it again."""
    return F.transform(F.array(value), body)[0]
