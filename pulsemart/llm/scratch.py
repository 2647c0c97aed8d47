"""Tables that an operator writes for itself and removes again.

A run's tables lie under one folder of the shared checkpoint directory.  Each is
removed as soon as its last reader has run, so the disk an operator holds follows
its widest step, not the sum of its steps.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from pulsemart.session import work_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """The scratch tables of one run.  With ``tidy`` the shuffle files of a table's job
    are removed when it is written, not when the driver's garbage collector finds them."""

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False) -> None:
        self.spark = spark
        self.tidy = tidy
        self.base = work_dir(spark, "llm", name, fresh=True)

    @contextmanager
    def tidied(self) -> Iterator[None]:
        """Jobs inside remove their shuffle files at their end, if the tables are ``tidy``."""
        before = self.spark.conf.get(_CLEANUP)
        if self.tidy:
            self.spark.conf.set(_CLEANUP, "true")
        try:
            yield
        finally:
            self.spark.conf.set(_CLEANUP, before)

    def store(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """``df`` written as table ``name`` and read back."""
        path = f"{self.base}/{name}"
        writer = df.write.mode("overwrite")
        with self.tidied():
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that nothing will read again, and let Spark remove the
        shuffle files of jobs that are over: it does so once the driver's
        garbage collector finds them unused."""
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = path_of(f"{self.base}/{name}")
            path.getFileSystem(conf).delete(path, True)
        gc.collect()
        self.spark._jvm.System.gc()
