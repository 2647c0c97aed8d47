"""Session set-up and the shared working folder.

Nothing here hard-codes a cluster.  ``configure`` only sets SQL options that
every query relies on (UTC session zone, AQE); ``work_dir`` returns the shared
folder named by ``spark.checkpoint.dir`` and creates a private one only when
the setting is absent and the master is local (tests).
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL options every query depends on.  They are safe to set on a
# session someone else built: they change planning and state storage, not
# results, except the zone, which H9 fixes to UTC so results match the SQL
# oracle.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only below a fixed, measured size: AQE converts a join to a
    # broadcast join from the runtime size of the finished shuffle stage, so
    # no side is broadcast on a guess.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # Streaming state off the JVM heap (RocksDB), committed as a per-batch
    # changelog instead of a snapshot upload: commit cost follows the rows a
    # batch changed, not the size of the state.  Both settings are stored in
    # a query's checkpoint at first start, so restarts keep what they began
    # with.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # No count of the state's rows, a progress figure that costs a lookup for
    # every row put or removed.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(
    master: str | None = None,
    app: str = "pulsemart",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session.  ``master`` is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # No Python call-site capture around every column function: four
        # driver round trips per expression when building plans, used only
        # to decorate error messages.  Read once per process, so it is a
        # build-time option.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Checkpointed sides (join.join_checked_small) are removed from the
        # shared folder once no DataFrame refers to them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **_RUNTIME_CONF,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession, *parts: str, fresh: bool = False) -> str:
    """A folder under the cluster's shared checkpoint dir.

    The dir comes from ``spark.checkpoint.dir`` (or the context's checkpoint
    dir).  Only when neither is set -- local tests -- a private folder is made
    and registered as the checkpoint dir.  ``fresh`` appends a unique leaf so a
    run never reuses another run's files.  On a cluster a missing setting is an
    error: a private folder would be a different one on every machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named and not sc.getCheckpointDir():
        sc.setCheckpointDir(named)          # the cluster's folder, for DataFrame.checkpoint()
    base = named or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="pulsemart-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    path = "/".join([base.rstrip("/"), "pulsemart", *parts])
    if fresh:
        path = f"{path}/{uuid.uuid4().hex}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path


def drop_shuffles(spark: SparkSession) -> None:
    """Has Spark drop the shuffle files of the jobs that are over: after a wide one."""
    gc.collect()
    spark._jvm.System.gc()
