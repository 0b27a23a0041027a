"""Spark session and checkpoint-folder helpers.

Library code never creates its own session: it takes the caller's.  The
builder below is for tests, the bench and the command line.  On a cluster the
platform's session (and its ``spark.checkpoint.dir``) is used as is.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on.  Times are formatted in UTC (the reference used
# the JVM default zone; we fix one).  AQE coalesces small shuffles and splits
# skewed join partitions at run time.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE merges small shuffle partitions down to this size.  Several stages
    # expand rows after the shuffle (pane -> window ends, window -> history),
    # so byte counts under-state their work; a small floor keeps them spread
    # over the cores.  At cluster scale partitions are far above it anyway.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Broadcasts are decided on measured sizes: Catalyst plan statistics first,
    # AQE runtime shuffle sizes second; anything larger is sort-merge joined.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ripplerec", extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs (never used by library code)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("RIPPLEREC_DRIVER_MEMORY", "16g")
    # Streaming state for the stateful processors.
    conf["spark.sql.streaming.stateStore.providerClass"] = (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    local_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which all executors
    share; an error if there is none."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")


def local_checkpoint_dir(spark: SparkSession) -> str:
    """``ensure_checkpoint_dir`` for one-machine sessions (tests, bench, local
    runs): a fresh scratch folder if none is set and the master is local."""
    sc = spark.sparkContext
    if not (sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)) \
            and re.match(r"local(\[|$)", sc.master):
        folder = tempfile.mkdtemp(prefix="ripplerec-ckpt-")
        spark.conf.set("spark.checkpoint.dir", folder)
        sc.setCheckpointDir(folder)
    return ensure_checkpoint_dir(spark)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def modified(spark: SparkSession, path: str) -> int:
    """Modification time of a file or folder in any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getModificationTime()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that
    tasks can import it wherever the driver was started."""
    import ripplerec
    sc = spark.sparkContext
    if getattr(sc, "_ripplerec_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(ripplerec.__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="ripplerec-zip-"), "ripplerec"), "zip",
                                  os.path.dirname(home), os.path.basename(home))
    sc.addPyFile(archive)
    sc._ripplerec_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df, name: str = "table"):
    """Write ``df`` once as a Parquet table in the checkpoint folder and read
    it back: lineage is cut, the data survives lost executors (shared
    folder), it is computed exactly once, and Catalyst sees its real size
    (so later joins broadcast it only when it is measured small)."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@contextmanager
def staged(df, name: str = "batch") -> Iterator:
    """``df`` written once in the checkpoint folder and removed at the end of the ``with`` block: a
    ``foreachBatch`` body that reads its micro-batch twice would run the stateful operators twice."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
