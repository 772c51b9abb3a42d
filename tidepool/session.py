"""Session construction and the shared checkpoint folder.

Every operator in the package is a plain ``DataFrame -> DataFrame`` function
and works with any session; this module only supplies sensible defaults for
local runs (tests, bench) and resolves where lineage may be cut.
"""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession

# Defaults that matter at scale: adaptive execution re-plans joins and
# shuffle sizes at runtime and splits skewed join partitions; UTC keeps
# timestamp rendering independent of the machine.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # raw HTML rows are wide: smaller Arrow batches for the page walker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.ui.enabled": "false",
    # delete reliable checkpoint files once their frames are unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tidepool",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; it is only invented
    here when unset and the master is local (tests), never on a cluster.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            d = None
    if d:
        return d
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="tidepool-ckpt-")
    spark.sparkContext.setCheckpointDir(d)  # a core setting: not changeable through spark.conf
    return d


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table;
    removed when the driver's Python ends, or by ``purge_scratch``."""
    base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tidepool/{name}-{os.urandom(6).hex()}"
    _SCRATCH.append((spark, path))
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the session's file systems, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def purge_scratch() -> None:
    """Remove the scratch tables written so far; call when no result that
    reads them is used any more."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone at exit
            return


atexit.register(purge_scratch)
