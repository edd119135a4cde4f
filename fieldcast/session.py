"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

_LOCAL_ROOT: dict[str, str] = {}


def build_session(app_name: str = "fieldcast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    On a cluster leave ``master`` unset (spark-submit supplies it) and size
    ``spark.sql.shuffle.partitions`` to a small multiple of the total cores;
    AQE then coalesces small partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOT:
        _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="fieldcast-")
        spark.sparkContext.setCheckpointDir(_LOCAL_ROOT[app])
    return _LOCAL_ROOT[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_root`; never reused, so a rerun cannot see old files."""
    return os.path.join(shared_root(spark), "fieldcast", f"{label}-{uuid.uuid4().hex}")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def send_with_tasks(module: str) -> None:
    """Send a module's functions along with the tasks that call them, so executors need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
