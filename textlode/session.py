"""Session settings the library is tuned for, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "textlode", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans assume; `conf` overrides any of them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    A local-mode session without the setting gets a fresh temporary folder;
    on a cluster a missing setting is an error, since a folder of one machine
    is lost with that machine.
    """
    global _local_dir
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="textlode-")
    return _local_dir


def work_dir(spark: SparkSession) -> str:
    """The folder of this application under the shared folder."""
    return f"{shared_dir(spark)}/textlode-{spark.sparkContext.applicationId}"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder name under the application's folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Deletes the application's folder, once no result is read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
