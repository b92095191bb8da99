"""Session construction and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for sessions fleetlens builds itself (bench, CLI, tests). Results do not depend on
# the time zone (timestamp_ntz throughout); UTC only makes logs and displays unambiguous.
# AQE re-plans joins and coalesces partitions from runtime sizes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Skip PySpark's per-call capture of the Python call site for error messages: it costs
    # several JVM round trips per Column function, which dominated plan construction.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def _modifiable(key: str) -> bool:
    return SparkSession.getActiveSession().conf.isModifiable(key)


def get_session(
    master: str | None = None,
    app_name: str = "fleetlens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with the fleetlens base settings applied.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces small ones away).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    running = SparkSession.getActiveSession() is not None
    for key, value in settings.items():
        # the builder sets its options on a running session too, and static ones raise there
        if not (running and key.startswith("spark.sql.") and not _modifiable(key)):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate returns an existing session unchanged: re-apply the SQL settings.
    # (Static ones, such as the warehouse folder, cannot change once a session runs.)
    for key, value in settings.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def _checkpoint_root(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir`` as configured, else a dir set with ``setCheckpointDir``."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Only when it is unset *and* Spark runs in local
    mode (tests, the driver's checks) is a local folder chosen and registered with
    ``setCheckpointDir``; on a cluster an unset value is an error, because a machine-local
    folder is not visible to other executors.
    """
    root = _checkpoint_root(spark)
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...)"
            )
        folder = tempfile.mkdtemp(prefix="fleetlens-ckpt-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)  # made here, removed here
        spark.sparkContext.setCheckpointDir(folder)
        root = spark.sparkContext.getCheckpointDir()
    # Not created here: Spark writers create it (and refuse an existing one by default).
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Remove the folder ``path`` when this Python process ends, if the session still runs."""

    def remove() -> None:
        context = spark.sparkContext
        if context._jsc is not None:
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)

    atexit.register(remove)
