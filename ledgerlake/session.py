"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import SparkSession

DEFAULT_TIME_ZONE = "America/Sao_Paulo"

# Settings every job of this engine expects. ANSI stays on (Spark 4 default):
# tolerant casts are written explicitly with try_cast.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # remove checkpoint files once the DataFrames that use them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerlake",
    time_zone: str = DEFAULT_TIME_ZONE,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    ``time_zone`` decides the calendar date of an issue instant
    (``2021-01-29T22:32-03:00`` is the 29th in Sao Paulo, the 30th in UTC).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.session.timeZone"] = time_zone
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ship(package: str) -> None:
    """Functions of ``package`` travel to the executors with the job: nothing has to be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[package])


def _is_local(spark: SparkSession) -> bool:
    return (spark.conf.get("spark.master", "") or "").startswith("local")


def app_id(spark: SparkSession) -> str:
    """The application id (from the session's settings, so it also works over Spark Connect)."""
    return spark.conf.get("spark.app.id", None) or "app"


_LOCAL_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    A cluster must name it; only a local session (tests) gets a private
    temporary folder when it is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared folder for "
            "checkpoints and intermediate tables"
        )
    app = app_id(spark)
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="ledgerlake-")
    return _LOCAL_FALLBACK[app]


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Make ``DataFrame.checkpoint`` write to the shared folder (a Spark Connect session
    has no local context: the server's ``spark.checkpoint.dir`` applies there)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect
        return None
    current = sc.getCheckpointDir()
    if current:
        return current
    base = shared_dir(spark)
    sc.setCheckpointDir(os.path.join(base, "rdd"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder for a written table."""
    return f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and the path as it knows it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder or file the engine wrote to shared storage."""
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def path_exists_any(spark: SparkSession, pattern: str) -> bool:
    """Whether anything matches a glob pattern."""
    fs, p = file_system(spark, pattern)
    return bool(fs.globStatus(p))


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Apply SQL settings for the duration of a stage and restore the previous values."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
