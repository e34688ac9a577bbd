"""Session construction and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps are compared as UTC wall-clock
# values (the test tables are UTC-naive), AQE re-plans joins and partition
# counts at runtime from measured shuffle sizes, and skew splitting is on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the settings above.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them to the deployment.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        # re-apply SQL settings to a session that already existed; static
        # ones (warehouse, extensions, ...) only take effect at start
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception as e:  # noqa: BLE001 - only the static-config refusal is expected
                msg = str(e)
                if "CANNOT_MODIFY_STATIC_CONFIG" not in msg and "static config" not in msg.lower():
                    raise
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment names a shared folder; it is only set here
    when nothing is configured (local runs and tests).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a session without a local SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:  # a client-local folder would not exist on the cluster
            raise ValueError("set spark.checkpoint.dir to a folder shared with the cluster")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):  # another machine would not see this one's folder
            raise ValueError("set spark.checkpoint.dir to a folder shared with the cluster")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[str] = set()  # applications whose workers have got the package


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever it was started from.

    The package goes to the executors as a zip, once per application, as
    ``spark-submit --py-files`` would send it.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tessera-code-")  # read by the driver alone, which serves it
    archive = os.path.join(folder, "tessera.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for top, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """A fresh folder name under the shared checkpoint folder, for the caller to keep or delete."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-{uuid.uuid4().hex}"


_SCRATCH: dict[str, SparkSession] = {}


def scratch(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, deleted when the driver ends at the latest."""
    path = scratch_root(spark)
    if not _SCRATCH:
        atexit.register(drop_scratch)
    _SCRATCH[path] = spark
    return path


def drop_scratch() -> None:
    """Delete the folders that :func:`scratch` handed out and that still exist."""
    for path, spark in list(_SCRATCH.items()):
        drop_folder(spark, path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete one scratch folder (nothing else) once no frame reads it any more."""
    if _SCRATCH.pop(path, None) is None:
        raise ValueError(f"not a scratch folder: {path}")
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # noqa: BLE001 - the session has ended; the folder stays
        return


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
