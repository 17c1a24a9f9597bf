"""Session settings and shared scratch locations.

Everything that writes files (format round trips, batch loads, manifests)
writes below one shared root: the directory the cluster names in
``spark.checkpoint.dir``.  On a cluster that folder is on shared storage, so a
lost executor or a restarted driver still finds what was written.  A session
without the setting gets a folder of its own only in local mode, where driver
and executors are one process; on a cluster it is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this library relies on.  Timestamps are compared and
# printed in UTC, as in the reference pipeline.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition directory values such as '001' must stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(master: str = "local[*]", app: str = "sluice",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and the benchmark; clusters bring their own session."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for key, value in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession, force: bool = False) -> None:
    """Apply the runtime settings to a session built elsewhere (once per session)."""
    if getattr(spark, "_sluice_conf_applied", False) and not force:
        return
    for key, value in BASE_CONF.items():
        spark.conf.set(key, value)
    spark._sluice_conf_applied = True


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; raises on a cluster without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory path under the shared root, unique per call."""
    return f"{checkpoint_root(spark)}/sluice/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` of the Hadoop file system that owns ``path``."""
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(sc._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = hadoop_path(spark, path)
    return bool(fs.exists(hpath))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder: one listing call, no recursion."""
    fs, hpath = hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath)]


def switch_into_place(spark: SparkSession, written: str, target: str) -> None:
    """Put a finished dataset where ``target`` is; the old one goes only then."""
    fs, old = hadoop_path(spark, target)
    _, new = hadoop_path(spark, written)
    if fs.exists(old):
        _, aside = hadoop_path(spark, f"{target.rstrip('/')}__old-{uuid.uuid4().hex[:12]}")
        if not fs.rename(old, aside):
            raise OSError(f"cannot set {target} aside")
        if not fs.rename(new, old):
            fs.rename(aside, old)
            raise OSError(f"cannot move {written} to {target}")
        fs.delete(aside, True)
    elif not fs.rename(new, old):
        raise OSError(f"cannot move {written} to {target}")
