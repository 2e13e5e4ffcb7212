"""Session helpers: a local session for tests/bench and checkpoint-dir handling.

On a cluster the session is created by the platform; nothing here overrides
settings that are already present.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every query in this package is written for.  They are applied only
# when the session is built here (tests, bench); a cluster session keeps its own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "8", shuffle_partitions: int | None = None,
                  app_name: str = "churnlens") -> SparkSession:
    """Build (or reuse) a local-mode session with the package defaults."""
    cpus = str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.driver.memory", os.environ.get("CHURNLENS_DRIVER_MEMORY", "16g"))
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` (or a directory already set on the context) wins.
    Only a local-mode session without one gets a fresh scratch folder; a
    cluster session without a shared folder is an error, because a
    machine-local path would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):   # local-cluster is a cluster
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    scratch = tempfile.mkdtemp(prefix="churnlens-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Give every Python worker this package, also where the cluster was started
    without ``--py-files``: a zip of the sources goes out with ``addPyFile``."""
    sc = spark.sparkContext
    if getattr(sc, "_churnlens_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(here):  # already imported from a shipped zip otherwise
        root = os.path.dirname(here)
        target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="churnlens-src-")), "churnlens.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(here):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, root))
        sc.addPyFile(target)
    sc._churnlens_shipped = True
