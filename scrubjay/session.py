"""Session helpers.

The library never creates machine-local temporary folders: scratch output
(CSV round trips, saved tables) goes below ``spark.checkpoint.dir``, which a
cluster points at shared storage. Only under a ``local`` master (unit tests, a laptop)
is one set where it is absent; on a cluster that is an error. What was written
is removed by ``drop_scratch`` once its readers are done.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

def get_session(master: str | None = None, app_name: str = "scrubjay",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings the operators assume.

    AQE stays on so Spark can coalesce small shuffle partitions, split skewed
    join partitions and switch to broadcast joins at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder from the session, setting a local one only if unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        try:  # classic sessions may carry it on the context instead
            path = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - e.g. Spark Connect has no SparkContext
            path = None
    if not path:
        master = spark.conf.get("spark.master", "") or ""
        if not re.match(r"local($|\[)", master):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="scrubjay-")  # one process reads and writes it
        spark.conf.set("spark.checkpoint.dir", path)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application, through Spark's own file distribution.

    Only the few operators with numpy inside tasks need it; where the package is installed it is harmless.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="scrubjay-"), "scrubjay_core.zip")  # read by the driver alone
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("scrubjay", os.path.relpath(full, top)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scrubjay/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> bool:
    """Delete a folder that ``scratch_path`` named, through Hadoop's file system; refuses any other path."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + "/scrubjay/"
    if not path.startswith(base) or ".." in path:
        raise ValueError(f"{path} is not scratch of this session")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def cut_lineage(df, name: str = "lineage", partition_by: list[str] | None = None):
    """Write ``df`` as Parquet below the shared checkpoint folder and continue from the files.

    Used where a frame feeds several jobs (statistics plus the output): the
    expensive upstream (scan, shuffle, sort) runs once, a lost executor re-reads
    the files instead of recomputing the lineage, and later jobs read back only
    the columns they need (columnar, pruned), which ``checkpoint()``'s
    row-serialised files cannot offer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)
    # Folders of partitions hold no file at all where there is no row, so their schema is given.
    return (spark.read.schema(df.schema) if partition_by else spark.read).parquet(path)


def cut_lineage_observed(df, metrics: dict, name: str = "lineage"):
    """``cut_lineage`` that also returns aggregate ``metrics`` gathered during the write.

    The metrics (e.g. null or non-null counts) ride on the write job through
    ``DataFrame.observe``, so the statistics that decide the next steps cost no
    extra pass over the data.
    """
    from pyspark.sql import Observation

    obs = Observation(f"scrubjay_{name}")
    out = cut_lineage(df.observe(obs, *[v.alias(k) for k, v in metrics.items()]), name)
    return out, dict(obs.get)


__all__ = ["get_session", "ensure_checkpoint_dir", "ship_package", "scratch_path", "drop_scratch", "cut_lineage", "cut_lineage_observed"]
