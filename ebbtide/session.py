"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "ebbtide", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session for scripts and tests. On a cluster the submitter's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    Enough where executors see the driver's folders; elsewhere ship it with ``--py-files``.
    """
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


# --- fixed values: a Spark setting and its default -----------------------------------------------
BATCH_SETTING, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bound_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Keep Arrow batches of long texts small, unless the session has a bound of its own.

    A worker holds a batch several times over (received, as Python objects, as results),
    so 64 MB a batch is a large share of an executor's memory.
    """
    if spark.conf.get(BATCH_SETTING, None) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, str(size))


def _setting(spark: SparkSession, key: str) -> str | None:
    return spark.conf.get(key, None) or spark.sparkContext.getConf().get(key, None)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one machine, gets a
    temporary folder when the setting is absent.
    """
    sc = spark.sparkContext
    folder = _setting(spark, "spark.checkpoint.dir") or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="ebbtide-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and go on from there.

    Cuts the lineage on storage that outlives any executor, fixes ids drawn from
    partitions, and lets later readers prune columns.
    """
    path = scratch(df.sparkSession, "settled")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(spark: SparkSession, name: str) -> str:
    """New path in the shared folder for an intermediate table."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
