"""Session construction and cluster-facing settings.

Everything here is plain SparkSession configuration. The defaults are
chosen for a large cluster (AQE with skew-join splitting and partition
coalescing, adaptive broadcast only under a byte threshold) and are
overridable through the environment so the same code runs on local[8]
tests and on a 1000-executor job.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Adaptive broadcast threshold: AQE turns a sort-merge join into a
# broadcast hash join only when the *measured* size of one side (after its
# shuffle stage ran) is below this bound; otherwise the sort-merge plan
# stays. That is the size check for every dimension lookup in the library.
ADAPTIVE_BROADCAST_BYTES = os.environ.get("FURROW_BROADCAST_BYTES", "64MB")


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "furrow",
) -> SparkSession:
    """A session with the library's settings. Master, driver memory and
    shuffle partitions are set only when asked for (argument or
    environment), so that a submit's own values stay; without any master the
    session is local."""
    given = SparkConf()
    master = master or os.environ.get("FURROW_MASTER") or (None if given.contains("spark.master") else "local[*]")
    parts = shuffle_partitions or os.environ.get("FURROW_SHUFFLE_PARTITIONS") \
        or (8 if (master or "").startswith("local[") and not given.contains("spark.sql.shuffle.partitions") else None)
    builder = (
        SparkSession.builder
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", ADAPTIVE_BROADCAST_BYTES)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", os.environ.get("FURROW_DRIVER_MEMORY", "16g"))
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment must set it to a file system that every
    executor can read. Only a session in one process (master ``local``) gets a
    temporary folder when it is unset.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="furrow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


# Rows of a stored table that one task is to sort or join; up to eight times as many are left to the adaptive planner.
ROWS_PER_TASK = 500_000


def spread(df: DataFrame, *keys, rows: int | None = None) -> DataFrame:
    """A stored table hashed by ``keys`` into partitions of about ``rows`` rows
    at most, which a join or aggregate on the same keys takes as they are. The
    adaptive planner merges partitions by their compressed size, and sorted
    keys compress so well that a task would get many millions of rows. The
    count comes from the Parquet footers."""
    parts = parts_for(df, rows)
    return df.repartition(parts, *keys) if parts else df


def parts_for(df: DataFrame, rows: int | None = None) -> int | None:
    """How many partitions ``spread`` makes of a stored table; None: it is left as it is."""
    rows = rows or ROWS_PER_TASK
    total = df.count()
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // rows)) if total > 8 * rows else None


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's modules to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(spark.sparkContext._temp_dir, f"furrow-{app}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet under the shared checkpoint
    folder and read it back, so that later reads don't compute it again."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
