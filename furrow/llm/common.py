"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyarrow import parquet
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from furrow.session import ensure_checkpoint_dir
from furrow.session import ship_package
from furrow.session import written_table as written
from furrow.sources.tables import read_table

# Bytes of text that one numpy step handles at a time inside a task; a longer single text is a step of its own.
STEP_BYTES = 1 << 20

# Rows of an Arrow batch where the session has Spark's default: whole texts make large batches, which a Python worker
# and the JVM beside it hold a few of at a time.
BATCH_KEY, DEFAULT_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"


def ship(spark: SparkSession) -> None:
    """Make the session ready for Python tasks over texts: the package in the workers, batches of fewer rows."""
    ship_package(spark)
    if spark.conf.get(BATCH_KEY) == DEFAULT_ROWS:
        spark.conf.set(BATCH_KEY, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, through Spark's reader; makes the package importable in Python workers."""
    ship(spark)
    return read_table(spark, sf_dir, name)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), f"furrow-{name}-{uuid.uuid4().hex}")


def read_shared(folder: str) -> pa.Table | None:
    """Inside a task: the Parquet files of a folder below the shared one; None if there are none."""
    system, root = arrow_fs.FileSystem.from_uri(folder) if "://" in folder else (arrow_fs.LocalFileSystem(), folder)
    files = sorted(f.path for f in system.get_file_info(arrow_fs.FileSelector(root, allow_not_found=True)) if f.path.endswith(".parquet"))
    return pa.concat_tables([parquet.read_table(f, filesystem=system, partitioning=None) for f in files]) if files else None


def sample_by_hash(df: DataFrame, key: str, n: int) -> list[Row]:
    """The ``n`` rows with the least values of the hash column ``key``. The tasks hand over only rows below a threshold that
    about 4n rows pass, so what reaches the driver doesn't grow with the table."""
    total = df.count()
    if total > 8 * n:
        low = df.where(F.col(key) < -(1 << 63) + int(4 * n / total * 2**64))
        picked = low.orderBy(key).limit(n).collect()
        if len(picked) == n:
            return picked
    return df.orderBy(key).limit(n).collect()


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_row(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct."""
    return F.struct(*[quoted(c).alias(c) for c in df.columns]).alias(name)


def collapsed(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def binary_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; null counts as empty."""
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    arr = arr.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    _, offs, data = arr.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64, count=arr.offset + len(arr) + 1)[arr.offset:]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; at least one row."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi
