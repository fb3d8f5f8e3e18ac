"""Sources (§2.1): landed sheets, CSV exports, JSON documents, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip spaces from column names (drifting sheet headers)."""
    return df.toDF(*[c.strip() for c in df.columns])


def scan_sheet(spark: SparkSession, path: str, columns: dict[str, list[str]] | None = None) -> DataFrame:
    """A landed tab as all-string records, first row = header, no inference.
    ``columns = {canonical: [accepted header spellings]}`` renames drifting
    headers (trailing spaces, typos, 'Entry ID' vs 'EntryID')."""
    df = trim_headers(spark.read.option("header", True).option("inferSchema", False).csv(path))
    if columns:
        present = set(df.columns)
        sel = []
        for canon, names in columns.items():
            hit = next((n for n in [canon, *names] if n in present), None)
            sel.append((F.col(f"`{hit}`") if hit else F.lit(None).cast("string")).alias(canon))
        df = df.select(*sel)
    return df


scan_csv_export = scan_sheet


def scan_unformatted(spark: SparkSession, path: str, numeric_cols, columns=None, dtype: str = "decimal(18,4)") -> DataFrame:
    """Raw numeric cells read as text and ``try_cast`` -- never inferred
    from display-rounded text."""
    df = scan_sheet(spark, path, columns)
    return df.withColumns({c: F.regexp_replace(F.col(c), ",", "").try_cast(dtype) for c in numeric_cols})


def scan_tabs_union(spark: SparkSession, paths, transform=None, columns=None) -> DataFrame:
    """Same transform over several yearly tabs, concatenated by name."""
    out = None
    for p in paths:
        d = scan_sheet(spark, p, columns)
        d = transform(d) if transform else d
        d = d.withColumn("_source", F.lit(p))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def scan_table(spark: SparkSession, path: str, cols=None, eq: dict | None = None) -> DataFrame:
    """Full table read with optional equality filters and column list
    (both pushed into the Parquet scan)."""
    df = spark.read.parquet(path)
    for k, v in (eq or {}).items():
        df = df.where(F.col(k) == F.lit(v))
    return df.select(*cols) if cols else df


def scan_json_docs(spark: SparkSession, path: str, schema: T.StructType, date_col: str | None = None, since=None) -> DataFrame:
    """Landed JSON pages with a declared schema; optional ``date >= since``."""
    df = spark.read.schema(schema).json(path)
    if date_col and since is not None:
        df = df.where(F.col(date_col) >= F.lit(since).cast("date"))
    return df


def scan_measurements(spark: SparkSession, path: str, schema: T.StructType, ts_col: str = "timestamp", start=None, end=None,
                      stream: bool = False) -> DataFrame:
    """Long sensor items for a UTC range; ``stream=True`` gives the
    Structured Streaming source over the same landing folder."""
    if stream:
        return spark.readStream.schema(schema).json(path)
    df = spark.read.schema(schema).json(path)
    ts = F.to_timestamp(F.col(ts_col))
    if start is not None:
        df = df.where(ts >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(ts < F.lit(end).cast("timestamp"))
    return df


def distinct_seed(df: DataFrame, c: str, out: str = "name") -> DataFrame:
    """Dimension rows from distinct non-blank cell values."""
    v = F.regexp_replace(F.col(c).cast("string"), r"^\s+|\s+$", "")
    return df.select(v.alias(out)).where(F.col(out).isNotNull() & (F.col(out) != "")).distinct()


def static_dim(spark: SparkSession, rows, schema) -> DataFrame:
    """Hand-listed reference rows; a join broadcasts them if they are small enough for the session."""
    return spark.createDataFrame(rows, schema)


def catalog_columns(spark: SparkSession, db: str | None = None) -> DataFrame:
    """Tables / views with column name and type, as a DataFrame."""
    rows = []
    for t in spark.catalog.listTables(db):
        for c in spark.catalog.listColumns(t.name, db):
            rows.append((t.name, t.tableType, c.name, c.dataType))
    return spark.createDataFrame(rows, "table_name string, table_type string, column_name string, data_type string")
