"""Readers for the given parquet tables.

Every reader is a plain ``spark.read.parquet``; projection and filters
written downstream are pushed into the scan by Catalyst (``ReadSchema`` /
``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Lazy attribute access to the given tables: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)
