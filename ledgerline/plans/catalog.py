"""Lazy access to the landed tables of one scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


class Tables:
    """``t.lineitem`` -> ``spark.read.parquet(f"{sf_dir}/lineitem.parquet")``.

    Reads are lazy: projections and filters in the queries reach the
    Parquet scan (``ReadSchema`` / ``PushedFilters``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
