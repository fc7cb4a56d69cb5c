"""The given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Tables whose rows are expensive to work on, with the key that spreads them.
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id"}


class Tables:
    """``<folder>/<name>.parquet`` by attribute; files are listed once per table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._read = spark, folder.rstrip("/"), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            self._read[name] = spread(table, TEXT_TABLES[name]) if name in TEXT_TABLES else table
        return self._read[name]


def spread(table: DataFrame, key: str) -> DataFrame:
    """A table in fewer partitions than there are cores is spread over them, so that
    row-wise text work does not run in one task. Larger inputs stay as they are read."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, key) if table.rdd.getNumPartitions() < cores else table
