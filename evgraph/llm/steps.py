"""Session settings of jobs made of several steps."""

from __future__ import annotations

from pyspark.sql import SparkSession

from evgraph.session import tune

# Whole texts go to Python in Arrow batches, which both sides hold outside the heap.
BATCH_ROWS = 1000


def prepared(spark: SparkSession) -> SparkSession:
    """Steps hand written tables to each other, so a step's shuffle files can go when it ends."""
    tune(spark).conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark
