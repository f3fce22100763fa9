"""Ingest of files as they arrive: a stream of Parquet files, checked and appended batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from casemill.session import remove
from casemill.sources.tables import blanks_as_nulls


def arrivals(spark: SparkSession, folder: str, schema: T.StructType, *, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the rows of all files of a folder; empty texts are null."""
    return blanks_as_nulls(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder))


def ingest_arrivals(spark: SparkSession, folder: str, schema: T.StructType, target: str, checkpoint: str, *, files_per_batch: int = 1000):
    """Takes in what has arrived since last time, then stops.

    Each batch is a folder of its own number, replaced if the batch runs again, so a batch that is
    repeated after a crash isn't counted twice.
    """

    def load(batch: DataFrame, number: int) -> None:
        path = f"{target.rstrip('/')}/batch={number}"
        remove(spark, path)
        batch.write.parquet(path)

    query = arrivals(spark, folder, schema, files_per_batch=files_per_batch).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def arrived(spark: SparkSession, schema: T.StructType, target: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{target.rstrip('/')}/batch=*")
