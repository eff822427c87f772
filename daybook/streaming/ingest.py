"""Take in whichever feed files are new, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybook.sources.session import COMPACT


def new_messages(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over the trade feed: lines, their date and the file they came from."""
    reader = spark.readStream.schema("value string, dt date").option("basePath", root)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(root).select(
        F.col("value").alias("raw_record"),
        "dt",
        F.col("_metadata.file_path").alias("file_path"),
    )


def ingest_new_files(
    spark: SparkSession,
    root: str,
    target: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append the lines of new files to ``target`` by date, then stop.

    The checkpoint remembers finished files, so another call takes only those
    that arrived since; the file sink commits each batch once.
    """
    query = (
        new_messages(spark, root, files_per_batch)
        .writeStream.format("parquet")
        .partitionBy("dt")
        .options(path=target, **COMPACT)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
