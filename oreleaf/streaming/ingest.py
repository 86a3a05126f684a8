"""Incremental ingest: new files since the last run, one micro-batch at a time.

The stream's checkpoint remembers which files were seen, so a rerun costs only
what is new. It never replays a paper that failed; retries follow from the
manifest in a batch run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from oreleaf.sources.papers import BINARY_FILE, decoded_name, file_name


def paper_stream(spark: SparkSession, directory: str, files_per_batch: int | None = None) -> DataFrame:
    """New ``*.pdf`` files of a directory as a stream of (paper_id, path, ...)."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE)
              .option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "false"))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(directory)
    return files.select(file_name(F.col("path")).alias("paper_id"), *files.columns)


def tei_stream(spark: SparkSession, directory: str, files_per_batch: int | None = None) -> DataFrame:
    """New TEI files of a directory as a stream of (paper_id, tei_xml)."""
    reader = spark.readStream.option("wholetext", True).option("pathGlobFilter", "*.xml")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(directory).select(
        decoded_name(F.col("_metadata.file_path")).alias("paper_id"), F.col("value").alias("tei_xml"))


def ingest(stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``process(batch, batch_id)`` over everything that is new, then stop.

    ``process`` must be repeatable for a batch id: after a failure the last
    micro-batch is handed over again.
    """
    query = (stream.writeStream.foreachBatch(process)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
