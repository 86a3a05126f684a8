"""Paper files and TEI documents as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns the binaryFile source produces.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def read_papers(spark: SparkSession, directory: str) -> DataFrame:
    """The ``*.pdf`` files directly in ``directory``; ``paper_id`` is the bare file name.

    Select the columns you need: ``content`` is only read when it is used.
    """
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "false").load(directory))
    return files.select(file_name(F.col("path")).alias("paper_id"), *files.columns)


def decoded_name(path: Column) -> Column:
    """The file name of a URL-encoded path; a plus sign stays one."""
    return F.url_decode(F.replace(file_name(path), F.lit("+"), F.lit("%2B")))


def read_tei_files(spark: SparkSession, path: str) -> DataFrame:
    """One TEI document per ``*.xml`` file; ``paper_id`` is the file name."""
    return (spark.read.option("pathGlobFilter", "*.xml").text(path, wholetext=True)
            .select(decoded_name(F.col("_metadata.file_path")).alias("paper_id"), F.col("value").alias("tei_xml")))


def read_tei_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table with ``paper_id`` and ``tei_xml``."""
    return spark.read.parquet(path).select("paper_id", "tei_xml")
