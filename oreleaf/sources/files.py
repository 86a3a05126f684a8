"""Small questions to the file system a path lives on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _file_system(spark, path)
    return fs.exists(jvm_path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none when it does not exist."""
    jvm_path, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jvm_path)] if fs.exists(jvm_path) else []


def read_text(spark: SparkSession, path: str) -> str:
    jvm_path, fs = _file_system(spark, path)
    stream = fs.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    jvm_path, fs = _file_system(spark, path)
    stream = fs.create(jvm_path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def moved(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; fails where the target exists."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(source).toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context.rename(path(source), path(target), no_options)


def deleted(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    jvm_path, fs = _file_system(spark, path)
    fs.delete(jvm_path, True)
