"""The manifest as a log, versioned output tables, and the CSV sink."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreleaf.operators import manifest as M
from oreleaf.operators.flattening import flatten
from oreleaf.schemas import ExtractionSchema
from oreleaf.sources import commits
from oreleaf.sources.files import children, deleted, exists, moved

_VERSION = "version="
BUCKETS = 64  # of papers; part of the layout of records and CSV folders
_BUCKET = "paper_bucket"


def bucket(paper_id: str = "paper_id") -> Column:
    """The bucket of a paper: rows of a bucket are written and replaced together."""
    return F.pmod(F.xxhash64(paper_id), F.lit(BUCKETS)).cast("int").alias(_BUCKET)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions of a versioned table, oldest first."""
    found = [int(n[len(_VERSION):]) for n in children(spark, path) if n.startswith(_VERSION)]
    return sorted(v for v in found if exists(spark, f"{path}/{_VERSION}{v}/_SUCCESS"))


def _newest(spark: SparkSession, path: str, pieces: list[dict]) -> DataFrame:
    found = spark.read.schema(f"{M.SCHEMA}, seq int").parquet(*[f"{path}/{p['name']}" for p in pieces])
    if len(pieces) == 1:
        return found
    rest = [c for c in found.columns if c != "paper_id"]
    return found.groupBy("paper_id").agg(F.max_by(F.struct(*rest), "seq").alias("m")).select("paper_id", "m.*")


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest committed manifest; None when there is none."""
    number, state = commits.latest(spark, path)
    return _newest(spark, path, state["pieces"]).drop("seq") if number else None


def commit_manifest(changed: DataFrame, path: str, number: int, afresh: bool = False) -> None:
    """Add a batch's entries to the manifest as commit ``number``; with ``afresh`` they are the whole manifest.

    The manifest is a list of pieces, and a paper's entry is that of the newest piece that has it. Entries are
    written as one piece, together with those last pieces that have no more rows than it has by then. So a paper's
    entry is rewritten about as often as the manifest doubles, and pieces grow in number with the logarithm of its size.
    Another writer's commit of this number raises :class:`~oreleaf.sources.commits.Conflict` and leaves the manifest as
    that writer made it. Pieces that a commit gives up stay for one more commit, for those who are reading them.
    """
    spark = changed.sparkSession
    known, state = commits.latest(spark, path)
    if known != number - 1:
        raise commits.Conflict(f"commit {number} of {path} is not the next one")
    listed = state.get("pieces", [])
    older = [] if afresh else list(listed)
    piece = _write_piece(changed.withColumn("seq", F.lit(number)), path, number)
    if piece["rows"] or not older:
        size, joining = piece["rows"], [piece]
        while older and older[-1]["rows"] <= size:
            joining.insert(0, older.pop())
            size += joining[0]["rows"]
        if len(joining) > 1:
            piece = _write_piece(_newest(spark, path, joining), path, number)
        older.append(piece)
    kept = {p["name"] for p in older}
    commits.commit(spark, path, number, {"pieces": older, "given_up": [p["name"] for p in listed if p["name"] not in kept]})
    for name in state.get("given_up", []):
        deleted(spark, f"{path}/{name}")


def _write_piece(entries: DataFrame, path: str, number: int) -> dict:
    name = f"piece-{number:09d}-{uuid.uuid4().hex}"
    entries.write.parquet(f"{path}/{name}")
    return {"name": name, "rows": entries.sparkSession.read.schema("seq int").parquet(f"{path}/{name}").count()}


def _csv_column(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.BooleanType):
        return F.initcap(F.col(field.name).cast("string")).alias(field.name)
    return F.col(field.name)


def _csv_writer(rows: DataFrame, fieldnames: list[str], *keep: str):
    fields = {f.name: f for f in rows.schema.fields}
    return (rows.select(*keep, *[_csv_column(fields[n]) for n in fieldnames]).write
            .option("header", True).option("quote", '"').option("escape", '"')
            .option("nullValue", "").option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_rows(rows: DataFrame, path: str, fieldnames: list[str], mode: str = "append") -> None:
    """Write rows to a CSV directory with one header per file; nulls are empty.

    Without rows nothing is appended and no directory is made, but rows that an earlier ``overwrite`` left are replaced by none.
    """
    if rows.isEmpty() and (mode == "append" or not exists(rows.sparkSession, path)):
        return
    _csv_writer(rows, fieldnames).mode(mode).csv(path)


def read_rows(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of a CSV directory; of one that :func:`export_csv` keeps, those of its newest commit."""
    number, state = commits.latest(spark, path)
    files = [f"{path}/{name}" for names in state["files"].values() for name in names] if number else [path]
    if not files:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True)
            .csv(files))


def export_csv(spark: SparkSession, table: str, papers: DataFrame, schema: ExtractionSchema, out_dir: str, tag: str) -> None:
    """Bring ``<out_dir>/<tag>_<schema>`` up to date after a batch over ``papers``; ``table`` holds the records.

    The directory holds each paper's current rows as ``*.csv`` files of buckets of papers. Only the buckets of
    ``papers`` are read and written anew; they are written aside and then take effect by one commit that names the files of
    all buckets, which :func:`read_rows` follows. Files no longer named are deleted behind it, so the directory can also be
    read as it stands, except while a batch ends. Who reads a file meanwhile fails and may read again, but never gets a part.
    Papers without rows lose the ones they had. A directory is not made for no rows.
    """
    path = f"{out_dir}/{tag}_{schema.name}"
    number, state = commits.latest(spark, path)
    touched = [r[0] for r in papers.select(bucket()).distinct().collect()] if number else list(range(BUCKETS))
    records = current_records(spark, table, touched)
    if records is None or not touched:
        return
    rows = flatten(records.withColumn(_BUCKET, bucket()), schema, (_BUCKET,)).hint("rebalance", _BUCKET)
    aside = f"{path}/_aside-{uuid.uuid4().hex}"
    _csv_writer(rows, schema.fieldnames, _BUCKET).partitionBy(_BUCKET).csv(aside)
    files = {k: names for k, names in state.get("files", {}).items() if int(k) not in touched}
    for folder in children(spark, aside):
        if folder.startswith(f"{_BUCKET}="):
            of = folder.partition("=")[2]
            files[of] = [f"bucket-{int(of):03d}-{number + 1:09d}-{uuid.uuid4().hex}.csv" for _ in _csv_names(spark, f"{aside}/{folder}")]
            for old, new in zip(_csv_names(spark, f"{aside}/{folder}"), files[of]):
                moved(spark, f"{aside}/{folder}/{old}", f"{path}/{new}")
    deleted(spark, aside)
    if not number and not files:
        deleted(spark, path)
        return
    commits.commit(spark, path, number + 1, {"files": files})
    named = {name for names in files.values() for name in names}
    for name in _csv_names(spark, path):
        if name not in named and int(name.split("-")[2]) <= number + 1:
            deleted(spark, f"{path}/{name}")


def _csv_names(spark: SparkSession, path: str) -> list[str]:
    return sorted(n for n in children(spark, path) if n.endswith(".csv"))


def write_version(df: DataFrame, path: str, version: int) -> DataFrame:
    """Write one version of a table and read it back; repeating a batch rewrites its version."""
    target = f"{path}/{_VERSION}{version}"
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def write_records(records: DataFrame, table: str, version: int) -> DataFrame:
    """Write a batch's records, those of a bucket together so that scans can skip the rest, and read them back."""
    target = f"{table}/records/{_VERSION}{version}"
    (records.withColumn(_BUCKET, bucket()).hint("rebalance", _BUCKET).sortWithinPartitions(_BUCKET)
     .write.mode("overwrite").parquet(target))
    return records.sparkSession.read.schema(records.schema).parquet(target)


def read_versions(spark: SparkSession, path: str) -> DataFrame | None:
    known = versions(spark, path)
    if not known:
        return None
    return spark.read.option("basePath", path).parquet(*[f"{path}/{_VERSION}{v}" for v in known])


def current_records(spark: SparkSession, table: str, buckets: list[int] | None = None) -> DataFrame | None:
    """Each paper's records from the newest version that processed it, of all papers or of some buckets of them.

    ``<table>/records`` holds the records and ``<table>/processed`` the papers of
    each version, so a paper whose newest run gave nothing has no records.
    """
    records, processed = (read_versions(spark, f"{table}/{t}") for t in ("records", "processed"))
    if records is None or processed is None:
        return None
    if buckets is not None and len(buckets) < BUCKETS:
        records = records.where(F.col(_BUCKET).isin(buckets))
        processed = processed.where(bucket().isin(buckets))
    newest = processed.groupBy("paper_id").agg(F.max("version").alias("version"))
    return records.join(newest, ["paper_id", "version"], "left_semi").drop(_BUCKET)
