"""Bookkeeping of what has been processed: manifest(paper_id, status, stage, error, counts, attempts)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreleaf.schemas import ExtractionSchema

SCHEMA = "paper_id string, status string, stage string, error string, counts map<string,bigint>, attempts int"

PARSE, EXTRACT = "parse", "extract"


def needs_processing(
    schemas: list[ExtractionSchema], retry_empty: bool = True, per_schema: bool = False,
    status: str = "status", counts: str = "counts",
) -> Column:
    """True for recorded papers that are still open: failed, new to a selected schema, or (``retry_empty``) without records.

    Without records means none from all selected schemas together, or with
    ``per_schema`` none from any one of them.
    """
    keys = [s.count_key for s in schemas]
    found = [F.coalesce(F.col(counts)[k], F.lit(0)) for k in keys]
    failed = ~F.col(status).eqNullSafe("ok")
    never_ran = reduce(lambda a, b: a | b, [
        ~F.coalesce(F.map_contains_key(counts, F.lit(k)), F.lit(False)) for k in keys])
    again = failed | never_ran
    if retry_empty:
        if per_schema:
            again = again | reduce(lambda a, b: a | b, [n == 0 for n in found])
        else:
            again = again | (reduce(lambda a, b: a + b, found) == 0)
    return again


def pending(
    papers: DataFrame, manifest: DataFrame | None, schemas: list[ExtractionSchema],
    retry_empty: bool = True, per_schema: bool = False, force: bool = False,
) -> DataFrame:
    """Papers to process now, with ``previous_attempts`` and ``previous_counts``.

    Without a manifest, or with ``force``, all papers are pending and nothing is
    carried over.
    """
    nothing = F.create_map().cast("map<string,bigint>")
    if force or manifest is None:
        return papers.withColumn("previous_attempts", F.lit(0)).withColumn("previous_counts", nothing)
    recorded = manifest.select(
        "paper_id", F.struct("status", "counts", "attempts").alias("m"))
    todo = F.col("m").isNull() | needs_processing(schemas, retry_empty, per_schema, "m.status", "m.counts")
    return (
        papers.join(recorded, "paper_id", "left").where(todo)
        .withColumn("previous_attempts", F.coalesce("m.attempts", F.lit(0)))
        .withColumn("previous_counts", F.coalesce("m.counts", nothing))
        .drop("m")
    )


def paper_status(outcomes: DataFrame) -> DataFrame:
    """outcomes(paper_id, step, stage, ok, error), one row per step of a paper -> paper_id, status, stage, error.

    One failed step fails the paper; the error is that of the failed step with
    the smallest number (0 the parse, then the schemas in their selected order).
    """
    failure = F.when(~F.col("ok"), F.struct("step", "stage", F.coalesce("error", F.lit("")).alias("error")))
    return (
        outcomes.groupBy("paper_id").agg(F.bool_and("ok").alias("ok"), F.min(failure).alias("f"))
        .select("paper_id", F.when(F.col("ok"), "ok").otherwise("error").alias("status"), "f.stage", "f.error")
    )


def updates(todo: DataFrame, status: DataFrame, counts: DataFrame, schemas: list[ExtractionSchema]) -> DataFrame:
    """Manifest entries of the papers just processed.

    Success keeps the earlier counts of schemas not selected now; failure drops
    all counts. Attempts go up by one either way.
    """
    selected = [s.count_key for s in schemas]
    nothing = F.create_map().cast("map<string,bigint>")
    carried = F.map_filter("previous_counts", lambda k, v: ~k.isin(selected))
    zero = F.create_map(*[x for k in selected for x in (F.lit(k), F.lit(0).cast("bigint"))])
    fresh = F.coalesce(F.col("counts"), zero)
    ok = F.col("status") == "ok"
    return (
        todo.select("paper_id", "previous_attempts", "previous_counts")
        .join(status, "paper_id").join(counts, "paper_id", "left")
        .select(
            "paper_id", "status",
            F.when(~ok, F.col("stage")).alias("stage"), F.when(~ok, F.col("error")).alias("error"),
            F.when(ok, F.map_concat(carried, fresh)).otherwise(nothing).alias("counts"),
            (F.col("previous_attempts") + 1).cast("int").alias("attempts"))
    )


def upsert(manifest: DataFrame | None, changed: DataFrame) -> DataFrame:
    """The next manifest version: changed entries replace their predecessors, the rest stay."""
    if manifest is None:
        return changed
    return manifest.join(changed, "paper_id", "left_anti").unionByName(changed)


def run_summary(
    papers: DataFrame, manifest: DataFrame, schemas: list[ExtractionSchema], retry_empty: bool = True,
) -> DataFrame:
    """One row: papers found, complete and pending, and the records per schema."""
    recorded = manifest.select("paper_id", F.struct("status", "counts").alias("m"))
    todo = F.col("m").isNull() | needs_processing(schemas, retry_empty, status="m.status", counts="m.counts")
    return papers.join(recorded, "paper_id", "left").agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(~todo).alias("complete"),
        F.count_if(todo).alias("pending"),
        F.count_if(F.col("m.status") == "error").alias("failed"),
        *[F.coalesce(F.sum(F.col("m.counts")[s.count_key]), F.lit(0)).alias(s.count_key) for s in schemas])
