"""One batch: from TEI documents to validated, reconciled and flattened records.

Every stage that costs model calls or parsing is written before it is used: a lost executor or a
repeated batch repeats what was not written yet, of paid calls at most the open chunks. The manifest is
committed last: a batch that dies in between is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreleaf.functions.frames import fan_out
from oreleaf.operators import consolidation, documents, inference, manifest as M, mentions, prompts as P
from oreleaf.operators import responses as R, verification
from oreleaf.operators.tables import RULES as TABLE_RULES
from oreleaf.schemas import ExtractionSchema, select_schemas
from oreleaf.sources import commits, tables

RULES, MODEL = "rules", "model"


@dataclass(frozen=True)
class RunOptions:
    """Job parameters. ``assess``: how to merge variants, by rules, by the model, or not at all (None).

    ``owner`` names the job. Jobs of different names can't run a batch of one tag at the same time (the later one gets a
    :class:`~oreleaf.sources.commits.Conflict`); the job that died takes its own batch up again.
    """

    tag: str = "run"
    owner: str = "batch"
    schemas: tuple[str, ...] = ()
    force: bool = False
    retry_empty: bool = True
    per_schema: bool = False
    verify: bool = True
    assess: str | None = RULES
    unite: bool = False
    reject_other_identity: bool = False
    evidence: bool = False
    max_tokens: int = 16384
    retries: int = 3
    validation_retries: int = 3
    backoff_s: float = 15.0
    parallel: int | None = None
    per_second: float | None = None
    chunk: int = 10_000


@dataclass(frozen=True)
class _Batch:
    """What the stages of one batch share."""

    out_dir: str
    base: str
    version: int
    make_call: Callable[[], inference.Call]
    options: RunOptions

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return tables.write_version(df, f"{self.base}/{name}", self.version)

    def ask(self, stage: str, requests: DataFrame, render, judge) -> DataFrame:
        """Answers to one stage's requests; ``requests`` go to a table without their prompts first."""
        o = self.options
        budget = inference.Budget(
            self.version, o.max_tokens, o.retries, o.validation_retries, o.backoff_s, afresh=o.force,
            again_if_empty=o.retry_empty and stage.startswith(P.EXTRACT), parallel=o.parallel,
            per_second=o.per_second, chunk=o.chunk)
        written = self.write(requests.drop("prompt"), f"requests/{stage}")
        return inference.ask(written, render, f"{self.out_dir}/answers/{stage}", self.make_call, judge, budget)


def _of_open_papers(df: DataFrame, todo: DataFrame) -> DataFrame:
    return df.join(todo.select("paper_id").distinct(), "paper_id", "left_semi")


def _verdict(validated: DataFrame, n_rows) -> DataFrame:
    return validated.select("request_id", F.col("response_error").alias("problem"), n_rows.alias("n_rows"))


def _extracted(docs: DataFrame, schema: ExtractionSchema, batch: _Batch) -> DataFrame:
    return batch.ask(
        f"{P.EXTRACT}/{schema.name}", P.extraction_prompts(docs, [schema]),
        lambda todo: P.extraction_prompts(_of_open_papers(docs, todo), [schema]),
        lambda raw: _verdict(R.validate(raw, schema), F.size("rows")))


def _verified(validated, docs, schema, batch: _Batch) -> DataFrame:
    first = R.record_rows(validated.select("paper_id", "rows"))
    o = batch.options
    if not o.verify:
        return first
    answers = batch.ask(
        f"{P.VERIFY}/{schema.name}", P.verification_prompts(validated, docs, schema),
        lambda todo: P.verification_prompts(_of_open_papers(validated, todo), docs, schema),
        lambda raw: _verdict(R.validate_single(raw, schema), F.lit(1)))
    checked = R.validate_single(answers.where(F.col("status") == "ok"), schema)
    return verification.merge_verified(first, checked, schema, o.unite, o.reject_other_identity).drop("was_verified")


def _assessed(records, schema, batch: _Batch) -> DataFrame:
    if batch.options.assess is None:
        return records
    if batch.options.assess == RULES:
        return consolidation.consolidate(records, schema).drop("n_variants")
    answers = R.validate(batch.ask(
        f"{P.ASSESS}/{schema.name}", P.batch_prompts(records, schema),
        lambda todo: P.batch_prompts(_of_open_papers(records, todo), schema),
        lambda raw: _verdict(R.validate(raw, schema), F.size("rows"))), schema)
    outcome = answers.select("paper_id", ((F.col("status") == "ok") & F.col("response_error").isNull()).alias("ok"))
    numbered = fan_out(answers, ["paper_id"], "rows", "row_idx", "record")
    return consolidation.assess_or_keep(records, numbered, outcome)


def run(
    spark: SparkSession, tei: DataFrame, out_dir: str,
    make_call: Callable[[], inference.Call], options: RunOptions = RunOptions(),
) -> DataFrame:
    """tei(paper_id, tei_xml) -> manifest; records and CSV files go below ``out_dir``.

    Returns the new manifest. ``<out_dir>/<tag>/<schema>`` holds the versioned
    records (see :func:`oreleaf.sources.tables.current_records`) and
    ``<out_dir>/<tag>_<schema>`` the current rows of every paper as CSV.
    """
    schemas = select_schemas(list(options.schemas))
    base = f"{out_dir}/{options.tag}"
    manifest_path = f"{base}/manifest"
    version = commits.latest(spark, manifest_path)[0] + 1
    commits.claim(spark, manifest_path, version, options.owner)
    previous = None if options.force else tables.read_manifest(spark, manifest_path)

    todo = tables.write_version(
        M.pending(tei.select("paper_id"), previous, schemas, options.retry_empty, options.per_schema, options.force),
        f"{base}/todo", version)
    parsed = documents.with_document_text(documents.parse_tei(tei.join(todo, "paper_id", "left_semi")))
    docs = tables.write_version(parsed.select("paper_id", "llm_text", "parse_error"), f"{base}/docs", version)

    batch = _Batch(out_dir, base, version, make_call, options)
    outcomes = docs.select(
        "paper_id", F.lit(0).alias("step"), F.lit(M.PARSE).alias("stage"), F.col("parse_error").isNull().alias("ok"),
        F.col("parse_error").alias("error"))
    validated: dict[str, DataFrame] = {}
    for step, schema in enumerate(schemas, 1):
        mine = R.validate(_extracted(docs, schema, batch), schema)
        mine = mine.withColumn("problem", F.when(F.col("status") == "ok", F.col("response_error"))
                               .otherwise(F.coalesce("error", "status")))
        validated[schema.name] = batch.write(mine.select("paper_id", "rows", "problem"), f"{schema.name}/responses")
        outcomes = outcomes.unionByName(validated[schema.name].select(
            "paper_id", F.lit(step).alias("step"), F.lit(M.EXTRACT).alias("stage"), F.col("problem").isNull().alias("ok"),
            F.col("problem").alias("error")))
    status = tables.write_version(M.paper_status(outcomes), f"{base}/status", version)
    good = status.where(F.col("status") == "ok").select("paper_id")

    counted = None
    for schema in schemas:
        # One row per paper here: papers with a failed schema leave before any fan-out.
        rows = validated[schema.name].join(good, "paper_id", "left_semi")
        records = _verified(rows, docs, schema, batch)
        if options.verify or options.assess == MODEL:
            records = tables.write_version(records, f"{base}/{schema.name}/verified", version)
        records = _assessed(records, schema, batch)
        stored = tables.write_records(records, f"{base}/{schema.name}", version)
        done = tables.write_version(good, f"{base}/{schema.name}/processed", version)
        tables.export_csv(spark, f"{base}/{schema.name}", done, schema, out_dir, options.tag)
        if options.evidence:
            batch.write(verification.evidence_check(rows, docs, schema), f"{schema.name}/evidence")
            if schema.name in TABLE_RULES:
                batch.write(mentions.evidence_spans(rows, docs, TABLE_RULES[schema.name]), f"{schema.name}/evidence_spans")
        ids = stored.select("paper_id", F.lit(schema.name).alias("schema"))
        counted = ids if counted is None else counted.unionByName(ids)
    counts = consolidation.paper_counts(good, counted, schemas)
    changed = M.updates(todo, status, counts, schemas)
    tables.commit_manifest(changed, manifest_path, version, options.force)
    return tables.read_manifest(spark, manifest_path)


def current_output(spark: SparkSession, out_dir: str, tag: str, schema: ExtractionSchema) -> DataFrame | None:
    """The valid records of one schema: each paper's newest successful run."""
    return tables.current_records(spark, f"{out_dir}/{tag}/{schema.name}")
