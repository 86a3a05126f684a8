"""Prompt tables: one row per request to a model, keyed by a content hash.

The text of a paper is joined once per paper and schema and only then fanned
out to its records, so it is never shuffled once per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreleaf.functions.frames import fan_out
from oreleaf.functions.text import fill_template
from oreleaf.operators.responses import record_json
from oreleaf.schemas import ExtractionSchema

EXTRACT, VERIFY, ASSESS = "extract", "verify", "assess"


def request_id(*parts: Column) -> Column:
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("\u001f", *texts), 256)


def extraction_prompts(docs: DataFrame, schemas: list[ExtractionSchema]) -> DataFrame:
    """docs(paper_id, llm_text) -> one request per paper and schema."""
    requests = F.array(*[
        F.struct(F.lit(s.name).alias("schema"),
                 fill_template(s.extract_prompt, document_text=F.col("llm_text")).alias("prompt"))
        for s in schemas])
    return (
        fan_out(docs, ["paper_id"], F.when(F.col("llm_text").isNotNull(), requests), "i", "r")
        .select("paper_id", "r.schema", F.lit(EXTRACT).alias("stage"), F.lit(None).cast("int").alias("row_idx"), "r.prompt")
        .withColumn("request_id", request_id(
            F.col("schema"), F.col("stage"), F.col("paper_id"), F.col("row_idx"), F.col("prompt")))
    )


def verification_prompts(validated: DataFrame, docs: DataFrame, schema: ExtractionSchema, text_of: DataFrame | None = None) -> DataFrame:
    """validated(paper_id, rows) of one schema + docs(paper_id, llm_text) -> one request per record.

    ``text_of(paper_id, document)`` names the paper of ``docs`` whose text a paper has, where several share one: then
    the responses go to the texts, and a text is shuffled once however many papers share it.
    """
    given = validated.select("paper_id", "rows")
    if text_of is None:
        joined = given.join(docs.select("paper_id", "llm_text"), "paper_id", "left")
    else:
        texts = docs.select(F.col("paper_id").alias("document"), "llm_text")
        joined = given.join(text_of.select("paper_id", "document"), "paper_id", "left").join(texts, "document", "left")
    joined = joined.withColumn("llm_text", F.coalesce("llm_text", F.lit("")))
    return (
        fan_out(joined, ["paper_id", "llm_text"], "rows", "row_idx", "record")
        .select(
            "paper_id", F.lit(schema.name).alias("schema"), F.lit(VERIFY).alias("stage"), "row_idx",
            fill_template(schema.verify_prompt, row_json=record_json(F.col("record"), pretty=True),
                          document_text=F.col("llm_text")).alias("prompt"))
        .withColumn("request_id", request_id(
            F.col("schema"), F.col("stage"), F.col("paper_id"), F.col("row_idx"), F.col("prompt")))
    )


def batch_prompts(records: DataFrame, schema: ExtractionSchema) -> DataFrame:
    """records(paper_id, row_idx, record) -> one request per paper, with all its records.

    The group is bounded by the paper: its records came out of one response.
    """
    batch = records.groupBy("paper_id").agg(
        F.array_sort(F.collect_list(F.struct("row_idx", record_json(F.col("record")).alias("json")))).alias("batch"))
    rows = F.array_join(F.transform("batch", lambda b: b["json"]), ",")
    return (
        batch
        .select(
            "paper_id", F.lit(schema.name).alias("schema"), F.lit(ASSESS).alias("stage"), F.size("batch").alias("n_rows"),
            fill_template(schema.batch_prompt, batch_json=F.concat(F.lit('{"rows":['), rows, F.lit("]}"))).alias("prompt"))
        .withColumn("request_id", request_id(F.col("schema"), F.col("stage"), F.col("paper_id"), F.col("prompt")))
    )
