"""Reconciliation of first-pass records with their verified versions and with the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreleaf.functions.frames import fan_out
from oreleaf.functions.text import collapse_spaces
from oreleaf.schemas import ExtractionSchema

_NUMBER = r"[0-9]+(?:\.[0-9]+)?"


def _as_verified(verified: DataFrame) -> DataFrame:
    # Rows without a record stay in: a filter on the record would be pushed below
    # its validation and evaluate it twice.
    return verified.select("paper_id", "row_idx", F.col("record").alias("verified"))


def merge_verified(
    first: DataFrame, verified: DataFrame, schema: ExtractionSchema,
    unite: bool = False, reject_other_identity: bool = False,
) -> DataFrame:
    """first, verified (paper_id, row_idx, record) -> first with the good verified records in place.

    A verified record replaces the whole first-pass record; without one the
    first-pass record stays. Rows and their numbering do not change. The join
    key ends in row_idx, so a paper with very many records spreads over tasks.
    ``unite`` keeps first-pass items of the united lists;
    ``reject_other_identity`` keeps the first-pass record when the verified one
    is about another material or condition.
    """
    joined = first.join(_as_verified(verified), ["paper_id", "row_idx"], "left")
    usable = F.col("verified").isNotNull()
    if reject_other_identity:
        usable = usable & same_identity(F.col("record"), F.col("verified"), schema)
    merged = F.col("verified")
    if unite:
        for name in schema.united:
            merged = merged.withField(name, F.array_union(F.col(f"record.{name}"), F.col(f"verified.{name}")))
    return (
        joined.withColumn("was_verified", usable)
        .withColumn("record", F.when(usable, merged).otherwise(F.col("record")))
        .drop("verified")
    )


def _field(record: Column, path: str) -> Column:
    for part in path.split("."):
        record = record[part]
    return record


def same_identity(a: Column, b: Column, schema: ExtractionSchema) -> Column:
    same = F.lit(True)
    for path in schema.identity:
        same = same & _field(a, path).eqNullSafe(_field(b, path))
    return same


def identity_check(first: DataFrame, verified: DataFrame, schema: ExtractionSchema) -> DataFrame:
    """One row per verified record: is it still about the same material and condition?

    The fields compared go to the join and no others, each a column of its own; answers without a record do not go there.
    """
    key = ["paper_id", "row_idx"]
    fields = lambda side: [_field(F.col("record"), path).alias(f"{side}_{k}") for k, path in enumerate(schema.identity)]
    answered = F.when(F.col("record").isNotNull(), F.array(F.struct(*fields("verified"))))
    answers = fan_out(verified, key, answered, "i", "verified").select(*key, "verified.*")
    # A merge at any size: Spark's estimate leaves out how many records a response has, so a side could look small and be broadcast.
    joined = first.select(*key, *fields("first")).join(answers.hint("merge"), key)
    same = F.lit(True)
    for k in range(len(schema.identity)):
        same = same & F.col(f"first_{k}").eqNullSafe(F.col(f"verified_{k}"))
    return joined.select(*key, same.alias("same_identity"))


def evidence_check(validated: DataFrame, docs: DataFrame, schema: ExtractionSchema) -> DataFrame:
    """Is each filled value of each record stated in the paper's text?

    validated(paper_id, rows) + docs(paper_id, llm_text) -> paper_id, row_idx,
    field, value, supported. The text meets the records once per paper, before
    they are exploded; its numbers are read out once per paper. A number is
    supported by an equal number in the text (its sign aside), a string by its
    occurrence, case and spacing aside. Booleans have no wording to look for; without a
    document ``supported`` is null.
    """
    text = collapse_spaces(F.lower("llm_text"))
    prepared = (
        validated.select("paper_id", "rows").join(docs.select("paper_id", "llm_text"), "paper_id", "left")
        .select(
            "paper_id", "rows", text.alias("text"),
            F.array_distinct(F.transform(
                F.regexp_extract_all("llm_text", F.lit(_NUMBER), F.lit(0)), lambda n: n.cast("double"))).alias("numbers"))
    )
    prepared = fan_out(prepared, ["paper_id", "text", "numbers"], "rows", "row_idx", "record")
    in_text = lambda s: F.contains(F.col("text"), collapse_spaces(F.lower(s)))
    entries = []
    for path, kind in schema.leaves():
        value = F.col(f"record.{path}")
        entry = lambda v, ok: F.struct(F.lit(path).alias("field"), v.alias("value"), ok.alias("supported"))
        if isinstance(kind, T.ArrayType):
            entries.append(F.transform(value, lambda item: entry(item, in_text(item))))
        elif isinstance(kind, (T.DoubleType, T.IntegerType)):
            found = F.array_contains("numbers", F.abs(value.cast("double")))
            entries.append(F.array(entry(value.cast("string"), found)))
        elif isinstance(kind, T.StringType):
            entries.append(F.array(entry(value, in_text(value))))
    filled = F.filter(F.flatten(F.array(*entries)), lambda e: e["value"].isNotNull() & (e["value"] != ""))
    return (fan_out(prepared, ["paper_id", "row_idx"], filled, "i", "e")
            .select("paper_id", "row_idx", "e.field", "e.value", "e.supported"))
