"""Merging of variants: records of one paper that describe the same result.

Records are variants when they agree in every key field. Strings are compared
in lower case with single spaces, lists regardless of order, numbers exactly,
and null only equals null. Each field of the merged record is the value of the
most complete variant that has one.

Only aggregates with map-side combine are used and the shuffle key is the whole
key, not the paper: neither a paper nor a key with very many records gathers in
one place before it has been reduced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreleaf.functions import sqltext as Q
from oreleaf.operators import phrases
from oreleaf.operators.responses import nest
from oreleaf.schemas import ExtractionSchema


def _filled(path: str, kind: T.DataType) -> str:
    """The value, or null when it says nothing."""
    value = f"record.{path}"
    return f"if(size({value}) > 0, {value}, NULL)" if isinstance(kind, T.ArrayType) else value


def completeness(schema: ExtractionSchema) -> str:
    """Number of non-null scalars and non-empty lists."""
    return " + ".join(f"int({_filled(p, t)} IS NOT NULL)" for p, t in schema.leaves())


def _comparable(value: str) -> str:
    return Q.strip(Q.replace_all(f"lower({value})", r"(?U)\s+", " "))


def normalised_phrase(value: str) -> str:
    """Comparison form of a phrase: lower case, no punctuation, single spaces."""
    return _comparable(Q.replace_all(value, r"[\p{Punct}]+", " "))


def _key(path: str, kind: T.DataType) -> str:
    value = f"record.{path}"
    if isinstance(kind, T.StringType):
        return _comparable(value)
    if isinstance(kind, T.ArrayType):
        return f"array_sort({Q.each(value, _comparable)})"
    return value


def _name(path: str) -> str:
    return path.replace(".", "__")


def _merged_record(schema: ExtractionSchema) -> str:
    """Record from the picked columns; lists without a value are empty."""
    def leaf(path: str, kind: T.DataType) -> str:
        picked = _name(path) if path in schema.united else f"{_name(path)}.value"
        return Q.or_empty(picked, "array<string>") if isinstance(kind, T.ArrayType) else picked

    return nest(leaf, schema)


def consolidate(records: DataFrame, schema: ExtractionSchema, similar: float = phrases.SIMILAR) -> DataFrame:
    """records(paper_id, row_idx, record) -> one record per paper and key.

    Records whose key fields are all null or empty have no identity and stay apart.
    Adds n_variants; row_idx is that of the first variant. Fields named in
    ``schema.united`` hold the union of the variants' items in the order of their
    first mention, with near-identical phrasings counted once: the same content words, or sets of them with a
    similarity of ``similar`` or more (:mod:`oreleaf.operators.phrases`).
    """
    kinds = dict(schema.leaves())
    keys = {f"k{i}": _key(p, kinds[p]) for i, p in enumerate(schema.key)}
    keyed = records.selectExpr(
        "paper_id", "row_idx", "record", f"{completeness(schema)} AS completeness",
        *[f"{expr} AS {k}" for k, expr in keys.items()])
    empty = {k: f"coalesce(size({k}), 0) <= 0" if isinstance(kinds[p], T.ArrayType) else f"coalesce(string({k}), '') = ''"
             for k, p in zip(keys, schema.key)}
    nameless = " AND ".join(empty.values())
    keyed = keyed.withColumn("alone", F.expr(f"if({nameless}, row_idx, NULL)"))
    picks = [(p, t) for p, t in schema.leaves() if p not in schema.united]

    def best(path: str, kind: T.DataType):
        value = _filled(path, kind)
        ranked = Q.named_struct({"completeness": "completeness", "order": "-row_idx", "value": value})
        return F.expr(f"max(if({value} IS NULL, NULL, {ranked}))").alias(_name(path))

    group = ["paper_id", *keys, "alone"]
    out = ["paper_id", "row_idx", f"{_merged_record(schema)} AS record", "n_variants"]
    if not schema.united:
        return keyed.groupBy(*group).agg(
            *[best(p, t) for p, t in picks],
            F.min("row_idx").alias("row_idx"), F.count(F.lit(1)).alias("n_variants")).selectExpr(*out)

    (united,) = schema.united
    # First level: one row per key and set of content words, carrying the partial picks along.
    # A record is counted with its first item only.
    items = keyed.select(*keyed.columns, F.posexplode_outer(f"record.{united}").alias("pos", "item"))
    phrase = items.withColumn("phrase", F.expr(normalised_phrase("item")))
    per_item = phrase.groupBy(*group, F.expr(phrases.content_words("phrase")).alias("words")).agg(
        *[best(p, t) for p, t in picks],
        F.expr("min(if(item IS NULL, NULL, named_struct('row_idx', row_idx, 'pos', pos, 'item', item)))").alias("first"),
        F.min("row_idx").alias("row_idx"),
        F.expr("count_if(coalesce(pos, 0) = 0)").alias("n_variants"))
    # Second level: only the distinct word sets of a key, which is the size of the result.
    return per_item.groupBy(*group).agg(
        *[F.max(_name(p)).alias(_name(p)) for p, _ in picks],
        F.expr("collect_list(if(first IS NULL, NULL, named_struct('first', first, 'words', words)))").alias("firsts"),
        F.min("row_idx").alias("row_idx"), F.sum("n_variants").alias("n_variants"),
    ).withColumn(_name(united), F.expr(phrases.first_of_each("firsts", similar))).selectExpr(*out)


def assess_or_keep(records: DataFrame, assessed: DataFrame, outcome: DataFrame) -> DataFrame:
    """Model-assessed batches where they succeeded, the original records elsewhere.

    ``outcome(paper_id, ok)`` has one row per assessed paper. The choice is made
    for a paper as a whole: a good assessment replaces its batch even when it has
    fewer records, a failed or missing one leaves it untouched.
    """
    good = outcome.where("ok").select("paper_id")
    kept = records.join(good, "paper_id", "left_anti").select("paper_id", "row_idx", "record")
    replaced = assessed.join(good, "paper_id", "left_semi").select("paper_id", "row_idx", "record")
    return kept.unionByName(replaced)


def paper_counts(papers: DataFrame, records: DataFrame, schemas: list[ExtractionSchema]) -> DataFrame:
    """papers(paper_id), records(paper_id, schema) -> paper_id, counts MAP<STRING, BIGINT>.

    A paper without records has the count 0 for every selected schema.
    """
    per_paper = records.groupBy("paper_id").agg(*[
        F.count_if(F.col("schema") == s.name).alias(s.count_key) for s in schemas])
    entries = []
    for s in schemas:
        entries += [F.lit(s.count_key), F.coalesce(F.col(s.count_key), F.lit(0).cast("bigint"))]
    return papers.select("paper_id").join(per_paper, "paper_id", "left").select(
        "paper_id", F.create_map(*entries).alias("counts"))
