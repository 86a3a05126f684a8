"""Nested records to the flat output columns of their schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreleaf.functions.text import join_list
from oreleaf.schemas import ExtractionSchema


def flat_columns(schema: ExtractionSchema, record: str = "record") -> list[Column]:
    types = dict(schema.leaves())
    return [
        (join_list(F.col(f"{record}.{path}")) if isinstance(types[path], T.ArrayType)
         else F.col(f"{record}.{path}")).alias(name)
        for name, path in schema.flat]


def flatten(records: DataFrame, schema: ExtractionSchema, keep: tuple[str, ...] = ()) -> DataFrame:
    """records(..., record) -> one flat row per record, plus the ``keep`` columns in front."""
    return records.select(*keep, *flat_columns(schema))
