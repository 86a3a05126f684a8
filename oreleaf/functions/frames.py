"""DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fan_out(df: DataFrame, keep: list, array: str | Column, index: str, item: str) -> DataFrame:
    """One row per array item, numbered from 0; rows with an empty or null array vanish.

    An inner explode makes the optimizer test the array in a filter of its own,
    pushed below the projection that builds it: an expensive array would be
    computed twice. The outer form with a test on the generated index does not.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(index, item)).where(F.col(index).isNotNull())
