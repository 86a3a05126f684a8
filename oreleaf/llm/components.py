"""Connected components by alternating large and small stars, each round a written table.

Every round joins an edge list with the smallest neighbour of each node and keeps its size
in proportion to the nodes; no set of neighbours is ever gathered in one row. Smallest
neighbours are aggregated before they are shuffled. A node with very many edges is read by
one task of each join: Spark's split of skewed partitions does not cover a join whose other
side is an aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreleaf.llm.common import staged


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes but the roots, root the smallest node of the component; `edges`: u, v of one type."""
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (state := now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()) != before:
        before = state
        now = staged(_small(_large(now)), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _large(edges: DataFrame) -> DataFrame:
    """Tie each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.least("w", "m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them; edges point to the smaller end."""
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    rest = edges.join(least, F.col("u") == F.col("w")).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least).distinct()
