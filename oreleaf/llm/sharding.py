"""Contiguous shards of nearly equal bytes, cut at equal targets of a global prefix sum.

Rows are put into one global order: the top 12 bits of the text's hash (the cell), the top 8 of the
row's hash (the sub-cell), then the text's hash. Equal texts share a cell, but lie in up to 256
sub-cells among its other texts, and a cut within the cell can part them. The order's leading bits name a two-level grid of cells; cells'
totals are summed by Spark, prefix sums of the totals give each cell its global offset,
and only the rows of one cell are sorted together. The cells depend on the rows
alone, so a task that is run again after a lost executor gives the same offsets. A text that makes
up a third of all rows shares its first-level cell, but its rows are spread over the
second level, which hashes the id.

Defined results: a null text has size `overhead` and the checksum of the empty string;
a null id is an id like any other; identical rows get slots of their own in any order;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreleaf.llm.common import text_or_empty

CELL_BITS = 12
SUBCELL_BITS = 8


def byte_shards(docs: DataFrame, n_shards: int = 40, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, size, text_crc32, shard, slot for every row of `docs`.

    A row goes to the shard in which the middle of its bytes falls, so each shard is within
    the largest row of the target. At most 2^12 first-level totals meet in one task.
    """
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("_text_hash"),
        F.xxhash64(F.col(id_col), F.lit(1)).alias("_row_hash"),
    ).withColumns({
        "_cell": F.shiftrightunsigned("_text_hash", 64 - CELL_BITS).cast("int"),
        "_sub": F.shiftrightunsigned("_row_hash", 64 - SUBCELL_BITS).cast("int"),
    })

    totals = rows.groupBy("_cell", "_sub").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    above = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = totals.groupBy("_cell").agg(F.sum("_bytes").alias("_cell_bytes"), F.sum("_rows").alias("_cell_rows"))
    top = top.select(
        F.col("_cell").alias("_top"),
        F.coalesce(F.sum("_cell_bytes").over(above), F.lit(0)).alias("_bytes_above"),
        F.coalesce(F.sum("_cell_rows").over(above), F.lit(0)).alias("_rows_above"),
        F.sum("_cell_bytes").over(every).alias("_all_bytes"),
    )
    within = Window.partitionBy("_cell").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.join(top, totals["_cell"] == top["_top"]).select(
        F.col("_cell").alias("_at"),
        F.col("_sub").alias("_at_sub"),
        "_all_bytes",
        (F.col("_bytes_above") + F.coalesce(F.sum("_bytes").over(within), F.lit(0))).alias("_bytes_before"),
        (F.col("_rows_above") + F.coalesce(F.sum("_rows").over(within), F.lit(0))).alias("_rows_before"),
    )

    order = Window.partitionBy("_cell", "_sub").orderBy("_text_hash", "_row_hash", id_col, "text_crc32", "size")
    placed = rows.withColumns({
        "_inner": F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_rank": F.row_number().over(order).cast("long") - 1,
    }).join(offsets, (F.col("_cell") == F.col("_at")) & (F.col("_sub") == F.col("_at_sub")))
    placed = placed.select(
        F.col(id_col), "size", "text_crc32",
        F.least(F.expr(f"{n_shards} * (2 * (_bytes_before + _inner) + size) div (2 * _all_bytes)"), F.lit(n_shards - 1)).cast("int").alias("shard"),
        (F.col("_rows_before") + F.col("_rank")).alias("_place"),
    )
    starts = placed.groupBy(F.col("shard").alias("_shard")).agg(F.min("_place").alias("_start"))
    return placed.join(F.broadcast(starts), F.col("shard") == F.col("_shard")).select(
        id_col, "size", "text_crc32", "shard", (F.col("_place") - F.col("_start")).alias("slot"),
    )

