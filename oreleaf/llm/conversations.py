"""Chat formatting: logs that are prefixes of longer logs collapse, the others are rendered.

A growing conversation that is logged after every exchange leaves one log for each state. A log's
state after t turns has a rolling hash: the exclusive or, over its turns so far, of a hash of
the turn's number, role and text, kept twice with different seeds (128 bits), so one running
aggregate gives the hashes of all prefixes. Logs with the hash of a proper prefix
of any log go, by an anti-join; of equal logs the one with the smallest id stays. Only
hashes are shuffled for that; texts travel once, with the conversations that are rendered.

Defined results: turns are ordered by number (null first), then by content; repeated rows
of a turn count once; null roles and texts are empty; rows without conversation id form one
conversation; an empty table gives an empty result; other columns are ignored. A role marker inside a text is
broken by a space, so that no text can pose as a turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PREFIX = ["_t", "_x1", "_x2"]


def _turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    return turns.select(
        F.col(conv_col).alias("_conv"), F.col(turn_col).alias("_turn"), F.xxhash64(role, text).alias("_h1"), F.xxhash64(F.lit(1), role, text).alias("_h2"),
        role.alias("_role"), text.alias("_text"),
    )


def prefixes(turns: DataFrame) -> DataFrame:
    """(_conv, _t, _x1, _x2, _last): the rolling hash of every conversation after each of its turns."""
    order = Window.partitionBy("_conv").orderBy("_turn", "_h1", "_h2")
    numbered = turns.select("_conv", "_turn", "_h1", "_h2").distinct().withColumns({
        "_t": F.row_number().over(order), "_last": F.lead("_conv", 1).over(order).isNull() & F.lead("_h1", 1).over(order).isNull(),
    })
    sofar = order.rowsBetween(Window.unboundedPreceding, 0)
    return numbered.select(
        "_conv", "_t", F.bit_xor(F.xxhash64("_t", "_h1", "_h2")).over(sofar).alias("_x1"), F.bit_xor(F.xxhash64(F.lit(2), "_t", "_h2", "_h1")).over(sofar).alias("_x2"), "_last",
    )


def collapse(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """`conv_col`, n_turns, n_equal (logs with the same turns) and rendered of each maximal conversation."""
    given = _turns(turns, conv_col, turn_col, role_col, text_col)
    states = prefixes(given)
    logs = states.where("_last").groupBy(*PREFIX).agg(F.min("_conv").alias("_kept"), F.count("*").alias("n_equal"))
    proper = states.where("not _last").select(*(F.col(c).alias(f"{c}_p") for c in PREFIX)).distinct()
    grown = F.lit(True)
    for c in PREFIX:
        grown = grown & (F.col(c) == F.col(f"{c}_p"))
    maximal = logs.join(proper, grown, "left_anti").select("_kept", "_t", "n_equal")

    turn = F.struct("_turn", "_h1", "_h2", "_role", "_text")
    rendered = F.expr(r"array_join(transform(array_sort(_all), x -> concat('<|', replace(x._role, '<|', '< |'), '|>\n', replace(x._text, '<|', '< |'), '<|end|>\n')), '')")
    return (
        given.join(maximal, F.col("_conv").eqNullSafe(F.col("_kept")))
        .groupBy("_conv", "_t", "n_equal").agg(F.collect_set(turn).alias("_all"))
        .select(F.col("_conv").alias(conv_col), F.col("_t").cast("long").alias("n_turns"), "n_equal", rendered.alias("rendered"))
    )
