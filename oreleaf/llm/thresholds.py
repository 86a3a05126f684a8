"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Every text gets counts (words, symbols, repeated lines, words in repeated five-word windows) and, from
them, one signal for each rule. A rule rejects a text whose signal exceeds the cutoff of its stratum.
Cutoffs come from a fixed grid and are certified on labelled texts: for every stratum, rule
and grid value, the number of good texts it would reject is tested exactly against a binomial law of
rate ALPHA / rules. From the loosest value on, values are accepted until the first
that fails (a fixed sequence needs no correction within a rule), at level DELTA divided by
the number of strata and rules (Bonferroni). So with confidence 1 - DELTA, in no stratum do all rules
together reject more than ALPHA of the good texts. A rule without certified value rejects nothing there.

Defined results: a null text has no words (base_failed); a null stratum is one of its own;
labels other than 1 and labels without a text do not count, repeated labels of an id count once;
repeated rows are judged each; empty tables give an empty result or no cutoffs; the counts are over whole texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreleaf.llm.common import SPACES, SPACE_WORD, UPPER, staged, text_or_empty

SYMBOLS = "#*$%&|<>"  # fixed values: the characters that count as symbols
WINDOW = 5
MIN_WORDS = 10
ALPHA = 0.02
DELTA = 0.05
GRID = 40
TERMS = 512  # of a binomial tail; what is left is bounded from above, so a test never gets easier
# Rule: a signal as a fraction of two counts, and the loosest cutoff; the grid is the fortieths of that.
RULES = {
    "symbols": ("n_symbols", "n_words", 2),
    "dup_lines": ("n_dup_lines", "n_lines", 1),
    "repeats": ("n_repeat_words", "n_words", 1),
    "word_length": ("word_chars", "n_words", 20),
    "capitals": ("n_capitals", "word_chars", 1),
}


def _without(text: str, characters: str) -> Column:
    return F.translate(F.col(text), characters, "")


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of `docs` and the counts of each text (long)."""
    names = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    size = WINDOW - 1
    rows = docs.select(*kept, text_or_empty(text_col).alias("_t"))
    rows = rows.select(
        *kept, F.regexp_extract_all("_t", F.lit(f"({SPACE_WORD})"), 1).alias("_w"),
        F.length(_without("_t", SPACES)).alias("_chars"),
        (F.length("_t") - F.length(_without("_t", SYMBOLS))).alias("_symbols"),
        (F.length("_t") - F.length(_without("_t", UPPER))).alias("_capitals"),
        F.expr(r"filter(split(_t, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("_lines"),
    )
    rows = rows.select(
        *kept, "_w", "_chars", "_symbols", "_capitals", F.size("_lines").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("_dup_lines"),
        F.expr(f"case when size(_w) > {size} then transform(sequence(1, size(_w) - {size}), i -> xxhash64(slice(_w, i, {WINDOW}))) else array() end").alias("_hashes"),
    )
    # A window that occurs twice has a hash that does; only such texts sort their windows, as text.
    rows = rows.select(
        *kept, F.size("_w").alias("_n"), "_chars", "_symbols", "_capitals", "_n_lines", "_dup_lines",
        F.expr(f"""case when size(array_distinct(_hashes)) < size(_hashes) then sort_array(
            transform(sequence(1, size(_w) - {size}), i -> struct(array_join(slice(_w, i, {WINDOW}), ' ') as g, i as i))) else array() end""").alias("_windows"),
    )
    rows = rows.withColumn("_starts", F.expr("""
        case when size(_windows) = 0 then array() else sort_array(transform(
            filter(sequence(0, size(_windows) - 1), j -> get(_windows, j).g = get(_windows, j - 1).g or get(_windows, j).g = get(_windows, j + 1).g),
            j -> get(_windows, j).i)) end"""))
    repeated = F.expr(f"aggregate(transform(_starts, (s, j) -> least({WINDOW}, coalesce(get(_starts, j + 1) - s, {WINDOW}))), 0, (a, b) -> a + b)")
    return rows.select(*kept, *(F.col(c).cast("long").alias(n) for c, n in zip(("_n", "_chars", "_symbols", "_capitals", "_n_lines", "_dup_lines"), names)), repeated.cast("long").alias("n_repeat_words"))


def step(rule: str) -> Column:
    """The smallest grid value, as a number from 0, that the text's signal does not exceed; in whole numbers, so exact."""
    above, below, top = RULES[rule]
    return F.expr(f"case when {below} > 0 then ({above} * {GRID} + {top} * {below} - 1) div ({top} * {below}) else 0L end")


def _log_gamma(z: str) -> str:
    """ln of the gamma function for z >= 1: Stirling's series eight steps further on."""
    far = f"({z} + 8)"
    steps = " + ".join(f"ln({z} + {k})" for k in range(8))
    return f"(({far} - 0.5) * ln({far}) - {far} + {0.5 * math.log(2 * math.pi)!r} + 1 / (12 * {far}) - 1 / (360 * power({far}, 3)) + 1 / (1260 * power({far}, 5)) - ({steps}))"


def log_tail(n: str, x: str, rate: float) -> Column:
    """ln P(Bin(n, rate) <= x), exact up to TERMS terms and from above beyond; 0 where x is no less than the mean."""
    odds = (1 - rate) / rate
    largest = f"({_log_gamma(f'({n} + 1D)')} - {_log_gamma(f'({x} + 1D)')} - {_log_gamma(f'({n} - {x} + 1D)')} + {x} * {math.log(rate)!r}D + ({n} - {x}) * {math.log1p(-rate)!r}D)"
    terms = f"""aggregate(sequence(0, cast(least({x}, {TERMS}) as int)), named_struct('term', 1D, 'sum', 0D),
        (a, k) -> named_struct('term', a.term * ({x} - k) * {odds!r}D / ({n} - {x} + k + 1), 'sum', a.sum + a.term),
        a -> a.sum + case when {x} > {TERMS} then a.term / (1 - ({x} - {TERMS}) * {odds!r}D / ({n} - {x} + {TERMS + 1})) else 0D end)"""
    return F.expr(f"case when {x} >= {n} * {rate!r}D then 0D else {largest} + ln({terms}) end")


def cutoffs(judged: DataFrame, labels: DataFrame, stratum: str, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(_stratum, one column for each rule): the tightest certified cutoffs as grid numbers, null where there is none.

    `judged` has the counts; at most GRID x rules counts for each stratum leave the tasks that read them.
    """
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("_good")).distinct()
    bins = F.array(*(F.struct(F.lit(rule).alias("rule"), F.least(step(rule), F.lit(GRID + 1)).alias("bin")) for rule in RULES))
    cells = (
        judged.where(F.col("n_words") > 0).join(good, F.col(id_col) == F.col("_good"), "left_semi")
        .select(F.col(stratum).alias("_stratum"), F.explode(bins).alias("_b"))
        .groupBy("_stratum", F.col("_b.rule").alias("_rule"), F.col("_b.bin").alias("_bin")).agg(F.count("*").alias("_count"))
    )
    series = Window.partitionBy("_stratum", "_rule")
    grid = cells.groupBy("_stratum", "_rule").agg(F.sum("_count").alias("_n"), F.map_from_entries(F.collect_list(F.struct("_bin", "_count"))).alias("_by_bin"))
    strata = Window.partitionBy(F.lit(1))
    grid = grid.withColumn("_tests", F.count("*").over(strata))
    tests = (
        grid.select("_stratum", "_rule", "_n", "_tests", F.explode(F.expr(f"transform(sequence(1, {GRID}), k -> struct(k as k, aggregate(map_values(map_filter(_by_bin, (b, c) -> b > k)), 0L, (a, b) -> a + b) as x))")).alias("_c"))
        .select("_stratum", "_rule", F.col("_c.k").alias("_k"), "_tests", log_tail("_n", "_c.x", ALPHA / len(RULES)).alias("_log_p"))
    )
    loosest_first = series.orderBy(F.desc("_k")).rowsBetween(Window.unboundedPreceding, 0)
    accepted = tests.withColumn("_worst", F.max(F.col("_log_p") - F.log(F.lit(DELTA) / F.col("_tests"))).over(loosest_first)).where("_worst <= 0")
    return accepted.groupBy("_stratum").agg(*(F.min(F.when(F.col("_rule") == rule, F.col("_k"))).alias(f"_{rule}") for rule in RULES))


def judge(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Id, counts, base_failed and kept of every row."""
    given = docs.select(F.col(id_col), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("_lang"), F.col(text_col))
    judged = staged(counts(given, text_col).drop(text_col), "counts")
    certified = staged(cutoffs(judged, labels, "_lang", id_col, label_col), "cutoffs")
    over = [F.coalesce(step(rule) > F.col(f"_{rule}"), F.lit(False)) for rule in RULES]
    rejected = over[0]
    for one in over[1:]:
        rejected = rejected | one
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.join(certified, F.col("_lang") == F.col("_stratum"), "left").select(
        *(c for c in judged.columns if c != "_lang"), base_failed.alias("base_failed"), (~base_failed & ~rejected).alias("kept"),
    )
