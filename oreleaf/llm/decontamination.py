"""Benchmark decontamination by winnowing, in DataFrame operations only.

A span of `span` words has span - k + 1 k-grams; its fingerprint is their smallest hash, so equal
spans have equal fingerprints. Every text keeps the distinct fingerprints of its windows, by row-local
expressions over arrays (hashes of words, pairs and fours, then minima over two, four and seven neighbours), and
only these meet the fingerprints of the benchmark's windows. Texts with a hit, usually few, are taken once more: in them runs of
neighbouring windows that share a hit fingerprint are extended, word for word, to the windows that occur in an
item, and hit windows that touch are merged to spans. Each shared span of `span` words or
more is found, and nothing else.

All results belong to a text, not to a row: copies of a text share them. Items shorter than
`span` words are one window each; their fingerprint is the hash of all their words.

Defined results: null texts have no words; an item without words matches nothing; items of
one id are one item; a null item id hits words, but is no item of the list; repeated rows
and null ids of documents keep their rows; with no documents the result is empty, with no items nothing is hit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreleaf.llm.common import alnum_words, staged, text_or_empty

SPAN = 10
GRAM = 4  # a power of two
KEY = ["_t1", "_t2"]


def _words(df: DataFrame, text_col: str, *kept: str) -> DataFrame:
    """The kept columns, the text's 128-bit key and its words."""
    text = text_or_empty(text_col)
    return df.select(*kept, F.xxhash64(text).alias("_t1"), F.xxhash64(F.lit(1), text).alias("_t2"), alnum_words(text).alias("_words"))


def _over(values: str, have: int, want: int, combine: str) -> str:
    """SQL: `combine` (of a and b) over `want` neighbours, from an array that holds it over `have`; the last want - have values are no good."""
    return f"zip_with({values}, slice({values}, {want - have + 1}, size({values})), (a, b) -> {combine})"


def _fingerprints(words: DataFrame, span: int, gram: int) -> DataFrame:
    """(key, words, least): the fingerprint of the window that starts at each word."""
    rows = words.select(*KEY, "_words", F.expr(f"case when size(_words) >= {span} then transform(_words, w -> xxhash64(w)) else array() end").alias("_v"))
    have = 1
    while have < gram:
        step = min(have, gram - have)
        rows = rows.select(*KEY, "_words", F.expr(_over("_v", have, have + step, "xxhash64(a, b)")).alias("_v"))
        have += step
    rows = rows.select(*KEY, "_words", F.expr(f"slice(_v, 1, greatest(size(_v) - {gram - 1}, 0))").alias("_v"))
    width, have = span - gram + 1, 1
    while have < width:
        step = min(have, width - have)
        rows = rows.select(*KEY, "_words", F.expr(_over("_v", have, have + step, "least(a, b)")).alias("_v"))
        have += step
    return rows.select(*KEY, "_words", F.expr(f"slice(_v, 1, greatest(size(_v) - {width - 1}, 0))").alias("_least"))


def _runs(fingerprints: DataFrame) -> DataFrame:
    """(key, fp, first, last): runs of neighbouring windows, from 0, with one fingerprint."""
    begins = F.expr("filter(sequence(0, size(_least) - 1), i -> i = 0 or get(_least, i) <> get(_least, i - 1))")
    return fingerprints.select(*KEY, "_least", F.when(F.size("_least") > 0, begins).otherwise(F.array().cast("array<int>")).alias("_begins")).select(*KEY, F.expr(
        "inline(transform(_begins, (b, j) -> struct(get(_least, b) as fp, b as first, coalesce(get(_begins, j + 1), size(_least)) - 1 as last)))",
    ))


def _windows(items: DataFrame, span: int) -> DataFrame:
    """(item, window, length): the windows of each item."""
    words = items.where("size(_words) > 0").withColumn("_length", F.least(F.size("_words"), F.lit(span)))
    starts = words.select("_item", "_words", "_length", F.explode(F.expr("sequence(1, size(_words) - _length + 1)")).alias("_start"))
    return starts.select("_item", F.expr("array_join(slice(_words, _start, _length), ' ')").alias("_window"), "_length").distinct()


def find(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(_t1, _t2, n_hit, items, spans) of every text that shares a window with an item.

    `spans` are the merged hits (first and last word, from 0), `items` the sorted ids as strings.
    """
    windows = staged(_windows(_words(items.select(F.col(item_col).cast("string").alias("_item"), F.col(item_text_col).alias("_item_text")), "_item_text", "_item"), span), "item-windows")
    spark = docs.sparkSession
    gram_of = {length: gram if length == span else length for length in range(1, span + 1)}
    lengths = sorted(row["_length"] for row in windows.select("_length").distinct().collect())  # `span` values at most
    named = [
        _fingerprints(windows.where(F.col("_length") == n).select(F.split("_window", " ").alias("_words"), F.lit(0).alias("_t1"), F.lit(0).alias("_t2")), n, gram_of[n])
        .select(F.array_join("_words", " ").alias("_window"), F.lit(n).alias("_length"), F.get("_least", F.lit(0)).alias("_item_fp")) for n in lengths
    ]
    distinct = staged(reduce(DataFrame.union, named, spark.createDataFrame([], "_window string, _length int, _item_fp long")).distinct(), "distinct-windows")

    words = _words(docs, text_col)
    met = []
    for n in lengths:
        mine = _fingerprints(words, n, gram_of[n]).select(*KEY, F.explode(F.array_distinct("_least")).alias("fp"))
        met.append(mine.join(distinct.where(F.col("_length") == n), F.col("fp") == F.col("_item_fp"), "left_semi").select(*KEY))
    met_texts = staged(reduce(DataFrame.union, met, spark.createDataFrame([], "_t1 long, _t2 long")).distinct(), "met-texts")
    met_texts = met_texts.select(F.col("_t1").alias("_m1"), F.col("_t2").alias("_m2"))
    text = text_or_empty(text_col)
    texts = docs.select(text.alias("_text"), F.xxhash64(text).alias("_t1"), F.xxhash64(F.lit(1), text).alias("_t2"))
    suspects = texts.join(met_texts, (F.col("_t1") == F.col("_m1")) & (F.col("_t2") == F.col("_m2"))).select(*KEY, "_text").dropDuplicates(KEY)
    suspects = staged(suspects.select(*KEY, alnum_words(F.col("_text")).alias("_words")), "suspects")

    seeds = []
    for n in lengths:
        runs = _runs(_fingerprints(suspects, n, gram_of[n]))
        runs = runs.join(distinct.where(F.col("_length") == n), F.col("fp") == F.col("_item_fp"), "left_semi")
        seeds.append(runs.select(*KEY, F.lit(n).alias("_length"), "first", "last"))
    seeded = (
        reduce(DataFrame.union, seeds, spark.createDataFrame([], "_t1 long, _t2 long, _length int, first int, last int"))
        .groupBy(F.col("_t1").alias("_m1"), F.col("_t2").alias("_m2")).agg(F.collect_set(F.struct("_length", "first", "last")).alias("_runs"))
    )

    hits = (
        suspects.join(seeded, (F.col("_t1") == F.col("_m1")) & (F.col("_t2") == F.col("_m2")))
        .select(*KEY, F.expr("""inline(flatten(transform(_runs, r -> transform(sequence(r.first, r.last), s ->
            struct(s as _start, s + r._length as _end, array_join(slice(_words, s + 1, r._length), ' ') as _hit)))))"""))
        .join(distinct, F.col("_hit") == F.col("_window"), "left_semi")
    )
    hits = staged(hits, "hits")
    order = Window.partitionBy(*KEY).orderBy("_start", "_end")
    reached = F.max("_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = (
        hits.select(*KEY, "_start", "_end")
        .withColumn("_new", (F.col("_start") > F.coalesce(reached, F.lit(-1))).cast("int"))
        .withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*KEY, "_island").agg(F.min("_start").alias("_from"), F.max("_end").alias("_to"))
        .groupBy(*KEY).agg(
            F.sum(F.col("_to") - F.col("_from")).cast("long").alias("n_hit"),
            F.sort_array(F.collect_list(F.struct(F.col("_from").alias("first"), (F.col("_to") - 1).alias("last")))).alias("spans"),
        )
    )
    found = (
        hits.select(*KEY, "_hit")
        .join(windows, F.col("_hit") == F.col("_window"))
        .groupBy(*KEY).agg(F.sort_array(F.collect_set("_item")).alias("items"))
    )
    return staged(spans.join(found, KEY).select(*KEY, "n_hit", "items", "spans"), "contaminated")


def decontaminated(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM, text_col: str = "text") -> DataFrame:
    """All columns of `docs` and n_words, n_hit, items, spans, contaminated for every row."""
    found = find(docs, items, span, gram, text_col)
    text = text_or_empty(text_col)
    kept = [c for c in docs.columns if c not in {"n_words", "n_hit", "items", "spans", "contaminated"}]
    rows = docs.select(
        *(F.col(f"`{c}`") for c in kept), F.xxhash64(text).alias("_d1"), F.xxhash64(F.lit(1), text).alias("_d2"),
        F.size(alnum_words(text)).cast("long").alias("n_words"),
    )
    return rows.join(found, (F.col("_d1") == F.col("_t1")) & (F.col("_d2") == F.col("_t2")), "left").select(
        *(F.col(f"`{c}`") for c in kept), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans", F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that share no window with an item, unchanged."""
    found = find(docs, items, span, gram, text_col).select(*KEY)
    text = text_or_empty(text_col)
    same = (F.xxhash64(text) == found["_t1"]) & (F.xxhash64(F.lit(1), text) == found["_t2"])
    return docs.join(found, same, "left_anti")
