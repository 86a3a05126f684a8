"""Repeated byte strings by prefix doubling over sampled suffixes.

The name of the 2h bytes at a position is made from the pair of names h bytes apart, starting from
8 bytes and doubling to 256 within the text; any longer string, up to 512 bytes, is the pair of the names of its first and
last 256 bytes. These are the widths at the threshold of 400 bytes; `Widths` derives those of other thresholds. Spark sorts such pairs together with their positions, at three growing lengths, and only positions
whose pair is shared go on to the next:

1. Anchors sampled by content (at 400 bytes the smallest 8-gram of any 128 neighbours, one for about 64
   bytes); the pair covers what all suffixes that begin before an anchor have in common.
2. In texts that are left, anchors of any 32 neighbours and a longer common part. Anchors whose whole
   stretch of suffixes, every byte of it, recurs are settled here.
3. Every single position of the other stretches (the ends of repeats), at the full threshold, together with
   those of one settled stretch of each kind that shares their common part.

Sampling loses nothing. Whether a position is an anchor depends on the bytes around it that
belong to every string of `threshold` bytes it stands for, so equal strings have equal
anchors at equal places. Only equality of all `threshold` bytes, as a pair of 64-bit names, removes a byte.

All results belong to a text, not to a row. A text that several rows share is repeated as a whole, and for
all others it counts as one occurrence, so large groups of copies cost one aggregation.

Defined results: a null text is empty; texts below the threshold keep all bytes; null ids and repeated
rows keep their rows, and a repeated row is a copy; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreleaf.llm.common import slices, staged, text_or_empty

THRESHOLD = 400
BLOCK = 1 << 20  # start positions of a long text that are worked on at a time
KEY = ["_t1", "_t2"]


@dataclass(frozen=True)
class Widths:
    """What follows from a threshold in bytes. coarse, fine: neighbours of which the smallest is an anchor; named: bytes of a name."""

    threshold: int = THRESHOLD

    def __post_init__(self) -> None:
        if self.threshold < 100:
            raise ValueError("the threshold is 100 bytes at least")

    @property
    def coarse(self) -> int:
        return min(128, (self.threshold - 6) // 3)

    @property
    def fine(self) -> int:
        return min(32, self.coarse // 4)

    @property
    def named(self) -> int:
        """Two names cover a stretch (threshold + fine), and one fits into the coarse common part; a power of two where one does."""
        least, most = -(-(self.threshold + self.fine) // 2), self.threshold - self.coarse + 1
        power = 1 << (most.bit_length() - 1)
        return power if power >= least else least


_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd multipliers
_HALF = np.uint64(32)


def _paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first * _A + (second ^ (second >> _HALF)) * _B
    x ^= x >> _HALF
    x *= _A
    return x ^ (x >> np.uint64(29))


def grams(codes: np.ndarray) -> np.ndarray:
    """Names of the 8 bytes at each position."""
    out = np.empty(len(codes) - 7, np.uint64)
    for at in range(8):
        part = codes[at : at + (len(codes) - at) // 8 * 8].view("<u8")
        out[at::8] = part[: len(out[at::8])]
    return _paired(out, out)


def doubled(names: np.ndarray, named: int) -> np.ndarray:
    """Names of `named` bytes from those of 8."""
    length = 8
    while length < named:
        step = min(length, named - length)
        names = _paired(names[:-step], names[step:])
        length += step
    return names


def _extreme(values: np.ndarray, width: int, of: Callable) -> np.ndarray:
    """Smallest or largest of each `width` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        values = of(values[:-have], values[have:])
        have *= 2
    return values if have == width else of(values[: len(values) - (width - have)], values[width - have :])


def anchors(names: np.ndarray, width: int) -> np.ndarray:
    """Positions whose value is the smallest of some `width` neighbours that hold them."""
    values = (names >> _HALF).astype(np.uint32)
    reach = _extreme(_extreme(values, width, np.minimum), width, np.maximum)
    return np.flatnonzero(values[width - 1 : width - 1 + len(reach)] == reach) + width - 1


def _blocks(text: bytes, w: Widths) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(first start, end of starts, offset, codes): parts of a text with all bytes their starts depend on."""
    for first in range(0, len(text) - w.threshold + 1, BLOCK):
        end = min(first + BLOCK, len(text) - w.threshold + 1)
        offset = max(0, first - 4 * w.coarse)
        yield first, end, offset, np.frombuffer(text, np.uint8)[offset : end + w.threshold + 4 * w.coarse]


def _stretches(first: int, end: int, offset: int, names: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, the ones before them (-1: none), and the first and last start that each anchor stands for."""
    at = anchors(names, width)
    before = np.concatenate(([-1], at[:-1])) if len(at) else at
    low = np.where(before < 0, 0, before + offset - width + 2)
    high = at + offset - width + 1
    low, high = np.maximum(low, first), np.minimum(high, end - 1)
    used = low <= high
    return at[used], before[used], low[used], high[used]


def _coarse(text: bytes, w: Widths = Widths()) -> Iterator[tuple[np.ndarray, ...]]:
    """(at, low, high, part): anchors with the folded pair of what their strings have in common."""
    length = w.threshold - w.coarse + 1
    for first, end, offset, codes in _blocks(text, w):
        names = grams(codes)
        at, _, low, high = _stretches(first, end, offset, names, w.coarse)
        long = doubled(names, w.named)
        start = at - w.coarse + 1
        yield at + offset, low, high, _paired(long[start], long[start + length - w.named])


def _fine(text: bytes, lows: np.ndarray, highs: np.ndarray, w: Widths) -> Iterator[tuple[np.ndarray, ...]]:
    """(at, low, high, part, gap, w1, w2): fine anchors of the given stretches and the 128-bit name of the whole stretch; gap 0: it has none."""
    length = w.threshold - w.fine + 1
    order = np.argsort(lows)
    lows, highs = lows[order], highs[order]
    for first, end, offset, codes in _blocks(text, w):
        names = grams(codes)
        at, before, low, high = _stretches(first, end, offset, names, w.fine)
        reached = np.maximum.accumulate(highs)
        near = np.searchsorted(lows, high, "right") - 1
        open_ = (near >= 0) & (reached[np.maximum(near, 0)] >= low)
        at, before, low, high = at[open_], before[open_], low[open_], high[open_]
        long = doubled(names, w.named)
        start = at - w.fine + 1
        part = _paired(long[start], long[start + length - w.named])
        head, tail = before - w.fine + 1, at - w.fine + 1 + w.threshold
        whole = (before >= 0) & (head >= 0) & (tail <= len(codes))
        head, tail = np.where(whole, head, 0), np.where(whole, tail, w.named)
        gap, first, last = np.where(whole, at - before, 0), long[head], long[tail - w.named]
        yield at + offset, low, high, part, gap, _paired(first, last), _paired(last + gap.astype(np.uint64) * _B, first)


def _single(text: bytes, lows: np.ndarray, highs: np.ndarray, w: Widths) -> Iterator[tuple[np.ndarray, ...]]:
    """(at, head, tail): every start of the given stretches and the pair of its whole string."""
    for first, end, offset, codes in _blocks(text, w):
        wanted = np.zeros(end - first + 1, np.int32)
        low, high = np.maximum(lows, first), np.minimum(highs, end - 1)
        used = low <= high
        np.add.at(wanted, low[used] - first, 1)
        np.add.at(wanted, high[used] + 1 - first, -1)
        at = np.flatnonzero(np.cumsum(wanted)[:-1]) + first
        if len(at):
            long = doubled(grams(codes), w.named)
            yield at, long[at - offset], long[at - offset + w.threshold - w.named]


def _positions(df: DataFrame, work: Callable[..., Iterator[tuple[np.ndarray, ...]]], names: list[str], w: Widths) -> DataFrame:
    """Rows that `work` finds in each text, behind the text's key; stretches are given where `df` has them."""
    wide = {"part", "w1", "w2", "head", "tail"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text", 1 << 20):
                found: list[list[np.ndarray]] = [[] for _ in range(len(names) + 2)]
                t1, t2 = (batch.column(k).to_numpy() for k in (0, 1))
                stretches = [batch.column(k) for k in range(3, batch.num_columns)]
                for row, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                    for arrays in work(text, *(s[row].values.to_numpy(zero_copy_only=False) for s in stretches), w):
                        n = len(arrays[0])
                        for column, values in zip(found, (np.full(n, t1[row]), np.full(n, t2[row]), *arrays)):
                            column.append(values)
                if found[0]:
                    columns = [np.concatenate(column) for column in found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c.view(np.int64)) if n in wide or n in KEY else pa.array(c.astype(np.int32)) for n, c in zip(KEY + names, columns)], KEY + names,
                    )

    kinds = ", ".join(f"{n} {'long' if n in wide else 'int'}" for n in names)
    return df.mapInArrow(run, f"_t1 long, _t2 long, {kinds}")


def _shared(found: DataFrame, key: list[str]) -> DataFrame:
    """The values of `key` that stand at two places, of one text or of several; copies of a text are one place."""
    place = F.xxhash64("_t1", "at")
    again = found.groupBy(*key).agg(F.min(place).alias("_a"), F.max(place).alias("_b")).where("_a <> _b")
    return again.select(*(F.col(c).alias(f"_{c}") for c in key))


def _recurring(found: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose value of `key` stands at two places; the other columns are the place.

    Search and join take the same columns and, as it is stated that no value is null, the same filters, so the rows are shuffled once for both.
    """
    dealt = found.where(" AND ".join(f"{c} IS NOT NULL" for c in found.columns)).repartition(*key)
    place = F.xxhash64(*[c for c in found.columns if c not in key])
    again = dealt.groupBy(*key).agg(F.min(place).alias("_a"), F.max(place).alias("_b")).where("_a <> _b")
    return dealt.join(again.select(*(F.col(c).alias(f"_{c}") for c in key)), _equal(key)).select(found.columns)


def _equal(key: list[str]) -> Column:
    same = F.col(key[0]) == F.col(f"_{key[0]}")
    for c in key[1:]:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return same


def _keyed(docs: DataFrame, text_col: str, *kept: Column) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.xxhash64(text).alias("_t1"), F.xxhash64(F.lit(1), text).alias("_t2"), *kept, text.alias("_text"))


def _merged(low: np.ndarray, end: np.ndarray) -> list[dict[str, int]]:
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(end[order])
    begins = np.flatnonzero(np.concatenate(([True], low[1:] > reach[:-1])))
    lasts = np.concatenate((begins[1:] - 1, [len(low) - 1]))
    return [{"first": int(a), "end": int(b)} for a, b in zip(low[begins], reach[lasts])]


def repeats(docs: DataFrame, text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(_t1, _t2, spans, kept, kept_text) of each text with a string of `threshold` bytes that stands elsewhere too, copies apart.

    `spans` are the maximal runs of such bytes (first, end), `kept` the other bytes (binary),
    `kept_text` the same without characters that a removed run has cut through.
    """
    w = Widths(threshold)
    texts = _keyed(docs, text_col).where(F.octet_length("_text") >= w.threshold)
    # Every anchor is shuffled: a stretch is one long, and half a text's key will do, as what is found here is only looked at more closely below.
    stretch = (F.shiftleft(F.col("high").cast("long"), 16) + (F.col("high") - F.col("low"))).alias("_stretch")
    found = staged(_positions(texts, _coarse, ["at", "low", "high", "part"], w).select("_t1", stretch, "part"), "coarse-anchors")
    stretches = _recurring(found, ["part"]).groupBy("_t1").agg(F.collect_set("_stretch").alias("_s")).select(
        F.col("_t1").alias("_c1"), F.expr("transform(_s, x -> int(shiftright(x, 16) - (x & 65535)))").alias("_lows"),
        F.expr("transform(_s, x -> int(shiftright(x, 16)))").alias("_highs"),
    )
    left = staged(texts.join(stretches, F.col("_t1") == F.col("_c1")).select(*KEY, "_text", "_lows", "_highs").dropDuplicates(KEY), "texts-left")

    found = staged(_positions(left, _fine, ["at", "low", "high", "part", "gap", "w1", "w2"], w), "fine-anchors")
    place = F.xxhash64("_t1", "at")
    whole = ["w1", "w2"]
    classes = found.where("gap > 0").groupBy(*whole).agg(F.min(place).alias("_a"), F.max(place).alias("_b")).where("_a <> _b")
    classes = classes.select(F.col("w1").alias("_w1"), F.col("w2").alias("_w2"), "_a")
    judged = staged(found.join(classes, _equal(whole) & (F.col("gap") > 0), "left").select(
        *KEY, "at", "low", "high", "part", "gap", F.col("_a").isNotNull().alias("_sure"), F.coalesce(place == F.col("_a"), F.lit(False)).alias("_first"),
    ), "fine-anchors-judged")
    columns = [*KEY, "low", "high", "_sure"]
    open_rows = staged(judged.where("not _sure").join(_shared(judged, ["part"]), _equal(["part"]), "left_semi").select(*columns, "part"), "open-stretches")
    # A start in an open stretch may recur in one that is settled: one stretch of each such kind is listed with the open ones.
    open_parts = open_rows.select(F.col("part").alias("_part")).distinct()
    listed = judged.where("_first").join(open_parts, _equal(["part"]), "left_semi").select(
        *KEY, (F.col("at") - F.col("gap") - w.fine + 2).alias("low"), (F.col("at") - w.fine + 1).alias("high"), F.lit(False).alias("_sure"),
    )
    judged = judged.where("_sure").select(*columns).union(open_rows.select(*columns))
    judged = judged.union(listed).groupBy(*KEY).agg(
        F.collect_set(F.when(F.col("_sure"), F.struct("low", "high"))).alias("_sure"), F.collect_set(F.when(~F.col("_sure"), F.struct("low", "high"))).alias("_open"),
    ).select(F.col("_t1").alias("_c1"), F.col("_t2").alias("_c2"), "_sure", F.col("_open.low").alias("_lows"), F.col("_open.high").alias("_highs"))
    same_text = (F.col("_t1") == F.col("_c1")) & (F.col("_t2") == F.col("_c2"))
    open_ = staged(left.drop("_lows", "_highs").join(judged, same_text).drop("_c1", "_c2"), "texts-open")

    found = staged(_positions(open_.select(*KEY, "_text", "_lows", "_highs"), _single, ["at", "head", "tail"], w), "single-starts")
    starts = _recurring(found, ["head", "tail"]).groupBy(*KEY).agg(F.collect_set("at").alias("_starts"))
    starts = starts.select(F.col("_t1").alias("_c1"), F.col("_t2").alias("_c2"), "_starts")
    settled = open_.join(starts, same_text, "left").select(
        *KEY, "_text", F.col("_sure.low").alias("_lows"), F.col("_sure.high").alias("_highs"), F.coalesce("_starts", F.array().cast("array<int>")).alias("_starts"),
    )

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        for whole_batch in batches:
            for batch in slices(whole_batch, "_text"):
                taken, runs, rest, readable = [], [], [], []
                lists = [batch.column(k) for k in (3, 4, 5)]
                for row, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                    low, high, single = (x[row].values.to_numpy(zero_copy_only=False) for x in lists)
                    if not len(low) + len(single):
                        continue
                    found_spans = _merged(np.concatenate((low, single)), np.concatenate((high, single)) + w.threshold)
                    edges = [0, *(e for s in found_spans for e in (s["first"], s["end"])), len(text)]
                    taken.append(row)
                    runs.append(found_spans)
                    pieces = [text[a:b] for a, b in zip(edges[::2], edges[1::2])]
                    rest.append(b"".join(pieces))
                    readable.append("".join(piece.decode("utf-8", "ignore") for piece in pieces))
                some = batch.take(pa.array(taken, pa.int32()))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(runs, kind), pa.array(rest, pa.binary()), pa.array(readable, pa.string())], [*KEY, "spans", "kept", "kept_text"])

    return settled.mapInArrow(spans, "_t1 long, _t2 long, spans array<struct<first:int,end:int>>, kept binary, kept_text string")


def facts(docs: DataFrame, text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(_f1, _f2, _copied, spans, kept, kept_text) of each text that loses bytes; `_copied` ones, which several rows share, lose all."""
    copied = (
        _keyed(docs, text_col).where(F.octet_length("_text") >= threshold).groupBy(F.col("_t1").alias("_c1"), F.col("_t2").alias("_c2"))
        .agg(F.count("*").alias("_copies")).where("_copies > 1")
    )
    found = repeats(docs, text_col, threshold).select(F.col("_t1").alias("_r1"), F.col("_t2").alias("_r2"), "spans", "kept", "kept_text")
    return staged(copied.join(found, (F.col("_c1") == F.col("_r1")) & (F.col("_c2") == F.col("_r2")), "full").select(
        F.coalesce("_c1", "_r1").alias("_f1"), F.coalesce("_c2", "_r2").alias("_f2"), F.col("_copies").isNotNull().alias("_copied"), "spans", "kept", "kept_text",
    ), "repeats")


def with_facts(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """Rows that have a text's key and n_bytes, joined with its facts: spans is null where nothing is removed."""
    joined = keyed.join(found, (F.col("_t1") == F.col("_f1")) & (F.col("_t2") == F.col("_f2")), "left").drop("_f1", "_f2")
    everything = F.array(F.struct(F.lit(0).alias("first"), F.col("n_bytes").cast("int").alias("end")))
    return joined.withColumns({
        "spans": F.when(F.col("_copied"), everything).otherwise(F.col("spans")),
        "kept": F.when(F.col("_copied"), F.expr("X''")).otherwise(F.col("kept")),
        "kept_text": F.when(F.col("_copied"), F.lit("")).otherwise(F.col("kept_text")),
    }).drop("_copied")


def keyed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of `docs`, the key of the text, its bytes `_text` and their number n_bytes."""
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in {"n_bytes", "spans", "kept", "kept_text"}]
    return _keyed(docs, text_col, *columns).withColumn("n_bytes", F.octet_length("_text").cast("long"))


def without_repeats(docs: DataFrame, text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """All columns of `docs` and n_bytes, spans (null: none), and kept and kept_text, what remains, for every row."""
    rows = keyed(docs, text_col)
    joined = with_facts(rows, facts(docs, text_col, threshold))
    text = text_or_empty(text_col) if text_col in docs.columns and text_col in rows.columns else F.col("_text")  # so that a text goes through the join once
    return joined.withColumns({"kept": F.coalesce("kept", text.cast("binary")), "kept_text": F.coalesce("kept_text", text)}).drop(*KEY, "_text")
