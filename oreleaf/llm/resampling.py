"""Importance resampling towards a target: documents whose hashed n-grams look like the target's are drawn more often.

A text's ASCII capitals are lowered and an untrained Regex Split of the tokenizers library gives its words with their
offsets. The features are the windows of one to `N` neighbouring words, joined by one space; a window is the pair of its first
word's start and its last word's end in the row of words, and its bucket is the CRC-32 of its bytes. CRC is linear, so the value of a
window follows from its words' values and lengths (`Crc.joined`) and all windows of a batch are computed at once.

The first pass sums bucket counts: a task emits one histogram, Spark adds them up (`buckets` rows, whatever the corpus). The gains of the
buckets, as many, go to all tasks, and the second pass sums them over each document. Words are taken again in place of
being stored, as a stored window list would be as large as the texts. A process remembers the words of the pieces between spaces it has seen, up
to a fixed number, and asks the library for all new pieces of a batch together.

The drawn documents are the highest scores (weight plus Gumbel noise from a hash of the id): scores are dealt out by range, each
range is counted, and a document's rank is the count of the ranges above plus its place in its own. Nothing is sorted in one task.

Defined results: a null text has no words; a null id hashes as the empty string and comes first among equal scores; equal rows are ranked one after
the other; with no documents the result is empty, with no target texts every gain follows from T = 0; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from oreleaf.llm.common import ALNUM_WORD, UPPER, PieceMemo, slices, space_parts, staged, text_or_empty

N = 3
BUCKETS = 10_000
SEED = 42
MIN_WORDS = 20
PERCENT = 5
PIECES_A_CALL = 200
SHORT = 64  # bytes of a word and a space before it that have a table of their own
ROWS_A_RANGE = 2_000_000

_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


class Crc:
    """CRC-32 of joined strings from those of their parts, by tables of what following zero bytes do to a value."""

    def __init__(self):
        one = np.empty(1 << 8, np.uint32)  # the effect of one zero byte on each value of the low byte
        for value in range(256):
            v = value
            for _ in range(8):
                v = v >> 1 ^ (0xEDB88320 if v & 1 else 0)
            one[value] = v
        shift = np.arange(256, dtype=np.uint32)
        first = np.stack([one, shift, shift << 8, shift << 16])  # a byte moves down, the lowest is spread
        self.powers = [first]  # of 1, 2, 4, ... bytes
        while len(self.powers) < 32:
            last = self.powers[-1]
            self.powers.append(np.stack([self._over(last, row) for row in last]))
        some = [np.stack([shift, shift << 8, shift << 16, shift << 24])]  # of 0, 1, 2, ... bytes
        while len(some) < SHORT:
            some.append(np.stack([self._over(first, row) for row in some[-1]]))
        self.some = np.concatenate(some, axis=1)  # a row for each byte of a value

    @staticmethod
    def _over(table: np.ndarray, values: np.ndarray) -> np.ndarray:
        return table[0][values & 255] ^ table[1][values >> 8 & 255] ^ table[2][values >> 16 & 255] ^ table[3][values >> 24]

    def joined(self, left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Values of left strings followed by right ones of these lengths."""
        at = np.minimum(lengths, SHORT - 1).astype(np.int64) << 8
        out = self.some[0][at | left & 255] ^ self.some[1][at | left >> 8 & 255] ^ self.some[2][at | left >> 16 & 255] ^ self.some[3][at | left >> 24]
        for place in np.flatnonzero(lengths >= SHORT):  # rare: very long words
            value, length = left[place : place + 1], int(lengths[place])
            for bit in range(length.bit_length()):
                if length >> bit & 1:
                    value = self._over(self.powers[bit], value)
            out[place] = value[0]
        return out ^ right


@cache
def _crc() -> Crc:
    return Crc()


WORD = np.dtype([("alone", "<u4"), ("after", "<u4"), ("length", "<u4")])  # CRC of a word, of a space and the word, and the latter's bytes


class Words:
    """The words of texts as WORD records, from those of their pieces between spaces: a word has no space in it."""

    def __init__(self, pattern: str = ALNUM_WORD):
        self.split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.memo = PieceMemo(self._records)

    def _records(self, pieces: list[str]) -> list[bytes]:
        """A call splits a row of pieces; a word's offset in the row says which piece it is of."""
        out: list[bytes] = []
        for at in range(0, len(pieces), PIECES_A_CALL):
            group = pieces[at : at + PIECES_A_CALL]
            found = self.split.pre_tokenize_str(" ".join(group))
            words = [word.encode() for word, _ in found]
            records = np.empty(len(words), WORD)
            records["alone"] = [zlib.crc32(word) for word in words]
            records["after"] = [zlib.crc32(word, 0xE96CCF45) for word in words]  # goes on from the CRC of a space
            records["length"] = [len(word) + 1 for word in words]
            ends = np.cumsum([len(piece) + 1 for piece in group])
            edges = (WORD.itemsize * np.searchsorted([start for _, (start, _) in found], ends)).tolist()
            raw = records.tobytes()
            out += [raw[a:b] for a, b in zip([0, *edges], edges)]
        return out

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words of the texts in one row, and each text's number of words."""
        packed = self.memo.joined(space_parts([text.encode().translate(_LOWER).decode() for text in texts]))
        return np.frombuffer(b"".join(packed), WORD), np.array([len(p) // WORD.itemsize for p in packed], np.int64)


def bucket_windows(words: Words, texts: list[str], n: int = N, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text) of every window of the texts, and each text's number of words."""
    row, per_text = words.of(texts)
    owner = np.repeat(np.arange(len(texts)), per_text)
    value, after, length = row["alone"], row["after"], row["length"]
    out_buckets, out_owner = [value % buckets], [owner]
    for width in range(2, n + 1):  # windows that start at each word and end width - 1 words on, in the same text
        whole = owner[: len(row) - width + 1] == owner[width - 1 :]
        last = slice(width - 1, None)
        value = _crc().joined(value[: len(row) - width + 1], after[last], length[last])
        out_buckets.append(value[whole] % buckets)
        out_owner.append(owner[: len(value)][whole])
    return np.concatenate(out_buckets).astype(np.int64), np.concatenate(out_owner), per_text


@cache
def _words() -> Words:
    return Words()  # stays with a process for its next task


def _passes(batches: Iterator[pa.RecordBatch], n: int, buckets: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    words = _words()
    for whole in batches:
        for batch in slices(whole, "_text", 1 << 20):
            yield batch, *bucket_windows(words, batch.column("_text").to_pylist(), n, buckets)


def histogram(docs: DataFrame, text_col: str = "text", n: int = N, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows; buckets without a feature have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for _, found, _, _ in _passes(batches, n, buckets):
            counts += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["bucket", "n"])

    return docs.select(text_or_empty(text_col).alias("_text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of all buckets from two histograms: floored thousandths of the log ratio of smoothed shares."""
    spark = source.sparkSession
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    each = (
        spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
        .join(source.select("bucket", F.col("n").alias("_s")), "bucket", "left").join(target.select("bucket", F.col("n").alias("_t")), "bucket", "left")
        .select("bucket", F.coalesce("_s", F.lit(0)).cast("double").alias("s"), F.coalesce("_t", F.lit(0)).cast("double").alias("t"))
        .select("bucket", "s", "t", F.sum("s").over(every).alias("all_s"), F.sum("t").over(every).alias("all_t"))  # `buckets` rows
    )
    ratio = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    return each.select("bucket", F.floor(1000 * F.ln(ratio)).cast("long").alias("gain"))


def weights(docs: DataFrame, gain: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, buckets: int = BUCKETS) -> DataFrame:
    """`id_col`, n_words, n_features, weight of every row."""
    of_bucket = np.zeros(buckets, np.int64)
    for row in gain.collect():  # `buckets` rows
        of_bucket[row["bucket"]] = row["gain"]
    sent = docs.sparkSession.sparkContext.broadcast(of_bucket)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found, owner, per_text in _passes(batches, n, buckets):
            sums = np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, owner, sent.value[found])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(per_text), pa.array(np.bincount(owner, minlength=batch.num_rows).astype(np.int64)), pa.array(sums),
            ], [id_col, "n_words", "n_features", "weight"])

    given = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    return given.mapInArrow(run, f"`{id_col}` {given.schema[id_col].dataType.simpleString()}, n_words long, n_features long, weight long")


def noise(id_col: str, seed: int = SEED) -> Column:
    """Floored thousandths of a Gumbel variate that the seed and the id decide."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def drawn(scored: DataFrame, eligible: Column, percent: int = PERCENT, id_col: str = "doc_id") -> DataFrame:
    """All columns of `scored` and rank: 1, 2, ... of the floor(percent/100) highest scores among eligible rows, ties to the smaller id; else null.

    Rows are dealt out by (eligible, score, id, place in the input), so equal scores and ids part too.
    """
    rows = staged(scored.withColumns({"_able": F.coalesce(eligible, F.lit(False)), "_place": F.monotonically_increasing_id()}), "scores")
    spark = rows.sparkSession
    n_rows, n_able = rows.agg(F.count("*"), F.count_if("_able")).first()
    order = [F.desc("_able"), F.desc("score"), F.asc(id_col), F.asc("_place")]
    n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // ROWS_A_RANGE + 1)
    ranges = staged(rows.repartitionByRange(n_ranges, *order).withColumn("_range", F.spark_partition_id()), "score-ranges")
    above = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy(F.col("_range").alias("_at")).agg(F.count("*").alias("_rows"))  # a row for each range
    totals = totals.select("_at", F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_above"))
    rank = F.col("_above") + F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = ranges.join(F.broadcast(totals), F.col("_range") == F.col("_at")).withColumn("_rank", rank)
    drawn_row = F.col("_able") & (F.col("_rank") <= percent * n_able // 100)
    return placed.select(*[F.col(f"`{c}`") for c in scored.columns if c != "rank"], F.when(drawn_row, F.col("_rank")).cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """`id_col`, n_words, n_features, weight, score, rank of every row of `docs`; rank is null where the row is not drawn."""
    gain = gains(histogram(docs, text_col), histogram(target, target_text_col))
    scored = weights(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise(id_col))
    return drawn(scored, F.col("n_words") >= MIN_WORDS, percent, id_col)
