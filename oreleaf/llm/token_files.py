"""Token ids in compressed files: canonical length-limited Huffman codes of global counts, in independent blocks.

`tokenize` gives the ids of every text. `write` counts them over the whole table (a task emits one row for each id it saw, Spark adds them up),
builds code lengths of at most `max_bits` by package-merge on those counts (one row for each id of the vocabulary), and writes three Parquet
tables below a folder:

* `codes` (id, n_bits, n): canonical, so the code itself follows from the lengths: shorter codes first, equal lengths by id;
* `blocks` (part, block, first, ids_of, n_tokens, marks, bits): rows in ascending order of the document's id. `bits` holds the documents' codes one after
  the other, each document from a whole byte on, most significant bit first; `n_tokens` the ids of each; `marks` (unsigned 32-bit, little-endian) is the bit
  offset of every `STEP`-th id of each document, so that a block is decoded on its own and all its stretches at once;
* `parts` (part, n_documents, n_ids, start): totals of the range of documents that one task wrote, and the ids before it.

Documents are put into order by one shuffle of their codes, about a third of the ids' own size, into ranges of (id, place in the input), so rows of one
id can part too; ranges come from a sample of ids of bounded size, which decides how even they are and nothing else. A range's place follows from the totals of those before, so nothing is sorted or summed in one task. `read` decodes blocks, each in any task, by one table look-up for each id.

A text's ids are those of its pieces between spaces, as the tokenizer drops white space before it looks for tokens; a process remembers
pieces it has seen, up to a fixed number. A batch is split and put together again by Arrow, so each of its different pieces is looked up once; of new ones, the library's
model gets words of Latin letters, with what it would be given for them, and the library the others together.

Defined results: a null text is the empty one and has the end id alone; null ids are no ids; a null document id comes first; rows of one
id follow one another; an empty table writes no block and reads as an empty one; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreleaf.llm.common import PieceMemo, shared_folder, slices, text_or_empty

MAX_BITS = 18  # of a code; a decoding table has 2^18 entries
STEP = 256  # ids between two marks
BLOCK_BYTES = 1 << 20
BLOCK_DOCUMENTS = 1 << 16
IDS_A_RANGE = 500_000_000
SAMPLE_A_RANGE, SAMPLE = 100, 1_000_000
PIECES_A_CALL = 200

# Letters of which the tokenizer may read a run as one word, and marks that may stand behind a word (no apostrophe).
_LETTERS = "".join(chr(c) for c in range(256) if chr(c).isalpha() and chr(c) not in "ªµº")
_MARKS = "".join(chr(c) for c in range(33, 127) if chr(c) != "'" and not chr(c).isalnum())
_LETTER_SET = frozenset(_LETTERS)
_ENDINGS = 10_000  # endings of marks that are remembered


class Ids:
    """Packed ids of texts from those of their pieces between spaces."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(tokenizer)
        self.model.no_padding()
        self.model.no_truncation()
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        self.merged = self.model.model.tokenize
        self.packed = [_pack([number]) for number in range(max(self.model.get_vocab().values(), default=-1) + 1)]
        self.letters = self._read_as()
        self.endings: dict[str, bytes | None] = {}
        self.memo = PieceMemo(self._encoded, 300_000)

    def _read_as(self) -> dict[int, str]:
        """What the model is given for each letter, if the tokenizer lower-cases ASCII and takes a word letter by letter and as a whole; else nothing."""

        def given(text: str) -> list[str]:
            return [piece for piece, _ in self.model.pre_tokenizer.pre_tokenize_str(self.model.normalizer.normalize_str(text))]

        table = {ord(c): "".join(given(c)) for c in _LETTERS}
        whole = all(given(word) == [word.translate(table)] for word in (_LETTERS, _LETTERS[::-1], *_LETTERS)) and all(table[ord(c)] == c.lower() for c in _LETTERS if c.isascii())
        return table if whole else {}

    def _ending(self, marks: str) -> bytes | None:
        """The ids of marks behind a word; None if the tokenizer does not read them apart from it."""
        if len(marks) > self.memo.longest:
            return None
        if marks not in self.endings:
            alone, after, word = (self.model.encode(text, add_special_tokens=False).ids for text in (marks, "ab" + marks, "ab"))
            if len(self.endings) >= _ENDINGS:
                self.endings = {}
            self.endings[marks] = _pack(alone) if after == word + alone else None
        return self.endings[marks]

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """Letters alone are one word of the model, whatever marks follow; other pieces are encoded in rows, where the place of a token says whose it is."""
        out: dict[str, bytes] = {}
        letters, merged, packed = self.letters, self.merged, self.packed
        for piece in pieces if letters else ():
            word = piece.rstrip(_MARKS)
            if word.isascii():
                if not word.isalpha():
                    continue
                given = word.lower()
            elif _LETTER_SET.issuperset(word):
                given = word.translate(letters)
            else:
                continue
            if len(word) == len(piece):
                out[piece] = b"".join([packed[token.id] for token in merged(given)])
            elif (ending := self._ending(piece[len(word) :])) is not None:
                out[piece] = (self.memo.known(word) or b"".join([packed[token.id] for token in merged(given)])) + ending
        rest = [piece for piece in pieces if piece not in out]
        for at in range(0, len(rest), PIECES_A_CALL):
            group = rest[at : at + PIECES_A_CALL]
            found = self.model.encode(" ".join(group), add_special_tokens=False)
            raw = np.array(found.ids, "<u4").tobytes()
            ends = np.cumsum([len(piece) + 1 for piece in group])
            edges = (4 * np.searchsorted([start for start, _ in found.offsets], ends)).tolist()
            out.update((piece, raw[a:b]) for piece, a, b in zip(group, [0, *edges], edges))
        return [out[piece] for piece in pieces]

    def of(self, texts: pa.Array) -> pa.Array:
        """Binary for each string."""
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = parts.flatten().dictionary_encode()
        whole = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        pieces = pc.binary_join(whole, "\n")[0].as_py().split("\n")  # no piece holds a line end, and there is one at least
        data = pa.array(self.memo.of(pieces), pa.binary()).take(coded.indices)
        return pc.binary_join(pa.ListArray.from_arrays(parts.offsets, data), pa.scalar(b"", pa.binary()))


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_loaded: dict[str, Ids] = {}  # stays with a process for its next task


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, token_ids binary (little-endian unsigned 32-bit, the end id last) of every row."""
    with open(tokenizer_path, encoding="utf-8") as file:  # a few MB whatever the corpus
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    end = pa.scalar(_pack([end_id]), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if sent.value not in _loaded:
            _loaded.clear()
            _loaded[sent.value] = Ids(sent.value)
        ids_of = _loaded[sent.value].of
        for whole in batches:
            for batch in slices(whole, "_text"):
                ids = pc.binary_join_element_wise(ids_of(batch.column("_text")), end, pa.scalar(b"", pa.binary()))
                yield pa.RecordBatch.from_arrays([batch.column(0), ids], [id_col, "token_ids"])

    given = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    return given.mapInArrow(run, f"`{id_col}` {given.schema[id_col].dataType.simpleString()}, token_ids binary")


def counts(tokens: DataFrame, ids_col: str = "token_ids") -> DataFrame:
    """(id, n) over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)  # as long as the largest id
        for whole in batches:
            for batch in slices(whole, "_ids"):
                found = np.bincount(_flat(batch.column(0))[0])
                if len(found) > len(total):
                    found, total = total, found
                total[: len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    return tokens.select(F.col(ids_col).alias("_ids")).mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(weights: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of the best prefix code with at most `max_bits` bits a symbol, by package-merge."""
    n = len(weights)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids do not fit codes of {max_bits} bits")
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(weights, kind="stable")
    symbols = np.asarray(weights, np.int64)[order]
    level, single = symbols, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([symbols, packages])
        by_weight = np.argsort(both, kind="stable")
        level = both[by_weight]
        single.append(by_weight < n)
    taken, lengths = 2 * n - 2, np.zeros(n, np.int64)
    for is_symbol in reversed(single):
        chosen = int(np.count_nonzero(is_symbol[:taken]))
        lengths[:chosen] += 1  # symbols enter a level from the lightest on
        taken = 2 * (taken - chosen)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Codes:
    """Canonical codes of (id, length) pairs: for writing by id, for reading by the next bits."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = np.asarray(ids, np.int64)[order], np.asarray(lengths, np.int64)[order]
        self.bits = int(self.lengths.max(initial=1))
        spans = np.int64(1) << (self.bits - self.lengths)
        self.codes = (np.cumsum(spans) - spans) >> (self.bits - self.lengths)  # each code begins where the one before it ends

    def writing(self) -> tuple[np.ndarray, np.ndarray]:
        """Code and length by id, as long as the largest id."""
        codes, lengths = (np.zeros(int(self.ids.max(initial=-1)) + 1, kind) for kind in (np.uint64, np.int64))
        codes[self.ids], lengths[self.ids] = self.codes, self.lengths
        return codes, lengths

    def reading(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and length of the code that the next `bits` bits begin with."""
        spans = np.int64(1) << (self.bits - self.lengths)
        table = np.zeros(1 << self.bits, np.uint32), np.ones(1 << self.bits, np.uint8)
        used = int(spans.sum())
        table[0][:used] = np.repeat(self.ids, spans)
        table[1][:used] = np.repeat(self.lengths, spans)
        return table


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows in one array, and each row's number of ids."""
    rows = [row or b"" for row in column.to_pylist()]
    return np.frombuffer(b"".join(rows), "<u4"), np.array([len(row) // 4 for row in rows], np.int64)


def _stretches(n_tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first id, ids) of every stretch of STEP ids, documents one after the other."""
    n = -(-n_tokens // STEP)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(np.cumsum(n_tokens) - n_tokens, n) + within * STEP, np.minimum(np.repeat(n_tokens, n) - within * STEP, STEP)


def packed(ids: np.ndarray, n_tokens: np.ndarray, writing: tuple[np.ndarray, np.ndarray]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The documents' codes, each from a whole byte on; the byte at which each ends; the bit offset of each stretch in its document."""
    codes, lengths = writing
    code, length = codes[ids], lengths[ids]
    ends = np.cumsum(length)
    edges = np.cumsum(n_tokens)
    to = np.concatenate([[0], ends])
    per_doc = to[edges] - to[edges - n_tokens]
    sizes = (per_doc + 7) // 8
    byte_ends = np.cumsum(sizes)
    moved = (byte_ends - sizes) * 8 - to[edges - n_tokens]  # from packed without gaps to whole bytes
    offsets = ends - length
    at = offsets + np.repeat(moved, n_tokens)
    words = np.zeros(int(byte_ends[-1]) // 4 + 3 if len(byte_ends) else 0, np.uint32)
    if len(ids):
        word = at >> 5
        value = code << (64 - (at & 31) - length).astype(np.uint64)
        begins = np.flatnonzero(np.diff(word, prepend=-1))
        both = np.bitwise_or.reduceat(value, begins)
        words[word[begins]] |= (both >> np.uint64(32)).astype(np.uint32)
        words[word[begins] + 1] |= (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    first, _ = _stretches(n_tokens)
    owner = np.repeat(np.arange(len(n_tokens)), -(-n_tokens // STEP))
    marks = offsets[first] - to[edges - n_tokens][owner]
    return words.astype(">u4").tobytes()[: int(byte_ends[-1]) if len(byte_ends) else 0], byte_ends, marks


def unpacked(bits: bytes, marks: np.ndarray, n_tokens: np.ndarray, reading: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ids of all documents of a block: every stretch takes its next id in the same step."""
    ids_of, length_of = reading
    width = len(length_of).bit_length() - 1
    data = np.frombuffer(bits + bytes(4), np.uint8).astype(np.uint32)
    ahead = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    first, sizes = _stretches(n_tokens)
    order = np.argsort(-sizes, kind="stable")  # those that still run come first
    first, at, sizes = first[order], marks[order].astype(np.int64), sizes[order]
    out = np.empty(int(n_tokens.sum()), "<u4")
    running = len(sizes)
    for step in range(int(sizes[0]) if len(sizes) else 0):
        while sizes[running - 1] <= step:
            running = int(np.searchsorted(-sizes, -step, "left"))
        now = at[:running]
        ahead_bits = ahead[now >> 3] >> (32 - width - (now & 7)).astype(np.uint32) & np.uint32((1 << width) - 1)
        out[first[:running] + step] = ids_of[ahead_bits]
        at[:running] += length_of[ahead_bits]
    return out


def _key(value, place: int) -> tuple:
    return (value is not None, value, place) if value is not None else (False, place)


def _bounds(keys: DataFrame, n_ranges: int) -> list[tuple]:
    """The first key of every range but the lowest, from a sample of some SAMPLE keys at most: it decides how even the ranges are, nothing else."""
    rows = keys.count()
    sample = keys.sample(min(1.0, min(n_ranges * SAMPLE_A_RANGE, SAMPLE) / max(rows, 1)), seed=7).collect()
    ordered = sorted(_key(*row) for row in sample)
    return [ordered[i * len(ordered) // n_ranges] for i in range(1, n_ranges)] if ordered else []


def write(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids", max_bits: int = MAX_BITS) -> None:
    """Write the tables named above below `path`. `tokens` is read three times (counts, a sample of ids, codes): give it written."""
    spark = tokens.sparkSession
    counted = counts(tokens, ids_col).collect()  # a row for each id of the vocabulary
    ids, n = np.array([r["id"] for r in counted], np.int64), np.array([r["n"] for r in counted], np.int64)
    bits = min(max(max_bits, int(len(ids)).bit_length()), 25)  # 25 bits and 7 before them fit a 32-bit word
    lengths = code_lengths(n, bits)
    spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist(), n.tolist())), "id long, n_bits long, n long").coalesce(1).write.parquet(f"{path}/codes")
    sent = spark.sparkContext.broadcast(Codes(ids, lengths).writing())
    given = tokens.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_place"), F.col(ids_col).alias("_ids"))
    kind = given.schema["_id"].dataType.simpleString()
    n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(n.sum()) // IDS_A_RANGE + 1)
    bounds = spark.sparkContext.broadcast(_bounds(given.select("_id", "_place"), n_ranges))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_ids"):
                flat, n_tokens = _flat(batch.column(2))
                data, ends, marks = packed(flat, n_tokens, sent.value)
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                stretches = np.cumsum(-(-n_tokens // STEP))
                raw = marks.astype("<u4").tobytes()
                edges = [0, *(stretches * 4).tolist()]
                keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(1), pa.array([bisect_right(bounds.value, _key(*key)) for key in keys], pa.int32()), pa.array(n_tokens),
                    pa.array([data[a:b] for a, b in zip(begins.tolist(), ends.tolist())], pa.binary()), pa.array([raw[a:b] for a, b in zip(edges, edges[1:])], pa.binary()),
                ], ["_id", "_place", "_range", "_n", "_bits", "_marks"])

    encoded = given.mapInArrow(encode, f"_id {kind}, _place long, _range int, _n long, _bits binary, _marks binary")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = before = 0
        kept: list[pa.RecordBatch] = []
        size = documents = 0

        def closed() -> pa.RecordBatch:
            nonlocal block, before
            whole = pa.Table.from_batches(kept).combine_chunks()
            n_tokens = whole["_n"].to_numpy()
            data, raw = whole["_bits"].to_pylist(), whole["_marks"].to_pylist()
            starts = np.cumsum([0, *map(len, data[:-1])]) * 8
            marks = np.frombuffer(b"".join(raw), "<u4") + np.repeat(starts, [len(m) // 4 for m in raw])
            one = lambda values: pa.array([values], pa.list_(values.type))
            out = pa.RecordBatch.from_arrays([
                pa.array([block], pa.int32()), pa.array([before], pa.int64()), one(whole["_id"].chunk(0)), one(pa.array(n_tokens)),
                pa.array([marks.astype("<u8").tobytes()], pa.binary()), pa.array([b"".join(data)], pa.binary()),
            ], ["block", "first", "ids_of", "n_tokens", "marks", "bits"])
            block, before = block + 1, before + int(n_tokens.sum())
            kept.clear()
            return out

        for whole in batches:
            for batch in slices(whole, "_bits", BLOCK_BYTES):
                length = batch.column("_bits").nbytes
                if kept and (size + length > BLOCK_BYTES or documents + batch.num_rows > BLOCK_DOCUMENTS):
                    yield closed()
                    size = documents = 0
                kept.append(batch)
                size, documents = size + length, documents + batch.num_rows
        if kept:
            yield closed()

    ranges = encoded.repartitionById(n_ranges, F.col("_range")).sortWithinPartitions("_id", "_place")
    made = ranges.mapInArrow(blocks, f"block int, first long, ids_of array<{kind}>, n_tokens array<long>, marks binary, bits binary")
    made.select(F.spark_partition_id().alias("part"), "*").write.parquet(f"{path}/blocks")
    totals = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(
        F.sum(F.size("n_tokens")).cast("long").alias("n_documents"), F.sum(F.expr("aggregate(n_tokens, 0L, (a, b) -> a + b)")).alias("n_ids"),
    )
    above = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals.withColumn("start", F.coalesce(F.sum("n_ids").over(above), F.lit(0))).coalesce(1).write.parquet(f"{path}/parts")  # a row for each range


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """`id_col`, start (ids of all documents before it), n_tokens, token_ids of every document in the files."""
    codes = spark.read.parquet(f"{path}/codes").select("id", "n_bits").collect()  # a row for each id of the vocabulary
    sent = spark.sparkContext.broadcast(Codes(np.array([r["id"] for r in codes]), np.array([r["n_bits"] for r in codes])).reading())
    parts = spark.read.parquet(f"{path}/parts").select(F.col("part").alias("_part"), "start")
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["ids_of"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for row in range(whole.num_rows):
                block = {name: whole.column(name)[row] for name in whole.schema.names}
                n_tokens = block["n_tokens"].values.to_numpy().astype(np.int64)
                marks = np.frombuffer(block["marks"].as_py(), "<u8").astype(np.int64)
                raw = unpacked(block["bits"].as_py(), marks, n_tokens, sent.value).tobytes()
                ends = np.cumsum(n_tokens)
                edges = [0, *(ends * 4).tolist()]
                yield pa.RecordBatch.from_arrays([
                    block["ids_of"].values, pa.array(block["_start"].as_py() + ends - n_tokens), pa.array(n_tokens),
                    pa.array([raw[a:b] for a, b in zip(edges, edges[1:])], pa.binary()),
                ], [id_col, "start", "n_tokens", "token_ids"])

    placed = blocks.join(F.broadcast(parts), F.col("part") == F.col("_part")).select(
        (F.col("start") + F.col("first")).alias("_start"), "ids_of", "n_tokens", "marks", "bits",
    )
    return placed.mapInArrow(decode, f"`{id_col}` {kind}, start long, n_tokens long, token_ids binary")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
