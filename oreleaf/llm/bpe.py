"""Byte-level BPE encoding and decoding by backtracking over longest matches.

A piece's bytes are read as Latin-1 characters, so that an Aho-Corasick automaton over
the vocabulary finds all tokens in it in one pass. From the left, the longest token that
starts at the current byte is tried, then its shorter prefixes; a token may follow another one only if the
two, merged as plain BPE would merge their bytes, stay two tokens. That test looks at two
tokens alone and is memoised. A position at which no token can follow is closed for good and the token
before it is taken back, so each byte is entered at most once per token length and the work is linear in
the piece. A sequence in which all neighbours are compatible is the one BPE makes.

Defined results: a null text encodes like the empty one, to no tokens; ids that are null
decode to no bytes; repeated rows are encoded each; an empty table gives an empty result.
Texts are encoded whole; a lone surrogate cannot occur in a Spark string.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterator
from contextlib import contextmanager

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreleaf.llm.common import slices, text_or_empty

PIECES_KEPT = 300_000
PAIRS_KEPT = 300_000


def by_rank(ranks: bytes) -> dict[int, bytes]:
    lines = (line.split() for line in ranks.splitlines() if line)
    return {int(rank): base64.b64decode(token) for token, rank in lines}


class Vocabulary:
    """Tokens by rank, the automaton over them and the memos of one task's process."""

    def __init__(self, ranks: bytes):
        self.token = by_rank(ranks)
        self.rank = {token: rank for rank, token in self.token.items()}
        self.latin = ahocorasick.Automaton()
        self.shorter: dict[int, int | None] = {}
        made = {token: rank for token, rank in self.rank.items() if self.merged(token) == [rank]}
        for token, rank in made.items():
            self.latin.add_word(token.decode("latin-1"), rank)
            prefixes = (made.get(token[:end]) for end in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((p for p in prefixes if p is not None), None)
        self.latin.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Plain BPE: merge the neighbours of the lowest rank until none can be merged."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranks = [self.rank.get(a + b) for a, b in zip(parts, parts[1:])]
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[part] for part in parts]

    def follows(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.merged(self.token[left] + self.token[right]) == [left, right]
            self.pairs[left, right] = known
        return known

    def encoded(self, piece: bytes) -> list[int]:
        if piece in self.rank:
            return [self.rank[piece]]
        longest: list[int] = [0] * len(piece)
        token = self.token
        for end, rank in self.latin.iter(piece.decode("latin-1")):
            longest[end + 1 - len(token[rank])] = rank  # later ends overwrite: the longest stays
        closed = bytearray(len(piece) + 1)
        out: list[int] = []
        at, now = 0, longest[0]
        while at < len(piece):
            while now is not None and (closed[at + len(token[now])] or out and not self.follows(out[-1], now)):
                now = self.shorter[now]
            if now is None:
                closed[at] = 1
                last = out.pop()
                at -= len(token[last])
                now = self.shorter[last]
            else:
                out.append(now)
                at += len(token[now])
                now = longest[at] if at < len(piece) else None
        return out


class Pieces(dict):
    """Packed ids by piece; forgets all when full, so its memory is bounded."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        packed = np.array(self.vocabulary.encoded(piece.encode()), "<u4").tobytes()
        if len(piece) <= 40:
            if len(self) >= PIECES_KEPT:
                self.clear()
            self[piece] = packed
        return packed


_loaded: dict[bytes, Vocabulary] = {}


@contextmanager
def _pieces(ranks: bytes) -> Iterator[Pieces]:
    """A task's memo. The vocabulary stays with the process for its next task, the memos go: idle processes keep little."""
    if ranks not in _loaded:
        _loaded.clear()
        _loaded[ranks] = Vocabulary(ranks)
    pieces = Pieces(_loaded[ranks])
    try:
        yield pieces
    finally:
        pieces.clear()
        pieces.vocabulary.pairs.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def _rank_file(spark: SparkSession, path: str):
    """The rank file, some hundred kB whatever the corpus, read once and sent to all tasks."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """`id_col`, n_tokens long, token_ids binary (little-endian unsigned 32-bit) of every row.

    With `decoded`, the ids are also decoded in the same pass, to a column of that name as :func:`decode` gives it:
    one Python process for each task in place of two.
    """
    ranks = _rank_file(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern).findall
        with _pieces(ranks.value) as pieces:
            packed = pieces.__getitem__
            for whole in batches:
                for batch in slices(whole, "_text"):
                    ids = [b"".join(map(packed, split(text))) for text in batch.column("_text").to_pylist()]
                    columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                    if decoded:
                        columns.append(pa.array([_text_of(x, pieces.vocabulary.token) for x in ids], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, [id_col, "n_tokens", "token_ids", "decoded"][: len(columns)])

    given = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    kind = given.schema[id_col].dataType.simpleString()
    return given.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, token_ids binary" + ", decoded binary" * decoded)


def _text_of(ids: bytes | None, token: dict[int, bytes]) -> bytes:
    return b"".join(map(token.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def decode(tokens: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """`id_col`, n_tokens, `ids_col` and decoded (binary): the bytes that the ids stand for."""
    ranks = _rank_file(tokens.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = by_rank(ranks.value)
        for whole in batches:
            for batch in slices(whole, ids_col):
                texts = [_text_of(ids, token) for ids in batch.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"])

    given = tokens.select(id_col, "n_tokens", ids_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema)
    return given.mapInArrow(run, f"{fields}, decoded binary")
