"""Helpers the operators share: shared scratch tables, word expressions, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters that separate words in the two word rules.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share: `spark.checkpoint.dir`; where it is unset, one of this process if that is all there is (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="oreleaf-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write `df` into the shared folder, packed tightly as it stays there, and read it back: cuts the lineage, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, **({"compression": "zstd"} | options))
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def alnum_words(text: Column) -> Column:
    """Lower-cased (A-Z) words of letters, digits and characters beyond ASCII: one translation and a split at single spaces."""
    parting = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
    return F.array_remove(F.split(F.translate(text, parting + UPPER, " " * len(parting) + UPPER.lower()), " ", -1), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `most` bytes of `column` each, one row at least: bounds the memory of a task."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    first = size = 0
    for row, length in enumerate(lengths):
        if row > first and size + length > most:
            yield batch.slice(first, row - first)
            first, size = row, 0
        size += length
    if first < batch.num_rows:
        yield batch.slice(first)


def space_parts(texts: list[str]) -> list[list[str]]:
    """Each text's pieces between spaces and line ends."""
    return [text.replace("\n", " ").split(" ") for text in texts]


class PieceMemo:
    """Bytes for pieces of text, made for all new pieces of a call at once.

    Two generations of at most about `kept` pieces each: when the young one is full it becomes the old one, and what is asked for again moves up,
    so frequent pieces stay and memory is bounded. Pieces of more than `longest` characters are not kept.
    """

    def __init__(self, made: Callable[[list[str]], list[bytes]], kept: int = 150_000, longest: int = 64):
        self.made, self.kept, self.longest = made, kept, longest
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def known(self, piece: str) -> bytes | None:
        data = self.young.get(piece)
        return self.old.get(piece) if data is None else data

    def joined(self, parts: list[list[str]]) -> list[bytes]:
        """The bytes of each list's pieces one after the other."""
        pieces = list(set().union(*parts))
        of = dict(zip(pieces, self.of(pieces))).__getitem__
        return [b"".join(map(of, part)) for part in parts]

    def of(self, pieces: list[str]) -> list[bytes]:
        """The bytes of different pieces."""
        young, old = self.young, self.old
        new = [piece for piece in pieces if piece not in young]
        unknown = [piece for piece in new if piece not in old]
        young.update((piece, old[piece]) for piece in new if piece in old)
        young.update(zip(unknown, self.made(unknown)))
        out = list(map(young.__getitem__, pieces))
        for piece in unknown:
            if len(piece) > self.longest:
                del young[piece]
        if len(young) > self.kept:
            self.old, self.young = young, {}
        return out
