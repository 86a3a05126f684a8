"""Audit of how filters interact, by count-weighted decision diagrams of failure masks.

One pass over the texts gives every document the mask of the filters that it fails. Documents are counted by text, part
and labels, then by part, mask and labels: at most 2^filters masks times four label pairs in a part, whatever the corpus.
From these counts each part gets a diagram: a level for each filter, a pass and a fail branch at every node, equal nodes kept once,
and under each node the number of its documents. All orders of the filters are visited by adjacent
swaps (each order differs from the one before in two neighbours), and a swap rebuilds the nodes of two levels alone.
The path on which every filter passes then holds an order's steps: what its fail branch counts is removed there.

The filter on copies compares a document with the whole table: it fails where a smaller id has the same text. Texts
are compared by their SHA-256. Filters on the text are the same for all copies, so a text needs one row for each part
and label pair, with its smallest id there and the rows that have it: counts combine before they are shuffled and a
text that makes up a third of all rows is spread by its ids first. Labels are joined by id and a salt, so that one id
that many rows share is dealt out too. There is a label for each id and salt, and that join always merges sorted rows: they
grow with the corpus, and the driver would have to hold them all to broadcast them.

Defined results: a null text is the empty one; a null part is the empty string; a null id has no labels and no smaller
id, and is smaller than none, so it neither fails the filter on copies nor makes others fail it; rows that
share the smallest id of a text all pass that filter; an id with several labels has those that any of its rows has;
repeated rows count each; an empty table has no part and gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreleaf.llm.common import slices, text_or_empty

FILTERS = "ABCDE"  # few words, few distinct words, many capitals, symbols, copies
MIN_WORDS = 100
MIN_DISTINCT = 80  # percent of the words
MAX_CAPITALS = 10  # percent of the characters
SYMBOLS = b"#$%&*|"
SALTS = 8

_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def text_mask(text: bytes) -> int:
    """Bits 0 to 3: the filters on the text that it fails, in the order of FILTERS."""
    words = text.split()  # bytes part at the six characters of ASCII white space alone
    codes = np.frombuffer(text, np.uint8)
    points = len(codes) - int(np.count_nonzero((codes & 0xC0) == 0x80))
    capitals = int(np.count_nonzero(_CAPITAL[codes]))
    fails = (
        len(words) < MIN_WORDS, 100 * len(set(words)) < MIN_DISTINCT * len(words),
        100 * capitals > MAX_CAPITALS * points, bool(_SYMBOL[codes].any()),
    )
    return sum(1 << bit for bit, failed in enumerate(fails) if failed)


def text_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(_id, _part, _text_key, _mask) of every row: the text's SHA-256 and the filters on the text that it fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                texts = [text.as_buffer().to_pybytes() if text.is_valid else b"" for text in batch.column("_text")]
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id"), batch.column("_part"), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                    pa.array(map(text_mask, texts), pa.int32()),
                ], ["_id", "_part", "_text_key", "_mask"])

    given = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("_part"), text_or_empty(text_col).alias("_text"),
    )
    kind = given.schema["_id"].dataType.simpleString()
    return given.mapInArrow(run, f"_id {kind}, _part string, _text_key binary, _mask int")


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, n): documents by part, whole failure mask and labels."""
    rows = text_masks(docs, id_col, text_col, part_col).groupBy("_id", "_part", "_text_key", "_mask").agg(F.count("*").alias("_n"))
    # An id meets its labels under a salt that the text decides; rows without an id meet none and stay spread by their text.
    by_text = F.xxhash64("_text_key")
    rows = rows.withColumn("_salt", F.when(F.col("_id").isNull(), by_text).otherwise(F.pmod(by_text, F.lit(SALTS))))
    marked = (
        labels.select(F.col(id_col).alias("_lid"), F.col("quality").alias("_q"), F.col("toxic").alias("_t")).where("_lid is not null")
        .groupBy("_lid").agg(
            F.coalesce(F.max(F.col("_q") == 1), F.lit(False)).alias("_good"), F.coalesce(F.max(F.col("_t") == 1), F.lit(False)).alias("_toxic"),
        )
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_lsalt"))
        .hint("merge")  # Spark's estimate of their size leaves out the salts, and would have them broadcast
    )
    rows = rows.join(marked, (F.col("_id") == F.col("_lid")) & (F.col("_salt") == F.col("_lsalt")), "left").select(
        "_id", "_part", "_text_key", "_mask", "_n", F.coalesce("_good", F.lit(False)).alias("_good"), F.coalesce("_toxic", F.lit(False)).alias("_toxic"),
    )
    # Equal (text, part, labels): all rows, and those with the smallest id among them.
    least = F.min(F.when(F.col("_id").isNotNull(), F.struct("_id", "_n")))
    groups = rows.groupBy("_text_key", "_part", "_good", "_toxic", "_mask").agg(
        F.sum("_n").alias("_n"), least.alias("_least"), F.sum(F.when(F.col("_id").isNull(), F.col("_n")).otherwise(0)).alias("_nameless"),
    )
    # A text's groups, as many as parts times label pairs: one list for each text.
    texts = groups.groupBy("_text_key").agg(
        F.min("_least._id").alias("_first"), F.collect_list(F.struct("_part", "_good", "_toxic", "_mask", "_n", "_least", "_nameless")).alias("_groups"),
    )
    each = texts.select("_first", F.explode("_groups").alias("g")).select(
        "g.*", (F.col("g._nameless") + F.when(F.col("g._least._id") == F.col("_first"), F.col("g._least._n")).otherwise(0)).alias("_own"),
    )
    copies = 1 << (len(FILTERS) - 1)
    counted = each.select("_part", "_good", "_toxic", F.explode(F.array(
        F.struct(F.col("_mask").alias("mask"), F.col("_own").alias("n")),
        F.struct((F.col("_mask") + copies).alias("mask"), (F.col("_n") - F.col("_own")).alias("n")),
    )).alias("m"))
    return counted.groupBy(F.col("_part").alias("part"), F.col("m.mask").alias("mask"), F.col("_good").alias("good"), F.col("_toxic").alias("toxic")).agg(
        F.sum("m.n").alias("n"),
    ).where("n > 0")


def neighbour_orders(n: int) -> Iterator[int]:
    """The places of the swaps that lead from 0..n-1 through all other orders, each by one swap of neighbours."""
    order, heads = list(range(n)), [-1] * n
    while True:
        # The largest element that heads for a smaller neighbour moves; all larger ones turn round.
        able = [e for e in range(n) if 0 <= (to := order.index(e) + heads[e]) < n and order[to] < e]
        if not able:
            return
        moved = max(able)
        at = order.index(moved)
        to = at + heads[moved]
        order[at], order[to] = order[to], order[at]
        for e in range(moved + 1, n):
            heads[e] = -heads[e]
        yield min(at, to)


class Diagram:
    """A count-weighted decision diagram: a node is (pass child, fail child), a leaf its vector of counts.

    Every path has all levels, so two levels are swapped alike under each node, and equal nodes are one node.
    """

    def __init__(self, levels: str, counts: dict[int, tuple[int, ...]], width: int):
        self.order = levels
        self.nodes: dict[tuple, int] = {}
        self.child: list[tuple] = []
        self.total: list[tuple[int, ...]] = []
        none = (0,) * width
        layer = [self._node(("leaf", *counts.get(mask, none)), counts.get(mask, none)) for mask in range(1 << len(levels))]
        for bit in reversed(range(len(levels))):  # the last filter is the lowest level
            half = 1 << bit
            layer = [self._pair(layer[mask], layer[mask + half]) for mask in range(half)]
        self.root = layer[0]

    def _node(self, key: tuple, total: tuple[int, ...]) -> int:
        if key not in self.nodes:
            self.nodes[key] = len(self.child)
            self.child.append(key)
            self.total.append(total)
        return self.nodes[key]

    def _pair(self, passed: int, failed: int) -> int:
        return self._node((passed, failed), tuple(a + b for a, b in zip(self.total[passed], self.total[failed])))

    def swap(self, level: int) -> None:
        """Exchange `level` and the one below it."""
        done: dict[int, int] = {}

        def rebuilt(node: int, depth: int) -> int:
            if node not in done:
                passed, failed = self.child[node]
                if depth < level:
                    done[node] = self._pair(rebuilt(passed, depth + 1), rebuilt(failed, depth + 1))
                else:
                    (pp, pf), (fp, ff) = self.child[passed], self.child[failed]
                    done[node] = self._pair(self._pair(pp, fp), self._pair(pf, ff))
            return done[node]

        self.root = rebuilt(self.root, 0)
        a, b = self.order[level : level + 2]
        self.order = self.order[:level] + b + a + self.order[level + 2 :]

    def steps(self) -> Iterator[tuple[str, tuple[int, ...], tuple[int, ...]]]:
        """(filter, kept, removed) down the path on which every filter passes."""
        node = self.root
        for name in self.order:
            passed, failed = self.child[node]
            yield name, self.total[passed], self.total[failed]
            node = passed


def part_report(counts: dict[int, tuple[int, ...]], filters: str = FILTERS) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders.

    `counts`: failure mask to (documents, good ones, toxic ones).
    """
    failing = {f: sum(n[0] for mask, n in counts.items() if mask >> i & 1) for i, f in enumerate(filters)}
    alone = {f: counts.get(1 << i, (0,))[0] for i, f in enumerate(filters)}
    diagram = Diagram(filters, counts, 3)
    shapley = dict.fromkeys(filters, 0)
    rows = []

    def walk() -> None:
        for step, (name, kept, removed) in enumerate(diagram.steps(), 1):
            rows.append((diagram.order, step, name, kept[0], removed[0], failing[name] - removed[0], alone[name], removed[1], removed[2]))
            shapley[name] += removed[0]

    walk()
    for place in neighbour_orders(len(filters)):
        diagram.swap(place)
        walk()
    return [(order, step, *rest, shapley[name]) for order, step, name, *rest in rows]  # the step's filter is the order's letter


REPORT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row for each part, order of the filters and step; the columns of REPORT."""
    names = [field.split()[0] for field in REPORT.split(", ")]

    def report(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        counts: dict[int, tuple[int, ...]] = {}
        for mask, good, toxic, n in zip(frame["mask"].tolist(), frame["good"].tolist(), frame["toxic"].tolist(), frame["n"].tolist()):
            before = counts.get(mask, (0, 0, 0))
            counts[mask] = (before[0] + n, before[1] + n * good, before[2] + n * toxic)
        return pd.DataFrame([(key[0], *row) for row in part_report(counts)], columns=names)

    return mask_counts(docs, labels, id_col, text_col, part_col).groupBy("part").applyInPandas(report, REPORT)
