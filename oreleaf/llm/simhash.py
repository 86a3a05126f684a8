"""SimHash near-duplicates: fingerprints, and exact Hamming neighbours through vantage-point trees.

Fingerprints of equal value are one row from the start. A routing tree, fitted on a bounded
sample of them (`SAMPLE` values at most, 512 kB), deals all fingerprints out to leaves: a node
has a vantage point and a radius, and a fingerprint goes inside or outside by its
distance. By the triangle inequality a pair within `bits` can only be parted by a node
if the inner one lies within `bits` of the radius; such a fingerprint is also sent across as
a guest, so every pair meets in the leaf where its outer member lives. In its leaf the
same division goes on in memory down to small blocks, which are compared in full. A leaf returns a
forest, at most one edge for each fingerprint in it, and components are joined over all leaves.

Defined results: a null text is the empty one, and all texts without words share fingerprint 0;
null ids count as larger than any id (a component of nothing but null ids has none);
repeated rows stay; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreleaf.llm.common import slices, staged, text_or_empty
from oreleaf.llm.components import stars

SHINGLE = 3
SEED = 42
BITS = 2
SAMPLE = 65_536
LEAF = 2048  # fingerprints that live in a leaf, about
BLOCK = 512


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the bits of the hashes of all shingles, repeats included; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())), "<u8", len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col` and fp (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                found = [fingerprint(text) for text in batch.column("_text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], [id_col, "fp"])

    given = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    return given.mapInArrow(run, f"`{id_col}` {given.schema[id_col].dataType.simpleString()}, fp long")


def _distances(points: np.ndarray, to: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ to)


def routing_tree(sample: np.ndarray, depth: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage point, radius, inside, outside); a child under 0 is leaf -child-1, node 0 the root."""
    nodes: list[tuple[int, int, int, int]] = []
    leaves = 0

    def grow(points: np.ndarray, left: int) -> int:
        nonlocal leaves
        split = _split(points) if left and len(points) >= 8 else None
        if split is None:
            leaves += 1
            return -leaves
        at = len(nodes)
        nodes.append((0, 0, 0, 0))
        vantage, radius, inner = split
        nodes[at] = (int(vantage), radius, grow(points[inner], left - 1), grow(points[~inner], left - 1))
        return at

    grow(sample, depth)
    return nodes


def _split(points: np.ndarray) -> tuple[np.uint64, int, np.ndarray] | None:
    """The first point as vantage point, and of the radii near the median the one that parts fewest neighbours."""
    away = _distances(points, points[0])
    counts = np.bincount(away, minlength=68).astype(np.int64)
    inside = np.cumsum(counts)
    radii = np.flatnonzero((4 * inside >= len(points)) & (4 * inside <= 3 * len(points)))
    if not len(radii):
        radii = np.flatnonzero((inside > 0) & (inside < len(points)))
        if not len(radii):
            return None
    crossing = np.array([counts[max(0, r - BITS + 1) : r + BITS + 1].sum() for r in radii])
    radius = int(radii[np.argmin(crossing * (1 + np.abs(2 * inside[radii] - len(points)) / len(points)))])
    inner = away <= radius
    return points[0], radius, inner


def _deal(points: np.ndarray, vantage: np.uint64, radius: int, guest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Masks of who goes inside, who goes outside, and who of those outside is a guest there."""
    away = _distances(points, vantage).astype(np.int64)
    inner = np.where(guest, away <= radius + BITS, away <= radius)
    outer = np.where(guest, away > radius - BITS, (away > radius) | (away > radius - BITS))
    return inner, outer, guest | (away <= radius)


def routed(points: np.ndarray, nodes: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, fingerprints, guest) for each leaf that the points reach."""
    waiting = [(0 if nodes else -1, points, np.zeros(len(points), bool))]
    while waiting:
        at, some, guest = waiting.pop()
        if not len(some):
            continue
        if at < 0:
            yield -at - 1, some, guest
            continue
        vantage, radius, inside, outside = nodes[at]
        inner, outer, guest_out = _deal(some, np.uint64(vantage), radius, guest)
        waiting += [(inside, some[inner], guest[inner]), (outside, some[outer], guest_out[outer])]


def labelled(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each of n nodes' components under edges i-j."""
    label = np.arange(n)
    while len(i):
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label[i] == label[j]).all():
            break
    while not (label == label[label]).all():
        label = label[label]
    return label


def forest(points: np.ndarray, guest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join all fingerprints of a leaf which pairs within BITS connect; guests meet only those who live here."""
    ends_i, ends_j = [], []
    waiting = [(np.arange(len(points)), guest)]
    while waiting:
        rows, visiting = waiting.pop()
        living = rows[~visiting]
        if not len(living) or len(rows) < 2:
            continue
        split = _split(points[living]) if len(living) > BLOCK else None
        if split is not None:
            inner, outer, guest_out = _deal(points[rows], split[0], split[1], visiting)
            waiting += [(rows[inner], visiting[inner]), (rows[outer], guest_out[outer])]
            continue
        for a in range(0, len(living), BLOCK):
            here = living[a : a + BLOCK]
            for b in range(0, len(rows), 4 * BLOCK):
                there = rows[b : b + 4 * BLOCK]
                i, j = np.nonzero(np.bitwise_count(points[here][:, None] ^ points[there][None, :]) <= BITS)
                apart = here[i] != there[j]
                i, j = here[i[apart]], there[j[apart]]
                if len(i) > len(here) + len(there):  # many pairs in one block: keep a forest of them
                    known, at = np.unique(np.concatenate((i, j)), return_inverse=True)
                    label = labelled(len(known), at[: len(i)], at[len(i) :])
                    i, j = known, known[label]
                    i, j = i[i != j], j[i != j]
                ends_i.append(i)
                ends_j.append(j)
    if not ends_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    label = labelled(len(points), np.concatenate(ends_i), np.concatenate(ends_j))
    node = np.flatnonzero(label != np.arange(len(points)))
    return node, label[node]


def sampled(distinct: DataFrame, n: int, most: int = SAMPLE) -> np.ndarray:
    """All of the n values of column fp, or if they are more than `most` some nine tenths of `most`, in the order of a hash.

    The limit on the hash follows from n, so the tasks together send the driver no more than it keeps. The number taken is
    binomial; with `most` of 65,536 the tenth left over is 27 standard deviations.
    """
    by = F.xxhash64("fp", F.lit(7))
    limit = int(-(2**63) + 2**64 * min(1.0, 0.9 * most / n)) if n > most else 2**63
    chosen = distinct.select("fp", by.alias("by"))
    found = (chosen.where(F.col("by") < limit) if limit < 2**63 else chosen).collect()
    return np.array([row.fp for row in sorted(found, key=lambda row: (row.by, row.fp))], np.int64)


def links(distinct: DataFrame, n: int) -> DataFrame:
    """Edges (u, v) between the n values of column fp that connect all within BITS of one another."""
    sample = sampled(distinct, n)
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / LEAF))))
    nodes = routing_tree(sample.view(np.uint64), depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaf, some, guest in routed(batch.column(0).to_numpy().view(np.uint64), nodes):
                arrays = [pa.array(np.full(len(some), leaf, np.int32)), pa.array(some.view(np.int64)), pa.array(guest)]
                yield pa.RecordBatch.from_arrays(arrays, ["leaf", "fp", "guest"])

    def join(group: pa.Table) -> pa.Table:
        points = group.column("fp").to_numpy().view(np.uint64)
        guest = group.column("guest").to_numpy().astype(bool)
        order = np.lexsort((points, guest))
        points, guest = points[order], guest[order]
        i, j = forest(points, guest)
        return pa.table({"u": points[i].view(np.int64), "v": points[j].view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "leaf int, fp long, guest boolean")
    return dealt.groupBy("leaf").applyInArrow(join, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, fp, component_id (the smallest id reachable over links of at most BITS bits) of every row."""
    found = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = staged(found.groupBy("fp").agg(F.min(id_col).alias("_least")), "fingerprint-classes")
    roots = stars(links(classes, classes.count()))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "_least", F.coalesce("root", "fp").alias("_root"))
    least = rooted.groupBy(F.col("_root").alias("_of")).agg(F.min("_least").alias("component_id"))
    component = rooted.join(least, F.col("_root") == F.col("_of")).select(F.col("fp").alias("_fp"), "component_id")
    return found.join(component, F.col("fp") == F.col("_fp")).select(id_col, "fp", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of `docs` for each component, unchanged: the one with the smallest id (null ids last)."""
    text = text_or_empty(text_col)
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))
    keyed = docs.withColumn("_key", key)
    grouped = near_duplicates(keyed.select("_key", text_col), "_key", text_col)
    first = grouped.where("_key = component_id").select(F.col("_key").alias("_first")).distinct()
    return keyed.join(first, F.col("_key") == F.col("_first")).dropDuplicates(["_first"]).select(*(F.col(f"`{c}`") for c in docs.columns))
