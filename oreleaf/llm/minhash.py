"""Near-duplicates by the overlap of their five-word shingles: MinHash bands for candidates, exact Jaccard for links.

Texts of equal words are one class from the start. A class has BANDS x ROWS smallest values of its
shingles' hashes; classes that agree in all ROWS values of a band meet in a bucket. Two sets with a Jaccard
similarity of 0.8 meet in at least one of 24 bands of 5 with probability 0.9999, of 0.9 with 1 - 4e-10. In
buckets of at most SMALL classes all pairs are candidates. In a larger bucket every class is first paired with REPS classes: the one
that most others meet over all bands (in a group of changed copies that is what they come from) and three dealt
by hash, so candidates grow in proportion to the classes. The words of each candidate pair are then compared, and only a true
similarity of SIMILAR or more is a link. Components are joined over all links.

What the first comparison leaves apart in larger buckets is then compared exactly (`remaining`). Classes of
buckets that hold more than one component order their shingles by frequency; of two similar sets the n/5 + 1 rarest
shingles of each meet. Classes that meet another component so are compared in blocks of bounded size, outside the
largest component of their cluster against all; a task emits one link for two components, never all pairs.

Defined results: as in `simhash`; a text of fewer than five words has one shingle, and all texts without
words are one class.
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

SHINGLE = 5
SIMILAR = 0.8
SEED = 42
BANDS, ROWS = 24, 5
SMALL = 16
REPS = 4
BLOCK_ROWS, BLOCK_HASHES = 512, 250_000  # classes and shingles of a block, one class at least

_R = np.random.default_rng(SEED)
_TIMES, _PLUS = (_R.integers(0, 2**63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of all shingles, sorted; none without words."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())), np.uint64, len(words) - size + 1))


def band_names(hashes: np.ndarray) -> np.ndarray:
    """One name for each band of the smallest values; all zero without shingles."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), 2048):
        part = hashes[None, at : at + 2048] * _TIMES + _PLUS
        least = np.minimum(least, (part >> np.uint64(32)).min(axis=1).astype(np.uint32))
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(least.reshape(BANDS, ROWS))], np.uint64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def words_class(text: bytes) -> int:
    return xxhash.xxh64_intdigest(b" ".join(text.lower().split()), SEED)


def _longs(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def classes_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`id_col` and the class of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                found = [words_class(text) for text in batch.column("_text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), _longs(found)], [id_col, "class"])

    given = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    return given.mapInArrow(run, f"`{id_col}` {given.schema[id_col].dataType.simpleString()}, class long")


def banded(docs: DataFrame, text_col: str) -> DataFrame:
    """(class, n, band) for every row and band: n is the number of distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                classes, sizes, names = [], [], []
                for text in batch.column(0).cast(pa.binary()).to_pylist():
                    found = shingles(text)
                    if len(found):
                        classes.append(words_class(text))
                        sizes.append(len(found))
                        names.append(band_names(found))
                if classes:
                    yield pa.RecordBatch.from_arrays(
                        [_longs(np.repeat(np.array(classes, np.uint64), BANDS)), pa.array(np.repeat(np.array(sizes, np.int32), BANDS)), _longs(np.concatenate(names))], ["class", "n", "band"],
                    )

    return docs.select(text_or_empty(text_col).alias("_text")).mapInArrow(run, "class long, n int, band long")


def meetings(bands: DataFrame) -> DataFrame:
    """The rows (band, class, n, _size) of buckets of two classes or more; `bands`: class, n, band, each row once."""
    buckets = bands.groupBy(F.col("band").alias("_band")).agg(F.count("*").alias("_size")).where("_size > 1")
    return bands.join(buckets, F.col("band") == F.col("_band")).select("band", "class", "n", "_size")


def candidates(met: DataFrame) -> DataFrame:
    """Pairs (u, v) of classes that share a band and whose sizes allow the similarity, all of them in small buckets."""
    small = met.where(F.col("_size") <= SMALL).groupBy("band").agg(F.sort_array(F.collect_list(F.struct("class", "n"))).alias("_m"))
    pairs = small.select(F.explode(F.flatten(F.expr(
        "transform(_m, (x, i) -> transform(slice(_m, i + 2, size(_m)), y -> struct(x.class as u, x.n as nu, y.class as v, y.n as nv)))",
    ))).alias("p")).select("p.*")
    large = met.where(F.col("_size") > SMALL)
    central = large.groupBy(F.col("class").alias("_of")).agg(F.sum("_size").alias("_central"))
    ranked = large.join(central, F.col("class") == F.col("_of")).select("band", "class", "n", "_central")
    one = F.struct("class", "n")
    picks = [F.max_by(one, F.struct("_central", "class"))] + [F.min_by(one, F.xxhash64("class", F.lit(k))) for k in range(1, REPS)]
    reps = ranked.groupBy(F.col("band").alias("_band")).agg(*(p.alias(f"_r{k}") for k, p in enumerate(picks)))
    starred = large.join(reps, F.col("band") == F.col("_band")).select(
        F.col("class").alias("u"), F.col("n").alias("nu"), F.explode(F.array_distinct(F.array(*(f"_r{k}" for k in range(REPS))))).alias("_r"),
    ).select("u", "nu", F.col("_r.class").alias("v"), F.col("_r.n").alias("nv"))
    fit = F.least("nu", "nv") >= SIMILAR * F.greatest("nu", "nv")
    return pairs.union(starred).where((F.col("u") != F.col("v")) & fit).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts have a similarity of SIMILAR or more; `texts`: class, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                known: dict[int, np.ndarray] = {}
                kept = []
                v = batch.column("v").to_pylist()
                for row, (a, b) in enumerate(zip(batch.column("_text").cast(pa.binary()).to_pylist(), batch.column("_other").cast(pa.binary()).to_pylist())):
                    if v[row] not in known:
                        known = {v[row]: shingles(b)}
                    if jaccard(shingles(a), known[v[row]]) >= SIMILAR:
                        kept.append(row)
                some = batch.take(pa.array(kept, pa.int32()))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1)], ["u", "v"])

    left = texts.select(F.col("class").alias("_u"), F.col("text").alias("_text"))
    right = texts.select(F.col("class").alias("_v"), F.col("text").alias("_other"))
    both = pairs.join(left, F.col("u") == F.col("_u")).select("u", "v", "_text").join(right, F.col("v") == F.col("_v")).select("u", "v", "_text", "_other")
    return both.mapInArrow(run, "u long, v long")


def _sets(texts: DataFrame) -> DataFrame:
    """class, and the hashes of its shingles as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [shingles(text).tobytes() for text in batch.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(found, pa.binary())], ["class", "hashes"])

    return texts.select("class", "text").mapInArrow(run, "class long, hashes binary")


def _spread(sets: DataFrame) -> DataFrame:
    """(class, shingle) for every shingle of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, hashes in zip(batch.column("class").to_pylist(), batch.column("hashes").to_pylist()):
                for at in range(0, len(hashes), 1 << 20):
                    part = np.frombuffer(hashes[at : at + (1 << 20)], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), name, np.int64)), pa.array(part)], ["class", "shingle"])

    return sets.select("class", "hashes").mapInArrow(run, "class long, shingle long")


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The number of common values of every set of `a` and every one of `b`, by products of bounded 0-1 matrices."""
    both = np.zeros((len(a), len(b)), np.float64)
    values = [np.concatenate(sets) for sets in (a, b)]
    rows = [np.repeat(np.arange(len(sets)), [len(s) for s in sets]) for sets in (a, b)]
    common = np.intersect1d(*values)
    columns = [np.searchsorted(common, v) for v in values]
    kept = [common[np.minimum(c, len(common) - 1)] == v if len(common) else np.zeros(len(v), bool) for c, v in zip(columns, values)]
    order = [np.flatnonzero(k)[np.argsort(c[k], kind="stable")] for k, c in zip(kept, columns)]
    for at in range(0, len(common), 4096):
        sides = []
        for sets, r, c, o in zip((a, b), rows, columns, order):
            lo, hi = np.searchsorted(c[o], [at, at + 4096])
            matrix = np.zeros((len(sets), min(4096, len(common) - at)), np.float32)
            matrix[r[o[lo:hi]], c[o[lo:hi]] - at] = 1
            sides.append(matrix)
        both += sides[0] @ sides[1].T
    return both


def _blocks(members: DataFrame) -> DataFrame:
    """Links (u, v) between the components (`root`) of similar members of a cluster; `members`: cluster, class, n, root, hashes."""
    sized = members.withColumn("bin", F.floor(F.log("n") / F.log(F.lit(1.26))))  # similar sets lie in neighbouring bins
    tallest = sized.groupBy("cluster", "root").agg(F.count("*").alias("_rows")).groupBy(F.col("cluster").alias("_cluster")).agg(
        F.max_by("root", F.struct("_rows", "root")).alias("_main"))
    split = staged(sized.join(tallest, F.col("cluster") == F.col("_cluster")).withColumn("rest", F.col("root") != F.col("_main"))
                   .select("cluster", "bin", "rest", "class", "root", "hashes"), "cluster-members")
    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), F.floor(BLOCK_HASHES / F.pow(F.lit(1.26), F.col("bin") + 1))))
    cells = staged(split.groupBy("cluster", "bin", "rest").agg(F.count("*").alias("_rows")).select(
        "cluster", "bin", "rest", F.ceil(F.col("_rows") / most).alias("_blocks")), "cluster-cells")
    name = F.xxhash64("cluster", "bin", "rest", "_block")
    dealt = split.join(cells, ["cluster", "bin", "rest"]).withColumn("_block", F.pmod(F.xxhash64("class"), "_blocks")).select(
        name.alias("_name"), "class", "root", "hashes")
    every = cells.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    x = every.where("rest").select("cluster", F.explode(F.expr("sequence(bin - 1, bin + 1)")).alias("bin"), name.alias("x"))
    y = every.select("cluster", "bin", name.alias("y"), F.col("rest").alias("_rest"))
    asked = staged(x.join(y, ["cluster", "bin"]).where("NOT _rest OR x <= y").select("x", "y"), "block-pairs")
    sides = asked.select("x", "y", F.col("x").alias("_of"), F.lit(0).alias("side")).union(
        asked.where("x <> y").select("x", "y", F.col("y").alias("_of"), F.lit(1).alias("side")))
    sent = sides.join(dealt, F.col("_of") == F.col("_name")).select("x", "y", "side", "root", "hashes")

    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        roots = table["root"].to_numpy()
        sets = [np.frombuffer(h, np.int64) for h in table["hashes"].to_pylist()]
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if (table["x"][0] != table["y"][0]) else left
        if not len(left) or not len(right):
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        a, b = [sets[k] for k in left], [sets[k] for k in right]
        sizes = [np.array([len(s) for s in some]) for some in (a, b)]
        close = 9 * overlaps(a, b) >= 4 * (sizes[0][:, None] + sizes[1][None, :])  # both / (a + b - both) >= 4 / 5
        i, j = np.nonzero(close & (roots[left][:, None] != roots[right][None, :]))
        found = np.unique(np.sort(np.stack([roots[left][i], roots[right][j]], 1), axis=1), axis=0)
        return pa.table({"u": pa.array(found[:, 0]), "v": pa.array(found[:, 1])})

    return sent.groupBy("x", "y").applyInArrow(run, "u long, v long").distinct()


def remaining(met: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Links (u, v) between components that meet in large buckets, complete for the classes there; None if there is no such bucket."""
    large = met.where(F.col("_size") > SMALL).join(roots, F.col("class") == F.col("node"), "left").select(
        "band", "class", "n", F.coalesce("root", "class").alias("root"))
    large = staged(large, "large-buckets")
    parted = large.groupBy(F.col("band").alias("_band")).agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a <> _b")
    hard = staged(large.join(staged(parted, "parted-buckets"), F.col("band") == F.col("_band"), "left_semi").select("class", "n", "root").distinct(), "hard-classes")
    if hard.isEmpty():
        return None
    sets = staged(_sets(texts.join(hard.select(F.col("class").alias("_h")), F.col("class") == F.col("_h"), "left_semi")), "hard-sets")
    spread = _spread(sets)
    often = staged(spread.groupBy(F.col("shingle").alias("_s")).agg(F.count("*").alias("_often")).where("_often > 1"), "frequent-shingles")
    known = spread.join(often, F.col("shingle") == F.col("_s")).groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("_often", "shingle"))).alias("_known"))
    # the shingles of one class alone come first in the order and meet nobody, so only the rest of the n/5 + 1 is listed
    rooted = known.join(hard.withColumnRenamed("class", "_c"), F.col("class") == F.col("_c"))
    listed = rooted.select("class", "root", F.explode(F.expr("slice(_known, 1, greatest(0, n div 5 + 1 - (n - size(_known))))")).alias("_k"))
    posted = staged(listed.select("class", "root", F.col("_k.shingle").alias("shingle")), "rare-shingles")
    shared = staged(posted.groupBy(F.col("shingle").alias("_s")).agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a <> _b"), "parted-shingles")
    edges = posted.join(shared, F.col("shingle") == F.col("_s"), "left_semi").select(F.col("class").alias("u"), F.xxhash64(F.lit(1), "shingle").alias("v"))
    clusters = stars(edges).select("node", F.col("root").alias("_cluster"))
    active = hard.join(edges.select(F.col("u").alias("_c")).distinct(), F.col("class") == F.col("_c"), "left_semi")
    members = active.join(clusters, F.col("class") == F.col("node"), "left").select(F.coalesce("_cluster", "class").alias("cluster"), "class", "n", "root")
    return _blocks(members.join(sets.withColumnRenamed("class", "_c"), F.col("class") == F.col("_c")).drop("_c"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """`id_col`, component_id (the smallest id reachable over links) of every row; `known` are further links (u, v) of classes."""
    found = staged(classes_of(docs, id_col, text_col), "classes")
    bands = staged(banded(docs, text_col).distinct(), "bands")
    met = staged(meetings(bands), "met-bands")
    pairs = staged(candidates(met), "candidate-pairs")
    asked = pairs.select(F.explode(F.array("u", "v")).alias("_c")).union(met.where(F.col("_size") > SMALL).select("class")).distinct()
    text = docs.select(text_or_empty(text_col).alias("text"))
    texts = staged(classes_of(text, "text", "text").join(asked, F.col("class") == F.col("_c"), "left_semi").dropDuplicates(["class"]), "candidate-texts")
    linked = links(pairs, texts)
    roots = stars(linked if known is None else linked.union(known.select("u", "v")))
    rooted = found.join(roots, F.col("class") == F.col("node"), "left").select(id_col, F.coalesce("root", "class").alias("_root"))
    more = remaining(met, roots, texts)
    if more is not None:
        tops = stars(more)
        rooted = rooted.join(tops, F.col("_root") == F.col("node"), "left").select(id_col, F.coalesce("root", "_root").alias("_root"))
    least = rooted.groupBy(F.col("_root").alias("_of")).agg(F.min(id_col).alias("component_id"))
    return rooted.join(least, F.col("_root") == F.col("_of")).select(id_col, "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """One row of `docs` for each component, unchanged: the one with the smallest id (null ids last); `known` as in `near_duplicates`."""
    text = text_or_empty(text_col)
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))
    keyed = docs.withColumn("_key", key)
    grouped = near_duplicates(keyed.select("_key", text_col), "_key", text_col, known)
    first = grouped.where("_key = component_id").select(F.col("_key").alias("_first")).distinct()
    return keyed.join(first, F.col("_key") == F.col("_first")).dropDuplicates(["_first"]).select(*(F.col(f"`{c}`") for c in docs.columns))
