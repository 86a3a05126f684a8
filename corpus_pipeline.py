"""From `documents` to token ids: quality, near-duplicates, repeated bytes, benchmarks, byte-level BPE.

Every stage takes all its predecessor kept and returns the columns of `documents`, but for
the last one, which returns the ids. `run` writes each stage's result into the shared folder
as Parquet, so a stage can be repeated alone and no plan spans two stages.

Where SQL cannot express a stage (scores, fingerprints, MinHash bands, sampled suffixes, token ids) there is
none for the whole: ORACLE_SQL is None, and the tests compare stages with brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreleaf.llm import bpe, decontamination, minhash, quality, simhash, suffixes
from oreleaf.llm.common import staged, text_or_empty
from oreleaf.llm.queries import RANKS, table

ORACLE_SQL = None
PASSAGE = 250  # bytes; of the passages of 51 words in sf0.1, 98.6 to 99.3 % by language are as long


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the cutoff; rejected ones go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where(F.col("score") >= quality.CUTOFF).select(docs.columns)


def keep_representatives(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: linked by operator 5's fingerprints, or by five-word shingles with a Jaccard similarity of 0.8 or more.

    Texts of equal words have equal fingerprints, so the components of operator 5 are links of classes of such texts; both kinds of links make components together.
    """
    classed = minhash.classes_of(docs.select(text_or_empty("text").alias("text")), "text", "text")
    alike = simhash.near_duplicates(classed, "class").select(F.col("class").alias("u"), F.col("component_id").alias("v")).distinct()
    return minhash.representatives(docs, known=alike)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of PASSAGE bytes that recur elsewhere; a document stays, even if nothing of its text does."""
    rest = suffixes.without_repeats(docs, threshold=PASSAGE)
    return rest.withColumns({
        "text": F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.col("kept_text")),
        "n_chars": F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(F.length("kept_text").cast(docs.schema["n_chars"].dataType)),
    }).select(docs.columns)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of what they decode to."""
    return bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id", "n_tokens", "token_ids", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_representatives),
    ("repeats", remove_repeats),
    ("decontamination", keep_uncontaminated),
    ("byte_bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
