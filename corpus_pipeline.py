"""From raw documents to packed sequences: five stages, each an operator of
``fleetlens.llm`` applied to all that its predecessor kept.

In every stage: null texts are empty; null languages and sources are values of
their own; rows with a null id are kept or dropped by their text alone, and
never count as copies; repeated rows are one near-duplicate group; very long
texts are taken whole; an empty table gives no rows; columns beside those of
``documents``, whatever they are called, come along unchanged up to the last
stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import mixing, packing, quality, shingle_join, substrings
from fleetlens.llm.queries import DOMAIN_WEIGHTS, prepare
from fleetlens.llm.shared import stored
from fleetlens.sources.driver import read_driver_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie far from their language and
    source go."""
    prepare(spark)
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest
    id."""
    prepare(spark)
    return shingle_join.one_of_each(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 50 words that smaller ids have too are cut out of the texts;
    texts of which nothing is left go, and ``n_chars`` is counted anew."""
    prepare(spark)
    cut = substrings.without_repeats(docs)
    cut = cut.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go, and so many of low quality, drawn by a hash, that
    the rest meets the target weights. No document is repeated."""
    prepare(spark)
    return mixing.resample(docs, read_driver_table(spark, sf_dir, "labels"), DOMAIN_WEIGHTS, most_rate=1.0)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, concatenated and cut into sequences of 1024."""
    import public_tokenizers

    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]

#: The estimates, the classifier and the token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read_driver_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
