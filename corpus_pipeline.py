"""A corpus pipeline over ``documents``: quality rules, line dedup, n-gram Jaccard join, mixing
and byte-level BPE, each stage on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.llm import byte_bpe, jaccard_join, line_dedup, mixing, quality_rules
from mailspark.llm.common import documents, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted rules reject go."""
    return quality_rules.passed(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go; so do documents of which nothing is left.  ``n_chars`` follows
    the text."""
    cut = line_dedup.deduplicated(docs)
    some = (F.col("__gone") == 0) | jaccard_join.has_word(F.col("text"))
    n_chars = F.when(F.col("__gone") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.where(some).withColumn("n_chars", n_chars).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id."""
    return jaccard_join.distinct(docs)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.mixed(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with a digest of the ids and of what they decode to."""
    import public_tokenizers as public

    path, pattern = public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN
    encoded = byte_bpe.encoded(docs, path, pattern, columns=["doc_id", "source"], digest=True)
    return encoded.select(
        "doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.col("raw_sha256").alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", good_quality),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources to target weights", to_target_weights),
    ("byte-level BPE encoding and decoding", to_tokens),
]

#: The estimate of the rules' accuracies and BPE have no SQL form; tests/llm holds the operators
#: of the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read back before the next."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = written(docs) if i + 1 < len(STAGES) else docs
    return docs
