"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the
last return the columns of `docs`; columns beyond those of `documents` pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tunemart import scratch
from tunemart.llm import bpe, decontaminate, langid, simhash, substring_dedup
from tunemart.llm.common import table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; others, and such without a letter, go."""
    return langid.without_rejected(docs, langid.train(docs, F.lit(True)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash fingerprints within two bits link."""
    return simhash.deduplicate(docs, shingle=3, max_distance=2)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand in an earlier one or earlier in their own."""
    cut = substring_dedup.cut(docs, substring_dedup.repeated_passages(docs))
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, in its words or re-parameterised."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (packed), with digests of them and of what they decode to."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    # Written in between: else each task would hold two Python workers with a vocabulary each.
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))
    encoded = scratch.materialize(encoded, "encoded")
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        "lang",
        "source",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language identification", identify_language),
    ("SimHash near-duplicates", drop_near_duplicates),
    ("substring deduplication", cut_repeated_passages),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("byte-level BPE", encode_texts),
]

# No SQL expresses the stages: tests compare each with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.materialize(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
