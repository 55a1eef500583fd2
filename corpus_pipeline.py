"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, benchmark
decontamination, BPE encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each stage's
result as Parquet below the shared folder and gives the table, read again, to the next stage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally.llm import bpe, decontam, line_dedup, quality, simhash
from chesstally.llm.common import fresh, materialize, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below 0.5) go. Learns from labelled documents outside
    the held-out fold. Null and empty texts score the share of good labels; whole texts of any length
    are scored; equal rows go or stay together; other columns, null or not, pass through; an empty
    table, or one without two labelled documents of either label, keeps all or none by that share."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated occurrences of cross-site boilerplate lines go; every document stays, with its
    ``n_chars`` counted anew where its text changed. Null texts stay null; a null source is a site of its
    own; rows without an id come last in the order of occurrences; rows that repeat an id and text
    are treated alike; an empty table stays empty."""
    before, removed = fresh(docs, "lines_before"), fresh(docs, "lines_removed")
    out = line_dedup.dedup_lines(docs, counts=(before, removed))
    n = F.when(F.col(removed) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.withColumn("n_chars", F.coalesce(n, "n_chars")).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest doc_id. Null, empty and blank
    texts are one group; equal rows are one document, other texts under its id are documents of their
    own; rows without an id all stay; an empty table stays empty."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget go. Null, empty and wordless texts hold none
    and stay, null items match nothing; whole texts of any length are searched; repeated rows go or
    stay together; an empty table on either side changes nothing."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document that is left, a row per row. A null
    text is the empty one; texts of any length are encoded whole; an empty table gives no rows."""
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding and decoding", bpe_encoding),
]

#: SQL can express neither the classifier nor fingerprints and token ids; tests/llm holds the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs
