"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally.llm import (
    bpe, decontam, line_dedup, lm, minhash, mixing, packing, pii, quality, repair, search, simhash,
    token_scan)
from chesstally.llm.common import fresh, table
from chesstally.llm.tokens import RANKS


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n, gone = fresh(docs, "n_lines"), fresh(docs, "n_removed")
    out = line_dedup.dedup_lines(docs, counts=(n, gone))
    return out.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col(n).alias("n_lines"),
                      F.col(gone).alias("n_removed"))


def op2_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"),
                                public_tokenizers.path("word_bpe_49k.json"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digest_columns(pii.find_spans(docs, pii.fit(docs)))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_documents(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op10_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).taken()


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_bpe_encode_decode, op3_simhash_near_dedup, op4_quality_classifier, op5_pii,
    op6_benchmark_decontamination, op7_document_fingerprints, op8_token_counts, op9_lm_scoring,
    op10_token_id_output, op11_source_mixing, op12_conversation_repair, op13_lexical_search)}

#: The others cannot be told in SQL: hashes, tokenizers and fitted models. tests/llm holds them
#: against brute-force versions.
ORACLE_SQL = {"op1_line_dedup": line_dedup.ORACLE, "op12_conversation_repair": repair.ORACLE,
              "op13_lexical_search": search.ORACLE}
