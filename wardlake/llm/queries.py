"""The operators of this package as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardlake.llm import exact_dedup, licenses, merkle_manifest, mixing
from wardlake.llm.bpe_codec import bpe_codec
from wardlake.llm.common import documents, labels
from wardlake.llm.fingerprints import fingerprint_neighbours
from wardlake.llm.jaccard_join import jaccard_components
from wardlake.llm.sentencepiece_codec import sentencepiece_codec
from wardlake.llm.substring_dedup import substring_dedup
from wardlake.llm.token_alignment import token_alignment
from wardlake.llm.token_counts import token_counts
from wardlake.llm.token_files import token_files
from wardlake.llm.toxicity import toxicity

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir), WORD_BPE, end_id=2)


def op3_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec(documents(spark, sf_dir), PIECE_BPE)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), PIECE_BPE, limit=4096)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir), mixing.PRODUCTION)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.merkle_manifest(documents(spark, sf_dir))


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec(documents(spark, sf_dir), WORD_BPE)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(documents(spark, sf_dir), BYTE_BPE, PIECE_BPE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_token_files,
        op3_sentencepiece_codec,
        op4_exact_dedup,
        op5_jaccard_join,
        op6_fingerprints,
        op7_token_counts,
        op8_toxicity,
        op9_mix_sources,
        op10_license_scan,
        op11_merkle_manifest,
        op12_bpe_codec,
        op13_token_alignment,
    )
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op9_mix_sources": mixing.oracle(),
    "op10_license_scan": licenses.oracle(),
    "op11_merkle_manifest": merkle_manifest.ORACLE,
}
