"""The corpus operators as queries over the driver's tables, whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, lang_id, license_scan, lm_score, ngram_join, piece_codec, pii, pivot_search, substring_dedup, token_store
from ._common import load


def tokenizer_path(name: str) -> str:
    """Where the box keeps a public tokenizer file; the operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document by pattern, checksum and context; see ``pii``. Null text counts as empty, a row in gives a row out."""
    return pii.pii_report(load(spark, sf_dir, "documents"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and what they decode to; see ``piece_codec``. Null text counts as empty, a row in gives a row out."""
    return piece_codec.piece_report(load(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of every document under a model of the corpus; see ``lm_score``. Null text is the end token alone; repeated rows and
    rows without an id are learnt from and scored each."""
    return lm_score.score_texts(load(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and component of every document; see ``ngram_join``. Texts without words and rows without an id link with nothing."""
    return ngram_join.ngram_components(load(spark, sf_dir, "documents"))


def op4_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many classes each class links with; see ``ngram_join``. Rows without an id have no class."""
    return ngram_join.link_counts(load(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query row's five best inner products; see ``pivot_search``. Rows are told apart, so repeated ones are candidates each."""
    return pivot_search.top_inner_products(load(spark, sf_dir, "embeddings"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written in ascending doc_id order and read back; see ``token_store``. Null text is the end id alone; rows without an id
    come first, repeated ones beside each other."""
    return token_store.token_report(load(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that repeat across documents; see ``substring_dedup``. Rows of one id are one document."""
    return substring_dedup.substring_report(load(spark, sf_dir, "documents"))


def op8_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; see ``lang_id``. Texts without a letter are ``und``; a row in gives a row out."""
    return lang_id.predict_languages(load(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document; see ``license_scan``. Texts without one give no rows."""
    return license_scan.scan_licenses(load(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold test items, and which; see ``decontaminate``. Rows without text or id take no part."""
    found = decontaminate.contained_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.withColumn("containment", F.round("containment", 9))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_pii, op2_pieces, op3_lm_score, op4_ngram_join, op4_ngram_links, op5_topk, op6_token_store, op7_substring_dedup, op8_lang_id, op9_licenses, op10_decontaminate)}
