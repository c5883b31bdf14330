"""The registered queries of this subpackage: each applies one operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.llm.oracles import ORACLES  # noqa: F401


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from turnstone.llm.token_counts import token_counts

    return token_counts(_read(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"), 4096)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from turnstone.llm.language_id import identify

    return identify(_read(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from turnstone.llm.quality import quality_rules

    return quality_rules(_read(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from turnstone.llm.transport_stream import decode_streams, stored

    return decode_streams(stored(_read(spark, sf_dir, "documents"))).drop("error")


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of ``docs`` with a digest in place of their ids."""
    import public_tokenizers

    from turnstone.llm.packing import pack_documents

    pieces = pack_documents(docs, _tokenizer("byte_bpe_50k.json"), _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_read(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from turnstone.llm.lm_scoring import score

    return score(_read(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from turnstone.llm.simhash import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from turnstone.llm.warc import archived

    return archived(_read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from turnstone.llm.mixing import rates

    return rates(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from turnstone.llm.recompression import repeats

    return repeats(_read(spark, sf_dir, "documents"), 20).select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_token_counts, op2_language_id, op3_quality_rules, op4_media_columns, op5_packing, op6_lm_scoring, op7_simhash, op8_warc, op9_mixing, op10_substring_dedup)}
