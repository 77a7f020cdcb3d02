"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, linededup, mixing, mpeg, neardup, phrases, pieces, quality, repair, sharding, substring, vamana, whitening

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Where a public tokenizer file lies on this machine; every executor has the same package."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), keep=("doc_id",)).select("doc_id", "size", "source_size", "target", "taken")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.line_dedup(d).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg.media_column(_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.token_files(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vamana.nearest(_table(spark, sf_dir, "embeddings"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return d.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    own = (op1_quality_rules, op2_minhash_near_dedup, op3_mix_sources, op4_line_dedup, op5_language_id, op6_sentencepiece, op7_substring_dedup, op8_sharding, op9_media_columns, op10_token_files, op11_nearest_neighbours, op12_embedding_whitening, op13_collocations)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that it can express. Quality and language are learned; neighbours are found by walks, whose recall is measured, and
    eigenvectors are not in SQL; checksums (the other
    engine has no crc32) and tokenizers are not in SQL; those are tested against brute force."""
    return {"op2_minhash_near_dedup": neardup.ORACLE_SQL, "op3_mix_sources": mixing.ORACLE_SQL, "op4_line_dedup": linededup.ORACLE_SQL, "op7_substring_dedup": substring.ORACLE_SQL, "op13_collocations": phrases.ORACLE_SQL}
