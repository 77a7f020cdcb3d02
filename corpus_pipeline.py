"""A corpus pipeline: quality rules, line dedup, near-dedup, mixing, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns of documents. Stages that send texts to
Python have the session's Arrow batches end at 4 MB, unless the session sets their size itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm import linededup, mixing, neardup, pieces, quality
from curatrix.llm.queries import vocabulary
from curatrix.llm.storage import stage_table
from curatrix.session import small_batches

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
PERCENT, MATCHES = 80, 32  # similarity in percent; signature coordinates that have to agree (of 64; 51 are expected at 80 %)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null, empty and wordless texts go; rows of a repeated doc_id are judged each."""
    small_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that line dedup drops; n_chars follows. A document that loses all its lines stays, empty, as does
    one whose text is null. Rows of a repeated doc_id lose the same lines; rows without an id count for nothing and keep theirs."""
    small_batches(spark)
    d = linededup.line_dedup(docs.select("doc_id", "text", "lang", "source"))
    return d.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id, with all its rows. Wordless texts and rows without
    an id stay."""
    small_batches(spark)
    return neardup.drop_near_duplicates(docs, percent=PERCENT, matches=MATCHES).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as many times as they are taken. A null source is one of its own; wordless texts add no words."""
    return mixing.mixed(docs).select(*COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix as ids of pieces; a null or empty text has none."""
    small_batches(spark)
    d = pieces.encode(docs, vocabulary("piece_bpe_32k.model"), keep_text=False)
    return d.select("doc_id", "lang", "source", "n_chars", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("sentencepiece", sentencepiece)]

#: The first stage is a learned model and the last one a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir, each one's result written and read back for the next, its own tables then deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stage_table(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
