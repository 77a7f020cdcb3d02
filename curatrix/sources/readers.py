"""Scans: Parquet tables, downloaded datasets, JSON documents, JSON lines of responses, texts, code, table information."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.places import with_file_place
from ..schemas import PROBLEM, RESPONSE_LINE
from .footers import column_chunks
from .jsonscan import json_records

DEFAULT_SYSTEM_PROMPT = """You turn mathematical problems into Lean 4 code that compiles without unfinished proofs.
Answer with one fenced block of Lean code. Begin it with `set_option warningAsError true`.
Put each step of a proof between the comments `-- [STEP_n: what it does]` and `-- [END_STEP_n]`.
"""


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def hosted_dataset(spark: SparkSession, root: str, split: str = "train", config: str | None = None) -> DataFrame:
    """A dataset that was downloaded as root/config/split/*.parquet; there is no network here."""
    return spark.read.parquet("/".join([root.rstrip("/"), *([config] if config else []), split]))


def problems_json(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """(pos, problem_id, problem, solution, metadata) of a JSON array of objects, or of one object, read by many tasks; see json_records().

    pos counts from 1 in the order of the document. A key that is missing has its default ('' for texts, {} for metadata,
    problem_{pos} for the id); an explicit null stays null, but for the id. A key that comes twice fails.
    """
    rows = json_records(spark, path, parts).select("pos", F.parse_json("record").alias("v"))

    def text(key: str, default) -> F.Column:
        got = F.variant_get("v", f"$.{key}", "variant")
        return F.when(got.isNull(), default).otherwise(F.try_variant_get("v", f"$.{key}", "string"))

    made = F.concat(F.lit("problem_"), F.col("pos").cast("string"))
    meta = F.coalesce(F.variant_get("v", "$.metadata", "variant"), F.parse_json(F.lit("{}")))
    return rows.select(
        "pos",
        F.coalesce(text("problem_id", made), made).alias("problem_id"),
        text("problem", F.lit("")).alias("problem"),
        text("solution", F.lit("")).alias("solution"),
        meta.alias("metadata"),
    )


def problems_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, problem_id, problem, solution, metadata) of problems as JSON lines, which can be split among tasks: pos counts the lines from 1
    through all files by name, other columns are as they come, null where a key is missing. An empty line is no line."""
    return with_file_place(spark.read.schema(PROBLEM).json(path), "pos", 1).select("pos", "problem_id", "problem", "solution", "metadata")


def problems_table(df: DataFrame, pos: str) -> DataFrame:
    """(pos, problem_id, problem, solution, metadata) of a table that may lack columns, by the rule of problems_json(): a missing column has
    its default, an explicit null stays null but for the id. pos counts rows in the order of the column that is named."""
    has = lambda c, default: F.col(c) if c in df.columns else default
    made = F.concat(F.lit("problem_"), F.col(pos).cast("string"))
    return df.select(
        F.col(pos).cast("long").alias("pos"),
        F.coalesce(has("problem_id", made).cast("string"), made).alias("problem_id"),
        has("problem", F.lit("")).alias("problem"),
        has("solution", F.lit("")).alias("solution"),
        has("metadata", F.parse_json(F.lit("{}"))).alias("metadata"),
    )


def responses(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(line_no, custom_id, response) of bulk output. Lines that can't be read are set aside (see bad_responses()); strict raises instead.

    line_no orders lines within a file by their place in it, and files by name.
    """
    lines = _response_lines(spark, path)
    if strict:
        bad = lines.where("_bad").limit(1).collect()
        if bad or lines.isEmpty():
            raise ValueError(f"a response line can't be read: {bad[0]._raw[:200]!r}" if bad else "no response line")
    return lines.where("not _bad").select("line_no", "custom_id", "response")


def bad_responses(spark: SparkSession, path: str) -> DataFrame:
    return _response_lines(spark, path).where("_bad").select("line_no", F.col("_raw").alias("line"))


def _response_lines(spark: SparkSession, path: str) -> DataFrame:
    kind = f"{RESPONSE_LINE}, _corrupt string"
    place = (F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i"))
    raw = spark.read.text(path).select("value", *place).where(F.trim("value") != "")
    got = F.from_json("value", kind, {"columnNameOfCorruptRecord": "_corrupt"})
    d = raw.withColumn("_j", got)
    bad = F.col("_j").isNull() | F.col("_j._corrupt").isNotNull() | F.col("_j.response").isNull() | F.col("_j.custom_id").isNull()
    return d.select(
        F.struct("_f", "_b", "_i").alias("line_no"),
        F.col("_j.custom_id").alias("custom_id"),
        F.struct("_j.response.status_code", "_j.response.body").alias("response"),
        bad.alias("_bad"),
        F.col("value").alias("_raw"),
    )


def system_prompt(spark: SparkSession, path: str | None = None) -> str:
    """A prompt file's text, or the default. It is a parameter of the run, so the driver reads it."""
    if not path:
        return DEFAULT_SYSTEM_PROMPT
    return "".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def code(spark: SparkSession, file: str | None = None, inline: str | None = None) -> DataFrame:
    """(code): of a file or of a text, one of which must be given."""
    if (file is None) == (inline is None):
        raise ValueError("give either a file or a text")
    return spark.read.text(file, wholetext=True).withColumnRenamed("value", "code") if file else spark.createDataFrame([(inline,)], "code string")


def table_info(spark: SparkSession, path: str) -> DataFrame:
    """A row for each column: ordinal, column_name, column_type (logical type), physical_type (of its leaves, joined), n_rows, n_bytes, n_columns.

    Counts and physical types come from the files' footers; no data is scanned. See footers.column_chunks() for row groups,
    encodings, sizes and null counts, and operators.curate.preview().
    """
    schema = spark.read.parquet(path).schema
    chunks = column_chunks(spark, path)
    files = chunks.groupBy("file").agg(F.max("file_bytes").alias("s"), F.max("file_rows").alias("n"))
    total = files.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"), F.coalesce(F.sum("s"), F.lit(0)).cast("long").alias("n_bytes"))
    leaves = F.array_join(F.sort_array(F.collect_set("physical_type")), ", ")
    kinds = chunks.where("physical_type is not null").groupBy(F.substring_index("column", ".", 1).alias("_c")).agg(leaves.alias("physical_type"))
    cols = spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema)], "ordinal int, column_name string, column_type string")
    d = cols.join(kinds, cols.column_name == kinds["_c"], "left").crossJoin(F.broadcast(total))  # one row of totals
    return d.select("ordinal", "column_name", "column_type", "physical_type", "n_rows", "n_bytes", F.lit(len(schema)).cast("long").alias("n_columns"))


def api_key(given: str | None = None, variable: str = "OPENAI_API_KEY") -> str:
    """The given key, else the environment's. It never enters a table."""
    found = given or os.environ.get(variable)
    if not found:
        raise ValueError(f"no key: give one or set {variable}")
    return found
