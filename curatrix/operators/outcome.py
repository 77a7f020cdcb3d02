"""What became of each row, and the counts and manifest of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import STATS
from .places import with_place

NO_RESPONSE, NO_BATCH_RESPONSE, NOT_COMPILED, NOT_PARSABLE = "No response from API", "No response from batch API", "Compilation failed", "Not parsable"


def no_response(c: Column | str) -> Column:
    """Null and empty responses are no responses."""
    return F.coalesce(F.length(F.col(c) if isinstance(c, str) else c), F.lit(0)) == 0


def classify(df: DataFrame, batch: bool = False) -> DataFrame:
    """df (skip_reason, response, compilation, parsability) with status, error and bucket.

    One at a time a row is skipped, without a response, not compiled, not parsable, or a success; the later fields of a
    row that ended early are null. In a batch the step check of a row that didn't compile is kept.
    """
    skipped, silent = F.col("skip_reason").isNotNull(), no_response("response")
    bad = ~F.coalesce(F.col("compilation.success"), F.lit(False))
    unparsable = ~F.coalesce(F.col("parsability.is_parsable"), F.lit(False))
    error = F.when(skipped, F.lit(None)).when(silent, F.lit(NO_BATCH_RESPONSE if batch else NO_RESPONSE)).when(bad, F.lit(NOT_COMPILED)).when(unparsable, F.lit(NOT_PARSABLE))
    early = skipped | silent
    out = df.withColumns(
        {
            "status": F.when(skipped, F.lit("skipped")).when(silent | bad | unparsable, F.lit("failed")).otherwise(F.lit("success")),
            "error": error.cast("string"),
            "parsability": F.when(~(early if batch else early | bad), F.col("parsability")),
            "compilation": F.when(~early, F.col("compilation")),
        }
    )
    return out.withColumn("bucket", bucket("status", "error"))


def bucket(status: str = "status", error: str = "error") -> Column:
    """The count that an outcome goes to; a failure of unknown error counts as the service's."""
    s, e = F.col(status), F.coalesce(F.col(error), F.lit(""))
    failed = F.when(F.contains(e, F.lit(NOT_COMPILED)), F.lit("failed_compilation")).when(F.contains(e, F.lit(NOT_PARSABLE)), F.lit("failed_parsable")).otherwise(F.lit("failed_api"))
    return F.when(s == "skipped", F.lit("skipped")).when(s == "success", F.lit("successful")).otherwise(failed)


def run_stats(classified: DataFrame, *by: str) -> DataFrame:
    """One row (one for each group of ``by``) of counts; total is the sum of the others."""
    counts = [F.count_if(F.col("bucket") == b).alias(b) for b in STATS[1:]]
    return classified.groupBy(*by).agg(F.count("*").alias("total"), *counts) if by else classified.agg(F.count("*").alias("total"), *counts)


def manifest(classified: DataFrame, order: str = "pos") -> DataFrame:
    """A row (pos, problem_id, status, file) for each row, to be written as a table: this scales. See manifest_array()."""
    return classified.select(order, "problem_id", "status", F.concat("problem_id", F.lit(".json")).alias("file"))


def manifest_in_order(classified: DataFrame, order: str = "pos") -> DataFrame:
    """manifest() with the place of each row from 0, gapless, at any size."""
    return with_place(manifest(classified, order), order)


ONE_ROW = 100_000  # rows of a run whose manifest one row may hold


def manifest_array(classified: DataFrame, order: str = "pos", most: int = ONE_ROW) -> DataFrame:
    """One row with the whole manifest in order, as a run summary can hold it; raises ValueError for more than ``most`` rows."""
    m = manifest(classified, order)
    if (n := m.count()) > most:
        raise ValueError(f"{n} rows are too many for one row of a manifest; write manifest() as a table")
    got = F.array_sort(F.collect_list(F.struct(order, "problem_id", "status", "file")))
    return m.agg(F.transform(got, lambda x: F.struct(x["problem_id"].alias("problem_id"), x["status"].alias("status"), x["file"].alias("file"))).alias("problem_files"))


def validation_record(df: DataFrame) -> DataFrame:
    """(custom_id, compilation{success, output}, parsability)."""
    return df.select("custom_id", F.struct("compilation.success", "compilation.output").alias("compilation"), "parsability")


def row_counts(df: DataFrame, kept: Column) -> DataFrame:
    """Rows before and after a filter, in one pass."""
    return df.agg(F.count("*").alias("rows_before"), F.count_if(kept).alias("rows_after"))
