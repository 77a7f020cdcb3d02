"""One check for each distinct program: verdicts are kept by content, across rows and runs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ledger
from .external import Validator

_VERDICT = "success boolean, output string, duration_seconds double"


def digest(name: str, code: str = "generated_code") -> F.Column:
    """A program as a validator of this name sees it; a null one is an empty one."""
    return F.sha2(F.to_json(F.struct(F.lit(name).alias("by"), F.coalesce(code, F.lit("")).alias("code"))), 256)


def verdicts(spark: SparkSession, store: str) -> DataFrame:
    """(digest, success, output, duration_seconds): the first verdict on each program."""
    d = ledger.answers(spark, store)
    v = F.from_json("response", "success boolean, output string")
    return d.select("digest", v.alias("_v"), "call_seconds").select("digest", "_v.success", "_v.output", F.col("call_seconds").alias("duration_seconds"))


def validate_once(df: DataFrame, check: Validator, store: str, name: str, window: int = 1) -> DataFrame:
    """external.validate(), with one check for each distinct program that ``store`` has no verdict on by the validator of this name.

    df (response, generated_code, ...) gets compilation, null for rows without a response. Programs are told apart by their digest; one
    row stands for all that have it, so a program that a third of all rows share is checked, shuffled and kept once. What
    ``check`` raises fails the task, and verdicts given until then stay. A check whose result may change, as by a new
    compiler, needs another name. df is evaluated twice and should be a written table.
    """
    d = df.drop("compilation").withColumn("_digest", F.when(F.length("response") > 0, digest(name)))
    programs = d.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.first(F.coalesce("generated_code", F.lit(""))).alias("code"))

    def judge(code: str) -> str:
        ok, said = check(code)
        return json.dumps({"success": bool(ok), "output": said})

    ledger.fill(programs, judge, store, window)
    have = verdicts(df.sparkSession, store).withColumnRenamed("digest", "_of")
    out = d.join(have, d["_digest"] == have["_of"], "left")
    verdict = F.when(F.col("_of").isNotNull(), F.struct("success", "duration_seconds", "output"))
    return out.select(*(d[f"`{c}`"] for c in d.columns if c != "_digest"), verdict.alias("compilation"))
