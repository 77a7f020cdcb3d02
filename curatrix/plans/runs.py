"""Whole runs: the export of scored rows, one call for each row, and one bulk job for all of them."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import extract_code, step_check
from ..operators.curate import GEOMETRY, SkipRules, limit_after_filter, limit_before_filter, score_filter, skip_classify
from ..operators.keys import default_id
from ..operators.outcome import classify, manifest, manifest_array, run_stats, validation_record
from ..operators.requests import EFFORT, envelope, join_responses, requests
from ..schemas import BATCH_INFO, RESPONSE_LINE
from ..sources import files, readers, writers
from . import ledger
from .external import Generator, Validator, validate
from .verdicts import validate_once

# Seconds between looks at a job, and seconds to wait for it.
INTERVAL, MOST_WAIT = 60, 86400
TERMINAL = ("completed", "failed", "cancelled", "expired")


def export_scored(df: DataFrame, max_rows: int | None = None, score: str = "score", order: str = "pos") -> DataFrame:
    """Filter by score, then limit; rows in the order of that column if there is one."""
    d = score_filter(df, score)
    if max_rows is not None and order not in d.columns:
        if max_rows < 0:
            raise ValueError("a limit must not be negative")
        return d.limit(max_rows)
    return limit_after_filter(d, max_rows, order)


def prepare(problems: DataFrame, max_problems: int | None = None, skip: bool = True, rules: SkipRules = GEOMETRY) -> DataFrame:
    """Limit first, then ids and skip reasons: fewer rows than the limit may be left to process."""
    return skip_classify(default_id(limit_before_filter(problems, max_problems)), "problem", rules, skip)


def finish(answered: DataFrame, skipped: DataFrame, check: Validator, batch: bool, model: str | None = None, store: str | None = None, name: str = "check") -> DataFrame:
    """Code, validation and outcome of answered rows, with the skipped ones; one wide log. With a ``store`` each distinct program is checked once
    by the validator of that name, see verdicts.validate_once().

    A run of calls has, for each row, start_time, end_time, total_duration_seconds (of its call and its check) and
    api_call{duration_seconds, model}; a bulk run has the timestamp at which the row was dealt with.
    """
    d = answered.withColumn("generated_code", F.when(F.length("response") > 0, extract_code("response")))
    d = validate_once(d, check, store, name) if store else validate(d, check)
    d = d.withColumn("parsability", step_check("generated_code"))
    both = classify(d.unionByName(skipped, allowMissingColumns=True), batch).withColumn("batch_mode", F.lit(batch))
    now = F.current_timestamp()
    if batch:
        return both.withColumn("timestamp", now)
    took = F.coalesce("call_seconds", F.lit(0.0)) + F.coalesce("compilation.duration_seconds", F.lit(0.0))
    start = F.coalesce("start_time", now)
    both = both.withColumn("start_time", start).withColumn("total_duration_seconds", F.round(took, 2)).withColumn("end_time", F.timestamp_micros((F.unix_micros(start) + took * 1e6).cast("long")))
    called = F.when(~F.col("skipped"), F.struct(F.col("call_seconds").alias("duration_seconds"), F.lit(model).alias("model")))
    return both.withColumn("api_call", called).drop("call_seconds")


def run_sync(
    problems: DataFrame,
    system_prompt: str,
    call: Generator,
    check: Validator,
    out: str,
    max_problems: int | None = None,
    skip: bool = True,
    rules: SkipRules = GEOMETRY,
    model: str | None = None,
    run_id: str = "run",
    effort: str | None = None,
    window: int = 1,
    rate: float | None = None,
    store: str | None = None,
    name: str = "check",
) -> DataFrame:
    """The log of a run that calls the generator once for each row that is not skipped.

    Requests are written to ``out``/requests/run_id=…, answers go to the ledger ``out``/ledger/run_id=… as they come, the log to
    ``out``/log/run_id=…. A run that is started again with the same run_id asks for what its ledger lacks and for nothing else;
    see ledger.ask() for ``window`` and ``rate``, finish() for ``store`` and ``name``.
    """
    spark = problems.sparkSession
    d = prepare(problems, max_problems, skip, rules)
    reqs = _written(requests(d.where("not skipped"), system_prompt), f"{out}/requests/run_id={run_id}")
    answered = ledger.ask(reqs, call, f"{out}/ledger/run_id={run_id}", model, effort, window, rate)
    writers.problem_logs(finish(answered, d.where("skipped"), check, False, model, store, name), f"{out}/log", run_id)
    return read_log(spark, out, run_id)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_log(spark: SparkSession, out: str, run_id: str) -> DataFrame:
    return spark.read.parquet(f"{out}/log/run_id={run_id}")


class Transport(Protocol):
    """The bulk service. It takes and gives paths; no executor talks to it."""

    def submit(self, path: str) -> str: ...

    def status(self, job: str) -> dict: ...

    def results(self, job: str) -> str: ...


def poll(transport: Transport, job: str, interval: float = INTERVAL, most: float = MOST_WAIT, sleep: Callable[[float], None] = time.sleep) -> tuple[str, dict]:
    """(status, last answer) once it is final, or ("timeout", ...). A look that fails is one of the looks; the next may not."""
    waited, last = 0.0, {}
    while waited < most:
        try:
            last = transport.status(job)
        except Exception as e:
            last = {"status": "error", "errors": str(e)}
        if last.get("status") in TERMINAL:
            return last["status"], last
        sleep(interval)
        waited += interval
    return "timeout", last


def settled_jobs(looks: DataFrame, interval: float = INTERVAL, most: float = MOST_WAIT) -> DataFrame:
    """(job, status, looks, progress) of many jobs from the looks at them (job, look, status, completed, total), as poll() ends for each.

    A look with a null status is one that failed. The first final status counts, if waiting has not taken ``most`` seconds by then,
    else it is ``timeout``, without progress. looks is the number that were made, ordered by ``look``.
    """
    n = F.row_number().over(Window.partitionBy("job").orderBy("look"))
    seen = looks.withColumn("_n", n).where(F.col("_n") <= -(-most // interval))
    final = F.when(is_terminal("status"), F.struct("_n", "status", "completed", "total"))
    d = seen.groupBy("job").agg(F.min(final).alias("_f"), F.max("_n").alias("_all"))
    percent = F.when(F.col("_f.total") > 0, F.col("_f.completed") * 100.0 / F.col("_f.total")).otherwise(F.lit(0.0))
    shown = F.format_string("%d/%d (%.1f%%)", F.col("_f.completed").cast("long"), F.col("_f.total").cast("long"), percent)
    made = F.coalesce("_f._n", "_all").cast("long")
    return d.select("job", F.coalesce("_f.status", F.lit("timeout")).alias("status"), made.alias("looks"), F.when(F.col("_f").isNotNull(), shown).alias("progress"))


def is_terminal(status: Column | str) -> Column:
    """Whether a job's status is final."""
    return F.coalesce((F.col(status) if isinstance(status, str) else status).isin(*TERMINAL), F.lit(False))


def progress(counts: dict | None) -> str:
    """Completed of total, and the percentage with one digit."""
    total, done = (counts or {}).get("total", 0), (counts or {}).get("completed", 0)
    return f"{done}/{total} ({done / total * 100 if total else 0:.1f}%)"


def run_batch(
    problems: DataFrame,
    system_prompt: str,
    transport: Transport,
    check: Validator,
    out: str,
    model: str,
    max_problems: int | None = None,
    skip: bool = True,
    rules: SkipRules = GEOMETRY,
    effort: str = EFFORT,
    run_id: str = "run",
    store: str | None = None,
    name: str = "check",
    **waiting,
) -> DataFrame:
    """The log of a bulk run under ``out``: request lines, then, once the job is completed, a copy of its raw output, then outcomes, each
    in a folder by run. Without a row to ask for no job is submitted.

    A run that is started again with the same run_id goes on with the job that it has submitted and with the raw output that it has
    copied; its requests stay as they were submitted.
    """
    spark = problems.sparkSession
    d = prepare(problems, max_problems, skip, rules)
    of = lambda name: f"{out}/{name}/run_id={run_id}"
    if not files.exists(spark, f"{of('batch_info')}/_SUCCESS"):
        reqs = _written(requests(d.where("not skipped"), system_prompt), of("requests"))
        if not reqs.isEmpty():
            writers.request_lines(envelope(reqs, model, effort), of("batch_input"))
            job = transport.submit(of("batch_input"))
            writers.write_one(writers.batch_info(spark, job, of("batch_input"), time.strftime("%Y-%m-%dT%H:%M:%S"), reqs.count()), of("batch_info"))
    reqs = spark.read.parquet(of("requests"))
    if reqs.isEmpty():
        lines = spark.createDataFrame([], f"line_no int, {RESPONSE_LINE}")
    else:
        job = batch_id(spark, out, run_id)
        if not files.exists(spark, f"{of('batch_output')}/_COPIED"):
            status, last = poll(transport, job, **waiting)
            if status != "completed":
                raise RuntimeError(f"job {job}: {status} {last.get('errors') or ''}")
            writers.keep_raw(spark, transport.results(job), of("batch_output"))
        lines = readers.responses(spark, of("batch_output"))
    writers.problem_logs(finish(join_responses(reqs, lines), d.where("skipped"), check, True, None, store, name), f"{out}/log", run_id)
    return read_log(spark, out, run_id)


def batch_id(spark: SparkSession, out: str, run_id: str) -> str | None:
    """The job that a bulk run has submitted, if it has."""
    path = f"{out}/batch_info/run_id={run_id}"
    if not files.exists(spark, path):
        return None
    row = spark.read.schema(BATCH_INFO).json(path).first()
    return row.batch_id if row else None


def retrieve(spark: SparkSession, path: str, check: Validator | None = None) -> DataFrame:
    """(custom_id, response, generated_code[, compilation, parsability]) of bulk output, without the problems. See retrieve_to()."""
    from ..operators.keys import response_map

    d = response_map(readers.responses(spark, path)).where(F.length("content") > 0)
    d = d.select("custom_id", F.col("content").alias("response"), extract_code("content").alias("generated_code"))
    return d if check is None else validate(d, check).withColumn("parsability", step_check("generated_code"))


def retrieve_to(spark: SparkSession, path: str, out: str, check: Validator | None = None) -> None:
    """Bulk output under ``out``: its raw bytes, and tables by custom_id of responses, of code where there is some, and of verdicts if
    there is a validator. Each is on disk before the next is made."""
    kept = writers.keep_raw(spark, path, f"{out}/raw")
    retrieve(spark, kept).select("custom_id", "response").write.mode("overwrite").parquet(f"{out}/responses")
    got = spark.read.parquet(f"{out}/responses").withColumn("generated_code", extract_code("response"))
    got.where(F.length("generated_code") > 0).select("custom_id", F.col("generated_code").alias("code")).write.mode("overwrite").parquet(f"{out}/code")
    if check is not None:
        checked = validate(got, check).withColumn("parsability", step_check("generated_code"))
        validation_record(checked).write.mode("overwrite").parquet(f"{out}/validation")


def summarise(log: DataFrame, one_row: bool = False, **fields) -> DataFrame:
    """The run summary; with one_row it holds the manifest too, which raises for runs too large for that."""
    return writers.run_summary(run_stats(log), manifest_array(log) if one_row else None, **fields)


def write_summary(log: DataFrame, out: str, one_row: bool = False, **fields) -> None:
    """The summary as one line of JSON in ``out``/run_summary, the manifest as lines in ``out``/problem_files."""
    writers.write_one(summarise(log, one_row, **fields), f"{out}/run_summary")
    writers.json_lines(manifest(log).select("pos", "problem_id", "status", "file"), f"{out}/problem_files", "overwrite")
