"""Queries of runs that go on where they stopped, and of what executors write on their own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import new_path
from . import io_queries, ledger, runs

Query = Callable[[SparkSession, str], DataFrame]


def _numbered(spark, sf_dir) -> DataFrame:
    """Problems of labels in which no two texts are equal."""
    d = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return d.select(
        F.col("doc_id").alias("pos"),
        F.concat(F.lit("p"), F.col("doc_id") % 700).alias("problem_id"),
        F.concat(F.lit("show "), F.col("doc_id")).alias("problem"),
        F.lit("").alias("solution"),
    )


def resumed_run(spark, sf_dir):
    """A run that dies when most of its rows are answered, and the same run once more: how often each row was asked, and by which.

    The generator of the first run dies at the last tenth of the rows. Every answer is in the ledger once; what the first run has is not
    asked for again; the log of the second holds all rows.
    """
    out = new_path(spark, "resumed")
    problems = _numbered(spark, sf_dir)
    first = problems.agg((F.max("pos") * 9 / 10).cast("long")).first()[0]
    calls = spark.sparkContext.accumulator(0)

    def dies(system: str, user: str) -> str | None:
        if int(user.split("show ")[1].split("\n")[0]) > first:
            raise ConnectionError("the service is gone")
        return "```lean\n-- [STEP_1: x]\n-- [END_STEP_1]\n```"

    def answers(system: str, user: str) -> str | None:
        calls.add(1)
        return "```lean\n-- [STEP_1: x]\n-- [END_STEP_1]\n```"

    died = False
    try:
        runs.run_sync(problems, "S", dies, io_queries._check, out, run_id="r")
    except Exception:
        died = True
    before = ledger.entries(spark, f"{out}/ledger/run_id=r").count()
    log = runs.run_sync(problems, "S", answers, io_queries._check, out, run_id="r")
    asked = ledger.entries(spark, f"{out}/ledger/run_id=r").groupBy("digest").agg(F.count("*").alias("n"))
    counts = asked.agg(F.count("*").alias("n_asked"), F.count_if(F.col("n") > 1).alias("n_asked_twice"))
    rows = log.agg(F.count("*").alias("n_logged"), F.count_if(F.col("response").isNotNull()).alias("n_answered"))
    both = counts.join(rows)  # one row each
    return both.withColumns({"died": F.lit(died), "first_has_some": F.lit(before > 0), "second_asked_the_rest": F.col("n_asked") == before + calls.value, "second_asked_some": F.lit(calls.value > 0)})


def repeated_run(spark, sf_dir):
    """A run that is whole and is started again asks for nothing, but for the rows that had no answer."""
    out = new_path(spark, "repeated")
    problems = _numbered(spark, sf_dir)
    calls = spark.sparkContext.accumulator(0)

    def some(system: str, user: str) -> str | None:
        calls.add(1)
        n = int(user.split("show ")[1].split("\n")[0])
        return None if n % 10 == 3 else f"answer {n}"

    log = runs.run_sync(problems, "S", some, io_queries._check, out, run_id="r")
    first = calls.value
    log = runs.run_sync(problems, "S", some, io_queries._check, out, run_id="r", window=8)
    again = calls.value - first
    d = log.select("pos", "custom_id", "response")
    return d.withColumns({"n_first": F.lit(first).cast("long"), "n_again": F.lit(again).cast("long")})


def resumed_bulk_run(spark, sf_dir):
    """A bulk run whose driver is lost while it waits, and the same run once more: one job, and all outcomes."""
    out = new_path(spark, "resumed-bulk")
    problems = io_queries._problems(spark, sf_dir)
    submitted = []

    class Service(io_queries.BulkService):
        def submit(self, path: str) -> str:
            submitted.append(path)
            return super().submit(path)

    service, waiting = Service(spark), {"interval": 0.0, "most": 1.0, "sleep": lambda s: None}
    service.status = lambda job: (_ for _ in ()).throw(KeyboardInterrupt())
    try:
        runs.run_batch(problems, "S", service, io_queries._check, out, "m", run_id="r", **waiting)
    except KeyboardInterrupt:
        del service.status
    log = runs.run_batch(problems, "S", service, io_queries._check, out, "m", run_id="r", **waiting)
    log = runs.run_batch(problems, "S", None, io_queries._check, out, "m", run_id="r")  # with its raw output at hand it needs no service
    counts = log.groupBy("status", "bucket").agg(F.count("*").alias("n"))
    return counts.withColumn("n_jobs", F.lit(len(submitted)).cast("long"))


def verdicts_by_content(spark, sf_dir):
    """A run over problems many of which have the same program, and another run of the same: checks, and distinct programs."""
    out, store = new_path(spark, "verdicts"), new_path(spark, "store")
    checks = spark.sparkContext.accumulator(0)

    def check(code: str) -> tuple[bool, str]:
        checks.add(1)
        return io_queries._check(code)

    problems = io_queries._problems(spark, sf_dir)
    log = runs.run_sync(problems, "S", io_queries._answer, check, out, run_id="a", store=store)
    first = checks.value
    log = runs.run_sync(problems, "S", io_queries._answer, check, out, run_id="b", store=store)
    counted = log.groupBy("bucket", "status").agg(F.count("*").alias("n"), F.count_distinct("generated_code").alias("n_programs"))
    return counted.withColumns({"n_checks": F.lit(first).cast("long"), "n_again": F.lit(checks.value - first).cast("long")})


_OWN = (resumed_run, repeated_run, resumed_bulk_run, verdicts_by_content)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _OWN}


def oracle_sql() -> dict[str, str]:
    ids = "'p' || (doc_id % 700)::VARCHAR"
    repeat = "row_number() OVER (PARTITION BY doc_id % 700 ORDER BY doc_id) - 1"
    custom = f"{ids} || CASE WHEN {repeat} = 0 THEN '' ELSE '_' || ({repeat})::VARCHAR END"
    ok = "problem IS NOT NULL AND NOT contains(problem, 'construct')"
    user = f"'Problem:' || chr(10) || problem || chr(10) || chr(10) || {io_queries._lit(io_queries.T.ASK)}"
    mark = "CASE WHEN length(u) % 3 <> 0 THEN '-- [STEP_1: x]' || chr(10) || '-- [END_STEP_1]' || chr(10) ELSE '' END"
    code = f"CASE WHEN length(u) % 5 <> 0 AND {ok} THEN regexp_replace({mark} || CASE WHEN length(u) % 2 = 0 THEN u ELSE right(u, 1) END, '\\A\\s+|\\s+\\z', '', 'g') END"
    programs = f"SELECT pos, problem, {code} AS code FROM (SELECT *, {user} AS u FROM p)"
    return {
        "verdicts_by_content": f"""WITH {io_queries._P}, c AS ({programs}), o AS ({io_queries._run_sql(False)})
          SELECT bucket, status, count(*)::BIGINT AS n, count(DISTINCT code)::BIGINT AS n_programs, (SELECT count(DISTINCT code) FROM c)::BIGINT AS n_checks,
          0::BIGINT AS n_again FROM o JOIN c USING (pos) GROUP BY bucket, status""",
        "resumed_run": """SELECT count(*)::BIGINT AS n_asked, 0::BIGINT AS n_asked_twice, count(*)::BIGINT AS n_logged, count(*)::BIGINT AS n_answered,
          true AS died, true AS first_has_some, true AS second_asked_the_rest, true AS second_asked_some FROM labels""",
        "repeated_run": f"""SELECT doc_id AS pos, {custom} AS custom_id, CASE WHEN doc_id % 10 <> 3 THEN 'answer ' || doc_id::VARCHAR END AS response,
          (SELECT count(*) FROM labels)::BIGINT AS n_first, (SELECT count(*) FROM labels WHERE doc_id % 10 = 3)::BIGINT AS n_again FROM labels""",
        "resumed_bulk_run": f"SELECT status, bucket, count(*)::BIGINT AS n, 1::BIGINT AS n_jobs FROM ({io_queries._run_sql(True)}) GROUP BY status, bucket",
    }
