"""Queries of the operators that write, read, call or wait: each writes its files to a folder of its own and gives what is read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import curate, keys, outcome, requests
from ..sources import files, jsonscan, readers, writers
from ..sources.scratch import new_path
from ..streaming import landing
from . import external, runs, verdicts

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hosted_dataset(spark, sf_dir):
    root = new_path(spark, "hosted")
    _t(spark, sf_dir, "labels").write.parquet(f"{root}/main/train")
    return readers.hosted_dataset(spark, root, "train", "main")


def _documents_of_labels(spark, sf_dir) -> DataFrame:
    """(pos, record): problems as JSON objects, in which keys are missing or null by doc_id."""
    d = _t(spark, sf_dir, "labels")
    key = F.when(F.col("doc_id") % 3 != 0, F.format_string('"problem_id": "d%d", ', "doc_id")).otherwise("")
    problem = F.when(F.col("doc_id") % 4 == 0, F.lit('"problem": null')).otherwise(F.format_string('"problem": "q%d"', F.coalesce("quality", F.lit(-1))))
    solution = F.when(F.col("toxic") == 1, F.lit(', "solution": "s"')).otherwise("")
    meta = F.when(F.col("doc_id") % 2 == 1, F.format_string(', "metadata": {"k": [%d]}', "doc_id")).otherwise("")
    return d.select(F.col("doc_id").alias("pos"), F.concat(F.lit("{"), key, problem, solution, meta, F.lit("}")).alias("record"))


def problem_document(spark, sf_dir):
    """A JSON document in parts, written record by record and scanned by many tasks: positions, defaults of missing keys, nulls that stay."""
    path = new_path(spark, "document")
    rows = _documents_of_labels(spark, sf_dir)
    writers.write_lines(writers.array_lines(rows, "pos", F.col("record")), path)
    got = readers.problems_json(spark, path, parts=True)
    return got.select("pos", "problem_id", "problem", "solution", F.to_json("metadata").alias("metadata"))


def problem_lines(spark, sf_dir):
    path = new_path(spark, "lines")
    _documents_of_labels(spark, sf_dir).select("record").write.text(path)
    return readers.problems_lines(spark, path).select("problem_id", "problem", "solution", F.to_json("metadata").alias("metadata"))


def problems_with_defaults(spark, sf_dir):
    """A table that lacks columns, with ids that are null."""
    d = _t(spark, sf_dir, "labels").select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("d"), "doc_id")).alias("problem_id"))
    return readers.problems_table(d, "doc_id").select("pos", "problem_id", "problem", "solution", F.to_json("metadata").alias("metadata"))


def tasks_of(df: DataFrame, least: int) -> int:
    """How many tasks read df, which grows with its files; ``least`` at least."""
    return max(least, df.rdd.getNumPartitions())


def _response_file(spark, sf_dir, broken: bool = False) -> str:
    """Bulk output of documents: lines in the order of doc_id, one for most, a second one for some, some failed; or some that can't be read."""
    path = new_path(spark, "responses")
    d = _t(spark, sf_dir, "documents")
    n_files = tasks_of(d, 8)
    d = d.where("doc_id % 7 <> 0").select("doc_id", "text")
    d = d.withColumn("n", F.explode(F.when(F.col("doc_id") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    code = F.when((F.col("doc_id") + F.col("n")) % 11 == 0, 500).otherwise(200)
    content = F.when(F.col("n") == 1, F.lit("again")).otherwise(F.concat(F.lit("```lean\n-- [STEP_1: x]\n"), "text", F.lit("\n-- [END_STEP_1]\n```")))
    body = F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices"))
    line = F.to_json(F.struct(F.col("doc_id").cast("string").alias("custom_id"), F.struct(code.alias("status_code"), body.alias("body")).alias("response")))
    if broken:
        line = F.when(F.col("doc_id") % 13 == 0, F.concat(F.lit("{"), F.col("doc_id"))).when(F.col("doc_id") % 13 == 1, F.concat(F.lit('{"custom_id":"'), "doc_id", F.lit('","response":null}'))).otherwise(line)
    d.repartitionByRange(n_files, "doc_id", "n").sortWithinPartitions("doc_id", "n").select(line.alias("value")).write.text(path)
    return path


def response_lines_read(spark, sf_dir):
    """Bulk output scanned, decoded and its last line of each id taken."""
    return keys.response_map(readers.responses(spark, _response_file(spark, sf_dir)))


def response_lines_bad(spark, sf_dir):
    return readers.bad_responses(spark, _response_file(spark, sf_dir, broken=True)).select("line")


def raw_output(spark, sf_dir):
    """The raw copy of bulk output, line by line."""
    kept = writers.keep_raw(spark, _response_file(spark, sf_dir), new_path(spark, "raw"))
    return spark.read.text(kept).select(F.get_json_object("value", "$.custom_id").alias("custom_id"), F.get_json_object("value", "$.response.status_code").cast("int").alias("status_code"), F.md5("value").alias("md5")).groupBy("custom_id").agg(F.count("*").alias("n_lines"), F.count_distinct("md5").alias("n_distinct"), F.max("status_code").alias("worst"))


def system_prompt(spark, sf_dir):
    """A prompt file's text in every request, and the default without a file."""
    path = new_path(spark, "prompt")
    spark.createDataFrame([("Be brief.\n  Twice.",)], "value string").coalesce(1).write.text(path)
    given, default = readers.system_prompt(spark, path), readers.system_prompt(spark)
    return _t(spark, sf_dir, "labels").select("doc_id", F.lit(given).alias("given"), F.lit(bool(default)).alias("has_default"))


def code_source(spark, sf_dir):
    """Code of files and the same code inline, as programs: a file for each row of labels."""
    path = new_path(spark, "code")
    code = F.concat(F.lit("theorem t"), "doc_id", F.lit(" : 1 = 1 := rfl\n\n"))
    rows = _t(spark, sf_dir, "labels").where("doc_id is not null").select(F.col("doc_id").cast("string").alias("stem"), code.alias("text"))
    files.write_text_files(rows.select("stem", F.concat("stem", F.lit(".lean")).alias("name"), "text"), path, 4)
    program = lambda kind, d: d.select(F.lit(kind).alias("kind"), T.check_program("code", ["t"]).alias("program"))
    return program("file", readers.code(spark, file=f"{path}/part-*")).unionByName(program("inline", rows.withColumnRenamed("text", "code")))


def json_array_export(spark, sf_dir, pretty=False):
    """Scored rows as one JSON array, written in parts that are read as one document."""
    path = new_path(spark, "array")
    d = runs.export_scored(_t(spark, sf_dir, "labels").withColumn("pos", F.col("doc_id")), score="quality")
    writers.write_json_document(d, path, "pos", pretty)
    rows = jsonscan.json_records(spark, path, parts=True)
    return rows.select(F.from_json("record", "doc_id long, quality int, toxic int", {"mode": "FAILFAST"}).alias("j")).select("j.*")


def json_pretty_export(spark, sf_dir):
    return json_array_export(spark, sf_dir, True)


def request_file(spark, sf_dir):
    """Request lines as a file, read back in its order."""
    path = new_path(spark, "requests")
    d = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), F.col("source").alias("problem_id"), F.col("text").alias("problem"), F.lit("").alias("solution"))
    writers.request_lines(requests.envelope(requests.requests(d, "Be brief."), "m", "low"), path)
    row = F.from_json("value", "custom_id string, method string, body struct<model: string, messages: array<struct<role: string, content: string>>, reasoning_effort: string>")
    lines = spark.read.text(path).select(row.alias("r"))
    return lines.select("r.custom_id", "r.method", "r.body.model", F.col("r.body.messages")[0]["content"].alias("system"), F.col("r.body.messages")[1]["content"].alias("user"), F.col("r.body.reasoning_effort").alias("effort"))


def batch_information(spark, sf_dir):
    path = new_path(spark, "batch-info")
    writers.write_one(writers.batch_info(spark, "b1", "in.jsonl", "2026-01-01T00:00:00", _t(spark, sf_dir, "labels").count()), path)
    return spark.read.schema("batch_id string, input_file string, created_at string, problem_count long").json(path)


def _check(code: str) -> tuple[bool, str]:
    return len(code) % 2 == 0, ""


def _answer(system: str, user: str) -> str | None:
    if len(user) % 5 == 0:
        return None
    mark = "-- [STEP_1: x]\n-- [END_STEP_1]\n" if len(user) % 3 else ""
    return f"```lean\n{mark}{user[-(len(user) % 2):]}\n```"


def _problems(spark, sf_dir) -> DataFrame:
    d = _t(spark, sf_dir, "labels")
    return d.select(F.col("doc_id").alias("pos"), F.concat(F.lit("p"), F.col("doc_id") % 500).alias("problem_id"), F.concat(F.when(F.col("doc_id") % 9 == 0, F.lit("construct ")).otherwise(F.lit("show ")), F.repeat(F.lit("x"), (F.col("doc_id") % 17).cast("int"))).alias("problem"), F.lit("").alias("solution"))


def sync_run(spark, sf_dir):
    """A whole run of one call for each row, from its log."""
    out = new_path(spark, "sync")
    log = runs.run_sync(_problems(spark, sf_dir), "S", _answer, _check, out, model="m", run_id="r1")
    return log.select("pos", "problem_id", "custom_id", "status", "error", "bucket", F.col("parsability.step_count").alias("steps"), F.col("api_call.model").alias("model"), (F.col("total_duration_seconds") >= 0).alias("timed"))


def sync_run_calls(spark, sf_dir):
    """How often a run calls its generator and validator, counted as they are called."""
    calls, checks = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def call(system: str, user: str) -> str | None:
        calls.add(1)
        return _answer(system, user)

    def check(code: str) -> tuple[bool, str]:
        checks.add(1)
        return _check(code)

    log = runs.run_sync(_problems(spark, sf_dir), "S", call, check, new_path(spark, "calls"))
    return log.agg(F.count("*").alias("n_rows"), F.count_distinct("pos").alias("n_problems")).withColumns({"n_calls": F.lit(calls.value).cast("long"), "n_checks": F.lit(checks.value).cast("long")})


class BulkService:
    """A bulk service of the driver's own: answers the request lines by the same rule as _answer()."""

    def __init__(self, spark: SparkSession, looks: int = 2):
        self.spark, self.looks, self.path = spark, looks, ""

    def submit(self, path: str) -> str:
        self.path = path
        return "job-1"

    def status(self, job: str) -> dict:
        self.looks -= 1
        if self.looks == 0:
            raise ConnectionError("not now")
        return {"status": "completed" if self.looks < 0 else "in_progress", "request_counts": {"total": 4, "completed": 4 if self.looks < 0 else 1}}

    def results(self, job: str) -> str:
        out = new_path(self.spark, "bulk-output")
        user = F.get_json_object("value", "$.body.messages[1].content")
        n = F.length(user)
        mark = F.when(n % 3 != 0, F.lit("-- [STEP_1: x]\n-- [END_STEP_1]\n")).otherwise(F.lit(""))
        text = F.when(n % 5 != 0, F.concat(F.lit("```lean\n"), mark, F.when(n % 2 == 0, user).otherwise(F.right(user, F.lit(1))), F.lit("\n```")))
        body = F.struct(F.array(F.struct(F.struct(text.alias("content")).alias("message"))).alias("choices"))
        line = F.struct(F.get_json_object("value", "$.custom_id").alias("custom_id"), F.struct(F.lit(200).alias("status_code"), body.alias("body")).alias("response"))
        self.spark.read.text(self.path).select(F.to_json(line)).write.text(out)
        return out


def bulk_run(spark, sf_dir):
    """A whole bulk run: requests, waiting, raw output, outcomes."""
    log = runs.run_batch(_problems(spark, sf_dir), "S", BulkService(spark), _check, new_path(spark, "bulk"), "m", run_id="r1", interval=0.0, most=1.0, sleep=lambda s: None)
    return log.select("pos", "problem_id", "custom_id", "status", "error", "bucket", F.col("parsability.step_count").alias("steps"), F.col("timestamp").isNotNull().alias("timed"))


def polled_states(spark, sf_dir):
    """What waiting for jobs ends with, from the looks at them, some of which failed, and the progress of the last look."""
    d = _t(spark, sf_dir, "events").where("event_id is not null")
    said = F.element_at(F.array(*map(F.lit, ("validating", "in_progress", "in_progress", "in_progress", "finalizing", "in_progress", "in_progress", "completed", "failed", "expired", "cancelled"))), (F.col("event_id") * 7 % 11 + 1).cast("int"))
    looks = d.select(F.floor(F.col("event_id") / 9).alias("job"), (F.col("event_id") % 9).alias("look"), F.when(F.col("event_id") % 5 != 0, said).alias("status"), (F.col("event_id") % 4).alias("completed"), F.lit(4).cast("long").alias("total"))
    return runs.settled_jobs(looks, 60, 360)


def terminal_states(spark, sf_dir):
    d = _t(spark, sf_dir, "events")
    said = F.element_at(F.array(*map(F.lit, ("validating", "in_progress", "completed", "failed", "cancelled", "expired"))), (F.col("event_id") % 6 + 1).cast("int"))
    return d.select("event_id", runs.is_terminal(said).alias("terminal"))


def _log(spark, sf_dir) -> DataFrame:
    d = _problems(spark, sf_dir).withColumn("skip_reason", curate.skip_reason("problem")).withColumn("response", F.when(F.col("pos") % 4 != 0, F.lit("r")))
    done = F.when(F.col("response").isNotNull(), F.struct((F.col("pos") % 5 != 0).alias("success"), F.lit(0.5).alias("duration_seconds"), F.lit("").alias("output")))
    d = d.withColumn("compilation", done).withColumn("parsability", F.struct((F.col("pos") % 7 != 0).alias("is_parsable"), (F.col("pos") % 7).cast("long").alias("step_count")))
    return outcome.classify(d.withColumn("generated_code", F.when(F.col("pos") % 2 == 0, F.concat(F.lit("code "), F.col("pos"))).otherwise(F.lit(""))))


def logs_by_run(spark, sf_dir):
    """Two runs' logs, one of them written twice, and the last row of each problem in one of them."""
    path = new_path(spark, "logs")
    log = _log(spark, sf_dir)
    writers.problem_logs(log, path, "a")
    writers.problem_logs(log.where("pos % 2 = 0"), path, "b")
    writers.problem_logs(log, path, "a")
    got = spark.read.parquet(path).where("run_id = 'a'")
    return keys.last_writer_wins(got.select("pos", "problem_id", "status"))


def code_table(spark, sf_dir):
    path = new_path(spark, "code-table")
    writers.code_files(_log(spark, sf_dir), path)
    return spark.read.parquet(path)


def exported_files(spark, sf_dir):
    """A file of the log, and one of the code where there is some, for each problem; by name and content."""
    path = new_path(spark, "files")
    writers.export_files(_log(spark, sf_dir), path)
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value")
    return files.select("name", F.when(F.endswith("name", F.lit(".lean")), F.col("value")).otherwise(F.get_json_object("value", "$.status")).alias("content"))


def summary_file(spark, sf_dir):
    """The run summary and its manifest, written and read back."""
    path = new_path(spark, "summary")
    runs.write_summary(_log(spark, sf_dir), path, model="m", max_problems=None, batch_mode=False)
    s = spark.read.schema("model string, max_problems long, batch_mode boolean, stats struct<total: long, successful: long, skipped: long, failed_compilation: long, failed_parsable: long, failed_api: long>").json(f"{path}/run_summary")
    files = spark.read.schema("pos long, problem_id string, status string, file string").json(f"{path}/problem_files")
    n = files.agg(F.count("*").alias("n_files"), F.count_if(F.col("status") == "skipped").alias("n_skipped"))
    return s.join(F.broadcast(n)).select("model", "max_problems", "batch_mode", "stats.*", "n_files", "n_skipped")


def manifest_in_order(spark, sf_dir):
    """The manifest by place."""
    d = outcome.manifest_in_order(_log(spark, sf_dir))
    return d.select(F.col("place").cast("int").alias("place"), "problem_id", "status", "file")


def retrieved_tables(spark, sf_dir):
    """Bulk output retrieved without its problems: responses, code and verdicts by request."""
    out = new_path(spark, "retrieved")
    runs.retrieve_to(spark, _response_file(spark, sf_dir), out, _check)
    r, c, v = (spark.read.parquet(f"{out}/{x}") for x in ("responses", "code", "validation"))
    d = r.join(c, "custom_id", "left").join(v, "custom_id")
    return d.select("custom_id", F.length("response").cast("long").alias("n_response"), F.length("code").cast("long").alias("n_code"), F.col("compilation.success").alias("success"), F.col("parsability.is_parsable").alias("is_parsable"), F.col("parsability.step_count").alias("step_count"))


def landed_responses(spark, sf_dir):
    """Bulk output taken in as a stream, twice: no line comes in again."""
    src, path = _response_file(spark, sf_dir), new_path(spark, "landed")
    for _ in range(2):
        landing.land(spark, src, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    d = landing.landed(spark, f"{path}/out")
    return d.groupBy("custom_id").agg(F.count("*").alias("n_lines"), F.count_if(F.col("response").isNotNull()).alias("n_answers"), F.max("parsability.step_count").alias("step_count"))


def unscored_rows(spark, sf_dir):
    """A table without a score is not filtered."""
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return curate.score_filter(_t(spark, sf_dir, "labels"))


#: Texts in front of which the documents of skip_geometry() stand, by doc_id: each rule, in other letters, two at once, counts at the limits.
STARTS = ("Let O be the CIRCUMCENTER. ", "the orthocenter of an incircle ", "Incircle ", "an EXCIRCLE ", "the Simson line ", "Nine-Point Circle ", "reconstruct ", "Draw a line ", "take points ", "point " * 8, "point " * 9, "line " * 6, "collinear " * 7, "POINT " * 4 + "points " * 5, "", "simson  line ")


def _with_start(d: DataFrame) -> F.Column:
    return F.concat(F.element_at(F.array(*map(F.lit, STARTS)), (F.col("doc_id") % len(STARTS) + 1).cast("int")), F.coalesce("text", F.lit("")))


def skip_geometry(spark, sf_dir):
    """The nine rules and the two counts."""
    d = _t(spark, sf_dir, "documents")
    return curate.skip_classify(d.withColumn("problem", _with_start(d))).select("doc_id", "skipped", "skip_reason")


def skip_nothing(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return curate.skip_classify(d.withColumn("problem", _with_start(d)), enabled=False).select("doc_id", "skipped", "skip_reason")


def preview_rows(spark, sf_dir):
    return curate.preview(_t(spark, sf_dir, "labels").orderBy("doc_id"))


def checked_ids(spark, sf_dir):
    """Ids that are checked to be unique."""
    d = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), "source")
    ids = keys.unique_request_id(keys.default_id(d, "source"), "source")
    return keys.assert_unique(ids).select("pos", "custom_id")


def times(spark, sf_dir):
    """Timestamps as run ids, and seconds between two of them."""
    d = _t(spark, sf_dir, "events")
    end = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") * 1_250_000)
    return d.select("event_id", T.run_id("ts").alias("run_id"), T.elapsed_seconds("ts", end).alias("seconds"))


def percentages(spark, sf_dir):
    d = _t(spark, sf_dir, "labels").groupBy("toxic").agg(F.count_if(F.col("quality") == 1).alias("part"), F.count("*").alias("total"))
    return d.select("toxic", T.percentage("part", "total").alias("percent"), T.percentage("part", F.lit(0)).alias("of_nothing"))


def project_checks(spark, sf_dir):
    """Builds of the programs of labels as projects of their own, with a stand-in for the build; each distinct program is built once."""
    build = external.ProjectCheck(build=("sh", "-c", "grep -q bad Main.lean && exit 2; grep -q 'lean_exe' lakefile.lean && cat Main.lean"))

    def check(code: str) -> tuple[bool, str]:
        status, said, _ = build(code)
        return status == 0, said

    d = _t(spark, sf_dir, "labels")
    kind = F.when(F.col("toxic") == 1, F.lit("bad")).otherwise(F.concat(F.lit("theorem q"), F.coalesce("quality", F.lit(-1)), F.lit(" : True := trivial")))
    d = d.select("doc_id", F.lit("r").alias("response"), kind.alias("generated_code"))
    got = verdicts.validate_once(d, check, new_path(spark, "builds"), "stand-in")
    return got.select("doc_id", F.col("compilation.success").alias("success"), F.md5("compilation.output").alias("md5"))


_OWN = (hosted_dataset, problem_document, problem_lines, problems_with_defaults, response_lines_read, response_lines_bad, raw_output, system_prompt, code_source, json_array_export, json_pretty_export, request_file, batch_information, sync_run, sync_run_calls, bulk_run, polled_states, terminal_states, logs_by_run, code_table, exported_files, summary_file, manifest_in_order, retrieved_tables, landed_responses, unscored_rows, skip_geometry, skip_nothing, preview_rows, checked_ids, times, percentages, project_checks)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _OWN}


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_FIELDS = """CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'q' || coalesce(quality, -1)::VARCHAR END AS problem"""
_R = """l AS (SELECT doc_id, n, doc_id::VARCHAR AS custom_id, CASE WHEN (doc_id + n) % 11 = 0 THEN 500 ELSE 200 END AS code,
  CASE WHEN n = 1 THEN 'again' ELSE '```lean' || chr(10) || '-- [STEP_1: x]' || chr(10) || text || chr(10) || '-- [END_STEP_1]' || chr(10) || '```' END AS content
  FROM (SELECT doc_id, text, unnest(CASE WHEN doc_id % 5 = 0 THEN [0, 1] ELSE [0] END) AS n FROM documents WHERE doc_id % 7 <> 0)),
m AS (SELECT custom_id, CASE WHEN code = 200 THEN content END AS content FROM l QUALIFY row_number() OVER (PARTITION BY custom_id ORDER BY n DESC) = 1)"""
_P = """p AS (SELECT doc_id AS pos, 'p' || (doc_id % 500)::VARCHAR AS problem_id, CASE WHEN doc_id % 9 = 0 THEN 'construct ' ELSE 'show ' END || repeat('x', (doc_id % 17)::INT) AS problem FROM labels)"""


def _run_sql(batch: bool) -> str:
    """Outcomes of sync_run() or bulk_run() by the rule of _answer()."""
    error = "No response from batch API" if batch else "No response from API"
    steps = "CASE WHEN NOT skipped AND r IS NOT NULL THEN steps END" if batch else "CASE WHEN NOT skipped AND r IS NOT NULL AND ok THEN steps END"
    return f"""WITH {_P}, k AS (SELECT *, contains(problem, 'construct') AS skipped, 'Problem:' || chr(10) || problem || chr(10) || chr(10) || {_lit(T.ASK)} AS u FROM p),
u AS (SELECT pos, problem_id || CASE WHEN row_number() OVER (PARTITION BY problem_id ORDER BY pos) = 1 THEN '' ELSE '_' || (row_number() OVER (PARTITION BY problem_id ORDER BY pos) - 1)::VARCHAR END AS custom_id FROM k WHERE NOT skipped),
r AS (SELECT k.*, custom_id, CASE WHEN length(u) % 5 <> 0 THEN CASE WHEN length(u) % 3 <> 0 THEN '-- [STEP_1: x]' || chr(10) || '-- [END_STEP_1]' || chr(10) ELSE '' END || CASE WHEN length(u) % 2 = 0 THEN u ELSE right(u, 1) END END AS r FROM k LEFT JOIN u USING (pos)),
o AS (SELECT *, length(r) % 2 = 0 AS ok, CASE WHEN length(u) % 3 <> 0 THEN 1 ELSE 0 END::BIGINT AS steps FROM r)
SELECT pos, problem_id, custom_id, CASE WHEN skipped THEN 'skipped' WHEN r IS NULL OR NOT ok OR steps = 0 THEN 'failed' ELSE 'success' END AS status,
 CASE WHEN skipped THEN NULL WHEN r IS NULL THEN '{error}' WHEN NOT ok THEN 'Compilation failed' WHEN steps = 0 THEN 'Not parsable' END AS error,
 CASE WHEN skipped THEN 'skipped' WHEN r IS NULL THEN 'failed_api' WHEN NOT ok THEN 'failed_compilation' WHEN steps = 0 THEN 'failed_parsable' ELSE 'successful' END AS bucket,
 {steps} AS steps, true AS timed{"" if batch else ", CASE WHEN NOT skipped THEN 'm' END AS model"} FROM o"""


_LOG = f"""{_P}, o AS (SELECT *, CASE WHEN contains(problem, 'construct') THEN 'skipped' WHEN pos % 4 = 0 OR pos % 5 = 0 OR pos % 7 = 0 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN contains(problem, 'construct') THEN 'skipped' WHEN pos % 4 = 0 THEN 'failed_api' WHEN pos % 5 = 0 THEN 'failed_compilation' WHEN pos % 7 = 0 THEN 'failed_parsable' ELSE 'successful' END AS bucket,
  CASE WHEN pos % 2 = 0 THEN 'code ' || pos::VARCHAR ELSE '' END AS code FROM p),
w AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY problem_id ORDER BY pos DESC) = 1)"""
_RULES = " ".join(f"WHEN contains(t, '{word}') THEN '{reason}'" for word, reason in curate.GEOMETRY.keywords)
_MANY = " OR ".join(f"(length(t) - length(replace(t, '{word}', ''))) // {len(word)} > {most}" for word, most in curate.GEOMETRY.counts)
_GEOMETRY = f"CASE {_RULES} WHEN {_MANY} THEN '{curate.GEOMETRY.counts_reason}' END"
_START = "CASE doc_id % " + str(len(STARTS)) + " " + " ".join(f"WHEN {k} THEN {_lit(x)}" for k, x in enumerate(STARTS)) + " END"


def oracle_sql() -> dict[str, str]:
    user = f"'Problem:' || chr(10) || text || chr(10) || chr(10) || {_lit(T.ASK)}"
    unique = "source || CASE WHEN row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1 THEN '' ELSE '_' || (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1)::VARCHAR END"
    stats = "count(*)::BIGINT AS total, " + ", ".join(f"count(*) FILTER (WHERE bucket = '{b}')::BIGINT AS {b}" for b in ("successful", "skipped", "failed_compilation", "failed_parsable", "failed_api"))
    return {
        "hosted_dataset": "SELECT * FROM labels",
        "problem_document": f"SELECT pos, CASE WHEN doc_id % 3 <> 0 THEN 'd' || doc_id::VARCHAR ELSE 'problem_' || pos::VARCHAR END AS problem_id, {_FIELDS}, CASE WHEN toxic = 1 THEN 's' ELSE '' END AS solution, CASE WHEN doc_id % 2 = 1 THEN '{{\"k\":[' || doc_id::VARCHAR || ']}}' ELSE '{{}}' END AS metadata FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS pos FROM labels)",
        "problem_lines": f"SELECT CASE WHEN doc_id % 3 <> 0 THEN 'd' || doc_id::VARCHAR END AS problem_id, {_FIELDS}, CASE WHEN toxic = 1 THEN 's' END AS solution, CASE WHEN doc_id % 2 = 1 THEN '{{\"k\":[' || doc_id::VARCHAR || ']}}' END AS metadata FROM labels",
        "problems_with_defaults": "SELECT doc_id AS pos, CASE WHEN doc_id % 3 <> 0 THEN 'd' ELSE 'problem_' END || doc_id::VARCHAR AS problem_id, '' AS problem, '' AS solution, '{}' AS metadata FROM labels",
        "response_lines_read": f"WITH {_R} SELECT * FROM m",
        "response_lines_bad": "SELECT unnest(CASE WHEN doc_id % 5 = 0 THEN [x, x] ELSE [x] END) AS line FROM (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN '{' || doc_id::VARCHAR ELSE '{\"custom_id\":\"' || doc_id::VARCHAR || '\",\"response\":null}' END AS x FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 13 < 2)",
        "raw_output": f"WITH {_R} SELECT custom_id, count(*)::BIGINT AS n_lines, count(*)::BIGINT AS n_distinct, max(code)::INT AS worst FROM l GROUP BY custom_id",
        "system_prompt": f"SELECT doc_id, {_lit('Be brief.' + chr(10) + '  Twice.' + chr(10))} AS given, true AS has_default FROM labels",
        "code_source": f"SELECT kind, 'set_option warningAsError true' || chr(10) || 'theorem t' || doc_id::VARCHAR || ' : 1 = 1 := rfl' || chr(10) || '#print axioms t' || chr(10) AS program FROM labels, (VALUES ('file'), ('inline')) k(kind) WHERE doc_id IS NOT NULL",
        "json_array_export": "SELECT * FROM labels WHERE quality = 1",
        "json_pretty_export": "SELECT * FROM labels WHERE quality = 1",
        "request_file": f"SELECT {unique} AS custom_id, 'POST' AS method, 'm' AS model, 'Be brief.' AS system, {user} AS \"user\", 'low' AS effort FROM documents",
        "batch_information": "SELECT 'b1' AS batch_id, 'in.jsonl' AS input_file, '2026-01-01T00:00:00' AS created_at, count(*)::BIGINT AS problem_count FROM labels",
        "sync_run": _run_sql(False),
        "sync_run_calls": f"WITH {_P}, k AS (SELECT *, length('Problem:' || chr(10) || problem || chr(10) || chr(10) || {_lit(T.ASK)}) AS n FROM p) SELECT count(*)::BIGINT AS n_rows, count(*)::BIGINT AS n_problems, count(*) FILTER (WHERE NOT contains(problem, 'construct'))::BIGINT AS n_calls, count(*) FILTER (WHERE NOT contains(problem, 'construct') AND n % 5 <> 0)::BIGINT AS n_checks FROM k",
        "bulk_run": _run_sql(True),
        "polled_states": """WITH k AS (SELECT event_id // 9 AS job, event_id % 9 AS look, CASE WHEN event_id % 5 <> 0 THEN ['validating', 'in_progress', 'in_progress', 'in_progress', 'finalizing', 'in_progress', 'in_progress', 'completed', 'failed', 'expired', 'cancelled'][(event_id * 7 % 11) + 1] END AS status, event_id % 4 AS completed FROM events WHERE event_id IS NOT NULL),
n AS (SELECT job, row_number() OVER (PARTITION BY job ORDER BY look) AS i, status, completed FROM k),
w AS (SELECT * FROM n WHERE i <= 6), f AS (SELECT job, min(i) FILTER (WHERE status IN ('completed', 'failed', 'cancelled', 'expired')) AS i, max(i) AS most FROM w GROUP BY job)
SELECT f.job, coalesce(CASE WHEN f.i IS NOT NULL THEN w.status END, 'timeout') AS status, coalesce(f.i, f.most)::BIGINT AS looks, CASE WHEN f.i IS NULL THEN NULL ELSE w.completed::VARCHAR || '/4 (' || printf('%.1f', w.completed * 25.0::DOUBLE) || '%)' END AS progress FROM f LEFT JOIN w ON w.job = f.job AND w.i = f.i""",
        "terminal_states": "SELECT event_id, event_id % 6 >= 2 AS terminal FROM events",
        "logs_by_run": f"WITH {_LOG} SELECT pos, problem_id, status FROM w",
        "code_table": f"WITH {_LOG} SELECT problem_id, code FROM w WHERE code <> ''",
        "exported_files": f"WITH {_LOG} SELECT problem_id || '.json' AS name, status AS content FROM w UNION ALL SELECT problem_id || '.lean', code FROM w WHERE code <> ''",
        "summary_file": f"WITH {_LOG} SELECT 'm' AS model, NULL::BIGINT AS max_problems, false AS batch_mode, {stats}, count(*)::BIGINT AS n_files, count(*) FILTER (WHERE bucket = 'skipped')::BIGINT AS n_skipped FROM o",
        "manifest_in_order": f"WITH {_LOG} SELECT (row_number() OVER (ORDER BY pos) - 1)::INT AS place, problem_id, status, problem_id || '.json' AS file FROM o",
        "retrieved_tables": f"WITH {_R}, c AS (SELECT custom_id, content, CASE WHEN content = 'again' THEN content ELSE regexp_replace(regexp_extract(content, '(?s)```lean\\n(.*?)```', 1), '\\A\\s+|\\s+\\z', '', 'g') END AS code FROM m WHERE length(content) > 0) SELECT custom_id, length(content)::BIGINT AS n_response, length(code)::BIGINT AS n_code, length(code) % 2 = 0 AS success, content <> 'again' AS is_parsable, CASE WHEN content = 'again' THEN 0 ELSE 1 END::BIGINT AS step_count FROM c",
        "landed_responses": f"WITH {_R} SELECT custom_id, 1::BIGINT AS n_lines, count(content)::BIGINT AS n_answers, max(CASE WHEN content <> 'again' THEN 1 ELSE 0 END)::BIGINT AS step_count FROM m GROUP BY custom_id",
        "unscored_rows": "SELECT * FROM labels",
        "skip_geometry": f"SELECT doc_id, r IS NOT NULL AS skipped, r AS skip_reason FROM (SELECT doc_id, {_GEOMETRY} AS r FROM (SELECT doc_id, lower({_START} || coalesce(text, '')) AS t FROM documents))",
        "skip_nothing": "SELECT doc_id, false AS skipped, NULL::VARCHAR AS skip_reason FROM documents",
        "preview_rows": "SELECT * FROM labels ORDER BY doc_id LIMIT 5",
        "checked_ids": f"SELECT doc_id AS pos, {unique} AS custom_id FROM documents",
        "times": "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_id, round((event_id * 1250000)::DOUBLE / 1000000, 2) AS seconds FROM events",
        "percentages": "SELECT toxic, round(count(*) FILTER (WHERE quality = 1) * 100.0::DOUBLE / count(*), 1) AS percent, 0.0::DOUBLE AS of_nothing FROM labels GROUP BY toxic",
        "project_checks": "SELECT doc_id, coalesce(toxic, 0) <> 1 AS success, md5(CASE WHEN toxic = 1 THEN '' ELSE 'theorem q' || coalesce(quality, -1)::VARCHAR || ' : True := trivial' END) AS md5 FROM labels",
    }
