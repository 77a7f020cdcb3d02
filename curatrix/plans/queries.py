"""A query for each operator of the engine on the driver's tables, and the same in another engine's SQL.

The tables hold no answers of a generator, so these are made from each document's text, in six forms by doc_id.
"""

from __future__ import annotations


from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import curate, keys, outcome, requests
from ..sources import readers, writers
from ..sources.scratch import new_path
from . import external, io_queries, run_queries, scan_queries

Query = Callable[[SparkSession, str], DataFrame]
RULES = curate.SkipRules((("license", "license text"), ("password", "secret")), (("tion", 8),), "too many endings")
FORMS = (
    ("Answer:\n```lean\n-- [STEP_1: x]\n", "\n-- [END_STEP_1]\n```\nDone."),
    ("```\n-- [STEP_1: x]\n", "\n```"),
    ("-- [STEP_1: x]\n-- [STEP_2: y]\n", "\n-- [END_STEP_1]"),
    ("```lean\n```", ""),
    ("```python\nx = 1\n```\n", "\n```\n"),
    ("", ""),
)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def synthetic_response() -> Column:
    out = F.when(F.col("doc_id") % 6 == 0, F.concat(F.lit(FORMS[0][0]), F.col("text"), F.lit(FORMS[0][1])))
    for k, (a, b) in enumerate(FORMS[1:], 1):
        out = out.when(F.col("doc_id") % 6 == k, F.concat(F.lit(a), F.col("text"), F.lit(b)))
    return out


def problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, problem_id, problem, solution): documents as problems, their source as id."""
    return _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), F.col("source").alias("problem_id"), F.col("text").alias("problem"), F.lit("").alias("solution"), "doc_id", "text")


def response_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, custom_id, response{status_code, body}): a line for each document, none for every 7th, failed for every 11th, a second one for every 5th."""
    d = _t(spark, sf_dir, "documents").where("doc_id % 7 <> 0")
    body = lambda c: F.struct(F.array(F.struct(F.struct(c.alias("content")).alias("message"))).alias("choices"))
    one = d.select((F.col("doc_id") * 2).alias("line_no"), F.col("doc_id").cast("string").alias("custom_id"), F.struct(F.when(F.col("doc_id") % 11 == 0, 500).otherwise(200).alias("status_code"), body(synthetic_response()).alias("body")).alias("response"))
    two = d.where("doc_id % 5 = 0").select((F.col("doc_id") * 2 + 1).alias("line_no"), F.col("doc_id").cast("string").alias("custom_id"), F.struct(F.when(F.col("doc_id") % 3 == 0, 500).otherwise(200).alias("status_code"), body(F.lit("again")).alias("body")).alias("response"))
    return one.unionByName(two)


def native_check(code: Column) -> Column:
    """A stand-in for the external validator: code compiles if it has an even number of characters."""
    n = F.length(code)
    return F.struct((n % 2 == 0).alias("success"), F.lit(None).cast("double").alias("duration_seconds"), F.lit("").alias("output"))


def outcomes(spark: SparkSession, sf_dir: str, batch: bool) -> DataFrame:
    d = curate.skip_classify(problems(spark, sf_dir), "problem", RULES)
    d = d.withColumn("response", F.when(F.col("pos") % 7 != 0, synthetic_response()))
    d = d.withColumn("generated_code", T.extract_code("response"))
    d = d.withColumn("compilation", native_check(F.col("generated_code"))).withColumn("parsability", T.step_check("generated_code"))
    return outcome.classify(d, batch)


def score_filter_scalar(spark, sf_dir):
    return curate.score_filter(_t(spark, sf_dir, "labels"), "quality")


def score_filter_array(spark, sf_dir):
    d = _t(spark, sf_dir, "labels")
    both = F.array(F.col("quality"), 1 - F.col("toxic"))
    score = F.when(F.col("doc_id") % 5 == 0, F.array().cast("array<int>")).when(F.col("doc_id") % 5 == 1, F.lit(None).cast("array<int>")).otherwise(both)
    return curate.score_filter(d.withColumn("score", score)).select("doc_id", "quality", "toxic")


def filter_then_limit(spark, sf_dir):
    return curate.limit_after_filter(curate.score_filter(_t(spark, sf_dir, "labels"), "quality"), 100, "doc_id")


def limit_then_filter(spark, sf_dir):
    return curate.score_filter(curate.limit_before_filter(_t(spark, sf_dir, "labels"), 100, "doc_id"), "quality")


def skip_classify(spark, sf_dir):
    return curate.skip_classify(_t(spark, sf_dir, "documents"), "text", RULES).select("doc_id", "skipped", "skip_reason")


def render_prompt(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("doc_id", T.render_prompt("text", F.when(F.col("quality").isNotNull(), F.concat(F.lit("quality "), F.col("quality").cast("string")))).alias("prompt"))


def extract_code(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.extract_code(synthetic_response()).alias("code"))


def step_check(spark, sf_dir):
    d = extract_code(spark, sf_dir).select("doc_id", T.step_check("code").alias("p"))
    return d.select("doc_id", "p.is_parsable", "p.step_count")


def unique_request_id(spark, sf_dir):
    return keys.unique_request_id(problems(spark, sf_dir)).select("pos", "problem_id", "custom_id")


def last_writer_wins(spark, sf_dir):
    return keys.last_writer_wins(problems(spark, sf_dir).select("pos", "problem_id", "problem"))


def request_envelope(spark, sf_dir):
    e = requests.envelope(requests.requests(problems(spark, sf_dir), "Be brief."), "default")
    m = F.col("body.messages")
    return e.select("custom_id", "method", "url", F.col("body.model").alias("model"), F.get(m, F.lit(0))["content"].alias("system"), F.get(m, F.lit(1))["content"].alias("user"), F.col("body.reasoning_effort").alias("effort"))


def response_dedup(spark, sf_dir):
    return keys.response_map(response_lines(spark, sf_dir))


def response_join(spark, sf_dir):
    d = problems(spark, sf_dir).withColumn("custom_id", F.col("doc_id").cast("string"))
    j = requests.join_responses(d, response_lines(spark, sf_dir))
    return j.select("custom_id", "problem_id", "response", outcome.no_response("response").alias("no_response"))


def classify_sync(spark, sf_dir):
    return outcomes(spark, sf_dir, False).select("pos", "status", "error", "bucket", F.col("parsability.step_count").alias("step_count"))


def classify_batch(spark, sf_dir):
    return outcomes(spark, sf_dir, True).select("pos", "status", "error", "bucket", F.col("parsability.step_count").alias("step_count"))


def run_stats(spark, sf_dir):
    return outcome.run_stats(outcomes(spark, sf_dir, False))


def run_manifest(spark, sf_dir):
    return outcome.manifest(outcomes(spark, sf_dir, False)).select("pos", "problem_id", "status", "file")


def job_progress(spark, sf_dir):
    return requests.job_progress(response_join(spark, sf_dir), "problem_id")


def json_records(spark, sf_dir):
    """Records as lines, written and read back: the export's form that scales."""
    path = new_path(spark, "records")
    writers.json_lines(_t(spark, sf_dir, "labels"), path)
    return spark.read.text(path).select(F.get_json_object("value", "$.doc_id").cast("long").alias("doc_id"), F.col("value").alias("record"))


def table_info(spark, sf_dir):
    return readers.table_info(spark, f"{sf_dir}/labels.parquet").select("ordinal", "column_name", "column_type", "n_rows", "n_columns", (F.col("n_bytes") > 0).alias("has_bytes"))


def row_counts(spark, sf_dir):
    d = _t(spark, sf_dir, "labels")
    return outcome.row_counts(d, curate.is_one(d, "quality"))


def text_functions(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select("doc_id", T.count_substring("text", "tion").alias("n_tion"), F.size(T.lines("text")).cast("long").alias("n_lines"), T.mask_secret("source").alias("masked"), T.has_main("text").alias("has_main"), F.length(T.check_program("text", ["x"])).cast("long").alias("n_program"))


def axiom_summary(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").withColumn("o", F.concat(F.lit("  axioms: a\nnone\naxioms: b\n"), F.col("text"), F.when(F.col("doc_id") % 3 == 0, F.lit("\nwarning: declaration uses 'sorry'")).otherwise(F.lit(""))))
    return d.select("doc_id", F.array_join(T.axiom_lines("o"), "|").alias("axioms"), T.has_placeholder("o").alias("placeholder"))


def _stub_check(code: str) -> tuple[bool, str]:
    return len(code) % 2 == 0, ""


def external_validate(spark, sf_dir):
    """The validator as it runs outside the JVM, with a stub of the same rule as native_check()."""
    d = _t(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 7 != 0, synthetic_response()).alias("response")).withColumn("generated_code", T.extract_code("response"))
    return external.validate(d, _stub_check).select("doc_id", F.col("compilation.success").alias("success"))


def _stub_generate(system: str, user: str) -> str | None:
    return None if len(user) % 5 == 0 else f"```lean\n{system}\n```"


def external_generate(spark, sf_dir):
    d = requests.requests(problems(spark, sf_dir), "Be brief.")
    return external.generate(d, external.Retry(_stub_generate)).select("pos", "response")


def flagship(spark, sf_dir):
    """Documents whose label is good, skipped or answered, their code extracted, checked and counted."""
    good = curate.score_filter(_t(spark, sf_dir, "labels"), "quality").select("doc_id")
    return outcome.run_stats(outcomes(spark, sf_dir, True).join(good, "doc_id"))


_OWN = (score_filter_scalar, score_filter_array, filter_then_limit, limit_then_filter, skip_classify, render_prompt, extract_code, step_check, unique_request_id, last_writer_wins, request_envelope, response_dedup, response_join, classify_sync, classify_batch, run_stats, run_manifest, job_progress, json_records, table_info, row_counts, text_functions, axiom_summary, external_validate, external_generate, flagship)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _OWN} | io_queries.queries() | run_queries.queries() | scan_queries.queries()


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_RESPONSE = "CASE doc_id % 6 " + " ".join(f"WHEN {k} THEN ({_lit(a)}) || text || ({_lit(b)})" for k, (a, b) in enumerate(FORMS)) + " END"
_STRIP = r"regexp_replace({}, '\A\s+|\s+\z', '', 'g')"
_CODE = _STRIP.format(r"CASE WHEN regexp_matches(r, '(?s)```lean\n(.*?)```') THEN regexp_extract(r, '(?s)```lean\n(.*?)```', 1) WHEN regexp_matches(r, '(?s)```\n(.*?)```') THEN regexp_extract(r, '(?s)```\n(.*?)```', 1) ELSE r END")
_STARTS, _ENDS = r"len(regexp_extract_all(c, '--\s*\[STEP_\d+:'))", r"len(regexp_extract_all(c, '--\s*\[END_STEP_\d+\]'))"
_REASON = "CASE WHEN contains(lower(text), 'license') THEN 'license text' WHEN contains(lower(text), 'password') THEN 'secret' WHEN (length(lower(text)) - length(replace(lower(text), 'tion', ''))) // 4 > 8 THEN 'too many endings' END"
_OUT = f"""WITH a AS (SELECT doc_id, source, text, {_REASON} AS reason, CASE WHEN doc_id % 7 <> 0 THEN {_RESPONSE} END AS r FROM documents),
b AS (SELECT *, {_CODE} AS c FROM a), s AS (SELECT *, {_STARTS} AS x, {_ENDS} AS y FROM b),
p AS (SELECT *, CASE WHEN x > 0 AND y > 0 THEN x ELSE 0 END AS steps, x > 0 AND x = y AS ok, reason IS NOT NULL AS skipped, coalesce(length(r), 0) = 0 AS silent, length(c) % 2 <> 0 AS bad FROM s),
o AS (SELECT *, CASE WHEN skipped THEN 'skipped' WHEN silent OR bad OR NOT ok THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN skipped THEN NULL WHEN silent THEN '@' WHEN bad THEN 'Compilation failed' WHEN NOT ok THEN 'Not parsable' END AS error,
  CASE WHEN skipped THEN 'skipped' WHEN silent THEN 'failed_api' WHEN bad THEN 'failed_compilation' WHEN NOT ok THEN 'failed_parsable' ELSE 'successful' END AS bucket FROM p)
"""
_SYNC, _BATCH = _OUT.replace("'@'", f"'{outcome.NO_RESPONSE}'"), _OUT.replace("'@'", f"'{outcome.NO_BATCH_RESPONSE}'")
_STATS = "count(*)::BIGINT AS total, " + ", ".join(f"count(*) FILTER (WHERE bucket = '{b}')::BIGINT AS {b}" for b in ("successful", "skipped", "failed_compilation", "failed_parsable", "failed_api"))
_LINES = f"""l AS (SELECT doc_id * 2 AS n, doc_id::VARCHAR AS custom_id, CASE WHEN doc_id % 11 <> 0 THEN {_RESPONSE} END AS content FROM documents WHERE doc_id % 7 <> 0
  UNION ALL SELECT doc_id * 2 + 1, doc_id::VARCHAR, CASE WHEN doc_id % 3 <> 0 THEN 'again' END FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 5 = 0),
m AS (SELECT custom_id, content FROM l QUALIFY row_number() OVER (PARTITION BY custom_id ORDER BY n DESC) = 1)"""
_UNIQUE = "source || CASE WHEN row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1 THEN '' ELSE '_' || (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1)::VARCHAR END"
_PROMPT = "'Problem:' || chr(10) || text || chr(10) || chr(10) || "


def oracle_sql() -> dict[str, str]:
    ask = _lit(T.ASK)
    return io_queries.oracle_sql() | run_queries.oracle_sql() | scan_queries.oracle_sql() | {
        "score_filter_scalar": "SELECT * FROM labels WHERE quality = 1",
        "score_filter_array": "SELECT * FROM labels WHERE doc_id % 5 = 0 OR (doc_id % 5 <> 1 AND quality = 1 AND toxic = 0)",
        "filter_then_limit": "SELECT * FROM labels WHERE quality = 1 ORDER BY doc_id LIMIT 100",
        "limit_then_filter": "SELECT * FROM (SELECT * FROM labels ORDER BY doc_id LIMIT 100) WHERE quality = 1",
        "skip_classify": f"SELECT doc_id, reason IS NOT NULL AS skipped, reason AS skip_reason FROM (SELECT doc_id, {_REASON} AS reason FROM documents)",
        "render_prompt": f"SELECT doc_id, {_PROMPT} CASE WHEN quality IS NULL THEN '' ELSE 'Solution/Hint:' || chr(10) || 'quality ' || quality::VARCHAR || chr(10) || chr(10) END || {ask} AS prompt FROM documents LEFT JOIN labels USING (doc_id)",
        "extract_code": f"SELECT doc_id, {_CODE} AS code FROM (SELECT doc_id, {_RESPONSE} AS r FROM documents)",
        "step_check": f"SELECT doc_id, x > 0 AND x = y AS is_parsable, CASE WHEN x > 0 AND y > 0 THEN x ELSE 0 END::BIGINT AS step_count FROM (SELECT doc_id, {_STARTS} AS x, {_ENDS} AS y FROM (SELECT doc_id, {_CODE} AS c FROM (SELECT doc_id, {_RESPONSE} AS r FROM documents)))",
        "unique_request_id": f"SELECT doc_id AS pos, source AS problem_id, {_UNIQUE} AS custom_id FROM documents",
        "last_writer_wins": "SELECT doc_id AS pos, source AS problem_id, text AS problem FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) = 1",
        "request_envelope": f"SELECT {_UNIQUE} AS custom_id, 'POST' AS method, '/v1/chat/completions' AS url, 'default' AS model, 'Be brief.' AS system, {_PROMPT} {ask} AS \"user\", 'high' AS effort FROM documents",
        "response_dedup": f"WITH {_LINES} SELECT * FROM m",
        "response_join": f"WITH {_LINES} SELECT doc_id::VARCHAR AS custom_id, source AS problem_id, content AS response, coalesce(length(content), 0) = 0 AS no_response FROM documents LEFT JOIN m ON m.custom_id = doc_id::VARCHAR",
        "classify_sync": f"{_SYNC} SELECT doc_id AS pos, status, error, bucket, CASE WHEN NOT (skipped OR silent OR bad) THEN steps END::BIGINT AS step_count FROM o",
        "classify_batch": f"{_BATCH} SELECT doc_id AS pos, status, error, bucket, CASE WHEN NOT (skipped OR silent) THEN steps END::BIGINT AS step_count FROM o",
        "run_stats": f"{_SYNC} SELECT {_STATS} FROM o",
        "run_manifest": f"{_SYNC} SELECT doc_id AS pos, source AS problem_id, status, source || '.json' AS file FROM o",
        "job_progress": f"WITH {_LINES} SELECT source AS problem_id, count(*)::BIGINT AS total, count(*) FILTER (WHERE length(content) > 0)::BIGINT AS completed, round(count(*) FILTER (WHERE length(content) > 0) * 100.0::DOUBLE / count(*), 1) AS percent FROM documents LEFT JOIN m ON m.custom_id = doc_id::VARCHAR GROUP BY source",
        "json_records": "SELECT doc_id, '{\"doc_id\":' || doc_id || ',\"quality\":' || coalesce(quality::VARCHAR, 'null') || ',\"toxic\":' || coalesce(toxic::VARCHAR, 'null') || '}' AS record FROM labels",
        "table_info": "SELECT i::INT AS ordinal, c AS column_name, k AS column_type, (SELECT count(*) FROM labels)::BIGINT AS n_rows, 3::BIGINT AS n_columns, true AS has_bytes FROM (VALUES (0, 'doc_id', 'bigint'), (1, 'quality', 'int'), (2, 'toxic', 'int')) t(i, c, k)",
        "row_counts": "SELECT count(*)::BIGINT AS rows_before, count(*) FILTER (WHERE quality = 1)::BIGINT AS rows_after FROM labels",
        "text_functions": "SELECT doc_id, ((length(text) - length(replace(text, 'tion', ''))) // 4)::BIGINT AS n_tion, len(string_split(text, chr(10)))::BIGINT AS n_lines, CASE WHEN length(source) > 11 THEN substr(source, 1, 7) || '...' || right(source, 4) ELSE '***' END AS masked, contains(text, 'def main') AS has_main, (length('set_option warningAsError true') + 1 + length(regexp_replace(text, '\\s+\\z', '')) + length('#print axioms x') + 2)::BIGINT AS n_program FROM documents",
        "axiom_summary": "SELECT doc_id, array_to_string(list_filter(list_transform(string_split('  axioms: a' || chr(10) || 'none' || chr(10) || 'axioms: b' || chr(10) || text, chr(10)), lambda x: regexp_replace(x, '\\A\\s+|\\s+\\z', '', 'g')), lambda x: starts_with(x, 'axioms:')), '|') AS axioms, contains(text, 'declaration uses ''sorry''') OR contains(text, 'declaration uses sorry') OR doc_id % 3 = 0 AS placeholder FROM documents",
        "external_validate": f"SELECT doc_id, length(c) % 2 = 0 AS success FROM (SELECT doc_id, {_CODE} AS c FROM (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN {_RESPONSE} END AS r FROM documents))",
        "external_generate": f"SELECT doc_id AS pos, CASE WHEN length({_PROMPT} {ask}) % 5 <> 0 THEN '```lean' || chr(10) || 'Be brief.' || chr(10) || '```' END AS response FROM documents",
        "flagship": f"{_BATCH} SELECT {_STATS} FROM o JOIN labels USING (doc_id) WHERE quality = 1",
    }
