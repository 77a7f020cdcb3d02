"""The engine's operators on small fixtures."""

import json
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curatrix import cli
from curatrix.functions import text as T
from curatrix.operators import curate, keys, outcome, requests
from curatrix.plans import external, runs
from curatrix.sources import footers, readers, writers
from curatrix.streaming import landing


def one(spark, column_of, *values):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in d.orderBy("i").select(column_of("c").alias("x")).collect()]


@pytest.mark.parametrize(("kind", "scores", "kept"), [("array<double>", [[1, 1], [1, 0], [], None, [None, 1], [1.0]], [0, 2, 5]), ("int", [1, 0, None], [0]), ("boolean", [True, False, None], [0]), ("string", ["1", "x", "1.0"], []), ("array<int>", [None, [1], [1, 1]], [1, 2])])
def test_score_filter(spark, kind, scores, kept):
    conv = (lambda x: [None if y is None else float(y) for y in x] if x is not None else None) if kind == "array<double>" else (lambda x: x)
    d = spark.createDataFrame([(i, conv(s)) for i, s in enumerate(scores)], f"i int, score {kind}")
    assert [r.i for r in curate.score_filter(d).orderBy("i").collect()] == kept


def test_no_score_column(spark):
    with pytest.warns(UserWarning, match="no column"):
        assert curate.score_filter(spark.range(3)).count() == 3


def test_scalar_filter_is_pushed_down(spark, tmp_path):
    spark.range(5).select("id", (F.col("id") % 2).alias("score")).write.parquet(str(tmp_path / "t"))
    plan = curate.score_filter(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(score,1\)", plan)


def test_skip_rules(spark):
    texts = ["Let O be the CIRCUMCENTER", "incircle and orthocenter", "the Simson line", "reconstruct the sum", "point " * 8 + "line " * 6, "point " * 9, "collinear " * 7, "", None]
    want = ["complex geometric construction (circumcenter)", "complex geometric construction (orthocenter)", "complex geometric construction (Simson line)", "geometric construction required", None, curate.GEOMETRY.counts_reason, curate.GEOMETRY.counts_reason, None, None]
    assert one(spark, curate.skip_reason, *texts) == want


def test_extract_code(spark):
    f = "```"
    texts = [f"intro\n{f}lean\nabc\n{f}\noutro", f"{f}\nplain\n{f}\n{f}lean\nmine\n{f}", f"{f}lean\n{f}", f"{f}python\nx=1\n{f}\nmid text\n{f}lean4\ny\n{f}", f"{f}lean\n1\n{f}{f}lean\n2\n{f}", f"{f}lean\r\nabc\n{f}", "　\x1c\n text \n", None]
    assert one(spark, T.extract_code, *texts) == ["abc", "mine", "", "mid text", "1", texts[5], "text", None]


def test_step_check(spark):
    s, e = "-- [STEP_1: x]\n", "-- [END_STEP_1]\n"
    texts = [s + e, s + s + e, s, e, e + s, s + "-- [END_STEP_2]", "-- [STEP_1A: x] -- [END_STEP_1A]", "--\n[STEP_1: x]" + e, "-- [STEP_١: x]" + e, None]
    got = [tuple(x) for x in one(spark, T.step_check, *texts)]
    assert got == [(True, 1), (False, 2), (False, 0), (False, 0), (True, 1), (True, 1), (False, 0), (True, 1), (True, 1), (False, 0)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab`\n lean-[]STEP_1:END x", max_size=60), min_size=1, max_size=30))
def test_text_functions_as_plain_python(spark, texts):
    def code(t):
        m = re.search(r"```lean\n(.*?)```", t, re.S) or re.search(r"```\n(.*?)```", t, re.S)
        return (m[1] if m else t).strip()

    assert one(spark, T.extract_code, *texts) == [code(t) for t in texts]
    assert one(spark, lambda c: T.count_substring(c, "ab"), *texts) == [t.count("ab") for t in texts]


def test_small_functions(spark):
    assert one(spark, T.mask_secret, "short", "sk-12345678901234") == ["***", "sk-1234...1234"]
    assert one(spark, lambda c: T.check_program(c, ["a", "b"]), "x  \n\n") == ["set_option warningAsError true\nx\n#print axioms a\n#print axioms b\n"]
    assert one(spark, T.axiom_lines, "a\n axioms: q \nb") == [["axioms: q"]]
    assert one(spark, lambda c: T.render_prompt("c", F.lit(None).cast("string")), "p")[0] == f"Problem:\np\n\n{T.ASK}"
    assert one(spark, lambda c: T.render_prompt("c", F.lit("h")), None)[0] == f"Problem:\n\n\nSolution/Hint:\nh\n\n{T.ASK}"
    assert runs.progress({"total": 3, "completed": 1}) == "1/3 (33.3%)" and runs.progress(None) == "0/0 (0.0%)"


def test_limits(spark):
    d = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "pos int, score int")
    assert [r.pos for r in curate.limit_after_filter(curate.score_filter(d), 1).collect()] == [2]
    assert curate.limit_after_filter(d, 0).count() == 0 and curate.limit_before_filter(d, 0).count() == 3
    for f in (curate.limit_after_filter, curate.limit_before_filter):
        with pytest.raises(ValueError, match="negative"):
            f(d, -1)


def test_keys(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "a"), (5, None)], "pos long, problem_id string")
    got = {r.pos: r.custom_id for r in keys.unique_request_id(keys.default_id(d)).collect()}
    assert got == {1: "a", 2: "b", 3: "a_1", 4: "a_2", 5: "problem_5"}
    assert sorted(r.pos for r in keys.last_writer_wins(d).collect()) == [2, 4, 5]
    clash = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a_1")], "pos long, problem_id string")
    with pytest.raises(ValueError, match="a_1"):
        keys.assert_unique(keys.unique_request_id(clash))
    assert [r.custom_id for r in keys.settled_request_id(clash).orderBy("pos").collect()] == ["a", "a_2", "a_1"]


def _settled(rows):
    """Plain rounds: colliding rows of an id get the next numbers it has not used."""
    given, used, seen, out, moving = {i for _, i in rows}, {}, {}, {}, []
    for p, i in sorted(rows):
        k = seen[i] = seen.get(i, -1) + 1
        used[i] = max(used.get(i, 0), k)
        out[p] = i if not k else f"{i}_{k}"
        moving += [(p, i)] if k and out[p] in given else []
    while moving:
        again = []
        for p, i in moving:
            used[i] += 1
            out[p] = f"{i}_{used[i]}"
            again += [(p, i)] if out[p] in given else []
        moving = again
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "a_1", "a_2", "a_3", "a_5", "a_1_1", "b_1", "a_01"]), max_size=25))
def test_settled_ids(spark, ids):
    rows = list(enumerate(ids, 1))
    d = spark.createDataFrame([(p, i, "x", 1) for p, i in rows], "pos long, problem_id string, _order string, _made int")
    got = {r.pos: r.custom_id for r in keys.settled_request_id(d).collect()}
    assert got == _settled(rows) and len(set(got.values())) == len(rows)


def test_unique_ids_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(keys, "BLOCK", 3)
    d = spark.range(20).select(F.col("id").alias("pos"), F.when(F.col("id") % 4 == 0, "y").otherwise("x").alias("problem_id"))
    got = [r.custom_id for r in keys.unique_request_id(d).orderBy("pos").collect()]
    seen, want = {}, []
    for i in range(20):
        k = "y" if i % 4 == 0 else "x"
        n = seen.get(k, 0)
        seen[k] = n + 1
        want.append(k if n == 0 else f"{k}_{n}")
    assert got == want


def test_outcomes(spark):
    ok, bad = (True, 0.0, ""), (False, 0.0, "")
    rows = [(1, "a", "why", None, None, None), (2, "b", None, "", None, None), (3, "c", None, "r", bad, (True, 1)), (4, "d", None, "r", ok, (False, 0)), (5, "e", None, "r", ok, (True, 1))]
    d = spark.createDataFrame(rows, "pos long, problem_id string, skip_reason string, response string, compilation struct<success: boolean, duration_seconds: double, output: string>, parsability struct<is_parsable: boolean, step_count: long>")
    sync, batch = outcome.classify(d), outcome.classify(d, batch=True)
    assert [(r.status, r.error) for r in sync.orderBy("pos").collect()] == [("skipped", None), ("failed", "No response from API"), ("failed", "Compilation failed"), ("failed", "Not parsable"), ("success", None)]
    assert [r.parsability is None for r in sync.orderBy("pos").collect()] == [True, True, True, False, False]
    assert [r.parsability is None for r in batch.orderBy("pos").collect()] == [True, True, False, False, False]
    assert outcome.run_stats(sync).first().asDict() == {"total": 5, "successful": 1, "skipped": 1, "failed_compilation": 1, "failed_parsable": 1, "failed_api": 1}
    assert [f.status for f in outcome.manifest_array(sync).first().problem_files] == ["skipped", "failed", "failed", "failed", "success"]


def _line(k, text, status=200):
    return json.dumps({"custom_id": k, "response": {"status_code": status, "body": {"choices": [{"message": {"content": text}}]}}})


def test_responses(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text("\n".join([_line("a", "1"), "{broken", _line("a", "x", 500), _line("b", "2"), '{"custom_id": "c", "response": null}']))
    path = str(tmp_path / "r.jsonl")
    got = {r.custom_id: r.content for r in keys.response_map(readers.responses(spark, path)).collect()}
    assert got == {"a": None, "b": "2"}
    assert readers.bad_responses(spark, path).count() == 2
    with pytest.raises(ValueError, match="can't be read"):
        readers.responses(spark, path, strict=True)


def test_problem_documents(spark, tmp_path):
    rows = [{"problem_id": "p", "problem": "x", "metadata": {"k": [1]}}, {"problem": None}, {"problem_id": "q", "problem": "z", "solution": "s"}]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "o.json").write_text(json.dumps(rows[0]))
    got = readers.problems_json(spark, str(tmp_path / "a.json")).withColumn("m", F.to_json("metadata")).orderBy("pos").collect()
    assert [(r.pos, r.problem_id, r.problem, r.solution, r.m) for r in got] == [(1, "p", "x", "", '{"k":[1]}'), (2, "problem_2", None, "", "{}"), (3, "q", "z", "s", "{}")]
    assert readers.problems_json(spark, str(tmp_path / "o.json")).count() == 1


class Service:
    """A bulk service that answers each request with a fenced block."""

    def __init__(self, folder):
        self.folder, self.looks = folder, 0

    def submit(self, path):
        self.path = path
        return "job"

    def status(self, job):
        self.looks += 1
        if self.looks == 1:
            raise ConnectionError("not now")
        return {"status": "completed" if self.looks > 2 else "in_progress"}

    def results(self, job):
        import glob

        out = []
        for f in sorted(glob.glob(f"{self.path}/part-*")):
            for line in open(f):
                r = json.loads(line)
                n = len(out)
                out.append(_line(r["custom_id"], "```lean\n-- [STEP_1: a]\n-- [END_STEP_1]\n```" if n else "```lean\nbad\n```"))
        (self.folder / "out.jsonl").write_text("\n".join(out))
        return str(self.folder / "out.jsonl")


def _stubs():
    """A validator and a generator; inner functions travel to the workers by value."""

    def good(code):
        return "bad" not in code, code[:10]

    def echo(system, user):
        return None if "silent" in user else f"```lean\n-- [STEP_1: a]\n{user}\n-- [END_STEP_1]\n```"

    return good, echo


def _problems(spark):
    return spark.createDataFrame([(1, "a", "one", ""), (2, "a", "construct it", ""), (3, "a", "two", "hint"), (4, "b", "bad", ""), (5, None, "silent", "")], "pos long, problem_id string, problem string, solution string")


def test_runs(spark, tmp_path):
    good, echo = _stubs()
    log = runs.run_sync(_problems(spark), "S", external.Retry(echo), good, str(tmp_path / "sync"), model="m")
    assert outcome.run_stats(log).first().asDict() == {"total": 5, "successful": 2, "skipped": 1, "failed_compilation": 1, "failed_parsable": 0, "failed_api": 1}
    log = runs.run_batch(_problems(spark), "S", Service(tmp_path), good, str(tmp_path / "batch"), "m", interval=0.0, most=1e-9 + 5, sleep=lambda s: None)
    got = outcome.run_stats(log).first()
    assert got.total == 5 and got.skipped == 1 and got.successful + got.failed_compilation == 4
    raw = tmp_path / "batch/batch_output/run_id=run"
    assert (raw / "out.jsonl").read_bytes() == (tmp_path / "out.jsonl").read_bytes()
    runs.write_summary(log, str(tmp_path / "summary"), one_row=True, model="m", batch_mode=True, max_problems=None)
    s = spark.read.json(str(tmp_path / "summary/run_summary")).first()
    assert s.stats.total == 5 and len(s.problem_files) == 5 and s.batch_mode is True
    assert spark.read.json(str(tmp_path / "summary/problem_files")).count() == 5
    with pytest.raises(ValueError, match="too many"):
        outcome.manifest_array(log, most=4)
    assert runs.run_sync(_problems(spark).limit(2), "S", external.Retry(echo), good, str(tmp_path / "l"), max_problems=1).count() == 1


def test_one_call_a_row(spark, tmp_path):
    """A generator that fails at random, and differently each time it is asked."""
    calls, checks = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def flaky(system, user):
        import random

        calls.add(1)
        return f"```lean\n{random.random()}\n```" if random.random() < 0.5 else None

    def check(code):
        checks.add(1)
        return True, code

    d = spark.createDataFrame([(i, f"p{i}", f"text {i}", "") for i in range(1, 11)], "pos long, problem_id string, problem string, solution string")
    for k in range(3):
        log = runs.run_sync(d, "S", flaky, check, str(tmp_path / "flaky"), run_id=f"r{k}").collect()
        assert sorted(r.pos for r in log) == list(range(1, 11)) and calls.value == 10 * (k + 1)
        assert all((r.response is None) == (r.compilation is None) for r in log)
        assert all(r.response is None or r.compilation.output in r.response for r in log)  # the answer that was logged is the one that was checked
    answered = sum(spark.read.parquet(str(tmp_path / f"flaky/log/run_id=r{k}")).where("response is not null").count() for k in range(3))
    assert checks.value == answered and spark.read.parquet(str(tmp_path / "flaky/log")).count() == 30


def test_log_fields(spark, tmp_path):
    good, echo = _stubs()
    log = runs.run_sync(_problems(spark), "S", external.Retry(echo), good, str(tmp_path / "sync"), model="m").orderBy("pos").collect()
    assert all(r.start_time <= r.end_time and r.total_duration_seconds >= 0 for r in log)
    assert [r.api_call and r.api_call.model for r in log] == ["m", None, "m", "m", "m"]
    assert log[0].user_prompt.startswith("Problem:\none") and log[1].user_prompt is None


def test_poll_and_retry():
    class Never:
        def status(self, job):
            return {"status": "in_progress"}

    assert runs.poll(Never(), "j", 60, 180, sleep=lambda s: None)[0] == "timeout"
    pauses = []

    def fails(s, u):
        raise OSError

    assert external.Retry(fails, sleep=pauses.append)("s", "u") is None and pauses == [2, 4]
    assert external.CommandValidator(("false",))("x")[0] is False and external.CommandValidator(("cat", "{file}"))("x") == (True, "x")
    assert external.CommandValidator(("sleep", "5"), seconds=0.2)("x")[0] is False


def test_json_export(spark, tmp_path):
    d = spark.createDataFrame([(1, 1, float("nan"), None), (2, 1, 2.5, "a/é"), (3, 0, 1.0, "n")], "pos int, score int, x double, s string")
    kept = runs.export_scored(d)
    for pretty in (False, True):
        writers.write_json_document(kept, str(tmp_path / f"d{pretty}"), "pos", pretty)
        writers.merge_files(spark, str(tmp_path / f"d{pretty}"), str(tmp_path / f"d{pretty}.json"))
        got = json.loads((tmp_path / f"d{pretty}.json").read_text())
        assert got == [{"score": 1, "x": None, "s": None}, {"score": 1, "x": 2.5, "s": "a/é"}]
        assert json.loads("".join(r.line for r in writers.json_document(kept.where("pos > 9"), "pos", pretty).orderBy("_at").collect())) == []
    writers.json_lines(kept, str(tmp_path / "l"))
    assert "null" in "".join(r.value for r in spark.read.text(str(tmp_path / "l")).collect())


def test_table_info_and_cli(spark, tmp_path, capsys):
    d = spark.createDataFrame([(1, 1), (2, 0)], "a int, score int")
    d.write.parquet(str(tmp_path / "t"))
    info = readers.table_info(spark, str(tmp_path / "t")).orderBy("ordinal").collect()
    assert [(r.column_name, r.n_rows, r.n_columns) for r in info] == [("a", 2, 2), ("score", 2, 2)] and info[0].n_bytes > 0
    assert cli.main(["convert", str(tmp_path / "t")], spark) == 0
    assert json.loads(capsys.readouterr().out) == [{"a": 1, "score": 1}]
    assert cli.main(["convert", str(tmp_path / "t"), "-o", str(tmp_path / "one.json"), "--single-file", "--pretty"], spark) == 0
    assert json.loads((tmp_path / "one.json").read_text()) == [{"a": 1, "score": 1}] and not (tmp_path / "one.json.parts").exists()
    assert cli.main(["convert", str(tmp_path / "t"), "-o", str(tmp_path / "lines"), "--lines"], spark) == 0
    assert [r.asDict() for r in spark.read.json(str(tmp_path / "lines")).collect()] == [{"a": 1, "score": 1}]
    assert cli.main(["convert", "x", "--info", "--hf"]) == 1
    assert cli.main(["check", "--code", "x", "--command", "cat {file}"], spark) == 0
    assert cli.main(["check", "--code", "declaration uses 'sorry'", "--command", "cat {file}"], spark) == 3
    assert cli.main(["check", "--code", "declaration uses 'sorry'", "--command", "false {file}"], spark) == 1
    assert cli.main(["check", "--code", "x", "--workdir", str(tmp_path / "project")], spark) == 1  # no build tool here
    assert (tmp_path / "project/Main.lean").read_text() == "set_option warningAsError true\nx\n" and "lean_exe" in (tmp_path / "project/lakefile.lean").read_text()


class Asked:
    """A service that is made with what the command line says."""

    made: list = []

    def __init__(self, api_key, model, reasoning_effort):
        Asked.made.append((api_key, model, reasoning_effort))

    def status(self, job):
        return {"status": "in_progress", "request_counts": {"total": 4, "completed": 1}}

    def submit(self, path):
        import shutil

        Asked.path = path
        self.out = f"{path}-out"
        shutil.rmtree(self.out, ignore_errors=True)
        return "job"

    def results(self, job):
        return Asked.results_path


def test_command_line_of_a_service(spark, tmp_path, capsys, monkeypatch):
    spec = f"{__name__}:Asked"
    monkeypatch.delenv("OPENAI_API_KEY", raising=False)
    assert cli.main(["status", "job", "--service", spec]) == 1 and "no key" in capsys.readouterr().err
    assert cli.main(["status", "job", "--service", spec, "--api-key", "k"]) == 0 and "in_progress 1/4 (25.0%)" in capsys.readouterr().out
    monkeypatch.setenv("OPENAI_API_KEY", "env")
    (tmp_path / "in.json").write_text(json.dumps([{"problem_id": "a/b", "problem": "one"}, {"problem_id": "c", "problem": "construct"}]))
    (tmp_path / "out.jsonl").write_text(_line("a/b", "```lean\nx\n```"))
    Asked.results_path, Asked.status = str(tmp_path / "out.jsonl"), lambda self, job: {"status": "completed"}
    code = cli.main(["process", str(tmp_path / "in.json"), "--service", spec, "--batch", "--model", "m", "--reasoning-effort", "low", "--dataset-dir", str(tmp_path / "d"), "--run-id", "r", "--export", "--manifest-in-summary", "--validator", "cat {file}"], spark)
    assert code == 0 and Asked.made[-1] == ("env", "m", "low")
    lines = [json.loads(x.value) for x in spark.read.text(Asked.path).collect()]
    assert [x["body"]["reasoning_effort"] for x in lines] == ["low"]
    assert sorted(x.name for x in (tmp_path / "d/files/r/part-00000").iterdir() if not x.name.startswith(".")) == ["a_b.json", "a_b.lean", "c.json"]
    assert json.loads((tmp_path / "d/files/r/part-00000/c.json").read_text())["status"] == "skipped"
    summary = spark.read.json(str(tmp_path / "d/runs/r/run_summary")).first()
    assert (summary.reasoning_effort, summary.stats.skipped, len(summary.problem_files)) == ("low", 1, 2) and summary.start_time <= summary.end_time
    assert cli.main(["retrieve", "job", "--service", spec, "--output-dir", str(tmp_path / "got"), "--process", "--validator", "cat {file}"], spark) == 0
    assert spark.read.parquet(str(tmp_path / "got/validation")).first().compilation.success and (tmp_path / "got/raw/out.jsonl").read_bytes() == (tmp_path / "out.jsonl").read_bytes()
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["process", "x", "--service", "s", "--reasoning-effort", "huge"])


def test_calls_hold_few_rows_at_a_time():
    base, seen = pa.total_allocated_bytes(), []

    def batches(*names):
        for k in range(3):
            seen.append(pa.total_allocated_bytes() - base)
            texts = [None if i % 7 == 0 else "" if i % 7 == 1 else f"{k} {i} " + "x" * (8000 + i) for i in range(1000)]
            yield pa.RecordBatch.from_arrays([pa.array(range(k * 1000, k * 1000 + 1000)), pa.array(texts), pa.array(texts)], ["id", *names])

    for job, names, column in ((external._validate, ("response", "generated_code"), "compilation"), (external._generate, ("system_prompt", "user_prompt"), "response")):
        call = (lambda code: (len(code) % 2 == 0, code[:9])) if column == "compilation" else lambda s, u: u and u[:9]
        ids, got, most = [], [], 0
        for out in job(batches(*names), call):
            most = max(most, out.num_rows)
            ids += out.column(0).to_pylist()
            got += out.column(out.schema.get_field_index(column)).to_pylist()
        assert ids == list(range(3000)) and most <= external.ROWS
        assert got[0] is None and got[1] == (None if column == "compilation" else "")
        assert [(x["output"], x["success"]) if column == "compilation" else x for x in (got[2], got[2999])] == ([("0 2 xxxxx", True), ("2 999 xxx", False)] if column == "compilation" else ["0 2 xxxxx", "2 999 xxx"])
    assert max(seen) < 4e6  # each batch has 12 MB, none of which is held while the next one is read


def _land(spark, tmp_path, n=None):
    landing.land(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), n).awaitTermination()


def test_landing_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.json").write_text(_line(f"r{k}", "```lean\n-- [STEP_1: a]\n-- [END_STEP_1]\n```") + "\n")
        _land(spark, tmp_path)
    got = landing.landed(spark, str(tmp_path / "out")).orderBy("custom_id").collect()
    assert [(r.custom_id, r.parsability.is_parsable) for r in got] == [("r0", True), ("r1", True)]


def test_landing_keeps_the_last_line_by_place(spark, tmp_path):
    (tmp_path / "in").mkdir()
    failed = '{"custom_id": "x", "response": {"status_code": 500, "body": null}}'
    waves = [
        {"m.json": [_line("x", "m0"), "", "{", _line("x", "m1"), _line("y", "y")]},
        {"a.json": [_line("x", "late but first"), _line("z", "z"), '{"custom_id": "q", "response": null}'], "p.json": [_line("x", "p0"), failed]},
        {"n.json": [_line("x", "between"), "not json", _line("y", "y2")]},
    ]
    for wave in waves:
        for name, lines in wave.items():
            (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
        _land(spark, tmp_path, 1)
    got = {r.custom_id: r.response for r in landing.landed(spark, str(tmp_path / "out")).collect()}
    all_ = readers.responses(spark, str(tmp_path / "in"))
    assert got == {r.custom_id: r.content for r in keys.response_map(all_).collect()} == {"x": None, "y": "y2", "z": "z"}
    bad = sorted(r.line for r in landing.broken(spark, str(tmp_path / "out")).collect())
    assert bad == sorted(r.line for r in readers.bad_responses(spark, str(tmp_path / "in")).collect()) and len(bad) == 3
    changes = spark.read.parquet(str(tmp_path / "out/answer")).where("custom_id = 'x'").count()
    assert changes == 2  # neither the late file nor the one between has changed what counts


def test_landing_holds_nothing_from_batch_to_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, lines in (("b", [_line("x", "1"), "{"]), ("c", [_line("x", "2"), _line("y", "3"), "{"]), ("a", [_line("x", "0")])):
        (tmp_path / "in" / f"{name}.json").write_text("\n".join(lines) + "\n")
        q = landing.land(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"))
        q.awaitTermination()
        assert all(not p["stateOperators"] for p in q.recentProgress)
    read = lambda: (sorted((r.custom_id, r.batch, r.content) for r in spark.read.parquet(str(tmp_path / "out/answer")).collect()), landing.broken(spark, str(tmp_path / "out")).count())
    want = ([("x", 0, "1"), ("x", 1, "2"), ("y", 1, "3")], 2)
    assert read() == want
    for k in (1, 2):  # as if the driver was lost between the output and the end of these batches
        for f in (tmp_path / "ck/commits").glob(f"*{k}*"):
            f.unlink()
    _land(spark, tmp_path)
    assert read() == want


def test_waves_have_as_many_files_as_tasks_read(spark, tmp_path):
    from pathlib import Path

    from curatrix.plans import scan_queries

    key = "spark.sql.files.maxPartitionBytes"
    had = spark.conf.get(key)
    spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("long text "), 200).alias("text")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set(key, "100k")
    try:
        src, out = scan_queries._waves(spark, str(tmp_path))
        got = landing.landed(spark, out).select("custom_id", F.length("response").alias("n")).collect()
    finally:
        spark.conf.set(key, had)
    assert len([*Path(src.removeprefix("file://"), "b").glob("part-*")]) > 6
    assert {int(r.custom_id) for r in got} == {i for i in range(400) if i % 7 and i % 13 > 1} and len(got) == len({r.custom_id for r in got})
    n = {int(r.custom_id): r.n for r in got}
    assert n[5] == len("again") and n[6] > 2000 and n[22] is None  # the last of two lines, the only one, a failed one


def test_last_lines_after_what_stands(spark):
    kind = "custom_id string, content string, line string, file string, block long, place long"
    d = spark.createDataFrame([("x", "a", None, "f", 0, 3), ("x", None, None, "f", 64, 0), ("y", "b", None, "f", 0, 1), ("z", "c", None, "f", 0, 2)], kind)
    before = spark.createDataFrame([("x", "f", 0, 9), ("y", "f", 0, 1), ("z", "e", 7, 7), ("q", "z", 0, 0)], "custom_id string, file string, block long, place long")
    assert {(r.custom_id, r.content, r.block) for r in landing.last_lines(d).collect()} == {("x", None, 64), ("y", "b", 0), ("z", "c", 0)}
    assert {(r.custom_id, r.block, r.place) for r in landing.last_lines(d, before).collect()} == {("x", 64, 0), ("z", 0, 2)}


def test_envelope(spark):
    d = requests.envelope(requests.requests(_problems(spark).where("problem_id is not null"), "S"), "m").orderBy("pos").first()
    assert (d.custom_id, d.method, d.body.model, [m.role for m in d.body.messages], d.body.messages[0].content) == ("a", "POST", "m", ["system", "user"], "S")
    assert d.body.reasoning_effort == "high"
    with pytest.raises(ValueError, match="effort"):
        requests.envelope(requests.requests(_problems(spark), "S"), "m", "huge")


def test_entry():
    import __spark_entry__ as e

    assert {"flagship", "score_filter_scalar"} <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_queries_agree_with_sql(spark):
    """The queries that write, read, call or wait, against the other engine on the smallest tables."""
    import duckdb

    from curatrix.plans import io_queries

    con = duckdb.connect()
    for t in ("documents", "labels", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    sql = io_queries.oracle_sql()
    for name, query in io_queries.queries().items():
        df = query(spark, "/root/testdata/sf0.001")
        cols = sorted(df.columns)
        got = con.execute(sql[name])
        at = [[x[0] for x in got.description].index(c) for c in cols]
        want = sorted(repr(tuple(r[i] for i in at)) for r in got.fetchall())
        assert sorted(repr(tuple(r[c] for c in cols)) for r in df.collect()) == want, name


def test_footers_agree_with_the_other_engine(spark, tmp_path):
    import duckdb

    d = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("s"), F.col("id") % 9)).alias("s"), F.struct((F.col("id") / 2).alias("x"), F.array("id").alias("y")).alias("n"))
    d.repartition(3).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "_note.txt").write_text("no table")
    got = sorted((r.file.rsplit("/", 1)[1], r.row_group, r.column.replace(".", ", "), r.physical_type, r.compression, r.n_values, r.n_nulls, r.compressed_bytes, r.plain_bytes, r.group_rows, r.file_rows) for r in footers.column_chunks(spark, str(tmp_path / "t")).collect())
    sql = f"SELECT file_name, row_group_id, path_in_schema, type, compression, num_values, stats_null_count, total_compressed_size, total_uncompressed_size, row_group_num_rows FROM parquet_metadata('{tmp_path}/t/*.parquet')"
    rows = duckdb.sql(sql).fetchall()
    of_file = {f: sum({x[1]: x[9] for x in rows if x[0] == f}.values()) for f in {x[0] for x in rows}}
    assert got == sorted((f.rsplit("/", 1)[1], *rest, of_file[f]) for f, *rest in rows) and len(got) > 12
    info = {r.column_name: r for r in readers.table_info(spark, str(tmp_path / "t")).collect()}
    assert (info["id"].physical_type, info["s"].physical_type, info["n"].physical_type, info["id"].n_rows) == ("INT64", "BYTE_ARRAY", "DOUBLE, INT64", 5000)


def test_convert_keeps_a_column_named_pos(spark, tmp_path, capsys):
    rows = [(None, "c", 1), (2, "b", 1), (2, "a", 1), (1, "x", 0)]
    spark.createDataFrame(rows, "pos long, x string, score int").coalesce(1).write.parquet(str(tmp_path / "t"))
    want = [{"pos": p, "x": x, "score": s} for p, x, s in rows[:3]]
    assert cli.main(["convert", str(tmp_path / "t")], spark) == 0 and json.loads(capsys.readouterr().out) == want
    assert cli.main(["convert", str(tmp_path / "t"), "-o", str(tmp_path / "o.json"), "--single-file", "--max-rows", "2"], spark) == 0
    assert json.loads((tmp_path / "o.json").read_text()) == want[:2]


def test_process_of_lines_and_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "_load", lambda spec: lambda system, user: f"```lean\n{user}\n```")
    (tmp_path / "in.jsonl").write_text('{"problem_id": "a", "problem": "one"}\n\n{"problem": "two"}\n')
    spark.createDataFrame([("t", "one"), (None, "two")], "problem_id string, problem string").coalesce(1).write.parquet(str(tmp_path / "t"))
    for path, kind, ids in ((tmp_path / "in.jsonl", "lines", ["a", "problem_2"]), (tmp_path / "t", "table", ["t", "problem_2"])):
        assert cli.main(["process", str(path), "--input-format", kind, "--service", "a:b", "--validator", "cat {file}", "--dataset-dir", str(tmp_path / kind), "--run-id", "r", "--window", "4"], spark) == 0
        assert [r.custom_id for r in runs.read_log(spark, str(tmp_path / kind), "r").orderBy("pos").collect()] == ids


def test_status_details(capsys, monkeypatch):
    monkeypatch.setenv("OPENAI_API_KEY", "env")
    monkeypatch.setattr(Asked, "status", lambda self, job: {"id": job, "status": "failed", "created_at": 0, "failed_at": 86400, "errors": "why", "request_counts": {"total": 2, "completed": 1}})
    assert cli.main(["status", "j", "--service", f"{__name__}:Asked"]) == 0
    assert capsys.readouterr().out.splitlines() == ["failed 1/2 (50.0%)", "id: j", "created_at: 1970-01-01T00:00:00+00:00", "failed_at: 1970-01-02T00:00:00+00:00", "errors: why"]
