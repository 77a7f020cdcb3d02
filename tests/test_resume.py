"""Runs that go on where they stopped, files that tasks write, and calls that are under way together."""

import re
import threading
import time
from datetime import UTC, datetime, timedelta
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curatrix.operators import steps
from curatrix.plans import external, ledger, runs, verdicts
from curatrix.sources import files, writers


def _reqs(spark, n=20):
    return spark.createDataFrame([(i, f"r{i}", "S", f"text {i}") for i in range(n)], "pos long, custom_id string, system_prompt string, user_prompt string")


def test_calls_in_order_and_together():
    busy, most, lock = [0], [0], threading.Lock()

    def slow(x):
        with lock:
            busy[0] += 1
            most[0] = max(most[0], busy[0])
        time.sleep(0.02 + 0.02 * (x % 3))
        with lock:
            busy[0] -= 1
        return -x

    t = time.monotonic()
    assert list(ledger.in_order(range(60), slow, 20)) == [(x, -x) for x in range(60)]
    assert time.monotonic() - t < 60 * 0.04 / 4 and 10 < most[0] <= 20


def test_answers_under_way_are_kept_when_a_call_fails():
    def call(x):
        time.sleep(0.05)
        if x == 3:
            raise ConnectionError("gone")
        return x

    got = []
    with pytest.raises(ConnectionError):
        for x, _ in ledger.in_order(range(100), call, 4):
            got.append(x)
    assert got == [0, 1, 2, 4, 5, 6]


def test_pace():
    waits = []
    pace = ledger._Pace(100.0, waits.append)
    for _ in range(5):
        pace()
    assert len(waits) == 4 and all(0 < w <= 0.041 for w in waits)


def test_a_service_that_asks_for_a_pause_is_given_one():
    begun, refused = [], []

    def call(x):
        begun.append(time.monotonic())
        if x == 5 and not refused:
            refused.append(time.monotonic())
            raise ledger.SlowDown(0.4)
        time.sleep(0.01)
        return x

    pace = ledger._Pace(200.0)
    got = list(ledger.in_order([(None, x) for x in range(30)], lambda r: ledger._asked(r, call, pace), 4, pace))
    assert [r[0] for _, r in got] == list(range(30))
    late = [t for t in begun if refused[0] < t < refused[0] + 0.35]
    assert len(late) <= 4  # those that had begun or were let through before
    with pytest.raises(ledger.SlowDown):
        external.Retry(lambda s, u: (_ for _ in ()).throw(ledger.SlowDown(1)), sleep=lambda s: None)("s", "u")


def test_a_task_that_is_run_again_reads_its_own_answers(monkeypatch, tmp_path):
    monkeypatch.setattr(ledger.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 7))
    batch = pa.RecordBatch.from_pydict({"_digest": [f"d{i}" for i in range(10)], "system_prompt": ["s"] * 10, "user_prompt": [str(i) for i in range(10)]})
    asked = []

    def call(system, user, last=6):
        if int(user) > last:
            raise ConnectionError
        asked.append(int(user))
        return None if user == "2" else f"a{user}"

    run = lambda f: list(ledger._ask(iter([batch]), f, str(tmp_path), "job", 1, None, 4))
    with pytest.raises(ConnectionError):
        run(call)
    assert asked == list(range(7)) and not [f for f in (tmp_path / "job/000007").iterdir() if f.name.startswith("_")]
    run(lambda s, u: call(s, u, 99))
    assert asked[7:] == [2, 7, 8, 9]  # what had no answer, and the rest
    rows = [r for f in (tmp_path / "job/000007").iterdir() for r in pq.read_table(f).to_pylist()]
    assert sorted(r["digest"] for r in rows) == sorted(f"d{i}" for i in range(10) if i != 2)


def test_first_writer_wins(spark, tmp_path):
    at = datetime(2026, 1, 1, tzinfo=UTC)
    rows = [("d", "late", 1.0, at, at + timedelta(seconds=2), "x"), ("d", "early", 1.0, at, at + timedelta(seconds=1), "y"), ("e", "only", 1.0, at, at, "x")]
    for k, r in enumerate(rows):
        (tmp_path / f"{k}").mkdir()
        files.add_table(str(tmp_path / f"{k}"), pa.Table.from_pylist([dict(zip(ledger._SCHEMA.names, r, strict=True))], ledger._SCHEMA), "answers")
    assert {r.digest: r.response for r in ledger.answers(spark, str(tmp_path)).collect()} == {"d": "early", "e": "only"}
    assert ledger.entries(spark, str(tmp_path / "none")).count() == 0


def test_a_request_is_what_it_asks_for(spark, tmp_path):
    path, calls = str(tmp_path / "l"), spark.sparkContext.accumulator(0)

    def call(system, user):
        calls.add(1)
        return f"answer to {user}"

    d = _reqs(spark)
    got = {r.custom_id: r.response for r in ledger.ask(d, call, path, "m", window=3).collect()}
    assert got == {f"r{i}": f"answer to text {i}" for i in range(20)} and calls.value == 20
    ledger.ask(d.withColumn("user_prompt", F.when(F.col("pos") == 3, "new").otherwise(F.col("user_prompt"))), call, path, "m").collect()
    assert calls.value == 21
    ledger.ask(d, call, path, "other").collect()
    assert calls.value == 41
    assert ledger.ask(d.limit(0), call, path, "m").count() == 0


def test_rate_of_all_tasks(spark, tmp_path):
    t = time.monotonic()
    d = _reqs(spark, 24).repartition(4)
    ledger.ask(d, lambda s, u: "x", str(tmp_path / "l"), window=4, rate=20.0).collect()
    first = ledger.entries(spark, str(tmp_path / "l")).agg(F.min("start_time"), F.max("start_time")).first()
    assert time.monotonic() - t > 0.5 and (first[1] - first[0]).total_seconds() > 0.5


def test_raw_copies(spark, tmp_path):
    src = tmp_path / "in"
    (src / "a").mkdir(parents=True)
    (src / "a" / "x.jsonl").write_bytes(b"\x00\xff" * 3_000_000)
    (src / "y z%20é.jsonl").write_bytes(b"1")
    (src / "empty").write_bytes(b"")
    writers.keep_raw(spark, str(src), str(tmp_path / "out"))
    assert (tmp_path / "out/a/x.jsonl").read_bytes() == b"\x00\xff" * 3_000_000 and (tmp_path / "out/y z%20é.jsonl").read_bytes() == b"1"
    assert not (tmp_path / "out/empty").exists()
    (src / "a" / "x.jsonl").write_bytes(b"new")
    writers.keep_raw(spark, str(src), str(tmp_path / "out"))
    assert (tmp_path / "out/a/x.jsonl").stat().st_size == 6_000_000  # a whole copy stays
    (tmp_path / "out/_COPIED").unlink()
    writers.keep_raw(spark, str(src), str(tmp_path / "out"))  # one that isn't marked as whole is done again
    assert (tmp_path / "out/a/x.jsonl").read_bytes() == b"new"
    with pytest.raises(ValueError, match="itself"):
        writers.keep_raw(spark, str(src), f"{src}/")
    assert (src / "a" / "x.jsonl").exists()


def test_files_by_executors(spark, tmp_path):
    rows = [(f"p{i}", f"p{i}.json", f"text é {i}\r\n") for i in range(200)]
    d = spark.createDataFrame(rows, "stem string, name string, text string").repartition(5)
    files.write_text_files(d, str(tmp_path / "o"), 4)
    for stem, name, text in rows:
        assert (tmp_path / "o" / files.folder_of(stem, 4) / name).read_bytes() == text.encode()
    assert sum(1 for x in (tmp_path / "o").rglob("*.json")) == 200 and (tmp_path / "o/_SUCCESS").exists()
    with pytest.raises(FileExistsError):
        files.write_text_files(d, str(tmp_path / "o"), 4)


def test_files_of_a_failed_write_are_gone(spark, tmp_path):
    d = spark.range(100).select(F.concat(F.lit("p"), "id").alias("stem"), F.concat(F.lit("p"), "id").alias("name"), F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.lit("x")).alias("text"))
    with pytest.raises(Exception, match="broken"):
        files.write_text_files(d, str(tmp_path / "o"), 4)
    assert not list((tmp_path / "o").rglob("p*")) and not list((tmp_path / "o").glob("_attempt*"))


def test_export_of_clashing_names(spark, tmp_path):
    log = spark.createDataFrame([(1, "a/b", "x"), (2, "a_b", "y")], "pos long, problem_id string, generated_code string")
    with pytest.raises(ValueError, match="same file name"):
        writers.export_files(log, str(tmp_path / "o"))
    assert writers.export_files(log.limit(0), str(tmp_path / "none")) == 1
    assert writers.export_files(spark.createDataFrame([(1, None, ""), (2, ".x", "c"), (3, ".x", "d")], log.schema), str(tmp_path / "p")) == 1
    assert {x.name: x.read_text() for x in (tmp_path / "p/part-00000").iterdir() if x.suffix == ".lean"} == {"_x.lean": "d"}


def test_a_bulk_run_submits_once(spark, tmp_path):
    class Lost:
        jobs = 0

        def submit(self, path):
            Lost.jobs += 1
            return f"job-{Lost.jobs}"

        def status(self, job):
            return {"status": "expired"}

    d = spark.createDataFrame([(1, "a", "one", "")], "pos long, problem_id string, problem string, solution string")
    for _ in range(3):
        with pytest.raises(RuntimeError, match="job-1: expired"):
            runs.run_batch(d, "S", Lost(), lambda c: (True, ""), str(tmp_path / "b"), "m", interval=0.0, most=1.0, sleep=lambda s: None)
    assert Lost.jobs == 1 and runs.batch_id(spark, str(tmp_path / "b"), "run") == "job-1" and runs.batch_id(spark, str(tmp_path / "b"), "x") is None


def test_each_program_is_checked_once(spark, tmp_path):
    checks = spark.sparkContext.accumulator(0)

    def check(code):
        checks.add(1)
        return len(code) > 1, f"said {code}"

    rows = [(i, "r" if i % 5 else None, ["", "a", "bb", "ccc", None][i % 4 if i % 7 else 4], 0) for i in range(300)]
    d = spark.createDataFrame(rows, "pos long, response string, generated_code string, compilation int").repartition(4)
    for n in (4, 4):
        got = verdicts.validate_once(d, check, str(tmp_path / "s"), "v1").collect()
        assert checks.value == n and len(got) == 300
    for r in got:
        code = rows[r.pos][2] or ""
        assert (r.compilation is None) == (rows[r.pos][1] is None) and (r.compilation is None or (r.compilation.success, r.compilation.output) == (len(code) > 1, f"said {code}"))
    verdicts.validate_once(d, check, str(tmp_path / "s"), "v2").collect()
    assert checks.value == 8  # another validator's verdicts are its own
    assert verdicts.validate_once(d.limit(0), check, str(tmp_path / "s"), "v1").count() == 0


def _matched_slowly(code):
    """Steps by a search through all markers for each end."""
    markers = [(m.start(), m.end(), m[1], m[2]) for m in re.finditer(r"--\s*\[(?:STEP_(\d+):|END_STEP_(\d+)\])", code)]
    closer = {}
    for k, (_, _, _, end) in enumerate(markers):
        if end is not None:
            free = [j for j in range(k) if markers[j][2] == end and j not in closer]
            if free:
                closer[free[-1]] = k
    out, closed = [], set(closer.values())
    for k, (a, b, start, end) in enumerate(markers):
        if start is not None:
            over = lambda j, at: j not in closer or closer[j] > at
            depth = sum(markers[j][2] is not None and over(j, k) for j in range(k))
            at = closer.get(k)
            inner = at is not None and any(markers[j][2] is not None and over(j, at) for j in range(k + 1, at))
            out.append((start, a, None if at is None else markers[at][1], depth, "no end" if at is None else "crossing" if inner else "closed"))
        elif k not in closed:
            out.append((end, None, b, None, "no start"))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["-- [STEP_1: a]", "--[STEP_2:", "-- [STEP_3: x", "-- [END_STEP_1]", "--\n[END_STEP_2]", "-- [END_STEP_3]", "word", "[STEP_1:", "-- [STEP_x:", "-- [STEP_٣:", "-- [END_STEP_٣]"]), max_size=30))
def test_steps_are_matched(parts):
    code = " ".join(parts)
    assert steps.matched(code) == _matched_slowly(code)


def test_step_structure(spark):
    d = spark.createDataFrame([("a", "-- [STEP_1: x]\n-- [STEP_2: y]\n-- [END_STEP_1]\n-- [END_STEP_2]\n-- [END_STEP_9]", 1), ("b", None, 2), ("c", "", 3)], "problem_id string, generated_code string, other int")
    got = [tuple(r) for r in steps.step_structure(d).orderBy("problem_id", "place").collect()]
    assert got == [("a", 0, "1", 0, 45, 0, "crossing"), ("a", 1, "2", 15, 61, 1, "closed"), ("a", 2, "9", None, 77, None, "no start")]


def test_jobs_settle_as_they_are_polled(spark):
    said = {1: ["in_progress", None, "completed"], 2: ["validating", "failed", "completed"], 3: ["cancelled"], 4: ["in_progress"] * 9 + ["completed"], 5: [None], 6: ["in_progress"] * 4 + ["expired"]}
    looks = spark.createDataFrame([(j, k, s, 1, 3) for j, x in said.items() for k, s in enumerate(x)], "job int, look int, status string, completed long, total long")
    got = {r.job: (r.status, r.progress) for r in runs.settled_jobs(looks, 60, 300).collect()}

    class Fixed:
        def __init__(self, x):
            self.x = list(x)

        def status(self, job):
            s = self.x.pop(0) if self.x else "in_progress"
            if s is None:
                raise ConnectionError("no answer")
            return {"status": s, "request_counts": {"total": 3, "completed": 1}}

    for j, x in said.items():
        status, last = runs.poll(Fixed(x), "j", 60, 300, sleep=lambda s: None)
        assert got[j] == (status, runs.progress(last["request_counts"]) if status != "timeout" else None)
