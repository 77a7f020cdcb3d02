"""Command lines: process, convert, check, status, retrieve. Services are given as ``module:name``."""

from __future__ import annotations

import argparse
import importlib
import sys
from datetime import UTC, datetime

from pyspark.sql import functions as F

from .functions.text import axiom_lines, check_program, has_placeholder
from .operators.curate import preview
from .operators.places import fresh, with_file_place
from .operators.requests import EFFORT, EFFORTS
from .plans import external, runs
from .session import build_session
from .sources import readers, writers
from .sources.files import remove


def _load(spec: str):
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="curatrix")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("process", help="generate and validate code for problems")
    a.add_argument("input_file")
    a.add_argument("--input-format", choices=("json", "parts", "lines", "table"), default="json", help="one document, one in files, JSON lines, Parquet")
    a.add_argument("--api-key")
    a.add_argument("--model", default="default")
    a.add_argument("--system-prompt")
    a.add_argument("--dataset-dir", default="dataset")
    a.add_argument("--max-problems", type=int)
    a.add_argument("--reasoning-effort", choices=EFFORTS, default=EFFORT)
    a.add_argument("--no-skip-geometry", action="store_true")
    a.add_argument("--batch", action="store_true")
    a.add_argument("--service", required=True, help="module:name of a generator, or of a transport with --batch")
    a.add_argument("--validator", default="lake env lean {file}", help="a command, or module:name")
    a.add_argument("--verdicts", help="folder of verdicts by program: each distinct program is checked once, over all runs with the same validator")
    a.add_argument("--run-id", help="the run's name in the dataset's folders; the time in UTC if not given. A run that is named again goes on")
    a.add_argument("--window", type=int, default=1, help="calls that are under way in a task")
    a.add_argument("--rate", type=float, help="calls a second of all tasks together, at most")
    a.add_argument("--export", action="store_true", help="also a .json and a .lean file for each problem; for small runs")
    a.add_argument("--manifest-in-summary", action="store_true", help="the summary holds the manifest in one row; for small runs")
    a = sub.add_parser("convert", help="rows of a table whose score is one, as JSON")
    a.add_argument("input")
    a.add_argument("-o", "--output")
    a.add_argument("--pretty", action="store_true")
    a.add_argument("--records", action="store_true", help="records are what is written in any case")
    a.add_argument("--lines", action="store_true", help="JSON lines instead of one array")
    a.add_argument("--single-file", action="store_true", help="output is one file, not a folder whose files make the document")
    a.add_argument("--max-rows", type=int)
    a.add_argument("--info", action="store_true")
    a.add_argument("--hf", action="store_true", help="input is a downloaded dataset: input/config/split")
    a.add_argument("--hf-split", default="train")
    a.add_argument("--hf-config")
    a = sub.add_parser("check", help="build one piece of code; exit 1: not built, 3: unfinished")
    g = a.add_mutually_exclusive_group(required=True)
    g.add_argument("--file")
    g.add_argument("--code")
    a.add_argument("--axioms", nargs="*", default=[])
    a.add_argument("--run", action="store_true", help="run what was built")
    a.add_argument("--workdir", help="folder of the project, made if missing; a temporary one if not given")
    a.add_argument("--with-mathlib", action="store_true")
    a.add_argument("--command", dest="build", help="a command on {file} instead of a project of its own")
    a = sub.add_parser("status", help="what a bulk job is doing")
    a.add_argument("batch_id")
    a.add_argument("--api-key")
    a.add_argument("--service", required=True)
    a = sub.add_parser("retrieve", help="results of a bulk job")
    a.add_argument("batch_id")
    a.add_argument("--output-dir", required=True)
    a.add_argument("--api-key")
    a.add_argument("--service", required=True)
    a.add_argument("--process", action="store_true")
    a.add_argument("--validator", default="lake env lean {file}")
    return p


def _shown(field: str, value) -> str:
    """Times, which come as seconds, as ISO text."""
    return datetime.fromtimestamp(value, UTC).isoformat() if field.endswith("_at") and isinstance(value, int | float) else str(value)


def _service(a):
    """What --service names. A class is made with the key (given, or of the environment; none raises), the model and the effort."""
    s = _load(a.service)
    if not isinstance(s, type):
        return s
    return s(api_key=readers.api_key(a.api_key), model=getattr(a, "model", None), reasoning_effort=getattr(a, "reasoning_effort", None))


def _validator(spec: str):
    return external.CommandValidator(tuple(spec.split())) if "{file}" in spec else _load(spec)


def main(argv: list[str] | None = None, spark=None) -> int:
    a = parser().parse_args(argv)
    if a.command == "convert" and a.info and a.hf:
        print("--info is for files, not for downloaded datasets", file=sys.stderr)
        return 1
    if a.command == "status":
        try:
            s = _service(a).status(a.batch_id)
        except Exception as e:
            print(f"error: {e}", file=sys.stderr)
            return 1
        print(s.get("status"), runs.progress(s.get("request_counts")))
        for field in ("id", "created_at", "completed_at", "failed_at", "output_file_id", "error_file_id", "errors"):
            if s.get(field) is not None:
                print(f"{field}: {_shown(field, s[field])}")
        return 0
    spark = spark or build_session()
    try:
        return globals()[f"_{a.command}"](a, spark)
    except Exception as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


def _problems(a, spark):
    if a.input_format == "lines":
        return readers.problems_lines(spark, a.input_file)
    if a.input_format == "table":
        place = "pos"
        df = readers.parquet(spark, a.input_file)
        return readers.problems_table(with_file_place(df.drop(place), place, 1), place)
    return readers.problems_json(spark, a.input_file, parts=a.input_format == "parts")


def _process(a, spark) -> int:
    began = datetime.now(UTC)
    problems, prompt, service = _problems(a, spark), readers.system_prompt(spark, a.system_prompt), _service(a)
    check, skip, run_id = _validator(a.validator), not a.no_skip_geometry, a.run_id or began.strftime("%Y%m%d_%H%M%S")
    if a.batch:
        log = runs.run_batch(problems, prompt, service, check, a.dataset_dir, a.model, a.max_problems, skip, effort=a.reasoning_effort, run_id=run_id, store=a.verdicts, name=a.validator)
    else:
        call = external.Retry(service)
        log = runs.run_sync(problems, prompt, call, check, a.dataset_dir, a.max_problems, skip, model=a.model, run_id=run_id, effort=a.reasoning_effort, window=a.window, rate=a.rate, store=a.verdicts, name=a.validator)
    fields = {"timestamp": run_id, "start_time": began.isoformat(), "end_time": datetime.now(UTC).isoformat(), "model": a.model, "reasoning_effort": a.reasoning_effort, "skip_complex_geometry": skip, "system_prompt_file": a.system_prompt, "input_file": a.input_file, "max_problems": a.max_problems, "batch_mode": a.batch}
    if a.batch:
        fields["batch_id"] = runs.batch_id(spark, a.dataset_dir, run_id)
    runs.write_summary(log, f"{a.dataset_dir}/runs/{run_id}", a.manifest_in_summary, **fields)
    writers.code_files(log, f"{a.dataset_dir}/code/run_id={run_id}")
    if a.export:
        remove(spark, f"{a.dataset_dir}/files/{run_id}")  # of the same run, when it goes on
        writers.export_files(log, f"{a.dataset_dir}/files/{run_id}")
    return 0


def _convert(a, spark) -> int:
    if a.info:
        for r in readers.table_info(spark, a.input).orderBy("ordinal").collect():
            print(r.n_rows, r.n_bytes, r.column_name, r.column_type, r.physical_type)
        preview(spark.read.parquet(a.input)).show()
        return 0
    df = readers.hosted_dataset(spark, a.input, a.hf_split, a.hf_config) if a.hf else readers.parquet(spark, a.input)
    place = fresh(df.columns, "_place")  # the order of the input: no column of the user's is taken for it
    d = runs.export_scored(with_file_place(df, place), a.max_rows, order=place)
    if not a.output:
        for r in writers.json_document(d, place, a.pretty).orderBy("_at").select("line").toLocalIterator():
            print(r.line)
        return 0
    folder = f"{a.output}.parts" if a.single_file else a.output
    if a.lines:
        writers.json_lines(d.drop(place), folder, "overwrite")
    else:
        writers.write_json_document(d, folder, place, a.pretty)
    if a.single_file:
        writers.merge_files(spark, folder, a.output)
        remove(spark, folder)
    return 0


def _check(a, spark) -> int:
    """0: built, and run if asked; 3: built with an unfinished proof; else what the step that failed gave."""
    program = readers.code(spark, a.file, a.code).select(check_program("code", a.axioms).alias("c")).first().c
    if a.build:
        ok, said = external.CommandValidator(tuple(a.build.split()))(program)
        status, output = int(not ok), ""
    else:
        status, said, output = external.ProjectCheck(a.workdir, a.with_mathlib, a.run)(program)
    r = spark.createDataFrame([(said,)], "o string").select(has_placeholder("o").alias("sorry"), axiom_lines("o").alias("axioms")).first()
    print(*(x for x in (said, output, *r.axioms) if x), sep="\n")
    return status or (3 if r.sorry else 0)


def _retrieve(a, spark) -> int:
    runs.retrieve_to(spark, _service(a).results(a.batch_id), a.output_dir, _validator(a.validator) if a.process else None)
    return 0


if __name__ == "__main__":
    sys.exit(main())
