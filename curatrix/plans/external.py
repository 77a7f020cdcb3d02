"""Calls to the world outside, by row: text generators and code validators, run in Arrow batches on the executors.

Results should be written down before anything counts them, so that no action calls twice. A task that is run again calls
again: generators and validators must bear that.
"""

from __future__ import annotations

import contextlib
import subprocess
import tempfile
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import partial
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

Generator = Callable[[str, str], "str | None"]
Validator = Callable[[str], "tuple[bool, str]"]

# Attempts at a call and the first pause between them in seconds, and the time that a build may take.
ATTEMPTS, PAUSE, BUILD_SECONDS = 3, 2, 60


@dataclass(frozen=True)
class Retry:
    """Calls a generator up to ``attempts`` times with doubling pauses; None when all have failed."""

    inner: Generator
    attempts: int = ATTEMPTS
    pause: float = PAUSE
    sleep: Callable[[float], None] = time.sleep

    def __call__(self, system: str, user: str) -> str | None:
        for k in range(self.attempts):
            try:
                return self.inner(system, user)
            except Exception as e:
                if hasattr(e, "seconds"):  # the service asks for a pause: see ledger.SlowDown
                    raise
                if k + 1 < self.attempts:
                    self.sleep(self.pause * 2**k)
        return None


@dataclass(frozen=True)
class CommandValidator:
    """Runs a command on a file with the code in a folder of its own; success is exit code 0, anything raised is a failure with its message."""

    command: tuple[str, ...]
    suffix: str = ".lean"
    seconds: float = BUILD_SECONDS

    def __call__(self, code: str) -> tuple[bool, str]:
        try:
            with tempfile.TemporaryDirectory() as d:
                f = Path(d, f"Main{self.suffix}")
                f.write_text(code)
                done = subprocess.run([x.format(file=str(f)) for x in self.command], cwd=d, capture_output=True, text=True, timeout=self.seconds)
                return done.returncode == 0, done.stdout + done.stderr
        except Exception as e:
            return False, str(e)


# The project that a standalone check builds, and the line that takes in the library of mathematics.
LAKEFILE = "import Lake\nopen Lake DSL\n\npackage Check\n\n@[default_target]\nlean_exe Main\n"
MATHLIB = 'require mathlib from git "https://github.com/leanprover-community/mathlib4" @ "master"'


@dataclass(frozen=True)
class ProjectCheck:
    """Builds a program as a project of its own: a scaffold in ``workdir`` (a temporary folder if None), updated first if it takes in the
    library, then built, then run if asked. ``build``, ``update`` and ``binary`` can be replaced."""

    workdir: str | None = None
    mathlib: bool = False
    run: bool = False
    build: tuple[str, ...] = ("lake", "build")
    update: tuple[str, ...] = ("lake", "update")
    binary: str = ".lake/build/bin/Main"

    def scaffold(self, root: Path, program: str) -> None:
        root.mkdir(parents=True, exist_ok=True)
        (root / "lakefile.lean").write_text(f"{MATHLIB}\n{LAKEFILE}" if self.mathlib else LAKEFILE)
        (root / "Main.lean").write_text(program)

    def __call__(self, program: str) -> tuple[int, str, str]:
        """(exit code, what the build said, what the program said): the first step that fails ends it."""
        with contextlib.ExitStack() as held:
            root = Path(self.workdir or held.enter_context(tempfile.TemporaryDirectory())).resolve()
            self.scaffold(root, program)
            do = lambda *command: subprocess.run(command, cwd=root, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, text=True)
            if self.mathlib and (first := do(*self.update)).returncode:
                return first.returncode, first.stdout, ""
            built = do(*self.build)
            if built.returncode or not self.run:
                return built.returncode, built.stdout, ""
            if not (root / self.binary).exists():
                return 0, built.stdout, "no program was built; it needs a `def main`"
            ran = do(str(root / self.binary))
            return ran.returncode, built.stdout, ran.stdout


ROWS = 64  # that are Python values at a time, and go back together


def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of up to ROWS rows, copied, so that no batch of the engine's, which may be thousands of long texts, is held while the next one is read."""
    for b in batches:
        for k in range(0, b.num_rows, ROWS):
            yield b.take(pa.array(range(k, min(k + ROWS, b.num_rows)), pa.int64()))
        del b


def _column(b: pa.RecordBatch, name: str) -> list:
    return b.column(b.schema.get_field_index(name)).to_pylist()


_ANSWER = StructType().add("response", "string").add("call_seconds", "double").add("start_time", "timestamp")


def _generate(batches: Iterator[pa.RecordBatch], call: Generator) -> Iterator[pa.RecordBatch]:
    for b in few(batches):
        out, took, began = [], [], []
        for s, u in zip(_column(b, "system_prompt"), _column(b, "user_prompt"), strict=True):
            began.append(datetime.now(UTC))
            t = time.monotonic()
            out.append(call(s, u))
            took.append(round(time.monotonic() - t, 2))
        made = [pa.array(out, pa.string()), pa.array(took, pa.float64()), pa.array(began, pa.timestamp("us", "UTC"))]
        yield pa.RecordBatch.from_arrays([*b.columns, *made], [*b.schema.names, *_ANSWER.names])


def generate(requests: DataFrame, call: Generator) -> DataFrame:
    """requests (system_prompt, user_prompt, ...) with response, call_seconds and start_time. Each row is one call, or more if the plan
    that holds it is run more than once: write it down before it is used twice."""
    d = requests.drop(*_ANSWER.names)
    return d.mapInArrow(partial(_generate, call=call), StructType([*d.schema.fields, *_ANSWER.fields]))


def _validate(batches: Iterator[pa.RecordBatch], check: Validator) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("success", pa.bool_()), ("duration_seconds", pa.float64()), ("output", pa.string())])
    for b in few(batches):
        out = []
        for response, code in zip(_column(b, "response"), _column(b, "generated_code"), strict=True):
            if not response:
                out.append(None)
                continue
            t = time.monotonic()
            ok, said = check(code)
            out.append({"success": bool(ok), "duration_seconds": round(time.monotonic() - t, 2), "output": said})
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, kind)], [*b.schema.names, "compilation"])


def validate(df: DataFrame, check: Validator) -> DataFrame:
    """df (response, generated_code, ...) with compilation; rows without a response are not checked and have null."""
    d = df.drop("compilation")
    kind = StructType([*d.schema.fields]).add("compilation", StructType().add("success", "boolean").add("duration_seconds", "double").add("output", "string"))
    return d.mapInArrow(partial(_validate, check=check), kind)
