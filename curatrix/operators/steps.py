"""How a program's step markers nest: which end closes which start, and which have no other side."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# The markers of a step, as step_check() counts them.
_MARKER = re.compile(r"--\s*\[(?:STEP_(\d+):|END_STEP_(\d+)\])")
CLOSED, CROSSING, NO_END, NO_START = "closed", "crossing", "no end", "no start"


def matched(code: str) -> list[tuple[str, int | None, int | None, int | None, str]]:
    """(step, start, end, depth, state) of each step, in the order of its first marker, in one pass over the markers.

    An end closes the last open start of its number: ``closed`` if nothing that began later is open, else ``crossing``. A start
    that is never closed has ``no end``, an end that finds no start has ``no start``. start is where the first marker begins,
    end where the last one ends, in characters; depth is how many steps are open around a start.
    """
    out: list[list] = []
    open_: list[int] = []  # places in out, inner ones last; closed ones go when they come to the end
    of: dict[str, list[int]] = {}
    n_open = 0
    for m in _MARKER.finditer(code):
        begun, ended = m.groups()
        if begun is not None:
            of.setdefault(begun, []).append(len(out))
            open_.append(len(out))
            out.append([begun, m.start(), None, n_open, NO_END])
            n_open += 1
        elif of.get(ended):
            at = of[ended].pop()
            out[at][2], out[at][4] = m.end(), CLOSED if open_[-1] == at else CROSSING
            n_open -= 1
            while open_ and out[open_[-1]][4] != NO_END:
                open_.pop()
        else:
            out.append([ended, None, m.end(), None, NO_START])
    return [tuple(x) for x in out]


_STEP = StructType().add("place", "integer").add("step", "string").add("start", "integer").add("end", "integer").add("depth", "integer").add("state", "string")


def _steps(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())
    for b in batches:
        at = b.schema.get_field_index(column)
        found, rows = [], []
        for k, code in enumerate(b.column(at).to_pylist()):
            own = matched(code or "")
            found += [(i, *x) for i, x in enumerate(own)]
            rows += [k] * len(own)
        kept = [c for i, c in enumerate(b.columns) if i != at]
        names = [n for i, n in enumerate(b.schema.names) if i != at]
        columns = zip(*found, strict=True) if found else [[]] * len(kinds)
        taken = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([*(c.take(taken) for c in kept), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], [*names, *_STEP.names])


def step_structure(df: DataFrame, code: str = "generated_code", keep: tuple[str, ...] = ("problem_id",)) -> DataFrame:
    """(keep ..., place, step, start, end, depth, state): a row for each step of each row's code, see matched(). A null code has none. Columns
    in ``keep`` must not have the names of these."""
    d = df.select(*keep, code)
    return d.mapInArrow(partial(_steps, column=code), StructType([*(d.schema[c] for c in keep), *_STEP.fields]))
