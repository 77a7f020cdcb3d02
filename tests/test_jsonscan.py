"""One JSON document cut by many tasks, against a reader of the whole document."""

import json
import random

import pytest
from pyspark.sql import functions as F

from curatrix.sources import jsonscan, readers, writers


@pytest.fixture
def ranges(spark):
    """Sets the bytes of a range."""

    def of(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield of
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _value(rnd, depth=0):
    kind = rnd.randrange(9 if depth < 3 else 6)
    if kind < 4:
        return "".join(rnd.choices(['"', "\\", "{", "}", "[", "]", ",", "é", "日", "x", " ", "\n", "/"], k=rnd.randrange(12)))
    if kind < 6:
        return rnd.choice([None, True, 3, -1.5e9])
    if kind == 6:
        return [_value(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return {f"k{i}": _value(rnd, depth + 1) for i in range(rnd.randrange(4))}


def _records(n, seed):
    rnd = random.Random(seed)
    return [{"problem": _value(rnd), "solution": _value(rnd), "m": _value(rnd)} for _ in range(n)]


def _read(spark, path, parts=False):
    rows = jsonscan.json_records(spark, path, parts).orderBy("doc", "pos").collect()
    docs = {}
    for r in rows:
        assert r.pos == len(docs.setdefault(r.doc, [])) + 1
        docs[r.doc].append(json.loads(r.record))
    return [docs[d] for d in sorted(docs)]


def test_arrays(spark, tmp_path, ranges):
    records = _records(25, 1)
    ranges(97)
    for k, text in enumerate((json.dumps(records), json.dumps(records, ensure_ascii=False, indent=3), " \n" + json.dumps(records, separators=(",", ":")) + "\n\n", "﻿" + json.dumps(records))):
        (tmp_path / f"{k}.json").write_text(text, encoding="utf-8")
        assert _read(spark, str(tmp_path / f"{k}.json")) == [records]
    for n in (800, 1 << 20):
        ranges(n)
        assert _read(spark, str(tmp_path)) == [records] * 4


@pytest.mark.parametrize("n", [3, 8])
def test_small_documents(spark, tmp_path, ranges, n):
    ranges(n)
    for k, (text, want) in enumerate([("[]", []), (" [ \n] ", []), ('{"a": "}"}', [[{"a": "}"}]]), ('{"a":{"b":[{}]}}\n', [[{"a": {"b": [{}]}}]]), ("[{}]", [[{}]]), ('[{"a":"\\\\"},{"b":"\\""}]', [[{"a": "\\"}, {"b": '"'}]])]):
        (tmp_path / f"{k}.json").write_text(text)
        assert _read(spark, str(tmp_path / f"{k}.json")) == want, text


@pytest.mark.parametrize("text", ['[{"a":1}', '[{"a":1', '{"a":"x', '[{"a":1},', "[1, 2]", '[{"a":1}, 2]', '[{"a":1} {"b":2}]', '["x", {"a":1}]', '[[{"a":1}]]', "x", '[{"a":1}]]', '{"a":1', '[,{"a":1}]'])
def test_broken_documents(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception, match="no array of objects|not a whole JSON document|no JSON array"):
        jsonscan.json_records(spark, str(tmp_path / "x.json")).collect()


def test_parts_make_one_document(spark, tmp_path, ranges):
    ranges(120)
    rows = [(i, json.dumps(r)) for i, r in enumerate(_records(30, 2))]
    d = spark.createDataFrame(rows, "pos long, record string").repartition(4)
    writers.write_lines(writers.array_lines(d, "pos", F.col("record")), str(tmp_path / "parts"))
    assert _read(spark, str(tmp_path / "parts"), parts=True) == [[json.loads(r) for _, r in rows]]


def test_problems_of_many_tasks(spark, tmp_path, ranges):
    ranges(50)
    records = [{"problem": "a"}, {"problem_id": None, "problem": None, "solution": "s", "metadata": {"k": [1]}}, {"problem_id": 7}] * 5
    (tmp_path / "p.json").write_text(json.dumps(records))
    got = readers.problems_json(spark, str(tmp_path / "p.json")).withColumn("metadata", F.to_json("metadata")).orderBy("pos").collect()
    assert [tuple(r) for r in got[:3]] == [(1, "problem_1", "a", "", "{}"), (2, "problem_2", None, "s", '{"k":[1]}'), (3, "7", "", "", "{}")]
    assert [r.pos for r in got] == list(range(1, 16))


def test_ranges_that_change_between_readings(spark, tmp_path):
    start = {("f", 0): jsonscan._Start(0, 1, 0, 0, 0, 5, False, 3)}
    sent = type("Sent", (), {"value": start})
    import pyarrow as pa

    lines = pa.RecordBatch.from_pydict({"value": ['[{"a":1', "]"], "file": ["f", "f"], "start": [0, 0], "size": [9, 9]})
    with pytest.raises(ValueError, match="other ranges"):
        list(jsonscan._cut(iter([lines]), sent))
