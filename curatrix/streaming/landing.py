"""Bulk output that arrives file by file, as a stream: the form of waiting for results that needs no polling loop.

Of each request the line counts that is the last one by file name and place in the file, whenever its file arrives. Where it stands is
kept in the table of what has landed. Lines that can't be read go to a table of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import extract_code, step_check
from ..schemas import RESPONSE_LINE

_LINE = "file string, block long, place long, line string"
_GOOD, _BAD = "answer", "broken"
_OUT = "kind string, custom_id string, content string, line string, file string, block long, place long"


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their place in the range of their file that is being read; blank ones count, and go."""
    at, n = None, 0
    for b in batches:
        places = []
        for key in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            n = n + 1 if key == at else 0
            at = key
            places.append(n)
        out = pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(places, pa.int64()), b.column(0)], ["file", "block", "place", "line"])
        yield out.filter(pc.not_equal(pc.utf8_trim_whitespace(b.column(0)), ""))


def response_stream(spark: SparkSession, folder: str, files_at_once: int | None = None) -> DataFrame:
    """(kind, custom_id, content, line, file, block, place) of each line of the files that come into a folder. A line that is no JSON, or lacks
    its id or its response, is ``broken`` and has its text; others are an ``answer``, with no content where the call failed."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_at_once) if files_at_once else spark.readStream
    raw = reader.format("text").load(folder)
    raw = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    d = raw.mapInArrow(_placed, _LINE)
    j = F.from_json("line", f"{RESPONSE_LINE}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    d = d.withColumn("j", j)
    bad = F.col("j").isNull() | F.col("j._corrupt").isNotNull() | F.col("j.response").isNull() | F.col("j.custom_id").isNull()
    text = F.get(F.col("j.response.body.choices"), F.lit(0)).getField("message").getField("content")
    return d.select(
        F.when(bad, _BAD).otherwise(_GOOD).alias("kind"),
        F.when(~bad, F.col("j.custom_id")).alias("custom_id"),
        F.when(~bad & (F.col("j.response.status_code") == 200), text).alias("content"),
        F.when(bad, F.col("line")).alias("line"),
        "file",
        "block",
        "place",
    )


def last_lines(answers: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Of each request the last one of these lines, if none of ``before`` (custom_id, file, block, place) stands at its place or after it."""
    place = F.struct("file", "block", "place")
    last = answers.groupBy("custom_id").agg(F.max_by(F.struct("content", "line", "file", "block", "place"), place).alias("_last")).select("custom_id", "_last.*")
    if before is None:
        return last
    known = before.select(F.col("custom_id").alias("_of"), place.alias("_at"))
    return last.join(known, (last["custom_id"] == known["_of"]) & (known["_at"] >= F.struct(*(last[c] for c in ("file", "block", "place")))), "left_anti")


def land(spark: SparkSession, folder: str, out: str, checkpoint: str, files_at_once: int | None = None) -> StreamingQuery:
    """Take in what is there now, each file once over all runs with the same checkpoint, and stop. Read with landed() and broken().

    Each batch writes its changes into folders by its number, so a batch that is run again after a failure replaces its own: a request's
    line whenever a later one than all before has come, and each broken line. What earlier batches have written is the state: their
    ids and places are read again and joined, without the contents, so that nothing is held in memory from batch to batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            batch.where(F.col("kind") == _BAD).drop("kind").write.mode("overwrite").parquet(f"{out}/{_BAD}/batch={number}")
            before = _changes(batch.sparkSession, out, _GOOD).where(F.col("batch") < number) if number else None
            last = last_lines(batch.where(F.col("kind") == _GOOD), before)
            last.write.mode("overwrite").parquet(f"{out}/{_GOOD}/batch={number}")
        finally:
            batch.unpersist()

    lines = response_stream(spark, folder, files_at_once)
    return lines.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def _changes(spark: SparkSession, out: str, kind: str) -> DataFrame:
    return spark.read.schema(f"{_OUT.removeprefix('kind string, ')}, batch long").parquet(f"{out}/{kind}")


def landed(spark: SparkSession, out: str) -> DataFrame:
    """(custom_id, response, generated_code, parsability): of each request the line that counts, all changes so far taken together."""
    d = _changes(spark, out, _GOOD)
    last = d.groupBy("custom_id").agg(F.max_by("content", F.struct("file", "block", "place")).alias("response"))
    code = F.when(F.length("response") > 0, extract_code("response"))
    return last.withColumn("generated_code", code).withColumn("parsability", step_check("generated_code"))


def broken(spark: SparkSession, out: str) -> DataFrame:
    """(file, block, place, line) of the lines that can't be read."""
    return _changes(spark, out, _BAD).select("file", "block", "place", "line")
