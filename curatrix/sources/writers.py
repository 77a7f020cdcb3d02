"""Sinks: JSON records, logs and code by row, request lines, run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import last_writer_wins
from ..operators.places import with_place
from .files import copy, hadoop, write_text_files


def json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines with nulls kept and NaN as null: the form of the export that scales."""
    _plain(df).write.mode(mode).option("ignoreNullFields", "false").json(path)


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c, t in df.dtypes if t in ("double", "float")})


def json_document(df: DataFrame, order: str, pretty: bool = False) -> DataFrame:
    """(_at, line): the lines of one JSON array of all records by ``order``, which stays out of the records. Nulls of it come first.

    No row holds more than a record: a record begins with its comma, but for the first, and the brackets are rows of their own.
    """
    d = _plain(df)
    how = {"ignoreNullFields": "false"} | ({"pretty": "true"} if pretty else {})
    record = F.to_json(F.struct(*(F.col(f"`{c}`") for c in d.columns if c != order)), how)
    return array_lines(d.select(order, record.alias("_record")), order, F.col("_record"))


def array_lines(df: DataFrame, order: str, record: Column) -> DataFrame:
    """(_at, line): the lines of one JSON array of records that are texts already, by ``order``; rows that are equal in it may change places."""
    d = with_place(df.select(order, record.alias("_line")), order, out="_at", start=1)
    lines = d.select("_at", F.concat(F.when(F.col("_at") > 1, F.lit(",")).otherwise(F.lit("")), "_line").alias("line"))
    spark = df.sparkSession
    bracket = lambda at, line: F.struct(F.lit(at).cast("long").alias("_at"), F.lit(line).alias("line"))
    ends = spark.range(1).select(F.explode(F.array(bracket(0, "["), bracket((1 << 63) - 1, "]"))).alias("e")).select("e.*")
    return lines.unionByName(ends)


def write_lines(lines: DataFrame, path: str) -> None:
    """(_at, line) as text files of a folder, in order: files follow ranges of _at."""
    lines.repartitionByRange("_at").sortWithinPartitions("_at").select("line").write.mode("overwrite").text(path)


def write_json_document(df: DataFrame, path: str, order: str, pretty: bool = False) -> None:
    """The array's lines as text files of a folder, which make the document when read in the order of their names; see merge_files()."""
    write_lines(json_document(df, order, pretty), path)


def merge_files(spark: SparkSession, folder: str, file: str) -> None:
    """The files of a folder, in the order of their names, as one file; bytes are streamed, never held."""
    (src, fs), (dst, to) = hadoop(spark, folder), hadoop(spark, file)
    out = to.create(dst, True)
    try:
        for part in sorted(str(x.getPath()) for x in fs.listStatus(src) if not x.getPath().getName().startswith(("_", "."))):
            own = fs.open(hadoop(spark, part)[0])
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(own, out, 1 << 16, False)
            finally:
                own.close()
    finally:
        out.close()


def keep_raw(spark: SparkSession, path: str, out: str) -> str:
    """A copy of bulk output, byte for byte, made by tasks, which stays whatever becomes of the parse. Gives the copy's folder. A whole
    copy that is there stays; see files.copy()."""
    if path.rstrip("/") == out.rstrip("/"):
        raise ValueError(f"{path} can't be copied onto itself")
    return copy(spark, path, out)


def problem_logs(df: DataFrame, path: str, run: str) -> None:
    """Logs as a table by run id, all rows; a reader takes last_writer_wins() where one row of a problem is wanted. A run that is there
    is replaced, other runs stay."""
    df.write.mode("overwrite").parquet(f"{path}/run_id={run}")


FOLDER_FILES = 2000  # problems whose files share a folder


def export_files(log: DataFrame, folder: str, key: str = "problem_id", order: str = "pos", folders: int | None = None) -> int:
    """For each problem ``{id}.json`` with its log and, where there is code, ``{id}.lean``; gives the number of folders.

    Executors write; the files of a problem lie in ``folder``/part-…, chosen by the name's checksum, see files.folder_of(). All are there when
    the write is committed, none if it fails. The last row of an id wins. Slashes and a leading dot in an id become
    underscores; ids whose files would be the same raise ValueError. A null id is the file ``null``.
    """
    last = last_writer_wins(log, key, order)
    plain = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(key).cast("string"), F.lit("null")), r"[/\\]", "_"), r"^\.", "_")
    record = F.to_json(F.struct(*(c for c in last.columns if c != order)), {"pretty": "true"})
    rows = last.select(plain.alias("stem"), record.alias("log"), F.nullif("generated_code", F.lit("")).alias("code"))
    counts = rows.groupBy("stem").agg(F.count("*").alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    if (counts.most or 0) > 1:
        raise ValueError("two problems have the same file name")
    folders = folders or max(1, -(-(counts.n or 0) // FOLDER_FILES))
    both = F.array(F.struct(F.lit(".json").alias("suffix"), F.col("log").alias("text")), F.struct(F.lit(".lean").alias("suffix"), F.col("code").alias("text")))
    files = rows.select("stem", F.explode(both).alias("f")).where("f.text is not null")
    write_text_files(files.select("stem", F.concat("stem", "f.suffix").alias("name"), "f.text"), folder, folders)
    return folders


def code_files(df: DataFrame, path: str, key: str = "problem_id", order: str = "pos") -> None:
    """(key, code) of the last row of each key, where there is code, as a table of texts."""
    last_writer_wins(df, key, order).where(F.length("generated_code") > 0).select(key, F.col("generated_code").alias("code")).write.mode("overwrite").parquet(path)


def request_lines(envelopes: DataFrame, path: str) -> None:
    """One request a line, in order of pos: partitions are ranges of it, files follow partitions."""
    e = envelopes.repartitionByRange("pos").sortWithinPartitions("pos")
    e.select(F.to_json(F.struct("custom_id", "method", "url", "body"))).write.mode("overwrite").text(path)


def batch_info(spark, batch_id: str, input_file: str, created_at: str, n: int) -> DataFrame:
    from ..schemas import BATCH_INFO

    return spark.createDataFrame([(batch_id, input_file, created_at, n)], BATCH_INFO)


def run_summary(stats: DataFrame, files: DataFrame | None = None, **fields: str | int | bool | None) -> DataFrame:
    """One row: the run's fields, stats as a struct, and the manifest if it is given as one row (manifest_array()). Without it, the
    manifest is a table of its own beside the summary."""
    kinds = {bool: "boolean", int: "long"}
    row = stats.select(*(F.lit(v).cast(kinds.get(type(v), "string")).alias(k) for k, v in fields.items()), F.struct(*stats.columns).alias("stats"))
    return row.crossJoin(files) if files is not None else row  # one row each


def write_one(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
