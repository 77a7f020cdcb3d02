"""Queries of what many tasks read of one document, of files' footers, of bulk output that lands in waves, and of global places."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keys, places, steps
from ..sources import footers, jsonscan, readers, writers
from ..sources.scratch import new_path
from ..streaming import landing
from . import io_queries, runs

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_document(spark, sf_dir):
    """One pretty JSON array of all documents, in which texts have brackets and quotes and values are nested, cut by many tasks."""
    path = new_path(spark, "split")
    d = _t(spark, sf_dir, "documents").where("doc_id is not null")
    odd = F.concat(F.lit('"}], \\ {'), F.coalesce("text", F.lit("")), F.lit('\\"[{'))
    nested = F.array(F.struct(F.array("lang", "source").alias("of")), F.struct(F.array(F.lit("]}"), F.lit("\\")).alias("of")))
    writers.write_json_document(d.select("doc_id", odd.alias("odd"), nested.alias("nested")), path, "doc_id", pretty=True)
    rows = jsonscan.json_records(spark, path, parts=True)
    got = F.from_json("record", "odd string, nested array<struct<of: array<string>>>", {"mode": "FAILFAST"})
    rows = rows.withColumn("j", got)
    return rows.select("pos", F.md5("j.odd").alias("md5"), F.col("j.nested")[0]["of"][0].alias("lang"), F.col("j.nested")[1]["of"][0].alias("mark"))


def problem_lines_in_order(spark, sf_dir):
    """JSON lines over several files with their global places, of which a run can be made."""
    path = new_path(spark, "lines")
    d = io_queries._documents_of_labels(spark, sf_dir)
    d.repartitionByRange(5, "pos").sortWithinPartitions("pos").select("record").write.text(path)
    return runs.prepare(readers.problems_lines(spark, path)).select("pos", "problem_id", "problem", "skipped")


def global_places(spark, sf_dir):
    """Rows of documents by source, lang and id, numbered without a gap."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return places.with_place(d, "source", "lang", "doc_id", start=1)


def export_keeps_columns(spark, sf_dir):
    """A table with a column named pos, full of nulls and ties, as a JSON array: no column and no record is lost."""
    path, table = new_path(spark, "export"), new_path(spark, "table")
    d = _t(spark, sf_dir, "labels")
    pos = F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("doc_id") % 2)
    d.withColumn("pos", pos).repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id").write.parquet(table)
    from .. import cli

    code = cli.main(["convert", table, "-o", path], spark)
    rows = jsonscan.json_records(spark, path, parts=True)
    j = F.from_json("record", "doc_id long, quality int, toxic int, pos long", {"mode": "FAILFAST"})
    return rows.select(F.col("pos").alias("place"), j.alias("j")).select("place", "j.*", F.lit(code).alias("code"))


def parquet_footers(spark, sf_dir):
    """What the footers of a table of three files say of each column."""
    path = new_path(spark, "footers")
    _t(spark, sf_dir, "labels").repartitionByRange(3, "doc_id").write.option("compression", "zstd").parquet(path)
    d = footers.columns(spark, path)
    sizes = (F.col("compressed_bytes") > 0) & (F.col("plain_bytes") > 0) & (F.size("encodings") > 0)
    return d.select("column", "physical_type", "n_files", "n_row_groups", "n_values", "n_nulls", F.array_join("compressions", ",").alias("compression"), sizes.alias("has_sizes"))


def _waves(spark, sf_dir) -> tuple[str, str]:
    """Bulk output that lands in two waves: the second has a file that stands before all others by its name, and broken lines."""
    src, out = new_path(spark, "waves"), new_path(spark, "landed")
    read = spark.read.text(io_queries._response_file(spark, sf_dir, broken=True))
    n = io_queries.tasks_of(read, 3)
    lines = places.with_file_place(read.withColumn("key", F.get_json_object("value", "$.custom_id").cast("long")))
    late = lines.where(F.coalesce(F.col("key") % 4 == 1, F.lit(False)))
    first = lines.where(F.coalesce(F.col("key") % 4 != 1, F.lit(True)))
    stale = late.withColumn("value", F.regexp_replace("value", '"status_code":\\d+', '"status_code":404'))
    for wave, rows in (("b", first), ("c", late), ("a", stale)):  # what is stale comes last and stands first
        rows.repartitionByRange(n, "place").sortWithinPartitions("place").select("value").write.text(f"{src}/{wave}")
        if wave != "c":  # two batches and three, however many files there are
            landing.land(spark, f"{src}/*", f"{out}/out", f"{out}/checkpoint", -(-2 * n // 3)).awaitTermination()
    return src, f"{out}/out"


def landed_in_waves(spark, sf_dir):
    """Of each request the last line by file and place, whenever it came."""
    _, out = _waves(spark, sf_dir)
    d = landing.landed(spark, out)
    return d.select("custom_id", F.md5("response").alias("md5"), F.col("parsability.step_count").alias("step_count"))


def landed_broken(spark, sf_dir):
    """The lines that can't be read, of all waves."""
    _, out = _waves(spark, sf_dir)
    return landing.broken(spark, out).select("line")


def _clashing(spark, sf_dir) -> DataFrame:
    """Ids that clash with what repeats of others are named, in chains: s, s, s, s_1, s_2, s_4 …"""
    d = _t(spark, sf_dir, "labels").where("doc_id is not null")
    id_ = F.concat(F.lit("s"), (F.col("doc_id") % 40).cast("string"))
    n = F.floor(F.col("doc_id") / 40) % 5
    return d.select(F.col("doc_id").alias("pos"), F.when(n < 3, id_).otherwise(F.concat(id_, F.lit("_"), (F.floor(F.col("doc_id") / 40) % 7).cast("string"))).alias("problem_id"))


def settled_ids(spark, sf_dir):
    """Ids made unique where ids that are given stand in the way."""
    d = keys.assert_unique(keys.settled_request_id(_clashing(spark, sf_dir)))
    return d.select("pos", "problem_id", "custom_id")


def step_structure(spark, sf_dir):
    """The steps of documents whose words are partly markers: nested, crossing, without an end or a start."""
    marked = F.transform(
        F.split(F.coalesce("text", F.lit("")), " "),
        lambda w, i: F.when((F.col("doc_id") + i * 5) % 13 == 0, F.format_string("-- [STEP_%d: %s]\n", (i / 3).cast("int") % 4, w))
        .when((F.col("doc_id") + i * 7) % 11 == 0, F.format_string("-- [END_STEP_%d]\n", (i / 2).cast("int") % 4))
        .otherwise(w),
    )
    d = _t(spark, sf_dir, "documents").select("doc_id", F.array_join(marked, " ").alias("code"))
    return steps.step_structure(d, "code", ("doc_id",))


_OWN = (step_structure, split_document, problem_lines_in_order, global_places, export_keeps_columns, parquet_footers, landed_in_waves, landed_broken, settled_ids)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _OWN}


def _settled_sql() -> str:
    given = "'s' || (doc_id % 40)::VARCHAR || CASE WHEN (doc_id // 40) % 5 < 3 THEN '' ELSE '_' || ((doc_id // 40) % 7)::VARCHAR END"
    return f"""WITH RECURSIVE g AS (SELECT doc_id AS pos, {given} AS problem_id FROM labels WHERE doc_id IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY problem_id ORDER BY pos) - 1 AS n, count(*) OVER (PARTITION BY problem_id) - 1 AS used FROM g),
r AS (SELECT 0 AS step, pos, problem_id, n, used FROM k WHERE n > 0
  UNION ALL SELECT step + 1, pos, problem_id, used + row_number() OVER (PARTITION BY problem_id ORDER BY pos), used + count(*) OVER (PARTITION BY problem_id)
  FROM r WHERE problem_id || '_' || n::VARCHAR IN (SELECT problem_id FROM g)),
f AS (SELECT pos, n FROM r QUALIFY row_number() OVER (PARTITION BY pos ORDER BY step DESC) = 1)
SELECT k.pos, problem_id, CASE WHEN k.n = 0 THEN problem_id ELSE problem_id || '_' || f.n::VARCHAR END AS custom_id FROM k LEFT JOIN f ON k.pos = f.pos"""


def oracle_sql() -> dict[str, str]:
    bad = "CASE WHEN doc_id % 13 = 0 THEN '{' || doc_id::VARCHAR ELSE '{\"custom_id\":\"' || doc_id::VARCHAR || '\",\"response\":null}' END"
    odd = "'\"}], \\ {' || coalesce(text, '') || '\\\"[{'"
    return {
        "split_document": f"SELECT row_number() OVER (ORDER BY doc_id) AS pos, md5({odd}) AS md5, lang, ']}}' AS mark FROM documents WHERE doc_id IS NOT NULL",
        "problem_lines_in_order": f"""SELECT pos, CASE WHEN doc_id % 3 <> 0 THEN 'd' || doc_id::VARCHAR ELSE 'problem_' || pos::VARCHAR END AS problem_id,
          {io_queries._FIELDS}, false AS skipped FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS pos FROM labels)""",
        "global_places": "SELECT doc_id, source, lang, row_number() OVER (ORDER BY source NULLS FIRST, lang NULLS FIRST, doc_id NULLS FIRST) AS place FROM documents",
        "export_keeps_columns": "SELECT row_number() OVER (ORDER BY doc_id) AS place, doc_id, quality, toxic, CASE WHEN doc_id % 3 <> 0 THEN doc_id % 2 END AS pos, 0 AS code FROM labels",
        "parquet_footers": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{kind}' AS physical_type, 3::BIGINT AS n_files, 3::BIGINT AS n_row_groups, count(*)::BIGINT AS n_values, "
            f"(count(*) - count({c}))::BIGINT AS n_nulls, 'ZSTD' AS compression, true AS has_sizes FROM labels"
            for c, kind in (("doc_id", "INT64"), ("quality", "INT32"), ("toxic", "INT32"))
        ),
        "landed_in_waves": f"""WITH {io_queries._R}, x AS (SELECT * FROM l WHERE doc_id % 13 > 1),
          y AS (SELECT custom_id, CASE WHEN code = 200 THEN content END AS content FROM x QUALIFY row_number() OVER (PARTITION BY custom_id ORDER BY n DESC) = 1)
          SELECT custom_id, md5(content) AS md5, CASE WHEN content IS NULL OR content = 'again' THEN 0 ELSE 1 END::BIGINT AS step_count FROM y""",
        "landed_broken": f"""SELECT unnest(CASE WHEN doc_id % 13 = 1 AND doc_id % 4 = 1 THEN list_concat(k, k) ELSE k END) AS line
          FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN [{bad}, {bad}] ELSE [{bad}] END AS k FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 13 < 2)""",
        "settled_ids": _settled_sql(),
    }
