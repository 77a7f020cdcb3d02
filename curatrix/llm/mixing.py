"""Mixing sources to target weights by systematic sampling, in DataFrame operations alone.

Within a source each document is expected the same number of times, r = target / size of the source. The documents are put
in an order by size, r is summed up along it, one random offset u is added, and a document is taken once for each whole
number that its stretch of the sum crosses: floor(i r + u) - floor((i - 1) r + u) for the i-th. As neighbours in the order
are alike in size, the words taken follow the target to within a few documents.

The order is by (band of similar sizes, bucket by hash, size, doc_id). Ranks are made in steps: within a (source, band,
bucket), over the counts of the buckets of a band, and over the bands of a source. The number of buckets follows the number of
rows, so that no task gets a whole source however large it is. Words are counted once, into a narrow table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BUCKET_ROWS = 1 << 22  # rows of the table for each 64 buckets
RESULT = ("size", "source_size", "target", "copies", "taken")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_size) with target: share of all sizes by weight, at most ``most`` times the source's size, the excess reshared.

    Sources by code point, null last, take the weights in turn. A source that is capped at its level stays capped when the
    excess is reshared, so one pass over the sources in the order of most x size / weight finds the level of the others.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("double"))
    s = s.withColumn("_cap", (most * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    total = Window.partitionBy()
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    s = s.withColumn("_level", (share * F.sum("source_size").over(total).cast("double") - before) / after)
    s = s.withColumn("_free", F.min(F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level")).alias("x"))).over(total))
    level = F.col("_free").getField("_level")
    return s.select("source", "source_size", F.when(level.isNull(), F.col("_cap")).otherwise(F.least("_cap", level * F.col("_w"))).alias("target"))


def buckets_for(rows: int) -> int:
    """Buckets of each (source, band): 64 for each BUCKET_ROWS rows of the whole table."""
    return 64 * max(1, -(-rows // BUCKET_ROWS))


def _facts(docs: DataFrame, seed: int, kept: list[str], digest: bool) -> DataFrame:
    """What decides of each row: key (of the source, never null), source, size, band, spot (a hash of doc_id), doc_id, digest; and the kept columns in one struct."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    spot = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 6), 16, 10).cast("int")
    row = F.struct(*(F.col(f"`{c}`") for c in kept)) if kept else F.lit(0)
    ties = F.md5(F.coalesce("text", F.lit(""))) if digest else F.lit("")
    d = docs.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")).alias("key"), "source", size.alias("size"), spot.alias("spot"), "doc_id", ties.alias("digest"), row.alias("row"))
    digits = F.col("size").cast("string")
    return d.withColumn("band", (100 * F.length(digits) + F.substring(digits, 1, 2).cast("int")).cast("int"))  # number of digits, first two


def mix(docs: DataFrame, seed: int = 1, keep: tuple[str, ...] | None = None, wide: bool | None = None) -> DataFrame:
    """All rows of docs (doc_id, text, source) with size, source_size, target, copies and taken (words with repeats).

    keep: the columns of docs that are wanted, all if None. wide: whether these are too large to be written down a second time
    with the sizes, as is assumed if text is among them. size counts the words of the text; null or wordless texts have 0, are ranked like others and take 0 words. A null source is a source of its own,
    after all others. Repeated rows are ranked one after another; ties are rows that are equal in what decides. Columns of
    docs that have the name of a result column are replaced; all others stay, whatever their names. Empty in, empty out.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in RESULT]
    wide = any(c.lower() == "text" for c in kept) if wide is None else wide
    facts = table(_facts(docs, seed, [] if wide else kept, not wide), "sizes")
    n = buckets_for(facts.count())
    bucket = lambda d: d.withColumn("bucket", F.col("spot") % n)
    d = bucket(_facts(docs, seed, kept, True) if wide else facts)
    groups = bucket(facts).groupBy("key", "band", "bucket").agg(F.count("*").alias("n"))
    bands = facts.groupBy("key", "band").agg(F.count("*").alias("n"))
    goals = targets(facts.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")))
    up_to = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda w: F.coalesce(F.sum("n").over(w), F.lit(0))
    bands = bands.select("key", "band", earlier(up_to("key").orderBy("band")).alias("bands_before"))
    groups = groups.select("key", "band", "bucket", earlier(up_to("key", "band").orderBy("bucket")).alias("before"))
    firsts = groups.join(bands, ["key", "band"]).join(goals.select("key", "source_size", "target", offset_of(F.col("source"), seed).alias("u")), "key")
    place = Window.partitionBy("key", "band", "bucket").orderBy("size", "doc_id", "digest")
    ranked = d.withColumn("place", F.row_number().over(place)).join(firsts, ["key", "band", "bucket"])
    i = F.col("bands_before") + F.col("before") + F.col("place")
    r = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = lambda k: F.floor(k.cast("double") * r + F.col("u"))
    copies = F.least(F.lit(2), upto(i) - upto(i - 1)).cast("long")
    out = ranked.select(*(F.col("row")[c].alias(c) for c in kept), "size", "source_size", "target", copies.alias("copies"))
    return out.withColumn("taken", F.col("size") * F.col("copies"))


def offset_of(source: F.Column, seed: int) -> F.Column:
    """The source's random offset in (0, 1), the same in every run."""
    name = F.concat(F.lit(f"{seed}/"), F.coalesce(source, F.lit("\u0001null")))
    return (F.conv(F.substring(F.md5(name), 1, 3), 16, 10).cast("double") + 0.5) / 4096


def mixed(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The mix itself: docs' columns, whatever their names, each row as many times as it is taken.

    A null or wordless text may be taken and adds no words; a null source is one of its own; repeated rows are taken each in
    their turn, see mix(). Empty in, empty out.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    m = mix(docs.select("doc_id", "text", "source", row), seed, ("row",), True).where("copies > 0")
    times = m.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return times.select(*(F.col("row")[c].alias(c) for c in docs.columns))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, text, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
b AS (SELECT *, CAST(('0x' || substr(md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 6)) AS INT) % (64 * greatest(1, CAST(ceil((SELECT count(*) FROM documents) / 4194304.0) AS INT))) AS bucket, CAST(100 * length(CAST(size AS VARCHAR)) + CAST(substr(CAST(size AS VARCHAR), 1, 2) AS INT) AS INT) AS band FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS w, CAST(2 * source_size AS DOUBLE) AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT min({'r': cap / w, 'l': level}).l AS level FROM l WHERE cap > level * w),
t AS (SELECT source, source_size, CASE WHEN f.level IS NULL THEN cap ELSE least(cap, f.level * w) END AS target,
        (CAST(CAST(('0x' || substr(md5('1/' || coalesce(source, chr(1) || 'null')), 1, 3)) AS INT) AS DOUBLE) + 0.5::DOUBLE) / 4096 AS u FROM l, f),
r AS (SELECT b.doc_id, b.size, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS r,
        row_number() OVER (PARTITION BY b.source ORDER BY band, bucket, size, doc_id NULLS FIRST, md5(coalesce(text, ''))) AS i FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * least(2, floor(i * r + u) - floor((i - 1) * r + u)) AS BIGINT) AS taken FROM r
"""
