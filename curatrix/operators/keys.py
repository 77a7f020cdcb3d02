"""Request ids, and which of several rows of a key wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import new_path
from .places import fresh

def default_id(df: DataFrame, column: str = "problem_id", pos: str = "pos") -> DataFrame:
    """Missing ids become problem_{pos}, pos counting from 1."""
    return df.withColumn(column, F.coalesce(F.col(column), F.concat(F.lit("problem_"), F.col(pos).cast("string"))))


def unique_request_id(df: DataFrame, column: str = "problem_id", pos: str = "pos", out: str = "custom_id") -> DataFrame:
    """The first row of an id, by pos, keeps it; the k-th after it gets id_{k}. Such an id may be one that is given to another row, see
    settled_request_id()."""
    place = fresh([*df.columns, out], "_k")
    d = _repeats(df.select(*(c for c in df.columns if c != out)), column, pos, place)
    k = F.col(place)
    return d.withColumn(out, F.when(k == 0, F.col(column)).otherwise(F.concat(F.col(column), F.lit("_"), k.cast("string")))).drop(place)


def _repeats(df: DataFrame, column: str, pos: str, out: str) -> DataFrame:
    """df with how many rows of its id stand before each row, by pos.

    Ids that come once need no order, and a hot id should not be sorted in one task: rows are ranked within (id, block of
    pos) and the blocks' counts are summed up, so a task gets at most a block of an id.
    """
    block, place = fresh(df.columns, "_block"), fresh(df.columns, "_place")
    d = df.withColumn(block, F.floor(F.col(pos) / BLOCK))
    counts = d.groupBy(column, block).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(column).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("_before", before).select(F.col(column).alias("_id"), F.col(block).alias("_b"), "_before")
    d = d.withColumn(place, F.row_number().over(Window.partitionBy(column, block).orderBy(pos)))
    d = d.join(counts, d[column].eqNullSafe(counts._id) & (d[block] == counts._b))
    return d.select(*(d[c] for c in df.columns), (F.col("_before") + F.col(place) - 1).cast("long").alias(out))


BLOCK = 1_000_000


def settled_request_id(df: DataFrame, column: str = "problem_id", pos: str = "pos", out: str = "custom_id", rounds: int = 64) -> DataFrame:
    """unique_request_id() with ids that can't collide, whatever ids are given: of ``a, a, a_1`` the second becomes a_2.

    A made id that is a given one moves: the colliding rows of an id get the next numbers that it has not used, in the order of
    pos, until none collides. Ids that don't collide stay as they are. Made ids differ from one another, as each is an id and a number. Each round
    probes only the rows that moved. Rounds beyond ``rounds`` raise RuntimeError: ids would have to stand in the way of numbers
    that many times in a row.
    """
    order, made = fresh([*df.columns, out], "_order"), fresh([*df.columns, out], "_made")
    kept = [c for c in df.columns if c != out]
    d = _table(_repeats(df.select(*kept), column, pos, made))
    given = d.where(F.col(made) == 0).select(F.col(column).alias("_given"))
    name = F.concat(F.col(column), F.lit("_"), F.col(made).cast("string"))
    used = d.groupBy(F.col(column).alias("_of")).agg(F.max(made).alias("_used"))
    moved = _table(d.where(F.col(made) > 0).join(given, name == F.col("_given"), "left_semi").select(pos, column).withColumnRenamed(pos, order))
    settled = []
    for _ in range(rounds):
        if moved.isEmpty():
            break
        step = _repeats(moved, column, order, made)
        last = used.join(step.groupBy(F.col(column).alias("_by")).agg((F.max(made) + 1).alias("_n")), F.col("_of") == F.col("_by"), "left")
        numbered = step.join(used, F.col(column) == F.col("_of")).select(order, column, (F.col("_used") + 1 + F.col(made)).alias(made))
        numbered = _table(numbered)
        used = _table(last.select("_of", (F.col("_used") + F.coalesce("_n", F.lit(0))).alias("_used")))
        hit = numbered.join(given, name == F.col("_given"), "left_semi")
        settled.append(numbered.join(given, name == F.col("_given"), "left_anti").select(order, F.col(made).alias("_new")))
        moved = _table(hit.select(order, column))
    else:
        if not moved.isEmpty():
            raise RuntimeError(f"ids did not settle in {rounds} rounds")
    new = F.col(made)
    if settled:
        changes = settled[0]
        for x in settled[1:]:
            changes = changes.unionByName(x)
        d = d.join(changes, (d[pos] == changes[order]) & (d[made] > 0), "left")
        new = F.coalesce("_new", made)
    made_id = F.when(new == 0, F.col(column)).otherwise(F.concat(F.col(column), F.lit("_"), new.cast("string")))
    return d.select(*kept, made_id.alias(out))


def _table(df: DataFrame) -> DataFrame:
    path = new_path(df.sparkSession, "ids")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def assert_unique(df: DataFrame, column: str = "custom_id") -> DataFrame:
    """df; raises ValueError if an id comes twice, as when ids a, a, a_1 are made unique."""
    twice = df.groupBy(column).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{column} is not unique: {twice[0][0]!r}")
    return df


def last_writer_wins(df: DataFrame, key: str = "problem_id", order: str = "pos") -> DataFrame:
    """The last row of each key by order, as one aggregate with map-side combining. Rows of a null key are one group."""
    row = F.max_by(F.struct(*df.columns), F.col(order))
    return df.groupBy(F.col(key).alias("_key")).agg(row.alias("_row")).select("_row.*")


def response_map(lines: DataFrame, order: str = "line_no") -> DataFrame:
    """(custom_id, content): the last line of each id wins, a failed one too, whose content is null."""
    content = F.when(F.col("response.status_code") == 200, F.get(F.col("response.body.choices"), F.lit(0)).getField("message").getField("content"))
    return lines.select("custom_id", content.alias("content"), F.col(order).alias("_o")).groupBy("custom_id").agg(F.max_by("content", "_o").alias("content"))
