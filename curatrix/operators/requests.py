"""Chat requests and the join of their responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import render_prompt
from .keys import response_map, settled_request_id

# The request format of the bulk service.
METHOD, URL = "POST", "/v1/chat/completions"
EFFORTS, EFFORT = ("low", "medium", "high"), "high"


def messages(system: Column, user: Column) -> Column:
    return F.array(F.struct(F.lit("system").alias("role"), system.alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content")))


def requests(problems: DataFrame, system_prompt: str) -> DataFrame:
    """problems (pos, problem_id, problem, solution) with custom_id, which is unique whatever ids are given, system_prompt and user_prompt."""
    d = settled_request_id(problems)
    return d.withColumn("system_prompt", F.lit(system_prompt)).withColumn("user_prompt", render_prompt("problem", "solution"))


def envelope(reqs: DataFrame, model: str, effort: str = EFFORT) -> DataFrame:
    """(pos, custom_id, method, url, body): one request line each; other columns stay behind."""
    if effort not in EFFORTS:
        raise ValueError(f"effort is one of {', '.join(EFFORTS)}: {effort}")
    body = F.struct(F.lit(model).alias("model"), messages(F.col("system_prompt"), F.col("user_prompt")).alias("messages"), F.lit(effort).alias("reasoning_effort"))
    return reqs.select("pos", "custom_id", F.lit(METHOD).alias("method"), F.lit(URL).alias("url"), body.alias("body"))


def join_responses(reqs: DataFrame, lines: DataFrame) -> DataFrame:
    """reqs with response: null where there is no line, a failed one, or one without content."""
    got = response_map(lines).withColumnRenamed("content", "response")
    return reqs.drop("response").join(got, "custom_id", "left")


def job_progress(df: DataFrame, by: str) -> DataFrame:
    """(by, total, completed, percent): responses that came, for each group."""
    done = F.count_if(F.length(F.coalesce("response", F.lit(""))) > 0)
    d = df.groupBy(by).agg(F.count("*").alias("total"), done.alias("completed"))
    return d.withColumn("percent", F.round(F.col("completed") * 100.0 / F.col("total"), 1))
