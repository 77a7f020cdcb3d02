"""Row filters and limits: scores, complexity rules, and the two limits that differ in place and in what 0 means."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, NumericType

from ..functions.text import count_substring


@dataclass(frozen=True)
class SkipRules:
    """Ordered (substring, reason) rules, the first hit wins; then counts of which any above its threshold skips."""

    keywords: tuple[tuple[str, str], ...]
    counts: tuple[tuple[str, int], ...]
    counts_reason: str


# The rules for geometry problems.
GEOMETRY = SkipRules(
    keywords=(
        ("circumcenter", "complex geometric construction (circumcenter)"),
        ("orthocenter", "complex geometric construction (orthocenter)"),
        ("incircle", "complex geometric construction (incircle)"),
        ("excircle", "complex geometric construction (excircle)"),
        ("simson line", "complex geometric construction (Simson line)"),
        ("nine-point circle", "complex geometric construction (nine-point circle)"),
        ("construct", "geometric construction required"),
        ("draw a line", "geometric construction required"),
        ("take points", "complex point construction"),
    ),
    counts=(("point", 8), ("line", 6)),
    counts_reason="too many geometric elements (likely complex construction)",
)


def is_one(df: DataFrame, column: str) -> Column:
    """Whether a score is one, decided by the column's type: numbers equal 1, true; arrays if all elements are (so an empty
    array is); null scores and null elements are not. Other types, strings too, never are."""
    kind = df.schema[column].dataType
    c = F.col(f"`{column}`")

    def one(x: Column, t) -> Column:
        if isinstance(t, NumericType):
            return F.coalesce(x == 1, F.lit(False))
        return F.coalesce(x, F.lit(False)) if isinstance(t, BooleanType) else F.lit(False)

    if isinstance(kind, ArrayType):
        return F.coalesce(F.forall(c, lambda x: one(x, kind.elementType)), F.lit(False))
    if isinstance(kind, NumericType):
        return c == 1  # reaches the scan
    return one(c, kind)


def score_filter(df: DataFrame, column: str = "score") -> DataFrame:
    """Rows whose score is one; all rows, with a warning, if there is no such column."""
    if column not in df.columns:
        warnings.warn(f"no column {column}: rows are not filtered", stacklevel=2)
        return df
    return df.where(is_one(df, column))


def skip_reason(text: Column | str, rules: SkipRules = GEOMETRY) -> Column:
    """Why a text is skipped, null if it isn't. Matches substrings of the lower-cased text; a null text is empty."""
    low = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    out = None
    for word, reason in rules.keywords:
        hit = F.contains(low, F.lit(word))
        out = F.when(hit, F.lit(reason)) if out is None else out.when(hit, F.lit(reason))
    many = F.lit(False)
    for word, most in rules.counts:
        many = many | (count_substring(low, word) > most)
    return (F.when(many, F.lit(rules.counts_reason)) if out is None else out.when(many, F.lit(rules.counts_reason))).otherwise(F.lit(None).cast("string"))


def skip_classify(df: DataFrame, text: str = "problem", rules: SkipRules = GEOMETRY, enabled: bool = True) -> DataFrame:
    """df with skip_reason and skipped; nothing is skipped if not enabled."""
    reason = skip_reason(text, rules) if enabled else F.lit(None).cast("string")
    return df.withColumn("skip_reason", reason).withColumn("skipped", F.col("skip_reason").isNotNull())


def _checked(n: int | None) -> int | None:
    if n is not None and n < 0:
        raise ValueError(f"a limit must not be negative: {n}")
    return n


def limit_after_filter(df: DataFrame, n: int | None, order: str = "pos") -> DataFrame:
    """The export's limit, applied to filtered rows: None is no limit, 0 is no row."""
    return df if _checked(n) is None else df.orderBy(order).limit(n)


def limit_before_filter(df: DataFrame, n: int | None, order: str = "pos") -> DataFrame:
    """The pipeline's limit, applied to the input before any filter: None and 0 are no limit."""
    return df.orderBy(order).limit(n) if _checked(n) else df


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
