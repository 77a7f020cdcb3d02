"""Column functions on strings: code blocks, step markers, prompts, white space, counting. All of them stay in the JVM.

Patterns carry (?U), so that \\s and \\d mean white space and digits of all of Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of code fences and step markers, what a build says of unfinished proofs, and the sentence that ends a prompt.
LANGUAGE = "lean"
PLAIN_FENCE = "(?s)```\\n(.*?)```"
STEP_START = r"(?U)--\s*\[STEP_\d+:"
STEP_END = r"(?U)--\s*\[END_STEP_\d+\]"
UNFINISHED = ("declaration uses 'sorry'", "declaration uses sorry")
ASK = "Please translate this into compilable Lean 4 code with parsable proof steps."
# White space at both ends; \x1c-\x1f belong to it here but not to \s.
_EDGE = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(_col(c), _EDGE, "")


def rstrip(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"(?U)[\s\x1c-\x1f]+\z", "")


def extract_code(response: Column | str, language: str = LANGUAGE) -> Column:
    """The first fenced block of the language, else the first plain fenced block, else all of it; stripped. An empty block gives ''. Null stays null.

    The guards are needed: extraction alone gives '' for an empty block and for no block.
    """
    c, own = _col(response), f"(?s)```{language}\\n(.*?)```"
    block = F.when(c.rlike(own), F.regexp_extract(c, own, 1)).when(c.rlike(PLAIN_FENCE), F.regexp_extract(c, PLAIN_FENCE, 1)).otherwise(c)
    return strip(block)


def step_check(code: Column | str, start: str = STEP_START, end: str = STEP_END) -> Column:
    """struct(is_parsable, step_count): as many starts as ends, and some; the count is 0 if either is missing. Order and ids don't count."""
    c = F.coalesce(_col(code), F.lit(""))
    a, b = F.regexp_count(c, F.lit(start)).cast("long"), F.regexp_count(c, F.lit(end)).cast("long")
    some = (a > 0) & (b > 0)
    return F.struct((some & (a == b)).alias("is_parsable"), F.when(some, a).otherwise(F.lit(0).cast("long")).alias("step_count"))


def render_prompt(problem: Column | str, solution: Column | str, ask: str = ASK) -> Column:
    """The user prompt: the problem, the solution as a hint if there is one, and what is asked. Null counts as empty."""
    p, s = F.coalesce(_col(problem), F.lit("")), F.coalesce(_col(solution), F.lit(""))
    hint = F.when(F.length(s) > 0, F.concat(F.lit("Solution/Hint:\n"), s, F.lit("\n\n"))).otherwise(F.lit(""))
    return F.concat(F.lit("Problem:\n"), p, F.lit("\n\n"), hint, F.lit(ask))


def count_substring(c: Column | str, part: str) -> Column:
    """Non-overlapping occurrences of a literal, which must not be empty."""
    if not part:
        raise ValueError("an empty string has no count")
    c = _col(c)
    return F.floor((F.length(c) - F.length(F.replace(c, F.lit(part), F.lit("")))) / len(part)).cast("long")


def lines(c: Column | str) -> Column:
    return F.split(_col(c), "\n", -1)


def check_program(code: Column | str, names: list[str] | None = None) -> Column:
    """A program for a standalone check: warnings are errors, the code, and a line that prints the axioms of each name."""
    tail = "".join(f"\n#print axioms {n}" for n in names or [])
    return F.concat(F.lit("set_option warningAsError true\n"), rstrip(F.coalesce(_col(code), F.lit(""))), F.lit(tail + "\n"))


def has_main(code: Column | str) -> Column:
    return F.contains(_col(code), F.lit("def main"))


def has_placeholder(output: Column | str) -> Column:
    """Whether a build's output speaks of an unfinished proof."""
    return F.contains(_col(output), F.lit(UNFINISHED[0])) | F.contains(_col(output), F.lit(UNFINISHED[1]))


def axiom_lines(output: Column | str) -> Column:
    return F.filter(F.transform(lines(output), strip), lambda x: F.startswith(x, F.lit("axioms:")))


def percentage(part: Column | str, total: Column | str, digits: int = 1) -> Column:
    """part / total in percent, 0 where total is 0 or null."""
    p, t = _col(part), _col(total)
    return F.when(t > 0, F.round(p * F.lit(100.0) / t, digits)).otherwise(F.lit(0.0))


def mask_secret(c: Column | str) -> Column:
    c = _col(c)
    return F.when(F.length(c) > 11, F.concat(F.substring(c, 1, 7), F.lit("..."), F.right(c, F.lit(4)))).otherwise(F.lit("***"))


def run_id(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyyMMdd_HHmmss")


def elapsed_seconds(start: Column | str, end: Column | str, digits: int = 2) -> Column:
    micros = lambda c: F.unix_micros(_col(c).cast("timestamp"))
    return F.round((micros(end) - micros(start)) / F.lit(1e6), digits)
