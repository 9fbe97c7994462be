"""Column expressions. Everything stays in the JVM; there are no Python UDFs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_div(numerator, denominator) -> Column:
    """``numerator / denominator`` as a double; any failed division is NULL.

    A zero divisor, an overflow to infinity and NaN operands all count as failures.
    """
    quotient = F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))
    # NaN sorts above infinity in Spark, so one comparison rejects both.
    return F.when(F.abs(quotient) < F.lit(float("inf")), quotient)


def like_to_regex(pattern: str) -> str:
    """The regular expression matching the same strings as a T-SQL LIKE pattern."""
    out, i = [], 0
    while i < len(pattern):
        char = pattern[i]
        close = pattern.find("]", i + 1) if char == "[" else -1
        if char == "%":
            out.append(".*")
        elif char == "_":
            out.append(".")
        elif close > 0:
            body = pattern[i + 1 : close]
            negate = body.startswith("^") and len(body) > 1
            body = body[1:] if negate else body
            # '-' keeps its range meaning; everything else is literal inside the set.
            members = re.sub(r"([\\\[\]^&])", r"\\\1", body)
            # An empty set matches nothing, and a lone '^' is literal.
            out.append(f"[{'^' if negate else ''}{members}]" if body else "(?!)")
            i = close
        else:
            out.append(re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", char))
        i += 1
    return r"\A" + "".join(out) + r"\z"


def tsql_like(column, pattern: str, case_sensitive: bool = False) -> Column:
    """T-SQL LIKE with ``%``, ``_``, ``[set]`` and ``[^set]``; case-insensitive by default."""
    column = _col(column)
    if "[" not in pattern and "\\" not in pattern:
        return column.like(pattern) if case_sensitive else column.ilike(pattern)
    # Without "u", Java folds the case of ASCII letters only.
    flags = "(?s)" if case_sensitive else "(?isu)"
    return column.rlike(flags + like_to_regex(pattern))
