import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendframe.functions import safe_div, tsql_like
from trendframe.functions.scalar import like_to_regex


def test_safe_div_failures_are_null(spark):
    inf, nan = float("inf"), float("nan")
    data = [
        (1.0, 0.0), (None, 1.0), (1.0, None), (1e308, 1e-10), (-1e308, 1e-10), (0.0, 0.0), (inf, 1.0), (nan, 1.0),
    ]
    df = spark.createDataFrame(data, "n double, d double")
    assert [r.q for r in df.select(safe_div("n", "d").alias("q")).collect()] == [None] * len(data)


def test_safe_div_values(spark):
    df = spark.createDataFrame([(1.0, 4.0), (-3.0, 2.0), (0.0, 5.0)], "n double, d double")
    assert [r.q for r in df.select(safe_div("n", F.col("d")).alias("q")).collect()] == [0.25, -1.5, 0.0]


def test_safe_div_of_decimals_is_double(spark):
    df = spark.sql("SELECT CAST(1 AS DECIMAL(9,2)) AS n, CAST(3 AS DECIMAL(9,2)) AS d")
    out = df.select(safe_div("n", "d").alias("q"))
    assert out.schema["q"].dataType.simpleString() == "double"
    assert math.isclose(out.first().q, 1 / 3)


NAMES = ["CAI_COD", "CAIXCOD", "cai_cod", "XCAI_COD", "a1", "b1", "c-1", "d]1", "x\\y", "p.q", "pXq", "^1", "a\nb"]


@pytest.mark.parametrize(
    "pattern, expected",
    [
        ("CAI_COD", {"CAI_COD", "CAIXCOD", "cai_cod"}),
        ("CAI[_]COD", {"CAI_COD", "cai_cod"}),
        ("%cod", {"CAI_COD", "CAIXCOD", "cai_cod", "XCAI_COD"}),
        ("[ab]%", {"a1", "b1", "a\nb"}),
        ("[a-b]1", {"a1", "b1"}),
        ("[^a]1", {"b1", "^1"}),
        ("_]1", {"d]1"}),
        ("_[]]1", set()),
        ("x\\y", {"x\\y"}),
        ("p.q", {"p.q"}),
        ("[^]1", {"^1"}),
        ("a_b", {"a\nb"}),
        ("", set()),
    ],
)
def test_like(spark, pattern, expected):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    assert {r.name for r in df.filter(tsql_like("name", pattern)).collect()} == expected


def test_like_case_sensitive(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    for pattern in ("cai_cod", "cai[_]cod"):
        kept = df.filter(tsql_like("name", pattern, case_sensitive=True)).collect()
        assert {r.name for r in kept} == {"cai_cod"}


def _matches(pattern: str, text: str) -> bool:
    if not pattern:
        return not text
    if pattern[0] == "%":
        return any(_matches(pattern[1:], text[i:]) for i in range(len(text) + 1))
    return bool(text) and (pattern[0] == "_" or pattern[0] == text[0]) and _matches(pattern[1:], text[1:])


@settings(max_examples=300, deadline=None)
@given(st.text("ab%_.*\\$", max_size=6), st.text("ab.*\\$%", max_size=6))
def test_like_to_regex_without_sets(pattern, text):
    regex = like_to_regex(pattern).replace(r"\z", r"\Z")
    assert bool(re.match("(?s)" + regex, text)) == _matches(pattern, text)


@pytest.mark.parametrize("pattern", ["ação", "[a]ção", "A[Ç]ão", "aÇÃ_", "[^b]ção%"])
def test_like_folds_accented_letters_with_and_without_sets(spark, pattern):
    df = spark.createDataFrame([("AÇÃO",), ("ação",), ("acao",)], "name string")
    assert {r.name for r in df.filter(tsql_like("name", pattern)).collect()} == {"AÇÃO", "ação"}
    exact = {r.name for r in df.filter(tsql_like("name", "[a]ção", case_sensitive=True)).collect()}
    assert exact == {"ação"}
