"""Small tables with the awkward rows that every operator has a defined result for."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: The columns of ``documents``, and extra ones whose names operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, bands int, log_weight string,"
    " bucket string, kept string, part string, ids string, value string, payload string"
)


def make_docs(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``documents`` of (doc_id, text, lang, source), with clashing extra columns."""
    full = [(i, t, lang, s, None if t is None else len(t), "x", 1, "x", "x", "x", "x", "x", "x", "x") for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, words: int, syllables: str = "the an er ing ou re st on ha ti ed ly") -> str:
    r = random.Random(seed)
    parts = syllables.split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(words))


def awkward(seed: int = 0) -> list[tuple]:
    """Null and empty texts, null ids, repeated rows, equal texts, other scripts, white space only, a very long text."""
    a = prose(seed, 60)
    return [
        (1, a, "en", "s1"), (2, a, "en", "s1"), (2, a, "en", "s1"), (None, a, None, None), (3, None, "en", "s1"), (4, "", "de", "s2"),
        (5, " \n\t ", "de", "s2"), (6, "!!! ### 123 4.5", "", "s2"), (7, "日本語のテキスト é́ 🙂 \x1c x", "ja", "s3"),
        (8, prose(seed + 1, 30_000), "en", "s1"), (9, "word", "en", None), (None, None, None, None), (10, "the the  the \n\n the", "en", "s3"),
        (11, "x" * 100_000, "en", "s3"), (12, a + " more", "en", "s1"), (-5, "Ünïcödé tèxt " * 12, "fr", "s4"),
    ]
