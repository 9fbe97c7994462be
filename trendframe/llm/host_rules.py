"""Quality rules per document and per host, in DataFrame functions only.

Each document is measured and judged by two rules of its own. Failures are then counted per host
(``source``), each host's failure rate is shrunk towards the corpus by a beta prior whose two parameters
come from the moments of all hosts' rates, and a host whose shrunken rate is above ``max_rate`` is
refused with all its documents. Hosts with few documents thus need more than bad luck.

The measures are computed once and stored without the texts, counts per host are combined before they are
shuffled, and one row with the sums over hosts goes to the driver. The verdict comes back by a join on the host,
whose other side has a row per host.

Defined results: a null text has no words and so fails; documents without ``source`` are one host; repeated
rows count as often as they occur; an empty table gives no row; other columns are not read. A text's
length is not bounded: repeats within a text are found by sorting hashes of its windows, not by comparing them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendframe.llm.common import stored

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _window_hashes(words: Column) -> Column:
    last = F.size(words) - WINDOW
    starts = F.sequence(F.lit(0), last)
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def _repeated_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(p: Column) -> Column:
        same = lambda x, j: F.coalesce(x["h"] == F.get(p, j)["h"], F.lit(False))
        found = F.transform(p, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]))
        return F.sort_array(F.array_compact(found))

    def covered(s: Column) -> Column:
        to_next = F.transform(s, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(s, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(to_next, F.lit(0), lambda a, x: a + x)

    distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(distinct, F.lit(0)).otherwise(_let(_let(pairs, starts), covered))


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, source, five measures, base_failed) of every whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(F.col("text"), "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text.alias("text")
    ).select(
        "doc_id", "source",
        F.array_remove(F.split(F.col("text"), r"[\x20\x09-\x0D]+", -1), "").alias("words"),
        F.length(F.translate("text", SPACE, "")).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
    )
    hashed = words.select("*", F.size("words").alias("n_words"), _window_hashes(F.col("words")).alias("hashes"))
    counted = hashed.withColumn("n_repeat_words", _repeated_words(F.col("hashes")))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.select(
        "doc_id", "source", *(F.col(c).cast("long").alias(c) for c in MEASURES)
    ).withColumn("base_failed", failed)


def host_verdicts(measured: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """(source, n, failures, rate, host_kept): each host's shrunken failure rate and its verdict."""
    hosts = measured.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failures")
    )
    alpha, beta = beta_prior(hosts)
    rate = (F.col("failures") + alpha) / (F.col("n") + alpha + beta)
    return hosts.withColumn("rate", rate).withColumn("host_kept", F.col("rate") <= max_rate)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Parameters of the beta prior whose mean and variance are those of the hosts' rates.

    The variance that counts of this size have by chance is taken off first; where none is left, or all
    hosts or no host fail throughout, the prior is as strong as ``STRENGTH`` allows.
    """
    square = F.sum(F.pow(F.col("failures").cast("double"), 2) / F.col("n"))
    row = hosts.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("n"), F.sum("failures").alias("x"), square.alias("square")
    ).first()
    if not row.hosts:
        return 1.0, 1.0
    mean = row.x / row.n
    within = mean * (1 - mean)
    between = row.square / row.n - mean * mean - within * row.hosts / row.n
    low, high = STRENGTH
    strength = min(max(within / between - 1, low), high) if between > 0 else high
    return mean * strength, (1 - mean) * strength


#: Least and greatest number of documents that the prior may weigh as much as.
STRENGTH = (1.0, 1000.0)


def quality_rules(docs: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """(doc_id, five measures, base_failed, kept): ``kept`` is false for failures and for refused hosts."""
    measured = stored(measures(docs), "measures")
    hosts = host_verdicts(measured, max_rate).select(F.col("source").alias("host"), "host_kept")
    joined = measured.join(hosts, F.col("source").eqNullSafe(F.col("host")))
    return joined.select("doc_id", *MEASURES, "base_failed", (~F.col("base_failed") & F.col("host_kept")).alias("kept"))
