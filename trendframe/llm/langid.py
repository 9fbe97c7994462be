"""Language identification with interpolated Kneser-Ney models of characters.

Words (runs of letters in lower case, with a space on each side) are modelled character by character, with at
most ``ORDER - 1`` characters before it that do not reach over the word. Per language, an n-gram that begins
with the word counts as often as it occurs and any other shorter than ``ORDER`` as often as different
characters stand before it. One absolute discount per order leaves room for the next lower order, and the lowest for
characters never seen. All n-grams of all languages are hashed into one sorted array with a column per
language beside it, and searched by bisection.

A text's language has the lowest cross-entropy per character. A text is rejected if it has no letter, or if
its cross-entropy lies further above the language's usual one, the median, than a share of ``QUANTILE`` of the calibration documents,
by ``SLACK`` and ``MARGIN``. Only documents whose label is predicted calibrate, and the greatest distance never does. The distance is measured in
units that shrink with the root of the text's length, down to how much long documents differ from each other.

The models learn from about ``SAMPLE`` documents per language, a fifth of which calibrate; which ones is decided by a
hash of the id. n-grams are counted by Spark; the driver gets the finished tables, whose size the
sample bounds. Whole texts are scored, each distinct word once per worker.

Defined results: null text, or a text without letters: ``und``, score 0, rejected; null or empty ``lang`` teaches nothing;
a null ``doc_id`` is not held out; without any training text every document is ``und``; of equally good
languages the first by name; repeated rows are scored alike; an empty table gives no row; ``predict`` reads
no other columns and ``keep`` keeps them.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendframe.llm.common import held, map_texts, slices, stored

ORDER = 4
SAMPLE = 3000
SLACK = 1.25
#: Share of calibration documents of a language that lie within the limit before ``SLACK``.
QUANTILE = 0.99
#: Cross-entropy (nats per character) above the usual one that is no ground for rejection at any length.
MARGIN = 0.5
#: Distance that is always allowed, as few calibration documents tell little: six times a usual deviation of one character.
LEAST_LIMIT = 10.0
#: Characters after which further evidence no longer raises the score.
SURE = 50
#: Alphabet over which the rest of the lowest order is spread.
ALPHABET = 1 << 16
#: Word scores that a worker keeps, words times languages; the store starts anew beyond it.
KEPT_SCORES = 2_000_000

_WORD = re.compile(r"[^\W\d_]+")
_BASE = 0x100000001B3
_MIXER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(sums: np.ndarray, n: int) -> np.ndarray:
    h = (sums + np.uint64(n)) * _MIXER
    return (h ^ (h >> np.uint64(31))) * _MIXER


def _sums(codes: np.ndarray) -> list[np.ndarray]:
    """For n = 0 to ``ORDER``, hash sums of the n codes that end at each place."""
    out = [np.zeros(len(codes), np.uint64)]
    for n in range(ORDER):
        power = np.uint64(pow(_BASE, n, 2**64))
        shifted = np.concatenate([np.zeros(min(n, len(codes)), np.uint64), codes[: max(len(codes) - n, 0)]])
        out.append(out[-1] + shifted * power)
    return out


class _Scores:
    """Scores of the words that a worker has met."""

    def __init__(self, langs: int):
        self.row: dict[str, int] = {}
        self.scores = np.zeros((0, langs))

    def missing(self, words: list[str]) -> list[str]:
        out = set(words).difference(self.row)
        if (len(self.row) + len(out)) * max(self.scores.shape[1], 1) > KEPT_SCORES:
            self.row, self.scores = {}, self.scores[:0]
            out = set(words)
        return list(out)

    def add(self, words: list[str], scores: np.ndarray) -> None:
        start, end = len(self.row), len(self.row) + len(words)
        self.row.update(zip(words, range(start, end), strict=True))
        if end > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros((max(end - len(self.scores), len(self.scores)), scores.shape[1]))])
        self.scores[start:end] = scores


@dataclass
class Models:
    """Sorted n-gram hashes, and per n-gram and language the discounted share and the share left to lower orders.

    ``share`` belongs to the n-gram as context and character, ``left`` to the n-gram as a context.
    """

    langs: list[str]
    hashes: np.ndarray
    share: np.ndarray
    left: np.ndarray
    usual: np.ndarray = field(default_factory=lambda: np.empty(0))
    limit: np.ndarray = field(default_factory=lambda: np.empty(0))
    between: np.ndarray = field(default_factory=lambda: np.empty(0))
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def _kept(self) -> _Scores:
        return held(("langid", self.name), lambda: _Scores(len(self.langs)))

    def _rows(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probabilities, word x language."""
        codes = np.array([ord(c) + 1 for c in "".join(f" {w} " for w in words)], dtype=np.uint64)
        sizes = np.array([len(w) + 2 for w in words])
        starts = np.cumsum(sizes) - sizes
        inside = np.arange(len(codes)) - np.repeat(starts, sizes)
        sums = _sums(codes)
        p = np.full((len(codes), len(self.langs)), 1.0 / ALPHABET)
        for n in range(1, ORDER + 1):
            at = np.flatnonzero(inside >= max(n - 1, 1))  # the space before a word is given
            row, found = self._rows(_mixed(sums[n][at], n))
            before, seen = self._rows(_mixed(sums[n - 1][at - 1], n - 1))
            p[at] = np.where(found[:, None], self.share[row], 0) + np.where(seen[:, None], self.left[before], 1) * p[at]
        p[starts] = 1
        return np.add.reduceat(np.log(p), starts, axis=0) if len(words) else np.zeros((0, len(self.langs)))

    def _scored(self, words: list[str]) -> np.ndarray:
        """``word_scores`` of many words, so many at a time that arrays stay small."""
        ends = np.cumsum([len(w) + 2 for w in words]) * len(self.langs)
        cuts = np.flatnonzero(np.diff(ends // 2_000_000)) + 1
        parts = zip([0, *cuts.tolist()], [*cuts.tolist(), len(words)], strict=True)
        return np.concatenate([self.word_scores(words[a:b]) for a, b in parts])

    def totals(self, words: list[str]) -> np.ndarray:
        """Log probability of all words per language."""
        kept = self._kept()
        missing = kept.missing(words)
        if missing:
            kept.add(missing, self._scored(missing))
        rows = np.fromiter(map(kept.row.__getitem__, words), dtype=np.int64, count=len(words))
        return kept.scores[rows].sum(axis=0)

    def prepare(self, texts: list[list[str]]) -> None:
        """Score the new words of several texts at once."""
        if not self.langs:
            return
        self.totals(list(set().union(*texts).difference(self._kept().row)))

    def predict(self, words: list[str]) -> tuple[str, float, float, int]:
        """(language, score, cross-entropy, characters) of a text's words."""
        n = sum(map(len, words)) + len(words)
        if not self.langs or not any(w.isalpha() or any(map(str.isalpha, w)) for w in words):
            return "und", 0.0, 0.0, 0
        mean = self.totals(words) / n
        best = int(mean.argmax())
        odds = np.exp((mean - mean[best]) * min(n, SURE))
        return self.langs[best], float(1 / odds.sum()), float(-mean[best]), n

    def rejects(self, lang: str, entropy: float, n: int) -> bool:
        if not n:
            return True
        k = self.langs.index(lang)
        return bool(entropy - self.usual[k] - MARGIN > self.limit[k] * (1 / n + self.between[k]) ** 0.5)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def held_out(doc_id: Column) -> Column:
    """Documents of this quarter teach nothing."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("long").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, text, calibrates): about ``sample`` different documents of each language that are not held out.

    Documents are drawn by a hash of id and text, so a repeated or null id draws none of the others, and copies of a
    document count once: however often rows repeat, a language has about ``sample`` rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    ).filter((F.length("lang") > 0) & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.withColumn("which", F.xxhash64("doc_id", "text"))
    draw = F.pmod(F.xxhash64("which", F.lit(7)), F.lit(1 << 30))
    # A sketch of fixed size per language, combined before the shuffle; equal rows give the same in any order.
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("which", 0.02).alias("count"))
    share = counts.select(F.col("lang").alias("l"), F.least(F.lit(1.0), sample / F.col("count")).alias("share"))
    # A row per language, each of which every worker holds a model of: small enough to send along.
    chosen = rows.join(F.broadcast(share), F.col("lang") == F.col("l")).filter(draw < F.col("share") * (1 << 30))
    once = chosen.dropDuplicates(["lang", "which"])
    return once.select("lang", "text", (F.pmod(F.xxhash64("which", F.lit(8)), F.lit(5)) == 0).alias("calibrates"))


def count_grams(rows: DataFrame) -> DataFrame:
    """(lang, gram, c): n-grams with all characters before that the model sees, and how often they occur."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        for batch in batches:
            for part, texts in slices(batch):
                for lang, text in zip(part.column("lang").to_pylist(), texts, strict=True):
                    words.setdefault(lang, Counter()).update(words_of(text))
        for lang, counts in words.items():
            grams: Counter = Counter()
            for word, c in counts.items():
                padded = f" {word} "
                for end in range(2, len(padded) + 1):
                    grams[padded[max(0, end - ORDER) : end]] += c
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams)), pa.array(list(grams)), pa.array(list(grams.values()), pa.int64())],
                names=["lang", "gram", "c"],
            )

    partial = rows.select("lang", "text").mapInArrow(run, "lang string, gram string, c long")
    return partial.groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def fit_table(grams: pd.DataFrame, langs: list[str]) -> Models:
    """Models from (lang, gram, c), by the definitions above."""
    level = {n: grams[grams.gram.str.len() == n] for n in range(2, ORDER + 1)}
    counts = {ORDER: level[ORDER]} if ORDER in level else {}
    for n in range(ORDER - 1, 0, -1):
        longer = counts[n + 1]
        after = longer[~longer.gram.str[1:].str.startswith(" ") | (longer.gram.str.len() == 2)]
        seen = after.assign(gram=after.gram.str[1:]).groupby(["lang", "gram"], as_index=False).agg(c=("c", "size"))
        whole = level[n][level[n].gram.str.startswith(" ")] if n > 1 else seen[:0]
        counts[n] = pd.concat([seen, whole[["lang", "gram", "c"]]], ignore_index=True)
    shares, lefts = [], []
    for n, table in counts.items():
        table = table.assign(context=table.gram.str[:-1])
        ones, twos = (table[table.c == k].groupby("lang").size() for k in (1, 2))
        discount = {x: (a := ones.get(x, 0) + 0.5) / (a + 2 * (twos.get(x, 0) + 0.5)) for x in langs}
        d = table.lang.map(discount)
        of = table.groupby(["lang", "context"])
        total = of.c.transform("sum")
        shares.append(pd.DataFrame({"lang": table.lang, "gram": table.gram, "v": (table.c - d).clip(lower=0) / total}))
        room = of.agg(total=("c", "sum"), kinds=("c", "size")).reset_index()
        room["v"] = room.lang.map(discount) * room.kinds / room.total
        lefts.append(room.rename(columns={"context": "gram"})[["lang", "gram", "v"]])
    share, left = pd.concat(shares, ignore_index=True), pd.concat(lefts, ignore_index=True)
    names = pd.Index(pd.unique(pd.concat([share.gram, left.gram], ignore_index=True)))
    hashes = np.array([_gram_hash(g) for g in names], dtype=np.uint64)
    order = np.argsort(hashes, kind="stable")
    row = np.empty(len(order), np.int64)
    row[order] = np.arange(len(order))
    tables = []
    for source, empty in ((share, 0.0), (left, 1.0)):
        values = np.full((len(names), len(langs)), empty)
        values[row[names.get_indexer(source.gram)], source.lang.map({x: k for k, x in enumerate(langs)})] = source.v
        tables.append(values)
    return Models(langs, hashes[order], *tables)


def _gram_hash(gram: str) -> int:
    codes = np.array([ord(c) + 1 for c in gram], dtype=np.uint64)
    sums = _sums(codes)[len(gram)][-1:] if gram else np.zeros(1, np.uint64)
    return int(_mixed(sums, len(gram))[0])


def fit(docs: DataFrame, sample: int = SAMPLE) -> Models:
    rows = stored(training_rows(docs, sample), "training")
    grams = count_grams(rows.filter(~F.col("calibrates"))).toPandas()
    langs = sorted(grams.lang.unique())
    if not langs:
        return Models([], np.empty(0, np.uint64), np.empty((0, 0)), np.empty((0, 0)))
    models = fit_table(grams, langs)
    models.usual, models.limit, models.between = _calibrate(models, rows.filter("calibrates"))
    return models


def _calibrate(models: Models, rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_limits`` per language, of documents that taught nothing and whose label is predicted (without any: no limit)."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(part: pa.RecordBatch, texts: list[str]) -> dict:
        split = [words_of(t) for t in texts]
        shared.value.prepare(split)
        found = [shared.value.predict(w) for w in split]
        return {
            "label": part.column("lang"), "lang": [x[0] for x in found], "entropy": [x[2] for x in found], "n": [x[3] for x in found],
        }

    schema = "label string, lang string, entropy double, n long"
    found = map_texts(rows, ["lang", "text"], schema, run).filter("n > 0 and label = lang").toPandas()
    usual, limit, between = np.full(len(models.langs), np.inf), np.full(len(models.langs), np.inf), np.zeros(len(models.langs))
    for k, lang in enumerate(models.langs):
        mine = found[found.lang == lang]
        if len(mine):
            usual[k], limit[k], between[k] = _limits(mine.entropy.to_numpy(), mine.n.to_numpy())
    return usual, limit, between


def _limits(entropy: np.ndarray, n: np.ndarray) -> tuple[float, float, float]:
    """Usual cross-entropy, the limit of distances from it, and the variance between long documents.

    The variance is given as a multiple of that of a single character. All rest on medians and on a quantile below the
    greatest distance, so no single document moves them far, however long or odd it is.
    """
    usual = float(np.median(entropy))
    above = entropy - usual
    long = n >= np.median(n)
    one = float(np.median(above**2 * n))
    between = max(float(np.median(above[long] ** 2)) / one - float(np.median(1 / n[long])), 0.0) if one else 0.0
    distance = above / np.sqrt(1 / n + between)
    return usual, max(SLACK * float(np.quantile(distance, QUANTILE, method="lower")), LEAST_LIMIT), between


def predict(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(models or fit(docs))  # bounded by the sample

    def run(rows: pa.RecordBatch, texts: list[str]) -> dict:
        models = shared.value
        split = [words_of(t) for t in texts]
        models.prepare(split)
        found = [models.predict(w) for w in split]
        return {
            "doc_id": rows.column("doc_id"), "held_out": rows.column("held_out"), "lang_pred": [x[0] for x in found],
            "score": [x[1] for x in found], "rejected": [models.rejects(x[0], x[2], x[3]) for x in found],
        }

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id")).alias("held_out")
    )
    return map_texts(rows, rows.columns, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean", run)


def keep(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(models or fit(docs))
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, at):
                split = [words_of(t) for t in texts]
                shared.value.prepare(split)
                found = (shared.value.predict(w) for w in split)
                yield rows.filter(pa.array([not shared.value.rejects(x[0], x[2], x[3]) for x in found]))

    return docs.mapInArrow(run, docs.schema)
