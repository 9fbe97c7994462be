"""Quality classifier by importance resampling: how much likelier a text is among good documents than in the corpus.

Words, pairs of neighbouring words and words repeated after one other are hashed into ``BUCKETS``; the raw model has the bucket shares of all
documents, the target model those of documents labelled good (mixed with the raw ones by ``MIX``, so no share is 0).
A document's log weight is its mean log ratio, shrunk towards 0 for short texts, times a factor: the least with which the draw still parts
good from bad held-out documents nearly as well as a cut would (``temper``). Adding Gumbel
noise to log weights and keeping the ``k`` greatest sums samples ``k`` documents in proportion to their weights without
replacement, so a document above the cut is refused at times and one below it kept. ``k`` is the number of documents with a weight above the cut that best parts good from bad
labelled documents, which took no part in the target model.

Every document counts in the raw model and is weighed. Of labelled rows, about ``TARGET`` good ones, chosen by a
hash of their ids, make the target model and about ``HELD_OUT`` others the cut, each with the least weight of the documents
with its id; only these ids, the bucket sums and a weight per held-out id pass through the driver. The noise is a hash of id and text, so a task that is run
again keeps the same documents. The k-th greatest sum is found exactly by counting in ever narrower ranges.

Defined results: a null or empty text has log weight 0; a null ``doc_id`` is unlabelled; a document with
contradicting labels counts as bad; repeated rows have equal sums and are all kept or all refused, as are
ties at the last place; without good or without bad held-out labels nothing is refused; an empty table gives no row; all other
columns are kept, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendframe.llm.common import about, as_docs, fresh, held, slices, stored

BUCKETS = 10_000
MIX = 0.5
#: Labelled documents of the target model, and of the cut, about (never twice as many).
TARGET, HELD_OUT = 20_000, 10_000
#: n-grams that every text is taken to have in addition, with ratio 1.
PRIOR_GRAMS = 20
#: Greatest factor of the mean log ratio: a step of 0.005 in it weighs as much as the usual noise. Tempered on held-out labels.
SHARPNESS = 200.0
#: Parts of the log weight that are tried, and the share of good and of bad held-out documents that the draw may cost against the plain cut.
TEMPERS, COST = tuple(2.0**-k for k in range(10, -1, -1)), 0.01
#: Sums are compared as integers of this unit.
UNIT = 1e-9
SEED = 20

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_KNOWN_WORDS = 250_000
_SAME, _SAME_BUT_ONE = (np.uint64(xxhash.xxh64_intdigest(b"\0", k)) for k in (1, 2))
_MIXER = np.uint64(0x9E3779B97F4A7C15)


def buckets(text: str) -> np.ndarray:
    """Bucket numbers of the words, of the pairs of neighbours, and of words that come again after one other.

    All pairs of equal words share one bucket, and so do all of the last kind.
    """
    words = _TOKEN.findall(text.lower())
    known = held("resampling", dict)
    if len(known) > _KNOWN_WORDS:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    a, b = h[:-1], h[1:]
    pairs = a * _MIXER ^ (b + (a >> np.uint64(29)))
    pairs = np.where(a == b, _SAME, pairs ^ (pairs >> np.uint64(32)))
    again = np.full(np.count_nonzero(h[:-2] == h[2:]), _SAME_BUT_ONE)
    return (np.concatenate([h, pairs, again]) % np.uint64(BUCKETS)).astype(np.int64)


def labelled(labels: DataFrame, target: int = TARGET, held_out: int = HELD_OUT) -> tuple[set[int], dict[int, int]]:
    """Ids of the good documents of the target model; ids and labels of held-out documents (a quarter of the labelled)."""
    one = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    one = one.dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    out = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(4)) == 3
    good = about(one.filter(~out & (F.col("quality") == 1)), target, "doc_id").collect()
    rest = about(one.filter(out), held_out, "doc_id").collect()
    return {r.doc_id for r in good}, {r.doc_id: r.quality for r in rest}


def log_ratios(docs: DataFrame, target_ids: set[int]) -> np.ndarray:
    """Log ratio of target and raw share per bucket, from all ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(target_ids)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for rows, texts in slices(batch):
                grams = [buckets(text) for text in texts]
                good = [g for i, g in zip(rows.column("doc_id").to_pylist(), grams, strict=True) if i in shared.value]
                raw += np.bincount(np.concatenate(grams), minlength=BUCKETS)
                if good:
                    target += np.bincount(np.concatenate(good), minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"]
        )

    partial = as_docs(docs).mapInArrow(count, "bucket int, raw long, target long")
    sums = partial.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[sums.bucket], target[sums.bucket] = sums.raw, sums.target
    if not target.sum():
        return np.zeros(BUCKETS)
    base = (raw + 1) / (raw.sum() + BUCKETS)
    return np.log(MIX * base + (1 - MIX) * target / target.sum()) - np.log(base)


def weigh(docs: DataFrame, ratios: np.ndarray, held_out: dict[int, int], names: list[str]) -> DataFrame:
    """``docs`` with log weight, sampling sum and held-out label under these ``names``."""
    shared = docs.sparkSession.sparkContext.broadcast((ratios, held_out))
    schema = T.StructType([
        *docs.schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.LongType()),
        T.StructField(names[2], T.IntegerType()),
    ])
    text_at, id_at = (docs.columns.index(c) for c in ("text", "doc_id"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_ratio, labels = shared.value
        for batch in batches:
            for rows, texts in slices(batch, text_at):
                ids = rows.column(id_at).to_pylist()
                grams = [buckets(t) for t in texts]
                weights = [SHARPNESS * float(log_ratio[g].sum()) / (len(g) + PRIOR_GRAMS) for g in grams]
                noise = [xxhash.xxh64_intdigest(f"{i}\0{t}".encode("utf-8", "replace"), SEED) for i, t in zip(ids, texts, strict=True)]
                sums = [w - np.log(-np.log((u + 0.5) / 2**64)) for w, u in zip(weights, noise, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns, pa.array(weights, pa.float64()), pa.array([round(s / UNIT) for s in sums], pa.int64()),
                        pa.array([labels.get(i) for i in ids], pa.int32()),
                    ],
                    names=schema.names,
                )

    return docs.mapInArrow(run, schema)


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The cut with the greatest difference of kept shares of good and bad, half-way between its neighbours."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    gain = np.cumsum(~g) / (~g).sum() - np.cumsum(g) / g.sum()
    last = np.append(w[1:] > w[:-1], True)  # a cut lies between different weights only
    k = int(np.argmax(np.where(last, gain, -np.inf)))
    if gain[k] <= 0:
        return -np.inf
    return float(w[k] + w[k + 1]) / 2 if k + 1 < len(w) else float(w[k]) + 1


def temper(weights: np.ndarray, good: np.ndarray, cut: float) -> float:
    """The least of ``TEMPERS`` with which drawing as many as lie above ``cut`` parts good from bad nearly as well as the cut does.

    A log weight ``w`` with Gumbel noise passes ``t`` with probability ``1 - exp(-exp(w - t))``, so what a draw keeps is known beforehand.
    """
    above = weights >= cut
    for factor in TEMPERS:
        w = factor * weights
        chance = lambda t: -np.expm1(-np.exp(np.clip(w - t, -700, 700)))  # noqa: B023, E731
        low, high = w.min() - 50, w.max() + 50
        for _ in range(100):
            middle = (low + high) / 2
            low, high = (middle, high) if chance(middle).sum() > above.sum() else (low, middle)
        kept = chance(low)
        if kept[good].mean() >= above[good].mean() - COST and kept[~good].mean() <= above[~good].mean() + COST:
            return factor
    return 1.0


def kth_greatest(values: DataFrame, column: str, k: int, bins: int = 4096) -> int:
    """The ``k``-th greatest of a long column without nulls, by counts in ``bins`` ranges at a time."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) // bins + 1
        least = F.col(column) - F.pmod(F.col(column), F.lit(width))  # of the bin
        inside = values.filter(F.col(column).between(low, high))
        bins_of = inside.groupBy(least.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for r in sorted(bins_of.collect(), key=lambda r: -r.bin):
            if r.n >= k:
                low, high = r.low, r.high
                break
            k -= r.n
    return low


def sample(docs: DataFrame, labels: DataFrame, columns: list[str]) -> tuple[DataFrame, int | None, list[str]]:
    """Stored ``columns`` of ``docs`` with weight, sum and label; the least sum that is kept (None: all); their names."""
    target_ids, held_out = labelled(labels)
    names = fresh(docs, "log_weight", "sampling_sum", "held_out_label")
    weighed = stored(weigh(docs, log_ratios(docs, target_ids), held_out, names).select(*columns, *names), "weights")
    seen = weighed.filter(F.col(names[2]).isNotNull())  # a row per held-out id, however often documents repeat it
    rows = seen.groupBy("doc_id").agg(F.min(names[0]).alias(names[0]), F.min(names[2]).alias(names[2])).toPandas()
    cut = best_cut(rows[names[0]].to_numpy(float), rows[names[2]].to_numpy() == 1) if len(rows) else -np.inf
    if cut == -np.inf:
        return weighed, None, names
    k = weighed.filter(F.col(names[0]) >= cut).count()
    if not k:
        return weighed, 2**63 - 1, names
    factor = temper(rows[names[0]].to_numpy(float), rows[names[2]].to_numpy() == 1, cut)
    noise = F.col(names[1]) - F.rint(F.col(names[0]) / UNIT).cast("long")
    drawn = weighed.withColumn(names[1], F.rint(F.col(names[0]) * (factor / UNIT)).cast("long") + noise)
    drawn = drawn.withColumn(names[0], F.col(names[0]) * factor)
    return drawn, kth_greatest(drawn, names[1], k), names


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, log_weight, sampling_sum, kept) of every document."""
    weighed, least, names = sample(as_docs(docs), labels, ["doc_id"])
    kept = F.lit(True) if least is None else F.col(names[1]) >= least
    return weighed.select("doc_id", F.col(names[0]).alias("log_weight"), F.col(names[1]).alias("sampling_sum"), kept.alias("kept"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The sampled documents, with the columns of ``docs``."""
    weighed, least, names = sample(docs, labels, docs.columns)
    return (weighed if least is None else weighed.filter(F.col(names[1]) >= least)).select(*docs.columns)
