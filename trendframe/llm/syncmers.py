"""Fingerprints of closed syncmers, and likeness by matching them in order.

A piece of ``K`` characters is an anchor if the smallest hash of its inner pieces of ``S`` characters lies at its beginning
or its end. This depends on the piece alone, so a passage has the same anchors wherever it stands, and of
any ``K - S + 1`` neighbouring pieces at least one is an anchor. A fingerprint is the hashes of a text's
anchors in order, each once. Likeness is the share of anchors that two texts have in the same order (a
longest increasing subsequence of positions). A text of under ``SHORT`` characters, half of which may hold no anchor, has all its pieces of
``PIECE`` characters instead, so its likeness to longer texts is 0; one of at most ``PIECE`` has its own hash as the only one.

Defined results: a null text is empty, its fingerprint too; two empty texts have likeness 1, an empty one and another 0;
a null ``doc_id`` comes last in descending order; rows that repeat an id follow each other by text; a
single document is its own next; an empty table gives no row; other columns are not read. Long texts are hashed in
blocks.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendframe.llm.common import about, as_docs, map_texts, slices

K, S = 24, 8
#: Below this length a half may be too short for an anchor; such texts are fingerprinted by pieces of ``PIECE`` characters.
SHORT, PIECE = 2 * (2 * K - S), 4
BLOCK = 1 << 20
#: Ranges of ids per shuffle partition.
RANGES = 4
#: Sampled ids per range that cuts the ranges.
SAMPLE = 50
#: First characters of a text that cut ranges of rows with one id.
PREFIX = 64
_BASE = 0x100000001B3
_MIXER = np.uint64(0x9E3779B97F4A7C15)
_NULL = -(2**63)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIXER
    return h ^ (h >> np.uint64(29))


def _pieces(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash sums of all pieces of ``size`` codes, put together from pieces whose sizes are powers of two."""
    h, width, out, done = codes, 1, None, 0
    while width <= size:
        if size & width:
            part = h[done:] * np.uint64(pow(_BASE, done, 2**64))
            out = part if out is None else out[: len(part)] + part
            done += width
        if 2 * width <= size:
            h = h[: max(len(h) - width, 0)] + h[width:] * np.uint64(pow(_BASE, width, 2**64))
        width *= 2
    return out[: max(len(codes) - size + 1, 0)]


def _window_minimum(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[: len(h) - size], h[size:])
        size *= 2
    rest = width - size
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def _short(h: np.ndarray) -> np.ndarray:
    return (_mixed(h) >> np.uint64(32)).astype(np.uint32)


def _block_anchors(codes: np.ndarray) -> np.ndarray:
    inner = _mixed(_pieces(codes, S))
    least = _window_minimum(inner, K - S + 1)
    at = np.flatnonzero((inner[: len(least)] == least) | (inner[K - S :] == least))
    return _short(_pieces(codes, K)[at])


def anchors(text: str) -> np.ndarray:
    """Hashes of the anchors of ``text`` (or its short pieces), each where it first occurs."""
    if len(text) <= PIECE:
        whole = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:4]
        return np.frombuffer(whole if text else b"", dtype="<u4")
    if len(text) < SHORT:
        found = [_short(_pieces(_codes(text), PIECE))]
    else:
        found = [_block_anchors(_codes(text[start : start + BLOCK + K - 1])) for start in range(0, len(text) - K + 1, BLOCK)]
    out = np.concatenate(found)
    _, first = np.unique(out, return_index=True)
    return out[np.sort(first)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the anchors that both have in the same order, over the anchors of both."""
    if not len(a) and not len(b):
        return 1.0
    if np.array_equal(a, b):
        return 1.0
    common, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    order = in_b[np.argsort(in_a)]
    if (np.diff(order) > 0).all():
        return 2 * len(order) / (len(a) + len(b))
    tails: list[int] = []
    for x in order.tolist():
        k = bisect_left(tails, x)
        tails[k : k + 1] = [x]
    return 2 * len(tails) / (len(a) + len(b))


def as_text(a: np.ndarray) -> str:
    return a.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint): eight hexadecimal digits per anchor, in order."""

    def run(rows: pa.RecordBatch, texts: list[str]) -> dict:
        return {"doc_id": rows.column("doc_id"), "fingerprint": [as_text(anchors(t)) for t in texts]}

    return map_texts(as_docs(docs), ["doc_id", "text"], "doc_id long, fingerprint string", run)


def _with_followers(docs: DataFrame) -> DataFrame:
    """Rows (bucket, copy, key, doc_id, text) placed by ranges of ids, each range followed by the next one's first row.

    Ranges are cut at quantiles of a sample of rows by descending id and the first ``PREFIX`` characters of the text, so that rows that
    repeat an id, or have none, are dealt to several ranges too unless their texts begin alike. About ``SAMPLE`` rows
    are sampled for each range; there are ``RANGES`` for each
    shuffle partition, so that no partition gets many more rows than others. The boundary row, the first of every
    range, is sent to the range before as well (the very first to the last range), so that every row finds the
    one after it in its own partition. The driver gets the sample and one id and prefix per range.
    """
    spark = docs.sparkSession
    key = F.coalesce("doc_id", F.lit(_NULL))
    # From the greatest id to the least: the complement of a long reverses its order and cannot overflow.
    rows = as_docs(docs).withColumns({
        "key": key, "place": F.bitwise_not(key), "prefix": F.substring(F.coalesce("text", F.lit("")), 1, PREFIX),
    })
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = RANGES * n
    sample = sorted((r.place, r.prefix) for r in about(rows.select("place", "prefix"), SAMPLE * parts, "place", "prefix").collect())
    edges = sorted({sample[k * len(sample) // parts] for k in range(1, parts)}) if sample else []
    edge_places = np.array([e[0] for e in edges], np.int64)

    @F.arrow_udf("int")
    def bucket(place: pa.Array, prefix: pa.Array) -> pa.Array:
        """Ranges in the order of rows; each begins with its edge."""
        places = place.to_numpy(zero_copy_only=False)
        out = np.searchsorted(edge_places, places, side="left")
        for i in np.flatnonzero(out != np.searchsorted(edge_places, places, side="right")).tolist():  # ids of edges
            out[i] = bisect_right(edges, (int(places[i]), prefix[i].as_py()))
        return pa.array(out, pa.int32())

    placed = rows.withColumn("bucket", bucket("place", "prefix"))
    least = placed.groupBy("bucket").agg(F.min(F.struct("place", "prefix")).alias("first")).collect()
    firsts = sorted((r.bucket, r.first.place, r.first.prefix) for r in least)
    before = [(place, prefix, firsts[i - 1][0]) for i, (_, place, prefix) in enumerate(firsts)]
    boundary = spark.createDataFrame(before, "first long, start string, before int")  # a row per range
    heads = rows.join(F.broadcast(boundary), (F.col("place") == F.col("first")) & (F.col("prefix") == F.col("start")))
    copies = heads.groupBy("before").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).select(
        F.col("before").alias("bucket"), F.lit(True).alias("copy"), F.lit(_NULL).alias("key"), F.lit(None).cast("long").alias("doc_id"), "text"
    )
    own = placed.select("bucket", F.lit(False).alias("copy"), "key", "doc_id", "text")
    return own.union(copies).repartition(n, "bucket").sortWithinPartitions("bucket", "copy", F.desc("key"), "text")


def edit(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COMPARED = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)


def compare(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every whole text.

    The edited text ends with the beginning of the next document by descending id (after the last, the
    first); ``near_edited`` and ``near_next`` are the likeness to it and to the next document.
    """

    def one(doc_id: int | None, text: str, marks: np.ndarray, following: str, next_marks: np.ndarray) -> tuple:
        edited = edit(text, following)
        edited_marks = anchors(edited)
        return (
            doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_text(marks),
            as_text(edited_marks), likeness(marks, edited_marks), likeness(marks, next_marks),
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_bucket, waiting = None, None  # the row whose next one is still to come
        for batch in batches:
            for rows, texts in slices(batch):
                out = []
                columns = (rows.column(c).to_pylist() for c in ("bucket", "copy", "doc_id"))
                for b, copy, doc_id, text in zip(*columns, texts, strict=True):
                    if copy and (waiting is None or b != open_bucket):
                        continue  # a further row with the id of the boundary
                    marks = anchors(text)
                    if waiting is not None:
                        out.append(one(*waiting, text, marks))
                    open_bucket, waiting = b, None if copy else (doc_id, text, marks)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(_COMPARED)], schema=_COMPARED)
        if waiting is not None:
            raise ValueError("a range of ids without the row after it")

    return _with_followers(docs).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )
