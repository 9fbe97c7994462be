"""Similarity join on word n-grams: MinHash banding finds candidates, full n-gram sets decide.

Texts with the same n-gram set are one node from the start, so copies cost nothing further. A node's MinHash values
are cut into bands; ``bands_for`` chooses how many bands of how many rows find a pair at the threshold
with the target recall. Nodes that agree in a band share a bucket. Buckets with the same members are
reduced to one, large ones are cut into blocks whose pairs are separate units of work, and each unit
compares its nodes by their full sets. A pair is compared in the smallest of its common buckets only, which
both sides know from their bands, so no list of pairs is ever made: a unit returns per node the
number of linked documents and the least node it hangs together with. Links then join to classes by
alternating star contractions, each of which is stored.

Words are what white space of ASCII separates; a text of fewer words than ``n`` is one n-gram of all.

Defined results: a null text, or one without words, is similar to none and is its own class; a null ``doc_id`` is
no class id while another id is in the class; each repeated row counts as a document; an empty
table gives no row; other columns are kept by ``distinct`` and not read by ``classes``. A text of any length is compared whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendframe.llm.common import as_docs, fresh, held, parts, slices, stored

N, THRESHOLD = 5, 0.8
RECALL, MOST_HASHES = 0.9999, 128
#: Nodes per block of a large bucket; a unit compares at most two blocks.
BLOCK = 256
#: Bytes of text per block, about; a longer text is a large part of its block.
BLOCK_BYTES = 8_000_000
#: Rows of 64 bits that are sent to every task, about 50 MB in memory; they stand for up to 64 million documents.
BROADCAST_WORDS = 1_000_000
_KNOWN_WORDS = 250_000
_MIXER = np.uint64(0x9E3779B97F4A7C15)


def bands_for(threshold: float, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective rows for which ``recall`` at ``threshold`` needs no more than ``most`` hashes."""
    if threshold >= 1:
        return 1, 1
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError("no banding with so few hashes reaches this recall")
    return best


def shingles(text: str, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of ``text``."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    known = held("shingles", dict)
    if len(known) > _KNOWN_WORDS:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(n, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = (out ^ (out >> np.uint64(31))) * _MIXER + h[k : len(h) - size + 1 + k]
    out = (out ^ (out >> np.uint64(29))) * _MIXER
    return np.unique(out ^ (out >> np.uint64(32)))


class Bands:
    """Band keys of n-gram sets."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        seeds = np.array([xxhash.xxh64_intdigest(b"minhash", s) for s in range(2 * bands * rows)], dtype=np.uint64)
        self.factor, self.shift = seeds[::2] | np.uint64(1), seeds[1::2]

    def keys(self, grams: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factor), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(grams), 2048):
            part = grams[at : at + 2048, None] * self.factor + self.shift
            np.minimum(least, part.min(axis=0), out=least)
        values = least.reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=np.uint64) * _MIXER
        for k in range(self.rows):
            key = (key ^ (key >> np.uint64(31)) ^ values[:, k]) * _MIXER
        return (key ^ (key >> np.uint64(32))).view(np.int64)


def sketch(docs: DataFrame, n: int, bands: int, rows: int, names: list[str]) -> DataFrame:
    """``docs`` with a row number, the hash of the n-gram set (null without words) and band keys under these names."""
    schema = T.StructType([
        *docs.schema.fields, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.BinaryType()),
        T.StructField(names[2], T.ArrayType(T.LongType())),
    ])
    text_at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, number = Bands(bands, rows), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part, texts in slices(batch, text_at):
                sets = [shingles(t, n) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns, pa.array(range(number, number + len(sets)), pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([make.keys(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=schema.names,
                )
                number += len(sets)

    return docs.mapInArrow(run, schema)


def with_rows(table: DataFrame, row: str, chosen: DataFrame) -> DataFrame:
    """The rows of ``table`` whose number is in ``chosen``, a table of one column that may repeat numbers.

    A join would shuffle ``table`` with its texts to find out which rows to drop. Rows are numbered one after the other in each
    partition, so the numbers are kept as bits, 64 to a row, and those go to all tasks: less than a byte for each row of ``table``. Beyond
    ``BROADCAST_WORDS`` of them Spark plans the join as it sees fit.
    """
    number, word, bits = F.col(chosen.columns[0]), *fresh(table, "word", "bits")
    bit = lambda n: F.expr(f"shiftleft(1L, cast(`{n}` & 63 AS INT))")
    words = chosen.filter(number.isNotNull()).groupBy(F.shiftright(number, 6).alias(word)).agg(F.bit_or(bit(chosen.columns[0])).alias(bits))
    words = stored(words, "words")
    if words.count() <= BROADCAST_WORDS:
        words = F.broadcast(words)
    joined = table.join(words, F.shiftright(F.col(row), 6) == F.col(word))
    return joined.filter(F.col(bits).bitwiseAND(bit(row)) != 0).select(*table.columns)


def _units(nodes: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """(bucket, low, high, block, node): the nodes of every unit of work; ``sizes`` has the bytes of each node's text (node, bytes)."""
    member = nodes.select("node", F.explode("bands").alias("bucket"))
    # Members are summed up by two hashes; equal sets of members are one bucket.
    groups = member.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")
    )
    kept = groups.filter("size > 1").groupBy("size", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "size")
    chosen = member.join(kept, "bucket")
    blocks = F.ceil(F.col("size") / BLOCK)
    if sizes is not None:
        # Sizes come to the members of kept buckets only, which are few: carried along, they would go through every shuffle of all bands.
        total = chosen.select("bucket", "node").join(sizes, "node").groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
        chosen = chosen.join(total, "bucket")
        # Never more blocks than nodes, which one text of many times the limit would ask for.
        blocks = F.least("size", F.greatest(blocks, F.ceil(F.col("bytes") / BLOCK_BYTES)))
    blocks = blocks.cast("int")
    own = F.pmod(F.xxhash64("node", "bucket"), blocks).cast("int")
    placed = chosen.select("bucket", "node", own.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    return placed.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node")


def _compare(unit: list[tuple], bucket: int, across: bool, make: Bands, n: int, threshold: float) -> list[tuple]:
    """(node, linked documents, least node reached) of the nodes with links; ``unit``: (node, block, copies, text)."""
    sets = [shingles(text, n) for _, _, _, text in unit]
    keys = np.array([make.keys(s) for s in sets])
    pairs = np.triu(np.ones((len(unit), len(unit)), bool), 1)
    if across:
        block = np.array([u[1] for u in unit])
        pairs &= block[:, None] != block[None, :]
    for k in range(keys.shape[1]):
        column = keys[:, k]
        earlier = column < bucket
        if earlier.any():
            pairs &= ~((column[:, None] == column[None, :]) & earlier)
    if not pairs.any():
        return []
    sizes = np.array([len(s) for s in sets])
    shared = _intersections(sets)
    linked = pairs & (shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9)
    linked |= linked.T
    copies, nodes = np.array([u[2] for u in unit]), np.array([u[0] for u in unit])
    counts, root = linked @ copies, nodes.copy()
    while True:  # least node along the links
        least = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (least == root).all():
            break
        root = least
    return [(nodes[i], counts[i], root[i]) for i in np.flatnonzero(linked.any(axis=1))]


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from the n-grams that more than one set has."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, gram, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count > 1
    number = np.cumsum(often) - 1
    keep = often[gram]
    owner, gram = owner[keep], number[gram[keep]]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(often.sum()), 4096):
        a, b = np.searchsorted(gram, [start, start + 4096])
        has = np.zeros((len(sets), 4096), np.float32)
        has[owner[a:b], gram[a:b] - start] = 1
        out += has @ has.T
    return out.astype(np.int64)


def _links(units: DataFrame, texts: DataFrame, n: int, threshold: float, bands: int, rows: int) -> DataFrame:
    """(node, linked, root) of every unit, from its nodes' texts (node, copies, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Bands(bands, rows)
        key, unit = None, []
        for batch in batches:
            for part in parts(batch):
                found = []
                columns = [part.column(c).to_pylist() for c in ("bucket", "low", "high", "node", "block", "copies", "text")]
                for bucket, low, high, *row in zip(*columns, strict=True):
                    if (bucket, low, high) != key:
                        if len(unit) > 1:
                            found += _compare(unit, key[0], key[1] != key[2], make, n, threshold)
                        key, unit = (bucket, low, high), []
                    unit.append(row)
                yield _found(found)
        if len(unit) > 1:
            yield _found(_compare(unit, key[0], key[1] != key[2], make, n, threshold))

    def _found(rows: list[tuple]) -> pa.RecordBatch:
        names = ["node", "linked", "root"]
        return pa.RecordBatch.from_arrays([pa.array([int(r[i]) for r in rows], pa.int64()) for i in range(3)], names=names)

    work = units.join(texts, "node").repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")
    return work.select("bucket", "low", "high", "node", "block", "copies", "text").mapInArrow(run, "node long, linked long, root long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that each node of ``edges`` (a, b) hangs together with.

    Large and small star contraction in turn: every round ties neighbours to the least node known, and
    the number of rounds grows with the logarithm of a component's size. Every round is stored.
    """
    edges = stored(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, F.col("b") > F.col("a"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        edges = stored(_star(down, F.lit(True), own=True), "edges")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _star(edges: DataFrame, chosen: Column, own: bool = False) -> DataFrame:
    """Tie the chosen neighbours of each node to its least neighbour or itself; with ``own``, the node as well."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = edges.join(least, "a").filter(chosen).select(F.col("b").alias("a"), F.col("m").alias("b"))
    if own:
        tied = tied.union(least.select("a", F.col("m").alias("b")))
    return tied.filter("a <> b").distinct()


def _classified(sketched: DataFrame, names: list[str], n: int, threshold: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (set, node, copies, id, linked, root), and stored links; ``sketched`` is a stored table."""
    row, key, keys = (F.col(c) for c in names)
    grouped = sketched.filter(key.isNotNull()).groupBy(key.alias("set")).agg(
        F.min(row).alias("node"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("id")
    )
    nodes = stored(grouped, "nodes")
    banded = with_rows(sketched.select(row.alias("node"), keys.alias("bands")), "node", nodes.select("node"))
    sizes = sketched.select(row.alias("node"), F.octet_length(F.col("text").cast("string")).alias("bytes"))
    # Only texts that a unit compares are shuffled; the others share no bucket.
    units = stored(_units(banded, sizes), "units")
    texts = with_rows(sketched.select(row.alias("node"), F.col("text").cast("string").alias("text")), "node", units.select("node"))
    texts = texts.join(nodes.select("node", "copies"), "node")
    found = stored(_links(units, texts, n, threshold, bands, rows), "links")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    joined = nodes.join(linked, "node", "left").join(roots, "node", "left")
    return joined.select("set", "node", "copies", "id", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("root", "node").alias("root")), found


def classes(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links) of every document.

    ``class_id`` is the least ``doc_id`` that links lead to, ``n_links`` the number of other documents whose similarity
    is ``threshold`` or more, copies among them.
    """
    docs, names = as_docs(docs), ["row", "set", "bands"]
    bands, rows = bands_for(threshold, recall)
    sketched = stored(sketch(docs, n, bands, rows, names), "sketches")
    nodes, _ = _classified(sketched, names, n, threshold, bands, rows)
    nodes = stored(nodes, "classified")
    ids = nodes.groupBy("root").agg(F.min("id").alias("class_id"))
    of_set = nodes.join(ids, "root").select("set", "class_id", (F.col("copies") - 1 + F.col("linked")).alias("n_links"))
    joined = sketched.select("doc_id", "set").join(of_set, "set", "left")
    alone = F.col("set").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def distinct(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row of ``docs`` per class, that with the least ``doc_id`` (null last); rows without words all stay."""
    names = fresh(docs, "row", "set", "bands")
    bands, rows = bands_for(threshold, recall)
    sketched = stored(sketch(docs, n, bands, rows, names), "sketches")
    nodes, _ = _classified(sketched, names, n, threshold, bands, rows)
    row, key = F.col(names[0]), F.col(names[1])
    of_row = sketched.select(row.alias("r"), F.coalesce("doc_id", F.lit(2**63 - 1)).alias("d"), key.alias("set"))
    # The best row of each set first, combined before the shuffle; a class then has a row per different text.
    best = of_row.filter("set is not null").groupBy("set").agg(F.min(F.struct("d", "r")).alias("best"))
    kept = nodes.select("set", "root").join(best, "set").groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.r").alias("r"))
    alone = of_row.filter("set is null").select("r")
    return with_rows(sketched, names[0], kept.union(alone)).select(*docs.columns)
