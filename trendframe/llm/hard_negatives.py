"""Hard negatives by exact search in Hilbert-ordered blocks with zone maps.

Candidates are ordered along a Hilbert curve through all dimensions and written as Parquet, one row per block of
neighbouring vectors, in a folder per stretch of the curve. Beside its vectors a block has its zone map: the least and greatest value
of every dimension and of the label. Anchors come in waves of a bounded number, neighbours on the curve, each of which is
broadcast. For an anchor and a block interval arithmetic gives the least and greatest inner product that the
block can hold, from the zone map alone; a block is read if that interval meets one of the anchor's windows.

An anchor has windows of scores: everything, for its positives, then one for each positive's negatives. A window is open from
above at its bound and from below at the score that its last place has so far, which the block that holds
the anchor gives first and which rises while a task reads. So bounds only skip what cannot be among the first, and the result is
that of comparing all pairs. No pair is written: a task hands on the first few of each window, and these are merged.

Folders of blocks that no anchor of a wave needs are not opened: the chosen blocks are stored and joined by folder and block. While they
are few enough to be broadcast by their measured size, Spark prunes the folders at run time; beyond that it joins by a shuffle.

Defined results: rows with a null label, a null vector or any null or non-finite component take no part; a shorter
vector counts as filled up with zeros; an empty vector scores 0; rows with a null id take part, after all ids among ties, are no
anchors, and are returned as null (so is the greatest long); of rows with the same id each is one of its own, and
an anchor's other rows include its copies; ties beyond id and score hold equal values. Extra columns are not read, an empty
table or one without anchors gives no row. Scores must stay below 2**53, else an error says so. The work is
the number of anchors times the number of rows that bounds leave: exact search in many dimensions cannot promise less.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendframe.llm.common import stored
from trendframe.session import scratch_dir

#: Bits per dimension of a place on the curve.
CURVE_BITS = 4
#: Rows of a block at most, and bytes of its vectors at most; bytes of vectors in a folder of blocks.
BLOCK_ROWS, BLOCK_BYTES, FOLDER_BYTES = 512, 1 << 20, 1 << 25
#: Anchors of a wave at most, and bytes of their vectors at most: what is broadcast.
WAVE_ROWS, WAVE_BYTES = 16_384, 1 << 23
#: Anchors whose scores with a block are in memory at a time.
TILE = 1024
#: Room for the rows of one folder in the number of a row.
FOLDER_ROWS = 1 << 40
_LAST = np.iinfo(np.int64).max


def quantised(df: DataFrame, scale: int = 256, key: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """(vec_id, label, q) of the rows that take part; ``q`` holds ``floor(scale * x)`` of each component as double."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(vector)
    return df.filter(F.col(label).isNotNull() & v.isNotNull() & F.forall(v, finite)).select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("q"),
    )


def hilbert_keys(points: np.ndarray, bits: int) -> list[bytes]:
    """The place on the Hilbert curve of each row of ``points`` (0 to 2**bits - 1), as bytes that sort along it.

    Skilling's method (2004), a column of all rows at a time: undo the rotations of each level, Gray-encode, interleave.
    """
    x = points.astype(np.int64)
    n = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            turned = (x[:, i] & bit) != 0
            swap = np.where(turned, low, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= swap
            x[:, i] ^= np.where(turned, 0, swap)
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip[:, None]
    planes = (x[:, None, :] >> np.arange(bits - 1, -1, -1)[None, :, None]) & 1
    packed = np.packbits(planes.reshape(len(x), -1).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


@dataclass(frozen=True)
class _Shape:
    """What all tasks need to know of the vectors: dimensions, range of values, and the types that hold them exactly."""

    dims: int
    low: int
    high: int

    @property
    def greatest(self) -> int:
        return max(self.dims * max(abs(self.low), abs(self.high)) ** 2, 1)

    @property
    def kept(self) -> str:
        return "<i2" if max(abs(self.low), abs(self.high)) < 1 << 15 else "<i4"

    @property
    def exact(self) -> type:
        """A type in which every inner product and every partial sum of one is exact."""
        return np.float32 if self.greatest < 1 << 24 else np.float64

    @property
    def width(self) -> int:
        return self.dims * np.dtype(self.kept).itemsize

    @property
    def block(self) -> int:
        return max(1, min(BLOCK_ROWS, BLOCK_BYTES // self.width))

    @property
    def wave(self) -> int:
        return max(1, min(WAVE_ROWS, WAVE_BYTES // self.width))

    def matrix(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, dtype=self.kept).reshape(-1, self.dims).astype(self.exact)


def _shape(rows: DataFrame) -> tuple[_Shape, int]:
    low, high = F.array_min("q").alias("low"), F.array_max("q").alias("high")
    found = rows.select(F.size("q").alias("dims"), low, high).agg(
        F.max("dims"), F.min("low"), F.max("high"), F.count(F.lit(1))
    )
    dims, least, most, n = found.first()
    shape = _Shape(max(dims or 0, 1), least or 0, most or 0)
    if shape.greatest >= 1 << 53:
        raise ValueError("vectors are too long or too large: a score could reach 2**53")
    return shape, n


_KEYED = "vec_id long, label long, place binary, vector binary"
_BLOCKS = (
    "folder int, block int, n int, label_low long, label_high long, low binary, high binary, ids binary, labels binary, vectors binary"
)


def _keyed(rows: DataFrame, shape: _Shape) -> DataFrame:
    """Each row with its place on the curve and its components as bytes."""
    cells = (1 << CURVE_BITS) / (shape.high - shape.low + 1)

    def run(batches):
        for batch in batches:
            lists = batch.column("q")
            x = np.zeros((len(lists), shape.dims), dtype=np.int64)
            sizes = np.diff(lists.offsets.to_numpy())
            x[np.repeat(np.arange(len(lists)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
            places = hilbert_keys(((x - shape.low) * cells).astype(np.int64), CURVE_BITS)
            vectors = [v.tobytes() for v in x.astype(shape.kept)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(places, pa.binary()), pa.array(vectors, pa.binary())],
                names=["vec_id", "label", "place", "vector"],
            )

    return rows.select("vec_id", "label", "q").mapInArrow(run, _KEYED)


def write_blocks(rows: DataFrame, shape: _Shape, n: int) -> DataFrame:
    """Blocks of ``rows`` along the curve with their zone maps, as Parquet in a folder per stretch of the curve."""
    spark = rows.sparkSession
    keyed = stored(_keyed(rows, shape).withColumn("row", F.monotonically_increasing_id()), "vectors")
    folders = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * shape.width // FOLDER_BYTES))
    # The number of the row parts copies of one vector, however many there are.
    order = [F.col("place"), F.col("vec_id").asc_nulls_last(), F.col("row")]
    along = keyed.repartitionByRange(folders, *order).sortWithinPartitions(*order).drop("place", "row")

    def run(batches):
        folder, number, held, count = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            while count >= shape.block:
                whole = pa.Table.from_batches(held)
                yield _block(whole.slice(0, shape.block), folder, number, shape)
                rest, number = whole.slice(shape.block), number + 1
                held, count = rest.to_batches(), rest.num_rows
        if count:
            yield _block(pa.Table.from_batches(held), folder, number, shape)

    path = scratch_dir(spark, "blocks")
    along.mapInArrow(run, _BLOCKS).write.partitionBy("folder").parquet(path)
    return spark.read.schema(_BLOCKS).parquet(path)


def _block(rows: pa.Table, folder: int, number: int, shape: _Shape) -> pa.RecordBatch:
    vectors = rows.column("vector").combine_chunks()
    data = b"".join(vectors.to_pylist())
    x = np.frombuffer(data, dtype=shape.kept).reshape(len(rows), shape.dims)
    ids = rows.column("vec_id").fill_null(_LAST).to_numpy().astype("<i8")
    labels = rows.column("label").to_numpy().astype("<i8")
    values = [
        folder, number, len(rows), int(labels.min()), int(labels.max()), x.min(axis=0).tobytes(), x.max(axis=0).tobytes(),
        ids.tobytes(), labels.tobytes(), data,
    ]
    schema = _arrow(_BLOCKS)
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def _arrow(columns: str) -> pa.Schema:
    """The Arrow schema of columns given as ``name type, ...``; workers have no session that could parse them."""
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, types[kind]) for name, kind in map(str.split, columns.split(","))])


_ANCHORS = "folder int, block int, number long, vec_id long, label long, vector binary"


def _anchors(blocks: DataFrame, shape: _Shape, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``, with the block that holds each and its wave."""

    def run(batches):
        for batch in batches:
            for b in batch.to_pylist():
                ids = np.frombuffer(b["ids"], "<i8")
                at = np.flatnonzero((ids % every == 0) & (ids != _LAST))
                vectors = np.frombuffer(b["vectors"], shape.kept).reshape(-1, shape.dims)[at]
                first = b["folder"] * FOLDER_ROWS + b["block"] * shape.block
                columns = [
                    [b["folder"]] * len(at), [b["block"]] * len(at), first + at, ids[at], np.frombuffer(b["labels"], "<i8")[at],
                    [v.tobytes() for v in vectors],
                ]
                schema = _arrow(_ANCHORS)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    found = stored(blocks.select("folder", "block", "ids", "labels", "vectors").mapInArrow(run, _ANCHORS), "anchors")
    # A row per folder gives each folder's place among all anchors; a folder's own anchors are ordered within it.
    before = Window.orderBy("folder").rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.groupBy("folder").agg(F.count(F.lit(1)).alias("n"))
    firsts = sizes.select("folder", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.col("first") + F.row_number().over(Window.partitionBy("folder").orderBy("number")) - 1
    return found.join(firsts, "folder").select(*found.columns, F.floor(place / shape.wave).alias("wave"))


@dataclass
class _Wave:
    """Anchors, their windows, and how many rows a window takes. Scores within ``floor`` and ``ceiling`` count."""

    number: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    home: np.ndarray
    floor: np.ndarray
    ceiling: np.ndarray
    take: int
    same_label: bool

    @classmethod
    def of(cls, table: pa.Table, shape: _Shape, take: int) -> _Wave:
        """With one window, of the anchor's own label, for all scores."""
        number, ids, labels, folder, block = (table.column(c).to_numpy() for c in ("number", "vec_id", "label", "folder", "block"))
        vectors = shape.matrix(b"".join(table.column("vector").to_pylist()))
        n = len(number)
        home = folder.astype(np.int64) * FOLDER_ROWS + block
        return cls(number, ids, labels, vectors, home, np.full((n, 1), -np.inf), np.full((n, 1), np.inf), take, True)

    def reach(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and greatest score of each anchor (row) with vectors between ``low`` and ``high`` (a column each)."""
        up, down = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)
        return up @ low.T + down @ high.T, up @ high.T + down @ low.T

    def wants(self, low: np.ndarray, high: np.ndarray, label_low: np.ndarray, label_high: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Whether each anchor (row) must read each block (column): the interval of scores meets a window."""
        least, most = self.reach(low, high)
        wanted = np.zeros(least.shape, dtype=bool)
        for w in range(floor.shape[1]):
            wanted |= (most >= floor[:, w, None]) & (least <= self.ceiling[:, w, None]) & (floor[:, w] <= self.ceiling[:, w])[:, None]
        if self.same_label:
            return wanted & (label_low <= self.labels[:, None]) & (self.labels[:, None] <= label_high)
        return wanted & ~((label_low == self.labels[:, None]) & (label_high == self.labels[:, None]))


class _Best:
    """The first rows of every window so far. Windows are numbered anchor by anchor."""

    def __init__(self, wave: _Wave):
        self.wave, self.floor = wave, wave.floor.copy()
        self.rows = np.zeros((4, 0), dtype=np.int64)  # window, score, id, number
        self.new: list[np.ndarray] = []
        self.waiting = 0

    def read(self, anchors: np.ndarray, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, first: int) -> None:
        """Compare ``anchors`` with the rows of a block, the first of which has number ``first``."""
        for k in range(0, len(anchors), TILE):
            a = anchors[k : k + TILE]
            scores = self.wave.vectors[a] @ vectors.T
            row, column = np.nonzero((scores >= self.floor[a].min(axis=1)[:, None]) & (scores <= self.wave.ceiling[a].max(axis=1)[:, None]))
            anchor, score = a[row], scores[row, column]
            fits = (labels[column] == self.wave.labels[anchor]) == self.wave.same_label
            fits &= self.wave.number[anchor] != first + column
            anchor, column, score = anchor[fits], column[fits], score[fits]
            for w in range(self.floor.shape[1]):
                inside = (score >= self.floor[anchor, w]) & (score <= self.wave.ceiling[anchor, w])
                window, at = anchor[inside] * self.floor.shape[1] + w, column[inside]
                self.new.append(np.stack([window, score[inside].astype(np.int64), ids[at], first + at]))
                self.waiting += len(at)
            if self.waiting > 100_000 + 2 * self.rows.shape[1]:
                self.settle()

    def settle(self) -> None:
        """Keep the first rows of each window, and raise the floors of the full ones."""
        rows = np.concatenate([self.rows, *self.new], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        starts = np.flatnonzero(np.diff(rows[0], prepend=-1))
        place = np.arange(rows.shape[1]) - np.repeat(starts, np.diff(np.append(starts, rows.shape[1])))
        last = place == self.wave.take - 1
        self.floor.reshape(-1)[rows[0][last]] = rows[1][last]
        self.rows, self.new, self.waiting = rows[:, place < self.wave.take], [], 0


_HITS = "window long, score long, id long, number long"


def _blocks_of(batches) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def _hits(blocks: DataFrame, shape: _Shape, sent, at_home: bool) -> DataFrame:
    """The first rows of each window among those of every task's blocks; ``at_home``: of the anchors' own block only."""

    def run(batches):
        wave: _Wave = sent.value
        best = _Best(wave)
        for b in _blocks_of(batches):
            if at_home:
                chosen = np.flatnonzero(wave.home == b["folder"] * FOLDER_ROWS + b["block"])
            else:
                if best.waiting > best.rows.shape[1] // 4:
                    best.settle()
                zone = shape.matrix(b["low"]), shape.matrix(b["high"]), np.array([b["label_low"]]), np.array([b["label_high"]])
                chosen = np.flatnonzero(wave.wants(*zone, best.floor)[:, 0])
            if len(chosen):
                ids, labels = np.frombuffer(b["ids"], "<i8"), np.frombuffer(b["labels"], "<i8")
                best.read(chosen, shape.matrix(b["vectors"]), ids, labels, b["folder"] * FOLDER_ROWS + b["block"] * shape.block)
        best.settle()
        for k in range(0, best.rows.shape[1], 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[k : k + 100_000]) for c in best.rows], names=["window", "score", "id", "number"])

    return blocks.mapInArrow(run, _HITS)


def _first(hits: DataFrame, take: int) -> DataFrame:
    order = Window.partitionBy("window").orderBy(F.desc("score"), "id", "number")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= take)


def chosen_blocks(blocks: DataFrame, shape: _Shape, sent) -> DataFrame:
    """(folder, block) of the blocks that some anchor of the wave must read, from their zone maps alone."""

    def run(batches):
        wave: _Wave = sent.value
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                low, high = (shape.matrix(b"".join(part.column(c).to_pylist())) for c in ("low", "high"))
                labels = (part.column(c).to_numpy() for c in ("label_low", "label_high"))
                wanted = pa.array(wave.wants(low, high, *labels, wave.floor).any(axis=0))
                yield part.select(["folder", "block"]).filter(wanted)

    zones = blocks.select("folder", "block", "label_low", "label_high", "low", "high")
    return zones.mapInArrow(run, "folder int, block int")


def _search(spark: SparkSession, blocks: DataFrame, shape: _Shape, wave: _Wave) -> DataFrame:
    """The first rows of each window of ``wave`` among all rows: (window, score, id, number, rank)."""
    low, high = int(wave.home.min() // FOLDER_ROWS), int(wave.home.max() // FOLDER_ROWS)
    homes = blocks.filter(F.col("folder").between(low, high))
    sent = spark.sparkContext.broadcast(wave)  # WAVE_ROWS anchors at most
    # A window's last place at home: at most one row for each window of the wave.
    at_home = _first(_hits(homes, shape, sent, at_home=True), wave.take).filter(F.col("rank") == wave.take)
    reached = at_home.select("window", "score").toArrow()
    wave.floor = wave.floor.copy()
    window, score = reached.column("window").to_numpy(), reached.column("score").to_numpy()
    wave.floor.reshape(-1)[window] = np.maximum(wave.floor.reshape(-1)[window], score)
    sent = spark.sparkContext.broadcast(wave)
    chosen = stored(chosen_blocks(blocks, shape, sent), "chosen-blocks")
    return _first(_hits(only(blocks, chosen), shape, sent, at_home=False), wave.take)


def only(blocks: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen blocks. The filter, true of all, lets the planner prune folders by ``chosen`` where it broadcasts it."""
    return blocks.join(chosen.filter(F.col("folder") >= 0), ["folder", "block"])


def mine(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for ``rows`` of (vec_id, label, q).

    Anchors are rows whose id is divisible by ``every``. Their positives are the first other rows of their label, by inner product
    and then id; the negatives of each are the first rows of other labels that score ``low`` to ``high`` percent of the positive.
    """
    spark = rows.sparkSession
    shape, n = _shape(rows)
    blocks = write_blocks(rows, shape, n)
    path = scratch_dir(spark, "anchors-by-wave")
    _anchors(blocks, shape, every).write.partitionBy("wave").parquet(path)
    anchors = spark.read.schema(f"{_ANCHORS}, wave long").parquet(path)
    waves = anchors.agg(F.max("wave")).first()[0]
    out = scratch_dir(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(f"{out}/none")
    for k in range(0 if waves is None else waves + 1):
        wave = _Wave.of(anchors.filter(F.col("wave") == k).sort("number").toArrow(), shape, positives)
        found = _first_positives(_search(spark, blocks, shape, wave).toArrow(), wave, positives)
        wave.floor, wave.ceiling = _windows(found, low, high)
        wave.take, wave.same_label = negatives, False
        hits = _search(spark, blocks, shape, wave)
        _named(hits, spark.sparkContext.broadcast((wave.ids, *found)), schema).write.parquet(f"{out}/wave-{k}")
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out)


def _first_positives(table: pa.Table, wave: _Wave, positives: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and scores of each anchor's positives by rank, and which there are."""
    shape = (len(wave.ids), positives)
    ids, scores, there = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape, bool)
    window, rank = table.column("window").to_numpy(), table.column("rank").to_numpy() - 1
    ids[window, rank], scores[window, rank], there[window, rank] = table.column("id").to_numpy(), table.column("score").to_numpy(), True
    return ids, scores, there


def _windows(found: tuple[np.ndarray, np.ndarray, np.ndarray], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative of each positive; of one that is not there none fits."""
    _, scores, there = found
    floor, ceiling = -((-low * scores) // 100), high * scores // 100
    return np.where(there, floor, np.inf), np.where(there, ceiling, -np.inf)


def _named(hits: DataFrame, sent, schema: str) -> DataFrame:
    """Hits with the anchor and positive that their window stands for."""

    def run(batches):
        anchor_ids, ids, scores, _ = sent.value
        for batch in batches:
            window = batch.column("window").to_numpy()
            anchor, positive = window // ids.shape[1], window % ids.shape[1]
            named = [
                pa.array(anchor_ids[anchor]), pa.array(ids[anchor, positive]), batch.column("rank"), batch.column("id"),
                pa.array(scores[anchor, positive]), batch.column("score"),
            ]
            yield pa.RecordBatch.from_arrays(named, schema=_arrow(schema))

    known = lambda c: F.when(F.col(c) != int(_LAST), F.col(c)).alias(c)
    out = hits.mapInArrow(run, schema)
    return out.select("anchor_id", known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")
