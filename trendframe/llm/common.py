"""What several operators of this package share: batches, stored tables, encoding by repeated pieces."""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendframe.session import scratch_dir

#: Characters of text that a task turns into Python objects at a time; a longer text is a slice of its own.
SLICE_CHARS = 1_000_000
#: Characters of text that are cut into pieces at a time, in Arrow.
PIECES_CHARS = 2_000_000


_held: dict = {}


def held(key, make: Callable):
    """What this worker keeps under ``key`` from task to task, made if it is new.

    Workers outlive operators, so what earlier operators kept is let go: a worker never holds more than one store.
    """
    if key not in _held:
        _held.clear()
        give_back()
        _held[key] = make()
    return _held[key]


def give_back() -> None:
    """Return freed memory to the system: a worker that lives through several operators would keep the most that any of them took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: lineage ends there, and a lost executor loses nothing."""
    folder = scratch_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def about(df: DataFrame, n: int, *key: str) -> DataFrame:
    """About ``n`` rows of ``df`` (all, if it has fewer), never more than twice as many, by a hash of ``key``.

    The rows are counted first and kept by their share, so each task finds its own: no task and not the driver sees
    the least of all partitions. ``key`` should tell rows apart: of drawn rows that agree in it one stays, and where more than
    twice ``n`` are left, those with the least hash. The same rows are thus drawn in every run.
    """
    total = df.count()
    if total <= n:
        return df
    place = F.xxhash64(*key, F.lit(n))
    drawn = df.filter(F.pmod(place, F.lit(1 << 30)) < int(n / total * (1 << 30))).dropDuplicates(list(key))
    return drawn.orderBy(place, *key).limit(2 * n)


def parts(batch: pa.RecordBatch, column: str | int = "text", chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``chars`` characters of text each; a longer text is a part of its own."""
    start = size = 0
    lengths = pc.utf8_length(batch.column(column)).fill_null(0).to_pylist()
    for i, n in enumerate(lengths):
        if size and size + n > chars:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield batch.slice(start)


def slices(batch: pa.RecordBatch, column: str | int = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with about ``SLICE_CHARS`` of text each, and their texts (null: empty)."""
    for part in parts(batch, column):
        yield part, [t or "" for t in part.column(column).to_pylist()]


def map_texts(
    docs: DataFrame, columns: Sequence[str], schema: T.StructType | str, fn: Callable[[pa.RecordBatch, list[str]], dict]
) -> DataFrame:
    """Rows that ``fn`` makes of slices of ``docs``: it gets a part of a batch with its texts and returns columns."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow = _arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                out = fn(part, texts)
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, f.type) for f, v in ((f, out[f.name]) for f in arrow)],
                    schema=arrow,
                )

    return docs.select(*columns).mapInArrow(run, schema)


def map_columns(docs: DataFrame, schema: T.StructType | str, fn: Callable[[pa.RecordBatch], dict], chars: int = PIECES_CHARS) -> DataFrame:
    """Rows that ``fn`` makes of parts of ``docs`` with about ``chars`` characters each, as Arrow columns; no text becomes a string."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow = _arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, chars=chars):
                out = fn(part)
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, f.type) for f, v in ((f, out[f.name]) for f in arrow)],
                    schema=arrow,
                )
        give_back()

    return docs.mapInArrow(run, schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def as_docs(df: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` as string; other columns go, so their names cannot clash."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def byte_names() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen, else one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    unseen = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(unseen)}


class Pieces:
    """Encode texts piece by piece, each distinct piece of a part looked up once and each new one encoded once per worker.

    A piece is a space with what follows up to the next space. Splitters that attach a single space to the
    word after it never match over such a cut if the characters on both sides are no white space, so
    pieces are encoded independently; a text with any other white space next to a space is encoded whole.
    ``encode`` takes an array of strings and returns the ids of each as little-endian 32-bit integers. At most ``limit``
    pieces are kept; then the store starts anew. All of it stays in Arrow: no piece becomes a Python string here.
    """

    def __init__(self, encode: Callable[[pa.Array], pa.Array], limit: int = 300_000):
        self.encode, self.limit = encode, limit
        self._forget()

    def _forget(self) -> None:
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def _table(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Ids of pieces, and where in it the piece of a space and each of ``words`` stands."""
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(at))
        if len(new):
            if len(self.words) + len(new) > self.limit:
                self._forget()
                new = words
            ids = self.encode(pc.binary_join_element_wise(pa.scalar(""), new, " "))
            if len(new) == len(words):
                at = pa.nulls(len(words), pa.int32())
            # New pieces stand behind the others, in their order.
            place = len(self.words) + np.cumsum(at.is_null().to_numpy(zero_copy_only=False)) - 1
            at = pc.coalesce(at, pa.array(place, pa.int32()))
            self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, ids])
        return self.ids, at.to_numpy()

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty) one after the other, and where each text's begin, with the end of the last."""
        texts = texts.fill_null("")
        lists = pc.split_pattern(texts, " ")
        first = lists.offsets.to_numpy().astype(np.int64)
        first -= first[0]
        spelled = lists.flatten().dictionary_encode()
        words, codes = spelled.dictionary, spelled.indices.to_numpy().astype(np.int64)
        begins = first[:-1]
        at_head = np.zeros(len(codes), dtype=bool)
        at_head[begins] = True
        # A piece that must not be cut off makes its text one that is encoded whole.
        blank = lambda part: pc.utf8_is_space(part).to_numpy(zero_copy_only=False)
        ends_blank = blank(pc.utf8_slice_codeunits(words, -1))
        uncut = ends_blank | blank(pc.utf8_slice_codeunits(words, 0, 1)) | pc.equal(words, "").to_numpy(zero_copy_only=False)
        whole = np.logical_or.reduceat(np.where(at_head, ends_blank[codes], uncut[codes]), begins) if len(codes) else np.zeros(0, bool)
        kept = ~np.repeat(whole, np.diff(first))
        inner = kept & ~at_head
        needed = np.flatnonzero(np.bincount(codes[inner], minlength=len(words)))
        ids, at = self._table(words.take(pa.array(needed)))
        place = np.zeros(len(words), dtype=np.int64)
        place[needed] = at
        # Heads have no space before them, and whole texts are pieces of their own: both are encoded as they are.
        heads = np.flatnonzero(np.bincount(codes[begins[~whole]], minlength=len(words)))
        head_place = np.zeros(len(words), dtype=np.int64)
        head_place[heads] = len(ids) + np.arange(len(heads))
        others = pa.concat_arrays([words.take(pa.array(heads)), texts.filter(pa.array(whole))])
        table = pa.concat_arrays([ids, self.encode(others)])
        codes = np.where(at_head, head_place[codes], place[codes])
        codes[begins[whole]] = len(ids) + len(heads) + np.arange(whole.sum())
        kept[begins] = True
        first = np.concatenate([[0], np.cumsum(np.where(whole, 1, np.diff(first)))]).astype(np.int64)
        data, starts = taken(table, codes[kept])
        return data.view("<u4"), starts[first] // 4

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        ids, at = self.flat(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]


def taken(table: pa.LargeBinaryArray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of ``table`` that ``codes`` name as one array of bytes, and where each begins, with the end of the last."""
    out = table.take(pa.array(codes))
    at = np.frombuffer(out.buffers()[1], dtype=np.int64)[out.offset : out.offset + len(out) + 1]
    data = out.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8)[: at[-1]] if data else np.zeros(0, np.uint8), at


def sha256_of(data: np.ndarray, at: np.ndarray, trim: int = 0) -> list[str]:
    """Hex SHA-256 of consecutive stretches of bytes, which begin ``at``, each without its last ``trim`` bytes."""
    view = memoryview(data)
    return [hashlib.sha256(view[a : max(a, b - trim)]).hexdigest() for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]


def as_binary(data: np.ndarray, at: np.ndarray) -> pa.BinaryArray:
    """Consecutive stretches of ``data``, which begin at items ``at``, as a column."""
    offsets = (at * data.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
