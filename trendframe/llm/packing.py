"""Concatenate and cut: all documents as one token stream, cut into sequences of a fixed length.

Two passes. The first encodes every document, writes its ids with their start within the partition, and
so leaves each partition's token total; prefix sums over these totals (a row per partition) give each
partition's place in the stream. The second cuts every document at the multiples of the sequence length.
A document that crosses one becomes several pieces, its boundary records. Only the last sequence is
shorter than the others; whatever the documents' lengths, there is no other padding.

The ids are read again from a stored table, not encoded twice, and places are computed from that table,
so a task that is run again after a loss cannot disagree with what others have read.

Defined results: a null text is empty and gives the end token alone; a null ``doc_id`` is kept as null;
a literal of an added token in a text, such as ``<|endoftext|>``, becomes that token, as ``add_special_tokens=False`` alone
has it; repeated rows and equal texts are packed once each; an empty table gives no piece; a text of any length is cut as
often as needed; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendframe.llm.bpe_index import Encoder, Merges
from trendframe.llm.common import PIECES_CHARS, as_binary, as_docs, give_back, held, parts, stored

#: Documents that are cut at a time, so that few ids are copied at once.
CUT_ROWS = 500
_TOKENS = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())]
)
_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ]
)


class _Encoder:
    """A tokenizer of the ``tokenizers`` library, given as its JSON.

    With ``literals``, a special token that a text spells out becomes that token, as the library has it by default;
    without, it is encoded like other text. Plain byte-level BPE is encoded piece by piece, any other by the library.
    """

    def __init__(self, definition: str, literals: bool = False):
        try:
            merges = Merges.read(definition)
        except ValueError:
            merges = None
        if merges and not literals:
            merges.added = {}
        self.pieces = Encoder(merges, public_tokenizers.PATTERN) if merges else None
        self.by_pieces = merges is not None and self.pieces.by_pieces
        if not self.by_pieces:
            self.tokenizer = Tokenizer.from_str(definition)
            self.tokenizer.encode_special_tokens = not literals

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty) one after the other, and where each text's begin, with the end of the last."""
        if self.by_pieces:
            return self.pieces.flat(texts)
        found = self.tokenizer.encode_batch_fast(texts.fill_null("").to_pylist(), add_special_tokens=False)
        ids = [np.array(e.ids, dtype="<u4") for e in found]
        return np.concatenate([np.zeros(0, "<u4"), *ids]), np.concatenate([[0], np.cumsum([len(a) for a in ids])]).astype(np.int64)

    def __call__(self, texts: list[str]) -> list[bytes]:
        ids, at = self.flat(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]


def token_table(docs: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """(doc_id, part, part_start, n, ids): each document's ids and their start in its partition's stream."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = held(("packing", tokenizer), lambda: _Encoder(tokenizer, literals=True))
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in parts(batch, chars=PIECES_CHARS):
                ids, first = encode.flat(rows.column("text"))
                if end_id is not None:
                    ids = np.insert(ids, first[1:], end_id)
                    first = first + np.arange(len(first))
                n = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([part] * len(n), pa.int32()), pa.array(at + first[:-1]), pa.array(n), as_binary(ids, first)],
                    schema=_TOKENS,
                )
                at += int(first[-1])
        give_back()

    return as_docs(docs).mapInArrow(run, "doc_id long, part int, part_start long, n long, ids binary")


def pack(docs: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int | None = 1) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of all ``docs``.

    ``ids`` are little-endian 32-bit integers; ``start`` counts the document's ids before the piece, ``offset``
    the sequence's. The tokenizer's file is read on the driver and its text sent to the tasks.
    """
    if length < 1:
        raise ValueError("length must be positive")
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    tokens = stored(token_table(docs, definition, end_id), "tokens")
    # A row per partition of the first pass: as many as that pass had tasks, so the order by part is small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n"))
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = tokens.join(F.broadcast(offsets), "part").select("doc_id", (F.col("first") + F.col("part_start")).alias("at"), "n", "ids")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (batch.slice(k, CUT_ROWS) for batch in batches for k in range(0, batch.num_rows, CUT_ROWS))
        for batch in parts:
            at, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("at", "n"))
            first, last = at // length, (at + n - 1) // length
            count = np.where(n > 0, last - first + 1, 0)
            row = np.repeat(np.arange(len(n)), count)
            sequence = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = np.maximum(sequence * length - at[row], 0)
            size = np.minimum((sequence + 1) * length - at[row], n[row]) - start
            ids = batch.column("ids")
            pieces = [ids[r].as_buffer()[4 * s : 4 * (s + k)].to_pybytes() for r, s, k in zip(row.tolist(), start.tolist(), size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(size), pa.array(pieces, pa.binary()),
                    pa.array(n[row]), pa.array(sequence), pa.array(at[row] + start - sequence * length),
                ],
                schema=_PIECES,
            )

    return placed.mapInArrow(
        cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
