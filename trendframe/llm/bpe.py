"""Byte-level BPE by prefix dynamic programming: encoding, decoding, appending and editing.

Every prefix of a byte string has exactly one valid last token: the token whose neighbour before it, the
last token of the prefix that remains, would not have merged with it differently. Storing that token per
prefix gives the encoding of every prefix at once, by walking back from its end. Appended bytes need the
entries of the new prefixes only; after an edit the entries before it stand, and those behind it stand
again as soon as as many entries in a row as the longest token has bytes agree with the old ones.

Defined results: a null text is empty and has no ids; a null ``doc_id`` is kept as null; repeated rows and
equal texts are encoded alike, row by row; an empty table gives no row; other columns are not read. Time
and memory are linear in the length of a text.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from trendframe.llm.common import Pieces, as_binary, as_docs, held, map_columns, sha256_of, taken

#: Distinct pre-tokens and token pairs whose result a worker keeps; the store starts anew beyond it.
KEPT = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@dataclass
class Vocabulary:
    """Ranks of tokens, and the pair each longer token is merged from (-1: no merge makes it)."""

    ranks: dict[bytes, int]
    left: dict[int, int] = field(default_factory=dict)
    right: dict[int, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.longest = max(map(len, self.ranks), default=1)
        self._compatible: dict[tuple[int, int], bool] = {}
        self.lengths = {i: len(t) for i, t in self.tokens.items()}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"no token for bytes {missing[:5]}")
        if not self.left:
            for token, i in sorted(self.ranks.items(), key=lambda x: x[1]):
                if len(token) > 1:
                    pair = self._last_merge(token, i)
                    self.left[i], self.right[i] = pair if pair else (-1, -1)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Finds every token that merges can make, in bytes read as Latin-1."""
        found = ahocorasick.Automaton()
        for token, i in self.ranks.items():
            if self.right.get(i) != -1:
                found.add_word(token.decode("latin-1"), i)
        found.make_automaton()
        return found

    def _last_merge(self, token: bytes, limit: int) -> tuple[int, int] | None:
        """The two tokens that merges of ranks below ``limit`` reduce ``token`` to; None if they don't."""
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            rank, k = min((self.ranks.get(a + b, limit), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank >= limit:
                return None
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def compatible(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay apart when their bytes are encoded together."""
        known = self._compatible.get((a, b))
        if known is None:
            if len(self._compatible) >= KEPT:
                self._compatible.clear()
            known = self._compatible[a, b] = self._stay_apart(a, b)
        return known

    def _stay_apart(self, a: int, b: int) -> bool:
        """Undo the merges on both sides of the seam from the last one back.

        Between two undone merges the seam has one token on either side; if these would have merged
        before the merge undone last, ``a`` and ``b`` would never have been formed side by side.
        """
        ranks, tokens, before = self.ranks, self.tokens, None
        while True:
            merged = ranks.get(tokens[a] + tokens[b])
            if merged is not None and (before is None or merged < before):
                return False
            inner_a, inner_b = len(tokens[a]) > 1, len(tokens[b]) > 1
            if not inner_a and not inner_b:
                return True
            # Of equal ranks the one on the left was merged first, so the right one is undone first.
            if inner_a and (not inner_b or a > b):
                before, a = a, self.right[a]
            else:
                # A merge on the seam of the rank undone here stands further left and would come first.
                before, b = b + 1, self.left[b]


class PrefixTable:
    """The last token of every prefix of one pre-token."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def copy(self) -> PrefixTable:
        out = PrefixTable(self.vocabulary)
        out.data, out.last = self.data, list(self.last)
        return out

    def append(self, more: bytes) -> None:
        self.data += more
        self._extend(len(self.data))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in the place of bytes ``start`` to ``end``; how many entries were computed anew."""
        old, tail = self.last, len(self.data) - end
        self.data = self.data[:start] + new + self.data[end:]
        self.last, shift = old[:start], len(new) - (end - start)
        run, first = 0, start + len(new)
        for i in range(start, len(self.data)):
            self._extend(i + 1)
            run = run + 1 if i >= first and self.last[i] == old[i - shift] else 0
            if run >= self.vocabulary.longest and i + 1 - first <= tail:
                self.last += old[i + 1 - shift :]
                return i + 1 - start
        return len(self.data) - start

    def _extend(self, size: int) -> None:
        v, last = self.vocabulary, self.last
        lengths, known, add = v.lengths, v._compatible, last.append
        at = len(last)
        begin = max(0, at - v.longest)
        # The automaton names the tokens that end at each byte, the longest first.
        for end, token in v.automaton.iter(self.data[begin:size].decode("latin-1")):
            if begin + end == at:
                start = at + 1 - lengths[token]
                if start:
                    before = last[start - 1]
                    apart = known.get((before, token))
                    if apart is None:
                        apart = v.compatible(before, token)
                    if not apart:
                        continue
                add(token)
                at += 1

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.tokens[token])
        return out[::-1]


class Codec:
    """Text to ids and back: pre-tokens by a pattern, each encoded by its prefix table."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self._known: dict[str, bytes] = {}
        self._pieces = Pieces(lambda pieces: pa.array(self._encode_all(pieces.to_pylist()), pa.large_binary()))

    def pre_token(self, text: str) -> bytes:
        ids = self._known.get(text)
        if ids is None:
            data = text.encode()
            whole = self.vocabulary.ranks.get(data)  # a pre-token that is a token is that token
            ids = np.array([whole] if whole is not None else PrefixTable(self.vocabulary, data).ids(), dtype="<u4").tobytes()
            if len(self._known) >= KEPT:
                self._known.clear()
            self._known[text] = ids
        return ids

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        return [b"".join(map(self.pre_token, self.pattern.findall(text))) for text in texts]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin, with the end of the last."""
        return self._pieces.flat(texts)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids, dtype="<u4") for ids in self._pieces(texts)]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self._encode_all([text])[0], dtype="<u4").tolist()

    @cached_property
    def token_bytes(self) -> pa.LargeBinaryArray:
        """The bytes of each id, empty where there is no such token."""
        tokens = self.vocabulary.tokens
        return pa.array([tokens.get(i, b"") for i in range(max(tokens) + 1)], pa.large_binary())

    @cached_property
    def decimals(self) -> pa.LargeBinaryArray:
        """Each id in decimal, with a space behind it."""
        return pa.array([b"%d " % i for i in range(max(self.vocabulary.tokens) + 1)], pa.large_binary())

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


class EncodedText:
    """A text with its pre-tokens, kept encoded over appends and edits."""

    def __init__(self, codec: Codec, text: str = ""):
        self.codec, self.text = codec, ""
        self.spans: list[tuple[int, int]] = []
        self.tables: list[PrefixTable] = []
        self.edit(0, 0, text)

    def append(self, more: str) -> int:
        return self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> int:
        """Put ``new`` in the place of characters ``start`` to ``end``; how many pre-tokens were encoded anew.

        A pre-token depends on two characters behind it at most, so those that end two before ``start``
        stand. Behind the edit, matching goes on as before from the first old cut that is met again.
        """
        shift = len(new) - (end - start)
        keep = 0
        while keep < len(self.spans) and self.spans[keep][1] + 1 < start:
            keep += 1
        old_spans, old_tables = self.spans, self.tables
        old_at = {s: k for k, (s, _) in enumerate(old_spans) if s >= end}
        self.text = self.text[:start] + new + self.text[end:]
        self.spans, self.tables = old_spans[:keep], old_tables[:keep]
        at, count = self.spans[-1][1] if self.spans else 0, 0
        vocabulary = self.codec.vocabulary
        for m in self.codec.pattern.finditer(self.text, at):
            k = old_at.get(m.start() - shift)
            if k is not None and m.start() >= start + len(new):
                self.spans += [(s + shift, e + shift) for s, e in old_spans[k:]]
                self.tables += old_tables[k:]
                break
            data, reused = m.group().encode(), keep + count
            table = old_tables[reused] if reused == keep and reused < len(old_tables) else None
            if table is not None and data.startswith(table.data) and table.data:
                table = table.copy()  # the old one may still be met again behind the edit
                table.append(data[len(table.data) :])  # the pre-token at the seam only grew
            else:
                table = PrefixTable(vocabulary, data)
            self.spans.append(m.span())
            self.tables.append(table)
            count += 1
        return count

    def ids(self) -> list[int]:
        ranks = self.codec.vocabulary.ranks
        return [i for t in self.tables for i in ([ranks[t.data]] if t.data in ranks else t.ids())]


class _Sent:
    """A vocabulary for the workers, each of which keeps one codec of it from task to task."""

    def __init__(self, docs: DataFrame, path: str, pattern: str):
        v = Vocabulary(read_ranks(path))
        self.name, self.pattern = uuid.uuid4().hex, pattern
        self.shared = docs.sparkSession.sparkContext.broadcast((v.ranks, v.left, v.right))  # bounded by the vocabulary

    def codec(self) -> Codec:
        return held(("bpe", self.name), lambda: Codec(Vocabulary(*self.shared.value), self.pattern))


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): ids of every whole text as little-endian 32-bit integers."""
    sent = _Sent(docs, ranks_path, pattern)

    def run(rows: pa.RecordBatch) -> dict:
        return {"doc_id": rows.column("doc_id"), "ids": as_binary(*sent.codec().flat(rows.column("text")))}

    return map_columns(as_docs(docs), "doc_id long, ids binary", run)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, data): the bytes of each row's ids; null ids give null."""
    sent = _Sent(encoded, ranks_path, "")

    def run(batches):
        for batch in batches:
            tokens = sent.codec().vocabulary.tokens.__getitem__
            data = [None if x is None else b"".join(map(tokens, np.frombuffer(x, dtype="<u4").tolist())) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, by encoding it and decoding the ids."""
    sent = _Sent(docs, ranks_path, pattern)

    def run(rows: pa.RecordBatch) -> dict:
        codec = sent.codec()
        ids, at = codec.flat(rows.column("text"))
        written, said = taken(codec.decimals, ids)
        data, spelled = taken(codec.token_bytes, ids)
        return {
            "doc_id": rows.column("doc_id"),
            "n_tokens": np.diff(at),
            "ids_sha256": sha256_of(written, said[at], trim=1),
            "decoded_sha256": sha256_of(data, spelled[at]),
        }

    return map_columns(as_docs(docs), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", run)
