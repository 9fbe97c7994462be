"""Byte-level BPE by an index of pair occurrences: encoding and decoding.

All new pre-tokens of a part of a partition are laid out one after the other as linked symbols. An index holds, for each
merge, every position where its pair stands. The active ranks are taken in ascending order: the lowest is applied to
all its positions at once, and the pairs that this makes with the neighbours on both sides are entered in the lists of
their own ranks. Positions whose pair has gone since are skipped when their list is taken. A merge at one position
changes nothing in other pre-tokens, and the lowest rank of all is the lowest of each pre-token it occurs in, so
this gives each the merges it would have had alone, in the same order.

Merges are as many steps as there are active ranks, each over arrays, whatever the text. Pieces between spaces are
kept from part to part, so later parts index new ones only.

Defined results: a null text is empty and has no ids; a null ``doc_id`` is kept as null; a literal of an added token
becomes that token; repeated rows and equal texts are encoded alike, row by row; an empty table gives no row; other
columns are not read. A text of any length is one row; memory is linear in the longest text and in a part's text.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from trendframe.llm.common import Pieces, as_binary, as_docs, byte_names, held, map_columns, sha256_of, taken


@dataclass
class Merges:
    """A byte-level vocabulary: the id of each byte, and the pair and product of each merge, in order of rank."""

    base: np.ndarray
    left: np.ndarray
    right: np.ndarray
    product: np.ndarray
    tokens: dict[int, bytes]
    added: dict[str, int] = field(default_factory=dict)

    @classmethod
    def read(cls, definition: str) -> Merges:
        """From the JSON of a ``tokenizers`` byte-level BPE; options that would change ids otherwise are refused."""
        spec = json.loads(definition)
        model, splitter = spec["model"], spec.get("pre_tokenizer") or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        byte_level = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space", True)
        if model["type"] != "BPE" or not plain or not byte_level or spec.get("normalizer"):
            raise ValueError("only plain byte-level BPE is supported")
        added = {}
        for token in spec.get("added_tokens") or []:
            if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]:
                raise ValueError(f"added token {token['content']!r} takes in what is around it")
            added[token["content"]] = token["id"]
        vocabulary, names = model["vocab"], byte_names()
        bytes_of = {name: b for b, name in names.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = lambda words: np.array([vocabulary[w] for w in words], dtype=np.int64)
        return cls(
            base=ids(names[b] for b in range(256)),
            left=ids(a for a, _ in pairs),
            right=ids(b for _, b in pairs),
            product=ids(a + b for a, b in pairs),
            tokens={i: bytes(map(bytes_of.__getitem__, t)) for t, i in vocabulary.items() if t not in added}
            | {i: t.encode() for t, i in added.items()},
            added=added,
        )

    @cached_property
    def size(self) -> int:
        return max(self.tokens) + 1

    @cached_property
    def _by_pair(self) -> tuple[np.ndarray, np.ndarray]:
        codes = self.left * self._stride + self.right
        # Of a pair that is listed twice the last counts, as in a dictionary filled in order.
        _, at = np.unique(codes[::-1], return_index=True)
        ranks = len(codes) - 1 - at
        # The last entry is beyond every pair, so that a search always ends within the table.
        return np.append(codes[ranks], np.iinfo(np.int64).max), np.append(ranks, -1)

    @cached_property
    def _stride(self) -> int:
        """Symbols -1 and -2, which are none, make no pair's code with this."""
        return self.size + 2

    @cached_property
    def of_bytes(self) -> np.ndarray:
        """The rank of each pair of bytes, -1 where no merge joins them."""
        ranks = self.ranks(np.repeat(self.base, 256), np.tile(self.base, 256))
        return ranks.reshape(256, 256)

    @cached_property
    def in_order(self) -> bool:
        """Whether every merge comes after those that make its two parts, as training leaves them."""
        made = np.full(self.size, -1)
        made[self.product] = np.arange(len(self.product))
        return bool((np.maximum(made[self.left], made[self.right]) < np.arange(len(self.product))).all())

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, -1 where no merge joins them."""
        codes, ranks = self._by_pair
        wanted = left * self._stride + right
        at = codes.searchsorted(wanted)
        return np.where(codes[at] == wanted, ranks[at], -1)


class PairIndex:
    """Symbols of several pre-tokens, and for each active rank the positions where its pair stands or stood.

    ``data`` holds the bytes of all pre-tokens one after the other, ``ends`` where each ends.
    """

    def __init__(self, merges: Merges, data: np.ndarray, ends: np.ndarray):
        self.merges, self.n = merges, len(data)
        n, sizes = self.n, np.diff(ends, prepend=0)
        # Position n stands for what is before the first and behind the last symbol of every word.
        self.symbol = np.append(merges.base[data], -1)
        self.next = np.append(np.arange(1, n + 1), n)
        self.before = np.append(np.arange(-1, n - 1), n)
        self.word = np.repeat(np.arange(len(ends)), sizes)
        filled = ends[sizes > 0]
        self.next[filled - 1] = n
        if n:
            self.before[np.append(0, filled[:-1])] = n
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        if n:
            within = np.flatnonzero(self.next[:-1] < n)
            self._list(within, merges.of_bytes[data[within], data[within + 1]])

    def _enter(self, at: np.ndarray) -> None:
        """Put positions into the lists of the ranks of their pairs."""
        self._list(at, self.merges.ranks(self.symbol[at], self.symbol[self.next[at]]))

    def _list(self, at: np.ndarray, ranks: np.ndarray) -> None:
        found = ranks >= 0
        at, ranks = at[found], ranks[found]
        if not len(at):
            return
        if len(self.merges.product) < 2**16:
            ranks = ranks.astype(np.uint16)  # sorted by digits
        order = ranks.argsort(kind="stable")
        at, ranks = at[order], ranks[order]
        starts = np.append(0, np.flatnonzero(ranks[1:] != ranks[:-1]) + 1)
        bounds = [*starts.tolist(), len(at)]
        for k, rank in enumerate(ranks[starts].tolist()):
            if rank not in self.places:
                self.places[rank] = []
                heapq.heappush(self.active, rank)
            self.places[rank].append(at[bounds[k] : bounds[k + 1]])

    def run(self) -> None:
        """Apply the active ranks in ascending order until none is left."""
        merges, symbol, following, before = self.merges, self.symbol, self.next, self.before
        while self.active:
            rank = heapq.heappop(self.active)
            lists = self.places.pop(rank)
            left, right = merges.left[rank], merges.right[rank]
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 or not merges.in_order else lists[0]
            at = at[(symbol[at] == left) & (symbol[following[at]] == right)]
            if not merges.in_order:  # a merge may bring back a lower rank: one place of each word at a time, all others stay listed
                self._enter(at)
                at = at[np.unique(self.word[at], return_index=True)[1]]
            elif left == right:
                at = self._apart(at)
            if not len(at):
                continue
            gone = following[at]
            behind = following[gone]
            symbol[at] = merges.product[rank]
            symbol[gone] = -2
            following[at] = behind
            inside = behind < self.n
            before[behind[inside]] = at[inside]
            ahead = before[at]
            self._enter(np.concatenate([ahead[ahead < self.n], at]))

    def _apart(self, at: np.ndarray) -> np.ndarray:
        """Every other place of each run of overlapping ones, from its first: the pair of a symbol with itself."""
        linked = np.append(False, self.next[at[:-1]] == at[1:])
        run_start = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
        return at[(np.arange(len(at)) - run_start) % 2 == 0]

    def ids(self, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many come before each of the byte positions ``bounds``, which cut no pre-token."""
        alive = self.symbol[:-1] >= 0
        return self.symbol[:-1][alive].astype("<u4"), np.append(0, np.cumsum(alive))[bounds]


#: Pieces that are one pre-token, and those of one with a comma or full stop behind it.
_WORD, _MARKED = "^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+$", "^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]$"


class Encoder:
    """Texts to ids: pre-tokens by a pattern, all new ones of a part merged by one pair index."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.pattern = merges, regex.compile(pattern)
        literals = sorted(merges.added, key=len, reverse=True)
        self.literal = re.compile("(" + "|".join(map(re.escape, literals)) + ")") if literals else None
        #: A literal that reaches over a space would be torn apart between pieces; one like a word would not be looked for.
        self.by_pieces = not any(re.search(r"\s", a) or not re.search("[^A-Za-z.,]", a) for a in literals)
        self._pieces = Pieces(self.encode)

    def encode(self, texts: pa.Array) -> pa.Array:
        """The ids of each string as little-endian 32-bit integers, without cutting at spaces first."""
        if not len(texts):
            return pa.array([], pa.large_binary())
        marked = _flags(pc.match_substring_regex(texts, _MARKED)) if self.by_pieces else np.zeros(len(texts), bool)
        plain = _flags(pc.match_substring_regex(texts, _WORD)) if self.by_pieces else marked
        texts = texts.cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        cuts, tokens = [bounds[1:], bounds[1:][marked] - 1], []
        odd = np.flatnonzero(~(plain | marked))
        if len(odd):
            words = [self._pre_tokens(t.decode()) for t in texts.take(pa.array(odd)).to_pylist()]
            flat = pa.array([w for own in words for w in own], pa.large_string())
            sizes = pc.binary_length(flat).to_numpy()
            # Pre-tokens leave nothing out, so those of a text begin where it begins, one behind the other.
            first = np.cumsum([0, *map(len, words)])
            within = np.append(0, np.cumsum(sizes))
            begins = within[:-1] + np.repeat(bounds[odd] - within[first[:-1]], np.diff(first))
            cuts.append(begins + sizes)
            added = self.merges.added
            if added:
                known = np.flatnonzero(_flags(pc.is_in(flat, value_set=pa.array(list(added), pa.large_string()))))
                tokens = [(int(begins[k]), int(sizes[k]), added[flat[k].as_py()]) for k in known.tolist()]
        ends = np.unique(np.concatenate(cuts))
        index = PairIndex(self.merges, data, ends[ends > 0])
        index.run()
        for at, size, token in tokens:  # an added token stands for all its bytes, whatever they were merged to
            index.symbol[at : at + size] = -2
            index.symbol[at] = token
        ids, at = index.ids(bounds)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(4 * at), pa.py_buffer(ids)])

    def _pre_tokens(self, text: str) -> list[str]:
        if self.literal is None or not self.literal.search(text):
            return self.pattern.findall(text)
        parts = self.literal.split(text)
        return [w for part in parts for w in ([part] if part in self.merges.added else self.pattern.findall(part))]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty) one after the other, and where each text's begin, with the end of the last."""
        if self.by_pieces:
            return self._pieces.flat(texts)
        data, at = taken(self.encode(texts.fill_null("")), np.arange(len(texts)))
        return data.view("<u4"), at // 4

    def __call__(self, texts: Sequence[str]) -> list[list[int]]:
        ids, at = self.flat(pa.array(texts, pa.string()))
        return [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]

    @cached_property
    def token_bytes(self) -> pa.LargeBinaryArray:
        """The bytes of each id, empty where there is no such token."""
        return pa.array([self.merges.tokens.get(i, b"") for i in range(self.merges.size)], pa.large_binary())

    @cached_property
    def decimals(self) -> pa.LargeBinaryArray:
        """Each id in decimal, with a comma behind it."""
        return pa.array([b"%d," % i for i in range(self.merges.size)], pa.large_binary())

    def decoded(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts of stretches of ids in UTF-8, and where each begins; bytes that are no text become U+FFFD."""
        data, spelled = taken(self.token_bytes, ids)
        ends = spelled[at]
        try:
            str(memoryview(data), "utf-8")
            whole = not np.any(data[ends[:-1][ends[:-1] < len(data)]] & 0xC0 == 0x80)
        except UnicodeDecodeError:
            whole = False
        if whole:
            return data, ends
        texts = [bytes(data[a:b]).decode("utf-8", "replace").encode() for a, b in zip(ends, ends[1:], strict=False)]
        return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _flags(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


class _Sent:
    """A vocabulary for the workers, each of which keeps one encoder of it from task to task."""

    def __init__(self, df: DataFrame, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            merges = Merges.read(f.read())
        self.name, self.pattern = uuid.uuid4().hex, pattern
        self.shared = df.sparkSession.sparkContext.broadcast(merges)  # bounded by the vocabulary

    def encoder(self) -> Encoder:
        return held(("bpe-index", self.name), lambda: Encoder(self.shared.value, self.pattern))


def encode(docs: DataFrame, tokenizer_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): ids of every whole text as little-endian 32-bit integers. ``pattern`` cuts texts into pre-tokens."""
    sent = _Sent(docs, tokenizer_path, pattern)

    def run(rows: pa.RecordBatch) -> dict:
        return {"doc_id": rows.column("doc_id"), "ids": as_binary(*sent.encoder().flat(rows.column("text")))}

    return map_columns(as_docs(docs), "doc_id long, ids binary", run)


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, text): the text of each row's ids; null ids give null, ids beyond the vocabulary nothing."""
    sent = _Sent(encoded, tokenizer_path, "")

    def run(batches):
        for batch in batches:
            encoder, column = sent.encoder(), batch.column("ids")
            ids = [np.frombuffer(x or b"", "<u4") for x in column.to_pylist()]
            flat = np.concatenate([np.zeros(0, "<u4"), *ids])
            known = flat < encoder.merges.size
            at = np.concatenate([[0], np.cumsum(known)])[np.cumsum([0, *map(len, ids)])]
            data, ends = encoder.decoded(flat[known], at)
            texts = as_binary(data, ends).cast(pa.string())
            keep = pa.array(np.asarray(column.is_valid()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _or_null(texts, keep)], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _or_null(values: pa.Array, valid: pa.Array) -> pa.Array:
    return pc.if_else(valid, values, pa.scalar(None, values.type))


def digests(docs: DataFrame, tokenizer_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, by encoding it and decoding the ids."""
    sent = _Sent(docs, tokenizer_path, pattern)

    def run(rows: pa.RecordBatch) -> dict:
        encoder = sent.encoder()
        ids, at = encoder.flat(rows.column("text"))
        written, said = taken(encoder.decimals, ids)
        return {
            "doc_id": rows.column("doc_id"),
            "n_tokens": np.diff(at),
            "ids_sha256": sha256_of(written, said[at], trim=1),
            "decoded_sha256": sha256_of(*encoder.decoded(ids, at)),
        }

    return map_columns(as_docs(docs), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", run)
