"""The pair index against the tokenizers library and against merging word by word; round trips."""

import hashlib
import json

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import awkward, make_docs, prose
from trendframe.llm import bpe_index, common

PATH = public_tokenizers.path("byte_bpe_50k.json")
with open(PATH, encoding="utf-8") as f:
    DEFINITION = f.read()
REFERENCE = Tokenizer.from_str(DEFINITION)
ENCODER = bpe_index.Encoder(bpe_index.Merges.read(DEFINITION), public_tokenizers.PATTERN)
TEXT = st.text(alphabet="abcdehinorst THEIN'\n\t 012!.éß　\x1cあ🙂<|>", max_size=60)


def plain(merges, word):
    """One word, one merge at a time: the leftmost pair of the lowest rank."""
    ids = merges.base[np.frombuffer(word, np.uint8)].tolist()
    ranks = {(a, b): k for k, (a, b) in enumerate(zip(merges.left.tolist(), merges.right.tolist(), strict=True))}
    while True:
        found = [(ranks[p], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in ranks]
        if not found:
            return ids
        rank, k = min(found)
        ids[k : k + 2] = [int(merges.product[rank])]


def indexed(merges, words):
    ends = np.cumsum([0, *map(len, words)])
    index = bpe_index.PairIndex(merges, np.frombuffer(b"".join(words), np.uint8), ends[1:])
    index.run()
    ids, at = index.ids(ends)
    return [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_encodes_like_the_library(texts):
    texts = [*texts, texts[0] + "<|endoftext|>" + texts[-1], " <|endoftext|> "]
    assert ENCODER(texts) == [REFERENCE.encode(t, add_special_tokens=False).ids for t in texts]


def toy(pairs, random=None):
    """Merges over a few bytes; symbol k is byte k. Pairs of symbols that are not there yet are left out."""
    names, merges = {i: bytes([i]) for i in range(256)}, []
    for a, b in pairs:
        if a in names and b in names:
            joined = names[a] + names[b]
            made = next((i for i, t in names.items() if t == joined), len(names))
            names[made] = joined
            merges.append((a, b, made))
    if random:
        random.shuffle(merges)
    columns = np.array(merges, dtype=np.int64).reshape(-1, 3).T
    return bpe_index.Merges(np.arange(256), *columns, names)


SYMBOLS = st.sampled_from([0, 1, 2, 256, 257, 258, 259])


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.tuples(SYMBOLS, SYMBOLS), max_size=8, unique=True),
    st.lists(st.lists(st.integers(0, 2), max_size=12).map(bytes), max_size=5),
    st.none() | st.randoms(use_true_random=False),
)
def test_any_order_of_merges_equals_word_by_word(pairs, words, random):
    """Also where a merge makes a pair of a lower rank than its own, and with overlapping pairs of equal symbols."""
    merges, words = toy(pairs, random), [*words, bytes(7)]
    assert indexed(merges, words) == [plain(merges, w) for w in words]


def test_positions_of_a_pair_are_all_indexed():
    merges = toy([(1, 2)])
    index = bpe_index.PairIndex(merges, np.array([1, 2, 1, 2, 2, 1, 1, 2], np.uint8), np.array([4, 4, 6, 8]))
    assert [p.tolist() for p in index.places[0]] == [[0, 2, 6]]  # not over the cuts between words
    index.run()
    assert not index.places and not index.active


def test_long_and_repeating_texts():
    texts = ["a" * 5000, "é" * 700 + " " * 400, "!?" * 600, " " * 3000, prose(3, 3000)]
    assert ENCODER(texts) == [REFERENCE.encode(t, add_special_tokens=False).ids for t in texts]


def test_decoding_like_the_library():
    ids = [[64, 50256, 275], [], [160, 222], [172], [447, 250], [160, 120], [1, 2, 3]]
    flat, at = np.array([i for x in ids for i in x], "<u4"), np.cumsum([0, *map(len, ids)])
    data, ends = ENCODER.decoded(flat, at)
    got = [bytes(data[a:b]).decode() for a, b in zip(ends, ends[1:], strict=False)]
    assert got == [REFERENCE.decode(x, skip_special_tokens=False) for x in ids]
    # A text cut off within a character, completed by the next: no character may reach over.
    half = ENCODER(["é", "🙂"])
    parts = [half[1][:1], half[1][1:]]
    data, ends = ENCODER.decoded(np.array(sum(parts, []), "<u4"), np.cumsum([0, *map(len, parts)]))
    assert [bytes(data[a:b]).decode() for a, b in zip(ends, ends[1:], strict=False)] == [REFERENCE.decode(p, skip_special_tokens=False) for p in parts]


def test_table(spark):
    rows = [*awkward(), (77, "x <|endoftext|> y", "en", "s")]
    got = bpe_index.digests(make_docs(spark, rows), PATH, public_tokenizers.PATTERN).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t, _, _ in rows:
        ids = REFERENCE.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(REFERENCE.decode(ids, skip_special_tokens=False).encode())))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe_index.digests(make_docs(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_round_trip_by_tables(spark):
    docs = make_docs(spark, awkward())
    back = bpe_index.decode(bpe_index.encode(docs, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert sorted((r.doc_id, r.text) for r in back if r.doc_id) == sorted((i, t or "") for i, t, _, _ in awkward() if i)
    nothing = spark.createDataFrame([(1, None), (2, bytearray())], "doc_id long, ids binary")
    assert sorted(map(tuple, bpe_index.decode(nothing, PATH).collect())) == [(1, None), (2, "")]


def test_other_kinds_are_refused():
    spec = json.loads(DEFINITION)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}, {"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]}):
        with pytest.raises(ValueError):
            bpe_index.Merges.read(json.dumps(spec | change))


def test_whole_texts_where_literals_hold_spaces():
    merges = bpe_index.Merges.read(DEFINITION)
    merges.added = {"<|end of text|>": 50256}
    encoder = bpe_index.Encoder(merges, public_tokenizers.PATTERN)
    assert not encoder.by_pieces
    assert encoder(["a<|end of text|> b", "a b"]) == [[64, 50256, 275], [64, 275]]
    assert encoder.flat(pa.array([None, "a"], pa.string()))[1].tolist() == [0, 0, 1]


def test_a_part_searches_its_store_once(monkeypatch):
    """New pieces stand behind the kept ones, so they are not looked for again; pairs of bytes have their ranks in a table."""
    merges, searched, keep = bpe_index.Merges.read(DEFINITION), [], common.pc.index_in
    monkeypatch.setattr(common.pc, "index_in", lambda *a, **k: searched.append(1) or keep(*a, **k))
    encoder = bpe_index.Encoder(merges, public_tokenizers.PATTERN)
    for texts in (["one two a-b two", "", "x<|endoftext|>y z1,2", " \n  ué 日本語 two"], ["two three a-b", "one  four<|endoftext|>"], ["two a-b one"]):
        searched.clear()
        assert encoder(texts) == [REFERENCE.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(searched) == 1
    pairs = np.indices((256, 256)).reshape(2, -1)
    assert (merges.of_bytes.ravel() == merges.ranks(merges.base[pairs[0]], merges.base[pairs[1]])).all()
    assert (merges.ranks(np.array([-1, -2, 5, 5, 0]), np.array([5, 5, -1, -2, -1])) == -1).all()


def test_overlapping_pairs_stay_listed():
    """(256, 0) comes before (0, 0), which makes 256: the places that overlapped are needed after each merge."""
    merges = bpe_index.Merges(np.arange(256), np.array([256, 0]), np.array([0, 0]), np.array([257, 256]), dict.fromkeys(range(258), b""))
    assert not merges.in_order and indexed(merges, [bytes(7)]) == [plain(merges, bytes(7))] == [[257, 257, 0]]
