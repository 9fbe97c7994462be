"""Packing against the tokenizer itself: every id in exactly one piece, windows full but for the last."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import awkward, make_docs, prose
from trendframe.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def ids_of(piece):
    return [int.from_bytes(piece.ids[k : k + 4], "little") for k in range(0, len(piece.ids), 4)]


@pytest.mark.parametrize("length", [1, 7, 2048])
def test_pieces_are_the_stream(spark, tokenizer, length):
    rows = awkward() if length > 1 else [(1, "a b", None, None), (2, None, None, None)]
    pieces = packing.pack(make_docs(spark, rows).repartition(3), PATH, length).collect()
    stream = {}
    for p in pieces:
        assert 0 < p.length <= length and len(p.ids) == 4 * p.length
        for k, i in enumerate(ids_of(p)):
            assert stream.setdefault(p.sequence_id * length + p.offset + k, (p.doc_id, p.start + k, p.doc_tokens, i)) is not None
    assert sorted(stream) == list(range(sum(p.length for p in pieces)))  # gapless: only the last sequence is short
    docs, at = [], 0
    while at < len(stream):
        doc_id, start, n, _ = stream[at]
        assert start == 0 and all(stream[at + k][:3] == (doc_id, k, n) for k in range(n))
        docs.append((doc_id, tuple(stream[at + k][3] for k in range(n))))
        at += n
    want = [(i, (*tokenizer.encode(t or "", add_special_tokens=False).ids, 1)) for i, t, _, _ in rows]
    assert sorted(docs, key=str) == sorted(want, key=str)


def test_empty_table_and_no_end_token(spark):
    assert packing.pack(make_docs(spark, []), PATH, 8).count() == 0
    assert packing.pack(make_docs(spark, [(1, "", None, None), (2, "a", None, None)]), PATH, 8, end_id=None).count() == 1


def test_pieces_between_spaces_equal_whole_texts(tokenizer):
    with open(PATH, encoding="utf-8") as f:
        encoder = packing._Encoder(f.read())
    assert encoder.by_pieces
    texts = ["", " ", "a", " a", "a ", "a  b", "a \n b", "a  b", "a \x1cb", "it's <|endoftext|> ok", prose(1, 500), "é 🙂 12 34!"]
    want = [b"".join(i.to_bytes(4, "little") for i in tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert encoder(texts) == want


def test_literals_of_added_tokens_are_the_tokens(spark):
    plain = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "x<|endoftext|>y", "<|endoftext|><|endoftext|>.", "a <|endoftext|>\n b", "word, <|endoftext|>, <|endoftext| >"]
    want = {k: [*plain.encode(t, add_special_tokens=False).ids, 1] for k, t in enumerate(texts)}
    assert want[0] == [64, 220, 50256, 275, 1]
    pieces = packing.pack(make_docs(spark, [(k, t, None, None) for k, t in enumerate(texts)]), PATH, 2048).collect()
    assert {p.doc_id: ids_of(p) for p in pieces} == want
