"""The encoder against tiktoken; round trips; appends and edits against encoding anew."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import awkward, make_docs
from trendframe.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
CODEC = bpe.Codec(bpe.Vocabulary(RANKS), public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXT = st.text(alphabet="abcdehinorst THEIN'\n\t 012!.éß　\x1cあ🙂", max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_encodes_like_tiktoken_and_decodes(text):
    ids = CODEC.encode(text)
    assert ids == REFERENCE.encode_ordinary(text) == CODEC.encode_batch([text])[0].tolist()
    assert CODEC.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 5), TEXT), max_size=4))
def test_edits_equal_encoding_anew(text, edits):
    encoded = bpe.EncodedText(CODEC, text)
    for at, removed, new in edits:
        at = min(at, len(text))
        encoded.edit(at, min(at + removed, len(text)), new)
        text = text[:at] + new + text[at + removed :]
        assert encoded.text == text and encoded.ids() == REFERENCE.encode_ordinary(text)
    encoded.append("ing the end")
    assert encoded.ids() == REFERENCE.encode_ordinary(text + "ing the end")


@pytest.mark.parametrize("start,end,new", [(0, 0, b"in"), (500, 503, b"the"), (999, 1000, b""), (1000, 1000, b"er")])
def test_replacing_bytes_stops_where_entries_agree(start, end, new):
    data = (b"thethereinthanonest" * 60)[:1000]
    table = bpe.PrefixTable(CODEC.vocabulary, data)
    computed = table.replace(start, end, new)
    assert table.last == bpe.PrefixTable(CODEC.vocabulary, data[:start] + new + data[end:]).last
    assert computed <= len(new) + 4 * CODEC.vocabulary.longest


def test_long_pre_tokens():
    for text in ("a" * 5000, "é" * 700 + " " * 400, "!?" * 600):
        assert CODEC.encode(text) == REFERENCE.encode_ordinary(text)


def test_table(spark):
    rows = awkward()
    got = bpe.digests(make_docs(spark, rows), PATH, public_tokenizers.PATTERN).collect()
    want = []
    for i, t, _, _ in rows:
        ids = REFERENCE.encode_ordinary(t or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.digests(make_docs(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_round_trip_by_tables(spark):
    docs = make_docs(spark, awkward())
    back = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert sorted((r.doc_id, bytes(r.data).decode()) for r in back if r.doc_id) == sorted((i, t or "") for i, t, _, _ in awkward() if i)


def test_every_byte_needs_a_token():
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0})
