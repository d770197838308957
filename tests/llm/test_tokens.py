"""BPE encoding and token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from goldpan.llm import bpe, token_files
from goldpan.llm.common import documents
from tests.llm.helpers import SMALL, clashing, frame, odd

WORDS = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
WORDS.no_truncation()
WORDS.no_padding()
BYTES = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
LEXICON = ["the", "there", "then", "hen", "other", "mother", "é", "12"]


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    path = public_tokenizers.path("word_bpe_49k.json")
    entries = bpe.Merges(path).encode([w.encode() for w in LEXICON])
    lexicon = bpe.compile_lexicon({w: e.tolist() for w, e in zip(LEXICON, entries)})
    return bpe.Encoder(lexicon, path)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text_as_the_library(encoder, texts):
    import pyarrow as pa

    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    for text, (ids, decoded) in zip(texts, encoder.of_texts(pa.array(texts, pa.string()))):
        expected = ids_of(WORDS, text)
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert decoded == WORDS.decode(expected, skip_special_tokens=False)


def test_lexicon_is_minimal_and_exact(encoder):
    lexicon = encoder.lexicon
    places = lexicon.places([w.encode() for w in LEXICON])
    assert sorted(places) == list(range(len(LEXICON)))
    assert (lexicon.places([b"", b"th", b"thereof", b"zebra"]) == -1).all()
    suffixes = {  # right languages: states of the minimal automaton
        frozenset(w[i:] for w in map(str.encode, LEXICON) if w.startswith(p))
        for v in map(str.encode, LEXICON)
        for i in range(len(v) + 1)
        for p in [v[:i]]
    }
    assert len(lexicon.final) == len(suffixes)


def test_long_words_merge_like_short_ones(encoder):
    for word in ("internationalisation", "aaaaaaaaaa", "thethethethe"):
        short = encoder.merges.encode([word.encode()])[0]
        assert encoder.merges._merge_long(word.encode()).tolist() == short.tolist()


@pytest.mark.parametrize("docs", ["given", "odd", "empty"])
def test_encoding_of_tables(spark, docs):
    df = {
        "given": lambda: documents(spark, SMALL),
        "odd": lambda: clashing(odd(spark)),
        "empty": lambda: frame(spark, []),
    }[docs]()
    found = sorted(map(tuple, bpe.encode_texts(spark, df, digest=True).collect()), key=repr)
    expected = []
    for row in df.select("doc_id", "text").collect():
        ids = ids_of(WORDS, row.text)
        decoded = WORDS.decode(ids, skip_special_tokens=False)
        expected.append(
            (
                row.doc_id,
                len(ids),
                hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(),
            )
        )
    assert found == sorted(expected, key=repr)


def test_decode_ids(spark):
    docs = documents(spark, SMALL).limit(20)
    for row in bpe.decode_ids(bpe.encode_texts(spark, docs).withColumnRenamed("decoded", "own")).collect():
        assert row.decoded == row.own


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=40))
def test_variable_length_round_trip(values):
    values = np.array(values, np.uint32)
    control, data = token_files.encode_values(values)
    assert len(control) == -(-len(values) // 4)
    assert (token_files.decode_values(control, data, len(values)) == values).all()


def test_cut_block_is_refused():
    block = token_files.Block(np.array([1]), np.array([2]), np.array([3, 4])).to_bytes()
    assert token_files.Block.from_bytes(block).ranks.tolist() == [3, 4]
    with pytest.raises(ValueError):
        token_files.Block.from_bytes(block[:-1])
    with pytest.raises(ValueError):
        token_files.Block.from_bytes(b"none" + block[4:])


@pytest.mark.parametrize("docs", ["given", "odd", "empty"])
def test_token_files(spark, docs):
    df = {
        "given": lambda: documents(spark, SMALL),
        "odd": lambda: clashing(odd(spark)),
        "empty": lambda: frame(spark, []),
    }[docs]()
    found = sorted(map(tuple, token_files.token_digests(spark, df).collect()), key=lambda r: r[1])
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    expected, start = [], 0
    for doc_id, text in rows:
        ids = ids_of(BYTES, text) + [token_files.END_ID]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        expected.append((doc_id, start, len(ids), crc))
        start += len(ids)
    assert found == expected


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab '\t\n\r\x85\xa0\x1c1.é!", max_size=30))
def test_pieces_end_where_words_end(text):
    import pyarrow as pa

    encoder = bpe._once(
        ("test-pieces",), lambda: token_files.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    )
    ids = encoder.of_texts(pa.array([text, "other words"]))[0]
    assert np.frombuffer(ids, "<u4").tolist() == ids_of(BYTES, text)
