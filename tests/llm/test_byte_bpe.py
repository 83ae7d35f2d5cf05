"""Byte-level BPE against the library on uncut texts."""

import base64
import hashlib
import random

import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from logwarden.llm import byte_bpe
from logwarden.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PIECES = ["a", "Z", "é", "你", "9", "٣", "'s", "'", "'re", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "　", "!", "^", "🎉", "é"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40), st.integers(1, 9))
def test_parts_have_the_tokens_of_the_whole(pieces, size):
    with open(PATH, "rb") as file:
        model = byte_bpe.encoding(file.read())
    text = "".join(pieces)
    assert "".join(byte_bpe.parts(text, size)) == text
    assert byte_bpe.encode_text(model, text, size).tolist() == model.encode_ordinary(text)


def long_texts():
    rng = random.Random(5)
    words = ["fox", "naïve", "12", "'ll", "你好", "--", "x1y2"]
    spaced = "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t ", ""]) for _ in range(500_000))
    return [spaced, "a" * 700_000, " " * 600_000 + "x", "9a" * 400_000, "^" * 600_000]


def test_long_texts(spark, library):
    texts = long_texts()
    assert len(list(byte_bpe.parts(texts[0]))) > 3
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in byte_bpe.round_trip(rows, PATH).collect()}
    for k, text in enumerate(texts):
        want = library.encode_ordinary(text)
        assert found[k].n_tokens == len(want)
        assert found[k].ids == b"".join(i.to_bytes(4, "little") for i in want)
        assert found[k].decoded == text.encode()


def test_every_row_equals_the_library(docs, library):
    rows = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, library.encode_ordinary(r.text or "")) for r in rows), key=repr)
    encoded = byte_bpe.encode(docs, PATH)
    got = encoded.collect()
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == want
    assert all(r.n_tokens == len(r.ids) for r in got)
    back = byte_bpe.decode(encoded, PATH).collect()
    assert sorted(((r.doc_id, bytes(r.decoded)) for r in back), key=repr) == sorted(
        ((r.doc_id, (r.text or "").encode()) for r in rows), key=repr
    )


def test_no_rows(no_docs):
    assert byte_bpe.encode(no_docs, PATH).count() == 0
    assert byte_bpe.round_trip(no_docs, PATH).count() == 0


def test_decoding_parts_of_characters_and_unknown_ids(spark, library):
    half = library.encode_ordinary("🎉")[:1]
    rows = [(1, half), (2, []), (3, None), (4, [49, 60000]), (5, [-1])]
    found = {r.doc_id: r.decoded for r in byte_bpe.decode(spark.createDataFrame(rows, "doc_id bigint, ids array<int>"), PATH).collect()}
    assert bytes(found[1]) == library.decode_bytes(half) and b"\xf0\x9f\x8e\x89".startswith(found[1])
    assert (bytes(found[2]), bytes(found[3]), found[4], found[5]) == (b"", b"", None, None)


def test_query(spark, library):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in QUERIES["op13_byte_bpe"](spark, sf).collect()}
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(texts)
    for r in texts:
        ids = library.encode_ordinary(r.text or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (found[r.doc_id].n_tokens, found[r.doc_id].ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert found[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
