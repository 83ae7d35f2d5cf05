"""Personal data in any text: no crash, the patterns' matches, and time that grows with the text."""

import random
import re
import time

import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from logwarden.llm import pieces, pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
PARTS = ["a", "B9", ".", "@", "-", "%", " ", "1", "255", "256", "²", "٣", "⁴", "+1", "(", ")", "555 010", "4111 1111 1111 1111", "\n", "[at]", " at ", "é", "🎉", "_" * 70, "x" * 130]


@pytest.fixture(scope="module")
def field():
    rng = random.Random(2)
    lines = [f"mail u{i}@mail.example.com or +1 (555) 010-{rng.randrange(1000, 9999)} from 10.0.{i}.1" for i in range(30)]
    return pii.train(lines, rounds=8)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join))
def test_any_text(field, text):
    base, both = pii.find(text, field)
    assert [s[1:] for s in base if s[0] == "email"] == [m.span() for m in EMAIL.finditer(text)]
    assert set(base) <= set(both)
    added = [s for s in both if s not in base]
    assert not any(x < b and a < y for _, a, b in added for _, x, y in base)


def test_superscripts_between_dots(field):
    assert pii.find("ip 123.².3.44 x", field)[0] == []


@pytest.mark.parametrize("text", ["x" * 400_000 + "@ ", "x@" * 200_000, "_" * 200_000 + "@b.c " + "y" * 200_000 + "@", "@" * 400_000])
def test_long_runs_take_linear_time(text):
    start = time.perf_counter()
    found = pii.base_spans(text)
    assert time.perf_counter() - start < 5
    assert [s for s in found if s[0] == "email"] == ([("email", 0, 200_004)] if "@b.c" in text else [])


def test_pieces_round_trip_equals_encoding_and_decoding(docs, no_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = {(r.doc_id, tuple(r.ids)) for r in pieces.encode(docs, path).collect()}
    decoded = {(r.doc_id, r.decoded == (r.text or "")) for r in pieces.decode(pieces.encode(docs, path), path).collect()}
    both = pieces.round_trip(docs, path).collect()
    assert {(r.doc_id, tuple(r.ids)) for r in both} == encoded
    assert {(r.doc_id, r.round_trip) for r in both} == decoded
    assert pieces.round_trip(no_docs, path).count() == 0
