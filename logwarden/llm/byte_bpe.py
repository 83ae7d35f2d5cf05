"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut before encoding, at places where the split pattern always ends a match:

* between a visible ASCII character and a blank, since no alternative reads on into white space;
* between a letter and a digit of ASCII, either way round, since no alternative reads both.

Left of such a place the pattern sees the same characters as in the whole text (its look-ahead
concerns white space only, which never ends a part), and right of it matching starts anew.  So the
parts' tokens, put together, are the text's.  A text without such a place stays whole.

Decoding joins the tokens' bytes; they need not be UTF-8 before they are joined.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame

from logwarden.llm import common

#: Fixed value: how the rank files' vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that a part of a long text should have at least.
PART = 1 << 18

_SAFE = re.compile(r"(?<=[!-~])(?=[ \t\n\r])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")

_encodings: dict[tuple[int, str], tiktoken.Encoding] = {}


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    pairs = (line.split() for line in content.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def encoding(content: bytes, pattern: str = PATTERN) -> tiktoken.Encoding:
    """The library's encoding of a rank file without special tokens; made once per worker."""
    key = (hash(content), pattern)
    if key not in _encodings:
        _encodings.clear()
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(content), special_tokens={})
    return _encodings[key]


def parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in parts of at least `size` characters, each up to the next safe place; the last may be shorter."""
    begin = 0
    while len(text) - begin > size:
        found = _SAFE.search(text, begin + size)
        if found is None:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:]


def encode_text(model: tiktoken.Encoding, text: str, size: int = PART) -> np.ndarray:
    """Token ids of one text as little-endian unsigned 32-bit integers."""
    found = [model.encode_to_numpy(part, disallowed_special=()) for part in parts(text, size)]
    return np.concatenate(found).astype("<u4", copy=False)


def _decoded(model: tiktoken.Encoding, ids: np.ndarray | list[int]) -> bytes | None:
    try:
        return model.decode_bytes(ids)
    except (KeyError, OverflowError):  # an id that no token has
        return None


def _shared(df: DataFrame, path: str) -> Broadcast:
    """The rank file for the workers; its size is the vocabulary's, whatever the input."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate([np.empty(0, "<u4"), *rows]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and ids (in order) of each row's whole text.

    A null or empty text has no tokens; repeated rows are encoded one by one; a very long text is
    encoded in parts with the same outcome; strings that look like special tokens are ordinary
    text.  No rows give no rows, and columns other than doc_id and text are not read.
    """
    shared = _shared(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoding(shared.value)
        for batch in common.slices(batches):
            rows = [encode_text(model, text or "") for text in batch.column("text").to_pylist()]
            sizes = pa.array(map(len, rows), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, _lists(rows)], ["doc_id", "n_tokens", "ids"])

    return common.map_arrow(docs, ["doc_id", "text"], run, "doc_id bigint, n_tokens bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and decoded (bytes) of each row's ids.

    Null or no ids give no bytes; a row with an id that no token has gives null.  Ids that cut a
    character give the bytes of its part: a reader decides what to do with broken UTF-8.
    """
    shared = _shared(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoding(shared.value)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                rows = [_decoded(model, ids or []) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "decoded"])

    return common.map_arrow(encoded, ["doc_id", "ids"], run, "doc_id bigint, decoded binary")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed: little-endian unsigned 32-bit) and the bytes decoded from those ids.

    The same as `encode` followed by `decode`, in one pass of one worker.
    """
    shared = _shared(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoding(shared.value)
        for batch in common.slices(batches):
            rows = [encode_text(model, text or "") for text in batch.column("text").to_pylist()]
            columns = [
                batch.column("doc_id"),
                pa.array(map(len, rows), pa.int64()),
                pa.array([ids.tobytes() for ids in rows], pa.binary()),
                pa.array([_decoded(model, ids) for ids in rows], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded"])

    return common.map_arrow(docs, ["doc_id", "text"], run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")
