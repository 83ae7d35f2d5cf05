"""Token counts of a byte-level BPE with the whole-token shortcut.

Offline, every vocabulary string is merged from its bytes; those that come out as one token are
the whole tokens.  A pre-token that equals one of them counts one without any merging.  The rest
is merged: short pre-tokens many at a time, each distinct one once, long ones with a heap.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.llm import common

LIMIT = 1024
#: Fixed value: how the byte-level vocabulary splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longest pre-token, in bytes, that is merged in a block.
_SHORT = 48
#: Counts of distinct pre-tokens that a worker remembers.
_REMEMBERED = 300_000
_NEVER = np.int32(1 << 30)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 as itself, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass
class Model:
    """Merges as sorted pair keys with rank and outcome, and the pre-tokens that are one token."""

    first: np.ndarray
    pair: np.ndarray
    rank: np.ndarray
    made: np.ndarray
    specials: list[str]
    whole: set[str] = field(default_factory=set)
    known: dict[str, int] = field(default_factory=dict)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and outcome of each pair; a rank of _NEVER if it doesn't merge."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        fits = (self.pair[at] == key) & (left >= 0) & (right >= 0)
        return np.where(fits, self.rank[at], _NEVER), self.made[at]

    def merged_lengths(self, words: list[bytes]) -> np.ndarray:
        """The number of tokens of each word."""
        out = np.zeros(len(words), np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for k in np.flatnonzero(sizes > _SHORT).tolist():
            out[k] = self._long(words[k])
        edges = [0, 1, 4, 8, 12, 16, 24, 32, _SHORT]
        for low, high in zip(edges, edges[1:], strict=False):
            chosen = np.flatnonzero((sizes > low) & (sizes <= high))
            for k in range(0, len(chosen), 50_000):
                part = chosen[k : k + 50_000]
                raw = b"".join(words[i].ljust(high, b"\0") for i in part.tolist())
                ids = self.first[np.frombuffer(raw, np.uint8).reshape(-1, high)]
                ids[np.arange(high) >= sizes[part][:, None]] = -1
                out[part] = self._block(ids, sizes[part].copy())
        return out

    def _block(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        width, rows = ids.shape[1], np.arange(len(ids))
        result = sizes.copy()
        if width < 2:
            return result
        rank, made = self.ranks(ids[:, :-1], ids[:, 1:])
        while True:
            at = rank.argmin(axis=1)
            live = rank[np.arange(len(at)), at] < _NEVER
            result[rows[~live]] = sizes[~live]
            if not live.any():
                return result
            rows, sizes, at, ids, rank, made = rows[live], sizes[live] - 1, at[live], ids[live], rank[live], made[live]
            line, column = np.arange(len(at)), np.arange(width)
            ids[line, at] = made[line, at]
            source = np.minimum(column + (column > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, source, 1)
            ids[:, -1] = -1
            pairs = np.minimum(column[:-1] + (column[:-1] > at[:, None]), width - 2)
            rank, made = np.take_along_axis(rank, pairs, 1), np.take_along_axis(made, pairs, 1)
            rank[:, -1] = _NEVER
            for near in (at - 1, at):
                spot = (near >= 0) & (near < width - 1)
                r, m = self.ranks(ids[line[spot], near[spot]], ids[line[spot], near[spot] + 1])
                rank[line[spot], near[spot]], made[line[spot], near[spot]] = r, m

    def _long(self, word: bytes) -> int:
        ids = self.first[np.frombuffer(word, np.uint8)]
        rank, made = self.ranks(ids[:-1], ids[1:])
        heap = [(int(rank[k]), int(k), int(ids[k]), int(ids[k + 1]), int(made[k])) for k in np.flatnonzero(rank < _NEVER)]
        heapq.heapify(heap)
        token, after, before = ids.tolist(), list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        left = len(token)
        while heap:
            _, k, a, b, new = heapq.heappop(heap)
            j = after[k]
            if token[k] != a or j >= len(token) or token[j] != b:
                continue
            token[k], token[j], after[k], left = new, -1, after[j], left - 1
            if after[k] < len(token):
                before[after[k]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y < len(token):
                    r, m = self.ranks(np.array([token[x]]), np.array([token[y]]))
                    if r[0] < _NEVER:
                        heapq.heappush(heap, (int(r[0]), x, token[x], token[y], int(m[0])))
        return left

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        find = regex.compile(PATTERN).findall
        cut = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        extra, parts = [0] * len(texts), []
        for k, text in enumerate(texts):
            if cut and any(s in text for s in self.specials):
                pieces = cut.split(text)
                extra[k] = len(pieces) - 1
                parts.append([x for piece in pieces for x in find(piece)])
            else:
                parts.append(find(text))
        new = set().union(*parts) - self.known.keys()
        whole = new & self.whole
        rest = list(new - whole)
        if len(self.known) + len(new) > _REMEMBERED:
            self.known = {}
            new = set().union(*parts)
            whole = new & self.whole
            rest = list(new - whole)
        self.known.update(dict.fromkeys(whole, 1))
        self.known.update(zip(rest, self.merged_lengths([x.encode() for x in rest]).tolist(), strict=True))
        get = self.known.__getitem__
        return [n + sum(map(get, part)) for n, part in zip(extra, parts, strict=True)]


def load(path: str) -> Model:
    """The model of a byte-level BPE file (the driver reads it)."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters, vocab, merges = byte_letters(), content["model"]["vocab"], content["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    key = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
    order = np.argsort(key)
    first = np.zeros(256, np.int32)
    for letter, byte in letters.items():
        first[byte] = vocab[letter]
    made = np.array([vocab[a + b] for a, b in pairs], np.int32)[order]
    specials = [x["content"] for x in content.get("added_tokens", [])]
    model = Model(first, key[order], order.astype(np.int32), made, specials)
    words = [w for w in vocab if all(c in letters for c in w)]
    raw = [bytes(letters[c] for c in w) for w in words]
    for word, n in zip(raw, model.merged_lengths(raw).tolist(), strict=True):
        if n == 1:
            try:
                model.whole.add(word.decode())
            except UnicodeDecodeError:  # part of a character: never a pre-token
                continue
    return model


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than `limit` tokens) of each row.

    Null and empty texts have no bytes and no tokens.  Special strings in a text are one token
    each.  Repeated rows are counted one by one; columns other than doc_id and text are not read.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in common.slices(batches):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            sizes = [len(x) for x in common.text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(model.count(texts), pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    counted = common.map_arrow(docs, ["doc_id", "text"], run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
