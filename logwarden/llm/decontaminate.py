"""Benchmark passages in documents, by Wu-Manber search over words.

The alphabet is the word, not the byte: a block is two consecutive words.  A shift table says how
far the window may move after a block without passing an occurrence; where it says zero, the
block is the suffix of some test string, and the bucket of its hash names the strings to compare.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm import common

WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
HIT_ONE_IN = 20
#: Bytes of benchmark texts in one broadcast block of test strings.
BLOCK_BYTES = 16 << 20
_LANE = 256
_SCHEMA = "n_words bigint, hit_spans array<int>, items array<string>"


@dataclass
class Strings:
    """Test strings of one length in words, and the tables that find them."""

    length: int
    texts: list[bytes]
    items: list[list[str]]
    hashes: np.ndarray
    shift: np.ndarray
    bucket_key: np.ndarray
    bucket_row: np.ndarray

    @property
    def block(self) -> int:
        return min(2, self.length)


def _block_hash(words: np.ndarray, last: np.ndarray, block: int) -> np.ndarray:
    """Hash of the block that ends with each given word."""
    if block == 1:
        return words[last]
    with np.errstate(over="ignore"):
        return common.mix(words[last - 1] * np.uint64(3) + words[last])


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, start and end of each word, and the first word of each text."""
    data, begins = common.joined(texts)
    data = common.LOWER_TABLE[data]
    start, end = common.spans_of(common.WORD_BYTE[data])
    return data, start, end, np.searchsorted(start, begins)


def test_strings(items: list[tuple[str | None, str | None]], window: int) -> list[Strings]:
    """The distinct windows of the items, by length, with their Wu-Manber tables."""
    data, start, end, first = words_of([(text or "").encode() for _, text in items])
    raw, owners = data.tobytes(), {}
    for (item, _), a, b in zip(items, first, first[1:], strict=False):
        words = [raw[s:e] for s, e in zip(start[a:b], end[a:b], strict=True)]
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            names = owners.setdefault(size, {}).setdefault(b" ".join(words[k : k + size]), set())
            if item is not None:
                names.add(item)
    return [_compile(size, strings) for size, strings in sorted(owners.items())]


def _compile(length: int, strings: dict[bytes, set[str]]) -> Strings:
    texts = sorted(strings)
    data, start, end, first = words_of(texts)
    words = common.hash_spans(data, start, end)
    at = first[:-1, None] + np.arange(length)
    block = min(2, length)
    bits = max(10, int(np.ceil(np.log2(8 * len(texts) * length))))
    shift = np.full(1 << min(bits, 24), length - block + 1, np.uint8 if length < 250 else np.uint32)
    mask = np.uint64(len(shift) - 1)
    for k in range(block - 1, length):
        slot = (_block_hash(words, at[:, k], block) & mask).astype(np.int64)
        np.minimum.at(shift, slot, shift.dtype.type(length - 1 - k))
    key = _key(words, at[:, -1], length, block)
    order = np.argsort(key, kind="stable")
    return Strings(length, texts, [sorted(strings[t]) for t in texts], words[at], shift, key[order], order)


def _key(words: np.ndarray, last: np.ndarray, length: int, block: int) -> np.ndarray:
    """Of a bucket: hash of the suffix block together with the prefix block."""
    with np.errstate(over="ignore"):
        suffix = _block_hash(words, last, block)
        return suffix * np.uint64(5) + _block_hash(words, last - length + block, block)


def candidates(words: np.ndarray, strings: Strings) -> np.ndarray:
    """Positions of last words where the shift is zero; the lanes of the text move in step."""
    if len(words) < strings.length:
        return np.empty(0, np.int64)
    mask, found = np.uint64(len(strings.shift) - 1), []
    at = np.arange(strings.length - 1, len(words), _LANE, dtype=np.int64)
    stop = np.minimum(at + _LANE, len(words))
    while len(at):
        step = strings.shift[(_block_hash(words, at, strings.block) & mask).astype(np.int64)]
        found.append(at[step == 0])
        at = at + np.maximum(step, 1)
        alive = at < stop
        at, stop = at[alive], stop[alive]
    return np.sort(np.concatenate(found))


def occurrences(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, strings: Strings, words: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Last word and row of the test string, for each occurrence within one text."""
    last = candidates(words, strings)
    owner = np.searchsorted(first, last, "right") - 1
    last = last[last - strings.length + 1 >= first[owner]]
    key = _key(words, last, strings.length, strings.block)
    low = np.searchsorted(strings.bucket_key, key, "left")
    size = np.searchsorted(strings.bucket_key, key, "right") - low
    last = np.repeat(last, size)
    offset = np.arange(len(last)) - np.repeat(np.cumsum(size) - size, size)
    row = strings.bucket_row[np.repeat(low, size) + offset]
    same = np.ones(len(last), bool)
    for k in range(strings.length):
        same &= words[last - strings.length + 1 + k] == strings.hashes[row, k]
    last, row = last[same], row[same]
    sure = [
        b" ".join(data[start[w] : end[w]].tobytes() for w in range(p - strings.length + 1, p + 1)) == strings.texts[r]
        for p, r in zip(last.tolist(), row.tolist(), strict=True)
    ]
    return last[sure], row[sure]


def _scan(block: Broadcast) -> object:
    """For each row its columns but the text, n_words, and the spans and items that the block's strings give it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            data, start, end, first = words_of(common.text_bytes(batch.column("text")))
            words = common.hash_spans(data, start, end)
            cover = np.zeros(len(start) + 1, np.int32)
            found: list[set[str]] = [set() for _ in range(batch.num_rows)]
            for strings in block.value:
                last, row = occurrences(data, start, end, first, strings, words)
                np.add.at(cover, last - strings.length + 1, 1)
                np.add.at(cover, last + 1, -1)
                owner = np.searchsorted(first, last, "right") - 1
                for doc, r in set(zip(owner.tolist(), row.tolist(), strict=True)):
                    found[doc].update(strings.items[r])
            low, high = common.spans_of(np.cumsum(cover[:-1]) > 0)
            # A run may cross from one text into the next: cut it there.
            cuts = first[1:-1][(cover[:-1].cumsum() > 0)[np.minimum(first[1:-1], max(len(start) - 1, 0))]] if len(start) else first[:0]
            cuts = np.unique(cuts[np.isin(cuts, low, invert=True) & (cuts < len(start))])
            inner = cuts[(cuts > 0) & (np.searchsorted(low, cuts, "right") > np.searchsorted(high, cuts, "right"))]
            low, high = np.sort(np.concatenate((low, inner))), np.sort(np.concatenate((high, inner)))
            owner = np.searchsorted(first, low, "right") - 1
            spans: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for doc, a, b in zip(owner.tolist(), low.tolist(), high.tolist(), strict=True):
                spans[doc] += [a - int(first[doc]), b - int(first[doc])]
            kept = [c for c in batch.schema.names if c != "text"]
            arrays = [pa.array(np.diff(first), pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array([sorted(x) for x in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *arrays], [*kept, "n_words", "hit_spans", "items"])

    return run


def pattern_blocks(items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[int, Iterator[list[Strings]]]:
    """How many blocks of at most about `block_bytes` of distinct item rows there are, and the tables of
    each in turn: the driver holds one block at a time."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), F.col("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // block_bytes) + 1
    if n > 1:
        rows = common.cut(rows)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return n, (test_strings([tuple(r) for r in rows.where(part == k).collect()], window) for k in range(n))


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that meet or overlap become one."""
    for batch in batches:
        spans = []
        for parts in batch.column("hit_spans").to_pylist():
            low, high = np.array(parts, np.int64).reshape(-1, 2).T
            order = np.argsort(low, kind="stable")
            low, reach = low[order], np.maximum.accumulate(high[order])
            new = np.flatnonzero(np.concatenate((np.ones(min(len(low), 1), bool), low[1:] > reach[:-1])))
            last = np.append(new[1:], len(low))[: len(new)] - 1
            spans.append(np.column_stack((low[new], reach[last])).ravel().astype(np.int32))
        at = batch.schema.get_field_index("hit_spans")
        yield batch.set_column(at, "hit_spans", pa.array(spans, pa.list_(pa.int32())))


def content_key() -> Column:
    """A digest of doc_id and text; rows that share it have the same outcome."""
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return F.sha2(text, 256)


def _in_turn(docs: DataFrame, n: int, blocks: Iterator[list[Strings]]) -> DataFrame:
    """key, doc_id, n_words, hit_spans and items of each row, by one pass over the texts for each block.

    What a pass hits is written before the block is released, so one block at a time is on the
    executors, and a lost executor needs no released block.  Of the rows that share a key one is
    written, so at most one row a block meets per key.
    """
    context = docs.sparkSession.sparkContext
    rows, schema = docs.select(content_key().alias("key"), "doc_id", "text"), "key string, doc_id bigint, " + _SCHEMA
    written = []
    for k, strings in enumerate(blocks):
        block = context.broadcast(strings)
        found = rows.mapInArrow(_scan(block), schema)
        if k == n - 1:  # this block stays, the outcome is still to be read
            break
        written.append(common.cut(found.where(F.size("hit_spans") > 0).select("key", "hit_spans", "items").dropDuplicates(["key"])))
        block.destroy()
    others = reduce(DataFrame.union, written).groupBy("key").agg(
        F.flatten(F.collect_list("hit_spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items")
    )

    def both(mine: str, more: str, kind: str) -> Column:
        return F.concat(F.col(mine), F.coalesce(F.col(more), F.array().cast(kind)))

    joined = found.join(others, "key", "left").select(
        "key", "doc_id", "n_words", both("hit_spans", "more_spans", "array<int>").alias("hit_spans"),
        F.array_sort(F.array_distinct(both("items", "more_items", "array<string>"))).alias("items"),
    )
    return joined.mapInArrow(_united, schema)


def find_occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each row of `docs`: doc_id, n_words, hit_spans (starts and ends of runs of hit words,
    words from 0), items (ids of items with an occurring window, as sorted strings).

    Each item gives its windows of `window` words, or all its words if it has fewer; an item
    without words gives none.  A null text has no words; an item whose id is null makes hits but
    is not named; a text may be of any length.  Repeated rows are judged one by one, repeated items
    count once; of items that share a window all are named.  Without items nothing is hit, without
    rows the outcome is empty.  Columns other than doc_id, text and item_id are not read.  Test
    strings are broadcast in blocks of bounded size, one after another; every document is searched
    for every block.
    """
    n, blocks = pattern_blocks(items, window, block_bytes)
    if n > 1:
        return _in_turn(docs, n, blocks).drop("key")
    return common.map_arrow(docs, ["doc_id", "text"], _scan(docs.sparkSession.sparkContext.broadcast(next(blocks))), "doc_id bigint, " + _SCHEMA)


def judged(found: DataFrame, one_in: int = HIT_ONE_IN) -> DataFrame:
    """Adds n_hit, n_items and contaminated to the outcome of `find_occurrences`."""
    ends = F.filter("hit_spans", lambda _, i: i % 2 == 1)
    starts = F.filter("hit_spans", lambda _, i: i % 2 == 0)
    sizes = F.zip_with(ends, starts, lambda b, a: (b - a).cast("bigint"))
    hit = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda total, x: total + x)
    return found.withColumns({"n_hit": hit, "n_items": F.size("items").cast("bigint")}).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))
    )


def clean_documents(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, one_in: int = HIT_ONE_IN, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of `docs` that are not contaminated, with all their columns.

    Null and empty texts, and all rows where there are no items, are clean.  Repeated rows stay or go
    together; texts of any length are judged whole.  An empty table stays empty.
    """
    n, blocks = pattern_blocks(items, window, block_bytes)
    if n > 1:
        key = "key"
        while key in docs.columns:
            key += "_"
        found = judged(_in_turn(docs, n, blocks), one_in)
        bad = found.where("contaminated").select(F.col("key").alias(key)).distinct()
        return docs.withColumn(key, content_key()).join(bad, key, "left_anti").select(*docs.columns)
    scan = _scan(docs.sparkSession.sparkContext.broadcast(next(blocks)))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            mask = []
            for part in scan(iter([batch.select(["text"])])):
                for n_words, spans in zip(part["n_words"].to_pylist(), part["hit_spans"].to_pylist(), strict=True):
                    hit = sum(spans[1::2]) - sum(spans[::2])
                    mask.append(not (hit > 0 and one_in * hit >= n_words))
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
