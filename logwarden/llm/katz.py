"""Katz backoff language model over words.

The probability of a word after another is the Good-Turing discounted relative count of the pair
if the pair is kept, and otherwise the backoff weight of the first word times the unigram
probability of the second; unigrams back off to one unseen word.  Backoff weights are exact: the
probabilities after any word add up to one over the vocabulary and the unseen word.

Counts and weights are tables partitioned by hash.  The most frequent words are also broadcast (a
fixed number, so that most look-ups need no shuffle); all other words are joined.  Pairs are dealt
to shards by hash, and a pair is counted and evaluated where it is dealt to.  The logarithm of a
text's probability is a sum of terms of words and pairs, so it is added up from wherever the terms
are known.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm import common

#: Pairs with a lower training count are not kept, so at 1 every pair is; counts up to DISCOUNTED are discounted.
LEAST_PAIR, DISCOUNTED = 1, 5
#: Words broadcast to every task; the others are joined.
FREQUENT_WORDS = 1 << 19
#: Bytes of text whose pairs make one shard.
SHARD_TEXT = 28 << 20
#: Hashes that stand for the beginning and the end of a text.
BEGIN, END = np.uint64(0xB5297A4D3F84D5B5), np.uint64(0x68E31DA4C2B2AE35)
_BITS = 20  # of the number of a frequent word, the beginning included
#: Bits of a hash that choose where the search for a word begins, and steps from there before a binary search.
_INDEX_BITS, _STEPS = 20, 8
_TEXT_BITS = np.uint64(64 - 2 * _BITS)  # that a pair of frequent words leaves for the number of its text


def held_out() -> Column:
    """Whether crc32 of doc_id as text leaves 2 when divided by 7; a null doc_id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token of all texts, an end after each text: the token, the one before it, and its text."""
    data, begins = common.joined(texts, b"\n")
    data = common.LOWER_TABLE[data]
    start, end = common.spans_of(common.SOLID_BYTE[data])
    owner = np.searchsorted(begins, start, "right") - 1
    sizes = np.bincount(owner, minlength=len(texts)) + 1
    token = np.full(len(start) + len(texts), END)
    token[np.arange(len(start)) + owner] = common.hash_spans(data, start, end)
    before = np.concatenate((np.array([BEGIN]), token[:-1]))
    before[np.cumsum(sizes) - sizes] = BEGIN
    return token, before, np.repeat(np.arange(len(texts)), sizes)


def discounts(counts: dict[int, int], least: int) -> np.ndarray:
    """Good-Turing factors of counts 0 .. DISCOUNTED; 1 where the counts of counts allow no discount."""
    out, k = np.ones(DISCOUNTED + 1), DISCOUNTED
    n = [counts.get(r, 0) for r in range(k + 2)]
    common_part = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(least, k + 1):
        if n[r] and common_part < 1:
            factor = ((r + 1) * n[r + 1] / n[r] / r - common_part) / (1 - common_part)
            out[r] = factor if 0 < factor <= 1 else 1.0
    return out


@dataclass
class Words:
    """The frequent words, by hash in ascending order, with what is known of them."""

    hashes: np.ndarray
    count: np.ndarray
    terms: dict[str, np.ndarray]
    _index: np.ndarray | None = field(default=None, init=False, repr=False)

    def find(self, words: np.ndarray) -> np.ndarray:
        """The number of each word; -1 if it is not frequent."""
        high = np.uint64(64 - _INDEX_BITS)
        if self._index is None:
            self._index = np.searchsorted(self.hashes, np.arange(1 << _INDEX_BITS, dtype=np.uint64) << high).astype(np.int32)
        last = len(self.hashes) - 1
        at = np.minimum(self._index[words >> high], last)
        behind = np.flatnonzero((self.hashes[at] < words) & (at < last))
        for _ in range(_STEPS):  # hashes are spread evenly, so few words share their upper bits
            if not len(behind):
                break
            at[behind] += 1
            behind = behind[(self.hashes[at[behind]] < words[behind]) & (at[behind] < last)]
        if len(behind):
            at[behind] = np.minimum(np.searchsorted(self.hashes, words[behind]), last)
        return np.where(self.hashes[at] == words, at, -1)

    def find_both(self, before: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the words before and of the words, each word before being the last one or BEGIN."""
        b = self.find(words)
        a = np.concatenate((b[:1], b[:-1]))
        a[before == BEGIN] = self.find(np.array([BEGIN]))[0]
        return a, b


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        word, count = np.unique(words_of(common.text_bytes(batch.column("text")))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count)], ["word", "count"])


def word_counts(rows: DataFrame) -> DataFrame:
    """word (hash) and count in the training rows."""
    counted = rows.where(~F.col("held")).select("text").mapInArrow(_count_words, "word bigint, count bigint")
    return common.cut(counted.groupBy("word").agg(F.sum("count").alias("count")))


#: Arrays of a blob: pairs of frequent words (first differences of sorted keys) and their counts or texts; pairs of
#: one other word (first differences of sorted hashes) and a frequent one (its number, twice, plus one where the
#: other word is the first) and their counts or texts; pairs of two other words (hashes) and their counts or texts;
#: row number and training mark of each text.
_KINDS = ("<u8", "<i4", "<u8", "<i4", "<i4", "<u8", "<u8", "<i4", "<i8", "?")
_SHARD = "shard int, blob binary, size bigint"


def _counted(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The distinct rows of the columns, in order, and how often each occurs."""
    columns = _sorted(columns)
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    head = np.flatnonzero(new)
    return [*(c[head] for c in columns), np.diff(np.append(head, len(new)))]


def _sorted(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The rows of the columns, in order."""
    if len(columns) == 1:
        return [np.sort(columns[0])]
    order = np.lexsort(columns[::-1])
    return [c[order] for c in columns]


def _dealt(
    h: np.ndarray, w: np.ndarray, value: np.ndarray | None, words: Words, shards: int, rows: np.ndarray, train: np.ndarray,
    found: tuple[np.ndarray, np.ndarray] | None = None,
) -> Iterator[tuple]:
    """Pairs by shard.  `value` is the text of each pair; without it, equal pairs are counted.  `found` has the words' numbers.

    A pair with a word that is not frequent goes where that word's terms are (the first of two).
    """
    a, b = found or words.find_both(h, w)
    usual, one, two = (a >= 0) & (b >= 0), (a >= 0) != (b >= 0), (a < 0) & (b < 0)
    mixed = np.where(a[one] < 0, 2 * b[one] + 1, 2 * a[one]).astype(np.int32)
    groups = [[a[usual].astype(np.uint64) << np.uint64(_BITS) | b[usual].astype(np.uint64)], [np.where(a[one] < 0, h[one], w[one]), mixed], [h[two], w[two]]]
    dealt = []
    for columns, chosen in zip(groups, (usual, one, two), strict=True):
        if value is None:
            columns = _counted(columns)
        else:
            text = value[chosen]
            if len(columns) == 1 and len(rows) <= 1 << int(_TEXT_BITS):  # both fit into one number
                both = np.sort(columns[0] << _TEXT_BITS | text.astype(np.uint64))
                columns = [both >> _TEXT_BITS, (both & ((np.uint64(1) << _TEXT_BITS) - np.uint64(1))).astype(np.int64)]
            else:
                columns = _sorted([*columns, text])
        shard = (common.mix(columns[0]) % np.uint64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.int64)  # short ones sort by digits
        by = np.argsort(shard, kind="stable")
        dealt.append((columns, by, np.cumsum([0, *np.bincount(shard, minlength=shards)])))
    for k in range(shards):
        arrays = [[c[by[cuts[k] : cuts[k + 1]]] for c in columns] for columns, by, cuts in dealt]
        if any(len(x[0]) for x in arrays):
            (key, n), (word, code, m), (first, second, o) = arrays
            key, word = np.diff(key, prepend=np.uint64(0)), np.diff(word, prepend=np.uint64(0))
            yield (k, *common.pack([key, n.astype(np.int32), word, code, m.astype(np.int32), first, second, o.astype(np.int32), rows, train]))


def _read(blobs: list[tuple[bytes, int]]) -> list[np.ndarray]:
    """The arrays of all blobs of a shard, texts numbered through, and the number of texts of each blob."""
    parts, shift, sizes = [], 0, []
    for blob, size in blobs:
        key, n, word, code, m, first, second, o, rows, train = common.unpack(blob, size, _KINDS)
        sizes.append(len(rows))
        with np.errstate(over="ignore"):
            parts.append((np.cumsum(key), n + shift, np.cumsum(word), code, m + shift, first, second, o + shift, rows, train))
        shift += len(rows)
    return [*(np.concatenate(x) for x in zip(*parts, strict=True)), np.array(sizes)]


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, int]]]:
    shards: dict[int, list[tuple[bytes, int]]] = {}
    for batch in batches:
        for shard, blob, size in zip(*(batch.column(c).to_pylist() for c in ("shard", "blob", "size")), strict=True):
            shards.setdefault(shard, []).append((blob, size))
    while shards:
        yield shards.popitem()[1]


def _count_pairs(words: Broadcast, shards: int) -> object:
    none = np.empty(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            w, h, _ = words_of(common.text_bytes(batch.column("text")))
            out = list(_dealt(h, w, None, words.value, shards, none, none.astype(bool)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.binary(), pa.int64()), strict=True)], ["shard", "blob", "size"])

    return run


def _totals(columns: list[np.ndarray], value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by the columns, where each distinct row begins in it, and its sum of values."""
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
    if not len(order):
        return order, order, np.zeros(0, np.int64)
    new = np.logical_or.reduce([c[order[1:]] != c[order[:-1]] for c in columns])
    head = np.flatnonzero(np.concatenate(([True], new)))
    return order, head, np.add.reduceat(value[order].astype(np.int64), head)


_SUMS = [*(f"n{r}" for r in range(1, DISCOUNTED + 2)), "more", "unigram"]


def _sum_pairs(words: Broadcast, least: int) -> object:
    """Per first word: how many kept pairs have each small count, the sum of larger counts, and the unigram
    probabilities of second words; a second word that is not frequent is named to be joined.  A row
    without a first word has the number of pairs below `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in _by_shard(batches):
            key, n, word, code, m, one, two, o, _, _, _ = _read(blobs)
            known, firsts, counts, shares, every = words.value, [], [], [], []
            lost_first, lost_second = [], []
            for columns, value in (([key], n), ([word, code], m), ([one, two], o)):
                order, head, total = _totals(columns, value)
                every.append(total)
                kept = total >= least
                row = [c[order[head]][kept] for c in columns]
                if len(columns) == 1:
                    first = known.hashes[(row[0] >> np.uint64(_BITS)).astype(np.int64)]
                    share = known.terms["probability"][(row[0] & np.uint64((1 << _BITS) - 1)).astype(np.int64)]
                elif columns[0] is word:
                    is_first = row[1] % 2 == 1
                    first = np.where(is_first, row[0], known.hashes[row[1] // 2])
                    share = np.where(is_first, known.terms["probability"][row[1] // 2], 0.0)
                    lost_first.append(first[~is_first])
                    lost_second.append(row[0][~is_first])
                else:
                    first, share = row[0], np.zeros(len(row[0]))
                    lost_first.append(row[0])
                    lost_second.append(row[1])
                firsts.append(first)
                counts.append(total[kept])
                shares.append(share)
            h, c, p = np.concatenate(firsts), np.concatenate(counts), np.concatenate(shares)
            lost, lost_h, every = np.concatenate(lost_second), np.concatenate(lost_first), np.concatenate(every)
            first, back = np.unique(h, return_inverse=True)
            sums = [np.bincount(back, c == r, len(first)) for r in range(1, DISCOUNTED + 2)]
            sums += [np.bincount(back, np.where(c > DISCOUNTED, c, 0), len(first)), np.bincount(back, p, len(first))]
            zeros = [np.zeros(len(lost)) for _ in _SUMS]
            below = np.array([(every == r).sum() for r in range(1, DISCOUNTED + 2)] + [0, 0], float)
            below[least - 1 :] = 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*first.view(np.int64).tolist(), *lost_h.view(np.int64).tolist(), None], pa.int64()),
                    pa.array([*[None] * len(first), *lost.view(np.int64).tolist(), None], pa.int64()),
                    *(pa.array(np.concatenate((x, z, [y])).astype(float)) for x, z, y in zip(sums, zeros, below, strict=True)),
                ],
                ["first", "second", *_SUMS],
            )

    return run


def _frequent(table: DataFrame, columns: list[str], limit: int) -> dict[str, np.ndarray]:
    got = table.orderBy(F.col("count").desc(), "word").limit(limit).select("word", *columns).toArrow()
    values = {c: got[c].to_numpy() for c in ("word", *columns)}
    order = np.argsort(values["word"].view(np.uint64))
    return {c: v[order] for c, v in values.items()}


def train(rows: DataFrame, frequent: int, least: int, shards: int) -> tuple[DataFrame, dict[str, float], np.ndarray]:
    """word, count, probability, weight (backoff) and total (of counts after the word) of each word and of BEGIN;
    numbers of the corpus; and discount factors of pairs."""
    spark = rows.sparkSession
    counts = word_counts(rows)
    n, v = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    small = counts.where(F.col("count") <= DISCOUNTED + 1).groupBy("count").agg(F.count("*").alias("n"))
    factor = discounts({r["count"]: r["n"] for r in small.collect()}, 1)
    by_count = F.create_map(*(F.lit(x) for r in range(1, DISCOUNTED + 1) for x in (r, float(factor[r]))))
    discounted = F.when(F.col("count") <= DISCOUNTED, F.element_at(by_count, F.col("count").cast("int"))).otherwise(1.0) * F.col("count")
    used = counts.agg(F.sum(discounted)).first()[0] or 0.0
    # Without any discount one more count is added, for the unseen word.
    total = float(n) if used < n else float(n) + 1
    known = counts.withColumn("probability", discounted / F.lit(total or 1.0))
    ends = counts.where(F.col("word") == F.lit(int(END.view(np.int64)))).agg(F.sum("count")).first()[0] or 0
    numbers = {"n": n, "v": v, "unseen": 1 - used / (total or 1.0), "ends": ends}
    top = _frequent(known, ["count", "probability"], frequent)
    hashes = np.append(top["word"].view(np.uint64), BEGIN)  # BEGIN is only ever a first word
    order = np.argsort(hashes)
    words = Words(hashes[order], np.append(top["count"], ends)[order], {"probability": np.append(top["probability"], 0.0)[order]})
    shared = spark.sparkContext.broadcast(words)
    dealt = rows.where(~F.col("held")).select("text").mapInArrow(_count_pairs(shared, shards), _SHARD).repartition(shards, "shard")
    schema = "first bigint, second bigint, " + ", ".join(f"{c} double" for c in _SUMS)
    sums = common.cut(dealt.mapInArrow(_sum_pairs(shared, least), schema))
    whole = sums.agg(*(F.coalesce(F.sum(f"n{r}"), F.lit(0.0)) for r in range(1, DISCOUNTED + 2))).first()
    pair_factor = discounts({r: whole[r - 1] for r in range(1, DISCOUNTED + 2)}, least)
    joined = sums.where("second IS NOT NULL").join(known.select(F.col("word").alias("second"), "probability"), "second")
    added = sums.where("first IS NOT NULL AND second IS NULL").select("first", *_SUMS).union(
        joined.select("first", *(F.lit(0.0) for _ in _SUMS[:-1]), "probability")
    )
    per_first = added.groupBy(F.col("first").alias("word")).agg(*(F.sum(c).alias(c) for c in _SUMS))
    kept = F.col("more")
    for r in range(1, DISCOUNTED + 1):
        kept = kept + float(pair_factor[r]) * r * F.col(f"n{r}")
    begin = spark.range(1).select(F.lit(int(BEGIN.view(np.int64))).alias("word"), F.lit(ends).cast("bigint").alias("count"), F.lit(0.0).alias("probability"))
    table = known.select("word", "count", "probability").union(begin).join(per_first, "word", "left")
    table = table.select("word", "count", "probability", F.coalesce(kept, F.lit(0.0)).alias("kept"), F.coalesce("unigram", F.lit(0.0)).alias("unigram"))
    total_after = F.when(F.col("kept") < F.col("count") - 1e-9, F.col("count").cast("double")).otherwise(F.col("count") + 1.0)
    table = table.withColumn("total", total_after).withColumn(
        "weight", (1 - F.col("kept") / F.col("total")) / F.greatest(1 - F.col("unigram"), F.lit(1e-12))
    )
    return common.cut(table.select("word", "count", "probability", "weight", "total")), numbers, pair_factor


def _base(count: np.ndarray, numbers: dict[str, float]) -> np.ndarray:
    return np.log10((count + 1) / (numbers["n"] + 1 * (numbers["v"] + 1)))


#: What a row adds to a text: its tokens, known tokens, base and model scores, and for one word (to be joined) how
#: often its base terms and its probability count.
_PARTS = ["tokens", "known", "base", "score", "targets", "probabilities"]
_ROW = "row bigint, doc_id bigint, held boolean, word bigint, " + ", ".join(f"{c} double" for c in _PARTS)


def _rows(row: np.ndarray, word: np.ndarray | None, doc_id: pa.Array = None, held: pa.Array = None, **parts: np.ndarray) -> pa.RecordBatch:
    n, zero = len(row), np.zeros(len(row))
    arrays = [
        pa.array(row), pa.nulls(n, pa.int64()) if doc_id is None else doc_id, pa.nulls(n, pa.bool_()) if held is None else held,
        pa.nulls(n, pa.int64()) if word is None else pa.array(word.view(np.int64)),
        *(pa.array(np.asarray(parts.get(c, zero), float)) for c in _PARTS),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "held", "word", *_PARTS])


#: What the first step hands on: rows as above, spread over the shards, and blobs of pairs.
_MIXED = pa.schema(
    [("shard", pa.int32()), ("blob", pa.binary()), ("size", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("held", pa.bool_()), ("word", pa.int64())]
    + [(c, pa.float64()) for c in _PARTS]
)


def _mixed(rows: pa.RecordBatch, shards: int) -> pa.RecordBatch:
    n = rows.num_rows
    turn = (rows.column("row").to_numpy() + np.arange(n)) % shards
    return pa.RecordBatch.from_arrays([pa.array(turn.astype(np.int32)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), *rows.columns], schema=_MIXED)


def _mixed_blob(shard: int, blob: bytes, size: int) -> pa.RecordBatch:
    first = [pa.array([shard], pa.int32()), pa.array([blob], pa.binary()), pa.array([size], pa.int64())]
    return pa.RecordBatch.from_arrays([*first, *(pa.nulls(1, f.type) for f in list(_MIXED)[3:])], schema=_MIXED)


def _evaluate_words(words: Broadcast, numbers: dict[str, float], shards: int) -> object:
    """Terms of frequent words summed by text, other words named, and all pairs dealt to shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value
        base = _base(known.count, numbers)
        for batch in common.slices(batches):
            rows = batch.column("row").to_numpy()
            train_mark = ~batch.column("held").to_numpy(zero_copy_only=False)
            w, h, owner = words_of(common.text_bytes(batch.column("text")))
            a, b = known.find_both(h, w)
            n = batch.num_rows
            score = np.where(b >= 0, known.terms["probability"][b], 0) + np.where(a >= 0, known.terms["weight"][a], 0)
            parts = {
                "tokens": np.bincount(owner, minlength=n), "known": np.bincount(owner, b >= 0, n),
                "base": np.bincount(owner, np.where(b >= 0, base[b], 0), n), "score": np.bincount(owner, score, n),
            }
            yield _mixed(_rows(rows, None, batch.column("doc_id"), batch.column("held"), **parts), shards)
            for shard, blob, size in _dealt(h, w, owner, known, shards, rows, train_mark, (a, b)):
                yield _mixed_blob(shard, blob, size)

    return run


#: Of a word in a shard: hash, count, and logarithms of probability, weight, and weight times total.
_WORD_KINDS = ("<u8", "<i8", "<f8", "<f8", "<f8")


def _deal_words(words: Broadcast, shards: int) -> object:
    """Words that are not frequent, with their terms, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = batch.column("word").to_numpy().view(np.uint64)
            columns = [word, batch.column("count").to_numpy()]
            columns += [np.nan_to_num(batch.column(c).to_numpy(zero_copy_only=False).astype(float)) for c in ("probability", "weight", "both")]
            shard = np.where(words.value.find(word) < 0, (common.mix(word) % np.uint64(shards)).astype(np.int64), -1)
            for k in np.unique(shard[shard >= 0]).tolist():
                blob, size = common.pack([c[shard == k] for c in columns])
                yield _mixed_blob(k, blob, -size)  # a negative size marks words

    return run


def _evaluate_pairs(words: Broadcast, numbers: dict[str, float], factor: np.ndarray, least: int) -> object:
    """Terms of pairs, summed by text, the texts of a blob in one row; rows of words pass."""
    unseen = float(np.log10(numbers["unseen"])) if numbers["unseen"] > 0 else 0.0

    def corrected(count: np.ndarray) -> np.ndarray:
        return np.log10(np.maximum(count, 1) * np.where(count <= DISCOUNTED, factor[np.minimum(count, DISCOUNTED)], 1.0))

    def counted(columns: list[np.ndarray], train_mark: np.ndarray) -> np.ndarray:
        """The training count of each pair, in the order of the arrays."""
        order, head, total = _totals(columns, train_mark)
        out = np.zeros(len(order), np.int64)
        out[order] = np.repeat(total, np.diff(np.append(head, len(order))))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shards, tables = words.value, {}, {}
        for batch in batches:
            plain = batch.filter(batch.column("blob").is_null())
            if plain.num_rows:
                yield _handed(plain.select(["row", "doc_id", "held", "word", *_PARTS]))
            packed = batch.filter(batch.column("blob").is_valid())
            for shard, blob, size in zip(*(packed.column(c).to_pylist() for c in ("shard", "blob", "size")), strict=True):
                (shards if size > 0 else tables).setdefault(shard, []).append((blob, abs(size)))
        while shards:
            shard, blobs = shards.popitem()
            key, text, word, code, word_text, one, two, both_text, rows, train_mark, sizes = _read(blobs)
            blobs.clear()
            parts = [common.unpack(blob, size, _WORD_KINDS) for blob, size in tables.pop(shard, [])]
            table = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.empty(0, k) for k in _WORD_KINDS]
            order = np.argsort(table[0])
            table = [x[order] for x in table]

            def place(word: np.ndarray, hashes: np.ndarray = table[0]) -> tuple[np.ndarray, np.ndarray]:
                at = np.minimum(np.searchsorted(hashes, word), max(len(hashes) - 1, 0))
                there = hashes[at] == word if len(hashes) else np.zeros(len(word), bool)
                return np.where(there, at, len(hashes)), there

            count, probability, weight, total = (np.append(x, v) for x, v in zip((table[1], table[2], table[3], table[4] - table[3]), (0, unseen, 0.0, 0.0), strict=True))
            score, base, seen = np.zeros(len(rows)), np.zeros(len(rows)), np.zeros(len(rows))

            times = counted([key], train_mark[text])
            at, times = np.flatnonzero(times >= least), times[times >= least]
            a, b = (key[at] >> np.uint64(_BITS)).astype(np.int64), (key[at] & np.uint64((1 << _BITS) - 1)).astype(np.int64)
            score += np.bincount(text[at], corrected(times) - known.terms["both"][a] - known.terms["probability"][b], len(rows))

            times = counted([word, code], train_mark[word_text])
            at, there = place(word)
            kept, is_first, other = times >= least, code % 2 == 1, code // 2
            as_first = np.where(kept, corrected(times) - known.terms["probability"][other] - total[at], weight[at])
            as_second = np.where(kept, corrected(times) - known.terms["both"][other], probability[at])
            score += np.bincount(word_text, np.where(is_first, as_first, as_second), len(rows))
            seen += np.bincount(word_text, ~is_first & there, len(rows))
            base += np.bincount(word_text, np.where(is_first, 0.0, _base(count[at], numbers)), len(rows))

            times = counted([one, two], train_mark[both_text])
            at, _ = place(one)
            kept = times >= least
            score += np.bincount(both_text, np.where(kept, corrected(times) - total[at], weight[at]), len(rows))
            if len(two):
                yield _handed(_rows(rows[both_text], two, targets=np.ones(len(two)), probabilities=~kept))
            some = np.flatnonzero((score != 0) | (base != 0))
            ends = np.cumsum(sizes)
            cuts = np.searchsorted(some, np.append(0, ends))
            firsts, sums = [], []
            for a, b, begin in zip(cuts[:-1], cuts[1:], ends - sizes, strict=True):
                if a < b:
                    mine = some[a:b]
                    firsts.append(rows[begin])
                    sums.append(common.pack([rows[mine] - rows[begin], score[mine], base[mine], seen[mine].astype(np.int32)]))
            if firsts:
                yield _handed(_rows(np.array(firsts), None), sums)

    return run


#: Of the sums of a shard for the texts of a blob: row after the first one, score, base score and known tokens.
_SUM_KINDS = ("<i8", "<f8", "<f8", "<i4")


def _handed(rows: pa.RecordBatch, sums: list[tuple[bytes, int]] | None = None) -> pa.RecordBatch:
    blob, size = zip(*sums, strict=True) if sums else ([None] * rows.num_rows,) * 2
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(blob, pa.binary()), pa.array(size, pa.int64())], [*rows.schema.names, "blob", "size"])


def _add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text for the sums that all shards have for it; other rows pass."""
    blocks: dict[int, dict[str, np.ndarray]] = {}
    names = ("score", "base", "known")
    for batch in batches:
        plain = batch.filter(batch.column("blob").is_null())
        if plain.num_rows:
            yield plain.select(["row", "doc_id", "held", "word", *_PARTS])
        packed = batch.filter(batch.column("blob").is_valid())
        for first, blob, size in zip(*(packed.column(c).to_pylist() for c in ("row", "blob", "size")), strict=True):
            at, *values = common.unpack(blob, size, _SUM_KINDS)
            n = int(at.max()) + 1
            held = blocks.get(first)
            if held is None or len(held["score"]) < n:
                wider = {c: np.zeros(n) for c in names}
                for c in names if held else ():
                    wider[c][: len(held[c])] = held[c]
                held = blocks[first] = wider
            for c, value in zip(names, values, strict=True):
                held[c][at] += value
    for first, held in blocks.items():
        some = np.flatnonzero((held["score"] != 0) | (held["base"] != 0) | (held["known"] != 0))
        yield _rows(first + some, None, **{c: x[some] for c, x in held.items()})


def score_documents(docs: DataFrame, frequent: int = FREQUENT_WORDS, least: int = LEAST_PAIR, shard_text: int = SHARD_TEXT) -> DataFrame:
    """For each row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model is trained on the rows that are not held out.  A null text is empty: its only token
    is the end.  Repeated rows are counted and scored one by one.  Without training rows every
    token is unseen, with probability one.  Columns other than doc_id and text are not read.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out().alias("held"))
    shards = max(1, int((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_text) + 1)
    table, numbers, factor = train(rows, frequent, least, shards)
    logs = table.select(
        "word", "count", F.log10("probability").alias("probability"), F.log10("weight").alias("weight"), F.log10(F.col("weight") * F.col("total")).alias("both")
    )
    top = _frequent(logs, ["count", "probability", "weight", "both"], frequent)
    order = np.argsort(top["word"].view(np.uint64))
    terms = {c: np.nan_to_num(top[c][order].astype(float), nan=0.0, neginf=0.0) for c in ("probability", "weight", "both")}
    hashes = top["word"].view(np.uint64)[order]
    if not len(hashes):
        hashes, terms, top["count"], order = np.array([BEGIN]), {c: np.zeros(1) for c in terms}, np.zeros(1), np.array([0])
    words = docs.sparkSession.sparkContext.broadcast(Words(hashes, top["count"][order], terms))
    marked = rows.withColumn("row", F.monotonically_increasing_id())
    mixed = _SHARD + ", " + _ROW
    dealt = marked.mapInArrow(_evaluate_words(words, numbers, shards), mixed).union(logs.mapInArrow(_deal_words(words, shards), mixed))
    parts = dealt.repartition(shards, "shard").mapInArrow(_evaluate_pairs(words, numbers, factor, least), _ROW + ", blob binary, size bigint")
    # A text has a sum in nearly every shard.  They travel together with those of its neighbours and are added up once.
    parts = parts.repartition(shards, "row").mapInArrow(_add_sums, _ROW)
    # Rows without a word get a key of their own, so that no task receives them all.
    named = parts.withColumn("key", F.coalesce("word", F.xxhash64("row")))
    looked_up = logs.select(F.col("word").alias("key"), F.col("count").alias("c"), F.col("probability").alias("p"))
    joined = named.join(looked_up, "key", "left")
    there = F.col("word").isNotNull() & F.col("c").isNotNull()
    unseen = float(np.log10(numbers["unseen"])) if numbers["unseen"] > 0 else 0.0
    base = F.log10((F.when(there, F.col("c")).otherwise(0) + 1) / F.lit(float(numbers["n"] + 1 * (numbers["v"] + 1))))
    score = F.col("probabilities") * F.when(there, F.coalesce("p", F.lit(0.0))).otherwise(unseen)
    summed = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held").alias("held_out"),
        F.sum("tokens").cast("bigint").alias("n_tokens"),
        F.sum(F.col("known") + F.when(there, F.col("targets")).otherwise(0.0)).cast("bigint").alias("n_known"),
        F.sum(F.col("base") + F.col("targets") * base).alias("base_score"),
        F.sum(F.col("score") + score).alias("score"),
    )
    return summed.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(numbers["n"]).cast("bigint").alias("train_tokens"), "base_score", "score")
