"""SimHash near duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits link where at most `distance` bits differ.  The bits are grouped into
partitions, correlated bits together; each partition gets its own threshold, and the thresholds
add up to distance - partitions + 1, so a linked pair is within the threshold of some partition.
Thresholds are chosen by dynamic programming on candidate counts estimated from a sample of
fingerprints; the choice moves work, never results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm import common
from logwarden.llm.components import components

SHINGLE = 4
DISTANCE = 4
_SEED = 42
#: Fingerprints from which correlations and candidate counts are estimated.
SAMPLE = 4096
#: Fingerprints of one bucket compared with each other in one task; larger buckets take the way of midpoints.
BUCKET_LIMIT = 32768
#: Rows that a task of the bucket stage should read.
_TASK_ROWS = 400_000
_ONE = np.uint64(1)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text, as a signed 64-bit number."""
    words = text.translate(common.LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], _SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=False)]
    bits = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 8192):
        part = np.array(hashes[k : k + 8192], "<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tag (a hash of the text) and fp of each row; a null text counts as empty, an empty text has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            out = [fingerprint(x, shingle) for x in common.text_bytes(batch.column("text"))]
            columns = [batch.column("doc_id"), batch.column("tag"), pa.array(out, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tag", "fp"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    return rows.mapInArrow(run, "doc_id bigint, tag bigint, fp bigint")


def project(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint, close together."""
    out = np.zeros(len(fps), np.uint64)
    for k, bit in enumerate(bits):
        out |= ((fps >> np.uint64(bit)) & _ONE) << np.uint64(k)
    return out


def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of nearly equal size; each group grows by the bit most correlated with it."""
    values = (sample[:, None] >> np.arange(64, dtype=np.uint64) & _ONE).astype(float)
    values -= values.mean(axis=0)
    norm = np.sqrt((values**2).sum(axis=0))
    alike = np.abs(values.T @ values) / np.maximum(np.outer(norm, norm), 1e-9)
    left, groups = list(range(64)), []
    for part in range(parts):
        size = len(left) // (parts - part)
        group = [left.pop(0)]
        while len(group) < size:
            best = max(left, key=lambda bit: alike[bit, group].sum())
            left.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def estimated_cost(sample: np.ndarray, total: int, bits: list[int], threshold: int) -> float:
    """Pairs to verify and rows to shuffle if one partition is probed with one threshold."""
    if threshold < 0:
        return 0.0
    values, near = project(sample, bits), 0
    for k in range(0, len(values), 256):
        near += int((np.bitwise_count(values[k : k + 256, None] ^ values[None, :]) <= threshold).sum())
    near = max(near - len(values), 0) / max(len(values) * (len(values) - 1), 1)
    least = sum(comb(len(bits), k) for k in range(threshold + 1)) / 2.0 ** len(bits)
    probes = sum(comb(len(bits), k) for k in range(threshold + 1))
    return total * (total * max(near, least) / 2 + 200.0 * (probes + 1))  # a shuffled row costs some 200 comparisons


def allocate(sample: np.ndarray, total: int, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Bits and threshold of each partition to probe, of the least estimated cost."""
    best: tuple[float, list[tuple[list[int], int]]] = (np.inf, [])
    for parts in range(1, distance + 2):
        groups, budget = group_bits(sample, parts), distance - parts + 1
        plans: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}  # by what the thresholds so far add up to, plus one each
        for bits in groups:
            costs = {t: estimated_cost(sample, total, bits, t) for t in range(-1, min(2, budget + parts - 1) + 1)}
            step: dict[int, tuple[float, list[int]]] = {}
            for spent, (cost, chosen) in plans.items():
                for t, more in costs.items():
                    if spent + t + 1 <= budget + parts and cost + more < step.get(spent + t + 1, (np.inf,))[0]:
                        step[spent + t + 1] = (cost + more, [*chosen, t])
            plans = step
        if (plan := plans.get(budget + parts)) and plan[0] < best[0]:
            best = (plan[0], [(bits, t) for bits, t in zip(groups, plan[1], strict=True) if t >= 0])
    return best[1]


def masks(bits: int, threshold: int) -> np.ndarray:
    """All values of `bits` bits with at most `threshold` set; the first is zero."""
    return np.array(
        [sum(1 << b for b in chosen) for k in range(threshold + 1) for chosen in combinations(range(bits), k)], np.uint64
    )


def _signatures(plan: list[tuple[list[int], int]]) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for part, (bits, threshold) in enumerate(plan):
                value = project(fps, bits)
                for k, mask in enumerate(masks(len(bits), threshold)):
                    key = common.mix((value ^ mask) * np.uint64(8) + np.uint64(part))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), batch.column("fp"), pa.array(np.full(len(fps), k == 0))], ["key", "fp", "home"]
                    )

    return run


def linked(key: np.ndarray, fps: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the buckets, enough of them to connect what the buckets connect."""
    order = np.lexsort((fps, key))
    key, fps, home = key[order], fps[order], home[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(first, len(key)))
    left, right = [], []
    small = np.repeat(size <= 64, size)
    at = np.flatnonzero(small & (np.repeat(size, size) > 1))
    stop = np.repeat(first + size, size)
    lag = 1
    while len(at := at[at + lag < stop[at]]):
        hit = (home[at] | home[at + lag]) & (np.bitwise_count(fps[at] ^ fps[at + lag]) <= distance)
        left.append(fps[at[hit]])
        right.append(fps[at[hit] + lag])
        lag += 1
    for begin, n in zip(first[size > 64].tolist(), size[size > 64].tolist(), strict=True):
        rest, front = np.unique(fps[begin : begin + n]), np.empty(0, np.uint64)
        while len(rest):
            if not len(front):
                front, rest = rest[:1], rest[1:]
            seed, front = front[0], front[1:]
            near = np.bitwise_count(rest ^ seed) <= distance
            left.append(np.full(int(near.sum()), seed))
            right.append(rest[near])
            front, rest = np.concatenate((front, rest[near])), rest[~near]
    if not left:
        return fps[:0], fps[:0]
    return np.concatenate(left), np.concatenate(right)


def _verify(distance: int) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [tuple(b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp", "home")) for b in batches]
        if not parts:
            return
        key, fps, home = (np.concatenate(x) for x in zip(*parts, strict=True))
        a, b = linked(key, fps.view(np.uint64), home, distance)
        pairs = np.unique(np.stack((np.minimum(a.view(np.int64), b.view(np.int64)), np.maximum(a.view(np.int64), b.view(np.int64)))), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    return run


def _midpoints(distance: int) -> object:
    """All fingerprints within half the distance: two are linked if and only if they share one (even distances)."""
    reach = masks(64, distance // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(fps), 128):
                part = fps[k : k + 128]
                middle = (part[:, None] ^ reach[None, :]).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(middle.view(np.int64)), pa.array(np.repeat(part, len(reach)).view(np.int64))], ["middle", "fp"]
                )

    return run


def links(fps: DataFrame, distance: int = DISTANCE, sample: int = SAMPLE, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints: every pair is within `distance`, and what links of
    all such pairs connect, these connect."""
    if distance % 2:
        raise ValueError("the distance must be even")
    total = fps.count()
    spark = fps.sparkSession
    if total < 2:
        return spark.createDataFrame([], "a bigint, b bigint")
    seen = fps.orderBy(F.xxhash64("fp")).limit(sample).collect()
    plan = allocate(np.array([r.fp for r in seen], np.int64).view(np.uint64), total, distance)
    rows = total * sum(len(masks(len(bits), t)) for bits, t in plan)
    marked = fps.mapInArrow(_signatures(plan), "key bigint, fp bigint, home boolean")
    hot = common.cut(marked.groupBy("key").count().where(F.col("count") > bucket_limit).select("key"))
    crowded = not hot.isEmpty()
    tasks = max(8, rows // _TASK_ROWS)
    usual = marked.join(hot, "key", "left_anti") if crowded else marked
    found = usual.repartition(tasks, "key").mapInArrow(_verify(distance), "a bigint, b bigint")
    if crowded:
        members = marked.join(hot, "key", "left_semi").select("fp").distinct()
        middles = members.mapInArrow(_midpoints(distance), "middle bigint, fp bigint")
        least = middles.groupBy("middle").agg(F.min("fp").alias("a"), F.max("fp").alias("last")).where("a < last")
        # Rows that share a middle all link to its smallest, so no pair of them is needed.
        star = middles.join(least, "middle").where("fp > a").select("a", F.col("fp").alias("b"))
        found = found.union(star)
    return found.distinct()


def _grouped(marks: DataFrame, distance: int, sample: int, bucket_limit: int) -> DataFrame:
    """fp and root of each distinct fingerprint; what links connect has one root."""
    distinct = marks.select("fp").distinct()
    joined = components(links(distinct, distance, sample, bucket_limit))
    return distinct.join(joined, distinct.fp == joined.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, sample: int = SAMPLE, bucket_limit: int = BUCKET_LIMIT
) -> DataFrame:
    """doc_id, fp (signed) and component_id (the smallest doc_id reachable by links) of each row.

    A null or empty text has fingerprint 0 and links like any other.  Rows of one doc_id are judged
    one by one.  A null doc_id is never a component's id unless the component has no other.
    Columns other than doc_id and text are not read.
    """
    marks = common.cut(fingerprints(docs, shingle))
    least = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = _grouped(marks, distance, sample, bucket_limit).join(least, "fp")
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(of_root, "root").select("fp", "component_id")
    return marks.join(named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, sample: int = SAMPLE, bucket_limit: int = BUCKET_LIMIT
) -> DataFrame:
    """The row of each component with the smallest doc_id, with all columns of `docs`.

    Of rows with one doc_id the smallest hash of the text decides, of equal rows any stays; rows
    without a doc_id come last.
    """
    marks = common.cut(fingerprints(docs, shingle))
    least = marks.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("first"))
    of_root = _grouped(marks, distance, sample, bucket_limit).join(least, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = of_root.select(F.col("first.doc_id").alias("_kept_id"), F.col("first.tag").alias("_kept_tag"))
    out = docs.join(kept, docs["doc_id"].eqNullSafe(F.col("_kept_id")) & (F.xxhash64(docs["text"]) == F.col("_kept_tag")), "left_semi")
    repeated = not marks.groupBy("doc_id", "tag").count().where("count > 1").isEmpty()
    return out.dropDuplicates(["doc_id", "text"]) if repeated else out
