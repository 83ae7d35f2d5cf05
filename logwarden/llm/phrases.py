"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, the phrases into phrases of phrases, and so on.  Where a phrase
begins is decided by deterministic coin tossing on a few neighbouring names, so equal substrings
have equal phrases but for their borders, at whatever offset they stand.  A fingerprint keeps the
smallest hashes of the phrase names of the upper levels; the likeness of two fingerprints
estimates the share of phrases that the texts have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm import common

#: Hashes that a fingerprint keeps.
KEPT = 64
#: Names of this level and above are kept; a level-2 phrase has some nine characters.
LOWEST = 2
#: Rows of one range in the order of ids.
BUCKET_ROWS = 16_000
#: Code points parsed together; their arrays fit a processor's cache.
_CHUNK = 50_000
_ROUNDS = 4  # 64-bit names come down to six labels


def _tossed(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below six that differ between neighbours of one text; `first` marks where texts begin."""
    label = names
    for kind in (label.dtype.type, np.uint8, np.uint8, np.uint8)[:_ROUNDS]:
        differs = np.empty_like(label)
        differs[1:] = label[1:] ^ label[:-1]
        differs[0] = 1
        differs[first] = 1
        lowest = differs & (~differs + kind(1))
        bit = np.bitwise_count(lowest - kind(1))  # the number of the lowest bit that differs
        label = bit + bit + ((label & lowest) != 0)
    return label


def _named(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A name for each run of values; equal runs have equal names."""
    up, down = common.powers(len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values.astype(np.uint64, copy=False) * up[:-1])))
        return common.mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def levels(codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Level, names and owning text of the phrases, from level 1 on until each text is one phrase."""
    names, level = codes, 0
    while len(names):
        level += 1
        # Repetitions of one name become one name.
        start = np.flatnonzero(np.concatenate(([True], (names[1:] != names[:-1]) | (owner[1:] != owner[:-1]))))
        if len(start) < len(names):
            size = np.diff(np.append(start, len(names)))
            names, owner, more = names[start], owner[start], np.flatnonzero(size > 1)
            if level == 1:  # a code point has 21 bits
                names = names.astype(np.uint64) if size.max() >= 1 << 11 else names
                names[more] |= size[more].astype(names.dtype) << names.dtype.type(21)
            else:
                names[more] = common.mix(names[more] + size[more].astype(np.uint64))
        first = np.concatenate(([True], owner[1:] != owner[:-1]))
        label = _tossed(names, first)
        peak = first.copy()
        peak[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[2:]
        # A phrase of one name at the beginning of a text would keep the hierarchy from ending.
        peak[1:] &= ~(first[:-1] & ~first[1:])
        start = np.flatnonzero(peak)
        names, owner = _named(names, start, np.append(start[1:], len(names))), owner[start]
        yield level, names, owner
        # A text that is a single phrase is done.
        alone = np.concatenate(([True], owner[1:] != owner[:-1])) & np.concatenate((owner[1:] != owner[:-1], [True]))
        names, owner = names[~alone], owner[~alone]


def fingerprints(texts: list[str], kept: int = KEPT, lowest: int = LOWEST) -> list[np.ndarray]:
    """The fingerprint of each text: up to `kept` hashes, ascending; none for an empty text."""
    out, part, size = [], [], 0
    for text in texts:
        if part and size + len(text) > _CHUNK:
            out += _fingerprints(part, kept, lowest)
            part, size = [], 0
        part.append(text)
        size += len(text)
    return out + (_fingerprints(part, kept, lowest) if part else [])


def _fingerprints(texts: list[str], kept: int, lowest: int) -> list[np.ndarray]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    owner, found = np.repeat(np.arange(len(texts), dtype=np.int32), sizes), []
    for level, names, of in levels(codes, owner):
        if level < lowest:  # a short text may end below: its last name stands for it
            single = np.bincount(of, minlength=len(texts)) == 1
            chosen = single[of]
            names, of = names[chosen], of[chosen]
        found.append((of.astype(np.uint64) << np.uint64(32)) | (names >> np.uint64(32)))
    top = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
    begin = np.searchsorted(top, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    hashes = (top & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [hashes[a : min(b, a + kept)] for a, b in zip(begin.tolist(), begin[1:].tolist(), strict=False)]


def likeness(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    """Estimated share of common phrases, 0 to 1; two empty texts are alike."""
    union, times = np.unique(np.concatenate((a, b)), return_counts=True)
    return float((times[:kept] == 2).mean()) if len(union) else 1.0


def _shown(marks: list[np.ndarray]) -> list[str]:
    return [x.astype(">u4").tobytes().hex() for x in marks]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (hex) of each row; null and empty texts have an empty fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            marks = fingerprints([x or "" for x in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_shown(marks))], ["doc_id", "fingerprint"])

    return common.map_arrow(docs, ["doc_id", "text"], run, "doc_id bigint, fingerprint string")


#: A row of the table of all comparisons; where a range begins or ends also a row with the text of this row alone.
_RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, own binary, edited binary, near_edited double, near_next double"
_WORK = _RESULT + ", part int, border string, text string"


def _compared(rows: list[tuple[int | None, str, np.ndarray, str, np.ndarray]]) -> list[pa.Array]:
    """Columns of the result from doc_id, text and fingerprint of each row, and text and fingerprint of the next."""
    edited = [text[: len(text) - len(text) // 4] + after[: len(text) // 4] for _, text, _, after, _ in rows]
    marks = fingerprints(edited)
    return [
        pa.array([r[0] for r in rows], pa.int64()),
        pa.array([len(r[1]) for r in rows], pa.int64()),
        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
        pa.array([r[2].astype(">u4").tobytes() for r in rows], pa.binary()),
        pa.array([x.astype(">u4").tobytes() for x in marks], pa.binary()),
        pa.array([likeness(r[2], x) for r, x in zip(rows, marks, strict=True)], pa.float64()),
        pa.array([likeness(r[2], r[4]) for r in rows], pa.float64()),
    ]


_NAMES = ["doc_id", "n_chars", "edited_sha256", "own", "edited", "near_edited", "near_next"]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a sorted range meets the row after it; the first and the last row are named as borders."""
    held, part = None, None  # the last row, which waits for its next

    def out(columns: list[pa.Array], border: str | None, text: str | None) -> pa.RecordBatch:
        n = len(columns[0])
        more = [pa.array([part] * n, pa.int32()), pa.array([border] * n, pa.string()), pa.array([text] * n, pa.string())]
        return pa.RecordBatch.from_arrays([*columns, *more], [*_NAMES, "part", "border", "text"])

    def edge(row: tuple, border: str) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
        return out([pa.array([row[0]], pa.int64()), *(pa.nulls(1, kind) for kind in kinds)], border, row[1])

    for batch in common.slices(batches):
        texts = [x or "" for x in batch.column("text").to_pylist()]
        rows = list(zip(batch.column("doc_id").to_pylist(), texts, fingerprints(texts), strict=True))
        if held is None:
            part = batch.column("part")[0].as_py()
            yield edge(rows[0], "first")
        else:
            rows = [held, *rows]
        held = rows[-1]
        if len(rows) > 1:
            yield out(_compared([(*row, *after[1:]) for row, after in zip(rows, rows[1:], strict=False)]), None, None)
    if held is not None:
        yield edge(held, "last")


def _compare_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As `_compare`, of rows that come with the text of the next."""
    for batch in common.slices(batches):
        texts, after = ([x or "" for x in batch.column(c).to_pylist()] for c in ("text", "after"))
        rows = zip(batch.column("doc_id").to_pylist(), texts, fingerprints(texts), after, fingerprints(after), strict=True)
        yield pa.RecordBatch.from_arrays(_compared(list(rows)), _NAMES)


def compare_with_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """For each row its fingerprint, that of its edited text, and its likeness to this and to the next document.

    The edited text has the last quarter of the code points replaced by as many from the beginning
    of the next document, in the order of doc_id (after the last, the first).  Rows of one doc_id
    follow each other in the order of their texts.  A row without a doc_id is next to none and has
    the first document as its next.  A null text is empty; a very long one is parsed in one pass,
    whole.  An empty table gives no rows.  Columns other than doc_id and text are not read.

    The rows are sorted into ranges of about `bucket_rows` rows, by one shuffle, and each range is
    compared as it streams by.  Only its last row needs another range: these rows, one for each
    range, are joined with the first rows of the ranges.  Rows of one doc_id are split among ranges
    by the beginning of their texts; rows equal in both lie in one range, sorted on disk if need be.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total, lost = rows.agg(F.count("doc_id"), F.count(F.when(F.col("doc_id").isNull(), 1))).first()
    parts = max(1, -(-total // bucket_rows))
    ranged = rows.where("doc_id IS NOT NULL").repartitionByRange(parts, "doc_id", F.substring("text", 1, 32))
    ranged = ranged.sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id())
    folder = common.work_folder(spark, "phrases")
    ranged.mapInArrow(_compare, _WORK).write.parquet(folder)
    work = spark.read.schema(_WORK).parquet(folder)
    first = work.where("border = 'first'").select(F.col("part").alias("next"), F.col("text").alias("after"))
    n, most = first.agg(F.count("*"), F.max("next")).first()
    if n and n != most + 1:  # a bound of a range is a row of it, so only ranges after the last row are empty
        raise RuntimeError(f"{n} of {most + 1} ranges have rows")
    last = work.where("border = 'last'").select("doc_id", "text", ((F.col("part") + 1) % F.lit(max(n, 1))).alias("next"))
    pairs = last.join(first, "next").select("doc_id", "text", "after")
    result = work.where("border IS NULL").select(*_NAMES).union(pairs.mapInArrow(_compare_pairs, _RESULT))
    if lost:
        opening = first.where("next = 0").first()  # one document
        without = rows.where("doc_id IS NULL").withColumn("after", F.lit(opening.after if opening else ""))
        result = result.union(without.mapInArrow(_compare_pairs, _RESULT))
    shown = {"fingerprint": F.lower(F.hex("own")), "edited_fingerprint": F.lower(F.hex("edited"))}
    return result.select("doc_id", "n_chars", "edited_sha256", *(c.alias(k) for k, c in shown.items()), "near_edited", "near_next")
