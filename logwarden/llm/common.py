"""Helpers of the corpus operators: reading tables, slicing Arrow batches, words as byte arrays."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one numpy pass holds; temporaries are some twenty times as large.
SLICE_BYTES = 4 << 20

#: Bytes of rows that Spark hands to a Python worker at a time; its own bound, 64 MB, is held several times over
#: by the JVM and the worker of each core.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Lower-cases A-Z only.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
LOWER_TABLE = np.frombuffer(LOWER, np.uint8)

_byte = np.arange(256)
#: Bytes of a word `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text.
WORD_BYTE = ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
#: Bytes of a word `[^\x20\x09-\x0D]+`.
SOLID_BYTE = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))

_PRIME = 0x9E3779B97F4A7C15


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_corpus_code_sent", None):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(top)
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="code-")), f"{name}_llm.zip")
    with zipfile.ZipFile(archive, "w") as out:
        out.write(os.path.join(top, "__init__.py"), f"{name}/__init__.py")
        for file in sorted(os.listdir(os.path.join(top, "llm"))):
            if file.endswith(".py"):
                out.write(os.path.join(top, "llm", file), f"{name}/llm/{file}")
    context.addPyFile(archive)
    context._corpus_code_sent = True


def bound_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session by BATCH_BYTES, unless the session says otherwise."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`, or where it is unset a folder of the warehouse, which executors reach too."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    return root.rstrip("/")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor reaches."""
    return f"{shared_root(spark)}/llm/{purpose}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows from reliable storage, without their lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each holds at most `limit` bytes of text or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, first = np.cumsum(sizes, dtype=np.int64), 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def text_bytes(column: pa.Array) -> list[bytes]:
    """Each text as UTF-8; a null is an empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def joined(texts: list[bytes], after: bytes = b"\0") -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, one more byte after each, and where each begins (one more entry at the end)."""
    data = np.frombuffer(after.join(texts) + after, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return data, np.concatenate(([0], np.cumsum(sizes)))


def spans_of(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true entries."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the outcome depends on every bit of x."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n-1 of an odd constant and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        _powers.clear()
        size = max(n, 1 << 16)
        for base in (_PRIME, pow(_PRIME, -1, 1 << 64)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            with np.errstate(over="ignore"):
                _powers.append(np.multiply.accumulate(out))
    return _powers[0][:n], _powers[1][:n]


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; it depends on nothing else."""
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1])))
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def pack(arrays: list[np.ndarray]) -> tuple[bytes, int]:
    """Arrays as one compressed value, and its size before compression.

    First bytes of all entries come first, then second bytes and so on: most upper bytes are equal, and compress well.
    """
    head = np.array([x.nbytes for x in arrays], np.int64)
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(x.size, x.itemsize).T.tobytes() for x in arrays]
    raw = b"".join((head.tobytes(), *planes))
    return pa.Codec("zstd").compress(raw, asbytes=True), len(raw)


def unpack(blob: bytes, size: int, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The arrays of `pack`, given their types."""
    raw = pa.Codec("zstd").decompress(blob, size, asbytes=True)
    at, out = 8 * len(kinds), []
    for n, kind in zip(np.frombuffer(raw, np.int64, len(kinds)).tolist(), kinds, strict=True):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n, at).reshape(width, n // width)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n // width))
        at += n
    return out


def map_arrow(
    df: DataFrame, columns: list[str], function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return df.select(*columns).mapInArrow(function, schema)
