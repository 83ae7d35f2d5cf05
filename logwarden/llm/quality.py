"""Quality classifier by co-training.

Two classifiers see separate views of a document: its content (words, byte trigrams and layout;
naive Bayes log-ratios, weighed by a logistic regression) and its page metadata (source, language
and size, a logistic regression).  In each
round either names the unlabelled documents it is most sure of, and the other learns from them.
Both are calibrated on labelled documents kept aside, and the calibrated views are combined into
one score.

The labelled documents are a bounded sample.  All other documents are the unlabelled pool: their
features are written once, and each round counts on the executors what the sure ones teach.  The
driver sees sums of fixed size only: a number for each content slot and for each metadata cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm import common

#: Documents of the labelled sample, half of them of each class; the pool of the others is not bounded.
LABELLED = 3000
ROUNDS = 3
#: Share of the pool that a view names in a round (twice as much in the second, and so on), and how sure it must be.
SHARE, SURE = 0.1, 0.9
#: Documents with a lower score are rejected.
THRESHOLD = 0.5
#: Hashed content features.
_SLOTS = 1 << 15
#: Layout features, each in bins, which are numbered after the slots.
_LAYOUT, _BINS = 12, 32
_TABLE = _SLOTS + _LAYOUT * _BINS
#: Fixed value: characters counted as symbols in the layout.
_SYMBOLS = b"$%&#*|!~^=<>{}[]\\@_+"
#: Bytes of text taken at a time.
_SLICE = 1 << 19
#: Hashed sources and languages, and sizes by power of two; a cell of the page view is one of each.
_SOURCES, _LANGUAGES, _SIZES = 64, 32, 32
_CELLS = _SOURCES * _LANGUAGES * _SIZES
#: Steps of certainty, in log-odds, by which the surest of the pool are told.
_STEPS, _STEP = 4096, 0.01
_SURE_AT = float(np.log(SURE / (1 - SURE)))
#: Shares of a text are added up as whole numbers, so that the order of addition does not matter.
_UNIT = 1 << 16


def content_tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts, and the text of each: words and byte trigrams, ASCII lower-cased."""
    data, begins = common.joined(texts)
    data = common.LOWER_TABLE[data]
    start, end = common.spans_of(common.SOLID_BYTE[data] & (data != 0))
    words = common.hash_spans(data, start, end)
    code = data.astype(np.uint64)
    three = code[:-2] << np.uint64(16) | code[1:-1] << np.uint64(8) | code[2:] if len(data) > 2 else code[:0]
    inside = (data[:-2] != 0) & (data[1:-1] != 0) & (data[2:] != 0) if len(data) > 2 else np.empty(0, bool)
    at = np.flatnonzero(inside)
    three = common.mix(three[at] + np.uint64(1 << 40))
    owner = np.searchsorted(begins, np.concatenate((start, at)), "right") - 1
    return (np.concatenate((words, three)) % np.uint64(_SLOTS)).astype(np.int32), owner


def layout_bins(texts: list[bytes]) -> np.ndarray:
    """The bin of each layout feature of each document, a row each."""
    out = np.zeros((len(texts), _LAYOUT))
    for row, text in zip(out, texts, strict=True):
        n, lines, words = max(len(text), 1), text.split(b"\n"), text.split()
        count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        upper, lower, digits = count[65:91].sum(), count[97:123].sum(), count[48:58].sum()
        symbols = sum(int(count[c]) for c in _SYMBOLS)
        shares = (
            upper / max(upper + lower, 1), digits / n, symbols / n, (count[46] + count[44]) / n, len(set(lines)) / len(lines),
            len(set(words)) / max(len(words), 1), count[128:].sum() / n, sum(not x.strip() for x in lines) / len(lines), count[124] / n,
        )
        row[:9] = np.sqrt(shares) * (_BINS - 1)
        row[9:] = np.log1p((len(lines), n / len(lines), n / max(len(words), 1))) * 3
    return np.minimum(out, _BINS - 1).astype(np.uint8)


def page_cells(texts: list[bytes], sources: list, languages: list) -> np.ndarray:
    """The metadata cell of each document."""

    def numbers(kind: str, names: list, slots: int) -> np.ndarray:
        known = {}
        for name in set(names):
            raw = np.frombuffer(f"{kind}={name}".encode(), np.uint8)
            known[name] = int(common.hash_spans(raw, np.array([0]), np.array([len(raw)]))[0] % np.uint64(slots))
        return np.array([known[name] for name in names], np.int64)

    size = np.array([min(len(t).bit_length(), _SIZES - 1) for t in texts], np.int64)
    return (numbers("source", sources, _SOURCES) * _LANGUAGES + numbers("language", languages, _LANGUAGES)) * _SIZES + size


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(12):
        p = _sigmoid(x @ w)
        slope = x.T @ (weight * (y - p)) - ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w + np.linalg.solve(curve, slope)
    return w


def _columns(cells: np.ndarray) -> np.ndarray:
    """Of each cell the features that are one: its source, its language, its size, and the constant."""
    source, language, size = cells // (_LANGUAGES * _SIZES), cells // _SIZES % _LANGUAGES, cells % _SIZES
    return np.stack((source, _SOURCES + language, _SOURCES + _LANGUAGES + size, np.full(len(cells), _SOURCES + _LANGUAGES + _SIZES)), 1)


def page_weights(good: np.ndarray, bad: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """As `logistic`, of cells with so much weight of good and of bad documents each."""
    some = np.flatnonzero(good + bad)
    at, every = _columns(some), good[some] + bad[some]
    n = _SOURCES + _LANGUAGES + _SIZES + 1
    pairs = (at[:, :, None] * n + at[:, None, :]).reshape(len(some), -1)
    w = np.zeros(n)
    for _ in range(12):
        p = _sigmoid(w[at].sum(axis=1))
        slope = np.bincount(at.ravel(), np.repeat(good[some] - every * p, at.shape[1]), n) - ridge * w
        curve = np.bincount(pairs.ravel(), np.repeat(every * p * (1 - p), pairs.shape[1]), n * n).reshape(n, n)
        w = w + np.linalg.solve(curve + ridge * np.eye(n), slope)
    return w


def _bin_numbers(layout: np.ndarray) -> np.ndarray:
    return _SLOTS + np.arange(_LAYOUT) * _BINS + layout.reshape(-1, _LAYOUT).astype(np.int64)


def _ratios(tokens: np.ndarray, layout: np.ndarray, table: np.ndarray) -> np.ndarray:
    return np.column_stack((tokens, table[_bin_numbers(layout)], np.ones(len(tokens))))


@dataclass
class Bag:
    """Features of some documents: slots and their counts, where each document begins, its cell and layout."""

    slot: np.ndarray
    count: np.ndarray
    begin: np.ndarray
    cell: np.ndarray
    layout: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch) -> Bag:
        texts = common.text_bytes(batch.column("text"))
        slot, owner = content_tokens(texts)
        key, count = np.unique(owner.astype(np.int64) << 32 | slot, return_counts=True)
        begin = np.searchsorted(key, np.arange(len(texts) + 1, dtype=np.int64) << 32)
        cell = page_cells(texts, batch.column("source").to_pylist(), batch.column("lang").to_pylist())
        return Bag((key & 0xFFFFFFFF).astype(np.uint16), count, begin, cell, layout_bins(texts).ravel())

    def _sizes(self) -> tuple[np.ndarray, np.ndarray]:
        """The text of each entry, and the number of tokens of each text (1 at least)."""
        owner = np.repeat(np.arange(len(self.cell)), np.diff(self.begin))
        return owner, np.maximum(np.bincount(owner, self.count, len(self.cell)), 1)

    def _binned(self) -> np.ndarray:
        """The number of each layout feature's bin, a row for each document."""
        return _bin_numbers(self.layout)

    def shares(self, which: np.ndarray) -> np.ndarray:
        """Sum over the chosen documents of the share of each slot in a document and of the bins, in units."""
        owner, size = self._sizes()
        use = which[owner]
        share = np.rint(self.count[use] / size[owner[use]] * _UNIT)
        bins = np.bincount(self._binned()[which].ravel(), minlength=_TABLE) * _UNIT
        return np.rint(np.bincount(self.slot[use], share, _TABLE)).astype(np.int64) + bins

    def ratios(self, table: np.ndarray) -> np.ndarray:
        """Of each document the mean log-ratio of its tokens, those of its bins, and a one."""
        owner, size = self._sizes()
        return _ratios(np.bincount(owner, self.count * table[self.slot], len(self.cell)) / size, self.layout, table)

    def score(self, content: Content) -> np.ndarray:
        return self.ratios(content.table) @ content.weights


@dataclass
class Content:
    """The content view: a log-ratio for each slot and bin, and the weights of what `Bag.ratios` makes of them."""

    table: np.ndarray
    weights: np.ndarray


#: Numbers of one block of a sum, and tasks that add blocks up.
_BLOCK, _SUMMERS = 1 << 14, 8


def _block(k: int, numbers: np.ndarray) -> pa.RecordBatch:
    blob, size = common.pack([numbers])
    return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([blob], pa.binary()), pa.array([size], pa.int64())], ["k", "blob", "size"])


_POOL_KINDS = ("<u2", "<i4", "<i4", "<i4", "u1")


class Pool:
    """The unlabelled documents: packed features, a row for each slice of them, and the number in each cell."""

    def __init__(self, docs: DataFrame, without: set[int]) -> None:
        skipped = pa.array(sorted(without), pa.int64())

        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in common.slices(batches, limit=_SLICE):
                batch = batch.filter(pc.invert(pc.is_in(batch.column("doc_id"), value_set=skipped)))
                if batch.num_rows:
                    bag = Bag.of(batch)
                    blob, size = common.pack([bag.slot, *(x.astype(np.int32) for x in (bag.count, bag.begin, bag.cell)), bag.layout])
                    yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary()), pa.array([size], pa.int64())], ["blob", "size"])

        spark = docs.sparkSession
        folder = common.work_folder(spark, "quality")
        common.map_arrow(docs, ["doc_id", "text", "source", "lang"], features, "blob binary, size bigint").write.parquet(folder)
        self.rows = spark.read.schema("blob binary, size bigint").parquet(folder)
        self.cells = self._sums(lambda bag: np.bincount(bag.cell, minlength=_CELLS)[None], _CELLS)[0]

    def _sums(self, function: object, width: int) -> np.ndarray:
        """The sum over the pool of a table of whole numbers, rows of `width`, made from each slice."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for blob, size in zip(batch.column("blob").to_pylist(), batch.column("size").to_pylist(), strict=True):
                    part = function(Bag(*common.unpack(blob, size, _POOL_KINDS)))
                    total = part if total is None else total + part
            for k in range(-(-total.size // _BLOCK)) if total is not None else ():
                block = total.ravel()[k * _BLOCK : (k + 1) * _BLOCK].astype(np.int64)
                if block.any():
                    yield _block(k, block)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    (block,) = common.unpack(row["blob"], row["size"], ("<i8",))
                    sums[row["k"]] = sums.get(row["k"], 0) + block
            for k, block in sums.items():
                yield _block(k, block)

        # A task sends its table in blocks; each block is added up in one task, as its rows stream by.
        sent = self.rows.mapInArrow(run, "k int, blob binary, size bigint")
        got = sent.repartition(_SUMMERS, "k").mapInArrow(add, "k int, blob binary, size bigint").toArrow().to_pylist()
        out = np.zeros(-(-4 * width // _BLOCK) * _BLOCK, np.int64)
        for row in got:
            (block,) = common.unpack(row["blob"], row["size"], ("<i8",))
            out[row["k"] * _BLOCK : row["k"] * _BLOCK + len(block)] += block
        return out[: 4 * width].reshape(4, width)

    def surest(self, content: Content, platt: np.ndarray, wanted: tuple[float, float]) -> tuple[float, float]:
        """From which log-odds on the content view is among the `wanted` surest that documents are good, and bad."""

        def steps(bag: Bag) -> np.ndarray:
            odds = bag.score(content) * platt[0] + platt[1]
            sides = [np.minimum((x[x >= _SURE_AT] - _SURE_AT) / _STEP, _STEPS - 1).astype(np.int64) for x in (odds, -odds)]
            return np.stack([np.bincount(x, minlength=_STEPS) for x in sides])

        return tuple(
            _SURE_AT + _STEP * _reached(counts[:_STEPS], most) for counts, most in zip(self._sums(steps, _STEPS)[:2], wanted, strict=True)
        )

    def taught(self, content: Content, platt: np.ndarray, at: tuple[float, float], good: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, ...]:
        """Slot shares of the documents in cells marked good and bad, and cells of those that the content view is sure of."""

        def learn(bag: Bag) -> np.ndarray:
            odds = bag.score(content) * platt[0] + platt[1]
            out = np.zeros((4, max(_TABLE, _CELLS)), np.int64)
            for k, marked in enumerate((good, bad)):
                out[k, :_TABLE] = bag.shares(marked[bag.cell])
            for k, side in enumerate((odds >= at[0], -odds >= at[1])):
                out[2 + k, :_CELLS] = np.bincount(bag.cell[side], minlength=_CELLS)
            return out

        sums = self._sums(learn, max(_TABLE, _CELLS))
        return sums[0, :_TABLE], sums[1, :_TABLE], sums[2, :_CELLS], sums[3, :_CELLS]


def _reached(counts: np.ndarray, wanted: float) -> int:
    """The highest step from which on at least `wanted` documents lie; 0 if there are fewer."""
    return int(np.flatnonzero(np.append(counts[::-1].cumsum()[::-1] >= wanted, False) | (np.arange(len(counts) + 1) == 0))[-1])


@dataclass
class Model:
    """Both views and how they are calibrated; `usable` is false if the labels don't show two classes."""

    usable: bool
    content: Content | None = None
    page: np.ndarray | None = None
    calibration: np.ndarray | None = None  # a row (slope, offset) for each view
    combination: np.ndarray | None = None

    def scores(self, content: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated scores of both views and of both together, from the raw content score and the cells."""
        if not self.usable:
            ones = np.ones(len(cells))
            return ones, ones, ones
        raw = np.stack((content, self.page[_columns(cells)].sum(axis=1)))
        logits = np.clip(raw * self.calibration[:, :1] + self.calibration[:, 1:], -8, 8)
        both = logits.T @ self.combination[:2] + self.combination[2]
        return _sigmoid(logits[0]), _sigmoid(logits[1]), _sigmoid(both)


def co_train(bag: Bag, label: np.ndarray, weight: np.ndarray, pool: Pool, rounds: int = ROUNDS) -> Model:
    """A model from labelled documents, how many documents each stands for, and the pool; every fourth is kept aside.

    What the pool teaches of a class weighs as much as its labelled documents, however large the pool.
    A round names its documents anew, so an early error does not stay.  Documents as sure as the last
    that is named are named too.
    """
    aside = np.zeros(len(label), bool)
    for value in (0, 1):
        aside[np.flatnonzero(label == value)[::4]] = True
    sides = [~aside & (label == value) for value in (1, 0)]
    if min(side.sum() for side in sides) < 2:
        return Model(False)
    fold = np.zeros(len(label), int)
    for side in sides:
        fold[np.flatnonzero(side)[::2]] = 1
    shown = [bag.shares(side).astype(float) / side.sum() for side in sides]
    stood = [np.bincount(bag.cell[side], minlength=_CELLS).astype(float) / side.sum() for side in sides]
    half = (~aside).sum() / 2
    every = float(pool.cells.sum())
    rate = weight[label == 1].sum() / weight.sum()

    def joint(own: np.ndarray, more: np.ndarray, n: float) -> np.ndarray:
        return (own + more / n) / 2 if n else own

    def fit(slots: list[tuple], cells: list[tuple]) -> tuple[Content, np.ndarray, list[np.ndarray]]:
        def table_of(shown: list[np.ndarray]) -> np.ndarray:
            parts = [joint(own, *more) / _UNIT for own, more in zip(shown, slots, strict=True)]
            tokens = [x[:_SLOTS] * 200_000 + 0.5 for x in parts]
            # Neighbouring bins share what they hold, as few documents may lie in one.
            bins = [sum(x[_SLOTS:].reshape(_LAYOUT, _BINS) @ np.eye(_BINS, k=k) * (3 - abs(k)) for k in range(-2, 3)) * 100 + 0.5 for x in parts]
            logs = [np.log(x / x.sum(axis=-1, keepdims=True)).ravel() for x in (*tokens, *bins)]
            return np.concatenate((logs[0] - logs[1], logs[2] - logs[3]))

        # A document weighs the ratios by those that others give, as its own fit it too well.
        ratios = np.zeros((len(label), _LAYOUT + 2))
        for turn in (0, 1):
            others = [side & (fold != turn) for side in sides]
            ratios[fold == turn] = bag.ratios(table_of([bag.shares(x) / x.sum() for x in others]))[fold == turn]
        weights = logistic(ratios[~aside], label[~aside].astype(float), np.ones(int((~aside).sum())), 1.0)
        content = Content(table_of(shown), weights)
        page = page_weights(*(half * joint(own, *more) for own, more in zip(stood, cells, strict=True)))
        return content, page, [bag.score(content), page[_columns(bag.cell)].sum(axis=1)]

    def platt(raw: np.ndarray) -> np.ndarray:
        x = np.stack((raw[aside], np.ones(int(aside.sum()))), axis=1)
        return logistic(x, label[aside].astype(float), weight[aside] / weight[aside].mean(), 0.01)

    nothing = [(0.0, 0.0)] * 2
    content, page, raw = fit(nothing, nothing)
    filled = np.flatnonzero(pool.cells)
    for turn in range(1, rounds + 1 if len(filled) else 1):
        wanted = tuple(max(1.0, turn * SHARE * part * every) for part in (rate, 1 - rate))
        slope, offset = platt(raw[1])
        odds = page[_columns(filled)].sum(axis=1) * slope + offset
        marked = []
        for x, most in zip((odds, -odds), wanted, strict=True):
            order = np.argsort(-x, kind="stable")
            sure = order[x[order] >= _SURE_AT]
            reached = np.searchsorted(pool.cells[filled[sure]].cumsum(), most)
            mark = np.zeros(_CELLS, bool)
            mark[filled[sure[: reached + 1]]] = True
            marked.append(mark)
        on_content = platt(raw[0])
        at = pool.surest(content, on_content, wanted)
        good, bad, good_cells, bad_cells = pool.taught(content, on_content, at, *marked)
        slots = [(part, float(pool.cells[mark].sum())) for part, mark in zip((good, bad), marked, strict=True)]
        content, page, raw = fit(slots, [(part, float(part.sum())) for part in (good_cells, bad_cells)])
    calibration = np.stack([platt(r) for r in raw])
    logits = np.clip(np.stack(raw) * calibration[:, :1] + calibration[:, 1:], -8, 8)
    x = np.concatenate((logits, np.ones((1, len(label))))).T[aside]
    combination = logistic(x, label[aside].astype(float), weight[aside] / weight[aside].mean(), 1.0)
    return Model(True, content, page, calibration, combination)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, limit=_SLICE):
        bag = Bag.of(batch)
        begin = pa.array(bag.begin.astype(np.int32))
        slot, count = (pa.ListArray.from_arrays(begin, pa.array(x.astype(np.int32))) for x in (bag.slot, bag.count))
        layout = pa.array(bag.layout.reshape(-1, _LAYOUT).tolist(), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), slot, count, pa.array(bag.cell), layout], ["doc_id", "slot", "count", "cell", "layout"])


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """A model from at most `labelled` labelled documents, half of each class and chosen by hash of doc_id, and all others.

    Labels that are null, or that differ for one doc_id, are not used.  Of rows with one chosen
    doc_id the least by text, source and language is used, and none of them is in the pool.
    """
    marks = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(
        F.min("quality").alias("label"), F.max("quality").alias("_most")
    )
    marks = marks.where(F.col("label") == F.col("_most")).select("doc_id", "label")
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().join(marks, "doc_id")
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    there = {r.label: r.n for r in ids.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = {r.doc_id: r.label for v in (0, 1) for r in ids.where(F.col("label") == v).orderBy(*order).limit(labelled // 2).collect()}
    if len(there) < 2:
        return Model(False)
    rows = docs.select("doc_id", F.struct("text", "source", "lang").alias("row")).where(F.col("doc_id").isin(list(chosen)))
    one = rows.groupBy("doc_id").agg(F.min("row").alias("row")).select("doc_id", "row.text", "row.source", "row.lang")
    got = one.mapInArrow(_sampled, "doc_id bigint, slot array<int>, count array<int>, cell bigint, layout array<int>").orderBy("doc_id").toArrow().combine_chunks()
    label = np.array([chosen[i] for i in got["doc_id"].to_pylist()])
    weight = np.where(label == 1, there[1] / max((label == 1).sum(), 1), there[0] / max((label == 0).sum(), 1))
    slot, count = got["slot"].combine_chunks(), got["count"].combine_chunks()
    begin = np.concatenate(([0], np.cumsum(slot.value_lengths().to_numpy())))
    bag = Bag(slot.flatten().to_numpy(), count.flatten().to_numpy(), begin, got["cell"].to_numpy(), got["layout"].combine_chunks().flatten().to_numpy())
    if min((label == v).sum() for v in (0, 1)) < 3:  # one is kept aside
        return Model(False)
    return co_train(bag, label, weight, Pool(docs, set(chosen)))


def _judge(model: Model, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    texts, n = common.text_bytes(batch.column("text")), batch.num_rows
    content = np.zeros(n)
    if model.usable:
        slot, owner = content_tokens(texts)
        tokens = np.bincount(owner, model.content.table[slot], n) / np.maximum(np.bincount(owner, minlength=n), 1)
        content = _ratios(tokens, layout_bins(texts), model.content.table) @ model.content.weights
    return model.scores(content, page_cells(texts, batch.column("source").to_pylist(), batch.column("lang").to_pylist()))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, content_score, page_score, score (0 to 1, of being good) and keep (score at least `threshold`) of each row.

    A null text is empty, a null source or language is a name of its own.  Repeated rows are scored
    one by one, and very long texts as a whole.  Where the labels don't show two classes, every
    document scores 1.  Columns other than doc_id, text, source and lang are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, limit=_SLICE):
            content, page, both = _judge(model.value, batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(content), pa.array(page), pa.array(both), pa.array(both >= threshold)],
                ["doc_id", "content_score", "page_score", "score", "keep"],
            )

    schema = "doc_id bigint, content_score double, page_score double, score double, keep boolean"
    return common.map_arrow(docs, ["doc_id", "text", "source", "lang"], run, schema)


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that the classifier keeps, with all their columns; nulls, repeated rows and ties as above.

    A score that equals the threshold is kept.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, limit=_SLICE):
            yield batch.filter(pa.array(_judge(model.value, batch)[2] >= threshold))

    return docs.mapInArrow(keep, docs.schema)
