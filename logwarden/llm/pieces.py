"""SentencePiece encoding and decoding as a weighted transducer.

The transducer is the composition of three: the normaliser (dummy prefix, spaces to the meta
symbol), the pieces as a trie whose states remember the last piece, and byte fallback for
characters that no piece has.  In a BPE model the score of a piece is the order of its merge, so
sums of scores don't rank segmentations; the weights stand on pairs instead: a piece follows
another at weight zero if the two, merged as one string, come apart again as just these two, and
at infinite weight otherwise.  A segmentation has finite weight exactly if it is the model's own,
and each prefix of the input has one, so the tropical shortest path needs one state a position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from logwarden.llm import common

META = "▁"
#: Types of pieces in the model file.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_REMEMBERED_WORDS = 150_000
_REMEMBERED_PAIRS = 100_000
_PAIR_SLOTS = 1 << 20
#: Bytes of text encoded together, and rows decoded together.
_SLICE_BYTES = 2 << 20
_BLOCK_WORDS = 8000
_DECODED_ROWS = 500
_NO_IDS = np.empty(0, np.int32)
#: Longest word, in characters, that goes through the composition in a block.
_LONG_WORD = 40


def _packed(ids: tuple[int, ...]) -> bytes:
    return np.array(ids, np.int32).tobytes()


@dataclass
class Transducer:
    """Compiled model: pieces with their merge order, the trie (all beginnings of pieces, -1 where no
    piece ends), and what each piece writes."""

    score: dict[str, float]
    trie: dict[str, int]
    byte_ids: list[int]
    output: list[bytes]
    names: list[str]
    dummy_prefix: bool
    pattern: str
    edge: np.ndarray = None
    piece: np.ndarray = None
    longest: int = 0
    slot_key: np.ndarray = None
    slot_open: np.ndarray = None
    histories: dict[int, tuple[tuple[float, ...], tuple[str, ...], tuple[str, ...]]] = field(default_factory=dict)
    words: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)
    pairs: dict[tuple[int, int], bool] = field(default_factory=dict)

    def history(self, name: str) -> tuple[tuple[float, ...], tuple[str, ...], tuple[str, ...]]:
        """Scores of the merges that make a piece, in order, and its first and last symbol before and after each."""
        symbols, scores = [*name], []
        first, last = [symbols[0]], [symbols[-1]]
        while len(symbols) > 1:
            found = [(self.score.get(x + y), -k) for k, (x, y) in enumerate(zip(symbols, symbols[1:], strict=False))]
            value, at = max((f for f in found if f[0] is not None), default=(None, 0))
            if value is None:
                break
            symbols[-at : 2 - at] = [symbols[-at] + symbols[1 - at]]
            scores.append(value)
            first.append(symbols[0])
            last.append(symbols[-1])
        return tuple(scores), tuple(first), tuple(last)

    def follows(self, left: int, right: int) -> bool:
        """Whether the arc from one piece to the next has finite weight.

        The merges of both pieces run by score, the leftmost of equals first; the weight is
        infinite if a merge across the border comes before what both sides have left.
        """
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        if len(self.pairs) >= _REMEMBERED_PAIRS:
            self.pairs.clear()
        (a, _, last), (b, first, _) = self.histories[left], self.histories[right]
        score, i, j, known = self.score.get, 0, 0, True
        while True:
            across = score(last[i] + first[j])
            if across is not None and (i == len(a) or across > a[i]) and (j == len(b) or across >= b[j]):
                known = False
                break
            if i == len(a) and j == len(b):
                break
            if j == len(b) or (i < len(a) and a[i] >= b[j]):
                i += 1
            else:
                j += 1
        self.pairs[left, right] = known
        return known

    def path(self, word: str) -> tuple[int, ...]:
        """Piece ids on the shortest path through the composition with a normalised word."""
        size, step, follows = len(word), self.trie.get, self.follows
        arcs: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
        for start in range(size):
            for end in range(start + 1, size + 1):
                piece = step(word[start:end])
                if piece is None:
                    break
                if piece >= 0:
                    arcs[end].append((start, piece))
        last, begin = [-1], [0]
        for end in range(1, size + 1):
            for start, piece in arcs[end]:
                if start == 0 or last[start] < 0 or follows(last[start], piece):
                    break
            else:  # no piece has this character: its bytes
                start, piece = end - 1, -1
            last.append(piece)
            begin.append(start)
        out, end = [], size
        while end:
            start = begin[end]
            if last[end] >= 0:
                out.append(last[end])
            else:
                out.extend(self.byte_ids[b] for b in reversed(word[start:end].encode()))
            end = start
        return tuple(reversed(out))

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The trie node after each node and character number; -1 where there is none."""
        key = node.astype(np.int64) << 21 | char
        at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
        return np.where(self.edge[at] == key, at + 1, -1)

    def open_arcs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """`follows` for many pairs; answers are kept in a table of fixed size."""
        key = left.astype(np.int64) << 32 | right
        slot = (common.mix(key.view(np.uint64)) & np.uint64(_PAIR_SLOTS - 1)).astype(np.int64)
        known = self.slot_key[slot] == key
        out = self.slot_open[slot] & known
        if not known.all():
            value, where, back = np.unique(key[~known], return_index=True, return_inverse=True)
            pairs = zip((value >> 32).tolist(), (value & 0xFFFFFFFF).tolist(), strict=True)
            answer = np.fromiter((self.follows(a, b) for a, b in pairs), bool, len(value))
            out[~known] = answer[back]
            at = slot[~known][where]
            self.slot_key[at], self.slot_open[at] = value, answer
        return out

    def paths(self, words: list[str]) -> list[bytes]:
        """`path` of each word, as 32-bit numbers; words of like length go through the composition together."""
        out, sizes = [b""] * len(words), np.fromiter(map(len, words), np.int64, len(words))
        edges = [0, 4, 7, 10, 13, 16, 20, 26, _LONG_WORD]
        for k in np.flatnonzero(sizes > _LONG_WORD).tolist():
            out[k] = _packed(self.path(words[k]))
        for low, high in zip(edges, edges[1:], strict=False):
            chosen = np.flatnonzero((sizes > low) & (sizes <= high))
            for k in range(0, len(chosen), _BLOCK_WORDS):
                part = chosen[k : k + _BLOCK_WORDS]
                for i, ids in zip(part.tolist(), self._block([words[i] for i in part.tolist()], sizes[part], high), strict=True):
                    out[i] = ids
        return out

    def _block(self, words: list[str], sizes: np.ndarray, high: int) -> list[bytes]:
        rows = len(words)
        code = np.frombuffer("".join(w.ljust(high, "\0") for w in words).encode("utf-32-le"), "<u4").reshape(rows, high)
        # Arcs of d + 1 characters: at (start * rows + row) and piece, in the order of start.
        flat, arcs = code.T.ravel().astype(np.int64), []
        at, node = np.arange(rows * high), np.zeros(rows * high, np.int64)
        for d in range(min(self.longest, high)):
            at, node = at[: np.searchsorted(at, (high - d) * rows)], node[: np.searchsorted(at, (high - d) * rows)]
            node = self.step(node, flat[at + d * rows])
            at, node = at[node >= 0], node[node >= 0]
            piece = self.piece[node]
            ends = piece >= 0
            arcs.append((at[ends] % rows, piece[ends], np.searchsorted(at[ends], np.arange(high + 1) * rows)))
        last = np.full((high + 1, rows), -2, np.int32)
        last[0] = -1
        begin = np.zeros((high + 1, rows), np.int64)
        for end in range(1, high + 1):
            for d in range(min(len(arcs), end), 0, -1):
                row, piece, bounds = arcs[d - 1]
                part = slice(bounds[end - d], bounds[end - d + 1])
                row, piece = row[part], piece[part]
                if not len(row):
                    continue
                free = last[end, row] == -2
                row, piece = row[free], piece[free]
                before = last[end - d, row]
                if end > d:
                    fits = before < 0
                    fits[~fits] = self.open_arcs(before[~fits], piece[~fits])
                    row, piece = row[fits], piece[fits]
                last[end, row], begin[end, row] = piece, end - d
            none = last[end] == -2  # no piece has this character: its bytes
            last[end, none], begin[end, none] = -1, end - 1
        ids, position, n = np.full((rows, high), -1, np.int32), sizes.copy(), 0
        line, odd = np.arange(rows), np.zeros(rows, bool)
        while (position > 0).any():
            live = position > 0
            piece = last[position, line]
            odd |= live & (piece < 0)
            n += 1
            ids[:, high - n] = np.where(live, np.maximum(piece, 0), -1)
            position = np.where(live, begin[position, line], 0)
        used = ids >= 0
        raw, stop = ids[used].tobytes(), np.cumsum(4 * used.sum(axis=1)).tolist()
        out = [raw[x:y] for x, y in zip([0, *stop], stop, strict=False)]
        for k in np.flatnonzero(odd).tolist():
            out[k] = _packed(self.path(words[k]))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Piece ids of each text."""
        find, head = re.compile(self.pattern, re.DOTALL).findall, META if self.dummy_prefix else ""
        parts = [find(head + text.replace(" ", META)) if text else [] for text in texts]
        new = set().union(*parts)
        if len(self.words) > _REMEMBERED_WORDS:  # words seen since the last time stay
            self.older, self.words = self.words, {}
        fresh = new.difference(self.words)
        for word in fresh.intersection(self.older):
            self.words[word] = self.older[word]
        fresh = list(fresh.difference(self.older))
        self.words.update(zip(fresh, self.paths(fresh), strict=True))
        ids = self.words.__getitem__
        return [np.frombuffer(b"".join(map(ids, part)), np.int32) for part in parts]


@dataclass
class Decoder:
    """The inverse transducer: what each piece writes."""

    output: list[bytes]
    dummy_prefix: bool

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece ids; bytes that are no UTF-8 become replacement characters."""
        raw = b"".join(map(self.output.__getitem__, ids.tolist()))
        if self.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def compile_model(path: str) -> Transducer:
    """The transducer of a BPE model file with byte fallback (the driver reads it)."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback:
        raise ValueError("a BPE model with byte fallback is needed")
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError("only the identity normaliser with escaped spaces is compiled")
    names = [p.piece for p in model.pieces]
    kinds = [p.type or _NORMAL for p in model.pieces]
    score = {p.piece: p.score for p, kind in zip(model.pieces, kinds, strict=True) if kind == _NORMAL}
    byte_ids = [names.index(f"<0x{b:02X}>") for b in range(256)]
    output = [
        bytes([int(name[3:5], 16)]) if kind == _BYTE
        else b"" if kind == _CONTROL
        else " ⁇ ".encode() if kind == _UNKNOWN
        else name.replace(META, " ").encode()
        for name, kind in zip(names, kinds, strict=True)
    ]
    # Words may be encoded apart where no piece has the meta symbol after another character.
    apart = not any(META in name.lstrip(META) for name in score)
    alone = r"\n|" if not any("\n" in name for name in score) else ""
    others = r"[^▁\n]" if alone else r"[^▁]"
    pattern = rf"{alone}▁*{others}+|▁+" if apart else r".+"
    made = Transducer(score, {}, byte_ids, output, names, rules.add_dummy_prefix, pattern)
    for k, (name, kind) in enumerate(zip(names, kinds, strict=True)):
        # A piece that its own merges don't make is on no path.
        if kind == _NORMAL and (history := made.history(name))[1][-1] == name:
            made.histories[k] = history
            made.trie[name] = k
            for end in range(1, len(name)):
                made.trie.setdefault(name[:end], -1)
    # The same trie as arrays: nodes are numbered by their edge (node above << 21 | character) in sorted order, by depth.
    number, edge, piece, base = {"": 0}, [], [-1], 0
    names_by_depth: dict[int, list[str]] = {}
    for name in made.trie:
        names_by_depth.setdefault(len(name), []).append(name)
    for depth in sorted(names_by_depth):
        level = sorted(names_by_depth[depth], key=lambda x: (number[x[:-1]], x[-1]))
        for name in level:
            base += 1
            number[name] = base
            edge.append(number[name[:-1]] << 21 | ord(name[-1]))
            piece.append(made.trie[name])
    made.edge, made.piece, made.longest = np.array(edge, np.int64), np.array(piece, np.int32), max(names_by_depth)
    made.slot_key, made.slot_open = np.full(_PAIR_SLOTS, -1, np.int64), np.zeros(_PAIR_SLOTS, bool)
    return made


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text and ids (array of int) of each row of `docs`.

    Null and empty texts have no ids.  Repeated rows are encoded one by one; columns other than
    doc_id and text are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(compile_model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, limit=_SLICE_BYTES):
            found = model.value.encode([x or "" for x in batch.column("text").to_pylist()])
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), ids], ["doc_id", "text", "ids"])

    return common.map_arrow(docs, ["doc_id", "text"], run, "doc_id bigint, text string, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The columns of `encoded` and `decoded`, the text of its column `ids`; null ids give an empty text."""
    made = compile_model(path)
    shared = encoded.sparkSession.sparkContext.broadcast(Decoder(made.output, made.dummy_prefix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, _DECODED_ROWS):
                batch = whole.slice(k, _DECODED_ROWS)
                ids = [row.values.to_numpy(zero_copy_only=False) if row.is_valid else _NO_IDS for row in batch.column("ids")]
                texts = pa.array([shared.value.decode(x) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "decoded"])

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) of each row's whole text, and round_trip: whether decoding them gives the text again.

    The same as `encode` and then `decode`, in one pass of one worker, which holds the model once.
    Null and empty texts have no ids and come back as empty ones; repeated rows and very long texts
    are treated like any others, no rows give none, and other columns are not read.
    """
    made = compile_model(path)
    shared = docs.sparkSession.sparkContext.broadcast((made, Decoder(made.output, made.dummy_prefix)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, decoder = shared.value
        for batch in common.slices(batches, limit=_SLICE_BYTES):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            found = model.encode(texts)
            same = [decoder.decode(ids) == text for ids, text in zip(found, texts, strict=True)]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(same)], ["doc_id", "ids", "round_trip"])

    return common.map_arrow(docs, ["doc_id", "text"], run, "doc_id bigint, ids array<int>, round_trip boolean")
