"""Removal of repeated 50-byte strings, by suffix arrays.

Every 50-byte string is dealt to a shard by its minimiser, the smallest hash among its 16-byte
substrings, which depends on the string alone; neighbouring strings with one minimiser travel as
one run of bytes.  So all places of a string meet in one shard.  Only runs with a context (a
minimiser and half of the rest of a string) that several documents have are dealt.  A shard builds
suffix arrays of the distinct runs, in the order of their minimisers (Larsson-Sadakane refinement),
finds equal strings by Kasai's common prefixes, and merges arrays that share a minimiser by binary
search.  The smallest doc_id of each string decides what is removed from which document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm import common

LENGTH = 50
_MINIMISER = 16
#: Bytes of text for a shard of runs (of which most are dropped before), and of distinct runs in one suffix array.
SHARD_BYTES, ARRAY_BYTES = 5 << 20, 1 << 20
#: Bytes of text for a part of the texts, for a partition of parts, and for a shard of contexts.
PART_BYTES, TEXT_BYTES, KEY_BYTES = 3 << 20, 12 << 20, 24 << 20
#: Starts of strings that are looked up at a time.
STARTS = 1 << 18
#: Starts along which Kasai's common prefixes are handed on; longer runs begin anew.
LANE = 64
#: Documents in which frequent minimisers are looked for, and the share of them that makes one frequent.
SAMPLE, FREQUENT = 2000, 0.02
#: Shards among which the documents of a frequent minimiser are dealt.
SPREAD = 16


def rolling_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes (a power of two) from each position on."""
    out, width = data.astype(np.uint64) + np.uint64(1), 1
    with np.errstate(over="ignore"):
        while width < size:
            out = out[:-width] * np.uint64(pow(0x9E3779B97F4A7C15, width, 1 << 64)) + out[width:]
            width *= 2
    return common.mix(out)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    out, done = values, 1
    while 2 * done <= width:
        out, done = np.minimum(out[:-done], out[done:]), 2 * done
    return np.minimum(out[: len(out) - (width - done)], out[width - done :]) if done < width else out


def hashed(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the short substrings, and the smallest in the string from each position on."""
    if len(data) < length:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    hashes = rolling_hashes(data, _MINIMISER)
    return hashes, sliding_minimum(hashes, length - _MINIMISER + 1)


def runs(least: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, text, first start and number of starts of each run of neighbouring strings."""
    if not len(least):
        empty = np.empty(0, np.int64)
        return least, empty, empty, empty
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))[: len(least)]
    inside = np.arange(len(least)) + length < begins[owner + 1]  # a NUL ends each text
    head = inside.copy()
    head[1:] &= ~inside[:-1] | (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(head)
    stop = np.searchsorted(np.flatnonzero(inside), np.append(start[1:], len(least)))
    count = np.diff(np.concatenate((np.searchsorted(np.flatnonzero(inside), start[:1]), stop)))
    return least[start], owner[start], start - begins[owner[start]], count


def contexts(hashes: np.ndarray, least: np.ndarray, key: np.ndarray, start: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs, and hashes of a minimiser with half of what a string may have beside it, to the left or to the right.

    A string holds one of the two whole, wherever its minimiser stands.  So runs of two documents
    have a string in common only if they have one of these hashes in common.
    """
    width, half = length - _MINIMISER + 1, (length - _MINIMISER) // 2
    if not len(key):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    edge = np.zeros(width - 1, np.uint64)
    # The minimum of the complements is the complement of the maximum.
    minimisers = np.flatnonzero(~sliding_minimum(~np.concatenate((edge, least, edge)), width) == hashes)
    low = np.searchsorted(minimisers, start)
    many = np.searchsorted(minimisers, start + count + width - 1) - low
    run, at = np.repeat(np.arange(len(key)), many), gathered(minimisers, low, many)
    own = hashes[at] == key[run]
    run, at = run[own], at[own]
    left, right = at - half >= start[run], at + _MINIMISER + half <= start[run] + count[run] + length - 1
    found = []
    with np.errstate(over="ignore"):
        for side, steps in ((left, [0, *range(-half, 0, _MINIMISER)]), (right, [0, *range(half, 0, -_MINIMISER)])):
            mixed = np.full(int(side.sum()), 1 + (side is right), np.uint64)
            for step in steps:
                mixed = common.mix(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[at[side] + step])
            found.append(mixed)
    return np.concatenate((run[left], run[right])), np.concatenate(found)


def gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The given pieces of data, one after another."""
    offset = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return data[np.repeat(start, size) + offset]


#: Of a place of a context in a shard: lower half of the context; number of the run in its part and of its text,
#: as differences.  The shard is taken from the upper half, so by chance contexts agree as rarely on any input size.
_KEY_KINDS = ("<u4", "<u4", "<u4")
#: Of a run in a shard: half of the minimiser, size in bytes, smallest doc_id and how much larger the largest is; its
#: bytes; of a place of a run: number of the run, doc_id above its smallest, number of the text in its part, first start.
_KINDS = ("<u4", "<i4", "<i8", "<i8", "u1", "<i4", "<i8", "<i4", "<i4")
#: Of a removed piece: number of the text in its part, begin and end.
_PIECE_KINDS = ("<i4", "<i4", "<i4")
_BLOB = "shard int, part int, blob binary, size bigint"
_HALF = np.uint64(32)


def _blobs(found: list[tuple[int, int, bytes, int]]) -> pa.Table:
    shard, part, blob, size = zip(*found, strict=True) if found else ((), (), (), ())
    arrays = [pa.array(shard, pa.int32()), pa.array(part, pa.int32()), pa.array(blob, pa.binary()), pa.array(size, pa.int64())]
    return pa.Table.from_arrays(arrays, ["shard", "part", "blob", "size"])


def _stretches(values: np.ndarray) -> list[tuple[int, int, int]]:
    """Each distinct of the sorted values, where it begins and where it ends."""
    found, first = np.unique(values, return_index=True)
    return list(zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(values)][: len(found)], strict=True))


def _batches(table: pa.Table) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a part in one order wherever it is read, in slices, and how many came before each."""
    order = [("doc_id", "ascending"), ("tag", "ascending"), ("text", "ascending")]
    before = 0
    for batch in common.slices(iter(table.sort_by(order).combine_chunks().to_batches())):
        yield before, batch
        before += batch.num_rows


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, joined bytes and where each text begins; a text without a doc_id counts as empty."""
    ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
    none = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
    texts = [b"" if skip else text for text, skip in zip(common.text_bytes(batch.column("text")), none, strict=True)]
    return ids, *common.joined(texts)


def _keys(shards: int, frequent: np.ndarray, length: int) -> object:
    """Contexts of a part by shard; frequent ones are known to have several documents and stay."""

    def run(table: pa.Table) -> pa.Table:
        part, found, runs_before = table.column("part")[0].as_py(), [], 0
        for before, batch in _batches(table):
            _, data, begins = _texts(batch)
            hashes, least = hashed(data, length)
            key, owner, first, count = runs(least, begins, length)
            of, context = contexts(hashes, least, key, begins[owner] + first, count, length)
            rare = ~np.isin(context, frequent)
            of, context = of[rare], context[rare]
            shard = (context >> _HALF) % np.uint64(shards)
            order = np.argsort(shard << _HALF | of.astype(np.uint64))
            of, context, shard = of[order], context[order], shard[order]
            for k, a, b in _stretches(shard):
                columns = [of[a:b] + runs_before, owner[of[a:b]] + before]
                found.append((k, part, *common.pack([context[a:b].astype(np.uint32), *(np.diff(c, prepend=0).astype(np.uint32) for c in columns)])))
            runs_before += len(key)
        return _blobs(found)

    return run


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes, int]]]:
    shards: dict[int, list[tuple[int, bytes, int]]] = {}
    for batch in batches:
        for shard, *rest in zip(*(batch.column(c).to_pylist() for c in ("shard", "part", "blob", "size")), strict=True):
            shards.setdefault(shard, []).append(tuple(rest))
    while shards:
        yield shards.popitem()[1]


def _several(key: np.ndarray, place: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places whose key several texts have."""
    if not len(key):
        return place
    ranked = key.astype(np.uint64) << _HALF | np.arange(len(key), dtype=np.uint64)
    ranked.sort()
    order = (ranked & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text, ranked = text[order], ranked >> _HALF
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    head = np.flatnonzero(new)
    several = np.logical_or.reduceat(np.concatenate(([False], text[1:] != text[:-1])) & ~new, head)
    return place[order[np.repeat(several, np.diff(np.append(head, len(order))))]]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part the numbers of runs with a context that several texts have (texts of one doc_id count as several here)."""
    for blobs in _by_shard(batches):
        keys, places, texts = [], [], []
        for part, blob, size in blobs:
            key, number, owner = common.unpack(blob, size, _KEY_KINDS)
            base = np.uint64(part) << _HALF
            keys.append(key)
            places.append(base | np.cumsum(number, dtype=np.uint64))
            texts.append(base | np.cumsum(owner, dtype=np.uint64))
        blobs.clear()
        key, place, text = np.concatenate(keys), np.concatenate(places), np.concatenate(texts)
        del keys, places, texts
        some = []
        for quarter in range(4):  # a sort holds several times what it sorts
            mine = np.flatnonzero(key >> np.uint32(30) == quarter)
            some.append(_several(key[mine], place[mine], text[mine]))
        del key, place, text
        chosen = np.concatenate(some)
        chosen.sort()
        chosen = chosen[np.concatenate(([True], chosen[1:] != chosen[:-1]))[: len(chosen)]]
        found = []
        for part, a, b in _stretches(chosen >> _HALF):
            found.append((0, part, *common.pack([np.diff(chosen[a:b], prepend=np.uint64(part) << _HALF).astype(np.uint32)])))
        yield from _blobs(found).to_batches()


def _unpacked(blobs: pa.Table, kinds: tuple[str, ...]) -> list[list[np.ndarray]]:
    return [common.unpack(blob, size, kinds) for blob, size in zip(blobs.column("blob").to_pylist(), blobs.column("size").to_pylist(), strict=True)]


def _deal(shards: int, frequent: np.ndarray, frequent_contexts: np.ndarray, length: int) -> object:
    """The chosen runs of a part, with their bytes, by shard."""

    def run(table: pa.Table, blobs: pa.Table) -> pa.Table:
        found, runs_before = [], 0
        numbers = np.concatenate([np.empty(0, np.int64), *(np.cumsum(x, dtype=np.int64) for (x,) in _unpacked(blobs, ("<u4",)))])
        part = table.column("part")[0].as_py() if table.num_rows else 0
        for turn, (before, batch) in enumerate(_batches(table)):
            ids, data, begins = _texts(batch)
            hashes, least = hashed(data, length)
            key, owner, first, count = runs(least, begins, length)
            chosen = np.zeros(len(key), bool)
            if len(frequent_contexts):
                of, context = contexts(hashes, least, key, begins[owner] + first, count, length)
                chosen[of[np.isin(context, frequent_contexts)]] = True
            del hashes, least
            chosen[numbers[(numbers >= runs_before) & (numbers < runs_before + len(key))] - runs_before] = True
            runs_before += len(key)
            key, owner, first, count = key[chosen], owner[chosen], first[chosen], count[chosen]
            if not len(key):
                continue
            size = count + length - 1
            body = common.hash_spans(data, begins[owner] + first, begins[owner] + first + size)
            order = np.lexsort((ids[owner], body, key))
            key, owner, first, size, body = (x[order] for x in (key, owner, first, size, body))
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (body[1:] != body[:-1])))
            which, at = np.cumsum(new) - 1, np.flatnonzero(new)
            least, most = ids[owner[at]], ids[owner[np.append(at[1:], len(key)) - 1]]
            shard = (common.mix(key) % np.uint64(shards)).astype(np.int64)
            often = np.isin(key, frequent)
            # A frequent run is known to all shards of its spread; its places go to one of them.
            copies = np.where(often, min(SPREAD, shards), 1)
            place_shard = np.where(often, (shard + (part + turn) % copies) % shards, shard)
            run_copies = copies[at]
            run_of = np.repeat(np.arange(len(at)), run_copies)
            run_shard = (np.repeat(shard[at], run_copies) + np.arange(len(run_of)) - np.repeat(np.cumsum(run_copies) - run_copies, run_copies)) % shards
            by_run, by_place = np.argsort(run_shard, kind="stable"), np.argsort(place_shard, kind="stable")
            run_of, run_shard, place_shard = run_of[by_run], run_shard[by_run], place_shard[by_place]
            targets = np.unique(run_shard)
            r = np.searchsorted(run_shard, np.append(targets, shards))
            p = np.searchsorted(place_shard, np.append(targets, shards))
            for k, target in enumerate(targets.tolist()):
                mine, places = run_of[r[k] : r[k + 1]], by_place[p[k] : p[k + 1]]
                source = at[mine]
                arrays = [
                    key[source].astype(np.uint32), size[source].astype(np.int32), least[mine], most[mine] - least[mine],
                    gathered(data, begins[owner[source]] + first[source], size[source]),
                    np.searchsorted(mine, which[places]).astype(np.int32), ids[owner[places]] - least[which[places]],
                    (owner[places] + before).astype(np.int32), first[places].astype(np.int32),
                ]
                found.append((target, part, *common.pack(arrays)))
        return _blobs(found)

    return run


def body_hashes(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each piece of data, the pieces in ascending order, some bytes of data at a time."""
    cut = np.flatnonzero(np.diff(begin // ARRAY_BYTES, prepend=-1))
    out = [np.empty(0, np.uint64)]
    for a, b in zip(cut, np.append(cut[1:], len(begin)), strict=True):
        base, ends = begin[a], begin[a:b] + size[a:b]
        out.append(common.hash_spans(data[base : ends[-1]], begin[a:b] - base, ends - base))
    return np.concatenate(out)


class SuffixArray:
    """All strings of `length` bytes of some runs, sorted, equal ones grouped."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray, length: int) -> None:
        padded = np.concatenate((data, np.zeros(length + 16, np.uint8))).astype(np.uint64)
        self.length = length
        self.words = np.zeros(len(data) + length + 8, np.uint64)  # the eight bytes from each position on
        for k in range(8):
            self.words = self.words << np.uint64(8) | padded[k : k + len(self.words)]
        starts = gathered(np.arange(len(data)), begin, size - length + 1)
        self.begin, self.count = begin, size - length + 1
        self.order = self._refined(len(data), starts)
        same = self._common_prefixes() >= length
        self.group = np.cumsum(~same) - 1  # along the order
        self.head = np.flatnonzero(~same)

    def _refined(self, n: int, starts: np.ndarray) -> np.ndarray:
        """Larsson-Sadakane: positions sorted by eight bytes, then groups that are still open by the rank of what follows.

        A pass ranks only the positions that later passes look at, the last one only the starts.
        Equal strings stand in the order of their positions.
        """
        aheads, depth = [], 8
        while depth < self.length:
            aheads.append(min(depth, self.length - depth))
            depth += aheads[-1]
        needed = [np.zeros(n, bool)]
        needed[0][starts] = True
        for ahead in reversed(aheads):
            wider = needed[0].copy()
            wider[ahead:] |= needed[0][:-ahead]
            needed.insert(0, wider)
        order = np.flatnonzero(needed[0]).astype(np.int32)
        ranked = self.words[order]
        by = np.argsort(ranked)
        order, ranked = order[by], ranked[by]
        first = np.ones(len(order), bool)
        first[1:] = ranked[1:] != ranked[:-1]
        del ranked, by
        rank = np.full(n + self.length, -1, np.int32)
        for ahead, mask in zip(aheads, needed[1:], strict=True):
            head = np.maximum.accumulate(np.where(first, np.arange(len(order), dtype=np.int32), 0))
            rank[order] = head
            kept = mask[order]
            order, head = order[kept], head[kept]
            first = np.ones(len(order), bool)
            first[1:] = head[1:] != head[:-1]
            open_slots = np.flatnonzero(~(first & np.append(first[1:], True)))
            members = order[open_slots]
            key = head[open_slots].astype(np.uint64) << np.uint64(32) | (rank[members + ahead] + 1).astype(np.uint64)
            by = np.argsort(key)
            key = key[by]
            order[open_slots] = members[by]
            if len(key):
                first[open_slots] = np.concatenate(([True], key[1:] != key[:-1]))
        return np.sort((np.cumsum(first, dtype=np.int64) << 32) | order) & 0xFFFFFFFF

    def _common_prefixes(self) -> np.ndarray:
        """Kasai: of each string with the one before it, from the longest known for the string one byte to the left."""
        n = len(self.order)
        out, rank = np.zeros(n, np.int32), np.full(len(self.words) + 1, -1, np.int32)
        rank[self.order] = np.arange(n, dtype=np.int32)
        pieces = -(-self.count // LANE)
        turn = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, count = np.repeat(self.begin, pieces) + turn * LANE, np.minimum(np.repeat(self.count, pieces) - turn * LANE, LANE)
        by_count = np.argsort(-count, kind="stable")
        begin, count = begin[by_count], count[by_count]
        known, left_before = np.zeros(len(begin), np.int32), np.full(len(begin), -1)
        for step in range(int(count.max(initial=0))):
            lanes = int(np.searchsorted(-count, -step, "left"))  # runs with more starts than step
            at = begin[:lanes] + step
            mine = rank[at]
            other = np.where(mine > 0, self.order[mine - 1], -1)
            shifted = rank[left_before[:lanes] + 1]
            sound = (left_before[:lanes] >= 0) & (shifted >= 0) & (shifted < mine)
            size = np.where(sound, np.maximum(known[:lanes] - 1, 0), 0)
            live = np.flatnonzero((other >= 0) & (size < self.length))
            while len(live):
                so_far = size[live]
                differs = self.words[at[live] + so_far] ^ self.words[other[live] + so_far]
                # The highest bit tells how many leading bytes agree; without the bit below it, rounding cannot move it.
                bits = np.frexp((differs & ~(differs >> np.uint64(1))).astype(float))[1]
                so_far += 8 - (bits + 7) // 8
                size[live] = so_far
                live = live[(bits == 0) & (so_far < self.length)]
            size = np.minimum(size, self.length)
            out[mine] = known[:lanes] = size
            left_before[:lanes] = other
        return out

    def find(self, words: list[np.ndarray]) -> np.ndarray:
        """The group equal to each string, given by its eight-byte words at `steps`; -1 if there is none."""
        places = self.order[self.head]
        low, high = np.zeros(len(words[0]), np.int64), np.full(len(words[0]), len(places))
        while (low < high).any():
            middle = (low + high) // 2
            at, less, open_ = places[np.minimum(middle, len(places) - 1)], np.zeros(len(low), bool), np.ones(len(low), bool)
            for step, word in zip(self.steps(), words, strict=True):
                own = self.words[at + step]
                less |= open_ & (own < word)
                open_ &= own == word
            live = low < high
            low, high = np.where(live & less, middle + 1, low), np.where(live & ~less, middle, high)
        at, same = places[np.minimum(low, len(places) - 1)], low < len(places)
        for step, word in zip(self.steps(), words, strict=True):
            same &= self.words[at + step] == word
        return np.where(same, low, -1)

    def steps(self) -> list[int]:
        return [*range(0, self.length - 8, 8), self.length - 8]

    def heads(self) -> list[np.ndarray]:
        return [self.words[self.order[self.head] + step] for step in self.steps()]


def smallest_owner(
    data: np.ndarray, begin: np.ndarray, size: np.ndarray, owner: np.ndarray, length: int, limit: int = ARRAY_BYTES, key: np.ndarray | None = None
) -> np.ndarray:
    """For each start of a string in the runs, in order, the smallest owner of a run that has the string.

    Runs with equal strings have equal keys, if keys are given; they are in ascending order then.
    """
    cut = np.flatnonzero(np.diff(begin // limit, prepend=-1))
    if key is not None:  # an array begins with a new key, unless the runs of one key are too many for it
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        long = np.diff(np.append(begin[heads], begin[-1] + size[-1])) > limit
        inside = np.flatnonzero(np.repeat(long, np.diff(np.append(heads, len(key)))))
        cut = np.union1d(heads[np.concatenate(([True], np.diff(begin[heads] // limit) > 0))], np.intersect1d(cut, inside))
    ends = np.append(cut[1:], len(begin))
    # Arrays without a key in common with those before them need not be held beside them.
    apart = np.flatnonzero(key[cut[1:]] != key[cut[1:] - 1]) + 1 if key is not None else np.empty(0, np.int64)
    chains = zip(np.split(cut, apart), np.split(ends, apart), strict=True) if len(cut) else ()
    return np.concatenate([np.empty(0, np.int64), *(x for cuts, stops in chains for x in _merged(data, begin, size, owner, length, cuts, stops))])


def _merged(data: np.ndarray, begin: np.ndarray, size: np.ndarray, owner: np.ndarray, length: int, cuts: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
    """The smallest owners by array, one array for the runs from each cut on, each pair of arrays merged."""
    arrays, least = [], []
    for a, b in zip(cuts, stops, strict=True):
        base, stop = begin[a], begin[b - 1] + size[b - 1]
        array = SuffixArray(data[base:stop], begin[a:b] - base, size[a:b], length)
        of = np.zeros(stop - base, np.int64)
        starts = gathered(np.arange(stop - base), array.begin, array.count)
        of[starts] = np.repeat(owner[a:b], array.count)
        arrays.append((array, starts))
        least.append(np.minimum.reduceat(of[array.order], array.head))
    for i, (one, _) in enumerate(arrays):
        for j in range(i + 1, len(arrays)):
            found = arrays[j][0].find(one.heads())
            here, there = np.flatnonzero(found >= 0), found[found >= 0]
            both = np.minimum(least[i][here], least[j][there])
            least[i][here], least[j][there] = both, both
    out = []
    for (array, starts), value in zip(arrays, least, strict=True):
        at = np.zeros(len(array.words), np.int64)
        at[array.order] = value[array.group]
        out.append(at[starts])
    return out


def _resolve(blobs: list[tuple[int, bytes, int]], length: int) -> pa.Table:
    parts = [common.unpack(blob, size, _KINDS) for _, blob, size in blobs]
    part = np.repeat(np.array([p for p, _, _ in blobs], np.int64), [len(p[5]) for p in parts])
    blobs.clear()
    shift = np.cumsum([0, *(len(p[0]) for p in parts)])
    key, size, least, most, data, run, ids, text, first = (np.concatenate(x) for x in zip(*parts, strict=True))
    run = run + np.repeat(shift[:-1], [len(p[5]) for p in parts])
    del parts
    most, ids = least + most, ids + least[run]
    begin = np.cumsum(size, dtype=np.int64) - size
    # Only minimisers of several documents can belong to a repeated string.
    order = np.argsort(key, kind="stable")
    head = np.flatnonzero(np.concatenate(([True], key[order[1:]] != key[order[:-1]])))
    several = np.minimum.reduceat(least[order], head) < np.maximum.reduceat(most[order], head)
    chosen = np.sort(order[np.repeat(several, np.diff(np.append(head, len(order))))])
    number = np.full(len(key), -1, np.int64)
    if len(chosen):
        body = body_hashes(data, begin[chosen], size[chosen].astype(np.int64))
        by = np.lexsort((least[chosen], body, key[chosen]))
        near_key, near_body = key[chosen][by], body[by]
        new = np.concatenate(([True], (near_key[1:] != near_key[:-1]) | (near_body[1:] != near_body[:-1])))
        number[chosen[by]] = np.cumsum(new) - 1
        sole = chosen[by][new]  # one of each distinct run, with the smallest doc_id
        bytes_of = gathered(data, begin[sole], size[sole].astype(np.int64))
        start = np.cumsum(size[sole], dtype=np.int64) - size[sole]
        del data, body, near_key, near_body
        owner = smallest_owner(bytes_of, start, size[sole].astype(np.int64), least[sole], length, key=key[sole])
        count = size[sole].astype(np.int64) - length + 1
        base = np.cumsum(count) - count
    places = np.flatnonzero(number[run] >= 0)
    found: list[tuple[np.ndarray, ...]] = []
    ends = np.cumsum(count[number[run[places]]]) if len(places) else np.empty(0, np.int64)
    for here in np.split(places, np.flatnonzero(np.diff(ends // STARTS)) + 1) if len(places) else ():
        which = number[run[here]]
        many = count[which]
        inner = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        gone = owner[np.repeat(base[which], many) + inner] < np.repeat(ids[here], many)
        edge = np.zeros(len(gone) + 1, bool)
        edge[np.cumsum(many)] = edge[0] = True
        opens = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate(([False], gone[:-1]))))
        closes = np.flatnonzero(gone & (edge[1:] | ~np.concatenate((gone[1:], [False]))))
        place = here[np.repeat(np.arange(len(here)), many)[opens]]
        found.append((part[place], text[place], first[place] + inner[opens], first[place] + inner[closes] + length))
    if not found:
        return _blobs([])
    columns = [np.concatenate(x) for x in zip(*found, strict=True)]
    order = np.lexsort((columns[2], columns[1], columns[0]))
    of, *columns = (c[order] for c in columns)
    return _blobs([(0, k, *common.pack([c[a:b].astype(np.int32) for c in columns])) for k, a, b in _stretches(of)])


def _match(length: int) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in _by_shard(batches):
            yield from _resolve(blobs, length).to_batches()

    return run


def _tag() -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def _frequent(rows: DataFrame, length: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimisers and contexts of many of the sampled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            data, begins = common.joined(common.text_bytes(batch.column("text")))
            hashes, least = hashed(data, length)
            key, owner, first, count = runs(least, begins, length)
            of, context = contexts(hashes, least, key, begins[owner] + first, count, length)
            for found, text, is_context in ((key, owner, False), (context, owner[of], True)):
                pairs = np.unique(np.stack((found.view(np.int64), text)), axis=1)[0] if len(found) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(np.full(len(pairs), is_context))], ["key", "is_context"])

    some = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("text")
    counted = some.mapInArrow(run, "key bigint, is_context boolean").groupBy("key", "is_context").count()
    found = counted.where(F.col("count") >= max(8, int(FREQUENT * sample))).collect()
    keys, others = ([r.key for r in found if r.is_context == kind] for kind in (False, True))
    return np.array(keys, np.int64).view(np.uint64), np.array(others, np.int64).view(np.uint64)


def _removed(rows: DataFrame, texts: DataFrame, total: int, length: int, shard_bytes: int, sample: int) -> DataFrame:
    """Blobs of removed pieces, which may overlap, by part; from the rows, and the same partitioned by part."""
    frequent, frequent_contexts = _frequent(rows.where("doc_id IS NOT NULL").where(F.octet_length("text") >= length), length, sample)
    key_shards, partitions = max(1, total // KEY_BYTES), total // TEXT_BYTES + 1
    keys = texts.groupBy("part").applyInArrow(_keys(key_shards, frequent_contexts, length), _BLOB).repartition(key_shards, "shard")
    numbers = keys.mapInArrow(_shared, _BLOB).repartition(partitions, "part")
    shards = max(1, total // shard_bytes)
    deal = _deal(shards, frequent, frequent_contexts, length)
    dealt = texts.groupBy("part").cogroup(numbers.groupBy("part")).applyInArrow(deal, _BLOB).repartition(shards, "shard")
    return dealt.mapInArrow(_match(length), _BLOB).repartition(partitions, "part")


_KEPT = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.string()), ("spans", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))), ("kept", pa.binary())]
)


def _kept(table: pa.Table, blobs: pa.Table) -> pa.Table:
    """The texts of a part, the maximal removed runs of each, and what is left."""
    pieces = [np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*_unpacked(blobs, _PIECE_KINDS), strict=True)] or [np.empty(0, np.int64)] * 3
    order = np.lexsort((pieces[1], pieces[0]))
    owner, a, b = (x[order] for x in pieces)
    out = []
    for before, batch in _batches(table):
        texts, spans, kept = common.text_bytes(batch.column("text")), [], []
        cuts = np.searchsorted(owner, np.arange(before, before + len(texts) + 1))
        for k, text in enumerate(texts):
            merged: list[list[int]] = []
            for x, y in zip(a[cuts[k] : cuts[k + 1]].tolist(), b[cuts[k] : cuts[k + 1]].tolist(), strict=True):
                if merged and x <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], y)
                else:
                    merged.append([x, y])
            ends = [0, *(v for span in merged for v in span), len(text)]
            spans.append([{"a": x, "b": y} for x, y in merged])
            kept.append(b"".join(text[x:y] for x, y in zip(ends[::2], ends[1::2], strict=True)))
        arrays = [batch.column("doc_id"), batch.column("text"), pa.array(spans, _KEPT.field("spans").type), pa.array(kept, pa.binary())]
        out.append(pa.RecordBatch.from_arrays(arrays, schema=_KEPT))
    return pa.Table.from_batches(out, _KEPT)


def deduplicated(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text, spans (array of struct a, b: maximal removed runs of bytes) and kept (binary, the bytes left) of each row.

    A byte goes if a string of `length` bytes covers it that also starts in a document with a
    smaller doc_id.  Null and empty texts keep nothing and lose nothing; a row without a doc_id has
    no order and loses nothing, nor do others because of it.  Rows of one doc_id count as one
    document: none loses anything because of another.  Columns other than doc_id and text are not read.

    The texts are dealt to parts once.  Every step works part by part, in one order of the texts, so that runs and
    texts are known by their numbers, and what steps tell each other travels as one blob per shard and part.
    """
    rows = docs.select("doc_id", _tag().alias("tag"), "text")
    total = int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    part = F.pmod(F.xxhash64("doc_id", "tag"), F.lit(total // PART_BYTES + 1)).cast("int")
    texts = rows.withColumn("part", part).repartition(total // TEXT_BYTES + 1, "part")
    found = _removed(rows, texts, total, length, shard_bytes, sample)
    cogrouped = texts.groupBy("part").cogroup(found.groupBy("part"))
    return cogrouped.applyInArrow(_kept, "doc_id bigint, text string, spans array<struct<a:int,b:int>>, kept binary")
