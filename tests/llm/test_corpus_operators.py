"""Operators over all texts together, against brute force."""

import math
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from logwarden.llm import common, components, katz, quality, simhash, suffixes

from .conftest import prose
from .test_text_operators import quality_table

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_Z))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[k : k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for k, a in enumerate(nodes):
        for b in nodes[k + 1 :]:
            if linked(a, b):
                a_root, b_root = sorted((find(a), find(b)))
                root[b_root] = a_root
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("limit", [simhash.BUCKET_LIMIT, 1])
def test_simhash_classes_equal_brute_force(docs, limit):
    rows = docs.collect()
    fps = {r.text: fingerprint(r.text) for r in rows}
    roots = classes(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for r in rows:
        root = roots[fps[r.text]]
        least[root] = min((x for x in (least.get(root), r.doc_id) if x is not None), default=None)
    expected = sorted(((str(r.doc_id), fps[r.text], least[roots[fps[r.text]]]) for r in rows), key=str)
    found = simhash.near_duplicates(docs, bucket_limit=limit).collect()
    assert sorted(((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in found), key=str) == expected


def test_simhash_links_of_random_fingerprints(spark):
    rng, values = random.Random(4), []
    for _ in range(60):
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            values.append(value)
            for _ in range(rng.randint(1, 5)):
                value ^= 1 << rng.randrange(64)
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    expected = classes(values, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 4)
    table = spark.createDataFrame([(v,) for v in values], "fp bigint")
    for limit in (simhash.BUCKET_LIMIT, 2):
        links = simhash.links(table, bucket_limit=limit)
        assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 4 for r in links.collect())
        found = {r.node: r.root for r in components.components(links).collect()}
        assert {v: found.get(v, v) for v in values} == expected


def test_large_buckets_stay_connected():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, dtype=np.uint64)
    fps = np.unique(np.array([base ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, 2, replace=False))) for _ in range(300)], np.uint64))
    a, b = simhash.linked(np.zeros(len(fps), np.int64), fps, np.ones(len(fps), bool), 4)
    assert len(a) == len(fps) - 1 and (np.bitwise_count(a ^ b) <= 4).all()


def test_thresholds_cover_the_distance():
    sample = np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64)
    for total in (1000, 10**6, 10**9):
        plan = simhash.allocate(sample, total)
        bits = [b for group, _ in plan for b in group]
        assert len(bits) == len(set(bits)) and plan
        # Differences spread in the worst way still fall within the threshold of one partition.
        assert sum(t + 1 for _, t in plan) > simhash.DISTANCE


def test_one_of_each_group_stays(docs, no_docs):
    kept, found = simhash.one_of_each(docs), simhash.near_duplicates(docs).collect()
    assert kept.schema == docs.schema
    assert kept.count() == len({r.component_id for r in found})
    assert {r.doc_id for r in kept.collect()} == {r.component_id for r in found}
    assert simhash.one_of_each(no_docs).count() == 0 and simhash.near_duplicates(no_docs).count() == 0


def test_components_of_chains_and_loops(spark):
    edges = [(k + 1, k) for k in range(40)] + [(100, 100), (7, 200), (200, 7), (300, 301)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 200: 0, 300: 300, 301: 300}


def kept_bytes(rows):
    """Per row what stays, rows of one doc_id being one document."""
    first, out = {}, []
    for doc_id, text in rows:
        for k in range(len(text) - 49):
            if doc_id is not None:
                first[text[k : k + 50]] = min(first.get(text[k : k + 50], doc_id), doc_id)
    for doc_id, text in rows:
        gone = set()
        for k in range(len(text) - 49):
            if doc_id is not None and first[text[k : k + 50]] < doc_id:
                gone |= set(range(k, k + 50))
        out.append((str(doc_id), bytes(b for k, b in enumerate(text) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize(("shard_bytes", "sample"), [(suffixes.SHARD_BYTES, 2000), (2000, 2000), (2000, 1)])
def test_repeated_strings_equal_brute_force(docs, no_docs, shard_bytes, sample):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    found = suffixes.deduplicated(docs, shard_bytes=shard_bytes, sample=sample).collect()
    assert sorted((str(r.doc_id), bytes(r.kept)) for r in found) == kept_bytes(rows)
    for r in found:
        ends = [x for s in r.spans for x in (s.a, s.b)]
        assert ends == sorted(set(ends)) and len(r.kept) == len((r.text or "").encode()) - sum(s.b - s.a for s in r.spans)
    assert suffixes.deduplicated(no_docs).count() == 0


@pytest.mark.parametrize("limit", [1 << 20, 2000, 500])
def test_suffix_arrays_merge(limit):
    rng = np.random.default_rng(7)
    texts = [bytes(rng.integers(97, 99, int(n), dtype=np.uint8)) + b"abcabc" * 15 + bytes(rng.integers(0, 256, 60, dtype=np.uint8)) for n in rng.integers(0, 60, 30)]
    texts = texts * 2 + [b"\0" * 200, b"\0" * 120 + b"x" * 60, texts[0][5:70]]
    owner = rng.permutation(len(texts))
    least = {}
    for text, o in zip(texts, owner, strict=True):
        for k in range(len(text) - 49):
            least[text[k : k + 50]] = min(least.get(text[k : k + 50], 10**9), o)
    size = np.array([len(t) for t in texts])
    found = suffixes.smallest_owner(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size, size, owner, 50, limit)
    assert found.tolist() == [least[t[k : k + 50]] for t in texts for k in range(len(t) - 49)]


@pytest.mark.parametrize("limit", [1 << 20, 3000, 500])
def test_suffix_arrays_merge_only_along_a_key(limit, monkeypatch):
    rng = np.random.default_rng(11)
    runs = []
    for key in (3, 4, 4, 9, 2**63, 2**64 - 1):
        middle = bytes(rng.integers(97, 123, 50, dtype=np.uint8))
        for _ in range(60 if key == 9 else 5):  # key 9 has more bytes than the smaller arrays hold
            left, right = (bytes(rng.integers(97, 99, int(n), dtype=np.uint8)) for n in rng.integers(0, 150, 2))
            runs.append((key, left + middle + right))
    key, texts = np.array([k for k, _ in runs], np.uint64), [t for _, t in runs]
    owner = rng.permutation(len(texts))
    least = {}
    for (k, text), o in zip(runs, owner, strict=True):
        for at in range(len(text) - 49):
            least[k, text[at : at + 50]] = min(least.get((k, text[at : at + 50]), 10**9), o)
    size, searches, find = np.array([len(t) for t in texts]), [], suffixes.SuffixArray.find
    monkeypatch.setattr(suffixes.SuffixArray, "find", lambda self, words: searches.append(1) or find(self, words))
    found = suffixes.smallest_owner(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size, size, owner, 50, limit, key)
    assert found.tolist() == [least[k, t[at : at + 50]] for k, t in runs for at in range(len(t) - 49)]
    arrays = int(size[key == 9].sum()) // limit + 2
    assert len(searches) <= arrays * (arrays - 1) // 2


def test_suffix_array_looks_along_bounded_lanes():
    """A run of many starts costs no more steps than LANE, and equal strings stand in the order of their places."""
    text = np.frombuffer(b"abcdefg" * 3000 + bytes(range(200)), np.uint8)
    array = suffixes.SuffixArray(text, np.array([0]), np.array([len(text)]), 50)
    for group in np.split(array.order, array.head[1:]):
        strings = {bytes(text[k : k + 50]) for k in group.tolist()}
        assert len(strings) == 1 and (np.diff(group) > 0).all()
    assert len(array.head) == len({bytes(text[k : k + 50]) for k in range(len(text) - 49)})


def brute_katz(rows):
    tokens = [(i, [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(A_Z)), None]) for i, t in rows]
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i, _ in rows]
    one, two = Counter(), Counter()
    for (_, w), h in zip(tokens, held, strict=True):
        if not h:
            one.update(w)
            two.update(zip(["<begin>", *w], w, strict=False))
    n, v = sum(one.values()), len(one)
    f1, f2 = katz.discounts(Counter(one.values()), 1), katz.discounts(Counter(two.values()), katz.LEAST_PAIR)
    part = lambda c, f: c * (f[c] if c <= katz.DISCOUNTED else 1)
    used = sum(part(c, f1) for c in one.values())
    total = n if used < n else n + 1
    uni = lambda w: part(one[w], f1) / total if w in one else 1 - used / total
    kept, alpha, whole = {}, {}, {}
    for (h, w), c in two.items():
        if c >= katz.LEAST_PAIR:
            kept.setdefault(h, {})[w] = c
    for h, after in kept.items():
        count, mass = one[None] if h == "<begin>" else one[h], sum(part(c, f2) for c in after.values())
        whole[h] = count if mass < count - 1e-9 else count + 1
        alpha[h] = (1 - mass / whole[h]) / (1 - sum(map(uni, after)))

    def p(h, w):
        return part(kept[h][w], f2) / whole[h] if w in kept.get(h, ()) else alpha.get(h, 1.0) * uni(w)

    for h in [*kept, "<unknown>"]:
        assert abs(sum(p(h, w) for w in one) + p(h, "<unseen>") - 1) < 1e-9
    out = []
    for (i, w), h in zip(tokens, held, strict=True):
        base = sum(math.log10((one[x] + 1) / (n + 1 * (v + 1))) for x in w)
        score = sum(math.log10(p(a, b)) for a, b in zip(["<begin>", *w], w, strict=False))
        out.append((str(i), h, len(w), sum(x in one for x in w), n, round(base, 6), round(score, 6)))
    return sorted(out)


@pytest.mark.parametrize(("frequent", "shard_text"), [(katz.FREQUENT_WORDS, katz.SHARD_TEXT), (5, 3000)])
def test_katz_equals_brute_force(docs, no_docs, frequent, shard_text):
    found = katz.score_documents(docs, frequent, shard_text=shard_text).collect()
    mine = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found)
    expected = brute_katz([(r.doc_id, r.text) for r in docs.collect()])
    assert [r[:5] for r in mine] == [r[:5] for r in expected]
    assert all(abs(a - b) < 1e-5 for x, y in zip(mine, expected, strict=True) for a, b in zip(x[5:], y[5:], strict=True))
    assert katz.score_documents(no_docs).count() == 0


def test_katz_keeps_pairs_seen_once(spark):
    # Every count is one, so nothing is discounted and a pair has half of what follows its first word.
    docs = spark.createDataFrame([(2, "x y z")], "doc_id bigint, text string")
    (row,) = katz.score_documents(docs).collect()
    assert not row.held_out
    assert abs(row.score - 4 * math.log10(1 / 2)) < 1e-9


def test_pipeline_stages_equal_brute_force(spark, tmp_path):
    table, labels, truth = quality_table(spark, 200)
    extra = [(500, prose(11, 60)), (501, prose(11, 60)), (502, prose(12, 50)), (503, "mail Jo.Doe@mail.example.com " + prose(13, 30)), (504, None), (505, "")]
    more = spark.createDataFrame([(i, t, "en", "s1", len(t or "")) for i, t in extra], table.schema)
    docs = table.union(more)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(12, 50))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    states = [docs]
    for _, stage in corpus_pipeline.STAGES:
        states.append(stage(spark, states[-1], str(tmp_path)).persist())
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in states]
    assert all(s.columns == docs.columns for s in states[:-1])
    assert ids[1] == {r.doc_id for r in quality.score_documents(docs, labels).where("keep").collect()}
    assert {502, 503, 504, 505} <= ids[1]
    assert ids[2] == {r.component_id for r in simhash.near_duplicates(states[1]).collect()} and 501 not in ids[2] and 500 in ids[2]
    assert ids[3] == ids[2] - {502}
    masked = {r.doc_id: r.text for r in states[4].collect()}
    assert masked[503].startswith("mail [EMAIL] ") and ids[4] == ids[3]
    assert all(r.n_tokens == len(r.ids) and r.round_trip for r in states[5].collect()) and ids[5] == ids[4]
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in whole) == sorted((r.doc_id, r.n_tokens) for r in states[5].collect())
    for s in states[1:]:
        s.unpersist()


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_packed_arrays_come_back():
    arrays = [np.arange(6, dtype="<i8"), np.arange(6, dtype="<i4").reshape(2, 3), np.empty(0), np.array([True, False])]
    kinds = ("<i8", "<i4", "<f8", "?")
    for before, after in zip(arrays, common.unpack(*common.pack(arrays), kinds), strict=True):
        assert before.ravel().tolist() == after.tolist() and before.dtype == after.dtype


def test_shared_contexts_are_one_row_per_shard_and_part():
    line = "a line of some length that several documents have, word for word, " * 3
    texts = [f"{line} {k} of its own {'x' * k}" for k in range(40)]
    tables = [
        pa.table({"doc_id": ids, "tag": pa.array([0] * 20, pa.int32()), "text": [texts[k] for k in ids], "part": pa.array([part] * 20, pa.int32())})
        for part, ids in enumerate((list(range(20)), list(range(20, 40))))
    ]
    keys = [b for t in tables for b in suffixes._keys(3, np.empty(0, np.uint64), 50)(t).to_batches()]
    shared = pa.Table.from_batches(suffixes._shared(iter(keys)))
    assert shared.num_rows <= 3 * 2 and set(shared["part"].to_pylist()) == {0, 1}


@pytest.mark.parametrize("crowd", [0, 100])
def test_words_are_found_without_a_binary_search_for_each(crowd, monkeypatch):
    """Even where more words than steps share their upper bits."""
    rng = np.random.default_rng(3)
    same = (np.uint64(77) << np.uint64(64 - katz._INDEX_BITS)) + np.arange(1, crowd + 1, dtype=np.uint64) * np.uint64(5)
    hashes = np.unique(np.concatenate((rng.integers(0, 2**64, 5000, dtype=np.uint64), same, [katz.BEGIN, np.uint64(0), np.uint64(2**64 - 1)])))
    words = katz.Words(hashes, np.ones(len(hashes)), {})
    asked = np.concatenate((hashes, hashes + np.uint64(1), rng.integers(0, 2**64, 5000, dtype=np.uint64)))
    place = {h: k for k, h in enumerate(hashes.tolist())}
    expected = [place.get(x, -1) for x in asked.tolist()]
    assert words.find(asked[:0]).tolist() == [] and words.find(asked).tolist() == expected
    searched, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *rest: searched.append(len(v)) or search(a, v, *rest))
    assert words.find(asked).tolist() == expected
    assert sum(searched) <= 2 * crowd


def test_words_before_are_numbered_once():
    texts = [b"one two", b"", b"two Two one", b"other"]
    w, h, _ = katz.words_of(texts)
    for some in (np.unique(np.append(w, katz.BEGIN)), np.unique(np.append(w[::2], katz.BEGIN)), np.array([katz.BEGIN])):
        known = katz.Words(some, np.ones(len(some)), {})
        assert [x.tolist() for x in known.find_both(h, w)] == [known.find(h).tolist(), known.find(w).tolist()]


def test_sums_of_pairs_are_one_row_per_shard_and_blob():
    texts = [f"one two three {k} four five {k % 7}".encode() for k in range(50)]
    w, h, owner = katz.words_of(texts)
    words = np.unique(np.concatenate((w, h)))
    known = katz.Words(words, np.ones(len(words)), {c: np.zeros(len(words)) for c in ("probability", "weight", "both")})
    rows, train = np.arange(100, 150), np.ones(50, bool)
    blobs = [pa.Table.from_batches([katz._mixed_blob(*x)]) for x in katz._dealt(h, w, owner, known, 4, rows, train)]
    step = katz._evaluate_pairs(SimpleNamespace(value=known), {"n": 1, "v": 1, "unseen": 0.5}, np.ones(katz.DISCOUNTED + 1), 1)
    sums = list(step(b for t in blobs for b in t.to_batches()))
    assert sum(b.num_rows for b in sums) <= 4
    added = pa.Table.from_batches(katz._add_sums(iter(sums)))
    assert added.num_rows == 50 and sorted(added["row"].to_pylist()) == rows.tolist()
    of_pair = Counter(zip(h.tolist(), w.tolist(), strict=True))
    expected = [sum(math.log10(of_pair[p]) for p in zip(h[owner == k].tolist(), w[owner == k].tolist(), strict=True)) for k in range(50)]
    got = dict(zip(added["row"].to_pylist(), added["score"].to_pylist(), strict=True))
    assert [got[100 + k] for k in range(50)] == pytest.approx(expected)
