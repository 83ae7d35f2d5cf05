"""Operators that look at one text at a time, against brute force or the library they must equal."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import groupby
from math import ceil

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logwarden.llm import decontaminate, licenses, phrases, pieces, pii, quality, token_counts

from .conftest import prose

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(A_Z))


def rows_by_text(table, *columns):
    return sorted(((str(r.doc_id), *(r[c] for c in columns)) for r in table.collect()), key=str)


def test_decontamination_equals_brute_force(spark, docs):
    long_item = docs.where("doc_id = 7").first().text
    items = [(1, long_item[:300]), (1, long_item[200:420]), (2, docs.where("doc_id = 14").first().text), (3, "mit license"), (4, ""), (5, None), (None, "x"), (2, "Été")]
    found = decontaminate.judged(decontaminate.find_occurrences(docs, spark.createDataFrame(items, "item_id bigint, text string")))
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(13, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(item)
    expected = []
    for row in docs.collect():
        w, hit, names = words(row.text), set(), set()
        for window, owners in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
                    names |= owners
        items_found = sorted(str(x) for x in names if x is not None)
        expected.append((str(row.doc_id), len(w), len(hit), items_found, len(hit) > 0 and 20 * len(hit) >= len(w)))
    assert rows_by_text(found, "n_words", "n_hit", "items", "contaminated") == sorted(expected, key=str)
    assert any(e[4] for e in expected) and not all(e[4] for e in expected)


def test_decontamination_in_blocks_and_kept_rows(spark, docs, no_docs):
    items = spark.createDataFrame([(k, docs.where("doc_id = 7").first().text[k * 50 : k * 50 + 120]) for k in range(40)], "item_id bigint, text string")
    one, many = (decontaminate.find_occurrences(docs, items, block_bytes=b) for b in (1 << 20, 500))
    assert rows_by_text(one, "hit_spans", "items") == rows_by_text(many, "hit_spans", "items")
    kept = decontaminate.clean_documents(docs, items)
    assert kept.schema == docs.schema and kept.count() == docs.count() - 1
    assert decontaminate.find_occurrences(no_docs, items).count() == 0
    assert decontaminate.clean_documents(docs, items.limit(0)).count() == docs.count()
    in_turn = decontaminate.clean_documents(docs.withColumnRenamed("source", "key"), items, block_bytes=500)
    assert in_turn.columns == [{"source": "key"}.get(c, c) for c in docs.columns]
    assert sorted(map(tuple, in_turn.collect()), key=str) == sorted(map(tuple, kept.collect()), key=str)
    assert decontaminate.find_occurrences(no_docs, items, block_bytes=500).count() == 0


def test_repeated_items_make_one_block(spark):
    items = spark.createDataFrame([(k % 2, prose(3, 40)) for k in range(300)], "item_id bigint, text string")
    n, blocks = decontaminate.pattern_blocks(items, block_bytes=1 << 10)
    assert n == 1 and len(next(blocks)[0].texts) == 28


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 9)), max_size=12))
@settings(max_examples=60, deadline=None)
def test_spans_of_blocks_unite(spans):
    flat = [x for a, size in spans for x in (a, a + size)]
    batch = pa.RecordBatch.from_arrays([pa.array([flat, []], pa.list_(pa.int32()))], ["hit_spans"])
    found, none = next(decontaminate._united(iter([batch]))).column(0).to_pylist()
    covered = {k for a, size in spans for k in range(a, a + size)}
    edges = [k for k in range(41) if (k in covered) != (k - 1 in covered)]
    assert found == edges and none == []


@pytest.mark.parametrize("offset", [0, 31, 70, 100, 149])
def test_license_templates_longer_than_the_least_block(spark, offset):
    long = " ".join(f"term{k}" for k in range(150))
    text = prose(1, offset) + " " + " ".join(f"term{k}" for k in range(0, 150) if k % 8) + " " + prose(2, 400)
    rows = spark.createDataFrame([(1, text), (2, prose(2, 500)), (3, None), (4, text.replace("term1", "other"))], "doc_id bigint, text string")
    found = {r.doc_id: r for r in licenses.scan(rows, (("own", long),)).collect()}
    assert found[1].labels == "own" and found[1].score == pytest.approx(131 / 150)
    assert [found[k].labels for k in (2, 3, 4)] == ["", "", ""]


def test_token_counts_equal_the_library(docs, no_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    found = token_counts.count_tokens(docs, path)
    expected = [(str(r.doc_id), len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()]
    assert rows_by_text(found, "n_bytes", "n_tokens") == sorted(expected, key=str)
    assert token_counts.count_tokens(no_docs, path).count() == 0


@pytest.fixture(scope="module")
def byte_model():
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.load(path), Tokenizer.from_file(path)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=" \t\n'stdremvlo<|endftx>1²é你", max_size=200))
def test_token_counts_of_any_text(byte_model, text):
    mine, library = byte_model
    assert mine.count([text]) == [len(library.encode(text, add_special_tokens=False).ids)]


def test_pieces_equal_the_library_and_decode(docs, no_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    found = pieces.decode(pieces.encode(docs, path), path)
    expected = [(str(r.doc_id), library.encode(r.text or ""), library.decode(library.encode(r.text or ""))) for r in docs.collect()]
    assert rows_by_text(found, "ids", "decoded") == sorted(expected, key=str)
    assert pieces.decode(pieces.encode(no_docs, path), path).count() == 0


@pytest.fixture(scope="module")
def piece_model():
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.compile_model(path), sentencepiece.SentencePieceProcessor(model_file=path)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" ▁\nthesigon'é你🎉019<>_", max_size=80) | st.text(max_size=30))
def test_pieces_of_any_text(piece_model, text):
    mine, library = piece_model
    assert mine.encode([text])[0].tolist() == library.encode(text)


def base_spans(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(digits) <= 19 and sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits[::-1])) % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="0123456789 .-@+()ab%_\né", max_size=90))
def test_base_spans_of_any_text(text):
    assert pii.base_spans(text) == base_spans(text)


def test_personal_data(spark, docs, no_docs):
    found = {(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.find_spans(docs).collect()}
    expected = set()
    for r in docs.collect():
        spans = base_spans(r.text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected.add((r.doc_id, *(sum(s[0] == k for s in spans) for k in pii.KINDS), hashlib.sha256(joined.encode()).hexdigest()))
    assert found == expected
    masked = {r.hits: r for r in pii.masked_documents(docs).collect()}
    assert pii.masked_documents(docs).schema == docs.schema
    assert masked[9].text == "Call [PHONE] or mail [EMAIL] from [IP], card [CARD]." and masked[9].n_chars == len(masked[9].text)
    assert pii.find_spans(no_docs).count() == 0 and pii.masked_documents(no_docs).count() == 0


def test_the_field_finds_what_patterns_miss():
    rng = random.Random(5)
    texts = []
    for k in range(120):
        digits = "".join(str(rng.randrange(10)) for _ in range(10))
        texts += [f"reach us at +1 ({digits[:3]}) {digits[3:6]}-{digits[6:]} today", f"mail a{k}.b@host{k % 7}.example.com now", f"order {digits[:5]} was late", f"at {k}.{k}.7.9 there"]
    field = pii.train(texts)
    assert pii.find("please ring (212) 555-0187 soon", field)[1] == [("phone", 12, 26)]
    assert pii.find("write to jo.doe [at] mail.example.com soon", field)[1] == [("email", 9, 37)]
    assert pii.find("about 12345 people in 1999", field)[1] == []
    same = 0
    for text in texts:
        stretch = pii.candidates(text, 0, len(text))
        alone = [(pii.KINDS[k], stretch.borders[i], stretch.borders[j]) for i, j, k in field.best(stretch)]
        same += alone == pii.base_spans(text)
        assert set(pii.base_spans(text)) <= set(pii.find(text, field)[1])
    assert same >= 0.95 * len(texts)


def test_the_likelihood_has_the_right_slope():
    text = "a +1 (212) 555-0187 b x@y.example.com"
    stretch = pii.candidates(text, 0, len(text))
    truth, field, rng = pii._truth(text, stretch), pii.Field(), np.random.default_rng(1)
    field.weights, field.adjacent = rng.normal(size=field.weights.shape) / 4, 0.3
    _, slope, near = field.gradient(stretch, truth)
    for at in ((0, 0), (1, 3), (18, 0), (29, 2)):
        low, high = (pii.Field(), pii.Field())
        for other, step in ((low, -1e-5), (high, 1e-5)):
            other.weights, other.adjacent = field.weights.copy(), field.adjacent
            other.weights[at] += step
        assert abs((high.gradient(stretch, truth)[0] - low.gradient(stretch, truth)[0]) / 2e-5 - slope[at]) < 1e-4
    high = pii.Field()
    high.weights, high.adjacent = field.weights, field.adjacent + 1e-5
    assert abs((high.gradient(stretch, truth)[0] - field.gradient(stretch, truth)[0]) / 1e-5 - near) < 1e-3


def test_license_scan_equals_brute_force(docs, no_docs):
    sets = [(label, set(words(text))) for label, text in licenses.TEMPLATES]
    expected = []
    for r in docs.collect():
        w, places, base, more, best = words(r.text), [], set(), set(), 0.0
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            at = [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
            places += at
            base |= {label} if at else set()
        for start in range(0, max(len(w), 1), licenses.STRIDE):
            block = set(w[start : start + licenses.BLOCK])
            for label, members in sets:
                if len(block & members) >= ceil(licenses.CONTAINMENT * len(members)):
                    more.add(label)
                    best = max(best, len(block & members) / len(members))
        expected.append((str(r.doc_id), len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if places else best))
    found = rows_by_text(licenses.scan(docs), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert found == sorted(expected, key=str)
    assert licenses.scan(no_docs).count() == 0
    matches = {(r.doc_id, r.label) for r in licenses.template_matches(docs).collect()}
    assert {(10, "mit"), (11, "cc-by-nc")} <= matches


def test_equal_substrings_have_equal_inner_phrases():
    rng = random.Random(2)
    shared = "".join(rng.choice("abcde fgh") for _ in range(4000))
    for left in ("", "zz top", "q" * 37):
        text = left + shared + "tail" * 9
        one, two = (phrases._fingerprints([x], 10**6, 1)[0] for x in (shared, text))
        assert len(np.intersect1d(one, two)) > 0.9 * len(one)
    assert phrases.likeness(*phrases.fingerprints([shared, shared])) == 1.0
    assert phrases.likeness(*phrases.fingerprints(["", ""])) == 1.0
    assert phrases.likeness(*phrases.fingerprints([shared, "".join(rng.sample(shared, len(shared)))])) < 0.1


@pytest.mark.parametrize("bucket_rows", [2, 7, 4000])
def test_phrases_compare_with_the_next_document(docs, no_docs, bucket_rows):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect() if r.doc_id is not None))
    alone = [r.text or "" for r in docs.collect() if r.doc_id is None]
    pairs = [(i, t, rows[(k + 1) % len(rows)][1]) for k, (i, t) in enumerate(rows)] + [(None, t, rows[0][1]) for t in alone]
    expected = []
    for i, text, after in pairs:
        take = len(text) // 4
        edited = text[: len(text) - take] + after[:take]
        a, b, n = phrases.fingerprints([text, edited, after])
        expected.append((str(i), len(text), hashlib.sha256(edited.encode()).hexdigest(), *phrases._shown([a, b]), phrases.likeness(a, b), phrases.likeness(a, n)))
    found = phrases.compare_with_next(docs, bucket_rows)
    assert rows_by_text(found, *found.columns[1:]) == sorted(expected, key=str)
    assert phrases.compare_with_next(no_docs).count() == 0


def parsed(text):
    """Names of each level by plain integers, one text at a time."""
    base, whole = 0x9E3779B97F4A7C15, (1 << 64) - 1

    def mixed(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = ((x ^ x >> shift) * factor) & whole
        return x ^ x >> 31

    names, out = [ord(c) for c in text], []
    while names and (not out or len(names) > 1):
        runs = [(n, len(list(same))) for n, same in groupby(names)]
        names = [n if k == 1 else mixed((n + k) & whole) if out else n | k << 21 for n, k in runs]
        label = names
        for _ in range(4):
            bits = [0] + [((x ^ y) & -(x ^ y)).bit_length() - 1 for x, y in zip(label[1:], label, strict=False)]
            label = [2 * b + (x >> b & 1) for x, b in zip(label, bits, strict=True)]
        cuts = [0] + [k for k in range(2, len(label) - 1) if label[k - 1] < label[k] > label[k + 1]] + [len(label)]
        names = [mixed((sum(v * pow(base, k, 1 << 64) for k, v in enumerate(names[a:b])) + b - a) & whole) for a, b in zip(cuts, cuts[1:], strict=False)]
        out.append(names)
    return out


def kept_of(text):
    levels = parsed(text)
    return sorted({n >> 32 for k, names in enumerate(levels, 1) for n in names if k >= 2 or len(names) == 1})[:64]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n\u00e9\U0001f389") | st.characters(exclude_categories=["Cs"]), max_size=80), min_size=1, max_size=4), st.integers(1, 3000))
def test_parsing_and_likeness_equal_brute_force(texts, times):
    texts = [*texts, "a" * times + texts[0]]
    marks = phrases.fingerprints(texts)
    assert [m.tolist() for m in marks] == [kept_of(t) for t in texts]
    for a, b in zip(texts, texts[1:], strict=False):
        first, second = kept_of(a), kept_of(b)
        union = sorted({*first, *second})[:64]
        expected = sum(x in first and x in second for x in union) / len(union) if union else 1.0
        assert abs(phrases.likeness(*phrases.fingerprints([a, b])) - expected) < 1e-12


def test_phrases_of_a_very_long_text_and_of_one_id(spark):
    long = "".join(random.Random(5).choices("abcdefgh ", k=3_000_000))
    rows = [(k // 6, f"{k * 7 % 10} text {'x' * k}") for k in range(60)] + [(4, long), (4, long)]
    found = phrases.compare_with_next(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), 5).collect()
    rows.sort()
    expected = [(i, len(t), phrases.likeness(*phrases.fingerprints([t, rows[(k + 1) % len(rows)][1]]))) for k, (i, t) in enumerate(rows)]
    assert sorted((r.doc_id, r.n_chars, r.near_next) for r in found) == sorted(expected)


def quality_table(spark, n=400):
    rng, rows, labels = random.Random(9), [], []
    for k in range(n):
        good = rng.random() < 0.7
        w = [rng.choice(["river", "stone", "cloud", "paper", "green", "walks", "slowly", "under"]) for _ in range(rng.randint(10, 80))]
        text = " ".join(w) + "." if good else " ".join(x.upper() + rng.choice(["!!", "$$$"]) for x in w)
        rows.append((k, text, "en", f"s{k % 5}", len(text)))
        if k % 2 == 0:
            labels.append((k, int(good), 0))
    truth = {k: not any(c in t for c in "!$") for k, t, *_ in rows}
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), truth


def test_quality_on_documents_kept_aside(spark, docs, no_docs):
    table, labels, truth = quality_table(spark)
    scored = quality.score_documents(table, labels).collect()
    aside = [r for r in scored if r.doc_id % 2]
    assert sum(r.keep == truth[r.doc_id] for r in aside) >= 0.97 * len(aside)
    assert all(0 <= x <= 1 for r in scored for x in (r.score, r.content_score, r.page_score))
    again = {r.doc_id: r.score for r in quality.score_documents(table.repartition(5), labels).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in scored)
    kept = quality.good_documents(table, labels)
    assert kept.schema == table.schema and {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored if r.keep}
    # No labels, labels of one class, labels that differ or are null: everything stays.
    for rows in ([], [(0, 1, 0), (1, 1, 0)], [(0, 1, 0), (0, 0, 0), (1, None, 0), (None, 0, 0)]):
        few = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
        assert quality.good_documents(docs, few).count() == docs.count()
    assert quality.score_documents(no_docs, labels).count() == 0
    assert quality.score_documents(docs, labels).count() == docs.count()


def test_what_the_pool_teaches_equals_brute_force(spark, docs):
    table, _, _ = quality_table(spark, 120)
    every = docs.select(table.columns).union(table)
    pool = quality.Pool(every, {3, 117})
    rows = [r for r in every.collect() if r.doc_id not in (3, 117)]
    cells = [int(quality.page_cells([(r.text or "").encode()], [r.source], [r.lang])[0]) for r in rows]
    assert {c: int(n) for c, n in enumerate(pool.cells) if n} == Counter(cells)
    rng = np.random.default_rng(4)
    content, platt = quality.Content(rng.normal(size=quality._TABLE), rng.normal(size=quality._LAYOUT + 2)), np.array([0.7, 0.2])
    bins = [quality.layout_bins([(r.text or "").encode()])[0].tolist() for r in rows]
    slots = [quality.content_tokens([(r.text or "").encode()])[0].tolist() for r in rows]
    numbers = [[quality._SLOTS + k * quality._BINS + b for k, b in enumerate(row)] for row in bins]
    raw = []
    for tokens, row in zip(slots, numbers, strict=True):
        parts = [sum(content.table[t] for t in tokens) / max(len(tokens), 1), *content.table[row], 1.0]
        raw.append(sum(a * b for a, b in zip(parts, content.weights, strict=True)) * platt[0] + platt[1])
    sure = math.log(quality.SURE / (1 - quality.SURE))
    for wanted in ((1.0, 1.0), (10.0, 4.0), (1e9, 1e9)):
        at = pool.surest(content, platt, wanted)
        for side, bound, most in ((raw, at[0], wanted[0]), ([-x for x in raw], at[1], wanted[1])):
            reached = sum(x >= bound for x in side)
            # As many as wanted, or all that are sure; with one step less there are too few.
            assert reached >= most or abs(bound - sure) < 1e-9
            assert sum(x >= bound + quality._STEP + 1e-9 for x in side) < max(most, 1)
    good, bad = (np.isin(np.arange(quality._CELLS), part) for part in (cells[::2], cells[1::5]))
    at = (0.1, 0.3)
    taught = pool.taught(content, platt, at, good, bad)
    for marked, sums in ((good, taught[0]), (bad, taught[1])):
        total = Counter()
        for cell, tokens, row in zip(cells, slots, numbers, strict=True):
            if marked[cell]:
                for t, n in Counter(tokens).items():
                    total[t] += round(n / len(tokens) * quality._UNIT)
                total.update(dict.fromkeys(row, quality._UNIT))
        assert {k: int(n) for k, n in enumerate(sums) if n} == {k: n for k, n in total.items() if n}
    for side, bound, sums in ((raw, at[0], taught[2]), ([-x for x in raw], at[1], taught[3])):
        assert {k: int(n) for k, n in enumerate(sums) if n} == Counter(c for c, x in zip(cells, side, strict=True) if x >= bound)


def test_rare_labels_repeated_ids_and_a_very_long_text(spark):
    table, labels, truth = quality_table(spark)
    long = "GREEN!! STONE$$$ " * 150_000
    more = [(900, long, "en", "s1", None), (901, long[:2_000_000].lower().replace("!!", "").replace("$$$", ""), "en", "s1", None)]
    more += [(2, "river stone", "en", "s2", None)] * 50 + [(None, None, None, None, None), (902, "", None, None, 0)]
    every = table.union(spark.createDataFrame(more, table.schema))
    # One labelled document in thirty is bad; the sample takes as many of each class as there are, up to half.
    bad = [i for i, good in truth.items() if not good and i % 2 == 0][:7]
    few = labels.where(F.col("quality") == 1).union(labels.where(F.col("doc_id").isin(bad)))
    scored = {r.doc_id: r.keep for r in quality.score_documents(every, few).collect()}
    assert not scored[900] and scored[901] and quality.score_documents(every, few).count() == every.count()
    assert sum(scored[i] == good for i, good in truth.items()) >= 0.95 * len(truth)
