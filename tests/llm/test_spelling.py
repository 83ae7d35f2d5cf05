"""Spelling variants against comparing all words with all words."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logwarden.llm import spelling
from logwarden.llm.queries import QUERIES

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows, length=7, count=2, typo=31):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % typo == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= length and k >= count}


def are_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_groups(n, ratio=10):
    near = {w: [v for v in n if are_near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def table(spark, n, parts=4):
    return spark.createDataFrame(sorted(n.items(), key=lambda x: hash(x[0])), "word string, n bigint").repartition(parts)


def some_words(seed, size=300, letters="aaaé"):
    rng = random.Random(seed)
    n = {}
    for _ in range(size):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 10)))
        n[word] = rng.choice([2, 2, 3, 25, 25, 300, 4000])
    n["q" * 5000], n["q" * 4999], n["q" * 5000 + "é"], n["q" * 2500 + "x" + "q" * 2500] = 2, 30, 900, 3
    n["zzzzzzzz"], n["×÷×÷×÷×"] = 2, 2
    return n


@pytest.mark.parametrize(("seed", "partitions"), [(1, 1), (2, 5), (3, 60)])
def test_groups_equal_all_with_all(spark, seed, partitions):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = some_words(seed)
        got = sorted(tuple(r) for r in spelling.variant_groups(table(spark, n)).collect())
        links = sorted(tuple(r) for r in spelling.near_words(table(spark, n)).collect())
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = brute_groups(n)
    assert got == want
    assert max(Counter(r[2] for r in want).values()) > 5 and any(r[1] and r[1] != r[2] for r in want)
    assert links == sorted((a, b) for a in n for b in n if are_near(a, b))


WORDS = st.lists(st.text("ab", min_size=1, max_size=6), min_size=1, max_size=40, unique=True).map(sorted)


@settings(max_examples=400, deadline=None)
@given(WORDS, st.lists(st.integers(0, 40), max_size=8))
def test_equal_prefixes_have_equal_numbers_in_any_partition(words, cuts):
    edges = sorted({0, len(words), *(c for c in cuts if c < len(words))})
    parts = [(3 * k, words[a:b]) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    ends = spelling.borders([(k, p[0], p[-1]) for k, p in parts])
    by_number, by_prefix = {}, {}
    for k, part in parts:
        for place, path in spelling.walk(iter(part), ends[k]):
            word = part[place]
            others = [w for w in words if w != word]
            shared = max((spelling.shared_length(word, w) for w in others), default=-1)
            assert len(path) == shared + 1
            for depth, number in enumerate(path):
                assert by_number.setdefault(number, word[:depth]) == word[:depth]
                assert by_prefix.setdefault(word[:depth], number) == number


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=300), st.text("ab", max_size=300), st.text("a", max_size=600))
def test_shared_length(a, b, start):
    a, b = start + a, start + b
    want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert spelling.shared_length(a, b) == want


def test_words_of_any_document(spark, docs):
    rng = random.Random(8)
    extra = [(k, " ".join(rng.choice(["Wizards", "potionsÉ", "QUIETLYly", "sevenseven", "b×÷céxÿz"]) for _ in range(60)) + "!x9wizardsy") for k in range(100, 160)]
    extra.append((170, "wizards" * 200_000 + " wizards"))
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    got = {r.word: r.n for r in spelling.words_of(rows).collect()}
    assert got == brute_words([tuple(r) for r in rows.collect()])
    assert spelling.variants(rows).count() == len(got)


def test_no_rows(spark, no_docs):
    assert spelling.variants(no_docs).count() == 0
    assert spelling.near_words(table(spark, {"lonely": 2})).count() == 0
    assert [tuple(r) for r in spelling.variant_groups(table(spark, {"lonely": 2})).collect()] == [("lonely", None, "lonely", 2, 0, None)]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    n = brute_words(rows)
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    found = QUERIES["op11_spelling"](spark, sf)
    assert found.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    got = {r.word: r for r in found.collect()}
    assert {w: r.n for w, r in got.items()} == n
    rng = random.Random(1)
    for w in rng.sample(sorted(n), min(len(n), 400)):
        near = [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, ()) if are_near(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form = best if best and n[best] >= 10 * n[w] else None
        assert (got[w].n_near, got[w].form, got[w].form_n) == (len(near), form, n[form] if form else None)
        assert got[w].root == (got[form].root if form else w)
