"""Groups of spelling variants by a dictionary of trie-node pairs.

Every prefix of a word is a node of the trie of all words, every suffix a node of the trie of all
reversed words.  Nodes are numbered by walking the words in order: a word shares the nodes up to
its common prefix with the word before, and gets new numbers below.  Partitions of the sorted words
number their own nodes; the nodes on the path across a border are numbered after the partition that
holds them first, which all learn from the first and last word of every partition.

Skipping position i of a word leaves the pair (node of the prefix before i, node of the suffix
after i).  Words that meet on such a pair differ in that one position.  A word also has, at every
place i, the pair (prefix before i, suffix from i); a longer word that skips a position to that very
pair has one code point more.  Of a run of equal code points only the first is skipped for this, so
every two neighbours meet exactly once.  A node that only one word has can't meet another and is
left out, so a word's pairs end where it stops sharing.

Words that meet on one pair differ in one code point, so there are at most as many as the alphabet
has letters, and one more.  Word numbers follow code-point order: comparing them compares words.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm import common

#: Fixed value: a run of letters.
RUN = r"[A-Za-zÀ-ÿ]"
#: Least code points and least occurrences of a word; how much more frequent a form must be.
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10

#: Numbers of the nodes of one partition; the lower half for new ones, the upper for the path across its end.
_PART = 1 << 40
_ACROSS = 1 << 39


def words_of(docs: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT, typo: int = 31) -> DataFrame:
    """word and n (occurrences) of the distinct words of whole texts.

    A word is a maximal run of letters with A-Z lower-cased; where `typo` divides its checksum with
    the document's number, one code point is missing.  Shorter and rarer words are left out, runs
    that can't be long enough before anything else.  A null text has none; a null doc_id counts as
    an empty one; every row counts, repeated ones too; no rows give none.
    """
    long = F.explode(F.regexp_extract_all("text", F.lit(f"({RUN}{{{length},}})"), F.lit(1)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), long.alias("run"))
    lower = runs.withColumn("run", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    summed = lower.withColumn("sum", F.crc32(F.encode(F.concat_ws(":", "doc", "run"), "UTF-8")))
    at = F.expr("int(sum % length(run))")
    shorter = F.concat(F.expr("left(run, at)"), F.expr("substring(run, at + 2)"))
    word = F.when(F.col("sum") % typo == 0, shorter).otherwise(F.col("run"))
    counted = summed.withColumn("at", at).select(word.alias("word")).where(F.char_length("word") >= length)
    return counted.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count)


def shared_length(a: str, b: str) -> int:
    """The length of the longest common prefix."""
    top = min(len(a), len(b))
    if a[:top] == b[:top]:
        return top
    low, step = 0, 8
    while a[low : low + step] == b[low : low + step]:
        low, step = low + step, step * 2
    while a[low] == b[low]:
        low += 1
        if step > 64 and a[low : low + 64] == b[low : low + 64]:
            low += 64
    return low


@dataclass
class Border:
    """What a partition must know of its neighbours: its number, how far its first word shares a
    path with the words before and its last word with the words after, and the numbers on the former."""

    part: int
    before: int
    after: int
    last: str
    owners: list[tuple[int, int]]  # (partition that holds it first, depth up to which that is so), by depth

    def number(self, depth: int) -> int:
        """The number of the node at a depth that the words before have too."""
        at = bisect.bisect_left(self.owners, depth, key=lambda x: x[1])
        return self.owners[at][0] * _PART + _ACROSS + depth


def borders(ends: list[tuple[int, str, str]]) -> dict[int, Border]:
    """Borders by partition, from (partition, first word, last word) of each in order."""
    out: dict[int, Border] = {}
    for k, (part, first, last) in enumerate(ends):
        before = shared_length(ends[k - 1][2], first) if k else -1
        after = shared_length(last, ends[k + 1][1]) if k + 1 < len(ends) else -1
        owners: list[tuple[int, int]] = []
        if k:
            left, previous = out[ends[k - 1][0]], ends[k - 1]
            # The partition before has the path of its last word; its first word tells what it took over.
            taken = min(before, left.before, shared_length(previous[1], previous[2]))
            owners = [(owner, min(depth, taken)) for owner, depth in left.owners]
            owners = [x for i, x in enumerate(owners) if i == 0 or owners[i - 1][1] < x[1]] if taken >= 0 else []
            if before > taken:
                owners.append((previous[0], before))
        out[part] = Border(part, before, after, last, owners)
    return out


def walk(words: Iterator[str], border: Border) -> Iterator[tuple[int, list[int]]]:
    """For each word in order its place and the numbers of its nodes from the root down, as far as another word shares them."""
    made = border.part * _PART
    path: list[int] = []
    place, word, ahead = -1, None, next(words, None)
    known = border.before  # depth down to which the word's path is numbered by the words before
    while ahead is not None:
        previous, word, place = word, ahead, place + 1
        ahead = next(words, None)
        common_ = border.before if previous is None else known
        if previous is None:
            path = [border.number(d) for d in range(common_ + 1)]
        else:
            del path[common_ + 1 :]
        following = border.after if ahead is None else shared_length(word, ahead)
        deep = max(common_, following)
        across = min(border.after, shared_length(word, border.last)) if border.after >= 0 else -1
        for depth in range(len(path), deep + 1):
            if depth <= across:
                path.append(border.part * _PART + _ACROSS + depth)
            else:
                path.append(made)
                made += 1
        yield place, path[: deep + 1]
        known = following


def _ordered(df: DataFrame, key: Column) -> tuple[DataFrame, dict[int, Border]]:
    """Rows sorted by `key` over partitions with their number, kept in the checkpoint folder, and the borders.

    The borders hold two keys a partition, as do the bounds by which Spark itself deals a sorted table.
    """
    dealt = df.withColumn("key", key).repartitionByRange("key").sortWithinPartitions("key")
    rows = common.cut(dealt.withColumn("part", F.spark_partition_id()))
    ends = rows.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("part")
    return rows, borders([tuple(r) for r in ends.collect()])


def _numbered(rows: DataFrame, ends: dict[int, Border]) -> DataFrame:
    """id (in code-point order), word, n and the prefix nodes of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _walked(batches, ends, ("word", "n"), with_id=True)

    return rows.mapInArrow(run, "id bigint, word string, n bigint, nodes array<bigint>")


def _walked(batches: Iterator[pa.RecordBatch], ends: dict[int, Border], kept: tuple[str, ...], with_id: bool) -> Iterator[pa.RecordBatch]:
    """The kept columns with the nodes of each key; rows come in the order of their keys."""
    waiting: list[pa.RecordBatch] = []
    part = -1

    def keys() -> Iterator[str]:
        nonlocal part
        for batch in batches:
            for piece in common.slices(iter([batch]), "key"):
                if piece.num_rows:
                    waiting.append(piece)
                    part = piece.column("part")[0].as_py()
                    yield from piece.column("key").to_pylist()

    source = keys()
    first = next(source, None)
    if first is None:
        return

    def all_keys() -> Iterator[str]:
        yield first
        yield from source

    nodes: list[list[int]] = []
    place = 0
    for place, path in walk(all_keys(), ends[part]):
        nodes.append(path)
        while waiting and len(nodes) >= waiting[0].num_rows:
            piece = waiting.pop(0)
            yield _with_nodes(piece, nodes[: piece.num_rows], kept, part * _PART + place - len(nodes) + 1 if with_id else None)
            del nodes[: piece.num_rows]


def _with_nodes(piece: pa.RecordBatch, nodes: list[list[int]], kept: tuple[str, ...], first: int | None) -> pa.RecordBatch:
    columns = [piece.column(name) for name in kept] + [pa.array(nodes, pa.list_(pa.int64()))]
    names = [*kept, "nodes"]
    if first is not None:
        columns.insert(0, pa.array(range(first, first + piece.num_rows), pa.int64()))
        names.insert(0, "id")
    return pa.RecordBatch.from_arrays(columns, names)


#: How a word comes to a pair: with all its code points, or skipping one (the first of a run of equal ones, or not).
_WHOLE, _SKIP, _FIRST = 0, 1, 2


def pairs_of(word: str, before: list[int], after: list[int]) -> Iterator[tuple[int, int, int]]:
    """(prefix node, suffix node, kind) of a word, given the nodes it shares with others by depth."""
    size = len(word)
    for i in range(max(0, size - len(after)), min(size, len(before) - 1) + 1):
        if size - i < len(after):
            yield before[i], after[size - i], _WHOLE
        if i < size and size - i - 1 < len(after):
            yield before[i], after[size - i - 1], _SKIP if i and word[i] == word[i - 1] else _FIRST


def _paired(rows: DataFrame, ends: dict[int, Border]) -> DataFrame:
    """The pairs of all words: prefix, suffix, kind, id, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _walked(batches, ends, ("word", "nodes_before", "id", "n"), with_id=False):
            words, before = batch.column("word").to_pylist(), batch.column("nodes_before").to_pylist()
            after, ids, counts = batch.column("nodes").to_pylist(), batch.column("id").to_pylist(), batch.column("n").to_pylist()
            out: list[tuple] = []
            for word, a, b, number, n in zip(words, before, after, ids, counts, strict=True):
                out.extend((p, s, kind, number, n) for p, s, kind in pairs_of(word, a, b))
                if len(out) > 200_000:
                    yield _pair_batch(out)
                    out = []
            if out:
                yield _pair_batch(out)

    return rows.mapInArrow(run, "prefix bigint, suffix bigint, kind int, id bigint, n bigint")


def _pair_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["prefix", "suffix", "kind", "id", "n"])


def node_pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, word and n of each word; its pairs) of a table of distinct words with their counts."""
    sorted_words, ends = _ordered(common.cut(words.select("word", "n")), F.col("word"))
    numbered = _numbered(sorted_words, ends).withColumnRenamed("nodes", "nodes_before")
    turned, ends_turned = _ordered(numbered, F.reverse("word"))
    return turned.select("id", "word", "n"), _paired(turned, ends_turned)


def _meetings(pairs: DataFrame) -> DataFrame:
    """id, and its neighbours as (-n, id) in order, by word and pair on which it meets any."""
    member = F.struct((-F.col("n")).alias("minus"), "id", "kind")
    met = pairs.groupBy("prefix", "suffix").agg(F.array_sort(F.collect_list(member)).alias("met")).where(F.size("met") > 1)

    def near(x: Column, y: Column) -> Column:
        skips = (x["kind"] != _WHOLE) & (y["kind"] != _WHOLE)
        longer = (x["kind"] + y["kind"] == _FIRST) & (x["kind"] != y["kind"])
        return (x["id"] != y["id"]) & (skips | longer)

    def of(x: Column) -> Column:
        others = F.filter("met", lambda y: near(x, y))
        return F.struct(x["id"].alias("id"), F.transform(others, lambda y: F.struct(y["minus"], y["id"])).alias("near"))

    rows = met.select(F.explode(F.transform("met", of)).alias("row"))
    return rows.select("row.id", "row.near").where(F.size("near") > 0)


def near_words(words: DataFrame) -> DataFrame:
    """word and near: all pairs of words that differ by one code point, each both ways round.

    Takes distinct words with their counts; every pair comes once.
    """
    table, pairs = node_pairs(words)
    links = _meetings(pairs).select("id", F.explode("near.id").alias("other"))
    left = links.join(table.select("id", "word"), "id")
    return left.join(table.select(F.col("id").alias("other"), F.col("word").alias("near")), "other").select("word", "near")


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word (distinct, with their counts n).

    form: the near word of largest n (ties: smallest in code-point order) where that n is at least
    `ratio` times the word's, else null; root: the last word that forms lead to, the word itself
    without one.  No words give no rows.

    Forms grow by `ratio` each time, so the greatest count bounds how many follow one another, and
    each round of the walk to the root doubles the way.  A form has no more words than a word has
    neighbours, so no join meets a key that gathers rows without bound.
    """
    table, pairs = node_pairs(words)
    best = _meetings(pairs).select("id", F.size("near").alias("met"), F.get("near", F.lit(0)).alias("first"))
    stats = best.groupBy("id").agg(F.sum("met").alias("n_near"), F.min("first").alias("first"))
    joined = table.join(stats, "id", "left").withColumn("form_n", -F.col("first.minus"))
    fits = F.col("form_n") >= ratio * F.col("n")
    kept = joined.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("first.id")).alias("form_id"), F.when(fits, F.col("form_n")).alias("form_n"),
    )
    judged = common.cut(kept)
    most, links = judged.agg(F.max("n")).first()[0] or 0, judged.where("form_id is not null").select("id", F.col("form_id").alias("to"))
    steps = 1
    while ratio**steps <= most:
        links = links.alias("a").join(
            links.select(F.col("id").alias("to"), F.col("to").alias("next")), "to", "left"
        ).select("id", F.coalesce("next", "to").alias("to"))
        steps *= 2
    named = judged.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    tops = links.join(judged.select(F.col("id").alias("to"), F.col("word").alias("root")), "to").select("id", "root")
    return (
        judged.join(named, "form_id", "left")
        .join(tops, "id", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )


def variants(docs: DataFrame) -> DataFrame:
    """`variant_groups` of the words of whole texts."""
    return variant_groups(words_of(docs))
