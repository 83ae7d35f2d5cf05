"""Personal data by fixed patterns and a semi-Markov conditional random field.

The field scores whole spans: what characters a span has, how its digits are grouped, whether it
passes a checksum, what stands beside it.  A dynamic programme with bounded span lengths chooses
all borders and types of a stretch of text together.  Weights are trained by likelihood on a
bounded sample in which the pattern matches are the truth, together with rewritten copies of them
(a phone number without its plus sign, an address with its sign spelt out), so the field also
finds spans that the patterns miss.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm import common

KINDS = ("email", "ip", "card", "phone")
#: Rows of the sample on which the field is trained, and stretches of text taken from it.
SAMPLE_ROWS = 1500
TRAINING_STRETCHES = 240
ROUNDS = 40
#: Longest entity, in tokens and characters.
MAX_TOKENS, MAX_CHARS = 24, 80
_CONTEXT = 24  # characters on both sides of what may belong to an entity

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_EMAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]*")
_NOT_EMAIL = re.compile(r"[^A-Za-z0-9._%+@-]")
_IP_RUN = re.compile(r"[0-9][0-9.]*")
_IP = re.compile(r"[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[\[(] ?at ?[\])]")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s|[\W_]|\d")
_SPELT = re.compile(r"[A-Za-z0-9._%+-]+ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]+( ?(\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]+)+")

Span = tuple[str, int, int]


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in reversed(digits)]
    doubled[1::2] = [2 * d - 9 * (d > 4) for d in doubled[1::2]]
    return sum(doubled) % 10 == 0


def _run_start(text: str, at: int, least: int) -> int:
    """Where the run of address characters around `at` begins, at `least` or later; reads the run only."""
    begin, size = at, 64
    while begin > least:
        low = max(least, begin - size)
        begin -= _EMAIL_RUN.match(text[low:begin][::-1]).end()
        if begin > low:
            break
        size *= 2
    return begin


def _emails(text: str, begin: int, end: int) -> list[Span]:
    """Addresses in a run of their characters: all before a sign may belong to the first part, so one look a sign is enough."""
    found: list[Span] = []
    start, at = begin, text.find("@", begin, end)
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1, end) if at > start else None
        start = domain.end() if domain else at + 1
        if domain:
            found.append(("email", begin, start))
        begin = start
        at = text.find("@", start, end)
    return found


def base_spans(text: str) -> list[Span]:
    """Pattern matches, leftmost and non-overlapping for each kind, in the order of start and kind."""
    found: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:  # a match lies within a run of its characters
        stop = _NOT_EMAIL.search(text, at)
        end = stop.start() if stop else len(text)
        found += _emails(text, _run_start(text, at, done), end)
        at, done = text.find("@", end), end
    for run in _IP_RUN.finditer(text):
        if run[0].count(".") >= 3:
            for m in _IP.finditer(run[0]):
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                    found.append(("ip", run.start() + m.start(), run.start() + m.end()))
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text that may hold entities; an entity has a trigger, so none lies outside or across."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - MAX_CHARS), min(len(text), m.end() + MAX_CHARS)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def tokens(text: str, begin: int, end: int) -> list[int]:
    """Borders of the tokens of a stretch; a word cut by its edge is a token too."""
    return [m.start() for m in _TOKEN.finditer(text, begin, end)] + [end]


N_FEATURES = 30


def features(text: str, a: int, b: int) -> np.ndarray | None:
    """Features of the whole span; none if it can't be an entity."""
    span, out = text[a:b], np.zeros(N_FEATURES)
    digits = _digits(span)
    n, letters, sign = len(digits), any(c.isalpha() for c in span), "@" in span
    spelt = not sign and _SPELT.fullmatch(span) is not None
    if not (n >= 4 or sign or spelt) or "\n" in span:
        return None
    out[0] = 1
    out[1 + sum(n >= k for k in (1, 4, 8, 10, 12, 14, 17, 20))] = 1  # 1 .. 9
    dotted = [p for p in span.split(".")]
    quad = len(dotted) == 4 and all(p.isascii() and p.isdigit() for p in dotted)
    out[10], out[11], out[12] = sign, quad, quad and all(len(p) < 4 and int(p) < 256 for p in dotted)
    out[13], out[14], out[15] = span[0] == "+", "(" in span, "-" in span or " " in span
    out[16], out[17] = 13 <= n <= 19 and luhn(digits), letters
    out[18], out[19], out[20] = _EMAIL.fullmatch(span) is not None, spelt, span.isdigit()
    left, right = text[a - 1 : a], text[b : b + 1]
    out[21], out[22] = left.isalnum(), right.isalnum()
    out[23] = bool(left) and left in "+@_%" or left in (".", "-") and text[a - 2 : a - 1].isalnum()
    out[24] = right in ("@", "_") or right in (".", "-", ")") and text[b + 1 : b + 2].isalnum()
    groups = re.findall(r"[0-9]+", span)
    out[25] = len(groups) >= 4 and all(len(g) == 4 for g in groups[:4])
    out[26] = len(groups) > 1 and len(groups[-1]) == 4
    out[27] = not letters and not sign and re.fullmatch(r"\+?[0-9(][0-9 ().-]*[0-9]", span) is not None
    out[28] = span.count("(") != span.count(")")
    out[29] = (b - a) / MAX_CHARS
    return out


@dataclass
class Stretch:
    """Candidate segments by the token they end with: (start token, features)."""

    borders: list[int]
    ending: list[list[tuple[int, np.ndarray]]]


def candidates(text: str, begin: int, end: int) -> Stretch:
    borders = tokens(text, begin, end)
    n = len(borders) - 1
    ending: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(n + 1)]
    starts = [text[p].isascii() and (text[p].isalnum() or text[p] in "+(") for p in borders[:-1]]
    ends = [text[p - 1].isascii() and text[p - 1].isalnum() for p in borders[1:]]
    triggers = np.cumsum([0, *("0" <= text[p] <= "9" or text[p] == "@" or text[p : p + 2] == "at" for p in borders[:-1])])
    for i in range(n):
        if not starts[i]:
            continue
        for j in range(i + 1, min(n, i + MAX_TOKENS) + 1):
            if borders[j] - borders[i] > MAX_CHARS or text[borders[j - 1]] == "\n":
                break
            if ends[j - 1] and triggers[j] > triggers[i] and (f := features(text, borders[i], borders[j])) is not None:
                ending[j].append((i, f))
    return Stretch(borders, ending)


class Field:
    """Weights by feature and kind, and one for an entity right after an entity; a token outside scores 0."""

    def __init__(self) -> None:
        self.weights = np.zeros((N_FEATURES, len(KINDS)))
        self.adjacent = 0.0

    def best(self, stretch: Stretch) -> list[tuple[int, int, int]]:
        """(start token, end token, kind) of the segmentation with the highest score."""
        n = len(stretch.borders) - 1
        value = [[0.0, -math.inf]] + [[-math.inf] * 2 for _ in range(n)]
        back: list[list] = [[None, None] for _ in range(n + 1)]
        for j in range(1, n + 1):
            come = 0 if value[j - 1][0] >= value[j - 1][1] else 1
            value[j][0], back[j][0] = value[j - 1][come], (j - 1, come, None)
            if stretch.ending[j]:
                scores = np.array([f for _, f in stretch.ending[j]]) @ self.weights
                for (i, _), row in zip(stretch.ending[j], scores, strict=True):
                    kind = int(row.argmax())
                    a, b = value[i][0], value[i][1] + self.adjacent
                    come = 0 if a >= b else 1
                    if (score := max(a, b) + row[kind]) > value[j][1]:
                        value[j][1], back[j][1] = score, (i, come, kind)
        out, j, state = [], n, int(value[n][1] > value[n][0])
        while j:
            i, come, kind = back[j][state]
            if kind is not None:
                out.append((i, j, kind))
            j, state = i, come
        return out[::-1]

    def gradient(self, stretch: Stretch, truth: list[tuple[int, int, int]]) -> tuple[float, np.ndarray, float]:
        """Log-likelihood of the true segments, and its gradient, by the forward-backward recursions."""
        n, add = len(stretch.borders) - 1, np.logaddexp
        scores = [np.array([f for _, f in e]) @ self.weights if e else None for e in stretch.ending]
        whole = [np.logaddexp.reduce(s, axis=1) if s is not None else () for s in scores]
        ahead = np.full((n + 1, 2), -np.inf)
        ahead[0, 0] = 0
        for j in range(1, n + 1):
            ahead[j, 0] = add(ahead[j - 1, 0], ahead[j - 1, 1])
            for (i, _), s in zip(stretch.ending[j], whole[j], strict=True):
                ahead[j, 1] = add(ahead[j, 1], add(ahead[i, 0], ahead[i, 1] + self.adjacent) + s)
        total = add(ahead[n, 0], ahead[n, 1])
        behind = np.full((n + 1, 2), -np.inf)
        behind[n] = 0
        for j in range(n, 0, -1):  # behind[j] is complete here
            behind[j - 1] = add(behind[j - 1], behind[j, 0])
            for (i, _), s in zip(stretch.ending[j], whole[j], strict=True):
                behind[i, 0] = add(behind[i, 0], s + behind[j, 1])
                behind[i, 1] = add(behind[i, 1], self.adjacent + s + behind[j, 1])
        slope, near = np.zeros_like(self.weights), 0.0
        for j in range(1, n + 1):
            for (i, f), row, s in zip(stretch.ending[j], scores[j] if scores[j] is not None else (), whole[j], strict=True):
                inside = add(ahead[i, 0], ahead[i, 1] + self.adjacent) + behind[j, 1] - total
                slope -= np.outer(f, np.exp(row + inside))
                near -= math.exp(ahead[i, 1] + self.adjacent + s + behind[j, 1] - total)
        value, last = -total, -1
        for i, j, kind in truth:
            f = next(f for start, f in stretch.ending[j] if start == i)
            slope[:, kind] += f
            value += f @ self.weights[:, kind] + self.adjacent * (last == i)
            near += last == i
            last = j
        return value, slope, near


def _truth(text: str, stretch: Stretch) -> list[tuple[int, int, int]]:
    """The pattern matches that are candidate segments; of overlapping ones the first."""
    place = {p: k for k, p in enumerate(stretch.borders)}
    out, last = [], -1
    for kind, a, b in base_spans(text) + [("email", *m.span()) for m in _SPELT.finditer(text)]:
        i, j = place.get(a), place.get(b)
        if i is not None and j is not None and i >= last and any(start == i for start, _ in stretch.ending[j]):
            out.append((i, j, KINDS.index(kind)))
            last = j
    return out


def training_set(texts: list[str], limit: int = TRAINING_STRETCHES) -> list[tuple[Stretch, list[tuple[int, int, int]]]]:
    """Stretches with their true segments: pattern matches in context, rewritten copies, and others without any."""
    out, plain = [], []
    for text in texts:
        found = base_spans(text)
        for kind, a, b in found:
            context, span, rest = text[max(0, a - _CONTEXT) : a], text[a:b], text[b : b + _CONTEXT]
            copies = [span]
            if kind == "email":
                copies.append(span.replace("@", " [at] "))
            if kind == "phone" and (short := re.sub(r"^\+[0-9]+ ?(?=\()", "", span)) != span:
                copies.append(short)
            for copy in copies:
                line = context + copy + rest
                stretch = candidates(line, 0, len(line))
                truth = _truth(line, stretch)
                if copy.startswith("("):
                    i, j = stretch.borders.index(len(context)), stretch.borders.index(len(context) + len(copy))
                    truth = [(i, j, KINDS.index(kind))] if any(s == i for s, _ in stretch.ending[j]) else truth
                out.append((stretch, truth))
        if not found:
            for a, b in stretches(text)[:2]:
                line = text[a:b]
                plain.append((candidates(line, 0, len(line)), _truth(line, candidates(line, 0, len(line)))))
        if len(out) >= limit:
            break
    return out[:limit] + plain[: limit // 2]


def train(texts: list[str], rounds: int = ROUNDS) -> Field:
    """Weights of the highest penalised likelihood, by adaptive gradient steps; the same texts give the same weights."""
    field, data = Field(), training_set(texts)
    squares, near_square = np.full(field.weights.shape, 1e-6), 1e-6
    for _ in range(rounds if data else 0):
        slope, near = -0.02 * field.weights, -0.02 * field.adjacent
        for stretch, truth in data:
            _, s, a = field.gradient(stretch, truth)
            slope, near = slope + s, near + a
        squares, near_square = squares + slope**2, near_square + near**2
        field.weights = field.weights + 0.8 * slope / np.sqrt(squares)
        field.adjacent += 0.8 * near / math.sqrt(near_square)
    return field


def _covered(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the parts of a text that spans, given in order, cover."""
    starts, ends = [], []
    for _, a, b in spans:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def find(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Pattern matches, and these together with the field's spans that meet none of them."""
    base = base_spans(text)
    more: list[Span] = []
    starts, ends = _covered(base)
    for begin, end in stretches(text):
        stretch = candidates(text, begin, end)
        for i, j, kind in field.best(stretch):
            a, b = stretch.borders[i], stretch.borders[j]
            before = bisect.bisect_left(starts, b) - 1
            if before < 0 or ends[before] <= a:
                more.append((KINDS[kind], a, b))
    return base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def sample_texts(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[str]:
    """A bounded sample of whole texts in which the patterns may have matches, chosen by hash."""
    some = docs.select("text", F.xxhash64("text").alias("h")).where(F.col("text").rlike("[0-9@]"))
    # A share of the hashes with about twice the rows, so that tasks do not each send that many texts.
    share = 2 * rows / max(some.count(), 1)
    few = some.where(F.col("h") <= min(int((share - 0.5) * 2**64), 2**63 - 1)) if share < 1 else some
    return [r.text for r in few.orderBy("h", "text").limit(rows).collect()]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_spans(docs: DataFrame) -> DataFrame:
    """For each row: doc_id, base and spans (kind:start:end by start and kind, comma-joined; code
    points, the end exclusive), and n_<kind> counting the base spans.

    Null and empty texts have no spans.  Repeated rows are searched one by one; a very long text is
    searched whole, in time that grows with its length; columns other than doc_id and text are not read.
    """
    field = docs.sparkSession.sparkContext.broadcast(train(sample_texts(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = [find(x or "", field.value) for x in batch.column("text").to_pylist()]
            counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS]
            sha = pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found])
            spans = pa.array([_joined(both) for _, both in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, sha, spans], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
            )

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return common.map_arrow(docs, ["doc_id", "text"], run, f"doc_id bigint, {counts}, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the name of its first kind."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def masked_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with every span masked in the text; n_chars, where there is one, counts the new text.

    A text without spans stays as it is, null included, and so does its n_chars.
    """
    field = docs.sparkSession.sparkContext.broadcast(train(sample_texts(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            texts = batch.column("text").to_pylist()
            sizes = batch.column("n_chars").to_pylist() if "n_chars" in batch.schema.names else [None] * len(texts)
            for k, text in enumerate(texts):
                if text and (spans := find(text, field.value)[1]):
                    texts[k] = masked(text, spans)
                    sizes[k] = len(texts[k])
            for name, values in (("text", texts), ("n_chars", sizes)):
                at = batch.schema.get_field_index(name)
                if at >= 0:
                    batch = batch.set_column(at, name, pa.array(values, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
