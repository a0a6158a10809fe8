"""Personal data by weak supervision.

Patterns propose candidate spans in every whole text. Four labelers vote on
each (for, against, or no opinion): the shape's own check, a gazetteer (issuer
and country prefixes, top-level domains, reserved networks), the words before the span,
and its neighbouring characters. Votes are counted over all documents into a
table of bounded size, and expectation-maximisation estimates from it how reliable
each labeler is and how likely each pattern of votes is right; no labeler has a veto.
A logistic span classifier is then trained on these probabilities. It does not see the
votes but the span and its surroundings: the span's shape, first characters and length,
the characters beside it, the words before and behind it. It is trained on a bounded
sample of candidates by hash and decides every candidate that is not a base span; spans
of the base kinds that pass their check always stay.

Defined cases: a null text is empty and has no span; null ids, ties and
repeated rows are independent of each other; a very long text is searched whole, in
time and memory in proportion to itself; an empty table fits no model and
gives no rows. Other columns stay as they are (``redact``) or are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohlcflow.llm.common import chunks, map_batches, of_kind, record_batch, span_digest

#: Kinds; the first four are the base kinds.
KINDS = ["email", "ip", "card", "phone", "local_phone", "national_id", "iban", "masked_email"]
BASE = KINDS[:4]
#: A candidate that is not a base span is one from this probability on.
ACCEPT = 0.5
#: Candidates that the classifier is trained on at most, drawn by hash, and the width of its hashed features.
SAMPLE_SPANS, WIDTH = 10_000, 1 << 12

# fixed values: prefixes and names that gazetteers list
_CALLING = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 354 358 359 370 371 372 380 385 386 420 421 852 886 971 972".split())
_ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|35|36|6011|62|65")
_DOMAINS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl be ch at se no dk fi pl pt ru jp cn kr in br mx ca au nz us eu".split())
_BANKS = frozenset("AD AE AT BE BG BR CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IL IS IT LI LT LU LV MC MT NL NO PL PT RO RS SA SE SI SK SM TR".split())
_FOR = re.compile(r"\b(?:e-?mail|mail|contact|write|phone|tel|call|mobile|cell|fax|card|visa|credit|debit|account|iban|bank|ssn|social|passport|ip|host|address|login|user|name|reach)\b", re.I)
_AGAINST = re.compile(r"\b(?:version|release|order|invoice|isbn|sku|serial|commit|hash|build|section|chapter|page|figure|id|no)\b", re.I)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match can only start where a run of digits starts, as runs are taken whole; possessive runs keep this linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MORE = {
    "local_phone": re.compile(r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"),
    "national_id": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"),
}
_MASKED = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{1,63})+", re.I | re.A)
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and host; each @ is looked at once, so long runs cost no more than their length."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            out.append((start, host.end()))
            end = host.end()
        at = text.find("@", max(at + 1, end))
    return out


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, passes its check) of every candidate."""
    if "@" in text:
        yield from ((0, a, b, True) for a, b in emails(text))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            yield 1, *m.span(), all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0")[:4] or 0) <= 255 for x in m[0].split("."))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if len(digits) >= 8:  # shorter numbers are no candidates for anything
                yield 2, *m.span(), 13 <= len(digits) <= 19 and luhn(digits)
        if "+" in text:
            for m in _PHONE.finditer(text):
                yield 3, *m.span(), 9 <= len(_digits(m[0])) <= 15
        for name, pattern in _MORE.items():
            for m in pattern.finditer(text):
                yield KINDS.index(name), *m.span(), name != "iban" or _iban(m[0])
    low = text.lower() if "at]" in text or "at)" in text or "AT" in text else ""
    if "[at]" in low or "(at)" in low:
        yield from ((7, *m.span(), True) for m in _MASKED.finditer(text))


def _iban(s: str) -> bool:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _gazetteer(kind: int, s: str) -> int:
    """1 for, 2 against, 0 no opinion; so all labelers."""
    digits = _digits(s)
    if kind in (0, 7):
        return 1 if re.split(r"[^A-Za-z0-9]+", s.rstrip(".-"))[-1].lower() in _DOMAINS else 2
    if kind == 1:
        return 2 if s.split(".")[0] in ("0", "127", "255") else 0
    if kind == 2:
        return 1 if _ISSUERS.match(digits) else 2
    if kind == 3:
        return 1 if digits.startswith(_CALLING) else 2
    if kind == 5:
        return 2 if digits[:3] in ("000", "666") or digits[0] == "9" else 0
    if kind == 6:
        return 1 if s[:2] in _BANKS else 2
    return 0


def pattern_of(text: str, kind: int, start: int, end: int, good: bool) -> int:
    """The candidate's kind, votes and length class as one number."""
    before = text[max(0, start - 40) : start]
    around = text[max(0, start - 1) : start] + text[end : end + 1]
    votes = (
        1 if good else 2,
        _gazetteer(kind, text[start:end]),
        1 if _FOR.search(before) else 2 if _AGAINST.search(before) else 0,
        2 if any(c.isalnum() or c in "_-/=@" for c in around) else 1,
    )
    code = kind
    for v in votes:
        code = 3 * code + v
    return 4 * code + min(3, (end - start) // 8)


LABELERS = 4
#: Number of patterns there can be: the size of the table that the driver sees.
PATTERNS = len(KINDS) * 3**LABELERS * 4


def _shape(s: str) -> str:
    """The span's kinds of characters, runs as one: A, a, 9, or the character itself."""
    out = []
    for c in s[:80]:
        k = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


def _class(c: str) -> str:
    return "" if not c else "9" if c.isdigit() else "a" if c.isalpha() else " " if c.isspace() else c


def features(text: str, kind: int, start: int, end: int, good: bool) -> list[int]:
    """Hashed features of a span and its surroundings."""
    s, left, right = text[start:end], text[max(0, start - 60) : start], text[end : end + 30]
    before, behind = left.lower().split(), right.lower().split()
    of_kind = [
        f"good {good}", f"shape {_shape(s)}", f"length {min(len(s), 40) // 2}", f"first {s[:1]}", f"first two {s[:2]}", f"last {s[-1:]}",
        f"digits {min(len(_digits(s)), 24)}", f"left {_class(left[-1:])}", f"right {_class(right[:1])}",
    ]
    around = [f"before {w.strip(_AROUND)}" for w in before[-3:]] + [f"just before {w}" for w in before[-1:]] + [f"behind {w.strip(_AROUND)}" for w in behind[:2]]
    names = [f"kind {kind}", *[f"{kind} {n}" for n in of_kind], *around, *[f"{kind} {n}" for n in around]]
    return sorted({zlib.crc32(n.encode()) % WIDTH for n in names})


_AROUND = ".,;:!?\"'()[]{}<>|#*="


class _Covered:
    """Non-overlapping parts of a text, from spans in any order."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        k = bisect_right(self.starts, b - 1) - 1
        return k >= 0 and self.ends[k] > a


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, bool]]]:
    """(base spans, other candidates with whether they pass their check); other candidates do not overlap base spans of equal or other kind."""
    base, other = [], []
    for kind, a, b, good in matches(text):
        (base if kind < len(BASE) and good else other).append((kind, a, b, good))
    covered = _Covered([(a, b) for _, a, b, _ in base])
    return [x[:3] for x in base], [x for x in other if not covered.meets(x[1], x[2])]


_SPAN = "struct<kind: int, start: long, end: long, pattern: int, features: array<int>>"
_FOUND = f"doc_id long, base array<{_SPAN}>, other array<{_SPAN}>"


def _described(text: str, kind: int, a: int, b: int, good: bool) -> dict:
    return {"kind": kind, "start": a, "end": b, "pattern": pattern_of(text, kind, a, b, good), "features": features(text, kind, a, b, good)}


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and other candidates, each with its votes and features: one row per document."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("pattern", pa.int32()), ("features", pa.list_(pa.int32()))])
        schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(span)), ("other", pa.list_(span))])
        for (ids,), texts in chunks(batches):
            found = [find(t) for t in texts]
            base = [[_described(t, *x, True) for x in b] for t, (b, _) in zip(texts, found, strict=True)]
            other = [[_described(t, *x) for x in o] for t, (_, o) in zip(texts, found, strict=True)]
            yield record_batch(schema, [ids, base, other])

    return map_batches(docs.select("doc_id", "text"), look, _FOUND)


def pattern_counts(found: DataFrame) -> dict[int, int]:
    """Candidates by pattern over all documents: at most ``PATTERNS`` rows."""
    all_ = F.explode(F.transform(F.concat("base", "other"), lambda s: s["pattern"])).alias("pattern")
    return {r["pattern"]: r["count"] for r in found.select(all_).groupBy("pattern").count().collect()}


def sample(found: DataFrame) -> list[tuple[int, list[int]]]:
    """(pattern, features) of at most ``SAMPLE_SPANS`` candidates, those with the least hashes."""
    spans = found.select("doc_id", F.explode(F.concat("base", "other")).alias("s")).select("doc_id", "s.*")
    order = [F.xxhash64("doc_id", "kind", "start", "end"), F.col("doc_id"), F.col("kind"), F.col("start"), F.col("features")]
    return [(r.pattern, r.features) for r in spans.orderBy(*order).limit(SAMPLE_SPANS).select("pattern", "features").collect()]


def _votes(pattern: int) -> tuple[int, list[int], int]:
    code, size = divmod(pattern, 4)
    votes = []
    for _ in range(LABELERS):
        code, v = divmod(code, 3)
        votes.append(v)
    return code, votes[::-1], size


def estimate(counts: dict[int, int], rounds: int = 60) -> tuple[dict[int, float], np.ndarray]:
    """Expectation-maximisation: (probability of each pattern, reliabilities[labeler, truth, vote])."""
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    kind, votes = np.array([_votes(p)[0] for p in patterns]), np.array([_votes(p)[1] for p in patterns])
    # from more votes for than against, with the shape's own check counting as certain as all the others
    p = 1 / (1 + np.exp(-((votes == 1) * [2, 1, 1, 1]).sum(1) + ((votes == 2) * [3, 1, 1, 1]).sum(1)))
    rates = np.zeros((LABELERS, 2, 3))
    for _ in range(rounds):
        prior = np.array([(np.sum(n * p * (kind == k)) + 1) / (np.sum(n * (kind == k)) + 2) for k in range(len(KINDS))])
        for j in range(LABELERS):
            for v in range(3):
                hit = votes[:, j] == v
                rates[j, 1, v], rates[j, 0, v] = np.sum(n * p * hit) + 1, np.sum(n * (1 - p) * hit) + 1
        rates /= rates.sum(2, keepdims=True)
        yes, no = np.log(prior[kind]), np.log(1 - prior[kind])
        for j in range(LABELERS):
            yes, no = yes + np.log(rates[j, 1, votes[:, j]]), no + np.log(rates[j, 0, votes[:, j]])
        p = 1 / (1 + np.exp(np.clip(no - yes, -500, 500)))
    return dict(zip(patterns, p.tolist(), strict=True)), rates


class SpanClassifier:
    """A weight for each hashed feature."""

    def __init__(self, weights: np.ndarray | None):
        self.weights = weights

    def probability(self, on: list[int]) -> float:
        if self.weights is None:
            return 0.0
        return float(1 / (1 + np.exp(-self.weights[on].sum())))


def fit(found: DataFrame, rounds: int = 300) -> SpanClassifier:
    """The span classifier, trained on what the labelers say of the candidates ``found``."""
    counts = pattern_counts(found)
    if not counts:
        return SpanClassifier(None)
    soft, _ = estimate(counts)
    return train([(x, soft[p]) for p, x in sample(found)], rounds)


def train(spans: list[tuple[list[int], float]], rounds: int = 300) -> SpanClassifier:
    """Logistic regression from features to probabilities; the two sides weigh as much as each other."""
    if not spans:
        return SpanClassifier(None)
    rows = np.repeat(np.arange(len(spans)), [len(x) for x, _ in spans])
    at = np.concatenate([np.array(x, np.int64) for x, _ in spans])
    y = np.array([p for _, p in spans])
    weight = np.where(y >= 0.5, 0.5 / max(1, (y >= 0.5).sum()), 0.5 / max(1, (y < 0.5).sum()))
    w, g2 = np.zeros(WIDTH), np.full(WIDTH, 1e-8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.bincount(rows, w[at], len(spans))))
        g = np.bincount(at, (weight * (p - y))[rows], WIDTH) + 1e-4 * w
        g2 += g * g
        w -= 0.3 * g / np.sqrt(g2)
    return SpanClassifier(w)


def detect(found: DataFrame, model: SpanClassifier) -> DataFrame:
    """doc_id, counts, digest and spans of the rows of ``candidates``."""
    weights = found.sparkSession.sparkContext.broadcast(model)  # ``WIDTH`` numbers

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))) for n in ("base", "more")]])
        bare = lambda spans: [{k: s[k] for k in ("kind", "start", "end")} for s in spans]
        for batch in batches:
            ids, base, other = (c.to_pylist() for c in batch.columns)
            more = [bare(s for s in spans if weights.value.probability(s["features"]) >= ACCEPT) for spans in other]
            yield record_batch(schema, [ids, [bare(x) for x in base], more])

    span = "array<struct<kind: int, start: long, end: long>>"
    decided = map_batches(found.select("doc_id", "base", "other"), decide, f"doc_id long, base {span}, more {span}")
    return decided.select(
        "doc_id",
        *[of_kind("base", k).alias(f"n_{name}") for k, name in enumerate(BASE)],
        F.sha2(span_digest(F.col("base"), KINDS, by_start=False), 256).alias("base_sha256"),
        span_digest(F.concat("base", "more"), KINDS, by_start=False).alias("spans"),
    )


def accepted(text: str, model: SpanClassifier) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base spans of a text and of those that the classifier adds."""
    base, other = find(text)
    return base + [x[:3] for x in other if model.probability(features(text, *x)) >= ACCEPT]


def redact(docs: DataFrame, model: SpanClassifier) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; n_chars, if there, follows. Columns stay."""
    at = docs.columns.index("text")
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    weights = docs.sparkSession.sparkContext.broadcast(model)

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, end = [], 0
        for a, b, k in sorted((a, b, k) for k, a, b in accepted(text, weights.value)):
            if a < end:  # overlaps one that is gone already: its rest goes too
                end = max(end, b)
                continue
            out += [text[end:a], f"<{KINDS[k]}>"]
            end = b
        return "".join([*out, text[end:]])

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            rows = max(1, (whole.num_rows << 22) // max(whole.nbytes, 1 << 22))  # about 4 MB at once
            for k in range(0, whole.num_rows, rows):
                batch = whole.slice(k, rows)
                texts = [clean(x.as_py()) for x in batch.column(at)]
                columns = list(batch.columns)
                columns[at] = pa.array(texts, batch.schema.field(at).type)
                if count is not None:
                    columns[count] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(count).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_batches(docs, replace, docs.schema)
