"""Line quality: a linear-chain conditional random field marks lines as content or boilerplate.

Each line with a word is described by binary features; Viterbi decoding of the
whole document marks its lines, and the share of word characters in content
lines decides whether the document is kept. The field is trained by gradient
ascent on the likelihood of runs of lines, which take their document's label: a
bounded sample, by hash, of the runs of a bounded sample of labelled documents.
Each text is cut into runs whole, so a run from anywhere may be drawn. Plain counts (words, symbols, repeats) fail a
document before the field is asked.

Defined cases: a null, empty or blank text has no words and fails; ties and
repeated rows are independent; a null id is a document like any other. With
no labelled documents, or one class only, every line counts as content. A very
long text is described whole, in memory in proportion to itself. Other
columns are not read (``keep`` returns them as they are).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohlcflow.llm.common import chunks, discard, labelled_sample, map_batches, materialize, record_batch, words

#: Symbols, counted over whole texts.
SYMBOLS = "#*$%&|<>"
#: Bounds of the training rows: labelled documents of a class, runs of lines of a class. Documents give the runs of their whole texts.
SAMPLE_DOCS, SAMPLE_RUNS = 1_500, 6_000
#: Lines of a run.
RUN_LINES = 40
#: A document is kept from this share of word characters in content lines on.
CONTENT_SHARE = 0.5
FEATURES = 21
_ENDS = tuple(SYMBOLS)
_DIGIT = re.compile(r"[0-9]")


def line_features(line: str, parts: list[str], repeated: bool) -> list[int]:
    """Indices of the features that hold for a line with the words ``parts``."""
    n = len(parts)
    chars = sum(map(len, parts))
    symbols = sum(map(line.count, SYMBOLS)) / chars
    on = [0]
    if symbols:
        on.append(1 if symbols <= 0.02 else 2 if symbols <= 0.08 else 3)
    if 10 * sum(w.endswith(_ENDS) for w in parts) > 3 * n:
        on.append(4)
    upper = sum(map(str.isupper, parts)) / n
    if upper > 0.3 and n > 2:
        on.append(5 if upper <= 0.7 else 6)
    if _DIGIT.search(line) and 10 * len(_DIGIT.findall(line)) > chars:
        on.append(7)
    on.append(8 if n <= 2 else 9 if n <= 5 else 10 if n <= 15 else 11)
    if repeated:
        on.append(12)
    if parts[-1][-1] in ".!?":
        on.append(13)
    if n > 3 and 10 * sum(map(str.__eq__, parts, parts[1:])) > 3 * n:
        on.append(14)
    if n >= 10 and 2 * len(set(parts)) < n:
        on.append(15)
    if 10 * parts.count("|") > n:
        on.append(16)
    if "!!" in line:
        on.append(17)
    if chars > 15 * n:
        on.append(18)
    elif chars < 3 * n:
        on.append(19)
    if line[0] in " \t":
        on.append(20)
    return on


def described(text: str) -> tuple[list[list[int]], list[int], list[str], int]:
    """(features, word characters) of the lines with a word, all words, lines equal to an earlier one."""
    seen: set[str] = set()
    features, chars, everything, twice = [], [], [], 0
    for line in text.split("\n"):
        if not (parts := words(line)):
            continue
        again = line in seen
        seen.add(line)
        twice += again
        features.append(line_features(line, parts, again))
        chars.append(sum(map(len, parts)))
        everything += parts
    return features, chars, everything, twice


def repeated_words(parts: list[str], n: int = 3) -> int:
    """Words in windows of ``n`` words that the text has twice or more, the first included."""
    if len(parts) <= n:
        return 0
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in parts), np.int64, len(parts))
    code = ids[: len(ids) - n + 1]
    for k in range(1, n):  # windows by rank, so that no product overflows
        code = code * (len(known) + 1) + ids[k : len(ids) - n + 1 + k]
        if k < n - 1 and len(known) > 1 << 20:
            code = np.unique(code, return_inverse=True)[1]
    _, place, count = np.unique(code, return_inverse=True, return_counts=True)
    hit = count[place] > 1
    covered = np.zeros(len(parts), bool)
    for k in range(n):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


class LineField:
    """A linear-chain conditional random field over two labels, 1 for content."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move  # (FEATURES, 2), (2, 2)
        self.rows = emit.tolist()
        self.steps = move.tolist()

    def decode(self, lines: list[list[int]]) -> list[int]:
        """Viterbi: the likeliest labels of all lines together."""
        rows, ((aa, ab), (ba, bb)) = self.rows, self.steps
        a = b = 0.0
        back = []
        for k, on in enumerate(lines):
            ea = eb = 0.0
            for f in on:
                x, y = rows[f]
                ea += x
                eb += y
            if k:
                stay, come = a + aa, b + ba
                leave, keep = a + ab, b + bb
                back.append((come > stay, keep >= leave))
                a, b = max(stay, come) + ea, max(leave, keep) + eb
            else:
                a, b = ea, eb
        label = int(b >= a)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


def train(docs: list[list[list[int]]], labels: list[int], rounds: int = 120, length: int = RUN_LINES) -> LineField:
    """Maximum likelihood by forward and backward passes over all sequences at once (cut to ``length`` lines)."""
    cut = [(d[k : k + length], y) for d, y in zip(docs, labels, strict=True) for k in range(0, len(d), length)]
    if len({y for _, y in cut}) < 2:
        return LineField(np.tile([0.0, 1.0], (FEATURES, 1)) / FEATURES, np.zeros((2, 2)))
    steps = max(len(d) for d, _ in cut)
    x = np.zeros((len(cut), steps, FEATURES), np.float32)
    mask = np.zeros((len(cut), steps), bool)
    for i, (d, _) in enumerate(cut):
        for t, on in enumerate(d):
            x[i, t, on] = 1
            mask[i, t] = True
    y = np.array([y for _, y in cut])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))[:, None]
    gold = np.zeros((len(cut), steps, 2))
    gold[np.arange(len(cut)), :, y] = 1
    pairs = mask[:, 1:, None, None] * np.einsum("bta,btc->btac", gold[:, :-1], gold[:, 1:])
    emit, move = np.zeros((FEATURES, 2)), np.zeros((2, 2))
    g2e, g2m = np.full_like(emit, 1e-8), np.full_like(move, 1e-8)
    for _ in range(rounds):
        e = (x @ emit.astype(np.float32)).astype(float) * mask[:, :, None]
        forward, backward = [e[:, 0]], [np.zeros_like(e[:, 0])]
        for t in range(1, steps):
            step = np.logaddexp.reduce(forward[-1][:, :, None] + move, axis=1) + e[:, t]
            forward.append(np.where(mask[:, t, None], step, forward[-1]))
        for t in range(steps - 1, 0, -1):
            step = np.logaddexp.reduce((backward[-1] + e[:, t])[:, None, :] + move, axis=2)
            backward.append(np.where(mask[:, t, None], step, backward[-1]))
        f, b = np.stack(forward, 1), np.stack(backward[::-1], 1)
        z = np.logaddexp.reduce(f[:, -1], axis=1)[:, None, None]
        node = np.exp(f + b - z) * mask[:, :, None]
        edge = np.exp(f[:, :-1, :, None] + move + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[..., None]) * mask[:, 1:, None, None]
        ge = np.einsum("btf,btl->fl", x, (gold * mask[:, :, None] - node) * weight[..., None]) - 1e-5 * emit
        gm = ((pairs - edge) * weight[..., None, None]).sum((0, 1)) - 1e-5 * move
        g2e += ge * ge
        g2m += gm * gm
        emit += 0.5 * ge / np.sqrt(g2e)
        move += 0.5 * gm / np.sqrt(g2m)
    return LineField(emit, move)


def fit(docs: DataFrame, labels: DataFrame) -> LineField:
    """The field, from at most ``SAMPLE_RUNS`` runs a class of at most ``SAMPLE_DOCS`` labelled documents; only line features reach the driver."""
    sample = labelled_sample(labels, "quality", {0: SAMPLE_DOCS, 1: SAMPLE_DOCS}).select(F.col("doc_id").alias("_id"), "label")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("doc_id", "label", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("run", pa.int64()), ("lines", pa.list_(pa.binary()))])
        for (ids, ys), texts in chunks(batches):
            for doc, y, text in zip(ids, ys, texts, strict=True):
                lines = [bytes(f) for f in described(text)[0]]
                runs = [lines[k : k + RUN_LINES] for k in range(0, len(lines), RUN_LINES)]
                yield record_batch(schema, [[doc] * len(runs), [y] * len(runs), list(range(len(runs))), runs])

    runs = materialize(map_batches(rows, describe, "doc_id long, label int, run long, lines array<binary>"), "line-runs")
    order = [F.xxhash64("doc_id", "run"), F.col("doc_id"), F.col("run"), F.col("lines")]
    drawn = [runs.where(F.col("label") == y).orderBy(*order).limit(SAMPLE_RUNS) for y in (0, 1)]
    got = drawn[0].unionAll(drawn[1]).orderBy("doc_id", "label", "run", "lines").collect()
    discard(runs)
    return train([[list(x) for x in r.lines] for r in got], [r.label for r in got])


def judge(text: str, field: LineField) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share of a text."""
    features, chars, parts, twice = described(text)
    n, total = len(parts), sum(chars)
    again = repeated_words(parts)
    failed = n < 50 or 100 * again > 50 * n
    labels = field.decode(features) if n else []
    share = sum(c for c, y in zip(chars, labels, strict=True) if y) / total if n else 0.0
    return n, total, sum(map(text.count, SYMBOLS)), twice, again, failed, not failed and share >= CONTENT_SHARE, share


_OUT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def quality(docs: DataFrame, field: LineField) -> DataFrame:
    """The counts and the verdict for every document."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.bool_(), pa.bool_(), pa.float64()]
        schema = pa.schema(list(zip([c.split()[0] for c in _OUT.split(", ")], kinds, strict=True)))
        for (ids,), texts in chunks(batches):
            yield record_batch(schema, [ids, *zip(*[judge(t, field) for t in texts], strict=True)])

    return map_batches(docs.select("doc_id", "text"), look, _OUT)


def keep(docs: DataFrame, field: LineField) -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged."""
    at = docs.columns.index("text")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # one text at a time leaves Arrow
            yield batch.filter(pa.array([judge(x.as_py() or "", field)[6] for x in batch.column(at)], pa.bool_()))

    return map_batches(docs, pick, docs.schema)
