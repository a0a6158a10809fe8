"""Toxicity: a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two strings sums, over all common subsequences of three
characters within a short span, a weight that decays with the characters skipped
(``DECAY`` for each). An inserted or missing character changes only
some of these, so "lo.s.er" and "losxer" stay close to "loser".

Training is multiple-instance: a labelled document's sentences carry its
label, and what makes a sentence toxic is one of its windows: a word, or a span
of 2 to ``SPAN`` neighbouring words, joined with and without a space. Windows are
counted over distinct sentences of a bounded sample of labelled documents; those
that occur with toxic sentences beyond chance (a bound on the binomial tail, times
the number of windows, below 1) and mostly there are positive instances, each with
the weight of its evidence; those that do not are negative, the rest is left out.
A span that holds a positive window is none of its own.
Some windows serve as landmarks: of the positive ones those that a pivoted Cholesky
factorisation picks, each the one that those before represent worst, so that every
family of insults has its own, however rare; and of the negative ones some at random
and, once a first machine is there, those that it takes for insults, chosen likewise.
A window is represented by its kernels with them,
whitened by the landmarks' own kernel matrix (Nyström), and a linear
SVM with squared hinge loss is trained on that, taking in the hardest negatives
of the sample again and again. As the kernel is an inner product over
subsequences, the trained machine folds into one weight for each
subsequence, so scoring a window costs no more for more landmarks.

A document's margin is a mix of the margins of its worst windows, less a little
for its length: a word that looks like an insult by chance stands alone, and a long text
has more of them. The mix (from the worst window only to the three worst words), the
length's weight and the cut are those that part the sample with the fewest errors,
the simplest of equally good ones; a logistic map turns the margin into a score. A text has
many more spans than words, so a span's margin counts less by a handicap fitted
with them, at most ``HANDICAP``. Words have outer punctuation off
and a few look-alike characters mapped; words without a letter are left out,
runs of single characters are joined whatever white space parts them, and very
long words and spans are taken in overlapping pieces, so whole texts are scored.
Windows are scored by running sums along the text: a window's sum is the difference of
two of them, so spans cost little more than words.

Defined cases: a null, empty or wordless text has the least margin; null ids
and repeated rows are scored like any other; labels of null or unknown
documents are not used; without two classes in the labels every score is 0.
Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohlcflow.llm.common import chunks, discard, labelled_sample, materialize, record_batch, words

#: Bounds of the training rows: labelled documents of either class, and negative instances (words, spans) drawn by hash from them.
SAMPLE_TOXIC, SAMPLE_CLEAN, NEGATIVES, SPAN_NEGATIVES = 3_000, 9_000, 80_000, 40_000
#: Kernel: weight for each skipped character, characters that may be skipped, window length.
DECAY, GAPS, LENGTH = 0.6, 2, 24
#: Landmarks: of the positive windows, of the negative ones at random, of the hardest negative ones.
LANDMARKS = 80, 32, 192
#: Neighbouring words in a span.
SPAN = 4
#: One in so many distinct spans of clean sentences, by hash, can be drawn as a negative instance.
SPAN_SHARE = 4
#: The most by which a span's margin may count less than a word's; training puts insults at 1, other windows at -1.
HANDICAP = 0.7
#: Mixes of a document's worst margins (words and spans, second and third word), simplest first, and weights of the length's logarithm.
MIXES = [(1.0, 0.0, 0.0), (0.5, 0.5, 0.0), (0.0, 1.0, 0.0), (0.0, 0.7, 0.3), (0.2, 0.4, 0.4)]
LENGTHS = [0.0, 0.05, 0.1, 0.15, 0.2]
#: Margins are compared within these bounds, lengths with this number of words.
BOUNDS, USUAL_WORDS = (-1.0, 1.2), 100
#: Characters whose windows are scored at once; longer texts go in overlapping blocks.
BLOCK = 1 << 18
#: Margin of a text without words.
LEAST = -3.0

_OUTER = ".,;:!?\"'()[]{}<>|*#%&$-_~`«»¿¡…“”’"
_INNER = re.compile(r"[.\-_*'’,~]+")
_SPACED = re.compile(r"(?<!\S)\S(?:\s++\S){2,}(?!\S)")
_LETTERED = re.compile(r"[^\x20\x09-\x0D]*?[^\W_][^\x20\x09-\x0D]*")
_SENTENCE = re.compile(r"[.!?\n]+")
# fixed values: characters that stand in for letters
_ALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_STEPS = [(a, b, DECAY ** (b - 2)) for a in range(1, GAPS + 2) for b in range(a + 1, GAPS + 3)]


def normal(word: str) -> str:
    return _INNER.sub("", word.strip(_OUTER).translate(_ALIKE))


def pieces(w: str) -> list[str]:
    """A normalised word or span, in overlapping pieces if long."""
    if len(w) <= LENGTH:
        return [w] if len(w) > 2 else []
    return [w[k : k + LENGTH] for k in range(0, len(w) - LENGTH // 2, LENGTH // 2)]


def windows(word: str) -> list[str]:
    """What a word is compared as: normalised, in overlapping pieces if long."""
    return pieces(normal(word))


def spaced(text: str) -> list[str]:
    """Runs of single characters between white space, joined."""
    return ["".join(m[0].split()) for m in _SPACED.finditer(text)]


def spans(sentence: str, without: set[str] = frozenset()) -> set[str]:
    """Windows of 2 to ``SPAN`` neighbouring words, joined with and without a space; none of a span with a window of ``without`` in it."""
    ws = [w for x in words(sentence) if (w := normal(x))]
    bad = [not without.isdisjoint(pieces(w)) for w in ws]
    out = set()
    for n in range(2, SPAN + 1):
        for k in range(len(ws) - n + 1):
            if not any(bad[k : k + n]):
                out.update(pieces("".join(ws[k : k + n])))
                out.update(pieces(" ".join(ws[k : k + n])))
    return out


def _codes(ws: list[str]) -> np.ndarray:
    """Characters as numbers below 64, 0 behind the end; letters and digits have their own, others share."""
    flat = np.frombuffer("".join(w.ljust(LENGTH, "\0") for w in ws).encode("utf-32-le"), "<u4").reshape(len(ws), LENGTH)
    letter = (flat >= 97) & (flat <= 122)
    return np.where(flat == 0, 0, np.where(letter, flat - 96, 27 + flat % 37)).astype(np.int32)


def _subsequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(feature of every start, whether it is within the window, weight) for every way to skip."""
    for a, b, weight in _STEPS:
        last = codes[:, b:]
        yield (codes[:, : LENGTH - b] << 12) | (codes[:, a : LENGTH - b + a] << 6) | last, last > 0, weight


def _norms(codes: np.ndarray) -> np.ndarray:
    return np.sqrt(sum(ok.sum(1) * weight**2 for _, ok, weight in _subsequences(codes)))


def seen(ws: list[str]) -> np.ndarray:
    """The features that the strings have, ascending."""
    return np.unique(np.concatenate([at[ok] for at, ok, _ in _subsequences(_codes(ws))]))


def features(ws: list[str], among: np.ndarray | None = None) -> np.ndarray:
    """Dense feature vectors of a few strings, scaled by their own number of subsequences; only the columns ``among``, which must be all they have."""
    codes, out = _codes(ws), np.zeros((len(ws), 1 << 18 if among is None else len(among)), np.float32)
    for at, ok, weight in _subsequences(codes):
        rows = np.broadcast_to(np.arange(len(ws))[:, None], at.shape)
        np.add.at(out, (rows[ok], at[ok] if among is None else np.searchsorted(among, at[ok])), weight)
    return out / np.maximum(_norms(codes), 1e-9)[:, None]


def folded(ws: list[str], table: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
    """Inner products of the strings' feature vectors with the columns of ``table``; a feature's row is at ``place`` if given."""
    codes = _codes(ws)
    total = np.zeros((len(ws), *table.shape[1:]), np.float32)
    for at, ok, weight in _subsequences(codes):
        got = table[at if place is None else place[at]] * (ok if table.ndim == 1 else ok[..., None])
        total += np.float32(weight) * got.sum(1)
    norm = np.maximum(_norms(codes), 1e-9).astype(np.float32)
    return total / (norm if table.ndim == 1 else norm[:, None])


_PLAIN, _EDGE, _DROPPED, _SPACE = 0, 1, 2, 3
# fixed values of the characters below 2^14: what becomes of them, and their numbers (as in _codes)
_KIND = np.zeros(1 << 14, np.uint8)
_KIND[[ord(c) for c in _OUTER]] = _EDGE
_KIND[[ord(c) for c in ".-_*'’,~"]] = _DROPPED
_KIND[[ord(c) for c in " \t\n\x0b\x0c\r"]] = _SPACE
_NUMBER = np.array([_ALIKE.get(c, c) if isinstance(_ALIKE.get(c, c), int) else ord(_ALIKE[c]) for c in range(1 << 14)])
_NUMBER = np.where((_NUMBER >= 97) & (_NUMBER <= 122), _NUMBER - 96, 27 + _NUMBER % 37).astype(np.int32)
#: Norm of a window by its length.
_NORM = np.array([max(1e-9, math.sqrt(sum(max(0, n - b) * w**2 for _, b, w in _STEPS))) for n in range(LENGTH + 1)])


def blocks(text: str) -> Iterator[tuple[str, int]]:
    """``text`` in blocks of about ``BLOCK`` characters, cut at spaces, that share ``2 * LENGTH`` words with a letter; with the characters that the block before has too."""
    start, done, size = 0, 0, BLOCK
    while len(text) - start > size:
        cut = next((k for k in range(start + size, len(text)) if text[k] in " \t\n\x0b\x0c\r"), len(text))
        shared = [m.start() for m in _LETTERED.finditer(text, start, cut)][-2 * LENGTH :]
        if cut < len(text) and (len(shared) < 2 * LENGTH or shared[0] == start):
            size *= 2
            continue
        yield text[start:cut], done - start
        if cut == len(text):
            return
        start, done, size = shared[0], cut, BLOCK
    yield text[start:], done - start


def _layout(parts: list[str], shared: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of the normalised words' characters, where each word begins and the last ends, the part of each word, whether it lies behind the part's ``shared`` characters)."""
    raw = np.frombuffer("\n".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
    low = np.minimum(raw, len(_KIND) - 1)
    kind = _KIND[low]
    number = np.where(raw < len(_KIND), _NUMBER[low], 27 + raw % 37).astype(np.int32)
    inside = np.concatenate([[False], kind != _SPACE, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edge[::2], edge[1::2]
    plain = np.flatnonzero(kind == _PLAIN)
    lo, hi = np.searchsorted(plain, begin), np.searchsorted(plain, end)
    some = hi > lo  # words of more than outer punctuation
    begin, lo, hi = begin[some], plain[lo[some]], plain[hi[some] - 1] + 1
    mark = np.zeros(len(raw) + 1, np.int8)
    mark[lo] += 1
    mark[hi] -= 1
    keep = (np.cumsum(mark[:-1], dtype=np.int8) > 0) & (kind != _DROPPED)
    at = np.concatenate([[0], np.cumsum(keep)])
    ends = np.cumsum([len(p) + 1 for p in parts])
    owner = np.searchsorted(ends, begin, "right")
    fresh = begin >= (ends - [len(p) + 1 - n for p, n in zip(parts, shared, strict=True)])[owner]
    return number[keep], np.append(at[lo], at[-1]), owner, fresh


def _cut(first: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows from s to e, the long ones in the pieces that ``pieces`` makes."""
    half = LENGTH // 2
    many = np.where(e - s > LENGTH, -(-(e - s - half) // half), 1)
    if many.max(initial=1) == 1:
        return first, s, e
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    s, e = np.repeat(s, many) + half * nth, np.repeat(e, many)
    return np.repeat(first, many), s, np.minimum(e, s + LENGTH)


class Machine:
    """The trained machine: a weight for each subsequence, and the map from margin to score."""

    def __init__(
        self, table: np.ndarray | None, bias: float = 0.0, slope: float = 1.0, middle: float = 0.0,
        handicap: float = 0.0, mix: tuple[float, ...] = MIXES[0], length: float = 0.0,
    ):
        self.table, self.bias, self.slope, self.middle = table, bias, slope, middle
        self.handicap, self.mix, self.length = handicap, mix, length

    def margins(self, ws: list[str]) -> np.ndarray:
        return folded(ws, self.table) + self.bias

    def _running(self, number: np.ndarray) -> list[np.ndarray]:
        """By a subsequence's width: running sums along the characters of what those that start there weigh."""
        out = []
        for b in range(2, GAPS + 3):
            n = max(0, len(number) - b)
            total = np.zeros(n + 1)
            head, last = number[:n] << 12, number[b:]
            value = sum(self.table[head | (number[a : n + a] << 6) | last] for a in range(1, min(b, GAPS + 2))) if n else total[:0]
            np.cumsum(value, dtype=float, out=total[1:])
            out.append(total * DECAY ** (b - 2))
        return out

    def _sums(self, running: list[np.ndarray], s: np.ndarray, e: np.ndarray) -> np.ndarray:
        total = np.zeros(len(s))
        for b, c in enumerate(running, 2):
            total += c[np.minimum(np.maximum(e - b, s), len(c) - 1)] - c[np.minimum(s, len(c) - 1)]
        return np.where(e - s > 2, total / _NORM[e - s] + self.bias, LEAST)

    def worst(self, parts: list[str], shared: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each (lower-case) part: the greatest margin among the words and among the spans (``LEAST`` at the least); the three greatest
        of single words behind its ``shared`` characters (within ``BOUNDS``), greatest first; the number of these words."""
        number, at, owner, fresh = _layout(parts, shared or [0] * len(parts))
        out, three = np.full((len(parts), 2), LEAST), np.full((len(parts), 3), BOUNDS[0])
        number_of = np.bincount(owner[fresh], minlength=len(parts))
        count = len(owner)
        if not count:
            return out, three, number_of
        best, every = np.full((count, 2), LEAST), np.arange(count)

        def take(kind: int, running: list[np.ndarray], first: np.ndarray, s: np.ndarray, e: np.ndarray) -> None:
            first, s, e = _cut(first, s, e)
            np.maximum.at(best[:, kind], first, self._sums(running, s, e))

        joined = self._running(number)
        take(0, joined, every, at[:-1], at[1:])
        some = np.flatnonzero(fresh & (best[:, 0] > BOUNDS[0]))
        some = some[np.lexsort((-best[some, 0], owner[some]))]
        place = np.arange(len(some)) - np.searchsorted(owner[some], owner[some])
        some, place = some[place < 3], place[place < 3]
        three[owner[some], place] = np.minimum(best[some, 0], BOUNDS[1])
        one = np.concatenate([[False], (np.diff(at) == 1), [False]])
        # a run of single characters ends with its part
        change = np.flatnonzero((one[1:] != one[:-1]) | np.concatenate([[False], one[1:-2] & (owner[1:] != owner[:-1]), [False]]))
        lo, hi = change[:-1], change[1:]
        run = one[1:][lo] & (hi - lo > 2)
        if run.any():
            take(0, joined, lo[run], at[lo[run]], at[hi[run]])
        apart = np.full(len(number) + count, _NUMBER[32], np.int32)
        apart[np.arange(len(number)) + np.repeat(every, np.diff(at))] = number
        apart = self._running(apart)
        for n in range(2, SPAN + 1):
            first = np.flatnonzero(owner[n - 1 :] == owner[: count - n + 1]) if count >= n else every[:0]
            take(1, joined, first, at[first], at[first + n])
            take(1, apart, first, at[first] + first, at[first + n] + first + n - 1)
        np.maximum.at(out, owner, best)
        return out, three, number_of

    def margin(self, found: np.ndarray) -> np.ndarray:
        """Margins of documents from rows of ``Scorer.found``."""
        first = np.clip(np.maximum(found[:, 0], found[:, 1] - self.handicap), *BOUNDS)
        mixed = np.column_stack([first, found[:, 3:5]]) @ np.array(self.mix)
        margin = mixed - self.length * np.log(np.maximum(found[:, 5], 1) / USUAL_WORDS)
        return np.where(found[:, 5] > 0, margin, LEAST)

    def score(self, margin: float) -> float:
        if self.table is None:
            return 0.0
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.slope * (margin - self.middle)))))


def nystrom(landmarks: list[str], among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(features of the landmarks, the inverse root of their kernel matrix)."""
    phi = features(landmarks, among)
    values, vectors = np.linalg.eigh((phi @ phi.T).astype(float))
    ok = values > 1e-6
    return phi, vectors[:, ok] / np.sqrt(values[ok])


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 150, c: float = 200.0) -> tuple[np.ndarray, float]:
    """Linear support vector machine, squared hinge loss, by Newton steps on the margin violators."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(z.shape[1]), np.r_[np.ones(x.shape[1]), 1e-3]
    for _ in range(rounds):
        on = y * (z @ w) < 1
        a = z[on] * (c * weight[on])[:, None]
        new = np.linalg.solve(a.T @ z[on] + np.diag(ridge), a.T @ y[on])
        if np.abs(new - w).max() < 1e-6:
            break
        w = w + 0.7 * (new - w)
    return w[:-1], float(w[-1])


def log_tail(t: int, c: int, share: float) -> float:
    """Logarithm of a bound (Chernoff's) on the chance of ``t`` toxic ones or more among ``t + c``."""
    q = t / (t + c)
    if q <= share:
        return 0.0
    return -(t * math.log(q / share) + (c * math.log((1 - q) / (1 - share)) if c else 0.0))


def beyond_chance(counts: list[tuple[str, int, int]], share: float, number: int) -> list[tuple[float, str]]:
    """(strength, w) of the windows mostly in toxic sentences and beyond chance among ``number`` windows, strongest first."""
    found = [(w, t, c) for w, t, c in counts if t >= 3 and t >= c and log_tail(t, c, share) + math.log(max(2, number)) < 0]
    return sorted(((_strength(t, c, share), w) for w, t, c in found), reverse=True)


def _strength(t: int, c: int, share: float) -> float:
    return t * math.log((t + 0.1) / (t + c + 0.1) / share)


def least(share: float, number: int) -> float:
    """The fewest sentences, all toxic, that are beyond chance among ``number`` windows."""
    return max(3, math.log(max(2, number)) / -math.log(share))


def spread(ws: list[str], number: int) -> list[str]:
    """At most ``number`` of the windows, each the one that those before represent worst (pivoted Cholesky of the kernel matrix)."""
    if not ws:
        return []
    phi = features(ws, seen(ws))
    left = (phi * phi).sum(1).astype(float)
    rows, chosen = np.zeros((len(ws), min(number, len(ws)))), []
    for k in range(rows.shape[1]):
        i = int(np.argmax(left))
        if left[i] < 1e-3:
            break
        chosen.append(i)
        rows[:, k] = (phi @ phi[i] - rows[:, :k] @ rows[i, :k]) / math.sqrt(left[i])
        left -= rows[:, k] ** 2
        left[chosen] = 0
    return [ws[i] for i in chosen]


def shortest(positive: list[tuple[float, str]], known: list[str]) -> list[tuple[float, str]]:
    """The spans without those that hold a known window or a shorter span."""
    out, held = [], list(known)
    for s, w in sorted(positive, key=lambda x: (len(x[1]), x[1])):
        if not any(h in w for h in held):
            out.append((s, w))
            held.append(w)
    return sorted(out, reverse=True)


def train(
    counts: list[tuple[str, int, int]], sentences: tuple[int, int], found: tuple[list[tuple[str, int, int]], int] = ((), 0), harmless: list[str] = ()
) -> Machine:
    """The machine from (window, toxic sentences, clean sentences) and the sample's numbers of both.

    ``found`` are such counts of spans and how many spans they were chosen from, ``harmless`` spans of clean sentences.
    """
    share = sentences[0] / max(1, sum(sentences))
    if not 0 < share < 1 or not counts:
        return Machine(None)
    positive = beyond_chance(counts, share, len(counts))
    positive += shortest(beyond_chance(found[0], share, found[1]), [w for _, w in positive])
    positive.sort(reverse=True)
    if not positive:
        rest = sorted(((_strength(t, c, share), w) for w, t, c in counts), reverse=True)
        positive = [(s, w) for s, w in rest[:5] if s > 0]
    taken = {w for _, w in positive}
    # no evidence for them, though clean sentences have them
    negative = [w for w, t, c in counts if w not in taken and c and log_tail(t, c, share) > math.log(0.01)]
    negative += sorted(set(harmless) - taken - set(negative))
    if not positive or not negative:
        return Machine(None)
    pos = [w for _, w in positive]
    strength = np.sqrt([s for s, _ in positive])
    rng = np.random.default_rng(7)
    some = [negative[i] for i in rng.permutation(len(negative))]
    ours, random, hardest = LANDMARKS
    marks = spread(pos, ours) + some[:random]
    _, hard, worst = _trained(pos, strength, marks, some, some[:4_000], 2)
    marks = list(dict.fromkeys([*marks, *spread(worst, hardest)]))
    return _trained(pos, strength, marks, some, hard, 4)[0]


def _trained(pos: list[str], strength: np.ndarray, marks: list[str], some: list[str], hard: list[str], rounds: int) -> tuple[Machine, list[str], list[str]]:
    """(machine, negatives it was trained on, hardest ones of all ``some``)."""
    used = seen(marks)  # a few thousand of the 2^18 subsequences; all others weigh nothing
    phi, root = nystrom(marks, used)
    table = np.vstack([np.zeros((1, root.shape[1])), phi.T @ root.astype(np.float32)])  # subsequences x landmark directions
    place = np.zeros(1 << 18, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    embed = lambda ws: np.vstack([folded(ws[k : k + 512], table, place) for k in range(0, len(ws), 512)]).astype(float)
    xp = embed(pos)
    for _ in range(rounds):
        xn = embed(hard)
        weight = np.r_[strength / strength.sum(), np.full(len(hard), 1 / len(hard))]
        w, b = svm(np.vstack([xp, xn]), np.r_[np.ones(len(pos)), -np.ones(len(hard))], weight)
        machine = Machine((table @ w.astype(np.float32))[place], b)
        margin = np.concatenate([machine.margins(some[k : k + 4_096]) for k in range(0, len(some), 4_096)])
        worst = [some[i] for i in np.argsort(-margin, kind="stable")[:2_000] if margin[i] > -1]
        new = list(dict.fromkeys([*hard, *worst]))
        if len(new) == len(hard):
            break
        hard = new
    return machine, hard, worst[:1_000]


class Scorer:
    """Margins of texts."""

    def __init__(self, machine: Machine):
        self.machine = machine

    def found(self, texts: list[str]) -> np.ndarray:
        """Of each text: the greatest margin among words and among spans, the three greatest of words, the number of words."""
        out = np.tile([LEAST, LEAST, *[BOUNDS[0]] * 3, 0.0], (len(texts), 1))
        parts, shared, owner, size = [], [], [], 0

        def flush() -> None:
            most, three, number = self.machine.worst(parts, shared)
            np.maximum.at(out[:, :2], owner, most)
            for k, x, n in zip(owner, three, number, strict=True):
                out[k, 2:5] = np.sort(np.r_[out[k, 2:5], x])[:-4:-1]
                out[k, 5] += n

        for k, text in enumerate(texts):
            for part, old in blocks(text.lower()):
                parts.append(part)
                shared.append(old)
                owner.append(k)
                size += len(part)
                if size >= BLOCK:
                    flush()
                    parts, shared, owner, size = [], [], [], 0
        if parts:
            flush()
        return out

    def both(self, texts: list[str]) -> np.ndarray:
        """The greatest margin among the words and among the spans of each text."""
        return self.found(texts)[:, :2]

    def margins(self, texts: list[str]) -> list[float]:
        return self.machine.margin(self.found(texts)).tolist()


_FOUND = ["of_words", "of_spans", "first", "second", "third", "n_words"]


def margins(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id and ``Scorer.found`` of every whole text, with the ``margin``."""
    table = docs.sparkSession.sparkContext.broadcast(machine)  # 2^18 weights, whatever the corpus

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(table.value)
        schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.float64()) for n in (*_FOUND, "margin")]])
        for (ids,), texts in chunks(batches):
            if table.value.table is None:
                got = np.tile([LEAST, LEAST, *[BOUNDS[0]] * 3, 0.0], (len(ids), 1))
            else:
                got = scorer.found(texts)
            yield record_batch(schema, [ids, *got.T, table.value.margin(got)])

    return docs.select("doc_id", "text").mapInArrow(look, "doc_id long, " + ", ".join(f"{n} double" for n in (*_FOUND, "margin")))


def _sentences(sample: DataFrame) -> DataFrame:
    """(sentence, label, text) of the distinct sentences of (text, label)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("sentence", pa.int64()), ("label", pa.int32()), ("text", pa.string())])
        for (labels,), texts in chunks(batches):
            rows = [(zlib.crc32(s.encode()), y, s) for y, text in zip(labels, texts, strict=True) for s in set(_SENTENCE.split(text.lower())) if s]
            if rows:
                yield record_batch(schema, list(zip(*rows, strict=True)))

    return sample.select("label", "text").mapInArrow(split, "sentence long, label int, text string").dropDuplicates(["sentence", "label"])


def _window_counts(sentences: DataFrame) -> tuple[list[tuple[str, int, int]], tuple[int, int]]:
    """Words by toxic and clean distinct sentences, and the numbers of the sentences with any."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("label", pa.int32()), ("ws", pa.list_(pa.string()))])
        for (labels,), texts in chunks(batches):
            rows = [(y, sorted(ws)) for y, s in zip(labels, texts, strict=True) if (ws := {x for w in {*words(s), *spaced(s)} for x in windows(w)})]
            if rows:
                yield record_batch(schema, list(zip(*rows, strict=True)))

    split_up = sentences.select("label", "text").mapInArrow(split, "label int, ws array<string>")
    by = {r["label"]: r["count"] for r in split_up.groupBy("label").count().collect()}
    counts = (
        split_up.select("label", F.explode("ws").alias("w"))
        .groupBy("w")
        .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
    )
    likely = counts.where("t >= 3 and t >= c")  # a few of the windows of a bounded sample
    others = counts.where("not (t >= 3 and t >= c)").orderBy(F.xxhash64("w"), "w").limit(NEGATIVES)
    return sorted((r.w, r.t, r.c) for r in likely.unionAll(others).collect()), (by.get(1, 0), by.get(0, 0))


def _span_counts(sentences: DataFrame, known: set[str], share: float) -> tuple[list[tuple[str, int, int]], int, list[str]]:
    """(span, toxic, clean sentences) of the spans that can be beyond chance, how many toxic spans there are, and some clean ones.

    Clean sentences are looked through only for the spans that enough toxic ones have.
    """

    def exploded(chosen: Callable[[str], Iterable[str]], label: int) -> DataFrame:
        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([("w", pa.string())])
            for _, texts in chunks(batches):
                yield record_batch(schema, [[w for s in texts for w in chosen(s)]])

        return sentences.where(F.col("label") == label).select("text").mapInArrow(split, "w string")

    held = sentences.sparkSession.sparkContext.broadcast(known)
    toxic = exploded(lambda s: spans(s, held.value), 1).groupBy("w").agg(F.count("*").alias("t"))
    number = toxic.count()
    often = toxic.where(F.col("t") >= least(share, number))
    found = dict(often.collect())  # each in several sentences of a bounded sample
    asked = sentences.sparkSession.sparkContext.broadcast(frozenset(found))
    clean = dict(exploded(lambda s: asked.value & spans(s), 0).groupBy("w").count().collect())
    some = exploded(lambda s: [w for w in spans(s, held.value) if zlib.crc32(w.encode()) % SPAN_SHARE == 0], 0).distinct()
    harmless = [r.w for r in some.orderBy(F.xxhash64("w"), "w").limit(SPAN_NEGATIVES).collect()]
    return sorted((w, t, clean.get(w, 0)) for w, t in found.items()), number, harmless


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """The machine from a bounded sample of the labelled documents (``SAMPLE_TOXIC``, ``SAMPLE_CLEAN``)."""
    chosen = labelled_sample(labels, "toxic", {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN}).select(F.col("doc_id").alias("_id"), F.col("label").cast("int").alias("label"))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "label", "text")
    sentences = materialize(_sentences(sample), "sentences")
    counts, numbers = _window_counts(sentences)
    found, harmless = ((), 0), []
    if all(numbers) and counts:
        share = numbers[0] / sum(numbers)
        known = {w for _, w in beyond_chance(counts, share, len(counts))}
        *found, harmless = _span_counts(sentences, known, share)
    discard(sentences)
    machine = train(counts, numbers, tuple(found), harmless)
    if machine.table is None:
        return machine
    got = margins(sample, machine).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select(*_FOUND, "label").collect()
    return calibrated(machine, np.array([[r[n] for n in _FOUND] for r in got]), np.array([r.label for r in got]))


def calibrated(machine: Machine, found: np.ndarray, y: np.ndarray) -> Machine:
    """The simplest mix, length's weight and handicap of spans that part the sample with the fewest errors, score one half at the cut."""
    best = None
    for mix in MIXES:
        for length in LENGTHS:
            for handicap in np.linspace(0, HANDICAP, 8).tolist() if mix[0] else [0.0]:
                tried = Machine(machine.table, machine.bias, 4.0, 0.0, handicap, mix, length)
                errors, tried.middle = _parted(tried.margin(found), y)
                if best is None or errors < best[0]:
                    best = errors, tried
    return best[1]


def _parted(m: np.ndarray, y: np.ndarray) -> tuple[int, float]:
    """The fewest errors, and the cut between neighbouring margins that makes them."""
    order = np.argsort(m, kind="stable")
    m, y = m[order], y[order]
    errors = np.r_[0, np.cumsum(y)] + np.r_[np.cumsum((1 - y)[::-1])[::-1], 0]
    errors[1:-1][m[1:] == m[:-1]] = len(m) + 1  # no cut between equal margins
    best = np.flatnonzero(errors == errors.min())
    edges = np.r_[m[0] - 1, (m[1:] + m[:-1]) / 2, m[-1] + 1]
    return int(errors.min()), float(np.median(edges[best]))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from one half on) of every text."""
    exponent = F.greatest(F.lit(-60.0), F.least(F.lit(60.0), F.lit(machine.slope) * (F.col("margin") - F.lit(machine.middle))))
    out = F.lit(0.0) if machine.table is None else 1 / (1 + F.exp(-exponent))
    return margins(docs, machine).select("doc_id", out.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
