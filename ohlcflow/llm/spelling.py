"""Spelling variants of the words of a corpus.

Two words are near if one inserted, deleted or replaced code point makes one
the other. They are found by reduced-alphabet generation: a hash sends the
letters to a few symbols; the full one-edit neighbourhood of every distinct
reduced word is generated over these symbols and joined with the reduced
vocabulary; words whose reduced words met are verified on their own letters.
One edit of a word is at most one edit of its reduced word, so no pair is
lost. The more words there are, the more symbols: a reduced word stands for
about as many words at any size of the vocabulary, so the pairs to verify grow
with the vocabulary and not with its square.

Neighbours are 64-bit polynomial hashes, each had from running sums in
constant work, so a word of a hundred thousand letters costs a few million
numbers and not as many strings. Two reduced words of one hash give pairs that
verification refuses.

A null text has no words, and neither have empty texts and texts without a run
of ``min_chars`` letters; a null ``doc_id`` counts as an empty string in the
hash that decides a deletion. Repeated rows count again. Ties go to the
smallest word in code-point order. Empty tables give empty results. Only
``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohlcflow.llm.common import chunks, discard, materialize, record_batch

LETTERS = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100))]
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Words and characters a task counts before it sends its counts on.
HELD_WORDS, HELD_CHARS = 200_000, 1 << 24
#: Base of the polynomial hash (odd), and the neighbours computed at once.
_BASE, _AT_ONCE = np.uint64(0x9E3779B97F4A7C15), 1 << 19


def lowered(run: str) -> str:
    """``run`` with A-Z in lower case and all else as it is."""
    return run.lower() if run.isascii() else run.translate(_LOWER)


def damaged(run: str, doc: object, every: int = 199) -> str:
    """``run`` of document ``doc`` without one code point if its hash says so."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{'' if doc is None else doc}:".encode()))
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def occurrences(docs: DataFrame, min_chars: int = 6, every: int = 199) -> DataFrame:
    """(word, n): how often each word of ``min_chars`` or more letters occurs; n of a word may be dealt over several rows."""
    # a deletion only shortens a run, so shorter runs need no look
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % min_chars)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
        total: Counter[str] = Counter()
        held = 0
        for (ids,), texts in chunks(batches):
            for doc, text in zip(ids, texts, strict=True):
                for run, n in Counter(runs.findall(text)).items():
                    word = damaged(lowered(run), doc, every)
                    if len(word) >= min_chars:
                        if word not in total:
                            held += len(word)
                        total[word] += n
                if len(total) >= HELD_WORDS or held >= HELD_CHARS:
                    yield record_batch(schema, [list(total), list(total.values())])
                    total.clear()
                    held = 0
        if total:
            yield record_batch(schema, [list(total), list(total.values())])

    return docs.select("doc_id", "text").mapInArrow(count, "word string, n long")


def vocabulary(docs: DataFrame, min_chars: int = 6, min_count: int = 5, every: int = 199) -> DataFrame:
    """(word, n) of the words that occur ``min_count`` times or more over all documents."""
    return occurrences(docs, min_chars, every).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def symbols_for(n_words: int, min_chars: int = 6) -> int:
    """Symbols that give the shortest words about as many reduced words as there are words."""
    return min(max(4, int(np.ceil(max(n_words, 1) ** (1 / min_chars)))), 48)


def reduced(words: DataFrame, symbols: int) -> DataFrame:
    """``words`` with ``reduced``: each letter replaced by one of ``symbols`` characters from "0" on."""
    to = "".join(chr(ord("0") + zlib.crc32(c.encode()) % symbols) for c in LETTERS)
    return words.withColumn("reduced", F.translate("word", "".join(LETTERS), to))


def _powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, _BASE, np.uint64))])


def hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of symbols (1 and up), modulo 2^64."""
    length = codes.shape[1]
    return (codes * _powers(length)[length - 1 :: -1][:length]).sum(axis=1, dtype=np.uint64) if length else np.zeros(len(codes), np.uint64)


def neighbourhoods(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Hashes of all rows that one edit at most makes of each row of ``codes``, the row itself included."""
    rows, length = codes.shape
    power = _powers(length + 1)
    place = power[length - 1 :: -1][:length]  # B^(L-1), ..., B^0
    letters = np.arange(1, symbols + 1, dtype=np.uint64)
    own = codes * place
    whole = own.sum(axis=1, dtype=np.uint64)[:, None]
    zero = np.zeros((rows, 1), np.uint64)
    upto = np.hstack([zero, np.cumsum(own, axis=1, dtype=np.uint64)])  # the first i symbols, in place
    shorter = np.hstack([zero, np.cumsum(codes[:, :-1] * place[1:], axis=1, dtype=np.uint64)])  # one place to the right
    longer = np.hstack([zero, np.cumsum(codes * power[length:0:-1], axis=1, dtype=np.uint64)])  # one place to the left
    replaced = (whole - own)[:, :, None] + place[None, :, None] * letters
    deleted = shorter + whole - upto[:, 1:]
    inserted = (longer + whole - upto)[:, :, None] + power[length::-1][None, :, None] * letters
    return np.hstack([whole, replaced.reshape(rows, -1), deleted, inserted.reshape(rows, -1)])


def meetings(words: DataFrame, symbols: int) -> DataFrame:
    """(code, near): hashes of reduced words that are one edit apart at most, code <= near; equal ones once."""

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("code", pa.int64()), ("near", pa.int64())])
        for batch in batches:
            by_length: dict[int, list[str]] = {}
            for word in batch.column(0).to_pylist():
                by_length.setdefault(len(word), []).append(word)
            for length, same in by_length.items():
                step = max(1, _AT_ONCE // ((2 * symbols + 1) * (length + 1)))
                for k in range(0, len(same), step):
                    codes = _codes(same[k : k + step], length)
                    code = hashes(codes).view(np.int64)[:, None]
                    near = np.sort(neighbourhoods(codes, symbols).view(np.int64), axis=1)
                    use = near >= code
                    use[:, 1:] &= near[:, 1:] != near[:, :-1]
                    yield record_batch(schema, [np.broadcast_to(code, near.shape)[use], near[use]])

    return words.select("reduced").distinct().mapInArrow(generate, "code long, near long")


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("ascii"), np.uint8).reshape(-1, length).astype(np.uint64) - np.uint64(ord("0") - 1)


def coded(words: DataFrame) -> DataFrame:
    """(word, n, code) of ``reduced`` words: the hash that ``meetings`` uses."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("code", pa.int64())])
        for batch in batches:
            word, n, short = batch.columns
            out = [int(hashes(_codes([w], len(w))).view(np.int64)[0]) for w in short.to_pylist()]
            yield pa.RecordBatch.from_arrays([word, n, pa.array(out, pa.int64())], schema=schema)

    return words.select("word", "n", "reduced").mapInArrow(code, "word string, n long, code long")


def near_pairs(words: DataFrame, symbols: int | None = None, min_chars: int = 6) -> DataFrame:
    """(word, n, near, near_n): all pairs of ``words(word, n)`` one edit apart, each once."""
    short = reduced(words, symbols := symbols or symbols_for(words.count(), min_chars))
    own = materialize(coded(short), "spelling-codes")
    met = meetings(short, symbols).join(own.select(F.col("code").alias("near")).distinct(), "near", "left_semi")
    other = own.select(F.col("word").alias("near_word"), F.col("n").alias("near_n"), F.col("code").alias("near"))
    verified = (
        own.join(met, "code")
        .join(other, "near")
        .where((F.col("code") != F.col("near")) | (F.col("word") < F.col("near_word")))
        .where(F.abs(F.char_length("word") - F.char_length("near_word")) <= 1)
        .where(F.levenshtein("word", "near_word", 1) == 1)
    )
    return verified.select("word", "n", F.col("near_word").alias("near"), "near_n").distinct()


def forms(words: DataFrame, pairs: DataFrame, ratio: int = 5) -> DataFrame:
    """``words(word, n)`` with n_near, and form and form_n: the commonest near word, if ``ratio`` times as common."""
    both = pairs.unionAll(pairs.select("near", "near_n", "word", "n"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word",
        F.when(is_form, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
    )


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last word that forms lead to.

    A form is ``ratio`` times as common as its word, so forms never turn back
    and their chains are short; every round doubles the steps taken.
    """
    now = materialize(found.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(now.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        done = moved.where("moved").isEmpty()
        discard(now)
        now = moved
        if done:
            return now.select("word", "root")


def spelling_groups(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, every: int = 199) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``docs``."""
    words = materialize(vocabulary(docs, min_chars, min_count, every), "spelling-words")
    found = materialize(forms(words, near_pairs(words, min_chars=min_chars), ratio), "spelling-forms")
    return found.join(roots(found), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
