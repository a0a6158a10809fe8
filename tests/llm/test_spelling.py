import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ohlcflow.llm import queries as L
from ohlcflow.llm import spelling as S

SF_SMALL = "/root/testdata/sf0.001"
TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows, min_chars=6, min_count=5):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(TABLE)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= min_chars and n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio=5):
    near = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for length, some in by_length.items():
        for i, a in enumerate(some):
            for b in some[i + 1 :] + by_length.get(length + 1, []):
                if one_edit(a, b):
                    near[a].append(b)
                    near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def as_dict(rows):
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = L.op13_spelling(spark, SF_SMALL)
    assert got.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert as_dict(got.collect()) == brute(brute_words(docs))


@pytest.mark.parametrize("symbols", [4, 7])
def test_pairs_of_random_words(spark, symbols):
    rng = np.random.default_rng(symbols)
    words = {"".join(rng.choice(list("abcé"), rng.integers(1, 7))): int(rng.integers(5, 2000)) for _ in range(400)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = S.near_pairs(table, symbols).collect()
    pairs = {frozenset((r.word, r.near)) for r in got}
    assert len(pairs) == len(got)
    some = sorted(words)
    assert pairs == {frozenset((a, b)) for i, a in enumerate(some) for b in some[i + 1 :] if one_edit(a, b)}
    found = S.forms(table, S.near_pairs(table, symbols))
    rows = found.join(S.roots(found), "word", "left").withColumn("root", F.coalesce("root", "word")).collect()
    assert as_dict(rows) == brute(words)


def test_neighbourhoods_are_full():
    rng = np.random.default_rng(5)
    for length in range(7):
        codes = rng.integers(1, 4, (6, length)).astype(np.uint64)
        for row, near in zip(codes, S.neighbourhoods(codes, 3), strict=True):
            word = [int(c) for c in row]
            edits = [word] + [word[:i] + word[i + 1 :] for i in range(length)]
            edits += [word[:i] + [s] + word[i + 1 :] for i in range(length) for s in (1, 2, 3)]
            edits += [word[:i] + [s] + word[i:] for i in range(length + 1) for s in (1, 2, 3)]
            expected = {int(S.hashes(np.array([e], np.uint64).reshape(1, len(e)))[0]) for e in edits}
            assert set(map(int, near)) == expected


def test_chains_of_forms(spark):
    # a chain of five words, each five times as common as the one before, and a tie
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb"]
    words = {w: 5 ** (i + 1) for i, w in enumerate(chain)} | {"zzzzzz": 5, "zzzzzy": 25, "yzzzzz": 25}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    found = S.forms(table, S.near_pairs(table))
    rows = {r.word: r.root for r in S.roots(found).collect()}
    assert rows == {w: "aabbbb" for w in chain[:-1]} | {"zzzzzz": "yzzzzz"}


def test_odd_rows(spark, make_docs, odd_docs, no_docs):
    rows = [(i, "Größe GRÖßE x÷y×zÀÿ banana bananas" + "'word' wordword1wordword") for i in range(8)] + [(None, "bananas")] * 3 + [(9, None), (9, ""), (9, "a" * 30_000 + " " + "a" * 29_999)] * 6
    got = as_dict(S.spelling_groups(make_docs(rows)).collect())
    assert got == brute(brute_words(rows))
    assert len(got["a" * 30_000][0] or "") in (0, 29_999) and got["a" * 30_000][3] == 1
    everything = [(r.doc_id, r.text) for r in odd_docs.collect()] * 5
    assert as_dict(S.spelling_groups(make_docs(everything)).collect()) == brute(brute_words(everything))
    assert S.spelling_groups(no_docs).collect() == []


def test_a_hot_word_is_counted_before_the_shuffle(spark, make_docs):
    docs = make_docs([(i, "common " * 50 + f"w{'abcdefghij'[i % 10]}rdword") for i in range(300)]).repartition(4)
    assert S.occurrences(docs).where("word = 'common'").count() <= 4
