import random

import numpy as np
import pytest

from ohlcflow.llm import ngram_join as J


def brute(rows, n, percent):
    sets = [J.grams(t or "", n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if sets[i] and (same or 100 * shared >= percent * len(sets[i] | sets[j])):
                if rows[i][0] is not None and rows[j][0] is not None:
                    parent[find(i)] = find(j)
    out = []
    for i, (doc, text) in enumerate(rows):
        if doc is None and sets[i]:
            twins = [k for k, (d, t) in enumerate(rows) if d is not None and J.split(t or "") == J.split(text)]
            ids = [rows[k][0] for k in range(len(rows)) if twins and rows[k][0] is not None and find(k) == find(twins[0])]
        else:
            ids = [rows[k][0] for k in range(len(rows)) if rows[k][0] is not None and find(k) == find(i) and (sets[k] or k == i)]
        out.append((doc, len(sets[i]), min(ids, default=doc)))
    return sorted(out, key=repr)


def edits(rng, words, k):
    w = list(words)
    for _ in range(k):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = rng.choices(vocabulary, k=40)
    rows = []
    for g in range(12):
        base = rng.choices(vocabulary, k=rng.choice([2, 3, 6, 40, 120, 300]))
        for _ in range(rng.choice([1, 2, 5])):
            rows.append(edits(rng, base, rng.choice([0, 0, 1, 2, 4])))
    long = rng.choices(vocabulary, k=200)
    rows += [edits(rng, long, rng.randrange(4)) for _ in range(60)]  # near copies of one another, for the most part
    rows += [" ".join(passage + rng.choices(vocabulary, k=rng.choice([1, 3, 9]))) for _ in range(30)]
    rows += ["", "one", "One", "two  words", None, "a b c", "A\tb\nc"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("n, percent, small", [(3, 90, 32), (3, 90, 3), (5, 80, 32), (5, 80, 2)])
def test_against_all_pairs(spark, make_docs, monkeypatch, n, percent, small):
    monkeypatch.setattr(J, "SMALL_GROUP", small)
    rows = corpus(n + small)
    got = sorted(map(tuple, J.near_duplicates(make_docs(rows), n, percent).collect()), key=repr)
    assert got == brute(rows, n, percent)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = sorted(map(tuple, J.near_duplicates(odd_docs).collect()), key=repr)
    assert got == brute(rows, 3, 90)
    assert J.near_duplicates(no_docs).count() == 0


def test_rows_with_equal_ids_are_one_node(spark, make_docs):
    rows = [(1, "a b c d e"), (2, "f g h i j"), (2, "a b c d e"), (3, "f g h i j"), (4, "other words here")]
    assert {r.doc_id: r.component_id for r in J.near_duplicates(make_docs(rows)).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_distance_bound_never_exceeds_the_distance():
    rng = np.random.default_rng(5)
    for size in (1, 5, 70, 900):
        for other in (size, size + 1, 2 * size, 5 * size):
            a, b = rng.integers(0, 3 * size + 9, size).astype(np.uint64), rng.integers(0, 3 * size + 9, other).astype(np.uint64)
            a, b = np.unique(a * J._MIX[0]), np.unique(b * J._MIX[0])
            assert J.distance_bound(J.bit_vector(a), J.bit_vector(b)) <= len(np.setxor1d(a, b))


def template_pages(n, words=42):
    base = [f"t{i}" for i in range(words)]
    return [(i, " ".join([*base[:20], f"own{i}", *base[21:]])) for i in range(n)]


def test_template_pages_make_no_pairs(spark, make_docs):
    """One differing word keeps two pages under the threshold: their common n-grams head no pair and are not joined."""
    rows = template_pages(300)
    signed = J.signatures(make_docs(rows), 3, 90).withColumnRenamed("doc_id", "rep")
    assert J.shared_grams(signed, 90).count() == 0
    assert {r.component_id for r in J.near_duplicates(make_docs(rows)).collect()} == set(range(300))
    # at a threshold that they reach they are one group
    assert {r.component_id for r in J.near_duplicates(make_docs(rows), 3, 85).collect()} == {0}


@pytest.mark.parametrize("percent", [50, 80, 90, 99, 100])
def test_sets_of_any_sizes_and_thresholds(spark, make_docs, monkeypatch, percent):
    monkeypatch.setattr(J, "SMALL_GROUP", 4)
    rng = random.Random(percent)
    words = [f"w{i}" for i in range(25)]
    base = [words[:k] for k in (4, 9, 14, 19, 24)]
    rows = [(i, " ".join(b[rng.randrange(3) : len(b) - rng.randrange(3)] + rng.choices(words, k=rng.randrange(3)))) for i, b in enumerate(rng.choices(base, k=90))]
    got = sorted(map(tuple, J.near_duplicates(make_docs(rows), 1, percent).collect()), key=repr)
    assert got == brute(rows, 1, percent)


def test_counts_are_added_up_in_a_tree(spark, make_docs, monkeypatch):
    docs = make_docs([(i, f"a b c d{i % 3}") for i in range(64)]).repartition(20)
    whole = J.rarity(docs, 3)
    monkeypatch.setattr(J, "FAN_IN", 3)
    assert (J.rarity(docs, 3) == whole).all() and whole.max() > 0


def test_distinct_documents_of_equal_and_null_ids(spark, make_docs):
    near = " ".join(f"w{i}" for i in range(40))
    rows = [(5, near + " x"), (5, "quite another text of its own"), (None, near), (None, near + " y"), (3, near), (None, ""), (None, None), (None, "alone and without an id")]
    docs = make_docs(rows)
    kept = J.distinct_documents(docs, 5, 80)
    assert kept.columns == docs.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(repr, [(3, near), (5, "quite another text of its own"), (None, ""), (None, None), (None, "alone and without an id")]))
