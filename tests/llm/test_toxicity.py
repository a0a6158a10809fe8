import random

import pytest

from ohlcflow.llm import toxicity as T

SYLLABLES = "ra le mi ton ver sa ku pel no dri est ing".split()
INSULTS = ["grobbler", "snivelkin", "muckwit", "fetterling"]


@pytest.fixture(scope="module")
def data():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(900):
        sentences = [" ".join(word() for _ in range(rng.randint(4, 12))) for _ in range(rng.randint(2, 6))]
        toxic = i % 6 == 0
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(INSULTS) + " " + word()
        docs.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def machine(spark, data):
    docs, labels = data
    known = [x for x in labels if x[0] % 5]
    return T.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(known, "doc_id long, toxic int"))


def test_held_out_accuracy(spark, data, machine):
    docs, labels = data
    got = {r.doc_id: r for r in T.score(spark.createDataFrame(docs, "doc_id long, text string"), machine).collect()}
    held = [(got[i].predicted, y) for i, y in labels if i % 5 == 0]
    assert sum(p == y for p, y in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_gaps_and_insertions_are_tolerated(machine):
    clean = "ra leton verest kuing saleno"
    ms = T.Scorer(machine).margins([clean] + [f"{clean} {x} {clean}" for x in ("grobbler", "GROBBLER!", "grob.bler", "g r o b b l e r", "grobxbler", "gr0bbler", "grobblers")])
    assert machine.score(ms[0]) < 0.5
    assert all(machine.score(m) >= 0.5 for m in ms[1:])


def test_a_whole_text_is_scored(machine):
    clean = "raleton verest " * 20_000
    a, b, c = T.Scorer(machine).margins([clean, clean + "muckwit", "raleton" * 9_000 + "muckwit"])
    assert machine.score(a) < 0.5 <= machine.score(b) and c > a


def test_folding_equals_the_kernel(machine):
    marks, ws = ["grobbler", "raleton", "abc"], ["grobxler", "xyz", "leton", "grobbler"]
    phi, root = T.nystrom(marks)
    direct = T.features(ws) @ phi.T @ root
    assert abs(T.folded(ws, (phi.T @ root).astype("f4")) - direct).max() < 1e-4
    k = T.features(["grobbler"]) @ T.features(["grobbler"]).T
    assert k[0, 0] >= 1 - 1e-6 > (T.features(["grobbler"]) @ T.features(["grobxbler"]).T)[0, 0]


def test_odd_rows(spark, odd_docs, no_docs, machine):
    got = [tuple(r) for r in T.score(odd_docs, machine).collect()]
    assert len(got) == 12 and all(0 <= s < 0.5 and not p for _, s, p in got)
    assert T.score(no_docs, machine).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(3, 1), (None, 0), (77, None)], "doc_id long, toxic int")
    for labels in (none, one):
        assert {r.score for r in T.score(odd_docs, T.fit(odd_docs, labels)).collect()} == {0.0}


def test_split_and_spaced_insults(machine):
    clean = "ra leton verest kuing saleno"
    bad = ["grob bler", "muck  wit", "snivel\nkin", "fet ter ling", "g  r  o  b  b  l  e  r", "g\nr\no\nb\nb\nl\ne\nr", "m. u. c. k. w. i. t."]
    ms = T.Scorer(machine).margins([clean] + [f"{clean} {x} {clean}" for x in bad])
    assert machine.score(ms[0]) < 0.5
    assert [x for x, m in zip(bad, ms[1:], strict=True) if machine.score(m) < 0.5] == []


def test_insults_of_harmless_words_held_out(spark, data):
    """Every word occurs in clean sentences too; only the phrases are toxic."""
    rng, phrases = random.Random(9), ["waste of oxygen", "gone off cheese", "half a brain"]
    docs, labels = [], []
    for i, text in data[0]:
        text = text if i % 6 else " ".join(w for w in text.split() if w.strip(".") not in INSULTS)
        ws, toxic = text.split(), i % 6 == 0
        k = rng.randrange(1, len(ws))
        ws[k:k] = rng.choice(phrases).split() if toxic else [rng.choice("waste of oxygen gone off cheese half a brain".split())]
        docs.append((i, " ".join(ws)))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    machine = T.fit(df, spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, toxic int"))
    got = {r.doc_id: r.predicted for r in T.score(df, machine).collect()}
    held = [(got[i], y) for i, y in labels if i % 5 == 0]
    assert sum(p == y for p, y in held) / len(held) > 0.95


def test_running_sums_equal_the_windows_one_by_one(machine):
    texts = ["Grob.bler's, raleton -- «muck» wit!", "i d\n i o  t " + "ab" * 40, "", " ...", "no", "ß x一y\U0001f600zz 5h1t", "tonver " * 30 + "z"]
    for text, got in zip(texts, T.Scorer(machine).both(texts), strict=True):
        low = text.lower()
        for ws, m in zip(({x for w in [*T.words(low), *T.spaced(low)] for x in T.windows(w)}, T.spans(low)), got, strict=True):
            assert abs(m - max([T.LEAST, *machine.margins(sorted(ws)).tolist()] if ws else [T.LEAST])) < 1e-4


def test_blocks_of_a_long_text_share_words(machine, monkeypatch):
    text = "raleton verest " * 50 + "grob bler " + "saleno kuing " * 50 + "x" * 900 + " m u c k w i t " + "verest " * 90
    whole = T.Scorer(machine).margins([text])
    for size in (500, 701, 1000):
        monkeypatch.setattr(T, "BLOCK", size)
        assert T.Scorer(machine).margins([text]) == pytest.approx(whole, abs=1e-6)


def test_held_out_labels_by_language(spark):
    """Figures of the labelled documents held out of training; the language serves the report only."""
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    got = T.score(docs.where(held), T.fit(docs, labels.where(~held))).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    by = {r.lang: r for r in got.groupBy("lang").agg(F.sum("toxic").alias("bad"), F.sum(F.col("predicted") * F.col("toxic")).alias("hit"), F.sum(1 - F.col("toxic")).alias("fine"), F.sum(F.col("predicted") * (1 - F.col("toxic"))).alias("wrong")).collect()}
    print({k: (r.hit, r.bad, r.wrong, r.fine) for k, r in by.items()})
    assert all(r.hit >= 0.85 * r.bad for r in by.values() if r.bad >= 10)
    assert sum(r.wrong for r in by.values()) <= 0.01 * sum(r.fine for r in by.values())


def test_families_of_rare_forms(spark):
    """No form of a stem is common, some occur in clean texts by chance, and held-out texts have forms never seen."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))
    forms = [f"zorgub{a}{b}" for a in SYLLABLES for b in ("", "en", "is")]
    docs, labels = [], []
    for i in range(900):
        ws = [word() for _ in range(60)]
        toxic = i % 6 == 0
        for _ in range(4 if toxic else rng.random() < 0.1):
            ws.insert(rng.randrange(60), rng.choice(forms if i % 5 == 0 else forms[:-9]))
        docs.append((i, ". ".join(" ".join(ws[k : k + 12]) for k in range(0, len(ws), 12))))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in T.score(df, T.fit(df, spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, toxic int"))).collect()}
    held = [(got[i], y) for i, y in labels if i % 5 == 0]
    assert sum(p == y for p, y in held) / len(held) > 0.98


def test_landmarks_are_spread_over_families():
    ws = [f"achlich{a}" for a in SYLLABLES] + ["moron", "idiot"] + [f"bomente{a}" for a in SYLLABLES]
    first = T.spread(ws, 4)
    assert {w[:3] for w in first} == {"ach", "mor", "idi", "bom"}
    assert len(set(T.spread(ws, 100))) == len(T.spread(ws, 100)) <= len(ws) and T.spread([], 5) == []
