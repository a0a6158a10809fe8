import hashlib
import random
import zlib
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from ohlcflow.llm import queries as L
from ohlcflow.llm import turn_repair as R

SF_MEDIUM = "/root/testdata/sf0.01"
WHITE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, repaired rows) of (fault, role, text) rows by trying all edits."""
    to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

    @cache
    def best(i, state, inserted):
        options = []
        if i == len(rows):
            if state in (0, 3):
                options.append((0, "", ()))
        else:
            fault, role, text = rows[i]
            rest = best(i + 1, state, 0)
            options.append((2 + rest[0], "D" + rest[1], rest[2]))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                for initial, name in ((role[:1], role), ("u", "user"), ("a", "assistant")):
                    if (initial, state) in to:
                        rest = best(i + 1, to[initial, state], 0)
                        cost, edit = (0, "K") if name is role else (1, "R")
                        options.append((cost + more + rest[0], edit + rest[1], ((name, text), *rest[2])))
        if inserted < 3:
            for initial, name in (("u", "user"), ("a", "assistant")):
                if (initial, state) in to:
                    rest = best(i, to[initial, state], inserted + 1)
                    options.append((5 + rest[0], "I" + rest[1], ((name, ""), *rest[2])))
        return min(options, default=(10**9, "", ()))

    return best(0, 0, 0)


def brute(turns):
    out = {}
    for conv in {t[0] for t in turns}:
        rows = []
        for _, turn, role, text in (t for t in turns if t[0] == conv):
            role, text = (" " if x is None else x for x in (role, text))
            fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if fate == 1:
                text = ""
            elif fate == 2:
                text = text.translate({ord(c): None for c in ".!?"})
            elif fate == 4:
                role = "user"
            rows += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        numbers = [r[0] for r in rows if r[0] is not None]
        faults, seen = [], set()
        for _, role, text in rows:
            bare = text.strip(WHITE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, repaired = cheapest([(f, role, text) for f, (_, role, text) in zip(faults, rows, strict=True)])
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit,
            hashlib.sha256("\n".join(f"{role}:{text}" for role, text in repaired).encode()).hexdigest(),
        )
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def as_dict(rows):
    out = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def table(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("conv", "row", "copies", "segment", "symbol", "part", "at"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def test_query_equals_brute_force(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{SF_MEDIUM}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = L.op12_turn_repair(spark, SF_MEDIUM)
    assert got.dtypes == [("conv_id", "bigint"), *((c, "bigint") for c in COLUMNS[:6]), ("audit", "string"), ("repaired_sha256", "string")]
    assert as_dict(got.collect()) == brute(turns)


def random_turns(rng, convs, longest):
    texts = ["fine.", "fine!", "cut", "cut ", "", " \n", "ok?\t", "\x1c", "a\nb.", None, "é", "same."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    rows = []
    for conv in [*range(convs), None]:
        for _ in range(rng.randrange(1, longest)):
            rows.append((conv, rng.choice([None, *range(longest)]), rng.choice(roles), rng.choice(texts) or rng.choice([None, ""])))
            if rng.random() < 0.2:
                rows.append(rows[-1])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [3, 8, 4096])
def test_random_conversations_in_segments_of_any_size(spark, rows):
    turns = random_turns(random.Random(rows), 60, 40)
    assert as_dict(R.repair(table(spark, turns), rows).collect()) == brute(turns)


def test_hot_conversation_is_split(spark):
    rng = random.Random(1)
    turns = [(7, i, rng.choice(["user", "assistant"]), f"text {rng.randrange(400)}" + rng.choice([".", "", "?"])) for i in range(900)]
    turns += [(7, 5000, "user", "one text.")] * 600 + random_turns(rng, 20, 10)
    df = table(spark, turns).repartition(5)
    faults = R.Faults(placed := R.placed(R.damage(df)))
    sizes = placed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 700  # of about 1100 distinct rows, 800 of them in one conversation
    parts = R.segments(faults, 64)
    assert parts.agg(F.max("length")).first()[0] == 64 and parts.agg(F.max(F.size("ats"))).first()[0] <= 64
    import sys

    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(20_000)
    try:
        expected = brute(turns)
    finally:
        sys.setrecursionlimit(limit)
    assert as_dict(R.repair(df, 64).collect()) == expected


def test_tables_equal_single_steps():
    tables, rng = R.tables(), np.random.default_rng(3)
    assert len(tables.vectors) < 100
    for _ in range(300):
        symbols = rng.integers(0, R.SYMBOLS, rng.integers(0, 15))
        costs = tables.vectors[0]
        for symbol in reversed(symbols.tolist()):
            costs = R.before(costs, symbol)
        _, front, total = tables.passed(symbols, 0)
        assert tuple(c + total for c in tables.vectors[front]) == costs
        assert tables.effect(symbols)[0] == front


def test_repaired_turns(spark):
    turns = [(1, 0, "assistant", "Hello."), (1, 1, "user", "A?"), (1, 2, "tool", "B."), (1, 3, "user", "C.")]
    rows = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, copies long")
    placed = R.placed(rows)
    edits = R.solved(R.segments(R.Faults(placed)))
    got = [(r.role, r.text) for r in R.repaired_turns(placed, edits).orderBy("conv", F.col("row").asc_nulls_last(), "at").collect()]
    cost, audit, expected = cheapest([("", role, text) for _, _, role, text in turns])
    assert tuple(got) == expected
    (e,) = edits.collect()
    assert (e.cost, e.audit) == (cost, audit)


def test_odd_tables(spark):
    rows = [(None, None, None, None), (1, 0, "user", "x" * 200_000 + " " * 100_000), (2, None, "", "\x85"), (3, 1, "user", None)]
    assert as_dict(R.repair(table(spark, rows)).collect()) == brute(rows)
    assert R.repair(table(spark, rows).where("conv_id = 99")).collect() == []
    # a conversation that loses all its rows
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = R.repair(table(spark, [(lost, 0, "user", "Hi.")])).collect()
    assert tuple(row)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
