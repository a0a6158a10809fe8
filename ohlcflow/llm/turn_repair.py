"""Repair of the turn structure of conversations by least-cost edits.

The roles of a sound conversation read ``s?(ua)+`` or nothing. Keep costs 0,
Rerole 1, Delete 2 and Insert 5; blank and duplicate rows must go, and a
truncated row that stays costs 5 more. The cheapest edits come from a vector of
four costs, one a state of that expression, that each row moves.

Four-Russians block tables: less their smallest element, only a few dozen
vectors ever occur, and a row is one of nine symbols. For every such vector and
every block of ``BLOCK`` symbols the tables hold the vector on the other side
and what it adds, so rows are read ``BLOCK`` at a time, from the last to the
first: a vector then says what the rows still to come cost. Blocks are
afterwards expanded against that direction, from the first row on, each step
taking the ASCII-least edit that keeps to the least cost; so ties are settled
exactly and no choice is stored.

No conversation is gathered in a task. Copies are merged before the shuffle
and counted; rows lie in range partitions of (conversation, turn, role, text),
which cut a large conversation; positions are sums of partitions. Rows that
are no duplicates are the least positions of their (role, text); all others
are deleted, so nothing is joined back on a common text. A conversation is cut
into segments of at most ``SEGMENT`` rows. A segment's effect is a map of the
few dozen vectors, and its trace one of the four states, so the segments of
a long conversation are solved in parallel and linked by two passes that read
one small row a segment. Only the SHA-256 of a repaired conversation reads it
in order, as a stream.

Null roles and texts are one space, as are null ids and turns in the hash that
decides the damage; rows with a null ``conv_id`` are one conversation, whose id
stays null. Null turns come first; rows of one turn are ordered by role and
text, copies lie together. A role counts by its first character; one that is
not s, u or a (or is empty) fits nowhere until it is changed. Texts are read
whole, however long. Only the four named columns are read, so others may have any
name. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ohlcflow.llm.common import materialize, record_batch

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: Symbols of a block, and the most rows of a segment.
BLOCK, SEGMENT = 4, 4096
WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"

# States: nothing yet, after system, after user, after assistant.
_ROLE_AFTER = {2: "user", 3: "assistant"}
_INSERTED = (2, 2, 3, 2)  # the state that the one insertion possible leads to
_ACCEPTING = (0, 3)
_KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
_INITIALS = "sua"
#: Symbol of a row that must go; others are 1 + 2 * (place of the initial in "sua", or 3) + (1 if truncated).
GONE, SYMBOLS = 0, 9


def row_edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row, in ASCII order of the edits."""
    edits = [("D", DELETE, state)]
    if symbol != GONE:
        initial, cut = divmod(symbol - 1, 2)
        if initial < len(_INITIALS) and (_INITIALS[initial], state) in _KEPT:
            edits.append(("K", KEEP + CUT * cut, _KEPT[_INITIALS[initial], state]))
        edits.append(("R", REROLE + CUT * cut, _INSERTED[state]))
    return edits


def _with_insertions(costs: list[int]) -> tuple[int, ...]:
    for _ in range(2):  # two insertions visit every state that more would
        costs = [min(c, INSERT + costs[_INSERTED[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def before(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Least costs before a row, by state, from those behind it."""
    return _with_insertions([min(cost + costs[to] for _, cost, to in row_edits(symbol, q)) for q in range(4)])


class Tables:
    """All normalised vectors, and where one symbol or one block takes each."""

    def __init__(self):
        start = _with_insertions([0 if q in _ACCEPTING else 10**6 for q in range(4)])
        self.vectors, known, steps = [start], {start: 0}, []
        for vector in self.vectors:  # grows while it is read
            row = []
            for symbol in range(SYMBOLS):
                costs = before(vector, symbol)
                least = min(costs)
                costs = tuple(c - least for c in costs)
                if costs not in known:
                    known[costs] = len(self.vectors)
                    self.vectors.append(costs)
                row.append((known[costs], least))
            steps.append(row)
        self.to = np.array([[a for a, _ in row] for row in steps], np.int64)
        self.add = np.array([[b for _, b in row] for row in steps], np.int64)
        # a block's number has its first symbol as the highest digit; its last symbol is applied first
        self.block_to, self.block_add = self.to, self.add
        for _ in range(BLOCK - 1):
            longer = self.to[self.block_to]  # vector, block, symbol in front of it
            added = self.block_add[:, :, None] + self.add[self.block_to]
            self.block_to, self.block_add = (np.ascontiguousarray(t.transpose(0, 2, 1).reshape(len(t), -1)) for t in (longer, added))
        self.traced: dict[tuple, tuple] = {}

    def blocks(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        """The numbers of the whole blocks from the front, and the symbols left over behind them."""
        whole = len(symbols) // BLOCK * BLOCK
        digits = symbols[:whole].reshape(-1, BLOCK).astype(np.int64)
        return (digits @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist(), symbols[whole:].tolist()

    def effect(self, symbols: np.ndarray) -> np.ndarray:
        """The vector before the symbols for every vector behind them."""
        numbers, rest = self.blocks(symbols)
        now = np.arange(len(self.vectors))
        for symbol in reversed(rest):
            now = self.to[now, symbol]
        for number in reversed(numbers):
            now = self.block_to[now, number]
        return now

    def passed(self, symbols: np.ndarray, last: int) -> tuple[list[tuple[tuple[int, ...], int]], int, int]:
        """(symbols of a block, vector behind it) from the front; the first vector; what all blocks add."""
        numbers, rest = self.blocks(symbols)
        now, total, parts = last, 0, []
        for symbol in reversed(rest):
            parts.append(((symbol,), now))
            total += int(self.add[now, symbol])
            now = int(self.to[now, symbol])
        for number in reversed(numbers):
            parts.append((number, now))
            total += int(self.block_add[now, number])
            now = int(self.block_to[now, number])
        return parts[::-1], now, total

    def expand(self, part: int | tuple[int, ...], behind: int, state: int) -> tuple[str, list[tuple[int, str, str | None]], int]:
        """ASCII-least cheapest edits of a block from ``state``: the edits, (row, inserted before it, new role) of those that stay, the state behind."""
        if (found := self.traced.get((part, behind, state))) is not None:
            return found
        key = part, behind, state
        symbols = part if isinstance(part, tuple) else tuple(part // SYMBOLS**k % SYMBOLS for k in range(BLOCK - 1, -1, -1))
        costs = [self.vectors[behind]]
        for symbol in reversed(symbols):
            costs.append(before(costs[-1], symbol))
        costs.reverse()
        edits, stays = "", []
        for i, symbol in enumerate(symbols):
            inserted = ""
            while True:
                least = costs[i][state]
                options = [(e, c + costs[i + 1][to], to) for e, c, to in row_edits(symbol, state)]
                options.append(("I", INSERT + costs[i][_INSERTED[state]], _INSERTED[state]))
                edit, _, to = min(o for o in options if o[1] == least)
                edits += edit
                state = to
                if edit != "I":
                    break
                inserted += "nsua"[to]
            if edit != "D":
                stays.append((i, inserted, _ROLE_AFTER[to] if edit == "R" else None))
        self.traced[key] = edits, stays, state
        return self.traced[key]


@cache
def tables() -> Tables:
    return Tables()


def trace(parts: list, state: int) -> tuple[list[str], list[tuple[int, str, str | None]], int]:
    """Edits and staying rows of blocks in order, and the state behind them."""
    edits, stays, at = [], [], 0
    for part, behind in parts:
        some, kept, state = tables().expand(part, behind, state)
        edits.append(some)
        stays.extend((at + i, inserted, role) for i, inserted, role in kept)
        at += len(part) if isinstance(part, tuple) else BLOCK
    return edits, stays, state


def tail(state: int) -> str:
    """Initials of the rows to insert behind the last row."""
    added = ""
    while state not in _ACCEPTING:
        state = _INSERTED[state]
        added += "nsua"[state]
    return added


def conversation_key(conv_id: Column) -> Column:
    """A key without nulls."""
    return F.when(conv_id.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of ``turns`` with the damage that crc32(conv_id:turn) decides."""
    space = F.lit(" ")
    fate = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text = F.coalesce("text", space)
    return turns.withColumn("_fate", fate).where("_fate <> 0").select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(F.col("_fate") == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("_fate") == 1, F.lit("")).when(F.col("_fate") == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(F.col("_fate") == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"),
    )


def placed(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies, row): each distinct row once; ``row`` rises with (conv, turn, role, text)."""
    order = ["conv", "turn", "role", "text"]
    merged = rows.select(conversation_key(F.col("conv_id")).alias("conv"), "turn", "role", "text", "copies").groupBy(*order).agg(F.sum("copies").alias("copies"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = merged.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return materialize(ranged.withColumn("row", F.monotonically_increasing_id()), "turns-placed")


class Faults:
    """What the rows of each conversation are, as tables without texts."""

    def __init__(self, rows: DataFrame):
        bare = F.rtrim("text", F.lit(WHITE))
        initial = F.substring("role", 1, 1)
        number = F.coalesce(*[F.when(initial == c, F.lit(i)) for i, c in enumerate(_INITIALS)], F.lit(len(_INITIALS)))
        cut = (~F.right(bare, F.lit(1)).isin(*ENDS)).cast("int")
        lean = rows.select(
            "conv", "turn", "copies", "row",
            F.shiftright("row", 33).alias("part"),  # the partition, in the order of rows
            initial.alias("initial"),
            (bare == "").alias("blank"),
            (1 + 2 * number + cut).cast("int").alias("symbol"),
            F.unhex(F.sha2(F.concat_ws(":", F.char_length("role"), "role", "text"), 256)).alias("said"),
        )
        inside = Window.partitionBy("conv", "part").orderBy("row")
        self.lean = materialize(
            lean.withColumn("place", F.sum("copies").over(inside) - F.col("copies")).withColumn("last", F.lag("initial").over(inside)),
            "turns-lean",
        )
        parts = self.lean.groupBy("conv", "part").agg(
            F.sum("copies").alias("n"),
            F.sum(_illegal("last", "initial") + F.col("copies") - 1).alias("illegal"),  # copies side by side are never legal
            F.min_by("initial", "row").alias("first_initial"),
            F.max_by("initial", "row").alias("last_initial"),
        )
        along = Window.partitionBy("conv").orderBy("part")
        before_it = along.rowsBetween(Window.unboundedPreceding, -1)
        self.parts = materialize(
            parts.withColumn("base", F.coalesce(F.sum("n").over(before_it), F.lit(0)))
            .withColumn("_last", F.lag("last_initial").over(along))
            .withColumn("illegal", F.col("illegal") + _illegal("_last", "first_initial")),
            "turns-parts",
        )
        #: (conv, n_rows, illegal)
        self.sizes = self.parts.groupBy("conv").agg(F.sum("n").alias("n_rows"), F.sum("illegal").alias("illegal"))
        firsts = self.lean.where("not blank").groupBy("conv", "said").agg(F.min(F.struct("row", "part", "place", "symbol")).alias("f"))
        #: (conv, row, at, symbol): the rows that may stay, each with its position in the conversation
        self.firsts = materialize(
            firsts.select("conv", "f.*").join(self.parts.select("conv", "part", "base"), ["conv", "part"]).select("conv", "row", (F.col("base") + F.col("place")).alias("at"), "symbol"),
            "turns-firsts",
        )

    def counts(self) -> DataFrame:
        """(conv, gaps, blank, duplicate, truncated, illegal)"""
        turns = self.lean.groupBy("conv").agg(
            (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"),
            F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        )
        kinds = self.firsts.groupBy("conv").agg(F.count(F.lit(1)).alias("firsts"), F.sum((F.col("symbol") % 2 == 0).cast("long")).alias("truncated"))
        none = F.lit(0).cast("long")
        return turns.join(self.sizes, "conv").join(kinds, "conv", "left").select(
            "conv",
            F.coalesce("gaps", none).alias("gaps"),
            "blank",
            (F.col("n_rows") - F.col("blank") - F.coalesce("firsts", none)).alias("duplicate"),
            F.coalesce("truncated", none).alias("truncated"),
            "illegal",
        )


def _illegal(one: str, two: str) -> Column:
    """1 if both rows are there and their initials may not follow each other."""
    pair = F.concat(F.col(one), F.col(two))
    return F.coalesce((~((F.length(one) == 1) & pair.isin("su", "ua", "au"))).cast("long"), F.lit(0).cast("long"))


def segments(faults: Faults, rows: int = SEGMENT) -> DataFrame:
    """(conv, segment, n_segments, length, ats, symbols, rows): at most ``rows`` positions each; those not in ``ats`` must go."""
    every = faults.sizes.select("conv", "n_rows", F.ceil(F.col("n_rows") / rows).alias("n_segments")).select(
        "conv", "n_rows", "n_segments", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_segments") - 1)).alias("segment")
    )
    some = faults.firsts.groupBy("conv", F.expr(f"at div {rows}").alias("segment")).agg(F.sort_array(F.collect_list(F.struct((F.col("at") % rows).alias("at"), "symbol", "row"))).alias("some"))
    return every.join(some, ["conv", "segment"], "left").select(
        "conv", "segment", "n_segments",
        F.least(F.lit(rows), F.col("n_rows") - rows * F.col("segment")).alias("length"),
        F.coalesce("some.at", F.array().cast("array<long>")).alias("ats"),
        F.coalesce("some.symbol", F.array().cast("array<int>")).alias("symbols"),
        F.coalesce("some.row", F.array().cast("array<long>")).alias("rows"),
    )


def _symbols(length: int, ats: list[int], symbols: list[int]) -> np.ndarray:
    out = np.full(length, GONE, np.int64)
    out[ats] = symbols
    return out


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of the batches, a few segments at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            yield list(zip(*(c.to_pylist() for c in batch.slice(k, 256).columns), strict=True))


def _linked(links: DataFrame, direction: str, first: int) -> DataFrame:
    """(conv, segment, value): ``to`` arrays of the segments of each conversation applied in turn, from ``first`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", pa.string()), ("segment", pa.int64()), ("value", pa.int64())])
        conv, value = None, first
        for rows in _each(batches):
            out = []
            for key, segment, to in rows:
                if key != conv:
                    conv, value = key, first
                out.append((key, segment, value))
                value = to[value]
            yield record_batch(schema, list(zip(*out, strict=True)))

    order = F.col("segment").desc() if direction == "backward" else F.col("segment").asc()
    return links.repartition("conv").sortWithinPartitions("conv", order).mapInArrow(run, "conv string, segment long, value long")


def solved(parts: DataFrame) -> DataFrame:
    """(conv, segment, audit, cost, stays) of ``segments``; ``stays`` are the rows that stay, with the initials inserted before each and its new role."""
    parts = materialize(parts, "turns-segments")
    long = parts.where("n_segments > 1")

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", pa.string()), ("segment", pa.int64()), ("to", pa.list_(pa.int64()))])
        for rows in _each(batches):
            out = [(conv, segment, tables().effect(_symbols(*rest)).tolist()) for conv, segment, *rest in rows]
            yield record_batch(schema, list(zip(*out, strict=True)))

    columns = ["conv", "segment", "length", "ats", "symbols"]
    behind = materialize(_linked(long.select(*columns).mapInArrow(effects, "conv string, segment long, to array<long>"), "backward", 0), "turns-behind")
    long = long.join(behind.withColumnRenamed("value", "behind"), ["conv", "segment"])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", pa.string()), ("segment", pa.int64()), ("to", pa.list_(pa.int64()))])
        for rows in _each(batches):
            out = []
            for conv, segment, length, ats, symbols, last in rows:
                passed, _, _ = tables().passed(_symbols(length, ats, symbols), last)
                out.append((conv, segment, [trace(passed, state)[2] for state in range(4)]))
            yield record_batch(schema, list(zip(*out, strict=True)))

    started = materialize(_linked(long.select(*columns, "behind").mapInArrow(ends, "conv string, segment long, to array<long>"), "forward", 0), "turns-started")
    linked = behind.withColumnRenamed("value", "behind").join(started.withColumnRenamed("value", "state"), ["conv", "segment"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stay = pa.struct([("row", pa.int64()), ("inserted", pa.string()), ("role", pa.string())])
        schema = pa.schema([("conv", pa.string()), ("segment", pa.int64()), ("audit", pa.string()), ("cost", pa.int64()), ("stays", pa.list_(stay))])
        for rows in _each(batches):
            out = []
            for conv, segment, length, ats, symbols, ids, count, last, state in rows:
                passed, front, cost = tables().passed(_symbols(length, ats, symbols), last)
                edits, stays, after = trace(passed, state)
                if segment == 0:
                    cost += tables().vectors[front][0]
                row_at = dict(zip(ats, ids, strict=True))
                kept = [{"row": row_at[at], "inserted": inserted, "role": role} for at, inserted, role in stays]
                if segment == count - 1 and (added := tail(after)):
                    edits.append("I" * len(added))
                    kept.append({"row": None, "inserted": added, "role": None})
                out.append((conv, segment, "".join(edits), cost, kept))
            yield record_batch(schema, list(zip(*out, strict=True)))

    none = F.lit(0).cast("long")
    ready = parts.join(linked, ["conv", "segment"], "left").select(*columns, "rows", "n_segments", F.coalesce("behind", none), F.coalesce("state", none))
    return ready.mapInArrow(solve, "conv string, segment long, audit string, cost long, stays array<struct<row: long, inserted: string, role: string>>")


def repaired_turns(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv, row, at, role, text): the repaired conversations in the order of (row, at); inserted rows have an empty text, those behind all others a null row."""
    stays = edits.select("conv", F.explode("stays").alias("s")).select("conv", "s.*")
    kept = stays.where("row is not null").select("row", F.col("role").alias("new_role"))
    texts = rows.select("conv", "row", "role", "text").join(kept, "row")
    texts = texts.select("conv", "row", F.lit(2**30).alias("at"), F.coalesce("new_role", "role").alias("role"), "text")
    added = stays.where("inserted <> ''").select("conv", "row", F.posexplode(F.split("inserted", "")).alias("at", "initial"))
    role = F.when(F.col("initial") == "u", F.lit("user")).otherwise(F.lit("assistant"))
    return texts.unionAll(added.select("conv", "row", "at", role.alias("role"), F.lit("").alias("text")))


def digests(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of ``repaired_turns``: a running hash over a stream in order, no conversation held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])
        conv, sha = None, hashlib.sha256()
        for batch in batches:
            done = []
            for key, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != conv:
                    if conv is not None:
                        done.append((conv, sha.hexdigest()))
                    conv, sha = key, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            if done:
                yield record_batch(schema, list(zip(*done, strict=True)))
        if conv is not None:
            yield record_batch(schema, [[conv], [sha.hexdigest()]])

    order = ["conv", F.col("row").asc_nulls_last(), "at"]
    return turns.repartition("conv").sortWithinPartitions(*order).select("conv", "role", "text").mapInArrow(run, "conv string, repaired_sha256 string")


def repair(turns: DataFrame, rows: int = SEGMENT) -> DataFrame:
    """Every conv_id of ``turns`` with the faults of its damaged rows, the edits that repair them, their cost and the result's hash."""
    found = turns.groupBy("conv_id").agg(F.first(conversation_key(F.col("conv_id"))).alias("conv"))
    table = placed(damage(turns))
    faults = Faults(table)
    edits = materialize(solved(segments(faults, rows)), "turns-edits")
    whole = edits.groupBy("conv").agg(
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("segment", "audit"))), lambda s: s["audit"]), "").alias("audit"),
    )
    out = found.join(faults.counts(), "conv", "left").join(whole, "conv", "left").join(digests(repaired_turns(table, edits)), "conv", "left")
    zero = F.lit(0).cast("long")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id",
        *[F.coalesce(c, zero).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
