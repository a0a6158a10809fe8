"""Packing documents into sequences of bounded length: best-fit decreasing.

Overlong documents are first cut into full windows, each a sequence of its own
that is never moved; what is left of each document, and each shorter document,
is one piece. Pieces are dealt at random, by a hash of their row numbers, into
shards of about ``PIECES`` rows and each shard packs its own: pieces in
order of falling length go to the open window with the least room that still
holds them, found by a segment tree over remaining capacity. Dealing at random
gives every shard the same mix of lengths, so a shard wastes no more than its
last few windows. No text and no id is shuffled, only (id, start, length).

Nulls: a null text is empty (its end id alone is packed); a null id is packed
like any other. Repeated rows are packed each, in any shards. Other columns are not read. An
empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohlcflow.llm.common import chunks, map_batches, materialize, record_batch
from ohlcflow.llm.tokens import encoder, vocabulary

#: Pieces dealt to a shard.
PIECES = 16_384
#: Words that the encoder remembers here: the worker keeps them when other steps of a job run in it (about 250 bytes each).
MEMO_WORDS = 300_000


class OpenWindows:
    """Open windows by remaining capacity; a segment tree finds the tightest that fits."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)  # windows at or below each node
        self.at: dict[int, list[int]] = {}

    def _count(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.tree[i] += by
            i >>= 1

    def add(self, window: int, room: int) -> None:
        if room:
            self.at.setdefault(room, []).append(window)
            self._count(room, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out the window with the least room of at least ``length``: (window, room)."""
        i = length + self.size
        while not self.tree[i]:
            while i & 1:  # no right sibling below this parent
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.tree[2 * i] else 2 * i + 1
        room = i - self.size
        self._count(room, -1)
        return self.at[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(window, offset) of each piece; ``lengths`` must fall and be at most ``capacity``."""
    free, windows, offsets, made = OpenWindows(capacity), [], [], 0
    for n in lengths:
        window, room = free.tightest(n) or (made, capacity)
        made += window == made
        windows.append(window)
        offsets.append(capacity - room)
        free.add(window, room - n)
    return windows, offsets


def cut(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: doc_id, start, length, ids_crc32, doc_tokens (and the ids as unsigned 32 bits)."""
    tokenizer = tokenizer or vocabulary()
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = pa.schema([(n, pa.int64()) for n in columns] + [("ids", pa.binary())] * with_ids)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer, MEMO_WORDS)
        for (doc_ids,), texts in chunks(batches):
            rows = []
            for doc, ids in zip(doc_ids, codec.encode(texts, end_id), strict=True):
                raw = ids.astype("<u4").tobytes()
                for start in range(0, len(ids), capacity):
                    part = raw[4 * start : 4 * (start + capacity)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), len(ids), *[part] * with_ids))
            yield record_batch(schema, list(zip(*rows, strict=True)))

    return map_batches(docs.select("doc_id", "text"), pieces, ", ".join(f"{c} long" for c in columns) + ", ids binary" * with_ids)


def pack(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset`` there; at most ``capacity`` tokens a sequence."""
    cuts = cut(docs, capacity, tokenizer, end_id, with_ids)
    numbered = materialize(cuts.withColumn("row", F.monotonically_increasing_id()), "pieces")
    pieces = numbered.where(F.col("length") < capacity)
    shards = max(1, -(-pieces.count() // PIECES))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).drop("row")

    def fill(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        windows, offsets = best_fit_decreasing(shard["length"].tolist(), capacity)
        shard["sequence_id"] = 2 * (np.array(windows, np.int64) * shards + shard["shard"].to_numpy()) + 1
        shard["offset"] = np.array(offsets, np.int64)
        return shard.drop(columns="shard")

    out = ", ".join(f"{n} {t}" for n, t in cuts.dtypes) + ", sequence_id long, offset long"
    packed = dealt.groupBy("shard").applyInPandas(fill, out.replace("bigint", "long"))
    # a full window is a sequence: even numbers are theirs
    full = numbered.where(F.col("length") == capacity).withColumns({"sequence_id": 2 * F.col("row"), "offset": F.lit(0).cast("long")})
    return packed.unionAll(full.select(packed.columns))


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves (``pack(..., with_ids=True)``): sequence_id, n_tokens, ids array; at most ``capacity`` ids each."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("sequence_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int64()))])
        for batch in batches:
            ids = [np.frombuffer(b"".join(p["ids"] for p in x), "<u4").astype(np.int64) for x in batch.column(1).to_pylist()]
            yield record_batch(schema, [batch.column(0).to_pylist(), [len(x) for x in ids], ids])

    return (
        packed.groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("pieces"))
        .mapInArrow(join, "sequence_id long, n_tokens long, ids array<long>")
    )
