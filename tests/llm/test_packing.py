import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from ohlcflow.llm.packing import best_fit_decreasing, pack, sequences
from ohlcflow.llm.tokens import vocabulary


def plain_best_fit(lengths, capacity):
    rooms, out = [], []
    for n in lengths:
        fits = [r for r in rooms if r >= n]
        room = min(fits, default=capacity)
        if fits:
            rooms.remove(room)
        rooms.append(room - n)
        out.append(capacity - room)
    return out, len(rooms)


def test_segment_tree_finds_the_tightest_window():
    rng = random.Random(1)
    for capacity in (1, 2, 7, 64, 100):
        for _ in range(30):
            lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 80))), reverse=True)
            windows, offsets = best_fit_decreasing(lengths, capacity)
            want, used = plain_best_fit(lengths, capacity)
            assert offsets == want and len(set(windows)) == used


def test_every_id_once_and_no_gap(spark, odd_docs):
    capacity = 64
    got = [r.asDict() for r in pack(odd_docs, capacity, end_id=2, with_ids=True).collect()]
    t = Tokenizer.from_file(vocabulary())
    for doc in {r["doc_id"] for r in got}:
        texts = [r.text or "" for r in odd_docs.where(odd_docs.doc_id.eqNullSafe(doc)).collect()]
        ids = t.encode(texts[0], add_special_tokens=False).ids + [2]
        mine = sorted((r for r in got if r["doc_id"] == doc), key=lambda r: r["start"])
        for text in texts[1:]:  # repeated rows: each piece as often
            assert text == texts[0]
        assert sorted(r["start"] for r in mine) == sorted(list(range(0, len(ids), capacity)) * len(texts))
        for r in mine:
            part = np.array(ids[r["start"] : r["start"] + capacity], "<u4")
            assert r["length"] == len(part) and r["doc_tokens"] == len(ids) and r["ids"] == part.tobytes()
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    whole = sequences(pack(odd_docs, capacity, end_id=2, with_ids=True)).collect()
    assert sorted(r.n_tokens for r in whole) == sorted(sum(n for _, n in s) for s in by.values())
    assert all(len(r.ids) == r.n_tokens for r in whole)


def test_little_padding_and_empty(spark, make_docs, no_docs):
    docs = make_docs([(i, "word " * (i * 37 % 900)) for i in range(800)])
    got = pack(docs, 1024).groupBy("sequence_id").sum("length").toPandas()
    assert got["sum(length)"].sum() / (len(got) * 1024) > 0.99
    assert pack(no_docs).count() == 0
