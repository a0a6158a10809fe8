import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from ohlcflow.llm.token_files import TokenReader, read_index, read_token_files, write_token_files
from ohlcflow.llm.tokens import WordEncoder, vocabulary


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def brute(rows, end):
    t, out, start = Tokenizer.from_file(vocabulary()), [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = t.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_round_trip(spark, odd_docs, tmp_path):
    path = str(tmp_path / "tokens")
    parts = write_token_files(odd_docs, path, end_id=1)
    got = sorted(map(tuple, read_token_files(spark, path, parts).collect()), key=lambda r: r[1])
    assert got == brute([(r.doc_id, r.text) for r in odd_docs.collect()], 1)
    dtype, ids, offsets = read_index(path, parts.first().part)
    assert dtype == np.dtype("<u2") and len(offsets) == len(ids) + 1
    assert TokenReader(path, parts.first().part, dtype)(0, int(offsets[-1])).dtype == dtype


def test_many_parts_have_prefix_sums_as_bases(spark, tmp_path, make_docs):
    docs = make_docs([(i * 7 % 301, f"text number {i} " * (i % 5)) for i in range(301)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = write_token_files(docs, str(tmp_path / "t"), end_id=1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts.count() > 1
    got = sorted(map(tuple, read_token_files(spark, str(tmp_path / "t"), parts).collect()))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], 1)


def test_empty_table(spark, no_docs, tmp_path):
    parts = write_token_files(no_docs, str(tmp_path / "t"))
    assert read_token_files(spark, str(tmp_path / "t"), parts).count() == 0


def test_memo_forgets_and_special_strings(monkeypatch):
    from ohlcflow.llm import tokens

    monkeypatch.setattr(tokens, "MEMO_WORDS", 5)
    e, t = WordEncoder(vocabulary()), Tokenizer.from_file(vocabulary())
    for text in ["a b c d", "don't stop<|endoftext|>now e\tf\rg", "ΣΑΣ é 가", "", "  x ", "l'été 1234 !!?", "a b c d"]:
        assert e.encode([text])[0].tolist() == t.encode(text, add_special_tokens=False).ids


def test_plain_words_equal_the_whole_tokenizer():
    rng, t = random.Random(6), Tokenizer.from_file(vocabulary())
    e = WordEncoder(vocabulary())
    letters = "abzAZéÉñßİΣσςäÄ\u0301\u00c5\u212a한ﬁǅ1²'.,!$_<|>-\u00a0"
    texts = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(40)) for _ in range(300)]
    for text, ids in zip(texts, e.encode(texts), strict=True):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids
