"""Byte-level BPE encoding and decoding by the tiktoken library and a local rank file.

A long text is cut where the split pattern ends a match whatever lies around,
so that no call sees more than about ``PART_CHARS`` characters and the ids are
those of the whole text: no alternative of the pattern goes on from a
character that is no white space to one that is, and of a run of white space
before a word the pattern always leaves the last character for the next match.
Very long runs of white space, on which the library's matcher overflows its
stack, are one match each and go to the merges without it.

Ids are little-endian unsigned 32-bit integers in one binary value. Decoding
joins the tokens' bytes and never goes through characters.

Each row is handled alone: no shuffle, no group. A null text is empty (no
ids); empty texts, ties, repeated rows and empty tables need no special case;
of the input only the named columns are read, so others may have any name. A
very long text needs memory in proportion to itself only.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Characters given to the library at once, and the white space that is taken out as a match of its own.
PART_CHARS, LONG_SPACE = 1 << 16, 1 << 12

_CUT = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})")
_LONG = regex.compile(r"\p{White_Space}{%d,}" % LONG_SPACE)
_CODECS: dict[tuple[str, str], Codec] = {}


def safe_parts(text: str, size: int = PART_CHARS) -> Iterator[tuple[str, bool]]:
    """Parts of ``text`` in order, each with whether it is one match of white space.

    Encoding the parts one by one gives the ids of ``text``. A part is longer
    than ``size`` only where no safe boundary follows.
    """
    start = 0
    for run in _LONG.finditer(text):
        yield from ((part, False) for part in _cut(text[start : run.start()], size))
        # the last character of a run goes with the word behind it
        stop = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : stop], True
        start = stop
    yield from ((part, False) for part in _cut(text[start:], size))


def _cut(text: str, size: int) -> Iterator[str]:
    start = 0
    while start < len(text):
        found = _CUT.search(text, start + size) if len(text) - start > size else None
        stop = found.start() if found else len(text)
        yield text[start:stop]
        start = stop


class Codec:
    """One rank file and split pattern, as the library reads them."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str, size: int = PART_CHARS) -> bytes:
        if len(text) <= LONG_SPACE:
            return self._ids(text)
        return b"".join(self._space(part) if space else self._ids(part) for part, space in safe_parts(text, size))

    def _ids(self, text: str) -> bytes:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def _space(self, text: str) -> bytes:
        return np.array(self.encoding._encode_single_piece(text), "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        return self.encoding.decode_bytes(np.frombuffer(ids, "<u4").tolist())


def codec(ranks: str, pattern: str) -> Codec:
    """The codec of a rank file, read once a Python worker."""
    if (ranks, pattern) not in _CODECS:
        _CODECS[ranks, pattern] = Codec(ranks, pattern)
    return _CODECS[ranks, pattern]


def encode(docs: DataFrame, ranks: str, pattern: str, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of every row with the ``ids`` of its ``text``; ``ranks`` is the path of the rank file on every machine."""
    kept = docs.select(*columns, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = codec(ranks, pattern).encode
        for batch in batches:
            for part in _slices(batch):
                ids = [to_ids(t or "") for t in part.column(len(columns)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ids, pa.binary())], names=[*columns, "ids"])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    return kept.mapInArrow(run, ", ".join([*types, "ids binary"]))


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``encoded`` with the bytes ``data`` that its ``ids`` stand for; an id without a token is an error, null ids are none."""
    names = [f"_{i}" for i in range(len(encoded.columns))]  # free of clashes while in Arrow
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_bytes = codec(ranks, pattern).decode
        for batch in batches:
            for part in _slices(batch):
                data = [to_bytes(x or b"") for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], names=[*names, "data"])

    types = [f"{n} {f.dataType.simpleString()}" for n, f in zip(names, encoded.schema.fields, strict=True)]
    out = encoded.toDF(*names).mapInArrow(run, ", ".join([*types, "data binary"]))
    return out.toDF(*encoded.columns, "data")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of about 4 MB."""
    rows = max(1, (batch.num_rows << 22) // max(batch.nbytes, 1 << 22))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def digest(decoded: DataFrame) -> DataFrame:
    """The contract's columns from ``decode``."""
    return decoded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
