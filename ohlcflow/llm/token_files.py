"""Token ids as flat binary files with 64-bit document offsets, memory-mapped.

``write_token_files`` encodes every text and writes, per partition of the
ascending document order, ``part-N.bin`` (the ids, little-endian, 16 bits if
the vocabulary allows, else 32) and ``part-N.idx`` (document ids, then the
documents' offsets inside the part, 64 bits each). A part's place in the whole
stream is the prefix sum of the token counts of the parts before it.
``read_token_files`` maps the files back to one row per document.

Nulls: a null text is empty (the end id alone); a null id sorts first and is
kept. Equal ids keep all their rows, ordered by text (its first 64 characters, then
a hash); parts are cut in that order and between equal rows, so a third of all rows
may share an id, or an id and a text. Other columns are not read. An empty table writes no documents.
"""

from __future__ import annotations

import json
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ohlcflow.llm.common import chunks, document_order, record_batch
from ohlcflow.llm.tokens import encoder, vocabulary

#: File header of an index: mark, bytes an id takes, documents.
HEADER = "<8sqq"
MARK = b"TOKIDX01"
#: A null document id in an index.
NO_ID = -(1 << 63)
_PART = "part long, n_docs long, n_tokens long"
_DOC = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _uri(path: str) -> str:
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def _put(store: pafs.FileSystem, temp: str, final: str) -> None:
    """A finished file under its final name; a retried task replaces what an earlier try left."""
    if not isinstance(store, pafs.LocalFileSystem) and store.get_file_info(final).type != pafs.FileType.NotFound:
        store.delete_file(final)
    store.move(temp, final)


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Writes the files under ``path`` (shared by all executors); returns (part, base, n_docs, n_tokens)."""
    spark, tokenizer, path = docs.sparkSession, tokenizer or vocabulary(), _uri(path)
    store, root = _open(path)
    store.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, tried = context.partitionId(), context.taskAttemptId()
        store, root = _open(path)
        codec = encoder(tokenizer)
        base = f"{root}/part-{part:06d}"
        ids, lengths = array("q"), array("q")  # 16 bytes a document
        with store.open_output_stream(f"{base}.bin.{tried}") as out:
            for (doc_ids,), texts in chunks(batches):
                for x in codec.encode(texts, end_id):
                    out.write(x.astype(codec.dtype).tobytes())
                    lengths.append(len(x))
                ids.extend(NO_ID if i is None else i for i in doc_ids)
        offsets = np.concatenate([[0], np.cumsum(np.frombuffer(lengths, np.int64))]).astype("<i8")
        with store.open_output_stream(f"{base}.idx.{tried}") as out:
            out.write(struct.pack(HEADER, MARK, codec.dtype.itemsize, len(ids)))
            out.write(np.frombuffer(ids, np.int64).astype("<i8").tobytes())
            out.write(offsets.tobytes())
        for kind in ("bin", "idx"):
            _put(store, f"{base}.{kind}.{tried}", f"{base}.{kind}")
        schema = pa.schema([("part", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
        yield record_batch(schema, [[part], [len(ids)], [int(offsets[-1])]])

    rows, order = document_order(docs)
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    parts = sorted(tuple(r) for r in ordered.mapInArrow(write, _PART).collect())  # one row a file
    bases = np.concatenate([[0], np.cumsum([n for _, _, n in parts])]).astype(int)
    rows = [(part, int(base), n_docs, n) for (part, n_docs, n), base in zip(parts, bases, strict=False)]
    with store.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps({"end_id": end_id, "parts": rows}).encode())
    return spark.createDataFrame(rows, "part long, base long, n_docs long, n_tokens long")


def read_index(path: str, part: int) -> tuple[np.dtype, np.ndarray, np.ndarray]:
    """(dtype of the ids, document ids, offsets) of a part."""
    store, root = _open(_uri(path))
    with store.open_input_file(f"{root}/part-{part:06d}.idx") as f:
        mark, width, n = struct.unpack(HEADER, f.read(struct.calcsize(HEADER)))
        if mark != MARK:
            raise ValueError(f"{root}/part-{part:06d}.idx is not a token index")
        return np.dtype(f"<u{width}"), np.frombuffer(f.read(8 * n), "<i8"), np.frombuffer(f.read(8 * (n + 1)), "<i8")


class TokenReader:
    """Slices of a part's ids: memory-mapped where the folder is local, ranged reads elsewhere."""

    def __init__(self, path: str, part: int, dtype: np.dtype):
        store, root = _open(_uri(path))
        self.dtype, name = dtype, f"{root}/part-{part:06d}.bin"
        self.mapped = self.file = None
        if not isinstance(store, pafs.LocalFileSystem):
            self.file = store.open_input_file(name)
        elif store.get_file_info(name).size:
            self.mapped = np.memmap(name, dtype, "r")

    def __call__(self, start: int, stop: int) -> np.ndarray:
        if self.file is not None:
            width = self.dtype.itemsize
            return np.frombuffer(self.file.read_at((stop - start) * width, start * width), self.dtype)
        return self.mapped[start:stop] if self.mapped is not None else np.empty(0, self.dtype)


def read_token_files(spark: SparkSession, path: str, parts: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32 (ids as unsigned 32 bits)."""
    path = _uri(path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])
        for batch in batches:
            for part, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                dtype, ids, offsets = read_index(path, part)
                tokens = TokenReader(path, part, dtype)
                for k in range(0, len(ids), 4096):
                    at = range(k, min(k + 4096, len(ids)))
                    yield record_batch(
                        schema,
                        [
                            [None if ids[i] == NO_ID else int(ids[i]) for i in at],
                            [base + int(offsets[i]) for i in at],
                            [int(offsets[i + 1] - offsets[i]) for i in at],
                            [zlib.crc32(tokens(offsets[i], offsets[i + 1]).astype("<u4").tobytes()) for i in at],
                        ],
                    )

    n = max(1, min(parts.count(), 10_000))
    return parts.select("part", "base").repartition(n, F.col("part")).mapInArrow(read, _DOC)
