"""Chat formatting by token-level assembly.

Every turn is encoded on its own: its role and its text become ordinary
token ids, and reserved ids above the vocabulary are spliced in where a turn
begins, where its text begins and where it ends. A text therefore can never
produce a control token. In the rendered form the same places hold control
strings, so control strings inside texts are escaped there, reversibly, and
the escaped text is what is encoded.
A turn's place in its conversation is a prefix sum of token counts; the loss
mask is a range of token positions: the assistant's texts.

The formatted form is a table of segments (one per turn, ordered by offset),
never one row for a whole conversation, so a conversation of any length is
streamed. ``read_back`` rebuilds roles, texts and the text under the mask from the
ids alone.

Defined cases: a null text is empty, a null role is written as an empty one;
rows with equal turns follow by role and text; a null conv_id or turn is
a value of its own, first; an empty table gives none. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ohlcflow.llm.common import record_batch
from ohlcflow.llm.tokens import vocabulary

#: Strings that mark turns in the rendered form: begin of a turn, end of its role, end of its text.
BEGIN, TEXT, END = "### ", ": ", " </turn>\n"
#: Reserved ids of the three marks, above the vocabulary's own.
RESERVED = 3
#: What a text must not show bare: a turn's head, a turn's end, and the escape itself.
_CONTROL = re.compile(r"###|</turn>|\\")
_ESCAPED = re.compile(r"\\(###|</turn>|\\)")


def escape(text: str) -> str:
    """Every control string and every backslash with a backslash before it."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class _Codec:
    """A byte-level vocabulary: decoding ids gives back exactly the text."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.t.encode_special_tokens = True  # strings of special tokens in texts are ordinary text
        self.first = self.t.get_vocab_size()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.t.encode_batch(texts, add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        return self.t.decode(ids, skip_special_tokens=False)


_CODECS: dict[str, _Codec] = {}


def _codec(path: str) -> _Codec:
    if path not in _CODECS:
        _CODECS[path] = _Codec(path)
    return _CODECS[path]


def format_chat(turns: DataFrame, tokenizer: str | None = None, loss_role: str = "assistant") -> DataFrame:
    """Segments (conv_id, turn, ids, n_tokens, offset, loss_start, loss_end, n_chars) of ``turns(conv_id, turn, role, text)``.

    ``offset`` is the segment's place in its conversation, ``loss_start`` and
    ``loss_end`` the positions there that the loss mask covers (equal: none),
    ``n_chars`` the code points of the rendered turn.
    """
    tokenizer = tokenizer or vocabulary("byte_bpe_50k.json")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(tokenizer)
        begin, text, end = range(codec.first, codec.first + RESERVED)
        schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("ids", pa.binary()), ("n_tokens", pa.int64()), ("mask_start", pa.int64()), ("mask_end", pa.int64()), ("n_chars", pa.int64())])
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                batch = whole.slice(k, 512)
                convs, numbers, roles, texts = (c.to_pylist() for c in batch.columns)
                heads, bodies = [escape(r or "") for r in roles], [escape(t or "") for t in texts]
                rows = []
                for conv, number, role, plain, head, body, a, b in zip(convs, numbers, roles, texts, heads, bodies, codec.encode(heads), codec.encode(bodies), strict=True):
                    ids = np.array([begin, *a, text, *b, end], "<u4")
                    start = len(a) + 2
                    stop = start + len(b) if role == loss_role else start
                    rows.append((conv, number, role, plain, ids.tobytes(), len(ids), start, stop, len(BEGIN + head + TEXT + body + END)))
                yield record_batch(schema, list(zip(*rows, strict=True)))

    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    encoded = rows.mapInArrow(encode, "conv_id long, turn long, role string, text string, ids binary, n_tokens long, mask_start long, mask_end long, n_chars long")
    before = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        encoded.withColumn("offset", before)
        .select("conv_id", "turn", "ids", "n_tokens", "offset", (F.col("offset") + F.col("mask_start")).alias("loss_start"), (F.col("offset") + F.col("mask_end")).alias("loss_end"), "n_chars")
    )


class _Conversation:
    """Running digests of one conversation, segment by segment."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.chars, self.loss_chars, self.end = conv, 0, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.end


def read_back(segments: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per conversation from the ids and masks: counts and digests of roles, texts and the text under the mask."""
    tokenizer = tokenizer or vocabulary("byte_bpe_50k.json")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
    types = ["long", "long", "string", "long", "string", "long", "long"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(tokenizer)
        begin, text, end = range(codec.first, codec.first + RESERVED)
        schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in zip(names, types, strict=True)])
        now, done = None, []
        for batch in batches:
            for conv, raw, offset, loss_a, loss_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv != conv:
                    if now:
                        done.append(now.row())
                    now = _Conversation(conv)
                ids = np.frombuffer(raw, "<u4").tolist()
                if offset != now.end or ids[0] != begin or ids[-1] != end:
                    raise ValueError(f"conversation {conv} is not gapless at {offset}")
                at = ids.index(text)
                head, body = codec.decode(ids[1:at]), codec.decode(ids[at + 1 : -1])
                now.all.update(f"{unescape(head)}\n{unescape(body)}\n".encode())
                masked = unescape(codec.decode(ids[loss_a - offset : loss_b - offset]))
                now.loss.update(masked.encode())
                now.loss_chars += len(masked)
                now.turns += 1
                now.chars += len(BEGIN + head + TEXT + body + END)
                now.end += len(ids)
            if done:
                yield record_batch(schema, list(zip(*done, strict=True)))
                done = []
        if now:
            yield record_batch(schema, list(zip(now.row(), strict=True)))

    ordered = segments.select("conv_id", "ids", "offset", "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions("conv_id", "offset")
    return ordered.mapInArrow(read, ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True)))


def render(segments: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(conv_id, offset, rendered) of every segment: the marks as control strings, texts escaped."""
    tokenizer = tokenizer or vocabulary("byte_bpe_50k.json")

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(tokenizer)
        schema = pa.schema([("conv_id", pa.int64()), ("offset", pa.int64()), ("rendered", pa.string())])
        for batch in batches:
            out = []
            for raw in batch.column(2).to_pylist():
                ids = np.frombuffer(raw, "<u4").tolist()
                at = ids.index(codec.first + 1)
                out.append(BEGIN + codec.decode(ids[1:at]) + TEXT + codec.decode(ids[at + 1 : -1]) + END)
            yield record_batch(schema, [batch.column(0).to_pylist(), batch.column(1).to_pylist(), out])

    return segments.select("conv_id", "offset", "ids").mapInArrow(show, "conv_id long, offset long, rendered string")
