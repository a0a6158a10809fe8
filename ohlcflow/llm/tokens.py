"""Encoding whole texts with a public tokenizer, word by word with a memo.

The word-level vocabulary used here never merges across white space (its
pre-tokenizer drops it), so a text's ids are those of its space-separated
words in turn. Distinct words are few compared with words: each task encodes
a word once and gathers ids with numpy.

Most words are letters, perhaps with symbols behind. Such a word's pieces are
what the pre-tokenizer would cut it into, and once lower-cased they need no
normalizer, so they go to the same vocabulary and merges without these two
steps, which take most of the tokenizer's time. All other words go through the
whole tokenizer.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words remembered per Python worker unless a caller asks for fewer, and the longest one remembered.
MEMO_WORDS, MEMO_CHARS = 700_000, 48
#: ASCII symbols but the apostrophe (which starts contractions): behind letters they are one piece of their own.
_SYMBOLS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_STEPS = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file on this machine (drivers and executors have the package)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_characters() -> list[str]:
    """The characters that byte-level vocabularies write bytes as: printable ones as they are, others from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(others)) for b in range(256)]


_BYTES = _byte_characters()


class _Pieces(dict):
    """Ids (unsigned 32 bits) of pieces that are lower-cased already: the vocabulary's merges alone, over bytes as characters."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join(map(_BYTES.__getitem__, piece.encode()))
        ids = self[piece] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids


class WordEncoder:
    """Ids of texts under a tokenizer whose tokens never span a space or line feed."""

    def __init__(self, path: str, memo: int | None = None):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        normal, cut = (spec.get("normalizer") or {}).get("normalizers", []), (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.bare = None  # for vocabularies of this kind only: lower case, letters apart from symbols, bytes as characters
        if ([x["type"] for x in normal], [x["type"] for x in cut]) == _STEPS:
            self.bare = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.pieces = _Pieces(self.bare)
        self.memo = memo or MEMO_WORDS
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _encoded(self, new: list[str]) -> list[bytes]:
        out, whole, pieces = [], [], self.pieces
        if len(pieces) > self.memo // 2:
            pieces.clear()
        for w in new:
            letters = w.rstrip(_SYMBOLS) if self.bare else ""
            low = letters.lower()  # not always letters: a mark may come with it
            plain = low.isalpha() and (letters.isascii() or letters.isalpha() and "\u03a3" not in letters and unicodedata.is_normalized("NFC", letters))
            if not plain or "<|" in w:  # the lower case of a sigma depends on its place; special tokens
                whole.append(len(out))
                out.append(b"")
            elif len(letters) == len(w):
                out.append(pieces[low])
            else:
                out.append(pieces[low] + pieces[w[len(letters) :]])
        for k, e in zip(whole, self.tokenizer.encode_batch_fast([new[k] for k in whole], add_special_tokens=False), strict=True):
            out[k] = array("I", e.ids).tobytes()
        return out

    def _learn(self, new: list[str]) -> range:
        """Takes words into the tables; their places there."""
        got = self._encoded(new)
        n = np.fromiter(map(len, got), np.int64, len(got)) // 4
        total, first, last = int(n.sum()), len(self.index), len(self.index) + len(new)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while last > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        self.ids[self.used : self.used + total] = np.frombuffer(b"".join(got), np.uint32)
        self.starts[first:last] = self.used + np.cumsum(n) - n
        self.lengths[first:last] = n
        self.index.update(zip(new, range(first, last), strict=True))
        self.used += total
        return range(first, last)

    def encode(self, texts: list[str], end_id: int | None = None) -> list[np.ndarray]:
        """The ids (uint32) of each text, with ``end_id`` appended if given."""
        end = np.array([] if end_id is None else [end_id], np.uint32)
        if not texts:
            return []
        # Arrow splits and numbers the distinct words; Python looks each up once
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False)
        if len(self.index) + len(words) > self.memo:
            self._forget()
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        is_long = np.fromiter(map(len, words[new]), np.int64, len(new)) > MEMO_CHARS
        long = words[new[is_long]].tolist()
        at[new[~is_long]] = self._learn(words[new[~is_long]].tolist())
        used = self.used
        at[new[is_long]] = self._learn(long)
        at = at[coded.indices.to_numpy()]
        n = self.lengths[at]
        stop = np.cumsum(n)
        ids = self.ids[np.repeat(self.starts[at] - stop + n, n) + np.arange(int(stop[-1]))]
        for w in long:  # the last ones learnt
            del self.index[w]
        self.used = used
        ends = stop[split.offsets.to_numpy()[1:] - 1].tolist()
        return [np.concatenate([ids[a:b], end]) for a, b in zip([0, *ends], ends, strict=False)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str, memo: int | None = None) -> WordEncoder:
    """The Python worker's encoder for ``path``, remembering ``memo`` words; workers are reused between tasks, and by other operators."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    _ENCODERS[path].memo = memo or MEMO_WORDS
    return _ENCODERS[path]
