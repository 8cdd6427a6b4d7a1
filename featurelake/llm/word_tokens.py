"""Token ids of whole texts with a word-ended BPE vocabulary, word by word.

That tokenizer lower-cases, drops white space and never merges across it, nor between an ASCII letter and the ASCII
mark after it. So a text's ids are those of its words in order, and each task encodes a word once.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from featurelake.llm.common import mix, slices, span_hashes, utf8

#: Words that a Python worker remembers (about 40 bytes each); beyond it starts anew.
MEMORY_WORDS = 2_000_000
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Words are known by a 64-bit hash of their bytes; two of two million words share one with a chance of about 1e-7."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a special token's string in a text is ordinary text
        self._forget()

    def _forget(self) -> None:
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted hashes, and where their ids are
        self.ids, self.first, self.n = np.zeros(1 << 18, np.uint32), np.zeros(1 << 16, np.int64), 0

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        for lo in range(0, len(words), 10_000):
            found = [e.ids for e in encode(words[lo:lo + 10_000], add_special_tokens=False)]
            n, more = self.n, len(found)
            end = self.first[n] + np.cumsum([len(x) for x in found])
            while end[-1] > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            while n + more + 1 > len(self.first):
                self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.ids[self.first[n]:end[-1]] = np.concatenate([np.asarray(x, np.uint32) for x in found])
            self.first[n + 1:n + 1 + more] = end
            self.n += more
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.place = np.insert(self.place, at, (np.arange(len(keys)) + self.n - len(keys))[order])

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) of the texts in order, and the place of each text's first one (n + 1). NULL: none."""
        text = pc.ascii_lower(text.fill_null(""))
        text = pc.replace_substring_regex(text, r"([a-z])([!-/:-@\[-`{-~])", r"\1 \2")
        split = pc.ascii_split_whitespace(text)
        words = split.flatten().dictionary_encode()
        data, at = utf8(words.dictionary)
        keys = mix(span_hashes(data, at[:-1], at[1:], lower=False) + np.diff(at).astype(np.uint64))
        new = ~self._known(keys)
        if self.n and self.n + int(new.sum()) > MEMORY_WORDS:
            self._forget()
            new[:] = True
        if new.any():
            self._learn(keys[new], words.dictionary.filter(pa.array(new)).to_pylist())
        place = self.place[np.searchsorted(self.keys, keys)] if len(keys) else np.zeros(0, np.int32)
        at = place[words.indices.to_numpy()] if len(words) else place
        sizes = self.first[at + 1] - self.first[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        take = np.arange(ends[-1]) + np.repeat(self.first[at] - ends[:-1], sizes)
        offsets = split.offsets.to_numpy().astype(np.int64)
        return self.ids[take], ends[offsets - offsets[0]]


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(batch: pa.RecordBatch, path: str, size: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, ids, first) for slices of a batch with a ``text`` column."""
    coder = encoder(path)
    for part in slices(batch, size=size):
        yield part, *coder.encode(part.column(part.schema.get_field_index("text")))
