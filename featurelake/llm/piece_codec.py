"""Operator 11, SentencePiece encoding and decoding: merge-type vocabularies by a table of every prefix's last token.

Encoding a text by merges (best score first, leftmost of equals) has two properties. A run of neighbouring tokens in the
result is itself the result of their own text, since no merge crossed its ends. And a sequence is the result of its text if
each token and each pair of neighbours is the result of its own text: the first merge across a border would also be
the next one in that pair's text alone. So every prefix has one last token: the only match of an automaton over the
vocabulary that ends there and is compatible with the last token of the prefix before it. One scan fills that table, and the
tokens are read off backwards from the end. Time is linear in the text, whatever its length.

Two neighbouring characters that no piece holds side by side are never merged, so texts are cut there first, and a task fills
the table of an equal cutting once. Characters without a piece become their bytes' pieces.

Models: merge type with byte fallback, a prefix space and no other normalisation; others raise ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from featurelake.llm.common import slices

SPACE_MARK = "▁"
#: Characters of cuttings, and compatible or incompatible pairs, that a Python worker remembers; beyond it starts anew.
MEMORY_CHARS = 2_500_000
MEMORY_PAIRS = 200_000
#: Characters or ids of a long text that are worked on at a time.
STEP = 1 << 18
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_codecs: dict[str, Codec] = {}


class Vocabulary:
    """What tasks need of a model file: the pieces, their scores and kinds. As large as the file's list of pieces."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, trainer = model.normalizer_spec, model.trainer_spec
        self.pieces = [p.piece for p in model.pieces]
        self.scores = [p.score for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        if (trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix
                or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces
                or set(self.kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or self.kinds.count(_BYTE) != 256):
            raise ValueError("not a merge-type model with byte fallback, a prefix space and no other normalisation")
        self.unknown = trainer.unk_surface
        self.key = path


class Codec:
    def __init__(self, v: Vocabulary):
        import ahocorasick

        normal = [i for i, k in enumerate(v.kinds) if k == _NORMAL]
        self.id = {v.pieces[i]: i for i in normal}
        self.score = {v.pieces[i]: v.scores[i] for i in normal}
        self.byte_id = {int(v.pieces[i][3:5], 16): i for i, k in enumerate(v.kinds) if k == _BYTE}

        alphabet = sorted({c for p in self.id for c in p})
        self.kind = np.zeros(0x110000, np.uint16)  # 0: in no piece
        self.kind[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.n_kinds = len(alphabet) + 1
        self.joined = np.zeros(self.n_kinds ** 2, bool)  # characters that some piece holds side by side
        pairs = {p[i:i + 2] for p in self.id for i in range(len(p) - 1)}
        self.joined[[int(self.kind[ord(a)]) * self.n_kinds + int(self.kind[ord(b)]) for a, b in pairs]] = True

        self.automaton = ahocorasick.Automaton()
        for p in {*(p for p in self.id if len(self.merged(p)) == 1), *alphabet}:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.fits: dict[tuple[str, str], bool] = {}

        said = [self._said(v, i) for i in range(len(v.pieces))]
        self.bytes = np.frombuffer(b"".join(said), np.uint8)
        self.bytes_at = np.concatenate([[0], np.cumsum([len(b) for b in said])])
        self.said, self.kinds = said, np.array(v.kinds)
        self.opens = np.array([k == _NORMAL and p.startswith(SPACE_MARK) for p, k in zip(v.pieces, v.kinds)])
        self._forget()

    @staticmethod
    def _said(v: Vocabulary, i: int) -> bytes:
        if v.kinds[i] == _NORMAL:
            return v.pieces[i].replace(SPACE_MARK, " ").encode()
        if v.kinds[i] == _BYTE:
            return bytes([int(v.pieces[i][3:5], 16)])
        return v.unknown.encode() if v.kinds[i] == _UNKNOWN else b""

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.known_chars = 0
        self.ids, self.first, self.n = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), 0

    def merged(self, text: str) -> list[str]:
        """The merges themselves, for the few characters of one or two pieces."""
        parts = list(text)
        while len(parts) > 1:
            scores = [self.score.get(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
            best = max(scores)
            if best == -np.inf:
                break
            at = scores.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: str, b: str) -> bool:
        fit = self.fits.get((a, b))
        if fit is None:
            if len(self.fits) >= MEMORY_PAIRS:
                self.fits.clear()
            fit = self.fits[a, b] = self.merged(a + b) == [a, b]
        return fit

    def tokens(self, text: str) -> list[str]:
        """The tokens of a text whose characters all occur in pieces."""
        last: list[str | None] = [None] * len(text)
        for end, piece in self.automaton.iter(text):
            if last[end] is None:
                start = end + 1 - len(piece)
                if start == 0 or self.compatible(last[start - 1], piece):
                    last[end] = piece
        found, end = [], len(text)
        while end:
            found.append(last[end - 1])
            end -= len(found[-1])
        return found[::-1]

    def token_ids(self, text: str) -> list[int]:
        known = len(text) > 1 or self.kind[ord(text)] > 0
        return [i for t in (self.tokens(text) if known else [text])
                for i in ([self.id[t]] if t in self.id else [self.byte_id[b] for b in t.encode()])]

    def _learn(self, texts: list[str]) -> None:
        for text in texts:
            ids = self.token_ids(text)
            lo, hi = self.first[self.n], self.first[self.n] + len(ids)
            while hi > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            if self.n + 2 > len(self.first):
                self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.ids[lo:hi] = ids
            self.first[self.n + 1] = hi
            self.known[text] = self.n
            self.known_chars += len(text)
            self.n += 1

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and the place of each text's first one (n + 1)."""
        marked = [SPACE_MARK + t.replace(" ", SPACE_MARK) if t else "" for t in texts]
        ends = np.cumsum([len(t) for t in marked]) if marked else np.zeros(0, np.int64)
        whole = "".join(marked)
        if not whole:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        opens = np.ones(len(whole), bool)
        for lo in range(1, len(whole), STEP):
            kind = self.kind[points[lo - 1:lo + STEP]].astype(np.int64)
            opens[lo:lo + STEP] = ~self.joined[kind[:-1] * self.n_kinds + kind[1:]]
        opens[ends[ends < len(whole)]] = True
        starts = np.flatnonzero(opens)
        at = [*starts.tolist(), len(whole)]
        cut = [whole[a:b] for a, b in zip(at, at[1:])]
        if self.known_chars > MEMORY_CHARS:
            self._forget()
        self._learn(sorted(set(cut) - self.known.keys()))
        place = np.fromiter(map(self.known.__getitem__, cut), np.int64, len(cut))
        sizes = self.first[place + 1] - self.first[place]
        token_at = np.concatenate([[0], np.cumsum(sizes)])
        take = np.arange(token_at[-1]) + np.repeat(self.first[place] - token_at[:-1], sizes)
        return self.ids[take], token_at[np.searchsorted(starts, np.concatenate([[0], ends]))]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The UTF-8 bytes of the texts, and the place of each one's first byte (n + 1).

        The prefix space goes; controls say nothing; a byte that is part of no character becomes U+FFFD.
        """
        lo, size = self.bytes_at[ids], np.diff(self.bytes_at)[ids]
        audible = np.flatnonzero(self.kinds[ids] != _CONTROL)
        at = np.searchsorted(audible, first[:-1])
        heads = audible[np.minimum(at, max(len(audible) - 1, 0))] if len(audible) else np.zeros(0, np.int64)
        heads = heads[(at < len(audible)) & (heads < first[1:])] if len(audible) else heads
        heads = heads[self.opens[ids[heads]]]
        lo[heads] += 1
        size[heads] -= 1
        byte_at = np.concatenate([[0], np.cumsum(size)])
        data = np.empty(byte_at[-1], np.uint8)
        for s in range(0, len(ids), STEP):
            a, b = byte_at[s], byte_at[min(s + STEP, len(ids))]
            data[a:b] = self.bytes[np.arange(a, b) + np.repeat((lo - byte_at[:-1])[s:s + STEP], size[s:s + STEP])]
        border = np.union1d(first, np.flatnonzero(self.kinds[ids] == _CONTROL))  # no character reaches across a control
        offsets = byte_at[border]
        if not _whole_characters(data, offsets):
            texts = [_mended(data[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
            data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        return data, offsets[np.searchsorted(border, first)]


def _whole_characters(data: np.ndarray, offsets: np.ndarray) -> bool:
    begins = offsets[offsets < len(data)]
    if ((data[begins] & 0xC0) == 0x80).any():
        return False
    try:
        data.tobytes().decode()
    except UnicodeDecodeError:
        return False
    return True


def _mended(said: bytes) -> bytes:
    """Each byte that begins no whole character becomes U+FFFD."""
    out = []
    while said:
        try:
            said.decode()
        except UnicodeDecodeError as e:
            out += [said[:e.start], "�".encode()]
            said = said[e.start + 1:]
        else:
            out.append(said)
            break
    return b"".join(out)


def codec(v: Vocabulary) -> Codec:
    if v.key not in _codecs:
        _codecs[v.key] = Codec(v)
    return _codecs[v.key]


def _mapped(rows: DataFrame, read: str, write: str, kind: T.DataType, model: str, work) -> DataFrame:
    carried = [c for c in rows.columns if c != write]
    schema = rows.select(*carried).schema.add(write, kind)
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary(model))  # as large as the model's list of pieces
    return rows.select(*carried).mapInArrow(lambda batches: work(batches, codec(shared.value), carried.index(read), schema.names), schema)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """docs (text, ...) and ids array<int>, without begin or end ids. A former column ``ids`` gives way; all others, and repeated
    rows, stay as they are. NULL and empty texts: an empty array. No rows: no rows."""
    def work(batches: Iterator[pa.RecordBatch], coder: Codec, at: int, names: list[str]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, names[at], 1 << 20):
                ids, first = coder.encode(part.column(at).to_pylist())
                said = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*part.columns, said], names=names)

    return _mapped(docs, "text", "ids", T.ArrayType(T.IntegerType()), model, work)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """rows (ids array<int>, ...) and decoded: their text. A former column ``decoded`` gives way; all others, and repeated rows,
    stay as they are. NULL or empty arrays: an empty text. An id outside the vocabulary, or a NULL one, raises."""
    def work(batches: Iterator[pa.RecordBatch], coder: Codec, at: int, names: list[str]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(at).value_lengths().fill_null(0).to_numpy()
            ends = np.concatenate([[0], np.cumsum(sizes)])
            lo = 0
            while lo < len(sizes):  # about 256,000 ids at a time; a longer text stands alone
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + (1 << 18), side="right")) - 1)
                part = batch.slice(lo, hi - lo)
                ids = part.column(at).flatten()
                if ids.null_count or (len(ids) and not 0 <= pc.min(ids).as_py() <= pc.max(ids).as_py() < len(coder.said)):
                    raise ValueError("an id outside the vocabulary")
                data, offsets = coder.decode(ids.to_numpy(), ends[lo:hi + 1] - ends[lo])
                text = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
                yield pa.RecordBatch.from_arrays([*part.columns, text.cast(pa.string())], names=names)
                lo = hi
            pa.default_memory_pool().release_unused()

    return _mapped(rows, "ids", "decoded", T.StringType(), model, work)
