"""Operator 5, token counts: edit-aware counting over segment trees of pre-tokens.

A byte-level BPE vocabulary encodes a text pre-token by pre-token, so a text's count is the sum over its pre-tokens. Per
document the tree's leaves are runs of ``LEAF`` pre-tokens, each with its characters and tokens; the inner nodes hold
subtree sums of both. An edit replaces some characters:

* by descent along the character sums, find the leaf that holds the edit's start less ``CONTEXT`` characters. What
  lies before it cannot change: the pattern has no look-behind, and looks at most 2 characters past a match;
* cut the text anew from that leaf on, until behind the edit a cut falls on an old leaf's border. From there on
  the cuts are the old ones, as they depend only on what follows;
* put the new counts into the leaves concerned and update the sums on their paths. A leaf grown past
  ``SPLIT`` times its size makes the tree be laid out anew, from its leaves.

Trees lie beside their texts as array columns, so neither building nor editing shuffles anything.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.llm.common import slices

LEAF, SPLIT, CONTEXT = 32, 8, 4
MEMORY_WORDS = 500_000
EDITS = "array<struct<start:int,length:int,replacement:string>>"
_counters: dict[str, Counter] = {}


class Counter(dict):
    """Pre-token -> number of tokens; remembers at most MEMORY_WORDS."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(public_tokenizers.PATTERN)

    def __missing__(self, piece: str) -> int:
        if len(self) >= MEMORY_WORDS:
            self.clear()
        self[piece] = n = len(self.encoding.encode_ordinary(piece))
        return n

    def pieces(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The lengths and token counts of the text's pre-tokens."""
        cut = self.pattern.findall(text)
        return np.fromiter(map(len, cut), np.int64, len(cut)), np.fromiter(map(self.__getitem__, cut), np.int64, len(cut))


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


class Tree:
    """Sums of characters and tokens over the leaves, heap-ordered: node i has the children 2i and 2i + 1."""

    def __init__(self, chars, tokens):
        self.n = max(len(chars), 1)
        self.size = 1 << (self.n - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        self.sums[self.size:self.size + len(chars), 0] = chars
        self.sums[self.size:self.size + len(tokens), 1] = tokens
        level = self.size
        while level > 1:
            self.sums[level // 2:level] = self.sums[level:2 * level].reshape(-1, 2, 2).sum(1)
            level //= 2

    def leaves(self) -> np.ndarray:
        return self.sums[self.size:self.size + self.n]

    def total(self) -> tuple[int, int]:
        return int(self.sums[1, 0]), int(self.sums[1, 1])

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at``, and where that leaf starts."""
        node, start = 1, 0
        while node < self.size:
            left = int(self.sums[2 * node, 0])
            node *= 2
            if at >= start + left and self.sums[node + 1, 0]:
                start += left
                node += 1
        return node - self.size, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = self.size + leaf
        change = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2


def build(text: str, words: Counter) -> Tree:
    chars, tokens = words.pieces(text)
    at = np.arange(0, len(chars), LEAF)
    return Tree(np.add.reduceat(chars, at), np.add.reduceat(tokens, at)) if len(chars) else Tree([], [])


def edit(tree: Tree, text: str, start: int, length: int, replacement: str, words: Counter) -> tuple[Tree, str, int]:
    """The tree and text after an edit, and how many characters were cut anew. Places beyond the text mean its end."""
    start = min(max(start, 0), len(text))
    stop = min(start + max(length, 0), len(text))
    new = text[:start] + replacement + text[stop:]
    shift = len(new) - len(text)
    first, at = tree.find(max(start - CONTEXT, 0))
    # leaves behind the edit, and where they start in the new text
    ends = at + np.cumsum(tree.leaves()[first:, 0])
    borders = {int(e) + shift: k + 1 for k, e in enumerate(ends) if e >= stop}
    if not borders:  # an empty text
        borders = {len(new): tree.n - first}
    found: list[tuple[int, int]] = []
    pos = at
    floor = start + len(replacement)
    count = None
    if pos == len(new) and pos in borders:
        count = tree.n - first
    else:
        for m in words.pattern.finditer(new, at):
            pos = m.end()
            found.append((pos - m.start(), words[m.group()]))
            if pos >= floor and pos in borders:
                count = borders[pos]
                break
    if count is None:
        count = tree.n - first
    if pos == len(new):  # leaves emptied by earlier edits may share the last border
        count = tree.n - first
    per = max(1, -(-len(found) // count))
    for k in range(count):
        part = found[k * per:(k + 1) * per]
        tree.put(first + k, sum(c for c, _ in part), sum(t for _, t in part))
    if per > SPLIT * LEAF:
        tree = build(new, words)
        return tree, new, len(new)
    return tree, new, pos - at


def with_trees(docs: DataFrame, ranks: str) -> DataFrame:
    """docs, all columns, and tree_chars, tree_tokens: the leaves of each whole text's tree.

    NULL and empty texts have one empty leaf. Columns of those names give way.
    """
    carried = [c for c in docs.columns if c not in ("tree_chars", "tree_tokens")]
    at = carried.index("text")
    counts = T.ArrayType(T.IntegerType())
    schema = docs.select(*carried).schema.add("tree_chars", counts).add("tree_tokens", counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(ranks)
        for batch in batches:
            for part in slices(batch, carried[at]):
                leaves = [build(t or "", words).leaves() for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, _lists([x[:, 0] for x in leaves]), _lists([x[:, 1] for x in leaves])], names=schema.names)

    return docs.select(*carried).mapInArrow(run, schema)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int32)))


def apply_edits(docs: DataFrame, ranks: str) -> DataFrame:
    """docs of ``with_trees`` with a column ``edits`` (start, length, replacement; in order, each on the text left by the one
    before), all columns but edits, edited: text, trees, and n_tokens_before, n_tokens, n_edits, n_reencoded.

    A NULL list is no edits; in an edit a NULL start or length counts as 0 and a NULL replacement as empty. A NULL text is
    empty before its first edit and stays NULL without one.
    """
    new = ["n_tokens_before", "n_tokens", "n_edits", "n_reencoded"]
    carried = [c for c in docs.columns if c not in ("edits", "text", "tree_chars", "tree_tokens", *new)]
    names = [*carried, "text", "tree_chars", "tree_tokens", *new]
    schema = docs.select(*names[:-4]).schema
    for c in new:
        schema = schema.add(c, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(ranks)
        for batch in batches:
            for part in slices(batch, "text"):
                texts, leaves, counts = [], [], []
                n = len(carried)
                chars, tokens = part.column(n + 1), part.column(n + 2)
                for i, (text, edits) in enumerate(zip(part.column(n).to_pylist(), part.column(n + 3).to_pylist())):
                    tree = Tree(chars[i].values.to_numpy(), tokens[i].values.to_numpy())
                    before, again = tree.total()[1], 0
                    for e in edits or []:
                        tree, text, m = edit(tree, text or "", e["start"] or 0, e["length"] or 0, e["replacement"] or "", words)
                        again += m
                    texts.append(text)
                    leaves.append(tree.leaves())
                    counts.append((before, tree.total()[1], len(edits or []), again))
                own = np.array(counts, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(texts, pa.string()), _lists([x[:, 0] for x in leaves]), _lists([x[:, 1] for x in leaves]),
                                                  *[pa.array(own[:, k]) for k in range(4)]], names=names)

    return docs.select(*names[:-4], "edits").mapInArrow(run, schema)


def attach_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """docs with the column ``edits`` from rows (doc_id, seq, start, length, replacement), in order of seq; NULL where there are none."""
    rows = edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "start", "length", "replacement"))).alias("edits"))
    rows = rows.select("doc_id", F.transform("edits", lambda e: F.struct(e["start"].cast("int").alias("start"), e["length"].cast("int").alias("length"), e["replacement"].alias("replacement"))).alias("edits"))
    return docs.drop("edits").join(rows, "doc_id", "left")
