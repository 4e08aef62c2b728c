"""Byte-pair encoding of a corpus by a public vocabulary.

Each distinct piece of text is encoded once a worker.  A segment tree over the ranks of the
adjacent pairs holds the leftmost lowest rank at its root; each merge changes at most three
leaves, so a piece of n bytes takes O(n log n) steps however long it is.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: No mergeable pair.
NONE = 1 << 40
#: Pieces whose ids a worker keeps; the cache is emptied when it is full, which changes no result.
CACHE_PIECES = 400_000
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published pattern that cuts text into pieces before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class PairTree:
    """Segment tree of pair ranks: the minimum of each span, and its leftmost position by descent."""

    def __init__(self, ranks: list[int]):
        size = 1
        while size < len(ranks):
            size *= 2
        self.size = size
        tree = [NONE] * size + ranks + [NONE] * (size - len(ranks))
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a <= b else b
        self.tree = tree

    def set(self, position: int, rank: int) -> None:
        tree, i = self.tree, self.size + position
        tree[i] = rank
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            low = a if a <= b else b
            if tree[i] == low:
                break
            tree[i] = low
            i >>= 1

    def leftmost_lowest(self) -> int:
        """Position of the leftmost pair of lowest rank, -1 if no pair can be merged."""
        tree, i = self.tree, 1
        low = tree[1]
        if low >= NONE:
            return -1
        while i < self.size:
            i *= 2
            if tree[i] != low:
                i += 1
        return i - self.size


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one piece: the leftmost pair of lowest rank is merged until none is left."""
    n = len(piece)
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    if n > 1:
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        rank = ranks.get
        tree = PairTree([rank(piece[i : i + 2], NONE) for i in range(n - 1)])
        while (i := tree.leftmost_lowest()) >= 0:
            j = after[i]
            parts[i] += parts[j]
            parts[j] = None
            k = after[j]
            after[i] = k
            if j < n - 1:
                tree.set(j, NONE)
            if k < n:
                before[k] = i
                tree.set(i, rank(parts[i] + parts[k], NONE))
            else:
                tree.set(i, NONE)
            h = before[i]
            if h >= 0:
                tree.set(h, rank(parts[h] + parts[i], NONE))
    return tuple(ranks[p] for p in parts if p is not None)


class Encoder:
    """Text to ids.  Special tokens are not known to it: their strings are ordinary text."""

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN):
        import regex

        self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in vocabulary.splitlines() if line)}
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; null and empty texts have none."""
        ids: list[int] = []
        known = self.known
        for piece in self.pieces(text or ""):
            got = known.get(piece)
            if got is None:
                got = merge_piece(piece.encode(), self.ranks)
                if len(known) >= CACHE_PIECES:
                    known.clear()
                if len(piece) <= 64:
                    known[piece] = got
            ids.extend(got)
        return ids


@lru_cache(maxsize=2)
def _encoder(vocabulary: bytes) -> Encoder:
    return Encoder(vocabulary)


def encode_corpus(documents: DataFrame, vocabulary_path: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array of int) of every row, without special tokens.

    The driver reads the vocabulary file, about a megabyte of fixed size, and broadcasts it.
    Null and empty texts have an empty list.  There is no shuffle: repeated rows come out
    repeated, an empty table empty, and other columns do not matter.
    """
    spark: SparkSession = documents.sparkSession
    with open(vocabulary_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(shared.value)
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "ids": [encoder.encode(t) for t in pdf[text]]})

    kind = dict(documents.dtypes)[key]
    return documents.select(key, text).mapInPandas(encode, f"`{key}` {kind}, ids array<int>")
