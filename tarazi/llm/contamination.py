"""Evaluation texts leaking into training text.

A hash set of the items' normalised n-grams is broadcast in blocks of bounded size; a window
slides over the words of every document, and where it hits, the document is aligned with the
item around the hits.  A hit stands when a dozen words are matched in their order with few
words changed, and as many figures and words that the item does not share with others are matched
as changed: texts made after the same pattern have other ones.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarazi.session import cut_lineage

#: Words of a window.  Short, so that a passage with a changed word in every four is still hit.
NGRAM = 3
#: Words of a passage, changed ones included, and those that must be matched.
PASSAGE, MATCHED = 12, 10
#: Words of the items that one broadcast holds; more items take more passes.
BLOCK_WORDS = 200_000
#: Item words covered by hits before a document is aligned: a dozen words with three changed cover at least these.
COVERED = 6
#: Share of an alignment's own words (not shared with over a tenth of the items) that must match, without and with figures among them.
OWN_SHARE, OWN_SHARE_WITH_FIGURES = 0.75, 0.5
#: Item words beyond which a seed is too common to start an alignment by itself.
COMMON = 0.1

# Letters of other scripts that look like a Latin one, and letters written with or without their mark.
LOOKALIKES = str.maketrans(
    {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
     "ı": "i", "ə": "a", "ё": "e", "й": "и", "α": "a", "ο": "o", "ε": "e", "ρ": "p", "ν": "v", "ø": "o", "ß": "ss"}
)
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})")
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_UNSEEN = re.compile("[­​-‏‪-‮⁠﻿]")
_BROKEN = re.compile(r"[-‐]\s*\n\s*")
_DECIMAL = re.compile(r"(?<=\d)[.,](?=\d)")
_WORD = re.compile(r"[^\W_]+")


class _Letters(dict):
    """Code points to what they count as: look-alikes to a Latin letter, combining marks to nothing; filled as letters occur."""

    def __missing__(self, point: int):
        ch = chr(point)
        self[point] = out = None if unicodedata.combining(ch) else LOOKALIKES.get(point, point)
        return out


_LETTERS = _Letters()


def words_of(text: str | None) -> list[str]:
    """Words without regard to case, punctuation, layout, mark-up and the way characters are written."""
    if not text:
        return []
    t = html.unescape(text) if "&" in text else text
    if "\\u" in t:
        t = _ESCAPE.sub(lambda m: chr(int(m[1], 16)), t)
    if "<" in t:
        t = _TAG.sub(" ", t)
    if not t.isascii():
        t = _UNSEEN.sub("", t)
    t = _BROKEN.sub("", t) if "\n" in t else t
    if t.isascii():
        t = t.lower()
    else:
        t = unicodedata.normalize("NFKD", t.replace("İ", "i").lower()).translate(_LETTERS)
    return _WORD.findall(_DECIMAL.sub("", t))


class Alignment(NamedTuple):
    """Item words that are matched and words that are changed, in all, of the item's own words and of its numbers."""

    matched: int
    changed: int
    own_matched: int
    own_changed: int
    numbers_matched: int
    numbers_changed: int

    def is_passage(self) -> bool:
        """Long enough, and told from look-alikes by its figures, or by its own words with one changed at most."""
        told_by_figures = self.numbers_matched >= max(1, self.numbers_changed)
        figures = told_by_figures or self.own_changed <= 1
        share = OWN_SHARE_WITH_FIGURES if told_by_figures else OWN_SHARE
        return self.matched >= MATCHED and self.matched + self.changed >= PASSAGE and figures and self.own_matched >= share * (self.own_matched + self.own_changed)


def align(item: list[str], doc: list[str], own: set[str]) -> Alignment:
    """The best local alignment of an item with a stretch of a document."""
    m, n = len(item), len(doc)
    rows = [[0] * (n + 1)]
    best = (0, 0, 0)
    for i in range(1, m + 1):
        above, row, x = rows[-1], [0] * (n + 1), item[i - 1]
        for j in range(1, n + 1):
            v = above[j - 1] + (1 if x == doc[j - 1] else -1)
            u, w = above[j] - 1, row[j - 1] - 1
            if u > v:
                v = u
            if w > v:
                v = w
            if v > 0:
                row[j] = v
                if v > best[0]:
                    best = (v, i, j)
        rows.append(row)
    _, i, j = best
    good: list[str] = []
    bad: list[str] = []
    added = 0
    while i > 0 and j > 0 and rows[i][j] > 0:
        v, x = rows[i][j], item[i - 1]
        if v == rows[i - 1][j - 1] + (1 if x == doc[j - 1] else -1):
            (good if x == doc[j - 1] else bad).append(x)
            i, j = i - 1, j - 1
        elif v == rows[i - 1][j] - 1:
            bad.append(x)
            i -= 1
        else:
            added += 1
            j -= 1
    ours = lambda ws: sum(w in own for w in ws)
    figures = lambda ws: sum(any(c.isdigit() for c in w) for w in ws)
    return Alignment(len(good), len(bad) + added, ours(good), ours(bad), figures(good), figures(bad))


class Index:
    """N-grams of a block of items (id and words), each with its places."""

    def __init__(self, items: list[tuple[int, list[str]]], shared: dict[str, float]):
        self.words = dict(items)
        self.own = {i: {w for w in ws if any(c.isdigit() for c in w) or shared.get(w, 0) <= COMMON} for i, ws in self.words.items()}
        self.places: dict[tuple, list] = defaultdict(list)
        for i, ws in self.words.items():
            n = min(NGRAM, len(ws))
            for k in range(len(ws) - n + 1 if ws else 0):
                self.places[tuple(ws[k : k + n])].append((i, k))

    def leaks(self, doc: list[str]) -> Iterator[tuple[int, int, int]]:
        """(item, matched, changed) of every item with a passage in the document."""
        places = self.places
        hits: dict[int, list] = defaultdict(list)
        for k in [k for k, window in enumerate(zip(*(doc[i:] for i in range(NGRAM)))) if window in places]:
            for item, at in places[tuple(doc[k : k + NGRAM])]:
                hits[item].append((k, at))
        for item, found in hits.items():
            words, own = self.words[item], self.own[item]
            best = None
            for group in self._near(found, len(words)):
                covered = {at + q for _, at in group for q in range(NGRAM)}
                if len(covered) < min(COVERED, len(words)) or not any(words[p] in own for p in covered):
                    continue
                start = max(0, min(k - at for k, at in group) - PASSAGE)
                end = max(k - at for k, at in group) + len(words) + PASSAGE
                got = align(words, doc[start:end], own)
                if got.is_passage() and (best is None or got.matched > best[1]):
                    best = (item, got.matched, got.changed)
            if best:
                yield best

    @staticmethod
    def _near(found: list, length: int) -> Iterator[list]:
        """Hits split where two neighbours are farther apart than the item is long."""
        group: list = []
        for hit in found:
            if group and hit[0] - group[-1][0] > length + 2 * PASSAGE:
                yield group
                group = []
            group.append(hit)
        if group:
            yield group


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"item_id": pdf["item_id"], "words": [words_of(t) for t in pdf["text"]]})


def leaked(documents: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, doc_id, matched and changed words of every document that holds an item's passage.

    Items are cut into blocks of about BLOCK_WORDS words by a hash of their id.  The driver
    holds and broadcasts one block at a time; the corpus is read once a block, without a
    shuffle.  Words that over a share of COMMON of all items have are few: under 1/COMMON times
    an item's words.  Null and empty texts hold nothing; items of under PASSAGE words can have
    no passage.  Repeated rows of one document come out once.
    """
    spark = documents.sparkSession
    texts = items.select("item_id", "text").where(F.col("text").isNotNull())
    worded = cut_lineage(texts.mapInPandas(_words, "item_id long, words array<string>"))
    total = worded.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("words")).first()
    in_items = worded.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > COMMON * total["items"])
    common = {r["word"]: r["n"] / total["items"] for r in in_items.toLocalIterator()}
    blocks = max(1, -(-total["words"] // BLOCK_WORDS))
    parts = []
    for number in range(blocks):
        block = [(r["item_id"], r["words"]) for r in worded.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).toLocalIterator()]
        shared_block = spark.sparkContext.broadcast((block, common))

        def scan(batches: Iterator[pd.DataFrame], shared_block=shared_block) -> Iterator[pd.DataFrame]:
            index = Index(*shared_block.value)
            for pdf in batches:
                out = [(item, d, m, c) for d, t in zip(pdf["doc_id"], pdf["text"]) for item, m, c in index.leaks(words_of(t))]
                yield pd.DataFrame(out, columns=["item_id", "doc_id", "matched", "changed"])

        part = documents.select("doc_id", "text").where(F.col("text").isNotNull()).mapInPandas(scan, "item_id long, doc_id long, matched int, changed int")
        if blocks > 1:
            part = cut_lineage(part)
            shared_block.destroy()
        parts.append(part)
    return reduce(DataFrame.unionByName, parts).groupBy("item_id", "doc_id").agg(F.max("matched").alias("matched"), F.min("changed").alias("changed"))


def without_leaks(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that hold no passage of any item."""
    return documents.join(found.select("doc_id").distinct(), "doc_id", "left_anti")
