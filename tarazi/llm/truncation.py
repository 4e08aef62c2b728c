"""Text cut off by field limits or in mid-transfer.

Two kinds of evidence, both from statistics over all documents:

* Per source, histograms of the lengths in characters and in bytes.  A field limit shows as a
  spike at the maximum; a value at spike length without terminal punctuation is flagged.
* How texts end.  Text inside the corpus that is followed by a line end or a sentence end is
  complete by construction; text followed by further words of its sentence is not.  The last
  words of a text are held against both counts, longest context first, so a text that stops
  where the corpus goes on is cut and one that stops where others stop is not.  This finds the
  texts that no field limit cut, which lengths alone cannot show.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarazi.functions.units import read_unit
from tarazi.operators.skew import lookup
from tarazi.session import cut_lineage

#: A spike: at least this share of the source's texts, and so many texts, within SPIKE_WIDTH below the maximum.
SPIKE_SHARE, SPIKE_COUNT, SPIKE_WIDTH = 0.03, 4, 3
#: Longest tail, in tokens, that is held against the corpus.
TAIL = 4
#: Bits of the filter that keeps tails of no text's end out of the shuffle: so many for each wanted tail, and in all (16 MB) at most.
FILTER_BITS, MOST_FILTER_BITS = 16, 1 << 27
#: Uses of a context that make it known, and a tail's least share of endings among its own uses and among those of its context.
KNOWN, END_SHARE, CONTEXT_SHARE = 5, 0.25, 0.02

_PICTURE = re.compile(r"[☀-➿⬀-⯿\U0001f000-\U0001faff️‍]")
_SMILEY = re.compile(r"[:;]-?[)(D]$")
_CLOSED = re.compile(r"[.!?。！？][\"'”’»)\]]*$")
_TOKEN = re.compile(r"[^\W_]+(?:[-.,/:][^\W_]+)*|\n|[^\w\s]|_")
#: A point that ends a sentence is a token of its own kind, told by the white space after it.
_STOP = re.compile(r"([.!?])(?=\s|$)")
_STOPS = {".": "\ue000", "!": "\ue001", "?": "\ue002"}
_DECIMAL, _HEX, _SIZE = re.compile(r"\d+[.,](\d{1,2})"), re.compile(r"(?=.*\d)[0-9a-f]{6,}"), re.compile(r"\d+(?:[.,]\d+)?([^\W\d_]+)")
_MEASURE = re.compile(r"\d+(?:[.,]\d+)?[ \t\xa0]?([^\W\d_]{1,8})(?![^\W_])")
_NUMBERED = re.compile(r"\d[.,]?$")
_LETTER, _NUMBERS = re.compile(r"[^\W\d_]"), re.compile(r"\d+")
_DIGIT = re.compile(r"\d")
_TAGS, _ITEM = re.compile(r"\s*(?:#\S+\s*)+"), re.compile(r"\s*[-*•]\s+\S")


def pattern(token: str) -> str:
    """A token without the digits that vary: a price keeps its number of decimals, a date and a code their form."""
    if token.isalpha():
        return token.lower()
    if _HEX.fullmatch(token):
        return "x" * len(token)
    if token.isdigit():
        return "9" if len(token) < 4 else "9" * len(token)
    if m := _DECIMAL.fullmatch(token):
        return "9." + "9" * len(m[1])
    if m := _SIZE.fullmatch(token):
        return "9" + m[1].lower()
    if "/" in token and _LETTER.search(token):
        return _NUMBERS.sub("9", token.lower())  # an address
    return _DIGIT.sub("9", token.lower())


@lru_cache(maxsize=4096)
def _is_measure(word: str) -> bool:
    u = read_unit(word)
    return u is not None and u.dimension in ("mass", "volume", "count")


def _sized(m: re.Match) -> str:
    """One token for every size, however its number and unit are written."""
    return "9u" if _is_measure(m[1]) else m[0]


_MASK, _BASE = (1 << 64) - 1, 0x9E3779B97F4A7C15


@lru_cache(maxsize=200_000)
def code(token: str) -> int:
    """64-bit hash of a token's pattern, the same on every worker."""
    return int.from_bytes(hashlib.blake2b(pattern(token).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


START = int.from_bytes(hashlib.blake2b(b"line start", digest_size=8).digest(), "little")
_STOP_CODES = np.array([int.from_bytes(hashlib.blake2b(c.encode(), digest_size=8).digest(), "little") for c in _STOPS.values()], dtype=np.uint64)


def codes_of(text: str) -> list[int]:
    """Codes of the tokens of a text; START stands before each line, once for several line breaks."""
    marked = _STOP.sub(lambda m: _STOPS[m[1]], _MEASURE.sub(_sized, text))
    out = [START]
    for t in _TOKEN.findall(marked):
        if t != "\n":
            out.append(code(t))
        elif out[-1] != START:
            out.append(START)
    return out


def _mixed(h, k: int):
    """A tail's hash with its length worked in, as a positive long."""
    return (h ^ k * 0xD6E8FEB86659FD93 & _MASK) >> 1


def tail_hash(codes: list[int], end: int, k: int) -> int:
    """Hash of the k tokens before ``end``, 0 where the line has fewer."""
    if end < k or START in codes[end - k + 1 : end]:
        return 0
    h = 0
    for c in codes[end - k : end]:
        h = (h * _BASE + c) & _MASK
    return _mixed(h, k)


def body_of(text: str) -> tuple[str, bool]:
    """The text without trailing white space, pictures and mark of omission, and whether it had such a mark.

    Works from the end and reads no more than what it takes off.
    """
    whole = (text or "").rstrip()
    end = len(whole)
    while end:
        if whole[end - 1].isspace() or _PICTURE.match(whole[end - 1]):
            end -= 1
        elif m := _SMILEY.search(whole[max(0, end - 3) : end]):
            end -= len(m[0])
        else:
            break
    t = whole[:end] or whole
    if t.endswith(".."):
        bare = t.rstrip(".").rstrip()
    elif t.endswith("…"):
        bare = t[:-1].rstrip()
    else:
        return t, False
    return (bare, True) if bare else (t, False)


def broken_by_itself(line: str) -> bool:
    """Ends that are cut whatever else the corpus holds: half a character, open mark-up, bracket or quotation."""
    if line.endswith("�") or re.search(r"\\u?[0-9a-fA-F]{0,3}$", line):
        return True
    if re.search(r"<[/A-Za-z!][^<>]*$", line) or re.search(r"&#?\w{0,8}$", line):
        return True
    return line.count("(") - len(re.findall(r"[:;]-?\(", line)) > line.count(")") - len(re.findall(r"[:;]-?\)", line)) or line.count("{") > line.count("}") or line.count("[") > line.count("]") or line.count('"') % 2 == 1 or line.count("«") > line.count("»")


USES = "tail long, ends long, mids long, finals long"
LAST = "doc_id long, source string, text_hash long, chars int, bytes int, closed boolean, broken boolean, numbered boolean, listed boolean, alone boolean, tails array<long>"


def wanted_filter(wanted: DataFrame) -> np.ndarray:
    """A bit array with the bit of every wanted tail set, as 64-bit words; built by the executors.

    Its size depends on the number of tails up to a bound; beyond it more tails pass, none is lost.
    """
    bits = 1 << 10
    while bits < min(wanted.count() * FILTER_BITS, MOST_FILTER_BITS):
        bits *= 2
    at = F.pmod("tail", F.lit(bits))
    words = wanted.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))).alias("held")).toPandas()
    out = np.zeros(bits >> 6, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["held"].to_numpy(np.int64)
    return out.view(np.uint64)


def passes(tails: np.ndarray, held: np.ndarray) -> np.ndarray:
    at = tails & np.uint64((len(held) << 6) - 1)
    return (held[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _uses(shared):
    """Uses of every wanted tail inside the texts: before the end of a line or sentence, or before more of it.

    The tokens of a batch are one array; the tails of each length are sums of shifted arrays.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value
        for pdf in batches:
            codes: list[int] = []
            lasts: list[int] = []
            for text in pdf["text"]:
                if text and text.strip():
                    codes.extend(codes_of(body_of(text)[0]))
                    lasts.append(len(codes) - 1)
            found, ended = tail_uses(np.array(codes, dtype=np.uint64), np.array(lasts, dtype=np.int64))
            some = passes(found, held)
            keys, at = np.unique(found[some], return_inverse=True)
            ends = np.bincount(at, weights=ended[some], minlength=len(keys)).astype("int64")
            all_uses = np.bincount(at, minlength=len(keys)).astype("int64")
            yield pd.DataFrame({"tail": keys.astype("int64"), "ends": ends, "mids": all_uses - ends, "finals": 0})

    return count


def tail_uses(codes: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tails but those at the end of a text, and whether each is followed by an end."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    start, stop = codes == np.uint64(START), np.isin(codes, _STOP_CODES)
    follows = lambda mask: np.append(mask[1:], True)
    ended = stop | follows(start) | follows(stop)
    counted = ~start
    counted[lasts] = False  # the last token of a text says nothing of what follows it
    within = np.arange(n) - np.maximum.accumulate(np.where(start, np.arange(n), 0))
    hashes, flags, h = [], [], np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(1, TAIL + 1):
            h = np.append(np.uint64(0), h[:-1]) * np.uint64(_BASE) + codes if k > 1 else codes.copy()
            take = counted & (within >= k - 1)
            mixed = (h ^ np.uint64(k * 0xD6E8FEB86659FD93 & _MASK)) >> np.uint64(1)
            hashes.append(mixed[take])
            flags.append(ended[take])
    return np.concatenate(hashes), np.concatenate(flags)


def last_words(text: str) -> tuple:
    """closed, broken, numbered, listed, alone and the tails of a text that is not blank.

    The tails are those of 1 to TAIL tokens, then the contexts of those of 2 to TAIL tokens,
    which are the same without the last token.
    """
    body, _ = body_of(text)
    line = body.split("\n")[-1]
    closed = bool(_CLOSED.search(line))
    stripped = re.sub(r"[.!?。！？][.!?。！？\"'”’»]*$", "", line) if closed else line
    tokens = codes_of(stripped)
    end = len(tokens)
    tails = [tail_hash(tokens, end, k) for k in range(1, TAIL + 1)] + [tail_hash(tokens, end - 1, k) if end - 1 >= k else 0 for k in range(1, TAIL)]
    listed = bool(_TAGS.fullmatch(line)) or bool(_ITEM.match(line)) and end <= 9
    return closed, broken_by_itself(line), bool(closed and _NUMBERED.search(stripped)), listed, "\n" in body, tails


def _last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for d, s, text in zip(pdf["doc_id"], pdf["source"], pdf["text"]):
            if text and text.strip():
                raw = text.encode("utf-8", "surrogatepass")
                h = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "big", signed=True)
                rows.append((d, s, h, len(text), len(raw), *last_words(text)))
        yield pd.DataFrame(rows, columns=["doc_id", "source", "text_hash", "chars", "bytes", "closed", "broken", "numbered", "listed", "alone", "tails"])


def length_spikes(documents: DataFrame) -> DataFrame:
    """Field limits by source: source, limit_kind (chars or bytes), limit, texts, at_limit.

    A limit is the largest length of a source where the texts within SPIKE_WIDTH of it are more
    than SPIKE_SHARE of the source, SPIKE_COUNT at least, and over twice as many as in the span
    before, which is three times as wide.
    """
    lengths = documents.where(F.col("text").isNotNull() & (F.trim("text") != "")).select(F.coalesce("source", F.lit("")).alias("source"), F.char_length("text").alias("chars"), F.octet_length("text").alias("bytes"))
    histogram = lengths.select("source", F.explode(F.create_map(F.lit("chars"), F.col("chars"), F.lit("bytes"), F.col("bytes"))).alias("limit_kind", "length")).groupBy("source", "limit_kind", "length").agg(F.count(F.lit(1)).alias("n"))
    top = histogram.groupBy("source", "limit_kind").agg(F.max("length").alias("limit"), F.sum("n").alias("texts"))
    near = histogram.join(top, ["source", "limit_kind"]).where(F.col("length") > F.col("limit") - 4 * SPIKE_WIDTH)
    counted = near.groupBy("source", "limit_kind", "limit", "texts").agg(
        F.sum(F.when(F.col("length") > F.col("limit") - SPIKE_WIDTH, F.col("n")).otherwise(0)).alias("at_limit"),
        F.sum(F.when(F.col("length") <= F.col("limit") - SPIKE_WIDTH, F.col("n")).otherwise(0)).alias("before"),
    )
    return counted.where((F.col("at_limit") >= SPIKE_COUNT) & (F.col("at_limit") > SPIKE_SHARE * F.col("texts")) & (F.col("at_limit") > 2 * F.col("before"))).drop("before")


def _verdict(closed: bool, broken: bool, numbered: bool, listed: bool, alone: bool, at_limit: bool, uses: list) -> bool:
    """Whether a text is cut.

    ``uses`` has (ends, mids, finals) of the tails and contexts of ``last_words``; finals count
    distinct texts that stop there, this one included.
    """
    if broken:
        return True
    if closed and not numbered:
        return False
    ends, mids, finals = uses[0]
    if listed and not closed:
        return ends + mids + finals <= 1  # an item of a list or a tag is whole if its last word is known
    for k in range(TAIL, 0, -1):
        ends, mids, finals = uses[k - 1]
        finals = max(finals - 1, 0)
        stop = ends + finals
        if k > 1:
            context = sum(uses[TAIL + k - 2]) - 1
            if context < KNOWN:
                continue
            if closed and stop + mids == 0:
                return True  # a number followed by a point where the corpus has other numbers
            if stop >= 2 and stop >= END_SHARE * (stop + mids) and stop >= CONTEXT_SHARE * context:
                return at_limit and not closed and not (alone and finals > ends)
            if stop + mids >= 3 and stop < END_SHARE * (stop + mids):
                return not closed or k > 2
        elif not closed:
            return not (ends >= 2 and ends >= END_SHARE * (ends + mids)) or at_limit
    return False


def _judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    own = ["closed", "broken", "numbered", "listed", "alone", "at_limit"]
    for pdf in batches:
        cut = []
        for *flags, evidence in zip(*(pdf[c] for c in own), pdf["evidence"]):
            uses = [(0, 0, 0)] * (2 * TAIL - 1)
            for e in evidence:
                uses[e["k"]] = (e["ends"] or 0, e["mids"] or 0, e["finals"] or 0)
            cut.append(_verdict(*(bool(f) for f in flags), uses))
        yield pdf[["doc_id", "source", "at_limit"]].assign(cut=cut)


def truncated(documents: DataFrame) -> DataFrame:
    """doc_id, source, at_limit and cut of every text that is neither null, empty nor blank.

    The uses of tails are counted in each batch and then over all documents, so a tail on a
    third of all texts costs a row a task.  Tails at the end of no text are kept out of the
    shuffle by a filter of bounded size.  Wholly repeated rows come out once.
    """
    docs = documents.select("doc_id", "source", "text")
    last = cut_lineage(docs.mapInPandas(_last, LAST))
    finals = last.dropDuplicates(["text_hash"]).select(F.explode(F.array_distinct("tails")).alias("tail")).where("tail <> 0").groupBy("tail").agg(F.count(F.lit(1)).alias("finals"))
    rows = last.select("doc_id", "text_hash", F.posexplode("tails").alias("k", "tail")).where("tail <> 0")
    wanted = cut_lineage(rows.groupBy("tail").agg(F.count(F.lit(1)).alias("_n")))
    shared = documents.sparkSession.sparkContext.broadcast(wanted_filter(wanted))
    uses = docs.select("text").mapInPandas(_uses(shared), USES).unionByName(finals.select("tail", F.lit(0).cast("long").alias("ends"), F.lit(0).cast("long").alias("mids"), "finals"))
    totals = uses.groupBy("tail").agg(*[F.sum(c).alias(c) for c in ("ends", "mids", "finals")])
    known = wanted.join(totals, "tail").select(F.col("tail").cast("string").alias("_tail"), "_n", "ends", "mids", "finals")
    found = lookup(rows.withColumn("_tail", F.col("tail").cast("string")), known, "_tail", "_n", ["doc_id", "k"])
    evidence = found.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("k", "ends", "mids", "finals")).alias("evidence"))
    spikes = length_spikes(documents).groupBy(F.col("source").alias("_source")).agg(
        F.max(F.when(F.col("limit_kind") == "chars", F.col("limit"))).alias("max_chars"), F.max(F.when(F.col("limit_kind") == "bytes", F.col("limit"))).alias("max_bytes")
    )
    at_limit = F.coalesce(F.col("chars") > F.col("max_chars") - SPIKE_WIDTH, F.lit(False)) | F.coalesce(F.col("bytes") > F.col("max_bytes") - SPIKE_WIDTH, F.lit(False))
    texts = last.drop("tails").distinct().join(evidence, ["doc_id", "text_hash"]).join(spikes, F.coalesce("source", F.lit("")) == F.col("_source"), "left")
    judged = texts.select("doc_id", "source", "closed", "broken", "numbered", "listed", "alone", at_limit.alias("at_limit"), "evidence")
    return judged.mapInPandas(_judge, "doc_id long, source string, at_limit boolean, cut boolean")


def truncation_report(found: DataFrame) -> DataFrame:
    """Of each source its texts that are not blank, those cut, and their share."""
    return found.groupBy("source").agg(F.count(F.lit(1)).alias("texts"), F.sum(F.col("cut").cast("long")).alias("cut_texts"), F.sum(F.col("at_limit").cast("long")).alias("at_limit"), F.avg(F.col("cut").cast("double")).alias("share"))
