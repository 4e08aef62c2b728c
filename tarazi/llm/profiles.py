"""Listings and registered products as attributes: kind, variant, maker, size of a piece, pieces, barcode.

The kind is the most usual goods word of a name with those that it implies, the variant its
other goods words; see ``vocabulary`` for how words are told apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarazi.llm.listings import brand_tokens, gtin, size_key, tokens_of, whole_words
from tarazi.llm.vocabulary import GOODS, kind_in, roles_of
from tarazi.operators.skew import lookup
from tarazi.session import cut_lineage

RAW = "src string, id long, tokens array<string>, brand array<string>, size string, pack int, ean string"
PROFILE = "src string, id long, kind string, variant string, maker string, size string, pack int, ean string, extra array<string>"
ROLE = f"array<struct<word:string,known:boolean,target:string,n:bigint,goods:{GOODS},maker:boolean,origin:boolean>>"


def _read(src: str, name: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, n, b, v, u, pk, e in zip(pdf["id"], pdf[name], pdf["brand"], pdf["unit_value"], pdf["unit_type"], pdf["pack"], pdf["ean"]):
                size, pack = size_key(n, v, u, pk)
                rows.append((src, i, list(tokens_of(n)), list(brand_tokens(b)), size, min(pack, 2**31 - 1), gtin(e)))
            yield pd.DataFrame(rows, columns=["src", "id", "tokens", "brand", "size", "pack", "ean"])

    return read


def raw_terms(items: DataFrame, products: DataFrame) -> DataFrame:
    """Tokens and sizes of listings (src ``i``) and registered products (src ``p``), before words are told apart; repeated rows once."""
    columns = ["brand", "unit_value", "unit_type", "pack", "ean"]
    registered = products.select("id", "name", *columns).mapInPandas(_read("p", "name"), RAW)
    return registered.unionByName(items.select("id", "name_raw", *columns).mapInPandas(_read("i", "name_raw"), RAW)).dropDuplicates(["src", "id"])


def _goods(words: list[str], info: dict) -> tuple[dict, set]:
    """The goods words that the words of a name stand for, each with what is known of it, and the words that named them.

    A misspelling that is near several words is the first of them that has been seen with
    another goods word of the name.  Goods words that were never seen with any other of the
    name are left out, if others were.
    """
    sure = {g["g"] for w in words if w in info and len(info[w]) == 1 for g in info[w][0]["goods"]}
    found: dict = {}
    used = set()
    for w in words:
        ways = info.get(w, ())
        way = next((r for r in ways if len(ways) > 1 and any(m in sure for g in r["goods"] for m in g["mates"])), ways[0] if ways else None)
        if way is not None and len(way["goods"]):
            used.add(w)
            found.update({g["g"]: g for g in way["goods"]})
    seen = {g: x for g, x in found.items() if any(o != g and o in found for o in x["mates"])}
    return seen or found, used


def _assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for src, i, tokens, brand, size, pack, ean, found in zip(*(pdf[c] for c in ("src", "id", "tokens", "brand", "size", "pack", "ean", "found"))):
            info: dict = {}
            for f in sorted(found, key=lambda f: (-f["n"], f["target"])):
                info.setdefault(f["word"], []).append(f)
            known = lambda w: w in info and info[w][0]["known"]
            words = whole_words(tuple(tokens), known)
            goods, used = _goods(words, info)
            kind, named = kind_in(goods), set(goods) | {o["g"] for x in goods.values() for o in x["implied"]}
            whole = goods and all(o in kind for g in kind if g in goods for o in goods[g]["mates"])  # the registry knows no variants of it
            variant = " ".join(sorted(named - kind)) or ("" if whole else None)
            maker, origin, extra = set(), set(), []
            for w in words:
                way = info[w][0] if w in info else None
                if w in used:
                    continue
                if way is not None and way["maker"]:
                    maker.add(way["target"])
                elif way is not None and way["origin"]:
                    origin.add(w)
                else:
                    extra.append(w)
            maker = maker or {info[w][0]["target"] if w in info else w for w in brand}
            extra += sorted(origin) if maker else []
            maker = maker or origin
            if size in (None, "1000g", "bulk") and any(x["weighed"] or any(o in named for o in x["weighed_with"]) for x in goods.values()):
                size, pack = "bulk", 1
            rows.append((src, i, " ".join(sorted(kind)) or None, variant, " ".join(sorted(maker)) or None, size, pack, ean, extra))
        yield pd.DataFrame(rows, columns=["src", "id", "kind", "variant", "maker", "size", "pack", "ean", "extra"])


def profiles(items: DataFrame, products: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """src, id, kind, variant, maker, size, pack, ean and extra words of every listing and product.

    Attributes that a row does not state are null (pack 1); the variant of a kind that has none
    is empty.  Null and empty names have no
    words; a brand column stands in for a maker that the name lacks.  Repeated rows come out
    once.  Words are joined by shuffle, as the vocabulary grows with the data.  Past decisions,
    if given, add links from which names in other languages are learned.
    """
    raw = cut_lineage(raw_terms(items, products))
    roles = roles_of(raw, decisions)
    by_word = roles.groupBy("word").agg(F.collect_list(F.struct("word", "known", "target", "n", "goods", "maker", "origin")).alias("ways"))
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.size("tokens") - 2, F.lit(0))), lambda i: F.concat(F.get("tokens", i), F.get("tokens", i + 1)))
    pairs = F.filter(pairs, lambda w: w.isNotNull())
    wanted = raw.select("src", "id", F.explode(F.array_distinct(F.concat("tokens", pairs, "brand"))).alias("word"))
    counts = wanted.groupBy("word").agg(F.count(F.lit(1)).alias("_n"))
    got = lookup(wanted, counts.join(by_word, "word"), "word", "_n", ["id", "word"])
    found = got.where(F.col("ways").isNotNull()).groupBy("src", "id").agg(F.flatten(F.collect_list("ways")).alias("found"))
    joined = raw.join(found, ["src", "id"], "left").withColumn("found", F.coalesce("found", F.array().cast(ROLE)))
    return cut_lineage(joined.mapInPandas(_assemble, PROFILE))
