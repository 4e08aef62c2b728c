"""The words of listings and registered products, told apart by statistics over all rows.

No list of goods is used.  Words of brand columns are makers.  Words that stand beside a maker
in registered names are goods: they name a kind or a variant.  Names of other languages are
learned from rows that a barcode or a past decision links: a word that changes places with a
goods word, in rows that otherwise agree, is a name for that.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarazi.llm.listings import edits, neighbours
from tarazi.operators.skew import lookup
from tarazi.session import cut_lineage

#: Registered names with their maker that a goods word stands in at least.
MARKED = 2
#: A registered word of names without a maker is a goods word beside another one if it has this share, and so many, of that one's names.
PAIR_SHARE, PAIR_COUNT = 0.08, 4
#: A word is foreign if it changes places in this share of its linked rows.
FOREIGN_SHARE = 0.35
#: A word stands for the goods words with which it changes places in so many rows, in this share of those in which it does with any, and of all changes.
MEANING_COUNT, MEANING_SHARE, CHANGE_SHARE = 2, 0.8, 0.3
#: A goods word implies others that this share of its registered names have, if it has so many.
IMPLIED_SHARE, IMPLIED_COUNT = 0.97, 5
#: A goods word, or two of them together, is sold by weight if this share of its registered names is.
WEIGHED_SHARE = 0.9
#: A word that implies a kind is the kind itself if it is at least so frequent beside it.
NARROWER = 0.6
#: A word is a misspelling of one that is so many times as frequent.
REPAIR_RATIO = 3
#: An unknown word that occurs so often, and with no more kinds than this, is a maker or origin where the row states no other.
MAKER_COUNT, MAKER_KINDS = 3, 4

GOODS = "array<struct<g:string,n:bigint,mates:array<string>,implied:array<struct<g:string,n:bigint>>,weighed:boolean,weighed_with:array<string>>>"


def links_of(raw: DataFrame, decisions: DataFrame | None) -> DataFrame:
    """src, id and group of rows that share a barcode, and of products with the listings last decided for them."""
    parts = raw.where(F.col("ean").isNotNull()).select("src", "id", F.concat(F.lit("e"), "ean").alias("group"))
    if decisions is not None:
        stated = decisions.where(F.col("product_id").isNotNull() & F.col("store_item_id").isNotNull())
        last = stated.groupBy("store_item_id").agg(F.max_by("product_id", F.struct("snapshot_date", "loaded_at", "product_id")).cast("long").alias("product_id"))
        group = F.concat(F.lit("p"), F.col("product_id").cast("string")).alias("group")
        parts = parts.unionByName(last.select(F.lit("i").alias("src"), F.col("store_item_id").cast("long").alias("id"), group))
        parts = parts.unionByName(last.select(F.lit("p").alias("src"), F.col("product_id").alias("id"), group).distinct())
    return parts


def registry_goods(raw: DataFrame, brands: DataFrame) -> DataFrame:
    """Words of registered names that no brand column has, and whether they are goods words."""
    own = raw.where(F.col("src") == "p").select("id", F.explode("tokens").alias("word"), F.coalesce(F.arrays_overlap("tokens", "brand"), F.lit(False)).alias("marked"))
    own = own.join(brands.select("word"), "word", "left_anti")
    counts = cut_lineage(own.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("marked").cast("long")).alias("n_marked")))
    unsure = own.join(counts.where((F.col("n_marked") < MARKED) & (F.col("n") >= PAIR_COUNT)).select("word"), "word", "left_semi").select("id", "word")
    beside = own.join(counts.where(F.col("n") >= PAIR_COUNT).select("word", "n"), "word").select("id", F.col("word").alias("other"), F.col("n").alias("n_other"))
    pairs = unsure.join(beside, "id").where(F.col("word") != F.col("other")).groupBy("word", "other", "n_other").agg(F.count(F.lit(1)).alias("c"))
    paired = pairs.where((F.col("c") >= PAIR_COUNT) & (F.col("c") >= PAIR_SHARE * F.col("n_other"))).select("word").distinct().withColumn("paired", F.lit(True))
    return counts.join(paired, "word", "left").select("word", ((F.col("n_marked") >= MARKED) | F.coalesce("paired", F.lit(False))).alias("goods"))


def meanings(raw: DataFrame, links: DataFrame, goods: DataFrame) -> DataFrame:
    """word, foreign and means (the goods words it stands for, may be empty) of words that linked rows tell of.

    The words of a group are counted; those in over half of its rows, or in a registered name,
    are common to it, so at most a few more than a name has.  Rows meet only these, never each
    other.  A row that agrees with most of them is a witness: a word that only it has and a word
    that only it lacks have changed places.  A word stands for goods words with which it mostly
    changes places, the rarer word for the more frequent one.  A word that often changes places
    is foreign.
    """
    rows = cut_lineage(links.join(raw.select("src", "id", F.array_union("tokens", "brand").alias("words")), ["src", "id"]))
    sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("m"))
    held = rows.select("group", "src", F.explode("words").alias("word")).groupBy("group", "word").agg(F.count(F.lit(1)).alias("f"), F.max(F.col("src") == "p").alias("registered"))
    usual = held.join(sizes.where(F.col("m") > 1), "group").where(F.col("registered") | (F.col("f") * 2 > F.col("m")))
    common = usual.groupBy("group", "m").agg(F.collect_list("word").alias("common"))
    met = lookup(rows, common.select("group", "m", "common"), "group", "m", ["src", "id"]).where(F.col("common").isNotNull())
    told = met.select(F.xxhash64("src", "id").alias("row"), F.array_except("words", "common").alias("strange"), F.array_except("common", "words").alias("lacked"), F.array_intersect("words", "common").alias("usual"))
    told = cut_lineage(told.where((F.size("usual") > 0) & (F.size("lacked") <= F.size("usual") + 1)))
    tagged = lambda c, kind: F.transform(c, lambda w: F.struct(w.alias("word"), F.lit(kind).alias("changed")))
    seen = told.select(F.explode(F.concat(tagged("strange", 1), tagged("lacked", 1), tagged("usual", 0))).alias("x")).groupBy("x.word").agg(F.count(F.lit(1)).alias("rows"), F.sum("x.changed").alias("changed"))
    seen = cut_lineage(seen.select("word", "changed", (F.col("changed") >= FOREIGN_SHARE * F.col("rows")).alias("foreign")))
    native = cut_lineage(goods.where("goods").join(seen.where("foreign").select("word"), "word", "left_anti").select(F.col("word").alias("means")))
    sides = [told.select("row", F.explode(x).alias("word"), y).select("row", "word", F.explode(y).alias("means")) for x, y in (("strange", "lacked"), ("lacked", "strange"))]
    swaps = sides[0].unionByName(sides[1]).join(native, "means").join(native.select(F.col("means").alias("word")), "word", "left_anti")
    swaps = cut_lineage(swaps.groupBy("word", "means", "row").agg(F.count(F.lit(1)).alias("n")))
    changes = swaps.groupBy("word").agg(F.countDistinct("row").alias("swapped"))
    pairs = swaps.groupBy("word", "means").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n")).join(changes, "word").join(seen.select("word", "changed"), "word")
    kept = pairs.where((F.col("c") >= MEANING_COUNT) & (F.col("c") >= MEANING_SHARE * F.col("swapped")) & (F.col("n") >= CHANGE_SHARE * F.col("changed")))
    means = kept.groupBy("word").agg(F.sort_array(F.collect_list("means")).alias("means"))
    return seen.join(means, "word", "left").select("word", (F.col("foreign") | F.col("means").isNotNull()).alias("foreign"), F.coalesce("means", F.array().cast("array<string>")).alias("means"))


def goods_info(raw: DataFrame, native: DataFrame, foreign: DataFrame) -> DataFrame:
    """g, n, mates, implied, weighed and weighed_with of every native goods word, from the registered names without a foreign word.

    ``n`` is the number of names a size they come in, a thousandfold: a kind comes in few sizes,
    a variant in those of all its kinds.
    """
    words = raw.where(F.col("src") == "p").select("id", "size", F.explode("tokens").alias("word"))
    mixed = words.join(foreign, "word", "left_semi").select("id").distinct()
    own = cut_lineage(words.join(native, "word").join(mixed, "id", "left_anti").select("id", F.coalesce("size", F.lit("")).alias("size"), F.col("word").alias("g")))
    many = (F.count(F.lit(1)) * 1000 / F.countDistinct("size")).cast("long")
    totals = own.groupBy("g").agg(F.count(F.lit(1)).alias("names"), many.alias("n"), (F.avg((F.col("size") == "bulk").cast("double")) >= WEIGHED_SHARE).alias("weighed"))
    bulk = (F.avg((F.col("size") == "bulk").cast("double")) >= WEIGHED_SHARE).alias("bulk")
    pairs = own.join(own.select("id", F.col("g").alias("o")), "id").where(F.col("g") != F.col("o")).groupBy("g", "o").agg(F.count(F.lit(1)).alias("c"), bulk)
    pairs = pairs.join(totals.select("g", "names"), "g").join(totals.select(F.col("g").alias("o"), F.col("n").alias("n_o")), "o")
    sure = (F.col("c") >= IMPLIED_SHARE * F.col("names")) & (F.col("names") >= IMPLIED_COUNT)
    sides = pairs.groupBy("g").agg(F.sort_array(F.collect_list("o")).alias("mates"), F.collect_list(F.when(sure, F.struct(F.col("o").alias("g"), F.col("n_o").alias("n")))).alias("implied"), F.sort_array(F.collect_list(F.when(F.col("bulk"), F.col("o")))).alias("weighed_with"))
    none = lambda kind: F.array().cast(kind)
    return totals.join(sides, "g", "left").select("g", "n", F.coalesce("mates", none("array<string>")).alias("mates"), F.coalesce("implied", none("array<struct<g:string,n:bigint>>")).alias("implied"), "weighed", F.coalesce("weighed_with", none("array<string>")).alias("weighed_with"))


def kind_in(goods: dict) -> frozenset:
    """The words of the kind among goods words (each with what goods_info knows of it, implied ones included).

    The word with the most names a size, or a nearly as frequent one that implies it, and what that implies.
    """
    if not goods:
        return frozenset()
    counts = {o["g"]: o["n"] for x in goods.values() for o in x["implied"]} | {g: x["n"] for g, x in goods.items()}
    implied = {g: {o["g"] for o in x["implied"]} for g, x in goods.items()}
    head = max(counts, key=lambda g: (counts[g], g))
    narrower = [g for g in goods if head in implied[g] and g not in implied.get(head, ()) and counts[g] >= NARROWER * counts[head]]
    head = max(narrower, key=lambda g: (counts[g], g), default=head)
    return frozenset({head} | implied.get(head, set()))


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(w, n, k) for w, n in zip(pdf["word"], pdf["n"]) if len(w) >= 4 and w.isalpha() for k in neighbours(w)]
        yield pd.DataFrame(rows, columns=["word", "n", "near"])


def _close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf[[edits(a, b, 1) <= 1 for a, b in zip(pdf["word"], pdf["target"])]]


def repairs(strange: DataFrame, known: DataFrame) -> DataFrame:
    """word and target of every unknown word that is one edit from a word REPAIR_RATIO times as frequent; a word may have several.

    Words meet by what is left of them without one letter, so no pairs of all words arise.
    """
    keys = "word string, n long, near string"
    targets = known.select("word", "n").mapInPandas(_keys, keys).select(F.col("word").alias("target"), F.col("n").alias("target_n"), "near")
    met = strange.select("word", "n").mapInPandas(_keys, keys).join(targets, "near").where(F.col("target_n") >= REPAIR_RATIO * F.col("n")).select("word", "target").distinct()
    return met.mapInPandas(_close, "word string, target string")


def roles_of(raw: DataFrame, decisions: DataFrame | None) -> DataFrame:
    """One row a word and target (itself or what it is a misspelling of): word, known, target, n, goods, maker and origin."""
    counts = cut_lineage(raw.select(F.explode("tokens").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    brands = cut_lineage(raw.select(F.explode("brand").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n_brand")))
    goods = cut_lineage(registry_goods(raw, brands))
    told = cut_lineage(meanings(raw, links_of(raw, decisions), goods))
    v = counts.join(brands, "word", "full_outer").join(goods, "word", "left").join(told, "word", "left")
    foreign = F.coalesce("foreign", F.lit(False))
    stands = F.when(F.size("means") > 0, F.col("means")).when(F.coalesce("goods", F.lit(False)) & ~foreign, F.array("word")).otherwise(F.array().cast("array<string>"))
    branded = F.col("n_brand").isNotNull()
    v = cut_lineage(
        v.select(
            "word", F.coalesce("n", "n_brand").alias("n"), branded.alias("branded"), F.when(branded, F.array().cast("array<string>")).otherwise(stands).alias("stands"), foreign.alias("foreign"),
            (F.col("goods").isNotNull() | branded | (F.size(stands) > 0)).alias("known"), (branded | (F.col("goods").isNotNull() & ~F.col("goods") & (F.size(stands) == 0))).alias("maker"),
        )
    )
    named = v.where(F.size("stands") > 0).select("word", "stands")
    # two words for goods written as one; a row tells them apart by the places of its words
    steps = raw.select(F.explode(F.transform(F.sequence(F.lit(0), F.greatest(F.size("tokens") - 2, F.lit(0))), lambda i: F.struct(F.get("tokens", i).alias("a"), F.get("tokens", i + 1).alias("b")))).alias("s")).select("s.a", "s.b")
    steps = steps.where(F.col("b").isNotNull()).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    both = steps.join(named.select(F.col("word").alias("a"), F.col("stands").alias("x")), "a").join(named.select(F.col("word").alias("b"), F.col("stands").alias("y")), "b")
    joined = both.groupBy(F.concat("a", "b").alias("word")).agg(F.max("n").alias("n"), F.max_by(F.array_union("x", "y"), "n").alias("stands")).join(v.where("known").select("word"), "word", "left_anti")
    flag = lambda x: F.lit(x)
    all_known = cut_lineage(v.where("known").select("word", "n", "stands", "maker").unionByName(joined.select("word", "n", "stands", flag(False).alias("maker"))))
    info = cut_lineage(goods_info(raw, v.where(F.array_contains("stands", F.col("word"))).select("word"), v.where("foreign and not maker").select("word")))
    strange = v.join(all_known.select("word"), "word", "left_anti").where(F.size("stands") == 0)
    mended = repairs(strange, all_known).join(all_known.withColumnRenamed("word", "target"), "target").select("word", "target", "n", "stands", "maker", flag(False).alias("known"))
    rest = strange.join(mended.select("word"), "word", "left_anti").where(~F.col("foreign") & F.col("word").rlike(r"^\p{L}{4,}$") & (F.col("n") >= MAKER_COUNT)).select("word")
    plain = all_known.select("word", F.col("word").alias("target"), "n", "stands", "maker", flag(True).alias("known")).unionByName(mended)
    about = info.select("g", F.struct("g", "n", "mates", "implied", "weighed", "weighed_with").alias("about"))
    held = plain.withColumn("g", F.explode_outer("stands")).join(about, "g", "left").groupBy("word", "target", "n", "maker", "known").agg(F.collect_list("about").alias("goods"))
    held = held.select("word", "known", "target", "n", F.col("goods").cast(GOODS).alias("goods"), "maker", flag(False).alias("origin"))
    return cut_lineage(held.unionByName(_unknown_makers(raw, rest, named, info)))


def _unknown_makers(raw: DataFrame, words: DataFrame, named: DataFrame, info: DataFrame) -> DataFrame:
    """Unknown words that few kinds of goods have: makers or origins that are not registered."""
    where = raw.select("src", "id", F.explode("tokens").alias("word"))
    kinds = where.join(named, "word").select("src", "id", F.explode("stands").alias("g")).join(info.select("g", "n"), "g").groupBy("src", "id").agg(F.max_by("g", F.struct("n", "g")).alias("kind"))
    spread = where.join(words, "word", "left_semi").join(kinds, ["src", "id"]).groupBy("word").agg(F.countDistinct("kind").alias("n_kinds"), F.count(F.lit(1)).alias("n"))
    few = spread.where(F.col("n_kinds") <= MAKER_KINDS)
    return few.select("word", F.lit(False).alias("known"), F.col("word").alias("target"), "n", F.array().cast(GOODS).alias("goods"), F.lit(False).alias("maker"), F.lit(True).alias("origin"))
