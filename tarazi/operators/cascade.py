"""A matching cascade by waves: barcode, fingerprint, tolerant fingerprint, similar names.

Each wave is written once and joins what is still alone to the products of the waves before,
through any of their listings.  A fingerprint match takes one listing a retailer at most.
Similar names of equal sizes are all compared, a square of at most CHUNK listings at a time;
bounds from the letters of names and brands leave few pairs to score.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarazi.functions.scalars import fingerprint, loose_fingerprint, name_parts, similarity
from tarazi.operators.skew import lookup
from tarazi.session import cut_lineage

# Scores of a match and of one for review, the lead of a match, and the candidates kept for review.
AUTO, REVIEW, MARGIN, CANDIDATES = 0.88, 0.70, 0.04, 3
# Weights of name, brand and category, the share of a brand that one side lacks, and the similarity of equal brands.
NAME, BRAND, CATEGORY, UNKNOWN_BRAND, SAME_BRAND = 0.60, 0.25, 0.15, 0.6, 85
#: Rows of one side of a comparison, and the places that letters are counted in.
CHUNK, LETTERS = 1000, 64


def prepared(items: DataFrame) -> DataFrame:
    """id, retailer_code, ean (global only), block (the recorded size), fat, numbers, brand, category, keys, words and the order of processing."""
    size = F.concat_ws("|", F.coalesce("unit_type", F.lit("")), F.coalesce(F.col("unit_value").cast("string"), F.lit("")), F.coalesce(F.col("pack").cast("string"), F.lit("")))
    named = items.withColumn("_p", name_parts(F.col("name_raw")))
    parts = F.col("_p")
    tail = F.concat(F.lit("|"), *[F.concat(F.coalesce(parts[c].cast("string"), F.lit("")), F.lit("|")) for c in ("size", "pack", "fat")])
    return named.select(
        "id", "retailer_code", F.when(F.col("ean_kind") == "global", F.trim("ean")).alias("ean"), size.alias("block"), F.coalesce(parts["fat"], F.lit("")).alias("fat"), F.array_join(parts["numbers"], " ").alias("numbers"),
        F.lower("brand").alias("brand"), "category", F.concat(fingerprint(parts), tail).alias("key"), F.concat(loose_fingerprint(parts), tail).alias("loose"), F.array_distinct(parts["words"]).alias("words"),
        F.struct((F.coalesce("ean_kind", F.lit("none")) != "global").alias("a"), F.col("retailer_code").alias("b"), F.col("id").alias("c")).alias("rank"),
    )


def _by_key(rows: DataFrame, decided: DataFrame, key: str, method: str, confidence: float) -> DataFrame:
    """Undecided listings with the key of an earlier listing join its product, if that has no listing of their retailer yet.

    The earliest listing with a key stands for it; of one retailer the first listing joins.
    """
    held = rows.where(F.col(key).isNotNull()).join(decided.select("id", "product"), "id", "left").select("id", "retailer_code", key, "rank", "product")
    founder = held.groupBy(key).agg(F.min(F.struct("rank", "product")).alias("_f")).select(key, F.coalesce("_f.product", "_f.rank.c").alias("product"), F.col("_f.rank.c").alias("_founder"))
    first = held.where(F.col("product").isNull()).groupBy(key, "retailer_code").agg(F.min("rank").alias("_r"))
    met = first.join(founder, key).where(F.col("_r.c") != F.col("_founder")).groupBy("product", "retailer_code").agg(F.min("_r").alias("_r"))
    taken = rows.select("id", "retailer_code").join(decided, "id", "left").select(F.coalesce("product", "id").alias("product"), "retailer_code").distinct()
    free = met.join(taken, (met.product == taken.product) & met.retailer_code.eqNullSafe(taken.retailer_code), "left_anti")
    return free.select(F.col("_r.c").alias("id"), "product", F.lit(method).alias("method"), F.lit(confidence).alias("confidence"))


def matched(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The listings with their products, and the scored candidates (id, product, score) of those that similar names were sought for."""
    rows = cut_lineage(prepared(items.dropDuplicates(["id"])))
    coded = rows.where(F.col("ean").isNotNull())
    founders = coded.groupBy("ean").agg(F.min("rank").alias("_f"))
    decided = cut_lineage(coded.join(founders, "ean").where(F.col("id") != F.col("_f.c")).select("id", F.col("_f.c").alias("product"), F.lit("ean").alias("method"), F.lit(1.0).alias("confidence")))
    for key, method, confidence in (("key", "fingerprint", 0.95), ("loose", "loose_fingerprint", 0.92)):
        decided = cut_lineage(decided.unionByName(_by_key(rows, decided, key, method, confidence)))
    scored = cut_lineage(similar(rows.join(decided.select("id"), "id", "left_anti")))
    best = Window.partitionBy("id").orderBy(F.desc("score"), "product")
    two = scored.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= 2).groupBy("id").agg(F.max(F.when(F.col("_n") == 1, F.struct("score", "product"))).alias("t"), F.max(F.when(F.col("_n") == 2, F.col("score"))).alias("second"))
    clear = (F.col("t.score") >= AUTO) & (F.col("second").isNull() | (F.col("t.score") - F.col("second") >= MARGIN))
    top = two.select("id", F.col("t.score").alias("confidence"), F.col("t.product").alias("near"), clear.alias("clear"))
    fuzzy = top.select("id", F.when(F.col("clear"), F.col("near")).otherwise(F.col("id")).alias("product"), F.when(F.col("clear"), "fuzzy").otherwise("review").alias("method"), "confidence")
    decided = decided.unionByName(fuzzy)
    new = rows.select("id").join(decided.select("id"), "id", "left_anti").select("id", F.col("id").alias("product"), F.lit("new").alias("method"), F.lit(1.0).alias("confidence"))
    status = F.when(F.col("method") == "review", "pending_review").when(F.col("method") == "new", "singleton").otherwise("auto")
    return resolve(decided.unionByName(new)).withColumn("status", status), scored


def cascade(items: DataFrame) -> DataFrame:
    """id, product (the id of its founding listing), method, confidence and status of every listing.

    Listings without a barcode and with fewer than two words match by similar names only.  Ties
    of similar names leave a listing for review.  Repeated ids count once.
    """
    return matched(items)[0]


def review_candidates(items: DataFrame) -> DataFrame:
    """id, place, candidate and score: the products that a listing left for review is most similar to, CANDIDATES at most."""
    found, scored = matched(items)
    waiting = scored.join(found.where(F.col("status") == "pending_review").select("id"), "id", "left_semi")
    root = waiting.join(found.select(F.col("id").alias("product"), F.col("product").alias("candidate")), "product").groupBy("id", "candidate").agg(F.max("score").alias("score"))
    best = Window.partitionBy("id").orderBy(F.desc("score"), "candidate")
    return root.withColumn("place", F.row_number().over(best)).where(F.col("place") <= CANDIDATES).select("id", "place", "candidate", "score")


def resolve(links: DataFrame) -> DataFrame:
    """Products of products followed to the founder: each round doubles the steps, until no product moves."""
    out = cut_lineage(links)
    while True:
        up = out.where(F.col("id") != F.col("product")).select(F.col("id").alias("product"), F.col("product").alias("_up"))
        moved = cut_lineage(out.join(up, "product", "left").select("id", F.coalesce("_up", "product").alias("product"), "method", "confidence", F.col("_up").isNotNull().alias("_moved")))
        out = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return out


def _bound(a: list[str], b: list[str]) -> np.ndarray:
    """For each pair of two lists a number that the similarity, as a share, is never above: by the letters in common."""
    def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros((len(texts), LETTERS), np.int32)
        for row, text in zip(out, texts):
            for ch in text:
                row[ord(ch) % LETTERS] += 1
        return out, out.sum(1)

    (x, n), (y, m) = counted(a), counted(b)
    common = np.zeros((len(a), len(b)), np.int32)
    for k in np.flatnonzero(x.any(0) & y.any(0)):
        common += np.minimum.outer(x[:, k], y[:, k])
    return 2 * common / np.maximum(n[:, None] + m[None, :], 1) + (n[:, None] + m[None, :] == 0)


@lru_cache(maxsize=100_000)
def _brand(p: str | None, q: str | None) -> float | None:
    """1 for similar brands, UNKNOWN_BRAND where one is missing, None where they differ."""
    return UNKNOWN_BRAND if p is None or q is None else 1.0 if similarity(p, q) >= SAME_BRAND else None


def _compared(pdf: pd.DataFrame) -> pd.DataFrame:
    """The pairs of a square that may score REVIEW: id, product, and the parts of the score."""
    pdf = pdf.sort_values(["late", "retailer_code", "id"], kind="stable").reset_index(drop=True)
    pdf["brand"] = pdf["brand"].astype(object).where(pdf["brand"].notna(), None)
    left, right = pdf[pdf["chunk"] == pdf["i"]], pdf[pdf["chunk"] == pdf["j"]]
    codes = {c: pd.Series(pd.factorize(pdf[c])[0], pdf.index) for c in ("retailer_code", "category", "brand")}
    grid = lambda s: (s[left.index].to_numpy()[:, None], s[right.index].to_numpy()[None, :])
    (r, t), (c, d), (p, q), (f, g), (k, h) = (grid(x) for x in (codes["retailer_code"], codes["category"], codes["brand"], pdf["fat"], pdf["numbers"]))
    able = (r != t) & (r >= 0) & (t >= 0) & ((f == g) | (f == "") | (g == "")) & ((k == h) | (k == "") | (h == ""))
    if pdf["i"].iloc[0] == pdf["j"].iloc[0]:
        able &= np.arange(len(left))[:, None] > np.arange(len(right))[None, :]
    brands = list(pd.factorize(pdf["brand"])[1])
    near = np.pad(_bound(brands, brands) >= SAME_BRAND / 100 - 1e-9, ((0, 1), (0, 1)), constant_values=True)  # -1, the last: no brand
    able &= near[p, q]
    least = (REVIEW - 0.0005 - 1e-9 - BRAND * np.where((p < 0) | (q < 0), UNKNOWN_BRAND, 1.0) - CATEGORY * (c == d)) / NAME
    able &= _bound(list(left["name"]), list(right["name"])) >= least
    out, equal = [], c == d
    ids, names, makers = pdf["id"].tolist(), pdf["name"].tolist(), pdf["brand"].tolist()
    for u, v in zip(*np.nonzero(able)):
        x, y, floor, same = left.index[u], right.index[v], least[u, v], bool(equal[u, v])
        brand = _brand(makers[x], makers[y])
        if brand is not None and (name := similarity(names[x], names[y])) / 100 >= floor:
            out.append((ids[max(x, y)], ids[min(x, y)], name, brand, same))
    return pd.DataFrame(out, columns=["id", "product", "name", "brand", "same"])


def similar(rows: DataFrame) -> DataFrame:
    """id, product and score of all pairs of different retailers with equal sizes and a score of REVIEW or more, the earlier listing as product.

    A brand that differs excludes the pair, as do another percentage and other numbers.  A block
    of equal sizes is compared as a whole, in squares of its chunks; names without words stay out.
    """
    side = rows.where(F.size("words") > 0).select("id", "block", "retailer_code", "fat", "numbers", "brand", "category", F.array_join(F.array_sort("words"), " ").alias("name"), F.col("rank.a").cast("int").alias("late"))
    sizes = side.groupBy("block").agg(F.count(F.lit(1)).alias("n")).withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    chunk = lookup(side, sizes, "block", "n", ["id"]).withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
    spread = chunk.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")).drop("other", "chunks")
    kind = rows.schema["id"].dataType.simpleString()
    parts = spread.groupBy("block", "i", "j").applyInPandas(_compared, f"id {kind}, product {kind}, name double, brand double, same boolean")
    score = F.round(F.col("name") / 100 * NAME + F.col("brand") * BRAND + F.col("same").cast("double") * CATEGORY, 3)
    return parts.select("id", "product", score.alias("score")).where(F.col("score") >= REVIEW)
