"""Matching listings to a product registry without a shared key.

MinHash over combinations of attributes finds candidates; each pair of a class of listings and
a product gets similarity features; a logistic classifier is trained on past decisions as weak
labels and its scores are calibrated by isotonic regression on decisions it was not trained on.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarazi.llm.duplicates import ATTRIBUTES, _key, classes_of
from tarazi.operators.skew import lookup
from tarazi.session import cut_lineage

#: Hash functions of a signature, one a band: a pair that shares a fifth of its shingles is missed once in 200.
HASHES = 24
#: Scores at which the calibration counts one case as likely as the score says.
ANCHORS = range(-6, 7)
#: Labelled pairs that the classifier is fitted on at most; half of them for the fit, half for the calibration.
LABELLED_PAIRS = 20_000
#: A candidate is accepted from this probability on, if the next one is so much less likely.
ACCEPT, MARGIN = 0.5, 0.02
FEATURES = ["variant_same", "variant_unknown", "maker_same", "maker_unknown", "size_same", "size_unknown", "pack_same", "ean_same", "ean_differs"]
#: Weights that the fit starts from and is drawn to, in the order of FEATURES, then the intercept.
PRIOR = [4.0, 1.0, 4.0, 1.0, 3.0, 1.0, 2.0, 4.0, -1.0, -9.0]


def _shingle(*columns: str) -> Column:
    ready = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns])
    return F.when(ready, F.concat_ws("\u0001", F.lit("+".join(columns)), *[F.col(c).cast("string") for c in columns]))


def signature(df: DataFrame, loose: bool) -> DataFrame:
    """``band`` and ``low``, the minimum of each hash function over the row's shingles of attributes.

    ``loose`` rows give the shingle without the maker in any case, others only where they have
    no maker: a listing that states its maker need not meet all makers' goods.
    """
    whole = [("kind", "variant", "maker", "size", "pack"), ("kind", "variant", "maker"), ("kind", "maker", "size", "pack"), ("ean",)]
    shingles = [_shingle(*w) for w in whole]
    no_maker = _shingle("kind", "variant", "size", "pack")
    shingles.append(no_maker if loose else F.when(F.col("maker").isNull(), no_maker))
    held = F.array_compact(F.array(*shingles))
    lows = F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.struct(i.alias("band"), F.array_min(F.transform(held, lambda s: F.xxhash64(i, s))).alias("low")))
    return df.where(F.size(held) > 0).withColumn("_b", F.explode(lows)).select(*df.columns, F.col("_b.band").alias("band"), F.col("_b.low").alias("low"))


def candidates(classes: DataFrame, products: DataFrame) -> DataFrame:
    """Class keys and products that agree in the minimum of a hash function, each pair once."""
    left = signature(classes.select("ck", *ATTRIBUTES, "ean"), loose=False).select("ck", "band", "low")
    right = signature(products.select(F.col("id").alias("product_id"), *ATTRIBUTES, "ean"), loose=True).select("product_id", "band", "low")
    return left.join(right, ["band", "low"]).select("ck", "product_id").distinct()


def featured(pairs: DataFrame, classes: DataFrame, products: DataFrame) -> DataFrame:
    """The pairs with their features and ``differs``, whether a stated attribute contradicts."""
    a = classes.select("ck", *[F.col(c).alias(f"a_{c}") for c in [*ATTRIBUTES, "ean"]])
    b = products.select(F.col("id").alias("product_id"), *[F.col(c).alias(f"b_{c}") for c in [*ATTRIBUTES, "ean"]])
    both = pairs.join(a, "ck").join(b, "product_id")
    same = lambda c: F.coalesce(F.col(f"a_{c}") == F.col(f"b_{c}"), F.lit(False))
    unknown = lambda c: F.col(f"a_{c}").isNull() | F.col(f"b_{c}").isNull()
    feature = {f"{c}_same": same(c) for c in ("variant", "maker", "size", "pack", "ean")} | {f"{c}_unknown": unknown(c) for c in ("variant", "maker", "size")}
    feature["ean_differs"] = ~unknown("ean") & ~same("ean")
    differs = reduce(lambda x, y: x | y, [~same(c) & ~unknown(c) for c in ATTRIBUTES])
    return both.select("ck", "product_id", *[feature[f].cast("double").alias(f) for f in FEATURES], differs.alias("differs"))


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights and intercept of a logistic regression by Newton's method, penalised by their distance from ``prior``."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.array(prior, float)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + penalty * np.eye(len(w)), z.T @ (y - p) - penalty * (w - prior))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_isotonic(score: np.ndarray, y: np.ndarray, anchors=ANCHORS) -> list[tuple[float, float]]:
    """(lowest score, probability) of the steps of the non-decreasing function nearest to the outcomes, one step smoothed in each.

    Each anchor is a case that came true as far as its score says, so that few outcomes move the steps little.
    """
    at = np.array(list(anchors), float)
    score, y = np.concatenate([score, at]), np.concatenate([y, 1 / (1 + np.exp(-at))])
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(score[order], y[order]):
        if blocks and blocks[-1][0] == s:
            blocks[-1][1] += v
            blocks[-1][2] += 1
        else:
            blocks.append([s, v, 1])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2] and blocks[-1][0] != s:
            top = blocks.pop()
            blocks[-1][1] += top[1]
            blocks[-1][2] += top[2]
    merged: list[list[float]] = []
    for b in blocks:
        merged.append(b)
        while len(merged) > 1 and merged[-2][1] / merged[-2][2] >= merged[-1][1] / merged[-1][2]:
            top = merged.pop()
            merged[-1][1] += top[1]
            merged[-1][2] += top[2]
    smooth = np.maximum.accumulate([(v + 0.5) / (n + 1) for _, v, n in merged]) if merged else []
    return [(float(b[0]), float(p)) for b, p in zip(merged, smooth)]


def weak_labels(decisions: DataFrame) -> DataFrame:
    """The last product that was decided for each listing: store_item_id and decided."""
    stated = decisions.where(F.col("product_id").isNotNull() & F.col("store_item_id").isNotNull())
    last = F.max_by("product_id", F.struct("snapshot_date", "loaded_at", "product_id"))
    return stated.groupBy("store_item_id").agg(last.cast("long").alias("decided"))


def train(pairs: DataFrame, members: DataFrame, decisions: DataFrame, bound: int = LABELLED_PAIRS) -> tuple[list[float], list[tuple[float, float]]]:
    """Weights and calibration steps from past decisions.

    A decision counts where one of the listing's candidates is the decided product; one that
    agrees with no candidate says nothing of them.  At most ``bound`` labelled pairs, taken in
    the order of a hash of their listing, come to the driver.  Few or no labels leave the weights
    near the prior ones.
    """
    labels = weak_labels(decisions).join(members.select(F.col("id").alias("store_item_id"), "ck"), "store_item_id")
    labelled = labels.join(pairs, "ck").withColumn("label", (F.col("decided") == F.col("product_id")).cast("double"))
    useful = labelled.where(F.col("label") == 1).select("store_item_id").distinct()
    taken = labelled.join(useful, "store_item_id", "left_semi").select(F.xxhash64("store_item_id").alias("h"), *FEATURES, "label").orderBy("h").limit(bound).toPandas()
    x, y, h = taken[FEATURES].to_numpy(float), taken["label"].to_numpy(float), taken["h"].to_numpy()
    first = (h % 2 == 0) if len(h) else np.zeros(0, bool)
    w = fit_logistic(x[first], y[first], np.array(PRIOR))
    return [float(v) for v in w], fit_isotonic(x[~first] @ w[:-1] + w[-1], y[~first])


def probability(weights: list[float], steps: list[tuple[float, float]]) -> Column:
    score = reduce(lambda a, b: a + b, [F.col(f) * w for f, w in zip(FEATURES, weights)], F.lit(weights[-1]))
    levels = F.array(*[F.struct(F.lit(low - 1e-9).alias("low"), F.lit(p).alias("p")) for low, p in steps])
    reached = F.filter(levels, lambda s: s["low"] <= score)
    return F.coalesce(F.try_element_at(reached, F.lit(-1))["p"], F.lit(steps[0][1]))


def match_registry(profiles: DataFrame, decisions: DataFrame, accept: float = ACCEPT, margin: float = MARGIN) -> DataFrame:
    """store_item_id, product_id and confidence of the listings without any past decision.

    A listing gets its likeliest product from ``accept`` on, if no stated attribute differs and
    no other such product is within ``margin`` of it; ties leave it open.  Listings of one class
    are scored once.
    """
    listings = profiles.where(F.col("src") == "i").select("id", *ATTRIBUTES, "ean")
    members = listings.select("id", _key(*ATTRIBUTES, "ean").alias("ck"))
    classes = cut_lineage(classes_of(listings))
    products = profiles.where(F.col("src") == "p").select("id", *ATTRIBUTES, "ean")
    pairs = cut_lineage(featured(candidates(classes, products), classes, products))
    weights, steps = train(pairs, members, decisions)
    scored = pairs.where(~F.col("differs")).withColumn("confidence", probability(weights, steps))
    likeliest = Window.partitionBy("ck").orderBy(F.desc("confidence"), "product_id")
    two = scored.withColumn("rank", F.row_number().over(likeliest)).where(F.col("rank") <= 2)
    ranked = two.groupBy("ck").agg(F.max(F.when(F.col("rank") == 1, F.struct("confidence", "product_id"))).alias("top"), F.max(F.when(F.col("rank") == 2, F.col("confidence"))).alias("next"))
    alone = F.col("next").isNull() | (F.col("next") <= F.col("top.confidence") - margin)
    best = ranked.where((F.col("top.confidence") >= accept) & alone).select("ck", "top.product_id", "top.confidence")
    counted = best.join(classes.select("ck", "n"), "ck").select("ck", "n", "product_id", "confidence")
    undecided = members.join(decisions.select(F.col("store_item_id").alias("id")).distinct(), "id", "left_anti")
    found = lookup(undecided, counted, "ck", "n", ["id"]).where(F.col("product_id").isNotNull())
    return found.select(F.col("id").alias("store_item_id"), "product_id", F.col("confidence").cast("decimal(4,3)").alias("confidence"))
