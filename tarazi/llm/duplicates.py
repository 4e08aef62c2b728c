"""Product listings that describe the same item: bipartite term-pair reinforcement.

Listings with the same attributes form a class; each candidate pair of classes is linked to
its terms (kind, variant, maker, size and pieces, barcode).  Pair scores and term weights are
updated in turn: a pair scores by the weight of the terms it shares against those on which its
classes differ, a term weighs by the scores of the pairs that share it against all pairs that
have it.  Terms that tell products apart gain, misleading barcodes lose.  Pairs above the
threshold whose stated attributes do not differ are clustered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarazi.operators.skew import lookup
from tarazi.session import cut_lineage

ATTRIBUTES = ["kind", "variant", "maker", "size", "pack"]
#: The largest change of a score that ends the rounds, and the score of a match.
SETTLED, THRESHOLD = 0.01, 0.5
#: Rounds after which scores that have not settled are an error.
ROUNDS = 100
_SEP = "\u0001"


def _key(*columns: str) -> Column:
    return F.concat_ws(_SEP, *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns])


def _stated(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def classes_of(listings: DataFrame) -> DataFrame:
    """One row a class: its key ``ck``, attributes, number of listings, and ``sg``, the key of its attributes where all are stated."""
    keyed = listings.select(_key(*ATTRIBUTES, "ean").alias("ck"), *ATTRIBUTES, "ean").groupBy("ck").agg(*[F.first(c).alias(c) for c in [*ATTRIBUTES, "ean"]], F.count(F.lit(1)).alias("n"))
    return keyed.withColumn("sg", F.when(_stated("kind", "variant", "maker", "size"), _key(*ATTRIBUTES)))


def _by_code(coded: DataFrame) -> DataFrame:
    """Pairs of classes of one barcode that differ in nothing both state.

    A class is linked to the largest agreeing class of each set of stated attributes, found by
    equal values of what both sets state; so at most 16 links a class, and none is refused.
    """
    bits = {c: 1 << i for i, c in enumerate(["kind", "variant", "maker", "size"])}
    mask = sum((F.when(F.col(c).isNotNull(), b).otherwise(0) for c, b in bits.items()), F.lit(0))
    common = F.col("mine").bitwiseAND(F.col("other"))
    agreed = F.concat_ws(_SEP, F.col("pack").cast("string"), *[F.when(common.bitwiseAND(F.lit(b)) > 0, F.col(c)).otherwise("\u0000") for c, b in bits.items()])
    wide = coded.withColumn("mine", mask).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(15)))).where(F.col("mine") != F.col("other"))
    asked = wide.select(F.col("ck").alias("a"), "n", "ean", "mine", "other", agreed.alias("agreed"))
    hubs = asked.groupBy("ean", F.col("mine").alias("other"), F.col("other").alias("mine"), "agreed").agg(F.max_by("a", F.struct("n", "a")).alias("b"))
    return asked.join(hubs, ["ean", "mine", "other", "agreed"]).select("a", "b")


def candidate_pairs(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of class keys, b the hub that a is linked to; a bounded number a class.

    Classes of one signature are linked to the largest of them, classes of one barcode to the
    largest with that barcode and to those of it that they agree with, and a class that lacks one attribute to the one signature that
    agrees with all it states, if there is just one.  A group thus makes as many pairs as it
    has classes, or 17 times as many for a barcode, never all pairs within it.
    """
    largest = F.max_by("ck", F.struct("n", "ck"))
    hubs = classes.where(F.col("sg").isNotNull()).groupBy("sg").agg(largest.alias("hub"))
    by_signature = classes.join(hubs, "sg").select(F.col("ck").alias("a"), F.col("hub").alias("b"))
    coded = classes.where(F.col("ean").isNotNull())
    signed = coded.groupBy("ean", F.coalesce("sg", "ck").alias("g")).agg(F.sum("n").alias("n"), F.max_by("ck", F.struct("n", "ck")).alias("ck"), F.max(F.col("sg").isNotNull()).alias("whole"))
    code_hubs = signed.groupBy("ean").agg(F.max_by("ck", F.struct("whole", "n", "ck")).alias("hub"))
    by_code = coded.join(code_hubs, "ean").select(F.col("ck").alias("a"), F.col("hub").alias("b"))
    parts = [by_signature, by_code, _by_code(coded)]
    for lacking in ("variant", "maker", "size"):
        rest = [c for c in ATTRIBUTES if c != lacking]
        whole = classes.where(F.col("sg").isNotNull()).groupBy(_key(*rest).alias("rk")).agg(F.min("sg").alias("sg"), F.max("sg").alias("other")).where(F.col("sg") == F.col("other"))
        partial = classes.where(F.col(lacking).isNull() & _stated(*[c for c in rest if c != "pack"])).select("ck", _key(*rest).alias("rk"))
        parts.append(partial.join(whole, "rk").join(hubs, "sg").select(F.col("ck").alias("a"), F.col("hub").alias("b")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("a") != F.col("b")).distinct()


def _incidence(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """pair, term and whether both classes have the term; an attribute that either does not state gives no term."""
    left = classes.select(F.col("ck").alias("a"), *[F.col(c).alias(f"a_{c}") for c in [*ATTRIBUTES, "ean"]])
    right = classes.select(F.col("ck").alias("b"), *[F.col(c).alias(f"b_{c}") for c in [*ATTRIBUTES, "ean"]])
    both = pairs.join(left, "a").join(right, "b")
    terms = []
    for c in [*ATTRIBUTES, "ean"]:
        x, y = F.col(f"a_{c}").cast("string"), F.col(f"b_{c}").cast("string")
        name = lambda v, c=c: F.concat(F.lit(c + ":"), v)
        one = F.array(F.struct(name(x).alias("term"), F.lit(True).alias("shared")))
        two = F.array(F.struct(name(x).alias("term"), F.lit(False).alias("shared")), F.struct(name(y).alias("term"), F.lit(False).alias("shared")))
        none = F.filter(one, lambda _: F.lit(False))
        terms.append(F.when(x.isNull() | y.isNull(), none).when(x == y, one).otherwise(two))
    differ = _differ("a_", "b_")
    return both.select("a", "b", F.xxhash64("a", "b").alias("pair"), differ.alias("differ"), F.concat(*terms).alias("terms"))


def reinforce(incidence: DataFrame, rounds: int = ROUNDS, settled: float = SETTLED) -> DataFrame:
    """pair and score after the scores and weights have settled; an error if they do not within ``rounds``."""
    edges = cut_lineage(incidence.select("pair", F.explode("terms").alias("t")).select("pair", "t.term", "t.shared"))
    scores = edges.select("pair").distinct().withColumn("score", F.lit(1.0))
    for _ in range(rounds):
        held = edges.join(scores, "pair")
        weights = held.groupBy("term").agg(
            F.count(F.lit(1)).alias("_n"), ((F.sum(F.when(F.col("shared"), F.col("score")).otherwise(0.0)) + 0.5) / (F.count(F.lit(1)) + 1.0)).alias("weight")
        )
        weighed = lookup(edges, weights, "term", "_n", ["pair", "term"])
        fresh = weighed.groupBy("pair").agg((F.sum(F.when(F.col("shared"), F.col("weight")).otherwise(0.0)) / F.sum("weight")).alias("score"))
        fresh = cut_lineage(fresh)
        change = fresh.join(scores.withColumnRenamed("score", "before"), "pair").agg(F.max(F.abs(F.col("score") - F.col("before")))).first()[0]
        scores = fresh
        if change is None or change < settled:
            return scores
    raise RuntimeError(f"scores still change by {change} after {rounds} rounds")


def _differ(a: str, b: str) -> Column:
    """Whether an attribute that both sides state differs; their columns begin with ``a`` and ``b``."""
    out = F.lit(False)
    for c in ATTRIBUTES:
        out = out | F.coalesce(F.col(f"{a}{c}") != F.col(f"{b}{c}"), F.lit(False))
    return out


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """node and root of the nodes that the links (a, b, score) join: connected components whose members differ in nothing they state.

    ``nodes`` has node, the attributes and n.  In each round every component takes its best link
    to one that it does not differ from, and joins that one if it ranks higher and joins none
    itself; of those that join one component, all stay that agree with the best of them in what
    the component lacks.  The ranks of every other round are hashes, so chains shrink by a share
    a round.  The best link of all is always taken, so the rounds end when no link is left.
    """
    roots = nodes.select("node", *ATTRIBUTES, "n")
    edges, merged, rounds = links.select("a", "b", "score"), None, 0
    while True:
        stated = F.size(F.array_compact(F.array(*[F.col(c).cast("string") for c in ATTRIBUTES]))).alias("stated")
        place = F.struct(stated, "n", "node")
        rank = F.struct(stated, F.xxhash64(F.lit(rounds), "node").alias("h"), "node") if rounds % 2 else place
        side = roots.select(*ATTRIBUTES, "node", place.alias("place"), rank.alias("rank"))
        left, right = (side.select(F.col("node").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in [*ATTRIBUTES, "place", "rank"]]) for x in "ab")
        met = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "score").where(F.col("a") != F.col("b")).groupBy("a", "b").agg(F.max("score").alias("score"))
        edges = cut_lineage(met.join(left, "a").join(right, "b").where(~_differ("a_", "b_")))
        if edges.isEmpty():
            break
        strength = F.struct("score", F.greatest("a_place", "b_place").alias("x"), F.least("a_place", "b_place").alias("y"))
        ways = [edges.select(F.col(x).alias("node"), F.col(y).alias("to"), strength.alias("strength"), (F.col(f"{y}_rank") > F.col(f"{x}_rank")).alias("joins"), *[F.col(f"{x}_{c}").alias(f"x_{c}") for c in ATTRIBUTES], *[F.col(f"{y}_{c}").alias(f"y_{c}") for c in ATTRIBUTES]) for x, y in ("ab", "ba")]
        both = ways[0].unionByName(ways[1])
        taken = both.groupBy("node").agg(F.max_by(F.struct(*[c for c in both.columns if c != "node"]), "strength").alias("t")).select("node", "t.*")
        taken = cut_lineage(taken)
        offers = taken.where("joins").join(taken.where(~F.col("joins")).select(F.col("node").alias("to")), "to", "left_semi")
        gained = offers.groupBy("to").agg(*[F.max_by(f"x_{c}", F.when(F.col(f"x_{c}").isNotNull(), F.struct("strength", "node"))).alias(f"z_{c}") for c in ATTRIBUTES])
        moves = cut_lineage(offers.join(gained, "to").where(~_differ("x_", "z_")).select("node", "to"))
        merged = moves if merged is None else merged.unionByName(moves)
        moved = roots.join(moves, "node", "left").select(F.coalesce("to", "node").alias("node"), *ATTRIBUTES, "n")
        roots = cut_lineage(moved.groupBy("node").agg(*[F.max(c).alias(c) for c in ATTRIBUTES], F.sum("n").alias("n")))
        for x in "ab":
            edges = edges.join(moves.select(F.col("node").alias(x), "to"), x, "left").withColumn(x, F.coalesce("to", x)).drop("to")
        edges = edges.select("a", "b", "score")
        rounds += 1
    if merged is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    out, span = merged.withColumnRenamed("to", "root"), 1
    while span < rounds:  # a node moves once, to one that moves in a later round if at all
        up = out.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        out = cut_lineage(out.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root")))
        span *= 2
    return out.unionByName(out.select(F.col("root").alias("node"), "root").distinct())


def same_items(profiles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """id and cluster of every listing; a cluster is the listings of one product.

    Classes join over every link that scores above the threshold: by an equal signature, by
    barcode or as the only fit.  Clusters are the connected components of these links, kept
    apart where stated attributes differ; equal signatures alone join nothing.  Listings that nothing links stay alone, even if they state the same few
    attributes.  Exact copies share a class and are never compared.
    """
    listings = profiles.where(F.col("src") == "i").select("id", *ATTRIBUTES, "ean")
    classes = cut_lineage(classes_of(listings))
    incidence = cut_lineage(_incidence(candidate_pairs(classes), classes))
    scores = reinforce(incidence)
    kept = incidence.join(scores, "pair").where((F.col("score") >= threshold) & ~F.col("differ")).select("a", "b", "score")
    joined = components(classes.withColumnRenamed("ck", "node"), kept).withColumnRenamed("node", "ck")
    # without a link a class is a group of its own if it lacks nothing or has a barcode
    alone = F.when(F.col("sg").isNotNull() | F.col("ean").isNotNull(), F.col("ck"))
    cluster = classes.join(joined, "ck", "left").select("ck", F.coalesce("root", alone).alias("cluster"))
    members = listings.select("id", _key(*ATTRIBUTES, "ean").alias("ck"))
    counts = classes.select("ck", "n")
    return lookup(members, cluster.join(counts, "ck").select("ck", "n", "cluster"), "ck", "n", ["id"]).select("id", F.coalesce("cluster", F.concat(F.lit("id"), F.col("id").cast("string"))).alias("cluster"))


def pairs_of(clusters: DataFrame) -> DataFrame:
    """item_a < item_b of every cluster: the form that the result is asked in."""
    left = clusters.select("cluster", F.col("id").alias("item_a"))
    right = clusters.select("cluster", F.col("id").alias("item_b"))
    return left.join(right, "cluster").where(F.col("item_a") < F.col("item_b")).select("item_a", "item_b").distinct()
