"""Deterministic single-row and pair plans by hash ranks; every row is a partner equally often."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import digest, hash_int
from ..functions.places import hash_stratum, placed, placed_by_hash, running, strata_for, value_edges, value_stratum


def direct_round_robin(df: DataFrame, key: str, field: str, total: int, strata: int | None = None) -> DataFrame:
    """``total`` rows, one of each value in turn."""
    rows = df.where(F.col(field).isNotNull()).select(F.col(key).alias("row_id"), F.col(field).alias("value"), digest(key).alias("h"))
    turns = placed_by_hash(rows, ["value"], "h", ["row_id"], strata, name="turn")
    return turns.orderBy("turn", "value").limit(total).select("row_id", "value", (F.col("turn") + 1).cast("int").alias("turn"))


def same_group_pairs(df: DataFrame, key: str, group: str, largest: int = 1000) -> DataFrame:
    """All unordered pairs inside a group. Their number grows with the square of a group, so a group of over ``largest``
    rows is refused; ``capacity`` counts such pairs and ``neighborhood`` plans a bounded number of them a row."""
    over = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("c")).where(F.col("c") > largest).limit(1).collect()
    if over:
        raise ValueError(f"group {over[0][0]!r} has {over[0].c} rows, more than {largest}: use neighborhood")
    a, b = df.select(F.col(key).alias("a"), F.col(group).alias("g")), df.select(F.col(key).alias("b"), F.col(group).alias("g"))
    return a.join(b, "g").where("a < b").select("a", "b")


def circle(df: DataFrame, key: str, group: str, strata: int | None = None) -> DataFrame:
    """Rows with their place in the group's hash order and in the circle of all groups, one behind the other.

    ``strata``: see ``placed_by_hash``; enough for the rows is enough for the groups."""
    rows = df.where(F.col(group).isNotNull()).select(F.col(key).alias("row_id"), F.col(group).alias("grp"), digest(key).alias("h"))
    sizes = rows.groupBy("grp").agg(F.count("*").alias("m")).withColumn("g", digest("grp"))
    # where a group starts in the circle of groups, which stand in hash order
    n = strata_for(df) if strata is None else strata
    starts = running(sizes.withColumn("_s", hash_stratum(F.col("g"), n)), ["g", "grp"], {"first": "m"}, exclusive=True)
    whole = sizes.agg(F.sum("m").alias("n"), F.max("m").alias("largest"))
    starts = starts.select("grp", "m", "first").join(F.broadcast(whole))  # one row
    return placed_by_hash(rows, ["grp"], "h", ["row_id"], n).join(starts, "grp")


def circular_next(df: DataFrame, key: str, group: str, strata: int | None = None) -> DataFrame:
    """Each row of a group with the next one by key, the last with the first."""
    n = strata_for(df) if strata is None else strata
    rows = df.where(F.col(group).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("row_id"), F.col(group).alias("grp"))
    at = placed(rows, ["grp"], value_stratum(F.col("row_id"), value_edges(rows, "row_id", n)), ["row_id"])
    sizes = rows.groupBy("grp").agg(F.count("*").alias("m"))
    asks = at.join(sizes, "grp").select("row_id", "grp", F.pmod(F.col("place") + 1, "m").alias("place"))
    return asks.join(at.withColumnRenamed("row_id", "next"), ["grp", "place"]).select("row_id", "next")


def neighborhood(df: DataFrame, key: str, group: str, same: int = 2, different: int = 2, ring: DataFrame | None = None) -> DataFrame:
    """Each row with the next ``same`` rows of its group's circle and ``different`` rows a largest group ahead. ``ring``: the
    circle, if it is made already."""
    c = circle(df, key, group) if ring is None else ring
    ok = c.where(2 * (F.col("largest") + different - 1) < F.col("n"))
    far = ok.select(F.col("row_id").alias("a"), F.explode(F.array(*[F.pmod(F.col("first") + F.col("place") + F.col("largest") + i, "n") for i in range(different)])).alias("at"))
    neg = far.join(c.select((F.col("first") + F.col("place")).alias("at"), F.col("row_id").alias("b")), "at").select("a", "b", F.lit(False).alias("same"))
    if not same:
        return neg
    near = c.where(F.col("m") >= 2 * same + 1).select(F.col("row_id").alias("a"), "grp", F.explode(F.array(*[F.pmod(F.col("place") + i, "m") for i in range(1, same + 1)])).alias("place"))
    pos = near.join(c.select("grp", "place", F.col("row_id").alias("b")), ["grp", "place"]).select("a", "b", F.lit(True).alias("same"))
    return pos.unionAll(neg)


def tiered_negative(df: DataFrame, key: str, speaker: str, tiers: list[list[str]], strata: int | None = None) -> DataFrame:
    """For each row a row of another speaker, of the first tier whose group has one: (a, b, tier); no b if there is no other.

    A tier is a list of columns that both share, an empty one the whole table; rows with a null among them have no such
    tier. Inside a group the speakers stand in hash order and a hash of the row picks one of the others, then a row of that
    speaker by its place. All joins are by equality; no window holds a group.
    """
    rows = df.where(F.col(speaker).isNotNull())
    strata = strata_for(rows) if strata is None else strata
    out = rows.select(F.col(key).alias("a"))
    for i, cols in enumerate(tiers):
        g = [f"g{j}" for j in range(len(cols))]
        held = rows.select(F.col(key).alias("b"), F.col(speaker).alias("who"), *[F.col(c).alias(x) for c, x in zip(cols, g, strict=True)]).dropna(subset=[*g, "b"])
        at = placed_by_hash(held.withColumn("h", digest("b")), [*g, "who"], "h", ["b"], strata, name="at").drop("h")
        speakers = held.groupBy(*g, "who").agg(F.count("*").alias("size"))
        ring = placed_by_hash(speakers.withColumn("h", digest("who")), g, "h", ["who"], strata, name="turn").drop("h")
        each = ring.groupBy(*g).agg(F.count("*").alias("k")).where("k > 1")
        ring = ring.join(each, g) if g else ring.join(F.broadcast(each))  # one row
        pick, spot = hash_int(F.lit("speaker"), F.lit(i), "b"), hash_int(F.lit("row"), F.lit(i), "b")
        asks = held.join(ring, [*g, "who"]).select(*g, F.col("b").alias("a"), F.pmod(F.col("turn") + 1 + pick % (F.col("k") - 1), "k").alias("turn"), spot.alias("spot"))
        found = asks.join(ring.select(*g, "turn", "who", "size"), [*g, "turn"]).withColumn("at", F.col("spot") % F.col("size")).join(at, [*g, "who", "at"])
        out = out.join(found.select("a", F.col("b").alias(f"b{i}")), "a", "left")
    first = [F.col(f"b{i}") for i in range(len(tiers))]
    return out.select("a", F.coalesce(*first).alias("b"), F.coalesce(*[F.when(c.isNotNull(), F.lit(i)) for i, c in enumerate(first)]).alias("tier"))


def verification_plan(df: DataFrame, key: str, speaker: str, tiers: list[list[str]]) -> DataFrame:
    """Pairs of one speaker, each with a pair of its first row and another speaker's: (a, b, same, tier), no unordered pair
    twice. A speaker of m rows gives its circle of m pairs (one if m is 2). Of the other pairs, one that an earlier pair
    holds the other way round is left out: ``plan_shortfall`` counts them."""
    rows = df.where(F.col(speaker).isNotNull()).select(F.col(key).alias("row_id"), F.col(speaker).alias("who"))
    strata = strata_for(rows)
    held = placed_by_hash(rows.withColumn("h", digest("row_id")), ["who"], "h", ["row_id"], strata)
    sizes = rows.groupBy("who").agg(F.count("*").alias("m"))
    ring = held.join(sizes, "who").where("m > 1")
    next_ = ring.select(F.col("row_id").alias("a"), "who", F.pmod(F.col("place") + 1, "m").alias("place"), "m").where("m > 2 or place = 1")
    same = next_.join(ring.select("who", "place", F.col("row_id").alias("b")), ["who", "place"]).select("a", "b")
    other = tiered_negative(df, key, speaker, tiers, strata).join(same.select("a"), "a").where("b is not null")
    once = other.groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.min(F.struct("a", "b", "tier")).alias("p")).select("p.*")
    return same.select("a", "b", F.lit(True).alias("same"), F.lit(None).cast("int").alias("tier")).unionByName(once.select("a", "b", F.lit(False).alias("same"), "tier"))


def plan_shortfall(plan: DataFrame) -> DataFrame:
    """One row: pairs of either side and how many of the second side are missing."""
    side = lambda x: F.coalesce(F.sum(F.col("same").eqNullSafe(x).cast("long")), F.lit(0).cast("long"))
    return plan.agg(side(True).alias("n_same"), side(False).alias("n_different")).withColumn("shortfall", F.col("n_same") - F.col("n_different"))


def target_match(df: DataFrame, key: str, field: str, low: float = 0.6, high: float = 1.67, strata: int | None = None) -> DataFrame:
    """Each row's own value and another value of the field, of like length if there is one, by hash.

    The domain stands in the order of length, then hash, so the values of like length are a range of places; the row's
    hash picks one of them but its own. One equi-join by place; no pair of values is looked at. A field of one value gives
    no rows.
    """
    dom = df.where(F.col(field).isNotNull()).select(F.col(field).cast("string").alias("v")).distinct().select("v", F.length("v").alias("len"), digest("v").alias("h"))
    lengths = dom.groupBy("len").agg(F.count("*").alias("c"))  # a row a length
    upto = F.sum("c").over(Window.orderBy("len"))
    steps = lengths.select("len", (upto - F.col("c")).alias("start"), upto.alias("end"))
    size = lengths.agg(F.sum("c").alias("size"))
    near = steps.alias("x").join(F.broadcast(steps.alias("y")), (F.col("y.len") / F.col("x.len") >= low) & (F.col("y.len") / F.col("x.len") <= high), "left")
    near = near.groupBy(F.col("x.len").alias("len"), F.col("x.start").alias("start")).agg(F.min("y.start").alias("lo"), F.max("y.end").alias("hi")).join(F.broadcast(size))
    domain = placed_by_hash(dom, ["len"], "h", ["v"], strata).join(F.broadcast(near), "len").withColumn("at", F.col("start") + F.col("place"))
    like = F.coalesce(F.col("hi") - F.col("lo") > 1, F.lit(False))
    lo, n = F.when(like, F.col("lo")).otherwise(F.lit(0)), F.when(like, F.col("hi") - F.col("lo")).otherwise(F.col("size"))
    asks = df.select(F.col(key).alias("row_id"), F.col(field).cast("string").alias("v")).join(domain.select("v", "at", lo.alias("lo"), n.alias("n"), (~like).alias("fallback")).where("n > 1"), "v")
    # a place in the range without the own one
    step = F.col("lo") + F.pmod(F.col("at") - F.col("lo") + 1 + hash_int("row_id") % (F.col("n") - 1), "n")
    asks = asks.select("row_id", F.col("v").alias("positive"), "fallback", step.alias("at"))
    return asks.join(domain.select("at", F.col("v").alias("negative")), "at").select("row_id", "positive", "negative", "fallback")


def selection(df: DataFrame, key: str, group: str, ring: DataFrame | None = None) -> DataFrame:
    """Each row beside one of another group; a hash bit says which comes first."""
    pairs = neighborhood(df, key, group, same=0, different=1, ring=ring)
    first = hash_int("a") % 2 == 0
    return pairs.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("row_a"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("row_b"), F.when(first, "A").otherwise("B").alias("answer"), F.col("a").alias("anchor"))


def reuse(pairs: DataFrame) -> DataFrame:
    """How often rows are used: rows, least, most, mean, upper median and 95th percentile (smallest number of uses that so
    many rows don't exceed), from the histogram of uses."""
    used = pairs.select(F.explode(F.array("a", "b")).alias("r")).groupBy("r").agg(F.count("*").alias("k"))
    hist = used.groupBy("k").agg(F.count("*").alias("c"))  # a row a number of uses
    run = hist.select("k", "c", F.sum("c").over(Window.orderBy("k")).alias("upto"), F.sum("c").over(Window.partitionBy()).alias("n"))
    at = lambda x: F.min(F.when(x, F.col("k")))
    return run.agg(F.sum("c").alias("n_rows"), F.min("k").alias("least"), F.max("k").alias("most"), F.round(F.sum(F.col("k") * F.col("c")) / F.sum("c"), 6).alias("mean"), at(F.col("upto") > F.floor(F.col("n") / 2)).alias("median"), at(F.col("upto") >= F.ceil(F.col("n") * 0.95)).alias("p95"))


def most_used(pairs: DataFrame, k: int = 10) -> DataFrame:
    """The k rows used most, ties to the smaller row."""
    used = pairs.select(F.explode(F.array("a", "b")).alias("row_id")).groupBy("row_id").agg(F.count("*").alias("n_refs"))
    return used.orderBy(F.desc("n_refs"), "row_id").limit(k)
