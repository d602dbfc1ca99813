"""Samples by hash rank: first usable rows, spread samples, nearest values, thresholds applied, shuffled choices."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import digest
from ..functions.places import placed_by_hash
from .calibrate import distribution, percentiles
from .terms import total


def ranked(rows: DataFrame, key: str, group: str, salt: str = "rank") -> DataFrame:
    """Rows with their place in the group's hash order, from 0; rows without a group have none."""
    return placed_by_hash(rows.where(F.col(group).isNotNull()).withColumn("h", digest(F.lit(salt), key)), [group], "h", [key], name="rank").drop("h")


def first_usable(rows: DataFrame, key: str, group: str, usable: Column, speaker: str, blocked_keys: DataFrame, blocked_speakers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group, key, skipped) of the first row in hash order that nothing rules out, no key where all are; and the rows before
    it (group, key, rank, reason): its key is blocked, its speaker is, or it can't be used."""
    named = ranked(rows, key, group).withColumn("ok", usable)
    bk = blocked_keys.select(F.col(key).alias("_k")).distinct().withColumn("_bk", F.lit(1))
    bs = blocked_speakers.select(F.col(speaker).alias("_p")).distinct().withColumn("_bs", F.lit(1))
    met = named.join(bk, F.col(key) == F.col("_k"), "left").join(bs, F.col(speaker) == F.col("_p"), "left")
    reason = F.when(F.col("_bk").isNotNull(), "key_overlap").when(F.col("_bs").isNotNull(), "speaker_overlap").when(~F.coalesce(F.col("ok"), F.lit(False)), "unusable")
    told = met.select(F.col(group).alias("grp"), F.col(key).alias("row_id"), "rank", reason.alias("reason"))
    best = told.groupBy("grp").agg(F.min(F.when(F.col("reason").isNull(), F.struct("rank", "row_id"))).alias("f"), F.count("*").alias("n"))
    chosen = best.select("grp", F.col("f.row_id").alias("row_id"), F.coalesce("f.rank", "n").alias("skipped"))
    before = told.join(chosen.select("grp", "skipped"), "grp").where(F.col("rank") < F.col("skipped")).select("grp", "row_id", "rank", "reason")
    return chosen, before


def spread_sample(rows: DataFrame, key: str, region: str, province: str, speaker: str, gender: str, text: str, target: int = 24) -> DataFrame:
    """row_id, n of ``target`` rows that spread over regions (a share each), provinces, speakers, genders and text lengths.

    One row after the other, the one that adds most in that order of importance, of equals the first by hash. That is
    sequential, but only looks at a pool that holds every row it can pick: of each combination of region, province, gender and
    length, the first ``target`` rows and the first row of each of the first ``target`` speakers. The pool's size is bounded by
    the number of combinations, not by the rows.
    """
    n = rows.count()
    spark = rows.sparkSession
    if not n:
        return spark.createDataFrame([], "row_id string, n int")
    target = min(target, n)
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    held = rows.select(F.col(key).cast("string").alias("k"), text_of(region).alias("region"), text_of(province).alias("province"), F.col(speaker).cast("string").alias("who"), F.col(gender).cast("string").alias("gender"), F.length(text_of(text)).alias("len"), digest(F.lit("discover"), key).alias("h"))
    lengths = held.groupBy("len").agg(F.count("*").alias("c")).orderBy("len").collect()  # a row a length
    cuts, upto = [], 0
    for at in (n // 3, 2 * n // 3):
        upto = 0
        for r in lengths:
            upto += r.c
            if upto > at:
                cuts.append(r.len)
                break
    held = held.withColumn("size", F.when(F.col("len") <= cuts[0], 0).when(F.col("len") <= cuts[1], 1).otherwise(2))
    of = ["region", "province", "gender", "size"]
    held = held.withColumn("r", F.row_number().over(Window.partitionBy(*of).orderBy("h", "k")))
    top = held.where(F.col("r") <= target)
    new = held.groupBy(*of, "who").agg(F.min(F.struct("h", "k")).alias("f")).where("who is not null")
    new = new.withColumn("r", F.row_number().over(Window.partitionBy(*of).orderBy("f"))).where(F.col("r") <= target)
    pool = top.select(*of, "who", "h", "k").unionByName(new.select(*of, "who", F.col("f.h").alias("h"), F.col("f.k").alias("k"))).distinct().orderBy("h", "k").collect()
    count = {r.region: r.c for r in held.groupBy("region").agg(F.count("*").alias("c")).collect()}
    each, rest = divmod(target, len(count))
    quota = {x: each + (i < rest) for i, x in enumerate(sorted(count, key=lambda x: (-count[x], x)))}
    picked, filled, seen = [], dict.fromkeys(count, 0), {"province": set(), "who": set(), "gender": set(), "size": set()}
    while len(picked) < target:
        room = any(filled[x] < quota[x] for x in quota)
        left = [r for r in pool if r not in picked]
        open_ = [r for r in left if not room or filled[r.region] < quota[r.region]] or left
        gain = lambda r: (filled[r.region] < quota[r.region], r.province not in seen["province"], r.who is not None and r.who not in seen["who"], r.gender is not None and r.gender not in seen["gender"], r["size"] not in seen["size"])  # noqa: B023, E731
        best = min(open_, key=lambda r: (tuple(-int(x) for x in gain(r)), r.h))
        picked.append(best)
        filled[best.region] += 1
        for f in ("province", "who", "gender", "size"):
            if best[f] is not None:
                seen[f].add(best[f])
    return spark.createDataFrame([(r.k, i + 1) for i, r in enumerate(sorted(picked, key=lambda r: r.h))], "row_id string, n int")


def canonical_order(rows: DataFrame, key: str, salt: str = "order") -> DataFrame:
    """The rows with their place in the order of their hashes: a release's total order."""
    return placed_by_hash(rows.withColumn("_h", digest(F.lit(salt), key)), [], "_h", [key]).drop("_h")


def nearest(rows: DataFrame, value: str, thresholds: dict[str, float], k: int = 10) -> DataFrame:
    """threshold, side, n, value: the k values nearest to each threshold below it, and from it on."""
    out = None
    v = rows.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    for name, t in sorted(thresholds.items()):
        for side, kept, order in (("below", F.col("v") < t, F.desc("v")), ("above", F.col("v") >= t, F.asc("v"))):
            got = v.where(kept).orderBy(order).limit(k)
            got = got.select(F.lit(name).alias("threshold"), F.lit(side).alias("side"), F.row_number().over(Window.orderBy(order)).alias("n"), F.col("v").alias("value"))  # k rows
            out = got if out is None else out.unionAll(got)
    return out


def near_threshold(rows: DataFrame, value: str, thresholds: dict[str, float], bands: tuple[float, ...]) -> DataFrame:
    """threshold, band, n: rows whose value lies within the band on both sides; one pass."""
    v = F.col(value).cast("double")
    cells = [(name, t, b) for name, t in sorted(thresholds.items()) for b in bands]
    told = rows.agg(*[total(F.abs(v - t) <= b, f"x{i}") for i, (_, t, b) in enumerate(cells)])
    return told.select(F.explode(F.array(*[F.struct(F.lit(n).alias("threshold"), F.lit(float(b)).alias("band"), F.col(f"x{i}").alias("n")) for i, (n, _, b) in enumerate(cells)])).alias("e")).select("e.*")


def ordinal(value: Column, cuts: tuple[float, float, float], names: tuple[str, ...]) -> Column:
    """The class of three rising thresholds; null stays null."""
    return F.when(value < cuts[0], names[0]).when(value < cuts[1], names[1]).when(value < cuts[2], names[2]).when(value.isNotNull(), names[3])


def reproduced(rows: DataFrame, value: str, gold: str, cuts: tuple[float, float, float], names: tuple[str, ...]) -> DataFrame:
    """One row: labelled rows with a value, those whose class the thresholds give, accuracy."""
    held = rows.where(F.col(value).isNotNull() & F.col(gold).isNotNull())
    right = total(ordinal(F.col(value), cuts, names) == F.col(gold), "right")
    told = held.agg(F.count("*").alias("n"), right)
    return told.select("n", "right", F.round(F.when(F.col("n") > 0, F.col("right") / F.col("n")).otherwise(F.lit(0.0)), 6).alias("accuracy"))


def projected(rows: DataFrame, value: str, cuts: tuple[float, float, float], names: tuple[str, ...]) -> DataFrame:
    """class, n, percent over all classes, empty ones too, beside the majority share, entropy, entropy over that of even
    classes, and effective classes."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(ordinal(F.col(value), cuts, names).alias("class")).agg(F.count("*").alias("c"))
    every = rows.sparkSession.createDataFrame([(x,) for x in names], "class string").join(counts, "class", "left").select("class", F.coalesce("c", F.lit(0)).alias("n"))
    p = F.col("n") / F.col("total")
    whole = every.agg(F.sum("n").alias("total"), F.max("n").alias("most"))
    each = every.join(F.broadcast(whole))
    h = each.agg(F.coalesce(-F.sum(F.when((F.col("n") > 0) & (F.col("total") > 0), p * F.log2(p))), F.lit(0.0)).alias("h"))
    share = lambda x: F.when(F.col("total") > 0, x).otherwise(F.lit(0.0))
    return each.join(F.broadcast(h)).select("class", "n", F.round(share(100 * p), 4).alias("percent"), F.round(share(F.col("most") / F.col("total")), 6).alias("majority"), F.round("h", 6).alias("entropy"), F.round(F.col("h") / math.log2(len(names)), 6).alias("normalized"), F.round(share(F.pow(F.lit(2.0), F.col("h"))), 6).alias("effective"))


def populations(frames: dict[str, DataFrame], value: str, points: tuple[float, ...]) -> DataFrame:
    """population, point and the linear percentile there."""
    out = None
    for name, d in sorted(frames.items()):
        one = d.select(F.lit(name).alias("population"), F.col(value).cast("double").alias("v"))
        out = one if out is None else out.unionAll(one)
    return percentiles(out, "population", "v", points).select("population", "point", "n", "linear")


def class_statistics(rows: DataFrame, value: str, label: str) -> DataFrame:
    """Rows, least, most, mean, deviation and linear percentiles of each class."""
    points = percentiles(rows.where(F.col(label).isNotNull()), label, value, (0.05, 0.25, 0.5, 0.75, 0.95))
    wide = points.groupBy(label).agg(*[F.max(F.when(F.col("point") == q, F.col("linear"))).alias(f"p{int(q * 100):02d}") for q in (0.05, 0.25, 0.5, 0.75, 0.95)])
    return distribution(rows.where(F.col(label).isNotNull()), value, [label]).join(wide, label)


def shuffled_choices(rows: DataFrame, key: str, choices: str, answer: str, epoch: int, seed: int = 42) -> DataFrame:
    """row_id, choices in the epoch's hash order, and the answer's letter."""
    order = F.array_sort(F.transform(F.col(choices), lambda c: F.struct(digest(F.lit(seed), F.lit(epoch), F.col(key), c).alias("h"), c.alias("c"))))
    shown = rows.select(F.col(key).alias("row_id"), F.transform(order, lambda p: p["c"]).alias("c"), F.col(answer).alias("a"))
    return shown.select("row_id", F.array_join("c", "|").alias("choices"), F.when(F.array_contains("c", F.col("a")), F.char((F.lit(64) + F.array_position("c", F.col("a"))).cast("int"))).alias("letter"))
