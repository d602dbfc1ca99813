"""Ordinal thresholds from labelled values, classification, evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.places import previous, running, strata_for, value_edges, value_stratum
from ..functions.text import ENDS


def _ranked(per: DataFrame, value: str, strata: int | None) -> DataFrame:
    """Rows with the stratum of their value."""
    n = strata_for(per) if strata is None else strata
    return per.withColumn("_s", value_stratum(F.col(value), value_edges(per, value, n)))


def best_boundary(df: DataFrame, value: str, low: str, strata: int | None = None) -> DataFrame:
    """The value up to which rows are called low with most right; ties to the smaller value.

    A first aggregate makes one row a value; running counts are over strata of the values.
    """
    per = df.groupBy(F.col(value).alias("v")).agg(F.sum(F.col(low).cast("long")).alias("lo"), F.sum((~F.col(low)).cast("long")).alias("hi")).where("v is not null")
    run = running(_ranked(per, "v", strata), ["v"], {"lo_upto": "lo", "hi_upto": "hi"})
    total = per.agg(F.sum("lo").alias("nlo"), F.sum("hi").alias("nhi"))
    right = run.join(F.broadcast(total)).select("v", (F.col("lo_upto") + F.col("nhi") - F.col("hi_upto")).alias("right"), (F.col("nlo") + F.col("nhi")).alias("n"))
    return right.orderBy(F.desc("right"), "v").limit(1).select(F.col("v").alias("boundary"), "right", "n", F.round(F.col("right") / F.col("n"), 6).alias("accuracy"))


def boundaries(df: DataFrame, value: str, rank: str) -> DataFrame:
    """Between each two neighbouring classes: the lower one's largest value, the upper one's smallest, gap and midpoint."""
    per = df.where(F.col(value).isNotNull() & F.col(rank).isNotNull()).groupBy(F.col(rank).alias("rank")).agg(F.min(value).alias("least"), F.max(value).alias("low_most"))
    up = F.lead("least").over(Window.orderBy("rank"))  # a row a class
    gap = F.col("high_least") - F.col("low_most")
    return per.withColumn("high_least", up).where("high_least is not null").select("rank", "low_most", "high_least", F.round(gap, 6).alias("gap"), (gap > 0).alias("clean"), F.round((F.col("low_most") + F.col("high_least")) / 2, 6).alias("midpoint"))


def monotonicity(df: DataFrame, value: str, rank: str, strata: int | None = None) -> DataFrame:
    """Neighbours in the order of value whose class falls, and values with several classes; one row a distinct pair is ordered."""
    per = df.where(F.col(value).isNotNull() & F.col(rank).isNotNull()).select(F.col(value).alias("v"), F.col(rank).alias("r")).distinct()
    falls = previous(_ranked(per, "v", strata), ["v", "r"], {"before": "r"}).select((F.col("before") > F.col("r")).alias("falls"))
    down = falls.agg(F.count("*").alias("n_pairs"), F.coalesce(F.sum(F.col("falls").cast("long")), F.lit(0).cast("long")).alias("n_inversions"))
    mixed = per.groupBy("v").agg(F.count("*").alias("k")).agg(F.coalesce(F.sum((F.col("k") > 1).cast("long")), F.lit(0).cast("long")).alias("n_conflicts"))
    return down.join(F.broadcast(mixed))


def best_thresholds(df: DataFrame, value: str, rank: str, strata: int | None = None) -> DataFrame:
    """The three rising cuts between values that put most rows in their class 0 to 3; of equals the lowest cuts.

    Rows right below and above the cuts are sums of prefix counts, one term a cut, so the best pair of lower cuts for each
    cut is a running maximum: sorting the distinct values replaces the search over all triples. No rows give no row.
    """
    at = lambda r: F.sum((F.col(rank) == r).cast("long"))
    per = df.where(F.col(value).isNotNull() & F.col(rank).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(*[at(r).alias(f"c{r}") for r in range(4)])
    n = strata_for(per) if strata is None else strata
    rows = _ranked(per, "v", n)
    run = running(rows, ["v"], {f"p{r}": f"c{r}" for r in range(4)})
    # a cut lies behind a value, half way to the next one: seen from behind, the next is the one before
    back = previous(run.withColumns({"w": -F.col("v"), "_s": -F.col("_s")}), ["w"], {"next": "v"})
    after = back.select(F.coalesce((F.col("v") + F.col("next")) / 2, F.col("v") + 1).alias("t"), *[f"p{r}" for r in range(4)])
    zero = F.lit(0).cast("long")
    before = per.groupBy().agg((F.min("v") - 1).alias("t"), *[zero.alias(f"p{r}") for r in range(4)]).where("t is not null")
    total = per.agg(F.sum("c3").alias("n3"), F.sum(sum(F.col(f"c{r}") for r in range(4))).alias("n"))
    cuts = after.unionByName(before)
    edges = value_edges(per, "v", n)
    ranked = lambda d: d.withColumn("_s", value_stratum(F.col("t"), edges))
    first = F.struct((F.col("p0") - F.col("p1")).alias("s"), (-F.col("t")).alias("t1"))
    one = running(ranked(cuts), ["t"], {}, {"first": first}, exclusive=True)
    pair = F.when(F.col("first").isNotNull(), F.struct((F.col("first.s") + F.col("p1") - F.col("p2")).alias("s"), F.col("first.t1").alias("t1"), (-F.col("t")).alias("t2")))
    two = running(one, ["t"], {}, {"two": pair}, exclusive=True).where("two is not null").join(F.broadcast(total))
    best = F.max(F.struct((F.col("two.s") + F.col("p2") - F.col("p3") + F.col("n3")).alias("s"), F.col("two.t1").alias("t1"), F.col("two.t2").alias("t2"), (-F.col("t")).alias("t3"), F.col("n").alias("n")))
    return two.agg(best.alias("b")).where("b is not null").select((-F.col("b.t1")).alias("t1"), (-F.col("b.t2")).alias("t2"), (-F.col("b.t3")).alias("t3"), F.col("b.s").alias("right"), F.col("b.n").alias("n"), F.round(F.col("b.s") / F.col("b.n"), 6).alias("accuracy"))


def classify(df: DataFrame, value: str, cuts: tuple[float, float, float], names: tuple[str, str, str, str]) -> DataFrame:
    """Rows per class of three thresholds, classes without rows included."""
    v = F.col(value)
    cls = F.when(v < cuts[0], names[0]).when(v < cuts[1], names[1]).when(v < cuts[2], names[2]).otherwise(names[3])
    counts = df.where(v.isNotNull()).groupBy(cls.alias("class")).agg(F.count("*").alias("c"))
    dim = df.sparkSession.createDataFrame([(n,) for n in names], "class string")
    return dim.join(counts, "class", "left").select("class", F.coalesce("c", F.lit(0)).alias("n"))


def confusion(pairs: DataFrame, gold: str, said: str) -> DataFrame:
    """Support, precision, recall and F1 of each gold class, 0 where nothing was said or hit; null said counts as a miss."""
    cell = pairs.where(F.col(gold).isNotNull()).groupBy(F.col(gold).alias("g"), F.col(said).alias("s")).agg(F.count("*").alias("n"))
    of_gold = cell.groupBy(F.col("g").alias("label")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("g") == F.col("s"), F.col("n")).otherwise(0)).alias("right"))
    of_said = cell.where("s is not null").groupBy(F.col("s").alias("label")).agg(F.sum("n").alias("said"))
    met = of_gold.join(of_said, "label", "left").withColumn("said", F.coalesce("said", F.lit(0)))
    p = F.when(F.col("said") > 0, F.col("right") / F.col("said")).otherwise(F.lit(0.0))
    r = F.col("right") / F.col("support")
    return met.select("label", "support", "said", "right", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)), 6).alias("f1"))


def evaluation(pairs: DataFrame, gold: str, said: str) -> DataFrame:
    """One row: rows, right ones, accuracy, macro F1, rows that nothing could be read from, and their rate."""
    rows = pairs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col(gold).eqNullSafe(F.col(said)).cast("long")), F.lit(0).cast("long")).alias("right"), F.coalesce(F.sum(F.col(said).isNull().cast("long")), F.lit(0).cast("long")).alias("unread"))
    macro = confusion(pairs, gold, said).agg(F.round(F.coalesce(F.avg("f1"), F.lit(0.0)), 5).alias("macro_f1"))
    rate = lambda c: F.round(F.when(F.col("n") > 0, F.col(c) / F.col("n")).otherwise(F.lit(0.0)), 6)
    return rows.join(F.broadcast(macro)).select("n", "right", rate("right").alias("accuracy"), "macro_f1", "unread", rate("unread").alias("unread_rate"))


def confusion_matrix(pairs: DataFrame, gold: str, said: str) -> DataFrame:
    """gold, said, n; what could not be read is UNREAD."""
    text = lambda c, x: F.coalesce(F.col(c).cast("string"), F.lit(x))
    return pairs.groupBy(text(gold, "None").alias("gold"), text(said, "UNREAD").alias("said")).agg(F.count("*").alias("n"))


def read_answer(raw: str, choices: str) -> tuple[Column, Column]:
    """The choice that a free answer names, and how: alone, inside the answer, or by its letter; null and unread otherwise.

    Texts meet by their answer keys. Two choices that fit alike are no answer.
    """
    keys = F.transform(F.col(choices), lambda c: F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "^" + ENDS, ""), ENDS + "$", ""))
    said = F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(F.col(raw), F.lit("")))), "^" + ENDS, ""), ENDS + "$", "")
    spots = F.sequence(F.lit(0), F.greatest(F.size(choices) - 1, F.lit(0)))
    fits = lambda test: F.filter(spots, lambda i: (F.get(keys, i) != "") & test(F.get(keys, i)))
    same, inside = fits(lambda k: k == said), fits(lambda k: F.contains(said, k))
    letter = F.when(said.rlike("^[a-z]$"), F.ascii(said) - 97)
    read = (said != "") & (F.size(choices) > 0)
    one = lambda a: F.get(F.col(choices), F.get(a, F.lit(0)))
    by_letter = F.get(F.col(choices), letter)
    value = F.when(read & (F.size(same) == 1), one(same)).when(read & (F.size(same) == 0) & (F.size(inside) == 1), one(inside)).when(read & (F.size(same) == 0) & (F.size(inside) == 0), by_letter)
    how = F.when(read & (F.size(same) == 1), "exact").when(read & (F.size(same) == 0) & (F.size(inside) == 1), "contained").when(read & (F.size(same) == 0) & (F.size(inside) == 0) & by_letter.isNotNull(), "letter").otherwise("unread")
    return value, how


def percentiles(df: DataFrame, group: str, value: str, points: tuple[float, ...] = (0.01, 0.05, 0.5, 0.95, 0.99), strata: int | None = None) -> DataFrame:
    """group, point and the percentile there by four conventions: the value at place round(q (n - 1)), half to even; the
    least value that ceil(q n) rows don't exceed; between the values around q (n - 1); and the value at place n div 2.

    From running counts over distinct values in strata: no group's values are held together. Empty groups give no rows.
    """
    per = df.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("grp"), F.col(value).cast("double").alias("v")).agg(F.count("*").alias("c"))
    ranked = _ranked(per, "v", strata)
    inside = Window.partitionBy("grp", "_s").orderBy("v")
    earlier = Window.partitionBy("grp").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)  # a row a stratum
    totals = ranked.groupBy("grp", "_s").agg(F.sum("c").alias("t")).select("grp", "_s", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("b"))
    size = per.groupBy("grp").agg(F.sum("c").alias("n"))
    run = ranked.withColumn("i", F.sum("c").over(inside)).join(F.broadcast(totals), ["grp", "_s"]).join(F.broadcast(size), "grp")
    run = run.select("grp", "v", "n", (F.col("i") + F.col("b") - F.col("c")).alias("lo"), (F.col("i") + F.col("b")).alias("hi"))
    at = run.withColumn("q", F.explode(F.array(*[F.lit(float(p)) for p in points])))
    spot = F.col("q") * (F.col("n") - 1)
    holds = lambda place: F.max(F.when((F.col("lo") <= place) & (place < F.col("hi")), F.col("v")))
    got = at.groupBy("grp", "q", "n").agg(holds(F.bround(spot)).alias("nearest"), holds(F.ceil(F.col("q") * F.col("n")) - 1).alias("ceiled"), holds(F.floor(spot)).alias("_a"), holds(F.ceil(spot)).alias("_b"), holds(F.floor(F.col("n") / 2)).alias("middle"))
    weight = spot - F.floor(spot)
    return got.select(F.col("grp").alias(group), F.col("q").alias("point"), "n", F.round("nearest", 6).alias("nearest"), F.round("ceiled", 6).alias("ceiled"), F.round(F.col("_a") * (1 - weight) + F.col("_b") * weight, 5).alias("linear"), F.round("middle", 6).alias("middle"))


def distribution(df: DataFrame, value: str, groups: list[str] | None = None) -> DataFrame:
    """Rows, least, most, mean and population deviation of each group."""
    v = F.col(value).cast("double")
    return df.groupBy(*(groups or [])).agg(F.count(v).alias("n"), F.round(F.min(v), 6).alias("least"), F.round(F.max(v), 6).alias("most"), F.round(F.avg(v), 4).alias("mean"), F.round(F.stddev_pop(v), 4).alias("dev"))
