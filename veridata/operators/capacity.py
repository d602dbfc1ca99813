"""How many questions a field supports, from group sizes alone; no pair is listed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import comb2


def capacity(df: DataFrame, field: str, name: str) -> DataFrame:
    """Capacities of the four operators for one field."""
    sizes = df.where(F.col(field).isNotNull()).groupBy(field).agg(F.count("*").alias("c"))
    t = sizes.agg(F.sum("c").alias("n"), F.count("*").alias("d"), F.sum(comb2(F.col("c"))).alias("pos"), F.sum(F.col("c") * F.col("c")).alias("sq"))
    return t.select(F.lit(name).alias("field"), F.col("n").alias("direct"), F.col("pos").alias("equal_pos"), (comb2(F.col("n")) - F.col("pos")).alias("equal_neg"), F.col("n").alias("match_pos"), (F.col("n") * (F.col("d") - 1)).alias("match_neg"), (F.col("n") * F.col("n") - F.col("sq")).alias("selection"))


def pair_buckets(df: DataFrame, field: str) -> DataFrame:
    """Per value: rows with it, pairs of both, of neither and of exactly one."""
    sizes = df.where(F.col(field).isNotNull()).groupBy(field).agg(F.count("*").alias("p"))
    n = sizes.agg(F.sum("p").alias("n"))
    rest = F.col("n") - F.col("p")
    return sizes.join(F.broadcast(n)).select(F.col(field).alias("value"), "p", comb2(F.col("p")).alias("both"), comb2(rest).alias("neither"), (F.col("p") * rest).alias("valid"))


def neighborhood_feasible(df: DataFrame, field: str, same: int, different: int) -> DataFrame:
    """Whether each group has ``same`` new partners for each row, and the circle ``different`` ones outside its group."""
    sizes = df.where(F.col(field).isNotNull()).groupBy(field).agg(F.count("*").alias("m"))
    total = sizes.agg(F.sum("m").alias("n"), F.max("m").alias("largest"))
    return sizes.join(F.broadcast(total)).select(F.col(field).alias("value"), "m", (comb2(F.col("m")) >= same * F.col("m")).alias("same_ok"), (2 * (F.col("largest") + different - 1) < F.col("n")).alias("different_ok"))


def equal_budget(capacities: DataFrame, name: str, limit: str, total: int) -> DataFrame:
    """A total in equal shares, the remainder to the first names, each share cut to the capacity. One row per type."""
    from pyspark.sql import Window

    n = capacities.agg(F.count("*").alias("k"))
    place = F.row_number().over(Window.orderBy(name)) - 1
    share = F.floor(F.lit(total) / F.col("k")) + (F.col("i") < F.lit(total) % F.col("k")).cast("long")
    return capacities.withColumn("i", place).join(F.broadcast(n)).select(F.col(name).alias("name"), F.least(share, F.col(limit)).alias("budget"), (share > F.col(limit)).alias("capped"))


def feasible(capacities: DataFrame, operator: str, ratio: float | None = None) -> DataFrame:
    """field, operator, feasible: the largest number of distinct instances that hold the share of positive ones.

    From frames of ``capacity``: direct by rows, selection by its pairs, the others by the scarcer side; a ratio of 0 or 1 only
    needs one side. Without a ratio: one half.
    """
    r = 0.5 if ratio is None else ratio
    sides = {"EQUALITY": ("equal_pos", "equal_neg"), "TARGET_MATCH": ("match_pos", "match_neg")}
    if operator in sides:
        pos, neg = (F.col(c) for c in sides[operator])
        n = neg if r <= 0 else pos if r >= 1 else F.floor(F.least(pos / F.lit(r), neg / F.lit(1 - r)))
    else:
        n = F.col("direct" if operator == "DIRECT" else "selection")
    return capacities.select("field", F.lit(operator).alias("operator"), n.cast("long").alias("feasible"))


def resolve_budget(feasible_: DataFrame, name: str, limit: str, total: int | None = None, per_type: dict[str, int] | None = None, debug: int | None = None, strict: bool = False) -> DataFrame:
    """type, requested, budget, shortfall, status of each type: a debug total or a total in equal shares (the remainder to the
    first names), or what each type is given; cut to what is feasible. A strict budget that is cut is infeasible as a whole."""
    from pyspark.sql import Window

    rows = feasible_.select(F.col(name).alias("type"), F.col(limit).alias("limit"))
    if debug is not None or (total and not per_type):
        n = total if debug is None else debug
        whole = rows.agg(F.count("*").alias("k"))
        place = F.row_number().over(Window.orderBy("type")) - 1  # a row a type
        rows = rows.withColumn("i", place).join(F.broadcast(whole))
        requested = F.floor(F.lit(n) / F.col("k")) + (F.col("i") < F.lit(n) % F.col("k")).cast("long")
        status = "TOTAL_BUDGET_EQUAL_BY_TYPE" if debug is None else "DEBUG_SAMPLE_BUDGET"
    elif per_type:
        unknown = sorted(set(per_type) - {r[0] for r in rows.select("type").collect()})  # a row a type
        if unknown:
            raise ValueError(f"budget for unknown types {unknown}")
        given = F.create_map(*[F.lit(x) for k, v in sorted(per_type.items()) for x in (k, int(v))])
        requested, status = F.coalesce(F.try_element_at(given, F.col("type")), F.lit(0)), "PER_TYPE_BUDGET"
    else:
        return rows.select("type", F.lit(None).cast("long").alias("requested"), F.lit(None).cast("long").alias("budget"), F.lit(None).cast("long").alias("shortfall"), F.lit("READY_AWAITING_BUDGET").alias("status"))
    out = rows.select("type", requested.cast("long").alias("requested"), F.least(requested, F.col("limit")).cast("long").alias("budget"))
    out = out.withColumn("shortfall", F.col("requested") - F.col("budget"))
    short = out.agg((F.sum("shortfall") > 0).alias("short"))
    return out.join(F.broadcast(short)).select("type", "requested", "budget", "shortfall", F.when(F.col("short") & F.lit(strict), "BUDGET_INFEASIBLE").otherwise(status).alias("status"))


def allocation_hash(budgets: DataFrame, dataset: str, split: str) -> DataFrame:
    """One row: the approved total and a hash that binds it to the dataset, the split and each type's share."""
    shares = F.array_sort(F.collect_list(F.concat_ws("=", "type", F.col("budget").cast("string"))))  # a row a type
    return budgets.agg(F.sum("budget").alias("total"), F.sha2(F.concat_ws("|", F.lit(dataset), F.lit(split), F.array_join(shares, ",")), 256).alias("hash"))


def topologies(df: DataFrame, anchor: str, group: str, candidates: DataFrame, labels: DataFrame) -> DataFrame:
    """topology, raw, valid, excluded, positive, negative: the instances that each shape of question has, by closed forms.

    ``candidates``: (candidate) what rows can be asked about; ``labels``: (anchor, candidate) what is true of them. raw is
    always valid and excluded together.
    """
    n = df.agg(F.countDistinct(anchor).alias("n"))
    c = candidates.agg(F.countDistinct("candidate").alias("c"))
    true = labels.distinct().groupBy("candidate").agg(F.count("*").alias("p"))
    t = true.join(candidates.distinct(), "candidate", "left_semi").join(F.broadcast(n))
    rest = F.col("n") - F.col("p")
    sums = t.agg(F.coalesce(F.sum("p"), F.lit(0)).alias("pos"), F.coalesce(F.sum(F.col("p") * rest), F.lit(0)).alias("cond"), F.coalesce(F.sum(comb2(F.col("p"))), F.lit(0)).alias("both"), F.coalesce(F.sum(comb2(rest)), F.lit(0)).alias("neither"), F.count("*").alias("hit"))
    same = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("m")).agg(F.coalesce(F.sum(comb2(F.col("m"))), F.lit(0)).alias("same"))
    x = n.join(F.broadcast(c)).join(F.broadcast(sums)).join(F.broadcast(same))
    pairs, zero = comb2(F.col("n")), F.lit(0).cast("long")
    unhit = (F.col("c") - F.col("hit")) * pairs  # candidates true of no row
    row = lambda name, raw, valid, pos, neg: F.struct(F.lit(name).alias("topology"), raw.cast("long").alias("raw"), valid.cast("long").alias("valid"), (raw - valid).cast("long").alias("excluded"), pos.cast("long").alias("positive"), neg.cast("long").alias("negative"))
    space = F.col("n") * F.col("c")
    rows = [
        row("ONE_TO_ONE", F.col("n"), F.col("n"), F.col("n"), zero),
        row("CARTESIAN_PRESENCE", space, space, F.col("pos"), space - F.col("pos")),
        row("UNORDERED_PAIR", pairs, pairs, F.col("same"), pairs - F.col("same")),
        row("TARGET_CONDITIONED_UNORDERED_PAIR", F.col("cond") + F.col("both") + F.col("neither") + unhit, F.col("cond"), F.col("cond"), zero),
    ]
    return x.select(F.explode(F.array(*rows)).alias("e")).select("e.*")


def resolve_plan(universe: DataFrame, key: str, positive: str, total: int, ratio: float, seed: int = 42) -> DataFrame:
    """key, relation of ``total`` instances, positive to negative as ``ratio`` to 1 (all positive without one), each side the
    first by a seeded hash. More than the universe holds of a side is an error, not a smaller plan."""
    pos = round(total * (ratio / (1.0 + ratio))) if ratio > 0 else total
    held = universe.agg(F.coalesce(F.sum(F.col(positive).cast("long")), F.lit(0)).alias("p"), F.coalesce(F.sum((~F.col(positive)).cast("long")), F.lit(0)).alias("n")).first()
    if pos > held.p or total - pos > held.n:
        raise ValueError(f"planned {pos} positive and {total - pos} negative instances of {held.p} and {held.n}")
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    side = lambda x, k, name: universe.where(x).orderBy(h, key).limit(k).select(key, F.lit(name).alias("relation"))
    return side(F.col(positive), pos, "POSITIVE").unionAll(side(~F.col(positive), total - pos, "NEGATIVE"))
