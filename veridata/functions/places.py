"""Places and running totals without a window over the table or over a large group.

A table is cut into strata in the order asked for; windows run inside a stratum, and the strata's own totals, a few rows,
are summed up in front of each. Strata by a digest need no look at the data, as digests are even; strata by a value take
their edges from a quantile sketch. Both are the same at every evaluation, so a lost task is computed again as it was.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one window task should hold.
STRATUM_ROWS = 500_000


def strata_for(df: DataFrame, rows: int = STRATUM_ROWS) -> int:
    return max(1, math.ceil(df.count() / rows))


def hash_stratum(h: Column, strata: int) -> Column:
    """Stratum of a hex digest, in the digests' order."""
    return F.floor(F.conv(F.substring(h, 1, 8), 16, 10).cast("double") * strata / float(1 << 32)).cast("int")


def placed(df: DataFrame, groups: list[str], stratum: Column, order: list[str], name: str = "place") -> DataFrame:
    """The rows with their place, from 0, in ``order`` inside their group (without groups: the table). ``stratum`` numbers the
    strata in that order."""
    rows = df.withColumn("_s", stratum)
    inside = F.row_number().over(Window.partitionBy(*groups, "_s").orderBy(*order)) - 1
    before = Window.partitionBy(*groups).orderBy("_s") if groups else Window.orderBy("_s")  # a row a stratum
    firsts = rows.groupBy(*groups, "_s").agg(F.count("*").alias("_c")).withColumn("_f", F.sum("_c").over(before) - F.col("_c")).drop("_c")
    same = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in [*groups, "_s"]]
    met = rows.withColumn("_i", inside).alias("a").join(firsts.alias("b"), same)
    return met.select("a.*", (F.col("b._f") + F.col("a._i")).cast("long").alias(name)).drop("_s", "_i")


def placed_by_hash(df: DataFrame, groups: list[str], h: str, ties: list[str], strata: int | None = None, name: str = "place") -> DataFrame:
    """``placed`` in the order of the digest ``h``."""
    n = strata_for(df) if strata is None else strata
    return placed(df, groups, hash_stratum(F.col(h), n), [h, *ties], name)


def value_edges(df: DataFrame, value: str, strata: int) -> list[float]:
    """Inner edges of about even strata of a numeric column: a sketch, merged map-side."""
    if strata <= 1:
        return []
    return sorted(set(df.approxQuantile(value, [i / strata for i in range(1, strata)], 0.25 / strata)))


def value_stratum(value: Column, edges: list[float]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e <= value.cast("double"))) if edges else F.lit(0)


def running(df: DataFrame, order: list[str], sums: dict[str, str], maxima: dict[str, Column] | None = None, stratum: str = "_s", exclusive: bool = False) -> DataFrame:
    """Running sums and maxima over the rows in ``order``, of columns by output name; ``exclusive``: of the rows before only.

    ``stratum`` numbers the strata in that order.
    """
    maxima = maxima or {}
    rows = df.select("*", *[c.alias(f"_m_{n}") for n, c in maxima.items()])
    end = -1 if exclusive else 0
    inside = Window.partitionBy(stratum).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    earlier = Window.orderBy(stratum).rowsBetween(Window.unboundedPreceding, -1)  # a row a stratum
    totals = rows.groupBy(stratum).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()], *[F.max(f"_m_{n}").alias(f"_t_{n}") for n in maxima])
    totals = totals.select(stratum, *[F.sum(f"_t_{n}").over(earlier).alias(f"_b_{n}") for n in sums], *[F.max(f"_t_{n}").over(earlier).alias(f"_b_{n}") for n in maxima])
    out = rows.select("*", *[F.sum(c).over(inside).alias(f"_i_{n}") for n, c in sums.items()], *[F.max(f"_m_{n}").over(inside).alias(f"_i_{n}") for n in maxima])
    out = out.join(F.broadcast(totals), stratum)
    zero = F.lit(0).cast("long")
    added = [(F.coalesce(f"_i_{n}", zero) + F.coalesce(f"_b_{n}", zero)).alias(n) for n in sums]
    best = [F.when(F.col(f"_b_{n}").isNull() | (F.col(f"_i_{n}") >= F.col(f"_b_{n}")), F.col(f"_i_{n}")).otherwise(F.col(f"_b_{n}")).alias(n) for n in maxima]
    return out.select(*df.columns, *added, *best)


def previous(df: DataFrame, order: list[str], columns: dict[str, str], stratum: str = "_s") -> DataFrame:
    """The rows with columns of the row before them in ``order``, across strata; null for the first row."""
    row = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_v_{n}") for n, c in columns.items()])
    last = df.groupBy(stratum).agg(F.max(row).alias("_l"))
    last = last.select(stratum, F.lag("_l").over(Window.orderBy(stratum)).alias("_p"))  # a row a stratum
    inside = Window.partitionBy(stratum).orderBy(*order)
    rows = df.select("*", F.row_number().over(inside).alias("_n"), *[F.lag(c).over(inside).alias(f"_w_{n}") for n, c in columns.items()]).join(F.broadcast(last), stratum)
    return rows.select(*df.columns, *[F.when(F.col("_n") == 1, F.col(f"_p._v_{n}")).otherwise(F.col(f"_w_{n}")).alias(n) for n in columns])
