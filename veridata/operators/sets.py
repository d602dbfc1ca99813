"""Contamination, duplicate conflicts, split overlap and vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hash_int, spoken_key
from ..functions.parsing import blank, clock_seconds

_RUN = 5


def _words(c: str):
    return F.array_remove(F.split(F.col(c), r"\s+"), "")


def contains_reserved(docs: DataFrame, reserved: DataFrame, broadcast_bytes: int = 1 << 20) -> DataFrame:
    """doc_id, item_id of texts that hold a reserved text as a substring.

    The second to sixth word of a held item of seven words or more stand whole in the text, so an equi-join on runs of five
    words finds all candidates; the substring test decides. Shorter items, up to ``broadcast_bytes`` of them, are tested
    against every text; more of them meet the texts' pieces of their lengths by equality.
    """
    short = reserved.where(F.col("text").isNotNull() & (F.size(_words("text")) < _RUN + 2)).select("item_id", F.col("text").alias("needle"))
    texts = docs.where("text is not null").select("doc_id", "text")
    if short.agg(F.coalesce(F.sum(F.octet_length("needle") + 32), F.lit(0))).first()[0] <= broadcast_bytes:
        few = texts.join(F.broadcast(short), F.contains("text", "needle")).select("doc_id", "item_id")
    else:
        lengths = short.agg(F.collect_set(F.length("needle")).alias("lengths"))  # of texts of six words
        spots = lambda n: F.when(F.length("text") >= n, F.sequence(F.lit(1), F.length("text") - n + 1)).otherwise(F.array().cast("array<int>"))
        pieces = F.flatten(F.transform("lengths", lambda n: F.transform(spots(n), lambda i: F.xxhash64(F.substring(F.col("text"), i, n)))))
        cut = texts.join(F.broadcast(lengths)).select("doc_id", F.explode(F.array_distinct(F.array_append(pieces, F.xxhash64(F.lit(""))))).alias("h"))
        met = cut.join(short.withColumn("h", F.xxhash64("needle")), "h").select("doc_id", "item_id", "needle").distinct()
        few = texts.join(met, "doc_id").where(F.contains("text", "needle")).select("doc_id", "item_id")
    items = reserved.select("item_id", F.col("text").alias("needle"), _words("text").alias("w")).where(F.size("w") >= _RUN + 2).select("item_id", "needle", F.xxhash64(*[F.element_at("w", i + 2) for i in range(_RUN)]).alias("run"))
    runs = F.element_at(F.transform(F.array(_words("text")), lambda w: F.transform(F.when(F.size(w) >= _RUN, F.sequence(F.lit(1), F.size(w) - (_RUN - 1))).otherwise(F.array().cast("array<int>")), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(_RUN)]))), 1)
    met = texts.select("doc_id", F.explode(F.array_distinct(runs)).alias("run")).join(items.select("item_id", "run"), "run").select("doc_id", "item_id").distinct()
    return met.join(texts, "doc_id").join(items.select("item_id", "needle"), "item_id").where(F.contains("text", "needle")).select("doc_id", "item_id").unionAll(few).distinct()


def duplicate_conflicts(docs: DataFrame, label: str) -> DataFrame:
    """Groups of equal comparison keys: members, distinct labels, whether they conflict."""
    keyed = docs.where("text is not null").select("doc_id", F.sha2(spoken_key("text"), 256).alias("text_key"), label)
    return keyed.groupBy("text_key").agg(F.count("*").alias("n"), F.countDistinct(label).alias("n_labels"), F.min("doc_id").alias("first_id")).where("n > 1").withColumn("conflict", F.col("n_labels") > 1)


def terminal_class(orders: DataFrame) -> DataFrame:
    """Customers by the splits their orders fall into; only clean training customers are usable."""
    s = hash_int("o_orderkey") % 10
    per = orders.groupBy("o_custkey").agg(F.max((s < 8).cast("int")).alias("train"), F.max((s == 8).cast("int")).alias("val"), F.max((s == 9).cast("int")).alias("test"))
    cls = F.when((F.col("test") == 1) & (F.col("train") == 1), "RESERVED_OVERLAP").when(F.col("test") == 1, "RESERVED").when((F.col("val") == 1) & (F.col("train") == 1), "VAL_OVERLAP").when(F.col("val") == 1, "VAL_ONLY").otherwise("CLEAN_TRAIN")
    return per.select(cls.alias("class")).groupBy("class").agg(F.count("*").alias("n"))


def split_overlap(docs: DataFrame, split: str) -> DataFrame:
    """For each pair of splits, how many texts both hold; a text lists its splits once, of which there are few."""
    per = docs.where("text is not null").groupBy(F.sha2(spoken_key("text"), 256).alias("k")).agg(F.array_sort(F.collect_set(split)).alias("s")).where(F.size("s") > 1)
    pairs = per.select(F.col("s"), F.explode("s").alias("a")).select("a", F.explode("s").alias("b")).where("a < b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n_texts"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """Per language: distinct words outside training, how many of them training never saw, and of occurrences alike."""
    part = (hash_int("doc_id") % 10 < 8).cast("int")
    words = docs.where("text is not null and lang is not null").select("lang", part.alias("train"), F.explode(F.split(spoken_key("text"), " ")).alias("w")).where("w <> ''")
    per = words.groupBy("lang", "w").agg(F.sum("train").alias("t"), F.sum(1 - F.col("train")).alias("o")).where("o > 0")
    return per.groupBy("lang").agg(F.count("*").alias("types"), F.sum((F.col("t") == 0).cast("long")).alias("unseen_types"), F.sum("o").alias("occurrences"), F.sum(F.when(F.col("t") == 0, F.col("o")).otherwise(0)).alias("unseen_occurrences"))


def overlaps(events: DataFrame, seconds: int) -> DataFrame:
    """Per user: intervals of fixed length that start before the one before ends."""
    start = F.unix_seconds(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = events.select("user_id", (start - F.lag(start).over(w)).alias("gap"))
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.sum(F.coalesce((F.col("gap") < seconds).cast("long"), F.lit(0))).alias("n_overlaps"))


def interval_audit(df: DataFrame, group: str, start: str, end: str) -> DataFrame:
    """One row over intervals of clock texts: rows that can't be read, repeats of an interval in its group, and intervals that
    start before the one before them, in the order of start and end, has ended."""
    a, z = clock_seconds(start), clock_seconds(end)
    rows = df.select(F.col(group).alias("g"), a.alias("a"), z.alias("z"))
    bad = blank("g") | F.col("a").isNull() | F.col("z").isNull()
    n = lambda x: F.coalesce(F.sum(x.cast("long")), F.lit(0).cast("long"))
    good = rows.where(~bad)
    per = good.groupBy("g", "a", "z").agg(F.count("*").alias("c"))
    # repeats beside each other all overlap when the interval has a length
    late = F.lag("z").over(Window.partitionBy("g").orderBy("a", "z"))
    overlapping = per.withColumn("late", F.col("a") < late).agg(n(F.col("late")).alias("between"), n(F.when(F.col("z") > F.col("a"), F.col("c") - 1)).alias("inside"), n(F.col("c") - 1).alias("repeated"))
    return rows.agg(n(bad).alias("unparseable")).join(F.broadcast(overlapping)).select("unparseable", "repeated", (F.col("between") + F.col("inside")).alias("overlapping"))
