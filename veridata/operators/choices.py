"""Multiple-choice construction, template choice and hash samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import digest, hash_int, spoken_key, word_bucket
from ..functions.places import placed_by_hash


def fixed_universe_choices(df: DataFrame, key: str, gold: str, universe: DataFrame, wrong: int = 3) -> DataFrame:
    """Gold and the ``wrong`` other values of a small universe that come first by hash, in hash order."""
    names = universe.agg(F.array_sort(F.collect_set(gold)).alias("u"))
    ranked = F.array_sort(F.transform(F.filter("u", lambda x: x != F.col(gold)), lambda x: F.struct(digest(F.lit("wrong"), F.col(key), x).alias("h"), x.alias("x"))))
    picked = F.concat(F.array(F.col(gold)), F.transform(F.slice(ranked, 1, wrong), lambda s: s["x"]))
    shown = F.transform(F.array_sort(F.transform(picked, lambda x: F.struct(digest(F.lit("order"), F.col(key), x).alias("h"), x.alias("x")))), lambda s: s["x"])
    rows = df.join(F.broadcast(names)).withColumn("choices", shown)
    return rows.select(F.col(key).alias("row_id"), F.col(gold).alias("answer"), F.array_join("choices", "|").alias("choices"), (F.array_position("choices", F.col(gold)) - 1).alias("position"))


BUCKETS = ("01-05", "06-10", "11-20", "21-40", "41-80", "81+")


def bucket_choices(docs: DataFrame, wrong: int = 3) -> DataFrame:
    """doc_id, n, distractor: for each text ``wrong`` others of like length that are no comparison copies of it or of each other.

    Each comparison key is held once, by its smallest doc_id, in that text's word bucket; the keys of a bucket stand in hash
    order. A text starts at a hashed place and walks on until it has enough, in its own bucket first, then in the next
    nearest, the smaller one of two. It is left short only if the whole table has too few other keys.
    """
    n_words = F.size(F.split(F.trim("text"), r"\s+"))
    rows = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.sha2(spoken_key("text"), 256).alias("k"), word_bucket(n_words).alias("bucket"))
    pool = rows.groupBy("k").agg(F.min(F.struct("doc_id", "bucket")).alias("f")).select("k", F.col("f.doc_id").alias("other"), F.col("f.bucket").alias("b"))
    pool = placed_by_hash(pool, ["b"], "k", [], name="ord")
    sizes = {r.b: r.n for r in pool.groupBy("b").agg(F.count("*").alias("n")).collect()}  # six rows
    tries = []
    for i, own in enumerate(BUCKETS):
        sure, turn = 0, 0
        for b in sorted(sizes, key=lambda b, i=i: (abs(BUCKETS.index(b) - i), b)):
            if sure < wrong:  # a bucket holds the own key at most once
                tries.append((own, b, turn, sizes[b], min(sizes[b], wrong + 1)))
                sure, turn = sure + sizes[b] - 1, turn + 1
    spark = docs.sparkSession
    plan = spark.createDataFrame(tries, "bucket string, b string, turn int, size long, steps long")  # 36 rows at most
    probes = rows.join(F.broadcast(plan), "bucket").withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("steps") - 1)))
    probes = probes.withColumn("ord", (hash_int("doc_id", "b") + F.col("j")) % F.col("size"))
    met = probes.join(pool.withColumnRenamed("k", "ok"), ["b", "ord"]).where("ok <> k")
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("turn", "j"))  # a few rows a text
    return met.withColumn("n", n).where(F.col("n") <= wrong).select("doc_id", F.col("n").cast("int").alias("n"), F.col("other").alias("distractor"))


def choice_shortfall(docs: DataFrame, chosen: DataFrame, wrong: int = 3) -> DataFrame:
    """doc_id, missing: anchors with fewer than ``wrong`` choices."""
    have = chosen.groupBy("doc_id").agg(F.count("*").alias("have"))
    return docs.where(F.col("text").isNotNull()).select("doc_id").join(have, "doc_id", "left").select("doc_id", (F.lit(wrong) - F.coalesce("have", F.lit(0))).alias("missing")).where("missing > 0")


def template_by_hash(df: DataFrame, key: str, templates: int) -> DataFrame:
    return df.select(F.col(key).alias("row_id"), (hash_int(F.lit("template"), key) % templates).cast("int").alias("template"))


def template_balanced(df: DataFrame, key: str, templates: int) -> DataFrame:
    """Blocks of ``templates`` rows in hash order; in a block each template once, by a second hash: over the whole table no
    template is used more than once more than another."""
    rows = df.select(F.col(key).alias("row_id"), digest(key).alias("h"))
    block = placed_by_hash(rows, [], "h", ["row_id"]).withColumn("block", F.floor(F.col("place") / templates))
    turn = F.row_number().over(Window.partitionBy("block").orderBy(digest(F.lit("turn"), "row_id"), "row_id")) - 1
    return block.withColumn("template", turn.cast("int")).select("row_id", "block", "template")


def hash_top(df: DataFrame, group: str, keys: list[str], k: int) -> DataFrame:
    """The k rows of each group that come first by hash; a smaller k gives a prefix."""
    w = Window.partitionBy(group).orderBy(digest(*keys), *keys)
    return df.select(group, *keys).withColumn("n", F.row_number().over(w)).where(F.col("n") <= k)


def composite_choices(docs: DataFrame) -> DataFrame:
    """Two texts and whether they are equal, as one choice of four.

    The pool holds the first document of each comparison key, in hash order. Each is paired with the next one of the circle
    or, where its hash says so, with itself; the one after is the wrong text. Wrong choices: the other truth, the wrong
    second text, the wrong first text. A pool of fewer than three gives no rows.
    """
    pool = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.sha2(spoken_key("text"), 256).alias("k")).agg(F.min("doc_id").alias("doc_id"))
    placed = placed_by_hash(pool, [], "k", [])
    ring = placed.join(F.broadcast(placed.agg(F.count("*").alias("size")).where("size >= 3")))  # one row
    at = placed.select(F.col("place").alias("at"), F.col("doc_id").alias("there"))
    step = lambda rows, i, name: rows.withColumn("at", F.pmod(F.col("place") + i, "size")).join(at, "at").withColumnRenamed("there", name).drop("at")
    ring = step(step(ring, 1, "next"), 2, "third")
    same = hash_int(F.lit("same"), "doc_id") % 2 == 0
    rows = ring.select(F.col("doc_id").alias("a"), F.when(same, F.col("doc_id")).otherwise(F.col("next")).alias("b"), "third", same.alias("same"))
    said = lambda x, y, z: F.concat_ws(",", x, y, z.cast("string"))
    gold = said(F.col("a"), F.col("b"), F.col("same"))
    four = F.array(gold, said(F.col("a"), F.col("b"), ~F.col("same")), said(F.col("a"), F.col("third"), F.col("same")), said(F.col("third"), F.col("b"), F.col("same")))
    return rows.select("a", "b", "same", gold.alias("answer"), shown_choices(F.col("a"), four).alias("c")).select("a", "b", "same", "answer", F.array_join("c", "|").alias("choices"), (F.array_position("c", F.col("answer")) - 1).alias("position"))


def shown_choices(key: Column, choices: Column) -> Column:
    """Choices in the order of their hashes with the row's key."""
    return F.transform(F.array_sort(F.transform(choices, lambda x: F.struct(digest(F.lit("order"), key, x).alias("h"), x.alias("x")))), lambda p: p["x"])


def audit_choices(mcq: DataFrame) -> DataFrame:
    """One row of violation counts of rows (row_id, answer, choices, position); all are 0 in a sound set."""
    c = F.split("choices", r"\|")
    bad = lambda x: F.coalesce(F.sum(x.cast("long")), F.lit(0).cast("long"))
    ids = mcq.groupBy("row_id").agg(F.count("*").alias("k")).agg(bad(F.col("k") > 1).alias("repeated_ids"))
    at = F.try_element_at(c, (F.col("position") + 1).cast("int"))
    out = mcq.agg(F.count("*").alias("n"), bad(~F.array_contains(c, F.col("answer"))).alias("answer_missing"), bad(F.size(F.array_distinct(c)) < F.size(c)).alias("repeated_choices"), bad(~at.eqNullSafe(F.col("answer"))).alias("wrong_gold"))
    return out.join(F.broadcast(ids))
