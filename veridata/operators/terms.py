"""Audits of term lists beside texts: levels, forms, counts, order, negative pools, vocabulary of splits.

Rows hold an id, a text and a semicolon list of terms. A null text counts as empty, a null list as no terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def total(x: Column, name: str) -> Column:
    """How many rows fulfil a condition; null counts as no."""
    return F.coalesce(F.sum(F.coalesce(x, F.lit(False)).cast("long")), F.lit(0).cast("long")).alias(name)


def each_term(df: DataFrame, terms: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.explode(T.term_list(terms)).alias("term"))


def match_levels(df: DataFrame, text: str, terms: str) -> DataFrame:
    """level, n of all annotated terms."""
    return each_term(df, terms, text).select(T.term_match("term", text).alias("level")).groupBy("level").agg(F.count("*").alias("n"))


def match_examples(df: DataFrame, key: str, text: str, terms: str, k: int = 5) -> DataFrame:
    """The first k terms, by row and term, of each level but the raw one."""
    rows = each_term(df, terms, key, text).select(T.term_match("term", text).alias("level"), F.col(key).alias("row_id"), "term").where("level <> 'A_RAW'").distinct()
    n = F.row_number().over(Window.partitionBy("level").orderBy("row_id", "term"))
    return rows.withColumn("n", n).where(F.col("n") <= k)


def forms(df: DataFrame, terms: str) -> DataFrame:
    """One row: terms of several words, acronyms, capitalised, lower case, with digits, hyphens, slashes; rows that repeat one."""
    t = F.col("term")
    acronym = t.rlike("^[A-Z]{2,}$")
    capital = t.rlike("^[A-Z][a-z]+( [A-Z][a-z]+)*$")
    lower = (F.lower(t) == t) & (F.upper(t) != t)
    counts = each_term(df, terms).agg(total(F.contains(t, F.lit(" ")), "multiword"), total(acronym, "acronym"), total(~acronym & capital, "capitalized"), total(~acronym & ~capital & lower, "lowercase"), total(t.rlike("[0-9]"), "digits"), total(F.contains(t, F.lit("-")), "hyphen"), total(F.contains(t, F.lit("/")), "slash"))
    listed = T.term_list(terms)
    return counts.join(F.broadcast(df.agg(total(F.size(F.array_distinct(listed)) < F.size(listed), "repeating_rows"))))


def declared_counts(df: DataFrame, declared: str, terms: str) -> DataFrame:
    """One row: whether the declared number of terms is that of the list."""
    n, said = F.size(T.term_list(terms)), F.col(declared)
    same = F.coalesce(said == n, F.lit(False))
    return df.agg(F.count("*").alias("n"), total(same, "exact"), total(~same, "mismatch"), total(~same & (said == 0) & (n > 0), "zero_but_terms"), total(~same & (said > 0) & (n == 0), "some_but_none"))


def order(df: DataFrame, text: str, terms: str) -> DataFrame:
    """One row over rows of two terms or more: listed as they occur, otherwise, one not found, or one repeated."""
    bare = lambda c: T.collapse(T.no_punctuation(F.lower(c)))
    rows = df.select(bare(F.coalesce(F.col(text), F.lit(""))).alias("x"), T.term_list(terms).alias("listed")).where(F.size("listed") > 1)
    spots = F.transform("listed", lambda t: F.instr(F.col("x"), bare(t)))
    rows = rows.withColumn("spots", spots)
    missing = F.exists("spots", lambda s: s == 0)
    repeated = F.size(F.array_distinct("listed")) < F.size("listed")
    rising = F.col("spots") == F.array_sort("spots")
    kind = F.when(missing, "missing").when(repeated, "repeated").when(rising, "same").otherwise("other")
    k = rows.select(kind.alias("k"))
    is_ = lambda x: F.col("k") == x
    return k.agg(F.count("*").alias("n"), total(is_("same"), "same_order"), total(is_("other"), "other_order"), total(is_("missing"), "not_found"), total(is_("repeated"), "repeated"))


def negative_pools(df: DataFrame, key: str, text: str, terms: str, topic: str | None = None) -> DataFrame:
    """row_id, pool: how many terms of the vocabulary (of the row's topic, if one is named) are neither annotated for the
    row nor stand in its text. The text's own pieces of the vocabulary's lengths meet the vocabulary by equality, so the work
    is a text's length times the number of term lengths, not rows times vocabulary."""
    bare = lambda c: T.collapse(T.no_punctuation(F.lower(c)))
    norm = lambda c: T.collapse(F.lower(c))
    group = F.col(topic).cast("string") if topic else F.lit("")
    rows = df.select(F.col(key).alias("row_id"), group.alias("topic"), bare(F.coalesce(F.col(text), F.lit(""))).alias("x"), F.transform(T.term_list(terms), norm).alias("own"))
    vocabulary = rows.select("topic", F.explode("own").alias("t")).distinct()
    size = vocabulary.groupBy("topic").agg(F.count("*").alias("v"))
    lengths = vocabulary.agg(F.collect_set(F.length("t")).alias("lengths"))  # as many as terms have lengths
    cut = F.flatten(F.transform("lengths", lambda n: F.transform(F.when(F.length("x") >= n, F.sequence(F.lit(1), F.length("x") - n + 1)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(F.col("x"), i, n))))
    held = rows.join(F.broadcast(lengths)).select("row_id", "topic", F.explode(F.array_distinct(F.concat(cut, F.col("own")))).alias("t"))
    taken = held.join(vocabulary, ["topic", "t"]).groupBy("row_id").agg(F.count("*").alias("taken"))
    out = rows.select("row_id", "topic").join(size, "topic", "left").join(taken, "row_id", "left")
    return out.select("row_id", (F.coalesce("v", F.lit(0)) - F.coalesce("taken", F.lit(0))).alias("pool"))


def split_vocabulary(df: DataFrame, split: str, terms: str, train: str = "train", rare: int = 2) -> DataFrame:
    """Per other split: vocabulary sizes, types and occurrences seen and unseen in training, types that training has rarely."""
    word = each_term(df, terms, split).select(split, T.collapse(F.lower("term")).alias("t"))
    counts = word.groupBy(split, "t").agg(F.count("*").alias("c"))
    known = counts.where(F.col(split) == train).select("t", F.col("c").alias("train"))
    met = counts.where(F.col(split) != train).join(known, "t", "left")
    per = met.groupBy(F.col(split).alias("split")).agg(F.count("*").alias("types"), total(F.col("train").isNotNull(), "seen"), total(F.col("train").isNull(), "unseen"), F.sum(F.when(F.col("train").isNotNull(), F.col("c")).otherwise(0)).alias("seen_occurrences"), F.sum(F.when(F.col("train").isNull(), F.col("c")).otherwise(0)).alias("unseen_occurrences"), total(F.col("train") <= rare, "rare"))
    rate = lambda a, b: F.round(F.col(a) / (F.col(a) + F.col(b)), 4)
    return per.join(F.broadcast(known.agg(F.count("*").alias("train_types")))).withColumn("unseen_rate", rate("unseen", "seen")).withColumn("unseen_occurrence_rate", rate("unseen_occurrences", "seen_occurrences"))


def split_identity(df: DataFrame, split: str, keys: dict[str, Column]) -> DataFrame:
    """kind, a, b, n: how many values of each kind two splits share; a value lists its splits once, of which there are few."""
    told = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("array<string>").alias("v")) for k, c in keys.items()])).alias("e")
    rows = df.select(split, told).select(split, "e.kind", F.explode("e.v").alias("v")).where("trim(v) <> ''")
    per = rows.groupBy("kind", "v").agg(F.collect_set(split).alias("s")).where(F.size("s") > 1)
    pairs = per.select("kind", "s", F.explode("s").alias("a")).select("kind", "a", F.explode("s").alias("b")).where("a < b")
    return pairs.groupBy("kind", "a", "b").agg(F.count("*").alias("n"))


def labels(df: DataFrame, label: str) -> DataFrame:
    """One row: rows, missing, raw and normalised kinds of a label."""
    present = F.trim(F.col(label)) != ""
    raw = F.when(present, F.col(label))
    return df.agg(F.count("*").alias("n"), total(~F.coalesce(present, F.lit(False)), "missing"), F.countDistinct(raw).alias("raw_labels"), F.countDistinct(F.lower(F.trim(raw))).alias("labels"))
