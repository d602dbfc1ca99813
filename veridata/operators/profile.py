"""Table profiles, dependency proofs and class statistics: one map-side combined aggregate each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import spoken_key
from ..functions.parsing import age, age_group, blank, url_id


def profile(df: DataFrame, name: str) -> DataFrame:
    """table_name, field, n, n_missing, n_distinct of every column, in one pass."""
    aggs = [F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("field"), F.count(F.lit(1)).alias("n"), F.sum(F.col(c).isNull().cast("long")).alias("n_missing"), F.countDistinct(c).alias("n_distinct")).alias(f"p{i}") for i, c in enumerate(df.columns)]
    return df.agg(*aggs).select(F.explode(F.array(*[f"p{i}" for i in range(len(aggs))])).alias("p")).select("p.*")


def dependency(df: DataFrame, source: str, target: str) -> DataFrame:
    """Whether source determines target: sources, sources with two rows or more, sources with two targets or more."""
    per = df.where(F.col(source).isNotNull() & F.col(target).isNotNull()).groupBy(source).agg(F.count("*").alias("n"), F.countDistinct(target).alias("t"))
    return per.agg(F.count("*").alias("n_sources"), F.sum((F.col("n") >= 2).cast("long")).alias("n_reusable"), F.sum((F.col("t") > 1).cast("long")).alias("n_violations")).withColumn("holds", (F.col("n_violations") == 0) & (F.col("n_reusable") > 0))


def conflicts(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows and distinct values of each group, and whether they conflict."""
    return df.groupBy(group).agg(F.count("*").alias("n_rows"), F.countDistinct(value).alias("n_values")).withColumn("conflict", F.col("n_values") > 1)


def age_consistency(df: DataFrame, speaker: str, raw: str) -> DataFrame:
    """Per speaker with a name: distinct ages and age groups, and whether either conflicts; ages under 18 have no group."""
    years = age(raw)
    per = df.where(~blank(speaker)).groupBy(speaker).agg(F.count("*").alias("n_rows"), F.countDistinct(years).alias("n_ages"), F.countDistinct(age_group(years)).alias("n_groups"))
    return per.withColumns({"raw_conflict": F.col("n_ages") > 1, "bin_conflict": F.col("n_groups") > 1})


def id_audit(df: DataFrame, url: str) -> DataFrame:
    """One row: rows, ids read from their URLs, missing and malformed URLs, distinct ids, ids of several rows and those rows."""
    ids = df.select(F.col(url).alias("u"), url_id(url).alias("id"))
    n = lambda x: F.coalesce(F.sum(x.cast("long")), F.lit(0).cast("long"))
    rows = ids.agg(F.count("*").alias("n"), F.count("id").alias("parsed"), n(blank("u")).alias("missing"), n(~blank("u") & F.col("id").isNull()).alias("malformed"))
    per = ids.where("id is not null").groupBy("id").agg(F.count("*").alias("c"))
    again = per.agg(F.count("*").alias("n_ids"), n(F.col("c") > 1).alias("repeated_ids"), n(F.when(F.col("c") > 1, F.col("c"))).alias("repeated_rows"))
    return rows.join(F.broadcast(again))


def information(df: DataFrame, label: str) -> DataFrame:
    """Entropy, normalised entropy, effective classes, majority rate and balanced capacity of a label."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("c"))
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("classes"), F.max("c").alias("most"), F.min("c").alias("least"), F.sum(F.col("c") * F.log2("c")).alias("s"))
    h = F.log2("n") - F.col("s") / F.col("n")
    return total.select("n", "classes", F.round(h, 6).alias("entropy"), F.round(F.when(F.col("classes") > 1, h / F.log2("classes")).otherwise(h), 6).alias("normalized"), F.round(F.pow(F.lit(2.0), h), 6).alias("effective"), F.round(F.col("most") / F.col("n"), 6).alias("majority"), (F.col("least") * F.col("classes")).alias("balanced"))


def shortcut(df: DataFrame, group: str, label: str) -> DataFrame:
    """Share of rows whose label follows from their group alone."""
    per = df.groupBy(group).agg(F.count("*").alias("n"), F.countDistinct(label).alias("k"))
    return per.agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.col("k") == 1, F.col("n")).otherwise(0)).alias("n_implied")).withColumn("rate", F.round(F.col("n_implied") / F.col("n_rows"), 6))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def field_profile(df: DataFrame, types: dict[str, str] | None = None, few: int = 20) -> DataFrame:
    """field, dtype, n, missing, empty, distinct, and of fields with more than ``few`` values the least, most and mean text
    length; of the others null. One pass over the table."""
    names = {"bigint": "int64", "int": "int64", "double": "float", "float": "float", "string": "string", "boolean": "boolean"}
    kinds = {**{c: names.get(t, t) for c, t in df.dtypes}, **(types or {})}
    text = {c: F.col(c).cast("string") for c in df.columns}
    aggs = []
    for i, c in enumerate(df.columns):
        n = F.length(text[c])
        aggs.append(F.struct(F.lit(c).alias("field"), F.lit(kinds[c]).alias("dtype"), F.count(F.lit(1)).alias("n"), F.sum(F.col(c).isNull().cast("long")).alias("missing"), F.sum((F.trim(text[c]) == "").cast("long") if kinds[c] == "string" else F.lit(0).cast("long")).alias("empty"), F.countDistinct(c).alias("distinct"), F.min(n).alias("a"), F.max(n).alias("z"), F.avg(n).alias("m")).alias(f"p{i}"))
    rows = df.agg(*aggs).select(F.explode(F.array(*[f"p{i}" for i in range(len(aggs))])).alias("p")).select("p.*")
    many = lambda x: F.when(F.col("distinct") > few, x)
    return rows.select("field", "dtype", "n", F.coalesce("missing", F.lit(0)).alias("missing"), F.coalesce("empty", F.lit(0)).alias("empty"), "distinct", many(F.col("a")).alias("least_length"), many(F.col("z")).alias("most_length"), many(F.round("m", 2)).alias("mean_length"))


def value_distribution(df: DataFrame, fields: list[str], few: int = 20) -> DataFrame:
    """field, value, n of the fields that have at most ``few`` values."""
    each = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("e")).select("e.*").where("value is not null")
    counts = each.groupBy("field", "value").agg(F.count("*").alias("n"))
    small = counts.groupBy("field").agg(F.count("*").alias("k")).where(F.col("k") <= few).select("field")
    return counts.join(F.broadcast(small), "field", "left_semi")


def index_summary(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, valid rows, empty ones, distinct values, largest group, groups of two rows or more."""
    out = []
    for f in fields:
        value = F.col(f).cast("string")
        per = df.select(F.when(F.trim(value) != "", value).alias("v")).groupBy("v").agg(F.count("*").alias("c"))
        v = F.col("v").isNotNull()
        n = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
        out.append(per.agg(n(F.when(v, F.col("c"))).alias("valid"), n(F.when(~v, F.col("c"))).alias("empty"), n(v.cast("long")).alias("domain"), F.coalesce(F.max(F.when(v, F.col("c"))), F.lit(0)).alias("largest"), n((v & (F.col("c") > 1)).cast("long")).alias("reusable")).select(F.lit(f).alias("field"), "*"))
    return union_all(out)


def speakers(df: DataFrame, speaker: str, label: str) -> DataFrame:
    """One row: speakers, rows, pairs of one speaker, speakers of a single row, largest speaker, speakers with two labels."""
    per = df.where(~blank(speaker)).groupBy(speaker).agg(F.count("*").alias("c"), (F.min(label) != F.max(label)).alias("conflict"))
    n = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    return per.agg(F.count("*").alias("n_speakers"), n(F.col("c")).alias("n"), n(F.col("c") * (F.col("c") - 1) / 2).alias("pairs"), n((F.col("c") == 1).cast("long")).alias("single"), F.coalesce(F.max("c"), F.lit(0)).alias("largest"), n(F.coalesce(F.col("conflict"), F.lit(False)).cast("long")).alias("conflicting"))


def group_histogram(df: DataFrame, group: str) -> DataFrame:
    """size, n_groups: how many groups have so many rows."""
    return df.where(~blank(group)).groupBy(group).agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("n_groups"))


def speaker_map(df: DataFrame, key: str, speaker: str, gender: str, region: str, order: str) -> DataFrame:
    """key, speaker, region of its last row, and the gender where the speaker has one alone."""
    one = df.where(F.col(gender).isNotNull()).groupBy(speaker).agg(F.min(gender).alias("a"), F.max(gender).alias("z"))
    rows = df.groupBy(key).agg(F.max_by(F.struct(speaker, region), order).alias("l")).select(key, F.col(f"l.{speaker}").alias("speaker"), F.col(f"l.{region}").alias("region"))
    met = rows.join(one, rows["speaker"] == one[speaker], "left")
    return met.select(key, "speaker", "region", F.when(F.col("a") == F.col("z"), F.col("a")).alias("gender"))


def metadata_audit(df: DataFrame, field: str, speaker: str) -> DataFrame:
    """One row: rows, missing, empty, distinct values, repeated rows, and speakers: all, of one label, of several, of none."""
    text = F.col(field).cast("string")
    n = lambda x: F.coalesce(F.sum(F.coalesce(x, F.lit(False)).cast("long")), F.lit(0).cast("long"))
    rows = df.agg(F.count("*").alias("n"), n(text.isNull()).alias("missing"), n(F.trim(text) == "").alias("empty"), F.countDistinct(text).alias("n_values"))
    kinds = df.groupBy(*df.columns).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("repeated_rows"))
    per = df.where(F.col(speaker).isNotNull()).groupBy(speaker).agg(F.countDistinct(text).alias("k"), F.max(text.isNull()).alias("some_null"), F.count("*").alias("c"))
    who = per.agg(F.count("*").alias("n_speakers"), n((F.col("k") == 1) & ~F.col("some_null")).alias("consistent"), n(F.col("k") > 1).alias("conflicting"), n(F.col("k") == 0).alias("unlabelled"), F.min("c").alias("least"), F.max("c").alias("most"), F.round(F.avg("c"), 4).alias("mean"))
    return rows.join(F.broadcast(kinds)).join(F.broadcast(who))


def text_audit(df: DataFrame, text: str, label: str, labels: list[str]) -> DataFrame:
    """One row: rows, rows of other labels, without text or label, distinct texts and comparison keys, and their repeats."""
    key = F.sha2(spoken_key(text), 256)
    n = lambda x: F.coalesce(F.sum(F.coalesce(x, F.lit(False)).cast("long")), F.lit(0).cast("long"))
    rows = df.agg(F.count("*").alias("n"), n(~F.coalesce(F.col(label).isin(*labels), F.lit(False))).alias("invalid_label"), n(blank(text)).alias("empty_text"), n(blank(label)).alias("missing_label"), F.countDistinct(F.coalesce(F.col(text), F.lit(""))).alias("n_texts"), F.countDistinct(F.coalesce(key, F.lit(""))).alias("n_keys"))
    return rows.withColumns({"repeated_texts": F.col("n") - F.col("n_texts"), "repeated_keys": F.col("n") - F.col("n_keys")})


def stream_audit(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row, one pass: usable rows, rows without id or text, all upper or lower case, with punctuation, digits or signs
    beyond ASCII, signs of either case, and distinct ids, texts and comparison keys by 64-bit fingerprints."""
    t = F.col(text)
    good = ~blank(key) & ~blank(text)
    n = lambda x: F.coalesce(F.sum((good & x).cast("long")), F.lit(0).cast("long"))
    upper, lower = F.upper(t) == t, F.lower(t) == t
    count = lambda p: F.coalesce(F.sum(F.when(good, F.length(F.regexp_replace(t, p, "")))), F.lit(0)).cast("long")
    distinct = lambda c: F.countDistinct(F.when(good, F.xxhash64(c)))
    return df.agg(n(F.lit(True)).alias("n"), F.coalesce(F.sum(blank(key).cast("long")), F.lit(0)).alias("no_id"), F.coalesce(F.sum((~blank(key) & blank(text)).cast("long")), F.lit(0)).alias("no_text"), n(upper & ~lower).alias("all_upper"), n(lower & ~upper).alias("all_lower"), n(t.rlike(r"\p{P}")).alias("punctuation"), n(t.rlike("[0-9]")).alias("digits"), n(t.rlike(r"[^\x00-\x7F]")).alias("beyond_ascii"), count(r"\P{Lu}").alias("upper_signs"), count(r"\P{Ll}").alias("lower_signs"), distinct(F.col(key).cast("string")).alias("ids"), distinct(t).alias("texts"), distinct(spoken_key(text)).alias("keys"))


def length_histogram(df: DataFrame, text: str) -> DataFrame:
    """kind, length, n of texts by signs and by words."""
    words = F.size(F.array_remove(F.split(F.col(text), r"\s+"), ""))
    each = df.where(F.col(text).isNotNull()).select(F.explode(F.array(F.struct(F.lit("signs").alias("kind"), F.length(text).alias("length")), F.struct(F.lit("words").alias("kind"), words.alias("length")))).alias("e")).select("e.*")
    return each.groupBy("kind", "length").agg(F.count("*").alias("n"))


def dataset_profile(df: DataFrame, seconds: str, text: str, terms: Column, topic: str, video: str) -> DataFrame:
    """One row: rows, hours, text and token lengths, terms a row, topics, videos and rows of the largest video."""
    tokens = F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), ""))
    k = F.size(terms)
    rows = df.agg(F.count("*").alias("n"), F.round(F.sum(seconds) / 3600, 4).alias("hours"), F.min(F.length(text)).alias("least_text"), F.max(F.length(text)).alias("most_text"), F.round(F.avg(tokens), 4).alias("mean_tokens"), F.sum(k).cast("long").alias("n_terms"), F.max(k).alias("most_terms"), F.coalesce(F.sum((k == 0).cast("long")), F.lit(0)).alias("without_terms"), F.countDistinct(topic).alias("n_topics"), F.countDistinct(video).alias("n_videos"))
    most = df.where(F.col(video).isNotNull()).groupBy(video).agg(F.count("*").alias("c")).agg(F.max("c").alias("largest_video"))
    return rows.join(F.broadcast(most))


def class_distribution(df: DataFrame, label: str, speaker: str, classes: list[str]) -> DataFrame:
    """class, n, n_speakers of all classes, empty ones too."""
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count("*").alias("c"), F.countDistinct(speaker).alias("k"))
    return df.sparkSession.createDataFrame([(x,) for x in classes], "class string").join(counts, "class", "left").select("class", F.coalesce("c", F.lit(0)).alias("n"), F.coalesce("k", F.lit(0)).alias("n_speakers"))


def coverage(fields: list[str], candidates: DataFrame, key: str, text: list[str]) -> DataFrame:
    """field, n, users: which candidates name each field in any of their texts, in any case."""
    told = F.lower(F.concat_ws(" ", *text))
    named = F.filter(F.array(*[F.lit(f) for f in fields]), lambda f: F.contains(told, F.lower(f)))
    per = candidates.select(F.col(key).cast("string").alias("k"), F.explode(named).alias("field")).groupBy("field").agg(F.count("*").alias("c"), F.min("k").alias("first"))
    return candidates.sparkSession.createDataFrame([(f,) for f in fields], "field string").join(per, "field", "left").select("field", F.coalesce("c", F.lit(0)).alias("n"), "first")


def relation_verdict(df: DataFrame, source: str, target: str, schema: set[str] | None = None, roles: dict[str, str] | None = None, hidden: set[str] | None = None) -> DataFrame:
    """One row: whether target is a coarser function of source, proven by the rows, or the first reason why not.

    In this order: the same field, a field that isn't known, a hidden identifier, a field without a meaning of its own, no rows
    with both, fewer than two sources, fewer than two targets, a source with two targets, fewer than two sources that occur
    twice, no fewer targets than sources. Counts beside it are of rows with both.
    """
    spark, roles, hidden = df.sparkSession, roles or {}, hidden or set()
    known = set(df.columns) if schema is None else schema

    def early() -> str | None:
        if source == target:
            return "invalid_derived_same_field"
        for f in (source, target):
            if f not in known:
                return f"unknown_answer_field:{f}"
        for f, side in ((source, "source"), (target, "target")):
            if f in hidden or roles.get(f) == "hidden_identifier":
                return f"invalid_derived_hidden_{side}"
        for f in (source, target):
            if roles.get(f, "semantic") != "semantic":
                return f"ineligible_field_role:{roles[f]}:{f}"
        return None

    told = early()
    out = "source string, target string, valid boolean, reason string, n_sources long, n_targets long, conflicts long, reusable long"
    if told:
        return spark.createDataFrame([(source, target, False, told, 0, 0, 0, 0)], out)
    both = df.where(F.col(source).isNotNull() & F.col(target).isNotNull())
    per = both.groupBy(source).agg(F.count("*").alias("n"), F.countDistinct(target).alias("t"))
    n = lambda x: F.coalesce(F.sum(x.cast("long")), F.lit(0).cast("long"))
    facts = per.agg(F.count("*").alias("n_sources"), n(F.col("t") > 1).alias("conflicts"), n(F.col("n") > 1).alias("reusable")).join(F.broadcast(both.agg(F.countDistinct(target).alias("n_targets"))))
    s, t = F.col("n_sources"), F.col("n_targets")
    reason = F.when(s == 0, "derived_relation_data_unavailable").when(s < 2, "invalid_derived_insufficient_source_values").when(t < 2, "invalid_derived_insufficient_target_values").when(F.col("conflicts") > 0, "invalid_derived_nonfunctional_relation").when(F.col("reusable") < 2, "invalid_derived_nonreusable_source").when(t >= s, "invalid_derived_not_coarsening")
    return facts.select(F.lit(source).alias("source"), F.lit(target).alias("target"), reason.isNull().alias("valid"), reason.alias("reason"), "n_sources", "n_targets", "conflicts", "reusable")


def derived_values(df: DataFrame, key: str, source: str, target: str) -> DataFrame:
    """key, value: the target that a row's source stands for, where all rows of the source agree on one."""
    one = df.where(F.col(source).isNotNull() & F.col(target).isNotNull()).groupBy(source).agg(F.min(target).alias("a"), F.max(target).alias("z")).where("a = z")
    return df.join(one, source).select(key, F.col("a").alias("value"))


def collisions(df: DataFrame, value: str, key: Column, allowed: list[set[str]]) -> DataFrame:
    """norm, n_raw, unexpected of the keys that several raw values share: expected only if one allowed group holds them all."""
    raw = df.select(F.coalesce(F.col(value).cast("string"), F.lit("None")).alias("raw"), key.alias("norm")).distinct()
    groups = [F.min(F.col("raw").isin(*sorted(g))) for g in allowed]
    inside = reduce(lambda a, b: a | b, groups, F.lit(False))
    return raw.groupBy("norm").agg(F.count("*").alias("n_raw"), (~inside).alias("unexpected")).where("n_raw > 1")


def information_gate(metrics: DataFrame, least: int = 50, balanced: int = 100) -> DataFrame:
    """A row of ``information`` with its verdict: no variation, informative, or uneven with too few of the rarest class, too
    small an even sample, or enough for one."""
    even = (F.col("majority") <= 0.8) & (F.col("normalized") >= 0.5)
    reason = F.when(F.coalesce(F.col("n"), F.lit(0)) == 0, "NO_LABEL_VARIATION").when(F.col("classes") < 2, "NO_LABEL_VARIATION").when(even, "REASONABLE_INFORMATION").when(F.col("balanced") / F.col("classes") < least, "INSUFFICIENT_MINORITY_CAPACITY").when(F.col("balanced") < balanced, "BALANCED_CAPACITY_TOO_SMALL").otherwise("PASS_WITH_PLANNER_BALANCING_CAPABILITY")
    ok = reason.isin("REASONABLE_INFORMATION", "PASS_WITH_PLANNER_BALANCING_CAPABILITY")
    return metrics.select("*", reason.alias("reason"), F.when(ok, "PASS").otherwise("AUTO_REJECT_TASK").alias("severity"))
