"""The engine's operators as queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import calibrate, capacity, choices, pairs, plan, profile, samples, sets
from ..sources.readers import table
from .registry import query


@query
def q_profile_table(s, d):
    return profile.union_all([profile.profile(table(s, d, t), t) for t in ("customer", "part")])


@query
def q_missing_normalize(s, d):
    e = table(s, d, "events").withColumn("v", K.missing_to_null("event_type", ("error", "none", "")))
    return e.groupBy("user_id").agg(F.count("*").alias("n"), F.count("v").alias("n_present"), F.countDistinct("v").alias("n_kinds"))


@query
def q_textnorm_ascii(s, d):
    return table(s, d, "documents").select("doc_id", F.sha2(K.spoken_key("text"), 256).alias("text_key"), K.audio_id("docs", "r1", "doc_id").alias("audio_id"))


@query
def q_field_dependency(s, d):
    c = table(s, d, "customer").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    a = profile.dependency(c, "n_nationkey", "n_regionkey").withColumn("relation", F.lit("nation->region"))
    return a.unionByName(profile.dependency(c, "c_mktsegment", "n_regionkey").withColumn("relation", F.lit("segment->region")))


@query
def q_group_conflict(s, d):
    return profile.conflicts(table(s, d, "orders"), "o_custkey", "o_orderstatus")


@query
def q_comparator_collision(s, d):
    p = table(s, d, "part").select(K.spoken_key("p_name").alias("norm"), "p_name", "p_type")
    return p.groupBy("norm").agg(F.count("*").alias("n"), F.countDistinct("p_name").alias("n_raw"), F.countDistinct("p_type").alias("n_types"))


@query
def q_group_shortcut(s, d):
    return profile.shortcut(table(s, d, "orders"), "o_custkey", "o_orderstatus")


@query
def q_contingency(s, d):
    c = table(s, d, "customer").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.groupBy("n_regionkey", "c_mktsegment").agg(F.count("*").alias("n"), F.countDistinct("c_nationkey").alias("n_nations"))


@query
def q_percentiles(s, d):
    return calibrate.percentiles(table(s, d, "lineitem"), "l_returnflag", "l_extendedprice")


@query
def q_distribution(s, d):
    return calibrate.distribution(table(s, d, "lineitem"), "l_extendedprice", ["l_returnflag"])


@query
def q_entropy_info(s, d):
    return profile.information(table(s, d, "customer"), "c_mktsegment")


@query
def q_hist_audit(s, d):
    docs = table(s, d, "documents").where("text is not null")
    n = F.size(F.split(K.spoken_key("text"), " "))
    return docs.groupBy("lang", K.word_bucket(n).alias("bucket")).agg(F.count("*").alias("n"), F.sum(F.col("text").rlike("[0-9]").cast("long")).alias("n_digits"), F.sum(F.length("text")).alias("chars"))


@query
def q_capacity_all(s, d):
    c, o = table(s, d, "customer"), table(s, d, "orders")
    return profile.union_all([capacity.capacity(c, "c_mktsegment", "c_mktsegment"), capacity.capacity(c, "c_nationkey", "c_nationkey"), capacity.capacity(o, "o_orderpriority", "o_orderpriority")])


@query
def q_capacity_topology(s, d):
    return capacity.pair_buckets(table(s, d, "customer"), "c_mktsegment")


@query
def q_neighborhood_feasible(s, d):
    return capacity.neighborhood_feasible(table(s, d, "orders"), "o_orderpriority", 4, 4)


@query
def q_budget_equal(s, d):
    return capacity.equal_budget(q_capacity_all(s, d).select("field", "direct"), "field", "direct", 10_000)


@query
def q_direct_roundrobin(s, d):
    return pairs.direct_round_robin(table(s, d, "customer"), "c_custkey", "c_mktsegment", 200)


@query
def q_pairs_positive(s, d):
    return pairs.same_group_pairs(table(s, d, "orders"), "o_orderkey", "o_custkey")


@query
def q_pairs_neighborhood(s, d):
    return pairs.neighborhood(table(s, d, "customer"), "c_custkey", "c_mktsegment")


@query
def q_negative_tiered(s, d):
    c = table(s, d, "customer").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return pairs.tiered_negative(c, "c_custkey", "c_nationkey", [["n_regionkey", "c_mktsegment"], ["n_regionkey"], []])


@query
def q_verification_plan(s, d):
    o = table(s, d, "orders").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return pairs.verification_plan(o, "o_orderkey", "o_custkey", [["c_nationkey", "c_mktsegment"], ["c_nationkey"], []])


@query
def q_target_match(s, d):
    return pairs.target_match(table(s, d, "part"), "p_partkey", "p_type")


@query
def q_alternating_sample(s, d):
    return plan.alternating(table(s, d, "part"), "p_partkey", "p_type", 100)


@query
def q_external_split(s, d):
    t = F.col("text")
    docs = table(s, d, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("  "), t)).when(F.col("doc_id") % 3 == 1, F.concat(t, F.lit("."))).alias("reference"))
    out = plan.external_split(docs, "doc_id", "text", "reference")
    gold = F.when(F.col("type") == "TRANSCRIBE", "text").otherwise(F.col("gold"))
    return out.groupBy("type", gold.alias("gold")).agg(F.count("*").alias("n"), F.countDistinct(F.array_join(F.array_sort("row_ids"), ",")).alias("n_sets"))


@query
def q_preview_pairs(s, d):
    return plan.preview_pairs(q_verification_plan(s, d), table(s, d, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("value")))


@query
def q_pairwise_selection(s, d):
    return pairs.selection(table(s, d, "customer"), "c_custkey", "c_mktsegment")


@query
def q_circular_next(s, d):
    return pairs.circular_next(table(s, d, "supplier"), "s_suppkey", "s_nationkey").withColumnRenamed("row_id", "s_suppkey")


@query
def q_reference_match(s, d):
    docs = table(s, d, "documents")
    keyed = docs.where("text is not null").select("doc_id", "text", F.sha2(K.spoken_key("text"), 256).alias("k"))
    first = keyed.groupBy("k").agg(F.min(F.struct("doc_id", "text")).alias("f"))
    kind = F.when(F.col("text") == F.col("f.text"), "RAW_EQUAL").when(F.lower("text") == F.lower("f.text"), "CASE_ONLY").otherwise("PUNCTUATION_OR_SPACE")
    return keyed.join(first, "k").where(F.col("doc_id") != F.col("f.doc_id")).select("doc_id", F.col("f.doc_id").alias("reference_id"), kind.alias("difference"))


@query
def q_mcq_distractors_fixed(s, d):
    c = table(s, d, "customer").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(s, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return choices.fixed_universe_choices(c, "c_custkey", "r_name", table(s, d, "region"))


@query
def q_mcq_distractors_bucket(s, d):
    return choices.bucket_choices(table(s, d, "documents"))


@query
def q_template_hash(s, d):
    return choices.template_by_hash(table(s, d, "orders"), "o_orderkey", 7)


@query
def q_template_balanced(s, d):
    return choices.template_balanced(table(s, d, "orders"), "o_orderkey", 5)


@query
def q_hash_topk_nested(s, d):
    return choices.hash_top(table(s, d, "lineitem"), "l_returnflag", ["l_orderkey", "l_linenumber"], 50)


@query
def q_rank_first_usable(s, d):
    good = table(s, d, "customer").where("c_acctbal >= 0")
    return good.groupBy("c_nationkey").agg(F.min(F.struct(K.digest("c_custkey").alias("h"), F.col("c_custkey"))).alias("f"), F.count("*").alias("n_usable")).select("c_nationkey", F.col("f.c_custkey").alias("c_custkey"), "n_usable")


@query
def q_contamination(s, d):
    return sets.contains_reserved(table(s, d, "documents"), table(s, d, "benchmark"))


@query
def q_dup_conflict(s, d):
    return sets.duplicate_conflicts(table(s, d, "documents"), "source")


@query
def q_terminal_class(s, d):
    return sets.terminal_class(table(s, d, "orders"))


@query
def q_cross_split_overlap(s, d):
    return sets.split_overlap(table(s, d, "documents"), "source")


@query
def q_vocab_seen_unseen(s, d):
    return sets.vocabulary(table(s, d, "documents"))


@query
def q_interval_overlap(s, d):
    return sets.overlaps(table(s, d, "events"), 3600)


@query
def q_calibrate_boundary(s, d):
    return calibrate.best_boundary(table(s, d, "part").withColumn("low", F.col("p_size") <= 20), "p_retailprice", "low")


@query
def q_classify(s, d):
    return calibrate.classify(table(s, d, "lineitem"), "l_quantity", (10.0, 25.0, 60.0), ("slow", "medium", "fast", "very fast"))


@query
def q_reuse_stats(s, d):
    return pairs.reuse(q_pairs_neighborhood(s, d))


@query
def q_most_used(s, d):
    return pairs.most_used(q_verification_plan(s, d))


@query
def q_plan_shortfall(s, d):
    return pairs.plan_shortfall(q_verification_plan(s, d))


@query
def q_audit_plan(s, d):
    p, c = q_pairs_neighborhood(s, d), table(s, d, "customer").select("c_custkey", "c_mktsegment")
    both = p.join(c.withColumnsRenamed({"c_custkey": "a", "c_mktsegment": "ga"}), "a").join(c.withColumnsRenamed({"c_custkey": "b", "c_mktsegment": "gb"}), "b")
    unordered = both.groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.count("*").alias("k"))
    return both.agg(F.count("*").alias("n"), F.sum(((F.col("ga") == F.col("gb")) != F.col("same")).cast("long")).alias("wrong_gold"), F.sum((F.col("a") == F.col("b")).cast("long")).alias("self_pairs")).join(unordered.agg(F.sum((F.col("k") > 1).cast("long")).alias("repeated")))


@query
def q_eval_confusion(s, d):
    j = table(s, d, "labels").join(table(s, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return calibrate.confusion(j.select(F.col("quality"), (F.col("n_chars") >= 1000).cast("int").alias("said")), "quality", "said")


def _said(s, d):
    """Documents' source of twenty as the gold class, and a rule that names half of them, another class or none."""
    n = F.col("n_chars") % 7
    said = F.when(n < 3, F.col("source")).when(n < 5, "src1").when(n == 5, "elsewhere")
    return table(s, d, "documents").select(F.col("source").alias("gold"), F.when(F.col("source") != "src9", said).alias("said"))


@query
def q_eval_classes(s, d):
    return calibrate.confusion(_said(s, d), "gold", "said")


@query
def q_eval_summary(s, d):
    return calibrate.evaluation(_said(s, d), "gold", "said")


@query
def q_eval_matrix(s, d):
    return calibrate.confusion_matrix(_said(s, d), "gold", "said")


@query
def q_eval_answers(s, d):
    k = F.col("o_orderkey") % 6
    words = F.array(F.lit("LOW"), F.lit("HIGH"), F.lit("URGENT"), F.lit("MEDIUM"))
    gold = F.substring_index("o_orderpriority", "-", -1)
    raw = F.when(k == 0, F.concat(F.lower(gold), F.lit("."))).when(k == 1, F.concat(F.lit("It is "), gold, F.lit("!"))).when(k == 2, F.lit(" (b) ")).when(k == 3, F.lit("low or high")).when(k == 4, F.lit(None).cast("string")).otherwise(F.lit("z"))
    rows = table(s, d, "orders").select(words.alias("choices"), gold.alias("gold"), raw.alias("raw"))
    value, how = calibrate.read_answer("raw", "choices")
    return rows.select("gold", value.alias("said"), how.alias("how")).groupBy("gold", "said", "how").agg(F.count("*").alias("n"))


@query
def q_dependency_manifest(s, d):
    p = q_pairs_neighborhood(s, d)
    return p.select(F.explode(F.array("a", "b")).alias("row_id")).groupBy("row_id").agg(F.count("*").alias("n_refs")).select(K.audio_id("customer", "r1", "row_id").alias("audio_id"), "n_refs")


@query
def q_union_release(s, d):
    a = q_template_hash(s, d).select(F.concat(F.lit("o"), F.col("row_id")).alias("id"), F.lit("DIRECT").alias("operator"), F.col("template").cast("string").alias("answer"))
    b = q_pairwise_selection(s, d).select(F.concat(F.lit("c"), F.col("anchor")).alias("id"), F.lit("SELECTION").alias("operator"), "answer")
    return samples.canonical_order(a.unionByName(b), "id", "union")


@query
def q_json_props(s, d):
    k = F.get_json_object("props", "$.k").cast("int")
    return table(s, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("sum_k"), F.min(k).alias("min_k"), F.max(k).alias("max_k"))


def _banded(s, d):
    """part with a class 0 to 3 that follows its size but for every fifth part."""
    return table(s, d, "part").select("p_size", F.when(F.col("p_partkey") % 5 == 0, F.col("p_partkey") % 4).otherwise(F.least(F.lit(3), F.floor(F.col("p_size") / 13))).cast("int").alias("rank"))


@query
def q_class_boundaries(s, d):
    return calibrate.boundaries(_banded(s, d), "p_size", "rank")


@query
def q_monotonicity(s, d):
    return calibrate.monotonicity(_banded(s, d), "p_size", "rank")


@query
def q_search3(s, d):
    return calibrate.best_thresholds(_banded(s, d), "p_size", "rank")


@query
def q_mcq_composite(s, d):
    return choices.composite_choices(table(s, d, "documents"))


@query
def q_audit_mcq(s, d):
    sound = q_mcq_distractors_fixed(s, d)
    # seeded faults: a repeated id, a wrong position, an answer that is no choice
    faulty = sound.unionByName(sound.where("row_id % 100 = 0")).withColumn("position", F.when(F.col("row_id") % 7 == 0, (F.col("position") + 1) % 4).otherwise(F.col("position"))).withColumn("answer", F.when(F.col("row_id") % 11 == 0, F.lit("NOWHERE")).otherwise(F.col("answer")))
    return profile.union_all([choices.audit_choices(x).select(F.lit(n).alias("of"), "*") for n, x in (("sound", sound), ("faulty", faulty))])


@query
def q_leakage(s, d):
    t = F.lower("text")
    n = lambda x: F.coalesce(F.sum(x.cast("long")), F.lit(0).cast("long"))
    return table(s, d, "documents").where("text is not null").groupBy("source").agg(F.count("*").alias("n"), n(F.contains(t, F.lower("source"))).alias("label_leaks"), n(t.rlike(r"(^|\s)(/[a-z]|[a-z]:\\)[^\s]*")).alias("path_leaks"), n(t.rlike(r"https?://")).alias("url_leaks"))
