"""Guardrails, invariants and governance rules as set operations: one row a rule and subject, with its severity or violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .plan import SLOT
from .terms import total

# Severities from harmless to blocking.
SEVERITIES = ("PASS", "REPORT_ONLY", "REVIEW", "AUTO_DROP_ROW", "AUTO_REJECT_TASK", "BLOCKING")
GUARDRAILS = ("SOURCE_SUPPORT", "GOLD_DERIVABILITY", "MODALITY_OBSERVABILITY", "LABEL_INFORMATION", "CAPACITY", "COMPARATOR_COLLISION", "INVARIANCE", "SPLIT_ISOLATION", "NEGATIVE_VALIDITY", "PAIR_VALIDITY", "COMPONENT_VISIBILITY", "TEXT_ONLY_SHORTCUT", "COMPOSITE_REDUNDANCY", "SOURCE_CONSISTENCY", "LANGUAGE_ALIGNMENT")


def severity_rank(c: Column) -> Column:
    """Place of a severity; null for a text that is none."""
    return F.coalesce(*[F.when(c == s, F.lit(i)) for i, s in enumerate(SEVERITIES)])


def worst(c: Column) -> Column:
    """Aggregate: the worst severity of a group; PASS of no rows."""
    return F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), F.coalesce(F.max(severity_rank(c)), F.lit(0)) + 1)


#: Columns of a task's evidence; a null is evidence that was not collected, and passes.
EVIDENCE = "task string, fields array<string>, source_fields array<string>, outputs array<string>, non_observable array<string>, label_severity string, capacity long, min_capacity long, unexpected_collisions long, comparator string, invariances array<string>, reserved_refs long, negative_min long, arity int, pair_capacity long, component_visible boolean, shortcut_risk boolean, composite string, anomaly_severity string, language string"


def guardrails(tasks: DataFrame) -> DataFrame:
    """task, guardrail, severity of all guardrails over rows of ``EVIDENCE``."""
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    c = F.col
    bad = {
        "SOURCE_SUPPORT": F.when(some("fields") & some("source_fields") & (F.size(F.array_except("fields", "source_fields")) > 0), "AUTO_REJECT_TASK"),
        "GOLD_DERIVABILITY": F.when(~some("outputs"), "AUTO_REJECT_TASK"),
        "MODALITY_OBSERVABILITY": F.when(some("fields") & some("non_observable") & F.arrays_overlap("fields", "non_observable"), "AUTO_REJECT_TASK"),
        "LABEL_INFORMATION": c("label_severity"),
        "CAPACITY": F.when(c("capacity") < F.coalesce("min_capacity", F.lit(2)), "AUTO_REJECT_TASK"),
        "COMPARATOR_COLLISION": F.when(c("unexpected_collisions") > 0, "BLOCKING"),
        "INVARIANCE": F.when((c("comparator") != "") & ~some("invariances"), "REVIEW"),
        "SPLIT_ISOLATION": F.when(c("reserved_refs") > 0, "BLOCKING"),
        "NEGATIVE_VALIDITY": F.when(c("negative_min") < 1, "AUTO_REJECT_TASK"),
        "PAIR_VALIDITY": F.when((c("arity") > 1) & (c("pair_capacity") < 1), "AUTO_REJECT_TASK"),
        "COMPONENT_VISIBILITY": F.when(c("component_visible"), "AUTO_REJECT_TASK"),
        "TEXT_ONLY_SHORTCUT": F.when(c("shortcut_risk"), "REVIEW"),
        "COMPOSITE_REDUNDANCY": F.when(c("composite") == "REDUNDANT_COMPOSITE", "AUTO_REJECT_TASK"),
        "SOURCE_CONSISTENCY": c("anomaly_severity"),
        "LANGUAGE_ALIGNMENT": F.when(c("language") == "PREFLIGHT_REVIEW", "REVIEW"),
    }
    told = [F.struct(F.lit(g).alias("guardrail"), F.coalesce(bad[g], F.lit("PASS")).alias("severity")) for g in GUARDRAILS]
    return tasks.select("task", F.explode(F.array(*told)).alias("e")).select("task", "e.*")


def task_verdicts(told: DataFrame) -> DataFrame:
    """task, severity, n_failed: the worst of a task's guardrails and how many don't pass."""
    return told.groupBy("task").agg(worst(F.col("severity")).alias("severity"), total(F.col("severity") != "PASS", "n_failed"))


def violations(name: str, bad: DataFrame) -> DataFrame:
    """invariant, violations: the number of rows that break it."""
    return bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("invariant"), "violations")


def exclusive_partition(everything: DataFrame, parts: DataFrame) -> DataFrame:
    """Keys (key) that stand in no part or several of (key, part), or in a part only."""
    n = parts.distinct().groupBy("key").agg(F.count("*").alias("n"))
    met = everything.select("key").distinct().withColumn("known", F.lit(1)).join(n, "key", "full_outer")
    return met.where("known is null or n is null or n > 1")


def not_monotone(capacities: DataFrame) -> DataFrame:
    """Tasks whose capacity grew by cleaning: (task, raw, clean)."""
    return capacities.where("clean > raw")


def undeclared_space(contracts: DataFrame, tasks: list[str]) -> DataFrame:
    """Contracts (task, concept_space) of the tasks that ask about terms without saying what a term is."""
    return contracts.where(F.col("task").isin(*tasks) & ~F.coalesce(F.col("concept_space").isin("LEXICAL_SURFACE_STRING", "NORMALIZED_KG_CONCEPT"), F.lit(False)))


def over_topology(capacities: DataFrame) -> DataFrame:
    """Unordered-pair capacities (topology, n, capacity) over n (n - 1) / 2."""
    n = F.col("n")
    return capacities.where((F.col("topology") == "UNORDERED_PAIR") & (F.col("capacity") > F.when(n > 1, n * (n - 1) / 2).otherwise(F.lit(0))))


# Names that belong to a plan, not to a contract.
PLAN_FIELDS = ("random_seed", "seed", "target_qa_count", "pos_neg_ratio", "sampling_policy", "max_samples", "budget")


def plan_fields(contract_fields: DataFrame) -> DataFrame:
    """Fields (task, field) of contracts that only a plan may have."""
    return contract_fields.where(F.lower("field").isin(*PLAN_FIELDS))


def over_bounds(plans: DataFrame) -> DataFrame:
    """Plans (task, total, ratio, positive, negative) that ask more of a side than there is."""
    pos = F.when(F.col("ratio") > 0, F.bround(F.col("total") * (F.col("ratio") / (1 + F.col("ratio"))))).otherwise(F.col("total"))
    return plans.where((pos > F.col("positive")) | (F.col("total") - pos > F.col("negative")))


def differing_builds(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows by which two builds differ, one side or the other."""
    return a.exceptAll(b).unionAll(b.exceptAll(a))


def not_conserved(buckets: DataFrame) -> DataFrame:
    """Rows (raw, pos, neg, collision, invalid) with a negative part or whose parts don't sum to the whole."""
    parts = ("pos", "neg", "collision", "invalid")
    return buckets.where(reduce(lambda a, b: a | b, [F.col(p) < 0 for p in parts]) | (reduce(lambda a, b: a + b, map(F.col, parts)) != F.col("raw")))


def formula_differs(formula: DataFrame, listed: DataFrame) -> DataFrame:
    """Keys (key, n) whose count by formula isn't that of the listed instances."""
    met = formula.select("key", F.col("n").alias("f")).join(listed.select("key", F.col("n").alias("l")), "key", "full_outer")
    return met.where(F.coalesce("f", F.lit(0)) != F.coalesce("l", F.lit(0)))


def repeated(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("k")).where("k > 1")


def outside(rows: DataFrame, universe: DataFrame, key: str) -> DataFrame:
    return rows.join(universe.select(key).distinct(), key, "left_anti")


def not_apart(hashes: DataFrame) -> DataFrame:
    """Rows (a, b) of two hashes of which one is empty or that are the same: registries, decisions and what they led to."""
    return hashes.where((F.coalesce("a", F.lit("")) == "") | (F.coalesce("b", F.lit("")) == "") | (F.col("a") == F.col("b")))


# Artefacts that are made from a universe, so a universe can't be made from them.
DERIVED_KINDS = ("HISTORICAL_QA_RELEASE", "HISTORICAL_GENERATION_PLAN", "PRODUCTION_PLAN", "FROZEN_INSTANCE_MANIFEST")


def derived_sources(universes: DataFrame) -> DataFrame:
    return universes.where(F.col("source_kind").isin(*DERIVED_KINDS))


def role_mismatch(contracts: DataFrame) -> DataFrame:
    """Contracts (topology, anchor_type, candidate_type, roles) whose shape lacks what it is about."""
    shows = F.arrays_overlap("roles", F.array(*[F.lit(x) for x in ("candidate_term", "target_text", "candidate_label", "target_value")]))
    t = F.col("topology")
    pair = (t == "UNORDERED_PAIR") & (F.coalesce("anchor_type", F.lit("")) != "audio_segment")
    cart = t.isin("CARTESIAN_PRESENCE", "CARTESIAN_RELATION") & (F.coalesce("candidate_type", F.lit("")) == "") & ~shows
    cond = (t == "TARGET_CONDITIONED_UNORDERED_PAIR") & ~shows
    return contracts.where(pair | cart | cond)


def sum_differs(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Groups (grp) whose counts (n) don't sum to what is expected (expected)."""
    met = counts.groupBy("grp").agg(F.sum("n").alias("s")).join(expected, "grp", "full_outer")
    return met.where(~F.col("s").eqNullSafe(F.col("expected")))


def unbound(bindings: DataFrame) -> DataFrame:
    """Bindings whose four task ids differ, or whose registry hash isn't that of the universe, where both are known."""
    same = (F.col("task") == F.col("contract")) & (F.col("task") == F.col("universe")) & (F.col("task") == F.col("result"))
    off = lambda a, b: F.coalesce((F.col(a) != "") & (F.col(b) != "") & (F.col(a) != F.col(b)), F.lit(False))
    return bindings.where(~F.coalesce(same, F.lit(False)) | off("anchors", "universe_anchors") | off("candidates", "universe_candidates"))


def buckets_differ(buckets: DataFrame, result: DataFrame) -> DataFrame:
    """Candidate buckets (raw, valid, both, neither) that aren't whole, and a result (raw, valid, both, neither) that isn't
    their sum. No buckets: nothing to hold the result against."""
    names = ("raw", "valid", "both", "neither")
    broken = buckets.where("raw <> valid + both + neither").select(F.lit(1).alias("x"))
    sums = buckets.agg(F.count("*").alias("k"), *[F.sum(n).alias(f"s_{n}") for n in names]).where("k > 0")
    off = reduce(lambda a, b: a | b, [F.col(n) != F.col(f"s_{n}") for n in names])
    return broken.unionAll(result.join(F.broadcast(sums)).where(off).select(F.lit(1).alias("x")))


def round_closure(rounds: DataFrame) -> DataFrame:
    """Rounds whose generated types aren't the accepted, duplicate, rejected and dropped ones together."""
    return rounds.where(F.col("generated") != F.col("accepted") + F.col("duplicate") + F.col("rejected") + F.col("dropped"))


def summaries(matrix: DataFrame, issues: DataFrame, key: str) -> DataFrame:
    """key, n, blocking, n_issues of every key of the matrix (key, ok), with the issues (key) counted beside it."""
    per = issues.groupBy(key).agg(F.count("*").alias("c"))
    return matrix.groupBy(key).agg(F.count("*").alias("n"), total(~F.col("ok"), "blocking")).join(per, key, "left").select(key, "n", "blocking", F.coalesce("c", F.lit(0)).alias("n_issues"))


def label_pairs(text: str) -> Column:
    """Number and label pairs of a description, such as ``0 = female, 1: male``, as an array of ``number=label``."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"(\d+)\s*[=:]\s*([A-Za-z]+)"), 0)
    return F.transform(found, lambda x: F.concat(F.regexp_extract(x, r"^(\d+)", 1), F.lit("="), F.lower(F.regexp_extract(x, r"([A-Za-z]+)$", 1))))


def effective_binding(approved: DataFrame, candidate: DataFrame, key: str, value: str) -> DataFrame:
    """key, value, origin: what was approved before wins over a new candidate."""
    a, c = approved.select(key, F.col(value).alias("_a")), candidate.select(key, F.col(value).alias("_c"))
    return a.join(c, key, "full_outer").select(key, F.coalesce("_a", "_c").alias(value), F.when(F.col("_a").isNotNull(), "approved").otherwise("candidate").alias("origin"))


def composite_kind(rows: DataFrame) -> DataFrame:
    """id, uncovered, new_joint, kind of composites (id, requested, covered, joint): a bundle of what other types give already, one
    with a relation of its own, or undecided."""
    uncovered, joint = F.size(F.array_except("requested", "covered")), F.size(F.array_except("joint", "covered"))
    kind = F.when((uncovered == 0) & (joint == 0), "REDUNDANT_COMPOSITE").when(joint > 0, "POTENTIAL_JOINT_RELATION").otherwise("REVIEW_REQUIRED")
    return rows.select("id", uncovered.alias("uncovered"), joint.alias("new_joint"), kind.alias("kind"))


def metadata_kind(rows: DataFrame, sensitive: tuple[str, ...] = ("gender", "sex", "age", "ethnicity")) -> DataFrame:
    """field, status of metadata fields (field, documented, in_schema, in_rows, needs_audio, consistent)."""
    risky = F.lower("field").isin(*sensitive)
    status = F.when(~F.col("in_schema") | ~F.col("in_rows"), "SOURCE_FIELD_NOT_PRESENT").when(~F.col("documented"), "SOURCE_METADATA_AMBIGUOUS").when(F.col("needs_audio") & risky, "POLICY_INAPPROPRIATE_AS_MODEL_TARGET").when(~F.col("consistent"), "SOURCE_ANNOTATION_INCONSISTENT").when(F.col("needs_audio"), "REVIEW_REQUIRED").otherwise("SOURCE_METADATA_VALID_MODEL_TARGET_REJECTED")
    return rows.select("field", status.alias("status"))


def preflight(entries: DataFrame, accepted: DataFrame) -> DataFrame:
    """type_id, issues of entries (type_id, templates, answer_format): unknown type, no templates, open slots, field names in the
    text, no answer format. [TARGET_VALUE] and [CONTEXT:..] are no open slots."""
    bare = F.transform(F.coalesce("templates", F.array().cast("array<string>")), lambda t: F.regexp_replace(t, r"\[(TARGET_VALUE|CONTEXT:[^\]]*)\]", " "))
    met = entries.join(accepted.select("type_id").distinct().withColumn("known", F.lit(1)), "type_id", "left")
    issues = F.array_compact(F.array(F.when(F.col("known").isNull(), "UNKNOWN_TYPE_ID"), F.when(F.size(bare) == 0, "NO_TEMPLATES"), F.when(F.exists(bare, lambda t: t.rlike(SLOT)), "UNRESOLVED_SLOT"), F.when(F.exists(bare, lambda t: t.rlike(r"\b[a-z]+_[a-z_]+\b")), "SNAKE_CASE_LEAK"), F.when(F.coalesce("answer_format", F.lit("")) == "", "NO_ANSWER_FORMAT")))
    return met.select("type_id", F.array_join(issues, ";").alias("issues"))


def template_faults(text: str) -> Column:
    """What is wrong with a template's places: empty, the answer itself, a context without a field, an unknown place."""
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"\[([A-Z]+(?::[^\]]*)?)\]"), 1)))
    each = F.transform(found, lambda p: F.when(p == "CONTEXT:", F.lit("invalid_context_placeholder")).when((p != "KEY") & ~F.startswith(p, F.lit("CONTEXT:")), F.concat(F.lit("unknown_placeholder:"), p)))
    return F.when(F.trim(F.coalesce(F.col(text), F.lit(""))) == "", "empty_template").when(F.array_contains(found, "VALUE"), "answer_leakage").otherwise(F.array_join(F.array_compact(each), ";"))


def allowed_operators(items: DataFrame, key: str, operator: str, allowed: tuple[str, ...]) -> DataFrame:
    """key, accepted, reason: items whose operator the policy allows."""
    op = F.col(operator)
    reason = F.when(op.isNull() | (F.trim(op) == ""), "OPERATOR_MISSING").when(~op.isin(*allowed), F.concat(F.lit("OPERATOR_NOT_ALLOWED:"), op))
    return items.select(key, reason.isNull().alias("accepted"), reason.alias("reason"))


def evaluation_eligible(types: DataFrame, policies: DataFrame) -> DataFrame:
    """type_id of types (type_id, fields) all of whose fields are known and may be evaluated: policies (field, evaluate)."""
    each = types.select("type_id", F.explode("fields").alias("field")).join(policies, "field", "left")
    bad = each.where(~F.coalesce(F.col("evaluate"), F.lit(False))).select("type_id").distinct()
    return types.select("type_id").join(bad, "type_id", "left_anti")
