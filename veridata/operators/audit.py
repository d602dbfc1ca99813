"""Audits of question records: named checks a record, label and position balance, use of wordings, targets and rows, leaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_column
from .plan import RULES, SLOT
from .terms import total

# The names of the checks, in report order.
CHECKS = ("KNOWN_TYPE", "TYPE_SUPPORTED", "TYPE_FULL_TRAIN_CAPACITY_SUFFICIENT", "KNOWN_LANGUAGE_ENTRY", "LANGUAGE_ENTRY_ACTIVE", "LANGUAGE_COMPATIBLE", "OPERATOR_MATCH", "SEMANTIC_CLASS_MATCH", "ANSWER_KIND_MATCH", "AUDIO_COUNT_MATCH", "NO_UNRESOLVED_SLOT", "TARGET_ALLOWED", "GOLD_DETERMINISTIC", "NEGATIVE_TARGET_IS_NEGATIVE", "EQUALITY_RELATION_CORRECT", "PAIRWISE_SELECTION_XOR", "NO_IDENTICAL_AUDIO_PAIR", "NO_HIDDEN_IDENTIFIER_LEAK", "NO_FILENAME_LEAK", "NO_PROVENANCE_LEAK", "NO_VISIBLE_GOLD_LEAK", "SEMANTIC_INSTANCE_UNIQUE", "QA_ID_UNIQUE", "SCHEMA_VALID", "ANSWER_WITHOUT_AUDIO")
# Texts that name where a row comes from.
PROVENANCE = (".wav", ".parquet", "_shard", "speakerid", "province_code", "filename", "sample_id", "train-")


def folded(c: Column | str) -> Column:
    """Text for leak searches: lower case, spaces collapsed; null is empty. Leaks are looked for in lower case, which stays in
    the JVM, and in the tables' scripts finds what full folding finds."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(as_column(c).cast("string"), F.lit(""))), r"(?U)\s+", " "))


def _inside(question: Column, values: Column, keep: Column | None = None) -> Column:
    """Whether any of the values stands in the question; with ``keep``, a value whose key is that one may."""
    allowed = lambda v: F.lit(False) if keep is None else folded(v).eqNullSafe(folded(keep))
    hit = lambda v: (folded(v) != "") & F.contains(question, folded(v)) & ~allowed(v)
    return F.coalesce(F.exists(values, hit), F.lit(False))


def record_checks(records: DataFrame, contracts: DataFrame, bank: DataFrame, compatible: DataFrame, capacity: DataFrame) -> DataFrame:
    """qa_id, failed: the checks that each record fails. ``compatible``: (type_id, entry_id) that go together; ``capacity``:
    (type_id, sufficient). An unknown type fails that check alone, and uniqueness."""
    c = contracts.select("type_id", F.col("operator").alias("c_operator"), "arity", "shows_target", "supported", "semantic_class", F.col("answer_kind").alias("c_answer"))
    w = bank.select("entry_id", "w_operator", "w_class", "w_answer", "enabled")
    met = records.join(F.broadcast(c), "type_id", "left").join(F.broadcast(w), "entry_id", "left")
    met = met.join(F.broadcast(compatible.select("type_id", "entry_id").distinct().withColumn("goes", F.lit(True))), ["type_id", "entry_id"], "left").join(F.broadcast(capacity.select("type_id", "sufficient")), "type_id", "left")
    for name in ("qa_id", "semantic_id"):
        again = records.groupBy(name).agg(F.count("*").alias("k")).where("k > 1").select(name, F.lit(True).alias(f"{name}_again"))
        met = met.join(again, name, "left")
    op, q = F.col("c_operator"), folded("question")
    v = lambda i: F.get(F.col("hidden_values"), F.lit(i))
    key = folded
    no = lambda x: ~F.coalesce(x, F.lit(False))
    gold, target = F.col("gold"), F.col("target")
    match = [key(v(i)) == key(target) for i in (0, 1)]
    one = F.coalesce(match[0], F.lit(False)) != F.coalesce(match[1], F.lit(False))
    known, wording = op.isNotNull(), F.col("w_operator").isNotNull()
    right = (
        F.when(op == "DIRECT", gold.eqNullSafe(v(0)))
        .when(op == "EQUALITY", (gold == "true").eqNullSafe(key(v(0)) == key(v(1))))
        .when(op == "TARGET_MATCH", (gold == "true").eqNullSafe(key(v(0)) == key(target)))
        .when(op == "PAIRWISE_SELECTION", one & gold.eqNullSafe(F.when(match[0], "A").otherwise("B")))
    )
    shown = F.col("shown_target")
    bad_target = F.when(F.col("shows_target"), shown.isNull() | ~F.contains(q, folded(shown))).otherwise(shown.isNotNull())
    hides = op.isin("DIRECT", "EQUALITY")
    leak = F.when(hides, _inside(q, F.col("hidden_values"))).otherwise(_inside(q, F.col("hidden_values"), target))
    null = [F.col(n).isNull() for n in ("qa_id", "semantic_id", "operator", "question", "gold", "row_ids", "audio_ids", "hidden_values")]
    missing = null[0]
    for x in null[1:]:
        missing = missing | x
    fails = {
        "TYPE_SUPPORTED": no(F.col("supported")),
        "TYPE_FULL_TRAIN_CAPACITY_SUFFICIENT": no(F.col("sufficient")),
        "KNOWN_LANGUAGE_ENTRY": ~wording,
        "LANGUAGE_ENTRY_ACTIVE": wording & no(F.col("enabled")),
        "LANGUAGE_COMPATIBLE": wording & F.col("goes").isNull(),
        "OPERATOR_MATCH": wording & (F.col("w_operator") != op),
        "SEMANTIC_CLASS_MATCH": wording & (F.col("w_class") != F.col("semantic_class")),
        "ANSWER_KIND_MATCH": wording & (F.col("w_answer") != F.col("c_answer")),
        "AUDIO_COUNT_MATCH": no(F.size("audio_ids") == F.col("arity")),
        "NO_UNRESOLVED_SLOT": F.coalesce(F.col("question").rlike(SLOT), F.lit(False)),
        "TARGET_ALLOWED": bad_target,
        "GOLD_DETERMINISTIC": no(right),
        "NEGATIVE_TARGET_IS_NEGATIVE": (op == "TARGET_MATCH") & (gold == "false") & (target.isNull() | match[0]),
        "EQUALITY_RELATION_CORRECT": (op == "EQUALITY") & ~(gold == "true").eqNullSafe(key(v(0)) == key(v(1))),
        "PAIRWISE_SELECTION_XOR": (op == "PAIRWISE_SELECTION") & ~one,
        "NO_IDENTICAL_AUDIO_PAIR": F.size(F.array_distinct("audio_ids")) < F.size("audio_ids"),
        "NO_HIDDEN_IDENTIFIER_LEAK": _inside(q, F.col("hidden_ids")),
        "NO_FILENAME_LEAK": F.coalesce(F.col("question").rlike(r"(?i)\b[\w-]+\.wav\b"), F.lit(False)) | _inside(q, F.col("row_ids")),
        "NO_PROVENANCE_LEAK": F.coalesce(F.exists(F.array(*[F.lit(p) for p in PROVENANCE]), lambda p: F.contains(q, p)), F.lit(False)),
        "NO_VISIBLE_GOLD_LEAK": leak,
        "ANSWER_WITHOUT_AUDIO": leak,
        "SCHEMA_VALID": missing,
    }
    told = [F.when(~known, "KNOWN_TYPE"), *[F.when(known & F.coalesce(x, F.lit(False)), n) for n, x in fails.items()], F.when(F.col("qa_id_again"), "QA_ID_UNIQUE"), F.when(F.col("semantic_id_again"), "SEMANTIC_INSTANCE_UNIQUE")]
    return met.select("qa_id", F.array_sort(F.array_compact(F.array(*told))).alias("failed"))


def check_counts(checked: DataFrame) -> DataFrame:
    """check, n_pass, n_fail over all records; one pass."""
    n = F.count(F.lit(1))
    bad = [F.coalesce(F.sum(F.array_contains("failed", x).cast("long")), F.lit(0).cast("long")).alias(f"x{i}") for i, x in enumerate(CHECKS)]
    told = checked.agg(n.alias("n"), *bad)
    return told.select(F.explode(F.array(*[F.struct(F.lit(x).alias("check"), (F.col("n") - F.col(f"x{i}")).alias("n_pass"), F.col(f"x{i}").alias("n_fail")) for i, x in enumerate(CHECKS)])).alias("e")).select("e.*")


def label_ratio(records: DataFrame, ratio: float) -> DataFrame:
    """Per type with a boolean answer: true and false records, the true share, and whether it is the set one but for one record."""
    per = records.where(F.col("operator").isin("EQUALITY", "TARGET_MATCH")).groupBy("type_id").agg(total(F.col("gold") == "true", "positive"), total(~(F.col("gold") == "true"), "negative"))
    n = F.col("positive") + F.col("negative")
    share = F.col("positive") / n
    return per.select("type_id", "positive", "negative", F.round(share, 6).alias("ratio"), (F.abs(share - ratio) <= 1 / n + 1e-9).alias("within"))


def position_bias(records: DataFrame) -> DataFrame:
    """Per selection type: answers A and B, and whether one side of two records or more is empty."""
    per = records.where("operator = 'PAIRWISE_SELECTION'").groupBy("type_id").agg(total(F.col("gold") == "A", "gold_a"), total(~(F.col("gold") == "A"), "gold_b"))
    return per.withColumn("severe_bias", (F.col("gold_a") + F.col("gold_b") >= 2) & (F.least("gold_a", "gold_b") == 0))


def wording_usage(records: DataFrame, bank: DataFrame) -> DataFrame:
    """entry_id, kind, n of every wording of the bank, unused ones too."""
    used = records.groupBy("entry_id").agg(F.count("*").alias("c"))
    return bank.select("entry_id", "kind").join(used, "entry_id", "left").select("entry_id", "kind", F.coalesce("c", F.lit(0)).alias("n"))


def target_frequency(records: DataFrame) -> DataFrame:
    """type_id, target, n of the types that show a target."""
    return records.where(F.col("operator").isin(*[o for o, r in RULES.items() if r[2]])).groupBy("type_id", F.coalesce("shown_target", F.lit("None")).alias("target")).agg(F.count("*").alias("n"))


def type_reuse(records: DataFrame) -> DataFrame:
    """type_id, references, distinct source rows."""
    return records.select("type_id", F.explode("row_ids").alias("r")).groupBy("type_id").agg(F.count("*").alias("n_refs"), F.countDistinct("r").alias("n_rows"))


def model_leaks(model: DataFrame, tokens: tuple[str, ...] = PROVENANCE) -> DataFrame:
    """One row over model records (question, answer, audio): texts that name a source field, and absolute paths."""
    text = F.lower(F.concat_ws(" ", "question", "answer", F.array_join("audio", " ")))
    path = text.rlike(r"(^|[\s\"'])(/[a-z0-9_]+/|[a-z]:\\)")
    return model.agg(F.count("*").alias("n"), total(F.exists(F.array(*[F.lit(t) for t in tokens]), lambda t: F.contains(text, t)), "token_leaks"), total(path, "path_leaks"))


def release_arity(model: DataFrame, pairs: tuple[str, ...], singles: tuple[str, ...], beep: str) -> DataFrame:
    """fault, n of a release's model records: audio counts by type, pair questions without the pair's wording, other types."""
    pair, single, n = F.col("type_id").isin(*pairs), F.col("type_id").isin(*singles), F.size("audio")
    faults = F.array_compact(F.array(F.when(pair & (n != 2), "PAIR_REQUIRES_TWO_AUDIO"), F.when(pair & ~F.contains("question", F.lit(beep)), "PAIR_REQUIRES_WORDING"), F.when(single & (n != 1), "SINGLE_REQUIRES_ONE_AUDIO"), F.when(~pair & ~single, "INACTIVE_TYPE")))
    return model.select(F.explode(faults).alias("fault")).groupBy("fault").agg(F.count("*").alias("n"))


def anchor_plan(pairs: DataFrame, groups: DataFrame, same: int, different: int) -> DataFrame:
    """One row over pairs (a, b, same) of rows (row_id, grp): anchors, pairs of either side, anchors with other numbers, pairs
    of a row with itself, unordered pairs that occur twice, and sides that the groups don't bear out."""
    g = groups.select(F.col("row_id").alias("a"), F.col("grp").alias("ga"))
    h = groups.select(F.col("row_id").alias("b"), F.col("grp").alias("gb"))
    both = pairs.join(g, "a", "left").join(h, "b", "left")
    per = pairs.groupBy("a").agg(total(F.col("same"), "s"), total(~F.col("same"), "d")).agg(F.count("*").alias("anchors"), total((F.col("s") != same) | (F.col("d") != different), "anchors_off"))
    twice = pairs.groupBy(F.least("a", "b"), F.greatest("a", "b")).agg(F.count("*").alias("k")).agg(total(F.col("k") > 1, "repeated"))
    told = both.agg(F.count("*").alias("n"), total(F.col("same"), "n_same"), total(~F.col("same"), "n_different"), total(F.col("a") == F.col("b"), "self_pairs"), total(~(F.col("ga") == F.col("gb")).eqNullSafe(F.col("same")), "wrong_gold"))
    return told.join(F.broadcast(per)).join(F.broadcast(twice))


def split_isolation(pairs: DataFrame, splits: DataFrame, split: str) -> DataFrame:
    """One row: references of a plan's rows outside the split, and rows that have none."""
    refs = pairs.select(F.explode(F.array("a", "b")).alias("row_id")).join(splits, "row_id", "left")
    return refs.agg(F.count("*").alias("n_refs"), total(F.col("split").isNotNull() & (F.col("split") != split), "outside"), total(F.col("split").isNull(), "unknown"))


def text_shortcut(records: DataFrame, positive: str = "true", threshold: float = 0.6) -> DataFrame:
    """Per type: how often a rule that sees only the text (true where a hidden value stands in the question) is right, the
    share of the most common answer, and whether either is a shortcut."""
    seen = _inside(folded("question"), F.col("hidden_values"))
    said = F.when(seen, F.lit(positive)).otherwise(F.lit("other"))
    gold = F.when(F.col("gold") == positive, F.lit(positive)).otherwise(F.lit("other"))
    rows = records.select("type_id", gold.alias("gold"), (said == gold).alias("hit"))
    per = rows.groupBy("type_id").agg(F.count("*").alias("n"), F.sum(F.col("hit").cast("long")).alias("hits"), F.sum((F.col("gold") == positive).cast("long")).alias("yes"))
    base, copy = F.greatest("yes", F.col("n") - F.col("yes")) / F.col("n"), F.col("hits") / F.col("n")
    return per.select("type_id", "n", F.round(base, 4).alias("base_rate"), F.round(copy, 4).alias("copy_accuracy"), F.when(copy >= threshold, "COPY_VISIBLE_FIELD").when(base >= threshold, "BASE_RATE_PRIOR").alias("risk"))


def component_visibility(records: DataFrame) -> DataFrame:
    """Per type: records, and those whose answer stands in the question as it is, or folded."""
    a = F.col("gold").cast("string")
    return records.groupBy("type_id").agg(F.count("*").alias("n"), total((a != "") & F.contains("question", a), "exposed_raw"), total((folded(a) != "") & F.contains(folded("question"), folded(a)), "exposed"))


def repeated_token(sentence: Column | str, token: Column | str, ordinal: Column, question: Column | str) -> Column:
    """Whether a token that occurs twice in its sentence is asked about without telling which one."""
    words = F.transform(F.split(F.lower(as_column(sentence)), r"\s+"), lambda w: F.regexp_replace(w, r"""^[,.?!:;"'()]+|[,.?!:;"'()]+$""", ""))
    n = F.size(F.filter(words, lambda w: w == F.lower(F.trim(as_column(token)))))
    told = ordinal.isNotNull() & F.contains(as_column(question), ordinal.cast("string"))
    return F.coalesce((n >= 2) & ~F.coalesce(told, F.lit(False)), F.lit(False))
