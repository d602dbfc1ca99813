"""From contracts to records: question types over a source's fields, their instances, wordings, questions and answers.

A source is a frame of rows with a key, the fields asked about and a hidden identifier. All choices are by hashes of keys, so
a plan is the same whenever and wherever it is built. Contracts, fields and wordings are small tables held on the driver.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import digest, hash_int
from ..functions.places import strata_for
from ..functions.text import as_column, canonical_json, collapse, split_key
from .pairs import circle, circular_next, direct_round_robin, selection, target_match

OPERATORS = ("DIRECT", "EQUALITY", "TARGET_MATCH", "PAIRWISE_SELECTION")
#: By operator: rows a question is about, the answer's kind, whether the question shows a target.
RULES = {"DIRECT": (1, "field_value", False), "EQUALITY": (2, "boolean", False), "TARGET_MATCH": (1, "boolean", True), "PAIRWISE_SELECTION": (2, "audio_index", True)}


@dataclass(frozen=True)
class Field:
    name: str
    semantic_class: str
    entity: str
    attribute: str
    unit: str = ""
    match_policy: str = "exact"
    quotes: bool = False
    supported: bool = True


@dataclass(frozen=True)
class Contract:
    type_id: str
    operator: str
    field: str
    supported: bool = True

    @property
    def arity(self) -> int:
        return RULES[self.operator][0]

    @property
    def answer_kind(self) -> str:
        return RULES[self.operator][1]


@dataclass(frozen=True)
class Wording:
    entry_id: str
    operator: str
    semantic_class: str
    pattern: str
    kind: str = "CANONICAL"
    enabled: bool = True
    unit_policy: str = "optional"
    match_policies: tuple[str, ...] = ("exact",)
    answer_kind: str = ""

    @property
    def answers(self) -> str:
        return self.answer_kind or RULES[self.operator][1]


def bank_hash(bank: list[Wording]) -> str:
    return hashlib.sha256(json.dumps([asdict(w) for w in sorted(bank, key=lambda w: w.entry_id)], sort_keys=True).encode()).hexdigest()[:16]


def contract_frame(spark: SparkSession, contracts: list[Contract], fields: list[Field]) -> DataFrame:
    by = {f.name: f for f in fields}
    rows = [(c.type_id, c.operator, c.field, c.arity, c.answer_kind, RULES[c.operator][2], c.supported and by[c.field].supported, by[c.field].semantic_class, by[c.field].entity, by[c.field].attribute, by[c.field].unit, by[c.field].match_policy, by[c.field].quotes) for c in contracts]
    return spark.createDataFrame(rows, "type_id string, operator string, field string, arity int, answer_kind string, shows_target boolean, supported boolean, semantic_class string, entity string, attribute string, unit string, match_policy string, quotes boolean")


def bank_frame(spark: SparkSession, bank: list[Wording]) -> DataFrame:
    rows = [(w.entry_id, w.operator, w.semantic_class, w.pattern, w.kind, w.enabled, w.unit_policy, list(w.match_policies), w.answers) for w in bank]
    return spark.createDataFrame(rows, "entry_id string, w_operator string, w_class string, pattern string, kind string, enabled boolean, unit_policy string, policies array<string>, w_answer string")


def tidy(c: Column | str) -> Column:
    """Spaces collapsed, none before punctuation, the first letter a capital."""
    text = F.regexp_replace(collapse(c), r"\s+([,.;:?!])", "$1")
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, F.lit(2), F.length(text)))


def compatible(contracts: DataFrame, bank: DataFrame) -> DataFrame:
    """Every contract with every wording of its operator or class: why they don't go together, in order, and the question
    pattern where they do, its slots filled but the target's."""
    met = contracts.join(F.broadcast(bank), (F.col("operator") == F.col("w_operator")) | (F.col("semantic_class") == F.col("w_class")))
    has = lambda slot: F.contains("pattern", F.lit(slot))
    reasons = F.array_compact(F.array(
        F.when(F.col("operator") != F.col("w_operator"), "OPERATOR_MISMATCH"),
        F.when(F.col("semantic_class") != F.col("w_class"), "SEMANTIC_CLASS_MISMATCH"),
        F.when(F.col("answer_kind") != F.col("w_answer"), "ANSWER_KIND_MISMATCH"),
        F.when(~F.col("supported"), "SEMANTIC_FIELD_NOT_SUPPORTED"),
        F.when(~F.array_contains("policies", F.col("match_policy")), "MATCH_POLICY_UNSUPPORTED"),
        F.when((F.col("unit_policy") == "required") & (F.col("unit") == ""), "UNIT_REQUIRED"),
        F.when((F.col("unit_policy") == "forbidden") & (F.col("unit") != ""), "UNIT_MUST_BE_ABSENT"),
        F.when(has("[UNIT]") & (F.col("unit") == ""), "REQUIRED_SLOT_MISSING"),
        F.when(F.col("shows_target") != has("[TARGET_VALUE]"), "TARGET_SLOT_MISMATCH"),
        F.when(~F.col("enabled"), "WORDING_DISABLED"),
    ))
    filled = F.col("pattern")
    for slot, c in (("[ENTITY]", "entity"), ("[ATTRIBUTE]", "attribute"), ("[UNIT]", "unit")):
        filled = F.replace(filled, F.lit(slot), F.col(c))
    return met.select("type_id", "entry_id", "kind", "quotes", F.array_join(reasons, ";").alias("reasons"), F.when(F.size(reasons) == 0, tidy(filled)).alias("question"))


def numbered_wordings(met: DataFrame) -> DataFrame:
    """The compatible wordings of each type with their number in the order of entry ids, and how many there are."""
    good = met.where("reasons = ''")
    w = Window.partitionBy("type_id")  # a bank's wordings
    return good.select("*", (F.row_number().over(w.orderBy("entry_id")) - 1).alias("choice"), F.count("*").over(w).alias("n_choices"))


def positive_count(total: int, ratio: float | None) -> int:
    """Positive instances of a total: half, rounded up, or the ratio's share, half to even."""
    return (total + 1) // 2 if ratio is None else round(total * ratio)


def equality_positive(rows: DataFrame, key: str, group: str, hidden: str, total: int, ring: DataFrame | None = None) -> DataFrame:
    """a, b of ``total`` pairs inside a group, no unordered pair twice: of a row's next three in the group's circle the first
    of another hidden identifier, the next one if there is none. Groups of under seven rows only use the next one, those of
    two their only pair."""
    c = (circle(rows, key, group) if ring is None else ring).join(rows.select(F.col(key).alias("row_id"), F.col(hidden).alias("who")), "row_id").where("m > 1")
    steps = F.when(F.col("m") >= 7, F.array(*[F.lit(i) for i in (1, 2, 3)])).otherwise(F.array(F.lit(1)))
    asks = c.where("m > 2 or place = 0").select(F.col("row_id").alias("a"), F.col("who").alias("wa"), "h", "grp", F.col("m"), F.col("place").alias("p"), F.explode(steps).alias("step"))
    asks = asks.withColumn("place", F.pmod(F.col("p") + F.col("step"), "m"))
    met = asks.join(c.select("grp", "place", F.col("row_id").alias("b"), F.col("who").alias("wb")), ["grp", "place"])
    other = ~F.col("wa").eqNullSafe(F.col("wb"))
    best = met.groupBy("a", "h").agg(F.min(F.struct((~other).alias("same"), F.col("step"), F.col("b"))).alias("f"))
    return best.orderBy("h", "a").limit(total).select("a", F.col("f.b").alias("b"))


def equality_negative(rows: DataFrame, key: str, group: str, total: int, ring: DataFrame | None = None) -> DataFrame:
    """a, b of ``total`` pairs of two groups, no unordered pair twice: a largest group ahead in the circle of all groups.
    None where one group holds half the rows or more."""
    c = circle(rows, key, group) if ring is None else ring
    ok = c.where(2 * F.col("largest") < F.col("n")).orderBy("h", "row_id").limit(total)
    asks = ok.select(F.col("row_id").alias("a"), F.pmod(F.col("first") + F.col("place") + F.col("largest"), "n").alias("at"))
    return asks.join(c.select((F.col("first") + F.col("place")).alias("at"), F.col("row_id").alias("b")), "at").select("a", "b")


def instances(rows: DataFrame, key: str, hidden: str, contract: Contract, total: int, ratio: float | None = None, strata: int | None = None, ring: DataFrame | None = None) -> DataFrame:
    """type_id, row_ids, target, gold of up to ``total`` instances of one contract; ``shortfall`` tells what is missing. ``ring``:
    the circle of the field's groups, which the types of one field share."""
    f = contract.field
    rows = rows.where(F.col(f).isNotNull())
    text = lambda c: as_column(c).cast("string")
    none = F.lit(None).cast("string")
    yes = positive_count(total, ratio)
    if contract.operator == "DIRECT":
        got = direct_round_robin(rows, key, f, total, strata).select(F.array(text("row_id")).alias("row_ids"), none.alias("target"), text("value").alias("gold"))
    elif contract.operator == "EQUALITY":
        pos = equality_positive(rows, key, f, hidden, yes, ring).withColumn("gold", F.lit("true"))
        neg = equality_negative(rows, key, f, total - yes, ring).withColumn("gold", F.lit("false"))
        got = pos.unionByName(neg).select(F.array(text("a"), text("b")).alias("row_ids"), none.alias("target"), "gold")
    elif contract.operator == "TARGET_MATCH":
        met = target_match(rows, key, f, strata=strata).withColumn("h", digest(F.lit("match"), "row_id")).orderBy("h", "row_id").limit(total)
        at = F.row_number().over(Window.orderBy("h", "row_id"))  # ``total`` rows
        met = met.withColumn("yes", at <= yes)
        got = met.select(F.array(text("row_id")).alias("row_ids"), F.when(F.col("yes"), F.col("positive")).otherwise(F.col("negative")).alias("target"), F.when(F.col("yes"), "true").otherwise("false").alias("gold"))
    else:
        met = selection(rows, key, f, ring).orderBy(digest(F.lit("select"), "anchor"), "anchor").limit(total)
        met = met.join(rows.select(F.col(key).alias("anchor"), text(f).alias("target")), "anchor")
        got = met.select(F.array(text("row_a"), text("row_b")).alias("row_ids"), "target", F.col("answer").alias("gold"))
    return got.select(F.lit(contract.type_id).alias("type_id"), F.lit(contract.operator).alias("operator"), F.lit(f).alias("field"), "row_ids", "target", "gold")


def alternating(rows: DataFrame, key: str, field: str, total: int) -> DataFrame:
    """row_id, target, gold, side of the first ``total`` rows in hash order: their own value and another one in turn, and the
    sides A and B in turn by pairs of rows, so that neither follows from the other."""
    met = target_match(rows, key, field).withColumn("h", digest(F.lit("indexed"), "row_id")).orderBy("h", "row_id").limit(total)
    i = F.row_number().over(Window.orderBy("h", "row_id")) - 1  # ``total`` rows
    met = met.withColumn("i", i).withColumn("gold", F.col("i") % 2 == 0)
    return met.select("row_id", F.when(F.col("gold"), F.col("positive")).otherwise(F.col("negative")).alias("target"), "gold", F.when(F.floor(F.col("i") / 2) % 2 == 0, "A").otherwise("B").alias("side"))


def preview_pairs(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """same, equal, a, b: of pairs (a, b, same) of one or of two speakers the first by hash whose rows' values (row_id, value) are
    equal, and the first whose are not."""
    v = lambda side: values.select(F.col("row_id").alias(side), F.col("value").alias(f"v{side}"))
    met = pairs.select("a", "b", "same").join(v("a"), "a").join(v("b"), "b").withColumn("equal", F.col("va").eqNullSafe(F.col("vb")))
    first = met.groupBy("same", "equal").agg(F.min(F.struct(digest(F.lit("preview"), "a", "b").alias("h"), F.col("a"), F.col("b"))).alias("f"))
    return first.select("same", "equal", "f.a", "f.b")


def external_split(rows: DataFrame, key: str, text: str, reference: str) -> DataFrame:
    """type, row_ids, gold of a split that has no contracts: every text to be transcribed, whether it matches its reference,
    pairs of equal texts, as many pairs of unequal ones as make up the number of rows (none are left out silently: fewer
    only if one text is half of all), and each row beside the next one, by side. Rows without a text give none."""
    norm = lambda c: F.sha2(split_key(c), 256)
    held = rows.where(F.col(text).isNotNull()).select(F.col(key).alias("id"), norm(text).alias("g"), (norm(text) == norm(F.coalesce(F.col(reference), F.lit("")))).alias("match"), F.lit(1).alias("one"))
    n = held.count()
    same = equality_positive(held, "id", "g", "id", n)
    other = equality_negative(held, "id", "g", max(0, n - same.count()))
    ids = lambda *c: F.array(*[F.col(x).cast("string") for x in c])
    row = lambda df, kind, cols, gold: df.select(F.lit(kind).alias("type"), ids(*cols).alias("row_ids"), gold.cast("string").alias("gold"))
    after = circular_next(held, "id", "one").withColumn("first", hash_int(F.lit("next"), "row_id") % 2 == 0)
    beside = after.select(F.when(F.col("first"), F.col("row_id")).otherwise(F.col("next")).alias("a"), F.when(F.col("first"), F.col("next")).otherwise(F.col("row_id")).alias("b"), F.when(F.col("first"), "A").otherwise("B").alias("gold"))
    parts = [row(held, "TRANSCRIBE", ["id"], F.col("g")), row(held, "REFERENCE_MATCH", ["id"], F.col("match")), row(same, "PAIR_EQUALITY", ["a", "b"], F.lit(True)), row(other, "PAIR_EQUALITY", ["a", "b"], F.lit(False)), row(beside, "SELECTION", ["a", "b"], F.col("gold"))]
    return reduce(DataFrame.unionByName, parts)


def semantic_id(dataset: str, revision: str) -> Column:
    """Id of an instance by what it asks: its type, rows in order, target and gold."""
    payload = canonical_json(dataset=F.lit(dataset), gold="gold", revision=F.lit(revision), rows="row_ids", target="target", type="type_id")
    return F.concat(F.lit("sem_"), F.substring(F.sha2(payload, 256), 1, 20))


def build_plan(rows: DataFrame, key: str, hidden: str, contracts: list[Contract], budgets: dict[str, int], wordings: DataFrame, bank: str, dataset: str, revision: str, ratio: float | None = None, seed: int = 42) -> DataFrame:
    """The instances of all contracts, each once, with audio ids and a wording chosen by hash among the type's."""
    strata = strata_for(rows)
    rings = {f: circle(rows.where(F.col(f).isNotNull()), key, f, strata) for f in sorted({c.field for c in contracts if budgets.get(c.type_id)})}
    parts = [instances(rows, key, hidden, c, budgets[c.type_id], ratio, strata, rings[c.field]) for c in sorted(contracts, key=lambda c: c.type_id) if budgets.get(c.type_id)]
    drafts = reduce(DataFrame.unionByName, parts).withColumn("semantic_id", semantic_id(dataset, revision)).dropDuplicates(["semantic_id"])
    ids = F.transform("row_ids", lambda r: F.concat(F.lit("audio_"), F.substring(F.sha2(F.concat_ws("|", F.lit(dataset), F.lit(revision), r), 256), 1, 20)))
    spot = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col("semantic_id"), F.lit(bank)), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    sizes = wordings.select("type_id", "n_choices").distinct()
    asks = drafts.join(F.broadcast(sizes), "type_id").withColumn("choice", F.pmod(spot, F.col("n_choices").cast("decimal(20,0)")).cast("int"))
    return asks.join(F.broadcast(wordings.select("type_id", "choice", "entry_id", "question", "quotes")), ["type_id", "choice"]).select("semantic_id", "type_id", "operator", "field", "row_ids", ids.alias("audio_ids"), "target", "gold", "entry_id", F.col("question").alias("pattern"), "quotes")


def shortfall(plan: DataFrame, budgets: dict[str, int]) -> DataFrame:
    """type_id, requested, planned, shortfall of every type with a budget."""
    asked = plan.sparkSession.createDataFrame(sorted(budgets.items()), "type_id string, requested long")
    return asked.join(plan.groupBy("type_id").agg(F.count("*").alias("c")), "type_id", "left").select("type_id", "requested", F.coalesce("c", F.lit(0)).alias("planned"), (F.col("requested") - F.coalesce("c", F.lit(0))).alias("shortfall"))


def require_budget(plan: DataFrame, budgets: dict[str, int]) -> DataFrame:
    """The plan, or an error that names the types that fall short."""
    short = [tuple(r) for r in shortfall(plan, budgets).where("shortfall <> 0").collect()]  # a row a type at most
    if short:
        raise ValueError(f"budget shortfall (type, requested, planned, missing): {short}")
    return plan


def visible_target(c: Column | str) -> Column:
    """A target as a question shows it: spaces collapsed, none before punctuation."""
    return F.regexp_replace(collapse(c), r"\s+([,.;:?!])", "$1")


def bound_target(c: Column | str, quotes: Column) -> Column:
    """The target without one balanced pair of outer quotes, where the wording brings its own."""
    text = visible_target(c)
    inner = F.trim(F.substring(text, F.lit(2), F.length(text) - 2))
    paired = (F.length(text) >= 2) & ((F.startswith(text, F.lit("“")) & F.endswith(text, F.lit("”"))) | (F.startswith(text, F.lit('"')) & F.endswith(text, F.lit('"'))))
    return F.when(quotes & paired, inner).otherwise(text)


SLOT = r"\[[A-Z_]+(:[A-Za-z_]+)?\]"


def question_text(pattern: Column | str, target: Column | str, quotes: Column) -> Column:
    """A wording with its target; of two sentence marks around a closing quote the inner one stays."""
    shown = tidy(F.replace(as_column(pattern), F.lit("[TARGET_VALUE]"), F.coalesce(bound_target(target, quotes), F.lit("[TARGET_VALUE]"))))
    return F.regexp_replace(shown, r"([.!?;:,])”[.!?](?=\s|$)", "$1”")


def realize(plan: DataFrame, rows: DataFrame, key: str, hidden: str, fields: list[str], bank: str) -> DataFrame:
    """Internal records: the plan with question, shown target, the asked values and hidden identifiers of its rows, and id.

    A question is about two rows at most, so the rows meet by two equi-joins; nothing is gathered."""
    src = rows.select(F.col(key).cast("string").alias("_k"), F.col(hidden).cast("string").alias("_w"), *fields)
    out = plan.withColumn("_n", F.size("row_ids"))
    for i in (0, 1):
        side = src.select(F.col("_k").alias(f"_k{i}"), F.col("_w").alias(f"_w{i}"), *[F.col(f).alias(f"_{f}{i}") for f in fields])
        out = out.join(side, F.get("row_ids", F.lit(i)) == F.col(f"_k{i}"), "left")
        out = out.withColumn(f"_v{i}", F.coalesce(*[F.when(F.col("field") == f, F.col(f"_{f}{i}").cast("string")) for f in fields]))
    cut = lambda a, b: F.slice(F.array(a, b), F.lit(1), F.col("_n"))
    qa = F.concat(F.lit("qa_"), F.substring(F.sha2(F.concat_ws("|", "semantic_id", "entry_id", F.lit(bank)), 256), 1, 20))
    return out.select(qa.alias("qa_id"), "semantic_id", "type_id", "operator", "field", "entry_id", "row_ids", "audio_ids", "target", F.when(F.col("target").isNotNull(), visible_target("target")).alias("shown_target"), "gold", question_text("pattern", "target", F.col("quotes")).alias("question"), cut("_v0", "_v1").alias("hidden_values"), cut("_w0", "_w1").alias("hidden_ids"))


def model_facing(records: DataFrame) -> DataFrame:
    """What a model sees of internal records; no source or annotation field."""
    return records.select(F.col("qa_id").alias("id"), F.col("audio_ids").alias("audio"), "question", F.col("gold").alias("answer"), "type_id", "operator")


def mcq_text(question: Column | str, choices: Column | str) -> Column:
    """A question, an empty line, and a lettered line a choice."""
    lines = F.transform(as_column(choices), lambda c, i: F.concat(F.char(F.lit(65) + i), F.lit(". "), c))
    return F.concat(as_column(question), F.lit("\n\n"), F.array_join(lines, "\n"))


def bind_context(template: Column | str, context: dict[str, Column], visible: dict[str, str]) -> tuple[Column, Column]:
    """A template with its [CONTEXT:field] places filled, and why not: a field that isn't declared, is hidden or forbidden, or
    has no value. Nothing is shown unless all can be."""
    t = as_column(template)
    named = F.regexp_extract_all(t, F.lit(r"\[CONTEXT:([^\]]*)\]"), 1)
    faults = [F.when(F.exists(named, lambda f: ~f.isin(*context)), "undeclared_context_field")]
    shown = t
    for f, c in sorted(context.items()):
        asked = F.array_contains(named, f)
        faults += [F.when(asked & F.lit(visible.get(f, "visible") != "visible"), f"{visible.get(f)}_context_requested"), F.when(asked & c.isNull(), "missing_context_value")]
        shown = F.replace(shown, F.lit(f"[CONTEXT:{f}]"), F.coalesce(c.cast("string"), F.lit("")))
    why = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*faults)))), ";")
    return F.when(why == "", tidy(shown)), why


def composite_wording(pattern: Column | str, parts: dict[str, str], target: Column) -> tuple[Column, Column]:
    """A composite question: the pattern's [OUTPUTS] as a numbered list of instructions and its target; and what is wrong with
    it: an instruction or the target not in the text, or a place left open."""
    told = "; ".join(f"({i + 1}) {x}" for i, x in enumerate(parts.values()))
    text = tidy(F.replace(F.replace(as_column(pattern), F.lit("[OUTPUTS]"), F.lit(told)), F.lit("[TARGET_VALUE]"), F.coalesce(target, F.lit("[TARGET_VALUE]"))))
    issues = [F.when(~F.contains(text, F.lit(x)), f"missing_instruction:{k}") for k, x in parts.items()]
    issues += [F.when(target.isNotNull() & ~F.contains(text, target), "missing_target"), F.when(text.rlike(SLOT), "unresolved_slot")]
    return text, F.array_join(F.array_compact(F.array(*issues)), ";")


def logical_release(records: DataFrame, variants: dict[str, list[str]], policy: str, recipe: str) -> DataFrame:
    """A release's rows: each record with the variant of its type that its id's hash picks, and one audio id: its row's own, or
    for two rows that of their composite, by recipe and order."""
    pick = F.conv(F.substring(F.sha2(F.concat_ws("|", "qa_id", "type_id", F.lit(policy)), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    text = F.coalesce(*[F.when(F.col("type_id") == t, F.get(F.array(*[F.lit(x) for x in v]), F.pmod(pick, F.lit(len(v)).cast("decimal(20,0)")).cast("int"))) for t, v in sorted(variants.items())])
    two = F.size("audio_ids") == 2
    at = lambda i: F.get(F.col("audio_ids"), F.lit(i))
    pair = F.concat(F.lit("pair_"), F.substring(F.sha2(canonical_json(a=at(0), b=at(1), recipe=F.lit(recipe)), 256), 1, 20))
    return records.select("qa_id", "type_id", F.coalesce(text, F.col("question")).alias("question"), F.when(two, pair).otherwise(at(0)).alias("audio_id"), "gold")


def composite_manifest(pairs: DataFrame, recipe: str) -> DataFrame:
    """composite_id and its components in the order they are heard (the smaller hash first), of pairs (a, b)."""
    key = lambda x: F.struct(digest(F.lit("heard"), x).alias("h"), F.col(x).cast("string").alias("r"))
    heard = F.transform(F.array_sort(F.array(key("a"), key("b"))), lambda p: p["r"])
    ident = F.concat(F.lit("c_"), F.substring(F.sha2(F.concat_ws("|", F.lit(recipe), F.least("a", "b").cast("string"), F.greatest("a", "b").cast("string")), 256), 1, 16))
    return pairs.select(ident.alias("composite_id"), F.array_join(heard, ",").alias("components"))


def response_format(records: DataFrame, pool: DataFrame, wrong: int = 3) -> DataFrame:
    """qa_id, format, choices, position: booleans as a yes or no choice, selections as A or B, values of a field as the answer
    among ``wrong`` other values of the pool (field, value) by hash, open where the pool has too few."""
    values = pool.groupBy("field").agg(F.collect_set("value").alias("u"))  # domains of the asked fields
    met = records.join(F.broadcast(values), "field", "left")
    by = lambda salt, xs: F.transform(F.array_sort(F.transform(xs, lambda x: F.struct(digest(F.lit(salt), "qa_id", x).alias("h"), x.alias("x")))), lambda p: p["x"])
    others = F.slice(by("wrong", F.array_remove("u", F.col("gold"))), 1, wrong)
    many = F.size(others) == wrong
    kind = F.when(F.col("operator").isin("EQUALITY", "TARGET_MATCH"), "BINARY").when(F.col("operator") == "PAIRWISE_SELECTION", "SELECTION").when(F.coalesce(many, F.lit(False)), "MULTIPLE_CHOICE").otherwise("OPEN_ENDED")
    shown = F.when(kind == "BINARY", F.array(F.lit("true"), F.lit("false"))).when(kind == "SELECTION", F.array(F.lit("A"), F.lit("B"))).when(kind == "MULTIPLE_CHOICE", by("shown", F.concat(others, F.array("gold"))))
    return met.select("qa_id", kind.alias("format"), F.array_join(shown, "|").alias("choices"), (F.array_position(shown, F.col("gold")) - 1).alias("position"))


def manifest(plan: DataFrame) -> DataFrame:
    """audio_id, row_id, required_by: each audio of a plan and how many instances need it."""
    each = plan.select(F.explode(F.arrays_zip("audio_ids", "row_ids")).alias("e"))
    return each.groupBy(F.col("e.audio_ids").alias("audio_id")).agg(F.min("e.row_ids").alias("row_id"), F.count("*").alias("required_by"))


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: rows and a sum of row hashes that no order changes; two builds of one plan must agree."""
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash"))
