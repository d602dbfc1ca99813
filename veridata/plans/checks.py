"""Queries of profiles, capacities, guardrails, invariants and governance rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import text as T
from ..operators import capacity, pairs, plan, profile, rules
from ..operators.terms import total
from ..sources.readers import table
from .oracle_capacity import CAPACITY
from .registry import count_if, spoken, stated

_LEN = "length(CAST({c} AS VARCHAR))"


def _profile_sql(t: str, cols: dict[str, str]) -> str:
    one = "SELECT '{c}' AS field, '{k}' AS dtype, count(*) AS n, count(*) - count({c}) AS missing, {e} AS empty, count(DISTINCT {c}) AS distinct_, min({l}) AS a, max({l}) AS z, round(avg({l}), 2) AS m FROM {t}"
    parts = [one.format(c=c, k=k, t=t, l=_LEN.format(c=c), e=f"count(*) FILTER (trim({c}) = '')" if k == "string" else "0") for c, k in cols.items()]
    return f"SELECT field, dtype, n, missing, empty, distinct_ AS \"distinct\", CASE WHEN distinct_ > 20 THEN a END AS least_length, CASE WHEN distinct_ > 20 THEN z END AS most_length, CASE WHEN distinct_ > 20 THEN m END AS mean_length FROM ({' UNION ALL '.join(parts)})"


@stated(_profile_sql("part", {"p_partkey": "int64", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int64"}))
def q_field_profile(s, d):
    return profile.field_profile(table(s, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))


@stated(" UNION ALL ".join(f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM part WHERE (SELECT count(DISTINCT {c}) FROM part) <= 20 AND {c} IS NOT NULL GROUP BY 2" for c in ("p_type", "p_name", "p_brand")))
def q_value_distribution(s, d):
    return profile.value_distribution(table(s, d, "part"), ["p_type", "p_name", "p_brand"])


_IX = "SELECT '{c}' AS field, coalesce(sum(n) FILTER (v IS NOT NULL), 0)::BIGINT AS valid, coalesce(sum(n) FILTER (v IS NULL), 0)::BIGINT AS empty, count(v) AS domain, coalesce(max(n) FILTER (v IS NOT NULL), 0) AS largest, count(*) FILTER (v IS NOT NULL AND n > 1) AS reusable FROM (SELECT CASE WHEN trim({c}) <> '' THEN {c} END AS v, count(*) AS n FROM part GROUP BY 1)"


@stated(" UNION ALL ".join(_IX.format(c=c) for c in ("p_type", "p_name", "p_brand")))
def q_index_summary(s, d):
    return profile.index_summary(table(s, d, "part"), ["p_type", "p_name", "p_brand"])


@stated("SELECT count(*) AS n_speakers, sum(c)::BIGINT AS n, sum(c * (c - 1) // 2)::BIGINT AS pairs, count(*) FILTER (c = 1) AS single, max(c) AS largest, count(*) FILTER (k > 1) AS conflicting FROM (SELECT count(*) AS c, count(DISTINCT o_orderstatus) AS k FROM orders GROUP BY o_custkey)")
def q_speakers(s, d):
    return profile.speakers(table(s, d, "orders"), "o_custkey", "o_orderstatus")


@stated("SELECT size, count(*) AS n_groups FROM (SELECT count(*) AS size FROM orders GROUP BY o_custkey) GROUP BY 1")
def q_group_histogram(s, d):
    return profile.group_histogram(table(s, d, "orders"), "o_custkey")


@stated("""WITH g AS (SELECT user_id, min(event_type) AS a, max(event_type) AS z FROM events GROUP BY 1), l AS (SELECT arg_max(user_id, event_id) AS speaker, arg_max(event_type, event_id) AS region, event_id % 500 AS row_id FROM events GROUP BY event_id % 500) SELECT row_id, speaker, region, CASE WHEN a = z THEN a END AS gender FROM l LEFT JOIN g ON g.user_id = speaker""")
def q_speaker_map(s, d):
    e = table(s, d, "events").select((F.col("event_id") % 500).alias("row_id"), "event_id", "user_id", "event_type", F.col("event_type").alias("region"))
    return profile.speaker_map(e, "row_id", "user_id", "event_type", "region", "event_id")


@stated("""WITH p AS (SELECT user_id, count(DISTINCT t) AS k, bool_or(t IS NULL) AS b, count(*) AS c FROM (SELECT user_id, nullif(event_type, 'error') AS t FROM events) GROUP BY 1)
  SELECT count(*) AS n, count(*) FILTER (event_type = 'error') AS missing, 0 AS empty, count(DISTINCT nullif(event_type, 'error')) AS n_values, 0 AS repeated_rows, (SELECT count(*) FROM p) AS n_speakers, (SELECT count(*) FROM p WHERE k = 1 AND NOT b) AS consistent, (SELECT count(*) FROM p WHERE k > 1) AS conflicting, (SELECT count(*) FROM p WHERE k = 0) AS unlabelled, (SELECT min(c) FROM p) AS least, (SELECT max(c) FROM p) AS most, (SELECT round(avg(c), 4) FROM p) AS mean FROM events""")
def q_metadata_audit(s, d):
    e = table(s, d, "events").select("event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("t"))
    return profile.metadata_audit(e, "t", "user_id")


@stated(f"WITH a AS (SELECT count(*) AS n, count(*) FILTER (lang IS NULL OR lang NOT IN ('en', 'de')) AS invalid_label, count(*) FILTER (text IS NULL OR trim(text) = '') AS empty_text, count(*) FILTER (lang IS NULL OR trim(lang) = '') AS missing_label, count(DISTINCT coalesce(text, '')) AS n_texts, count(DISTINCT coalesce({spoken('text')}, '')) AS n_keys FROM documents) SELECT *, n - n_texts AS repeated_texts, n - n_keys AS repeated_keys FROM a")
def q_text_audit(s, d):
    return profile.text_audit(table(s, d, "documents"), "text", "lang", ["en", "de"])


_MARKS, _BEYOND = r"regexp_matches(text, '[\p{P}]')", r"regexp_matches(text, '[^\x00-\x7F]')"


@stated(rf"""SELECT count(*) AS n, 0 AS no_id, 0 AS no_text, {count_if('upper(text) = text AND lower(text) <> text', 'all_upper')}, {count_if('lower(text) = text AND upper(text) <> text', 'all_lower')}, {count_if(_MARKS, 'punctuation')}, {count_if("regexp_matches(text, '[0-9]')", 'digits')}, {count_if(_BEYOND, 'beyond_ascii')},
  sum(length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')))::BIGINT AS upper_signs, sum(length(regexp_replace(text, '[^\p{{Ll}}]', '', 'g')))::BIGINT AS lower_signs, count(DISTINCT doc_id) AS ids, count(DISTINCT text) AS texts, count(DISTINCT {spoken('text')}) AS keys FROM documents WHERE text IS NOT NULL AND trim(text) <> ''""")
def q_stream_audit(s, d):
    return profile.stream_audit(table(s, d, "documents"), "doc_id", "text")


@stated(r"SELECT 'signs' AS kind, length(text) AS length, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 2 UNION ALL SELECT 'words', len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')), count(*) FROM documents WHERE text IS NOT NULL GROUP BY 2")
def q_length_histogram(s, d):
    return profile.length_histogram(table(s, d, "documents"), "text")


@stated(r"""SELECT count(*) AS n, round(sum(p_size) / 3600, 4) AS hours, min(length(p_name)) AS least_text, max(length(p_name)) AS most_text, round(avg(len(list_filter(regexp_split_to_array(p_name, '\s+'), lambda w: w <> ''))), 4) AS mean_tokens, sum(1 + (p_size % 2 = 0)::INT)::BIGINT AS n_terms, max(1 + (p_size % 2 = 0)::INT)::BIGINT AS most_terms, 0 AS without_terms, count(DISTINCT p_type) AS n_topics, count(DISTINCT p_brand) AS n_videos, (SELECT max(c) FROM (SELECT count(*) AS c FROM part GROUP BY p_brand)) AS largest_video FROM part""")
def q_dataset_profile(s, d):
    listed = F.concat_ws(";", F.col("p_type"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")))
    return profile.dataset_profile(table(s, d, "part"), "p_size", "p_name", T.term_list(listed), "p_type", "p_brand")


@stated("WITH d(class) AS (VALUES ('F'), ('O'), ('P'), ('X')) SELECT class, count(o_orderkey) AS n, count(DISTINCT o_custkey) AS n_speakers FROM d LEFT JOIN orders ON o_orderstatus = class GROUP BY 1")
def q_class_distribution(s, d):
    return profile.class_distribution(table(s, d, "orders"), "o_orderstatus", "o_custkey", ["F", "O", "P", "X"])


@stated("WITH d(field) AS (VALUES ('RING'), ('bolt'), ('promo'), ('nowhere')) SELECT field, count(p_partkey) AS n, min(CAST(p_partkey AS VARCHAR)) AS first FROM d LEFT JOIN part ON contains(lower(p_name || ' ' || p_type), lower(field)) GROUP BY 1")
def q_coverage(s, d):
    return profile.coverage(["RING", "bolt", "promo", "nowhere"], table(s, d, "part"), "p_partkey", ["p_name", "p_type"])


def _relations(s, d) -> DataFrame:
    c = table(s, d, "customer").join(F.broadcast(table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.withColumns({"none": F.lit(None).cast("int"), "one": F.lit(1), "twin": F.col("n_nationkey") * 2, "once": F.col("c_custkey") * 2})
    roles, hidden = {"c_name": "provenance", "n_name": "hidden_identifier"}, {"c_acctbal"}
    asked = [("n_nationkey", "n_regionkey"), ("c_mktsegment", "n_regionkey"), ("one", "n_regionkey"), ("n_regionkey", "one"), ("none", "one"), ("c_custkey", "once"), ("n_nationkey", "twin"), ("one", "one"), ("gone", "one"), ("c_name", "one"), ("n_name", "one"), ("one", "c_acctbal")]
    return profile.union_all([profile.relation_verdict(c, a, b, roles=roles, hidden=hidden) for a, b in asked])


_REL = "SELECT '{a}' AS source, '{b}' AS target, reason IS NULL AS valid, reason, n_sources, n_targets, conflicts, reusable FROM (SELECT CASE WHEN n_sources = 0 THEN 'derived_relation_data_unavailable' WHEN n_sources < 2 THEN 'invalid_derived_insufficient_source_values' WHEN n_targets < 2 THEN 'invalid_derived_insufficient_target_values' WHEN conflicts > 0 THEN 'invalid_derived_nonfunctional_relation' WHEN reusable < 2 THEN 'invalid_derived_nonreusable_source' WHEN n_targets >= n_sources THEN 'invalid_derived_not_coarsening' END AS reason, * FROM (SELECT count(*) AS n_sources, (SELECT count(DISTINCT {b}) FROM c WHERE {a} IS NOT NULL) AS n_targets, count(*) FILTER (t > 1) AS conflicts, count(*) FILTER (n > 1) AS reusable FROM (SELECT {a} AS s, count(*) AS n, count(DISTINCT {b}) AS t FROM c WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1)))"
_EARLY = {("one", "one"): "invalid_derived_same_field", ("gone", "one"): "unknown_answer_field:gone", ("c_name", "one"): "ineligible_field_role:provenance:c_name", ("n_name", "one"): "invalid_derived_hidden_source", ("one", "c_acctbal"): "invalid_derived_hidden_target"}


@stated("WITH c AS (SELECT *, NULL::INT AS none, 1 AS one, n_nationkey * 2 AS twin, c_custkey * 2 AS once FROM customer JOIN nation ON c_nationkey = n_nationkey) " + " UNION ALL ".join([_REL.format(a=a, b=b) for a, b in (("n_nationkey", "n_regionkey"), ("c_mktsegment", "n_regionkey"), ("one", "n_regionkey"), ("n_regionkey", "one"), ("none", "one"), ("c_custkey", "once"), ("n_nationkey", "twin"))] + [f"SELECT '{a}', '{b}', false, '{r}', 0, 0, 0, 0" for (a, b), r in _EARLY.items()]))
def q_relation_verdicts(s, d):
    return _relations(s, d)


@stated("SELECT c_custkey, n_regionkey AS value FROM customer JOIN nation ON c_nationkey = n_nationkey")
def q_derived_values(s, d):
    c = table(s, d, "customer").join(F.broadcast(table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return profile.derived_values(c, "c_custkey", "n_nationkey", "n_regionkey")


@stated(f"""WITH r AS (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) ELSE replace(p_name, ' ', '-') END AS raw FROM part), k AS (SELECT raw, lower(trim(regexp_replace(replace(raw, '-', ' '), '\\s+', ' ', 'g'))) AS norm FROM r)
  SELECT norm, count(*) AS n_raw, NOT (bool_and(raw IN ('small ring', 'SMALL RING', 'small-ring')) OR bool_and(raw IN ('red widget', 'RED WIDGET'))) AS unexpected FROM k GROUP BY 1 HAVING count(*) > 1""")
def q_collisions(s, d):
    n = F.col("p_name")
    raw = F.when(F.col("p_partkey") % 3 == 0, n).when(F.col("p_partkey") % 3 == 1, F.upper(n)).otherwise(F.replace(n, F.lit(" "), F.lit("-")))
    return profile.collisions(table(s, d, "part").select(raw.alias("raw")), "raw", T.COMPARATORS["spoken"].key("raw"), [{"small ring", "SMALL RING", "small-ring"}, {"red widget", "RED WIDGET"}])


_INFO = "SELECT '{n}' AS label, CASE WHEN coalesce(n, 0) = 0 OR classes < 2 THEN 'NO_LABEL_VARIATION' WHEN round(most / n, 6) <= 0.8 AND round(h / log2(classes), 6) >= 0.5 THEN 'REASONABLE_INFORMATION' WHEN least < 50 THEN 'INSUFFICIENT_MINORITY_CAPACITY' WHEN least * classes < 100 THEN 'BALANCED_CAPACITY_TOO_SMALL' ELSE 'PASS_WITH_PLANNER_BALANCING_CAPABILITY' END AS reason FROM (SELECT sum(c) AS n, count(*) AS classes, max(c) AS most, min(c) AS least, log2(sum(c)) - sum(c * log2(c)) / sum(c) AS h FROM (SELECT count(*) AS c FROM {t} GROUP BY {c}))"
_LABELS = {"segment": ("customer", "c_mktsegment"), "rare": ("orders", "o_orderkey % 97 = 0"), "very rare": ("orders", "o_orderkey = 5"), "one": ("orders", "o_orderkey < 0"), "status": ("orders", "o_orderstatus")}


@stated("SELECT *, CASE WHEN reason IN ('REASONABLE_INFORMATION', 'PASS_WITH_PLANNER_BALANCING_CAPABILITY') THEN 'PASS' ELSE 'AUTO_REJECT_TASK' END AS severity FROM (" + " UNION ALL ".join(_INFO.format(n=n, t=t, c=c) for n, (t, c) in _LABELS.items()) + ")")
def q_information_gate(s, d):
    one = lambda n, t, c: profile.information_gate(profile.information(table(s, d, t).select(F.expr(c).alias("x")), "x")).select(F.lit(n).alias("label"), "reason", "severity")
    return profile.union_all([one(n, t, c) for n, (t, c) in _LABELS.items()])


def _capacities(s, d) -> DataFrame:
    c, o = table(s, d, "customer"), table(s, d, "orders")
    return profile.union_all([capacity.capacity(c, "c_mktsegment", "c_mktsegment"), capacity.capacity(c, "c_nationkey", "c_nationkey"), capacity.capacity(o, "o_orderpriority", "o_orderpriority")])


_FEASIBLE = f"cap AS ({CAPACITY}), fe AS (SELECT field, 'DIRECT' AS operator, direct AS feasible FROM cap UNION ALL SELECT field, 'EQUALITY', CAST(floor(least(equal_pos / 0.4, equal_neg / 0.6)) AS BIGINT) FROM cap UNION ALL SELECT field, 'TARGET_MATCH', CAST(floor(least(match_pos / 0.4, match_neg / 0.6)) AS BIGINT) FROM cap UNION ALL SELECT field, 'PAIRWISE_SELECTION', selection FROM cap)"


def _feasible(s, d) -> DataFrame:
    return profile.union_all([capacity.feasible(_capacities(s, d), o, 0.4) for o in plan.OPERATORS])


@stated(f"WITH {_FEASIBLE} SELECT * FROM fe")
def q_feasible_capacity(s, d):
    return _feasible(s, d)


_T = "CASE WHEN operator = 'DIRECT' THEN field END"
_BUDGET = f"""{_FEASIBLE}, ty AS (SELECT field AS type, feasible AS l, row_number() OVER (ORDER BY field) - 1 AS i, count(*) OVER () AS k FROM fe WHERE operator = 'DIRECT'),
  bt AS (SELECT type, l, 5000 // k + (i < 5000 % k)::INT AS r FROM ty), bd AS (SELECT type, l, 10 // k + (i < 10 % k)::INT AS r FROM ty), bp AS (SELECT type, l, CASE type WHEN 'c_mktsegment' THEN 77 ELSE 0 END AS r FROM ty),
  bu AS (SELECT 'total' AS of, *, 'TOTAL_BUDGET_EQUAL_BY_TYPE' AS st FROM bt UNION ALL SELECT 'debug', *, 'DEBUG_SAMPLE_BUDGET' FROM bd UNION ALL SELECT 'types', *, 'PER_TYPE_BUDGET' FROM bp)"""


def _budgets(s, d) -> DataFrame:
    types = _feasible(s, d).where("operator = 'DIRECT'")
    told = {"total": {"total": 5000, "strict": True}, "debug": {"debug": 10}, "types": {"per_type": {"c_mktsegment": 77}}}
    return profile.union_all([capacity.resolve_budget(types, "field", "feasible", **how).select(F.lit(n).alias("of"), "*") for n, how in told.items()])


@stated(f"WITH {_BUDGET} SELECT of, type, CAST(r AS BIGINT) AS requested, CAST(least(r, l) AS BIGINT) AS budget, CAST(r - least(r, l) AS BIGINT) AS shortfall, CASE WHEN of = 'total' AND (SELECT sum(r - least(r, l)) FROM bt) > 0 THEN 'BUDGET_INFEASIBLE' ELSE st END AS status FROM bu")
def q_resolve_budget(s, d):
    return _budgets(s, d)


@stated(f"WITH {_BUDGET} SELECT of, CAST(sum(least(r, l)) AS BIGINT) AS total, sha256('shop|train|' || string_agg(type || '=' || CAST(least(r, l) AS BIGINT), ',' ORDER BY type || '=' || CAST(least(r, l) AS BIGINT))) AS hash FROM bu GROUP BY of")
def q_allocation_hash(s, d):
    b = _budgets(s, d)
    return profile.union_all([capacity.allocation_hash(b.where(F.col("of") == n), "shop", "train").select(F.lit(n).alias("of"), "*") for n in ("total", "debug", "types")])


def _topology(s, d) -> DataFrame:
    c = table(s, d, "customer")
    candidates = table(s, d, "nation").select(F.col("n_nationkey").alias("candidate")).unionAll(s.range(100, 101).select(F.col("id").cast("int").alias("candidate")))
    return capacity.topologies(c, "c_custkey", "c_mktsegment", candidates, c.select(F.col("c_custkey").alias("anchor"), F.col("c_nationkey").alias("candidate")))


_TOPOLOGY = """f AS (SELECT (SELECT count(*) FROM customer) AS n, (SELECT count(*) + 1 FROM nation) AS c, (SELECT sum(m * (m - 1) // 2) FROM (SELECT count(*) AS m FROM customer GROUP BY c_mktsegment)) AS same),
  b AS (SELECT count(c_custkey) AS p FROM (SELECT n_nationkey AS k FROM nation UNION ALL SELECT 100) LEFT JOIN customer ON c_nationkey = k GROUP BY k), g AS (SELECT sum(p * (n - p)) AS cond, sum(p * (p - 1) // 2) AS bth, sum((n - p) * (n - p - 1) // 2) AS nei FROM b, f)"""


@stated(f"""WITH {_TOPOLOGY}, t AS (SELECT 'ONE_TO_ONE' AS topology, n AS raw, n AS valid, n AS positive, 0 AS negative FROM f UNION ALL SELECT 'CARTESIAN_PRESENCE', n * c, n * c, n, n * c - n FROM f UNION ALL SELECT 'UNORDERED_PAIR', n * (n - 1) // 2, n * (n - 1) // 2, same, n * (n - 1) // 2 - same FROM f UNION ALL SELECT 'TARGET_CONDITIONED_UNORDERED_PAIR', cond + bth + nei, cond, cond, 0 FROM g)
  SELECT topology, CAST(raw AS BIGINT) AS raw, CAST(valid AS BIGINT) AS valid, CAST(raw - valid AS BIGINT) AS excluded, CAST(positive AS BIGINT) AS positive, CAST(negative AS BIGINT) AS negative FROM t""")
def q_topologies(s, d):
    return _topology(s, d)


@stated("""WITH u AS (SELECT o_orderkey, o_orderstatus = 'F' AS p, sha256('42:' || o_orderkey) AS h FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY h, o_orderkey) AS i FROM u) SELECT o_orderkey, CASE WHEN p THEN 'POSITIVE' ELSE 'NEGATIVE' END AS relation FROM r WHERE p AND i <= 75 OR NOT p AND i <= 25""")
def q_resolve_plan(s, d):
    o = table(s, d, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("p"))
    return capacity.resolve_plan(o, "o_orderkey", "p", 100, 3.0)


_TASKS = [
    ("sound", ["a"], ["a", "b"], ["x"], ["z"], "PASS", 50, None, 0, "exact", ["case"], 0, 3, 2, 9, False, False, "REVIEW_REQUIRED", "PASS", "PREFLIGHT_PASS"),
    ("bare", None, None, ["x"], None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None),
    ("source", ["a", "c"], ["a", "b"], [], ["a"], "AUTO_REJECT_TASK", 1, None, 2, "exact", [], 4, 0, 2, 0, True, True, "REDUNDANT_COMPOSITE", "BLOCKING", "PREFLIGHT_REVIEW"),
    ("review", ["a"], ["a"], ["x"], ["b"], "PASS", 5, 9, 0, "spoken", None, 0, 1, 1, 0, False, True, "POTENTIAL_JOINT_RELATION", "AUTO_DROP_ROW", "PREFLIGHT_REVIEW"),
]


def _lit(x) -> str:
    return "NULL" if x is None else "[" + ", ".join(f"'{v}'" for v in x) + "]::VARCHAR[]" if isinstance(x, list) else f"'{x}'" if isinstance(x, str) else str(x)


_EV = [x.split()[0] for x in rules.EVIDENCE.split(", ")]
_TASK_SQL = f"ev({', '.join(_EV)}) AS (VALUES " + ", ".join("(" + ", ".join(map(_lit, t)) + ")" for t in _TASKS) + ")"
_GUARD = {
    "SOURCE_SUPPORT": "CASE WHEN len(fields) > 0 AND len(source_fields) > 0 AND NOT list_has_all(source_fields, fields) THEN 'AUTO_REJECT_TASK' END", "GOLD_DERIVABILITY": "CASE WHEN coalesce(len(outputs), 0) = 0 THEN 'AUTO_REJECT_TASK' END", "MODALITY_OBSERVABILITY": "CASE WHEN list_has_any(fields, non_observable) THEN 'AUTO_REJECT_TASK' END", "LABEL_INFORMATION": "label_severity",
    "CAPACITY": "CASE WHEN capacity < coalesce(min_capacity, 2) THEN 'AUTO_REJECT_TASK' END", "COMPARATOR_COLLISION": "CASE WHEN unexpected_collisions > 0 THEN 'BLOCKING' END", "INVARIANCE": "CASE WHEN comparator <> '' AND coalesce(len(invariances), 0) = 0 THEN 'REVIEW' END", "SPLIT_ISOLATION": "CASE WHEN reserved_refs > 0 THEN 'BLOCKING' END", "NEGATIVE_VALIDITY": "CASE WHEN negative_min < 1 THEN 'AUTO_REJECT_TASK' END",
    "PAIR_VALIDITY": "CASE WHEN arity > 1 AND pair_capacity < 1 THEN 'AUTO_REJECT_TASK' END", "COMPONENT_VISIBILITY": "CASE WHEN component_visible THEN 'AUTO_REJECT_TASK' END", "TEXT_ONLY_SHORTCUT": "CASE WHEN shortcut_risk THEN 'REVIEW' END", "COMPOSITE_REDUNDANCY": "CASE WHEN composite = 'REDUNDANT_COMPOSITE' THEN 'AUTO_REJECT_TASK' END", "SOURCE_CONSISTENCY": "anomaly_severity", "LANGUAGE_ALIGNMENT": "CASE WHEN language = 'PREFLIGHT_REVIEW' THEN 'REVIEW' END",
}
_GUARDED = f"{_TASK_SQL}, gd AS (" + " UNION ALL ".join(f"SELECT task, '{g}' AS guardrail, coalesce({x}, 'PASS') AS severity FROM ev" for g, x in _GUARD.items()) + ")"


def _tasks(s: SparkSession) -> DataFrame:
    return s.createDataFrame(_TASKS, rules.EVIDENCE)


@stated(f"WITH {_GUARDED} SELECT * FROM gd")
def q_guardrails(s, d):
    return rules.guardrails(_tasks(s))


@stated(f"WITH {_GUARDED} SELECT task, {list(rules.SEVERITIES)}[max(list_position({list(rules.SEVERITIES)}, severity))] AS severity, count(*) FILTER (severity <> 'PASS') AS n_failed FROM gd GROUP BY 1")
def q_task_verdicts(s, d):
    return rules.task_verdicts(rules.guardrails(_tasks(s)))


@stated("""WITH c AS (SELECT count(*) AS n, count(DISTINCT c_mktsegment) AS k, min(m) AS least FROM customer JOIN (SELECT c_mktsegment, count(*) AS m FROM customer GROUP BY 1) USING (c_mktsegment)) SELECT 'segment' AS task, 'PASS' AS severity, 0 AS n_failed FROM c UNION ALL SELECT 'brand', 'BLOCKING', 2""")
def q_measured_guardrails(s, d):
    """Two tasks whose evidence is measured: the customers' segments, and brands of orders' test split under a comparator that
    maps them all to one."""
    c, p = table(s, d, "customer"), table(s, d, "part")
    info = profile.information_gate(profile.information(c, "c_mktsegment")).select(F.col("severity").alias("label_severity"))
    caps = capacity.capacity(c, "c_mktsegment", "x").select(F.col("direct").alias("capacity"), F.col("equal_pos").alias("pair_capacity"), F.least("equal_pos", "equal_neg").alias("negative_min"))
    merged = profile.collisions(p, "p_brand", F.regexp_replace("p_brand", "[0-9]", ""), []).agg(total(F.col("unexpected"), "unexpected_collisions"))
    shape = lambda df, **v: df.select(*[F.expr(f"cast(null as {t})").alias(n) if n not in v else v[n].cast(t).alias(n) for n, t in (x.split(" ", 1) for x in rules.EVIDENCE.split(", "))])
    one = shape(info.join(F.broadcast(caps)), task=F.lit("segment"), outputs=F.array(F.lit("segment")), label_severity=F.col("label_severity"), capacity=F.col("capacity"), pair_capacity=F.col("pair_capacity"), negative_min=F.col("negative_min"), arity=F.lit(2))
    two = shape(merged, task=F.lit("brand"), outputs=F.array(F.lit("brand")), unexpected_collisions=F.col("unexpected_collisions"), comparator=F.lit("digits"))
    return rules.task_verdicts(rules.guardrails(one.unionByName(two)))


def _invariants(s: SparkSession, d: str, broken: bool) -> DataFrame:
    """All invariants over measured inputs; ``broken``: each with inputs that break it once."""
    c, o, p = table(s, d, "customer"), table(s, d, "orders"), table(s, d, "part")
    x = int(broken)
    frame = lambda rows, ddl: s.createDataFrame(rows, ddl)
    v = rules.violations
    keys = c.select(F.col("c_custkey").alias("key"))
    parts = keys.select("key", F.when(F.col("key") % 3 == 0, "promoted").when(F.col("key") % 3 == 1, "fallback").otherwise("rejected").alias("part"))
    if broken:
        parts = parts.unionAll(keys.where("key = 0").select("key", F.lit("rejected")))
    n = c.agg(F.count("*").alias("n"))
    pairs_n = capacity.capacity(c, "c_mktsegment", "x").join(F.broadcast(n))
    listed = pairs.same_group_pairs(o, "o_orderkey", "o_custkey").join(o.select(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("key")), "a").groupBy("key").agg(F.count("*").alias("n"))
    formula = o.groupBy(F.col("o_custkey").alias("key")).agg((F.count("*") * (F.count("*") - 1) / 2).cast("long").alias("n"))
    if broken:
        formula = formula.withColumn("n", F.when(F.col("key") == formula.agg(F.min("key")).first()[0], F.col("n") + 1).otherwise(F.col("n")))
    buckets = capacity.pair_buckets(c, "c_mktsegment").withColumn("raw", F.col("both") + F.col("neither") + F.col("valid"))
    sums = buckets.agg(*[F.sum(k).alias(k) for k in ("raw", "valid", "both", "neither")])
    build = plan.fingerprint(c.select("c_custkey", K.digest("c_custkey").alias("h")))
    chosen = p.select("p_partkey").where("p_partkey % 5 = 0")
    fields = [("t", f) for f in ("field", "operator")] + [("t", "Random_Seed")] * x
    counts = o.groupBy(F.lit("all").alias("grp"), "o_orderstatus").agg(F.count("*").alias("n"))
    whole = o.agg(F.lit("all").alias("grp"), (F.count("*") + x).alias("expected"))
    out = [
        v("mutually_exclusive_partition", rules.exclusive_partition(keys, parts)),
        v("sanitization_monotonicity", rules.not_monotone(o.groupBy(F.col("o_orderstatus").alias("task")).agg(F.count("*").alias("raw"), (F.count(F.when(F.col("o_totalprice") > 1000, 1)) + F.when(F.max(F.col("o_orderstatus") == "F") & F.lit(broken), F.count("*")).otherwise(0)).alias("clean")))),
        v("concept_space_declared", rules.undeclared_space(frame([("terms", "LEXICAL_SURFACE_STRING" if not broken else ""), ("other", None)], "task string, concept_space string"), ["terms"])),
        v("topology_maximum", rules.over_topology(pairs_n.select(F.lit("UNORDERED_PAIR").alias("topology"), "n", (F.col("equal_pos") + F.col("equal_neg") + x).alias("capacity")))),
        v("no_sampling_fields_in_contract", rules.plan_fields(frame(fields, "task string, field string"))),
        v("planner_capacity_bounds", rules.over_bounds(pairs_n.select(F.lit("t").alias("task"), F.lit(10).alias("total"), F.lit(1.0).alias("ratio"), (F.col("equal_pos") * (1 - x)).alias("positive"), F.col("equal_neg").alias("negative")))),
        v("determinism", rules.differing_builds(build, build.withColumn("n", F.col("n") + x)).limit(1)),
        v("cartesian_conservation", rules.not_conserved(pairs_n.select((F.col("n") * (F.col("n") - 1) / 2 + x).cast("long").alias("raw"), F.col("equal_pos").alias("pos"), F.col("equal_neg").alias("neg"), F.lit(0).alias("collision"), F.lit(0).alias("invalid")))),
        v("formula_enumeration_equivalence", rules.formula_differs(formula, listed)),
        v("manifest_instance_uniqueness", rules.repeated(chosen.unionAll(chosen.where("p_partkey = 0").limit(x)), "p_partkey")),
        v("manifest_universe_membership", rules.outside(chosen, p.where(F.col("p_partkey") >= 5 * x), "p_partkey")),
        v("registry_hash_separation", rules.not_apart(frame([("l", "l" if broken else "k")], "a string, b string"))),
        v("fallback_decision_provenance", rules.not_apart(frame([("", "e") if broken else ("f", "e")], "a string, b string"))),
        v("semantic_universe_source_provenance", rules.derived_sources(frame([("SOURCE_DATASET",), ("PRODUCTION_PLAN" if broken else "SOURCE_PROFILE",)], "source_kind string"))),
        v("topology_role_compatibility", rules.role_mismatch(frame([("UNORDERED_PAIR", "audio_segment", None, ["x"]), ("CARTESIAN_PRESENCE", "a", "" if broken else "term", ["x"]), ("TARGET_CONDITIONED_UNORDERED_PAIR", "a", None, ["target_value"])], "topology string, anchor_type string, candidate_type string, roles array<string>"))),
        v("topology_usage_aggregation", rules.sum_differs(counts, whole)),
        v("task_binding_referential_integrity", rules.unbound(frame([("t", "t", "t", "t", "h", "g" if broken else "h", None, "c")], "task string, contract string, universe string, result string, anchors string, universe_anchors string, candidates string, universe_candidates string"))),
        v("historical_replay_count_closure", rules.sum_differs(o.groupBy(F.col("o_orderpriority").alias("grp")).agg(F.count("*").alias("n")), o.groupBy(F.col("o_orderpriority").alias("grp")).agg((F.count("*") + F.when(F.max(F.substring("o_orderpriority", 1, 1)) == "1", x).otherwise(0)).alias("expected")))),
        v("target_conditioned_bucket_exactness", rules.buckets_differ(buckets, sums.withColumn("valid", F.col("valid") + x))),
    ]
    return profile.union_all(out).select(F.lit("broken" if broken else "sound").alias("of"), "*")


_NAMES = "mutually_exclusive_partition sanitization_monotonicity concept_space_declared topology_maximum no_sampling_fields_in_contract planner_capacity_bounds determinism cartesian_conservation formula_enumeration_equivalence manifest_instance_uniqueness manifest_universe_membership registry_hash_separation fallback_decision_provenance semantic_universe_source_provenance topology_role_compatibility topology_usage_aggregation task_binding_referential_integrity historical_replay_count_closure target_conditioned_bucket_exactness".split()


@stated(" UNION ALL ".join(f"SELECT '{of}' AS of, '{n}' AS invariant, {int(of == 'broken')} AS violations" for of in ("sound", "broken") for n in _NAMES))
def q_invariants(s, d):
    return profile.union_all([_invariants(s, d, x) for x in (False, True)])


@stated("SELECT p_brand, count(*) AS n, count(*) FILTER (p_size <= 5) AS blocking, count(*) FILTER (p_type = 'PROMO') AS n_issues FROM part GROUP BY 1")
def q_summaries(s, d):
    p = table(s, d, "part")
    return rules.summaries(p.select("p_brand", (F.col("p_size") > 5).alias("ok")), p.where("p_type = 'PROMO'"), "p_brand")


@stated("SELECT o_orderkey, (o_orderkey % 3) || '=' || lower(o_orderstatus) || ',' || 7 || '=urgent' AS pairs FROM orders")
def q_label_pairs(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.concat(F.lit("Codes: "), (F.col("o_orderkey") % 3).cast("string"), F.lit(" = "), F.col("o_orderstatus"), F.lit("; 7: Urgent (see 8)")).alias("t"))
    return o.select("o_orderkey", F.array_join(rules.label_pairs("t"), ",").alias("pairs"))


@stated("WITH a AS (SELECT p_partkey, p_name FROM part WHERE p_partkey % 3 = 0), c AS (SELECT p_partkey, p_type FROM part WHERE p_partkey % 2 = 0) SELECT origin, count(*) AS n, count(DISTINCT v) AS n_values FROM (SELECT coalesce(p_name, p_type) AS v, CASE WHEN p_name IS NOT NULL THEN 'approved' ELSE 'candidate' END AS origin FROM a FULL JOIN c USING (p_partkey)) GROUP BY 1")
def q_effective_binding(s, d):
    p = table(s, d, "part")
    met = rules.effective_binding(p.where("p_partkey % 3 = 0").select("p_partkey", F.col("p_name").alias("v")), p.where("p_partkey % 2 = 0").select("p_partkey", F.col("p_type").alias("v")), "p_partkey", "v")
    return met.groupBy("origin").agg(F.count("*").alias("n"), F.countDistinct("v").alias("n_values"))


@stated("SELECT id, u AS uncovered, j AS new_joint, kind FROM (VALUES (1, 0, 0, 'REDUNDANT_COMPOSITE'), (2, 0, 1, 'POTENTIAL_JOINT_RELATION'), (3, 1, 0, 'REVIEW_REQUIRED'), (4, 2, 1, 'POTENTIAL_JOINT_RELATION')) t(id, u, j, kind)")
def q_composite_kind(s, d):
    rows = [(1, ["a", "b"], ["a", "b", "r"], ["r"]), (2, ["a"], ["a"], ["r"]), (3, ["a", "c"], ["a"], []), (4, ["c", "d"], ["a"], ["r", "a"])]
    return rules.composite_kind(s.createDataFrame(rows, "id int, requested array<string>, covered array<string>, joint array<string>"))


@stated("SELECT * FROM (VALUES ('gender', 'POLICY_INAPPROPRIATE_AS_MODEL_TARGET'), ('accent', 'REVIEW_REQUIRED'), ('topic', 'SOURCE_METADATA_VALID_MODEL_TARGET_REJECTED'), ('noise', 'SOURCE_ANNOTATION_INCONSISTENT'), ('mood', 'SOURCE_METADATA_AMBIGUOUS'), ('gone', 'SOURCE_FIELD_NOT_PRESENT')) t(field, status)")
def q_metadata_kind(s, d):
    rows = [("gender", True, True, True, True, False), ("accent", True, True, True, True, True), ("topic", True, True, True, False, True), ("noise", True, True, True, False, False), ("mood", False, True, True, True, True), ("gone", True, True, False, False, True)]
    return rules.metadata_kind(s.createDataFrame(rows, "field string, documented boolean, in_schema boolean, in_rows boolean, needs_audio boolean, consistent boolean"))


@stated("SELECT * FROM (VALUES ('t1', ''), ('t2', 'UNKNOWN_TYPE_ID;NO_TEMPLATES;NO_ANSWER_FORMAT'), ('t3', 'UNRESOLVED_SLOT;SNAKE_CASE_LEAK')) t(type_id, issues)")
def q_preflight(s, d):
    rows = [("t1", ["is it [TARGET_VALUE]?", "in [CONTEXT:town]?"], "yes or no"), ("t2", None, None), ("t3", ["what is [UNIT]?", "the row_id?"], "text")]
    return rules.preflight(s.createDataFrame(rows, "type_id string, templates array<string>, answer_format string"), s.createDataFrame([("t1",), ("t3",)], "type_id string"))


@stated("SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'answer_leakage' WHEN 2 THEN 'empty_template' WHEN 3 THEN 'invalid_context_placeholder;unknown_placeholder:TOWN' ELSE '' END AS faults FROM customer")
def q_template_faults(s, d):
    k = F.col("c_custkey") % 5
    text = F.when(k == 0, "is [KEY] in [CONTEXT:town]?").when(k == 1, "is it [VALUE]?").when(k == 2, "  ").when(k == 3, "in [TOWN], [CONTEXT:]?").otherwise("plain?")
    return table(s, d, "customer").select("c_custkey", text.alias("t")).select("c_custkey", rules.template_faults("t").alias("faults"))


@stated("SELECT p_type, count(*) AS n, count(*) FILTER (p_type IN ('SMALL', 'LARGE')) AS n_accepted, min(CASE WHEN p_type NOT IN ('SMALL', 'LARGE') THEN 'OPERATOR_NOT_ALLOWED:' || p_type END) AS reason FROM part GROUP BY 1")
def q_operator_policy(s, d):
    met = rules.allowed_operators(table(s, d, "part").select("p_partkey", "p_type"), "p_partkey", "p_type", ("SMALL", "LARGE"))
    return met.join(table(s, d, "part").select("p_partkey", "p_type"), "p_partkey").groupBy("p_type").agg(F.count("*").alias("n"), total(F.col("accepted"), "n_accepted"), F.min("reason").alias("reason"))


@stated("SELECT CAST(o_orderkey AS VARCHAR) AS type_id FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority NOT IN ('5-LOW')")
def q_evaluation_eligible(s, d):
    types = table(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("type_id"), F.array("o_orderstatus", "o_orderpriority").alias("fields"))
    policies = profile.union_all([table(s, d, "orders").select(F.col(c).alias("field")).distinct().select("field", (~F.col("field").isin("P", "5-LOW")).alias("evaluate")) for c in ("o_orderstatus", "o_orderpriority")])
    return rules.evaluation_eligible(types, policies)


@stated("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1 HAVING count(*) > 0")
def q_round_closure(s, d):
    o = table(s, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("generated"), total(F.col("o_orderstatus") == "F", "accepted"))
    off = rules.round_closure(o.select("*", F.lit(0).alias("duplicate"), F.lit(0).alias("rejected"), F.lit(0).alias("dropped")))
    return off.select("o_orderpriority", (F.col("generated") - F.col("accepted")).alias("n"))
