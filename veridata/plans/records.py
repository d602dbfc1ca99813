"""Queries of plans and records: budgets, instances, wordings, questions, audits. Customers are the source's rows; they are asked
for their market segment and region, and their nation's key is the hidden identifier.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import audit, plan
from ..operators.plan import Contract, Field, Wording

from ..sources.readers import table
from .registry import audio, collapse, count_if, digest, hash_int, stated

FIELDS = [Field("segment", "CATEGORY", "the customer", "market segment"), Field("region", "PLACE", "the customer", "home region", quotes=True), Field("balance", "QUANTITY", "the account", "balance", unit="dollars", match_policy="tolerance", supported=False)]
CONTRACTS = [Contract(f"{f.name}_{o.lower()}", o, f.name) for f in FIELDS[:2] for o in plan.OPERATORS] + [Contract("balance_direct", "DIRECT", "balance")]
BANK = [
    Wording("d1", "DIRECT", "CATEGORY", "what is  [ATTRIBUTE] of [ENTITY] ?"),
    Wording("d2", "DIRECT", "CATEGORY", "which [ATTRIBUTE] does [ENTITY] belong to?", "PARAPHRASE"),
    Wording("d3", "DIRECT", "PLACE", "in which [ATTRIBUTE] does [ENTITY] live?"),
    Wording("d4", "DIRECT", "QUANTITY", "how many [UNIT] are the [ATTRIBUTE]?", unit_policy="required"),
    Wording("d5", "DIRECT", "PLACE", "name the [ATTRIBUTE].", enabled=False),
    Wording("e1", "EQUALITY", "CATEGORY", "do both have the same [ATTRIBUTE]?"),
    Wording("e2", "EQUALITY", "PLACE", "do both share a [ATTRIBUTE] ?"),
    Wording("e3", "EQUALITY", "PLACE", "are both from one [ATTRIBUTE]?", "PARAPHRASE"),
    Wording("m1", "TARGET_MATCH", "CATEGORY", "is the [ATTRIBUTE] of [ENTITY] [TARGET_VALUE]?"),
    Wording("m2", "TARGET_MATCH", "PLACE", "is this right: the [ATTRIBUTE] is “[TARGET_VALUE]” ?"),
    Wording("m3", "TARGET_MATCH", "PLACE", "does [ENTITY] live there?", "PARAPHRASE"),
    Wording("s1", "PAIRWISE_SELECTION", "CATEGORY", "which of the two has the [ATTRIBUTE] [TARGET_VALUE], A or B?"),
    Wording("s2", "PAIRWISE_SELECTION", "PLACE", "who has the [ATTRIBUTE] “[TARGET_VALUE]”, A or B?"),
    Wording("s3", "PAIRWISE_SELECTION", "PLACE", "which one, A or B, in [UNIT] [TARGET_VALUE]?", unit_policy="required"),
    Wording("x1", "DIRECT", "PLACE", "what is the [ATTRIBUTE]?", unit_policy="forbidden", match_policies=("bucket",)),
]
EACH = 40
ASKED = CONTRACTS[:8]
BUDGETS = {c.type_id: EACH for c in ASKED}
BANK_HASH = plan.bank_hash(BANK)


def source(s, d) -> DataFrame:
    c = table(s, d, "customer").join(F.broadcast(table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(s, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("r_name").alias("region"), F.concat(F.lit("speaker-"), F.col("c_nationkey").cast("string")).alias("who"))


SOURCE = "src AS (SELECT c_custkey AS id, c_mktsegment AS segment, r_name AS region, 'speaker-' || c_nationkey AS who FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_CONTRACTS = "con(type_id, operator, answer_kind, shows, supported, cls, entity, attribute, unit, policy, quotes) AS (VALUES " + ", ".join(f"({_q(c.type_id)}, {_q(c.operator)}, {_q(c.answer_kind)}, {plan.RULES[c.operator][2]}, {f.supported}, {_q(f.semantic_class)}, {_q(f.entity)}, {_q(f.attribute)}, {_q(f.unit)}, {_q(f.match_policy)}, {f.quotes})" for c in CONTRACTS for f in FIELDS if f.name == c.field) + ")"
_BANK = "bank(entry_id, op, cls, pattern, kind, enabled, up, policies, ans) AS (VALUES " + ", ".join(f"({_q(w.entry_id)}, {_q(w.operator)}, {_q(w.semantic_class)}, {_q(w.pattern)}, {_q(w.kind)}, {w.enabled}, {_q(w.unit_policy)}, {list(w.match_policies)}, {_q(w.answers)})" for w in BANK) + ")"


def _tidy(x: str) -> str:
    y = rf"regexp_replace({collapse(x)}, '\s+([,.;:?!])', '\1', 'g')"
    return f"upper(left({y}, 1)) || substr({y}, 2)"


_COMPATIBLE = f"""{_CONTRACTS}, {_BANK},
  mt AS (SELECT type_id, entry_id, kind, quotes, array_to_string(list_filter([CASE WHEN operator <> op THEN 'OPERATOR_MISMATCH' END, CASE WHEN c.cls <> b.cls THEN 'SEMANTIC_CLASS_MISMATCH' END, CASE WHEN answer_kind <> ans THEN 'ANSWER_KIND_MISMATCH' END, CASE WHEN NOT supported THEN 'SEMANTIC_FIELD_NOT_SUPPORTED' END,
      CASE WHEN NOT list_contains(policies, policy) THEN 'MATCH_POLICY_UNSUPPORTED' END, CASE WHEN up = 'required' AND unit = '' THEN 'UNIT_REQUIRED' END, CASE WHEN up = 'forbidden' AND unit <> '' THEN 'UNIT_MUST_BE_ABSENT' END, CASE WHEN contains(pattern, '[UNIT]') AND unit = '' THEN 'REQUIRED_SLOT_MISSING' END,
      CASE WHEN shows <> contains(pattern, '[TARGET_VALUE]') THEN 'TARGET_SLOT_MISMATCH' END, CASE WHEN NOT enabled THEN 'WORDING_DISABLED' END], lambda x: x IS NOT NULL), ';') AS reasons, replace(replace(replace(pattern, '[ENTITY]', entity), '[ATTRIBUTE]', attribute), '[UNIT]', unit) AS t
    FROM con c JOIN bank b ON c.operator = b.op OR c.cls = b.cls),
  cp AS (SELECT type_id, entry_id, kind, quotes, reasons, CASE WHEN reasons = '' THEN {_tidy('t')} END AS question FROM mt),
  wd AS (SELECT *, row_number() OVER (PARTITION BY type_id ORDER BY entry_id) - 1 AS choice, count(*) OVER (PARTITION BY type_id) AS k FROM cp WHERE reasons = '')"""


def _compatible(s) -> DataFrame:
    return plan.compatible(plan.contract_frame(s, CONTRACTS, FIELDS), plan.bank_frame(s, BANK))


@stated(f"WITH {_COMPATIBLE} SELECT type_id, entry_id, reasons, question FROM cp")
def q_compatibility(s, d):
    return _compatible(s).select("type_id", "entry_id", "reasons", "question")


def _instances_sql(f: str) -> str:
    """CTEs of one field's instances, from the definitions of the four operators."""
    yes = plan.positive_count(EACH, None)
    t = lambda o: f"'{f}_{o}'"
    return f"""{f}r AS (SELECT id, {f} AS g, who, {digest('id')} AS h, row_number() OVER (PARTITION BY {f} ORDER BY {digest('id')}, id) - 1 AS place FROM src WHERE {f} IS NOT NULL),
  {f}z AS (SELECT g, count(*) AS m FROM {f}r GROUP BY g), {f}st AS (SELECT g, m, sum(m) OVER (ORDER BY {digest('g')}, g) - m AS first, sum(m) OVER () AS n, max(m) OVER () AS largest FROM {f}z),
  {f}c AS (SELECT r.*, m, n, largest, first + place AS pos FROM {f}r r JOIN {f}st USING (g)),
  {f}d AS (SELECT [CAST(id AS VARCHAR)] AS rows, NULL::VARCHAR AS target, g AS gold FROM {f}r ORDER BY place, g LIMIT {EACH}),
  {f}p AS (SELECT a, b FROM (SELECT x.id AS a, x.h, y.id AS b, row_number() OVER (PARTITION BY x.id ORDER BY x.who = y.who, k.i) AS o FROM {f}c x, range(1, 4) k(i), {f}c y WHERE x.m > 1 AND (x.m > 2 OR x.place = 0) AND (k.i = 1 OR x.m >= 7) AND y.g = x.g AND y.place = (x.place + k.i) % x.m) WHERE o = 1 ORDER BY h, a LIMIT {yes}),
  {f}n AS (SELECT x.id AS a, y.id AS b FROM (SELECT * FROM {f}c WHERE 2 * largest < n ORDER BY h, id LIMIT {EACH - yes}) x JOIN {f}c y ON y.pos = (x.pos + x.largest) % x.n),
  {f}e AS (SELECT [CAST(a AS VARCHAR), CAST(b AS VARCHAR)] AS rows, NULL::VARCHAR AS target, 'true' AS gold FROM {f}p UNION ALL SELECT [CAST(a AS VARCHAR), CAST(b AS VARCHAR)], NULL, 'false' FROM {f}n),
  {f}v AS (SELECT v, length(v) AS len, row_number() OVER (ORDER BY length(v), {digest('v')}, v) - 1 AS pos, count(*) OVER () AS size FROM (SELECT DISTINCT {f} AS v FROM src WHERE {f} IS NOT NULL)),
  {f}l AS (SELECT x.v, x.pos, x.size, min(y.pos) AS lo, max(y.pos) + 1 AS hi FROM {f}v x JOIN {f}v y ON y.len / x.len BETWEEN 0.6 AND 1.67 GROUP BY ALL),
  {f}g AS (SELECT v, pos, CASE WHEN hi - lo > 1 THEN lo ELSE 0 END AS lo, CASE WHEN hi - lo > 1 THEN hi - lo ELSE size END AS n FROM {f}l),
  {f}t AS (SELECT id, {f} AS pv, v.v AS nv, row_number() OVER (ORDER BY {digest("'match'", 'id')}, id) AS o FROM src JOIN {f}g g ON g.v = {f} AND g.n > 1 JOIN {f}v v ON v.pos = g.lo + (g.pos - g.lo + 1 + {hash_int('id')} % (g.n - 1)) % g.n),
  {f}m AS (SELECT [CAST(id AS VARCHAR)] AS rows, CASE WHEN o <= {yes} THEN pv ELSE nv END AS target, CASE WHEN o <= {yes} THEN 'true' ELSE 'false' END AS gold FROM {f}t WHERE o <= {EACH}),
  {f}s AS (SELECT CASE WHEN {hash_int('a')} % 2 = 0 THEN [CAST(a AS VARCHAR), CAST(b AS VARCHAR)] ELSE [CAST(b AS VARCHAR), CAST(a AS VARCHAR)] END AS rows, g AS target, CASE WHEN {hash_int('a')} % 2 = 0 THEN 'A' ELSE 'B' END AS gold
    FROM (SELECT x.id AS a, y.id AS b, x.g FROM {f}c x JOIN {f}c y ON 2 * x.largest < x.n AND y.pos = (x.pos + x.largest) % x.n ORDER BY {digest("'select'", 'x.id')}, x.id LIMIT {EACH})),
  {f}i AS (SELECT {t('direct')} AS type_id, 'DIRECT' AS operator, '{f}' AS field, * FROM {f}d UNION ALL SELECT {t('equality')}, 'EQUALITY', '{f}', * FROM {f}e UNION ALL SELECT {t('target_match')}, 'TARGET_MATCH', '{f}', * FROM {f}m UNION ALL SELECT {t('pairwise_selection')}, 'PAIRWISE_SELECTION', '{f}', * FROM {f}s)"""


_JSON_ROWS = """'["' || array_to_string(rows, '","') || '"]'"""
_PLAN = f"""{SOURCE}, {_COMPATIBLE}, {_instances_sql('segment')}, {_instances_sql('region')}, i0 AS (SELECT * FROM segmenti UNION ALL SELECT * FROM regioni),
  i1 AS (SELECT DISTINCT *, 'sem_' || substr(sha256('{{"dataset":"customer","gold":"' || gold || '","revision":"r1","rows":' || {_JSON_ROWS} || ',"target":' || coalesce('"' || target || '"', 'null') || ',"type":"' || type_id || '"}}'), 1, 20) AS sem FROM i0),
  i2 AS (SELECT i1.*, CAST(CAST('0x' || substr(sha256('42|' || sem || '|{BANK_HASH}'), 1, 16) AS UBIGINT) % k AS INTEGER) AS choice FROM i1 JOIN (SELECT DISTINCT type_id, k FROM wd) USING (type_id)),
  pl AS (SELECT i2.*, entry_id, question AS pattern, quotes, list_transform(rows, lambda r: {audio('customer', 'r')}) AS audio_ids FROM i2 JOIN wd USING (type_id, choice)),
  q1 AS (SELECT *, CASE WHEN target IS NOT NULL THEN regexp_replace({collapse('target')}, '\\s+([,.;:?!])', '\\1', 'g') END AS shown FROM pl),
  q2 AS (SELECT *, 'qa_' || substr(sha256(sem || '|' || entry_id || '|{BANK_HASH}'), 1, 20) AS qa, CASE WHEN target IS NULL THEN pattern ELSE {_tidy("replace(pattern, '[TARGET_VALUE]', shown)")} END AS question FROM q1),
  rec AS (SELECT q2.*, CASE field WHEN 'segment' THEN a.segment ELSE a.region END AS v0, CASE field WHEN 'segment' THEN b.segment ELSE b.region END AS v1, a.who AS w0, b.who AS w1 FROM q2 LEFT JOIN src a ON CAST(a.id AS VARCHAR) = rows[1] LEFT JOIN src b ON CAST(b.id AS VARCHAR) = rows[2])"""


def _plan(s, d) -> DataFrame:
    return plan.build_plan(source(s, d), "id", "who", ASKED, BUDGETS, plan.numbered_wordings(_compatible(s)), BANK_HASH, "customer", "r1")


def _records(s, d) -> DataFrame:
    return plan.realize(_plan(s, d), source(s, d), "id", "who", ["segment", "region"], BANK_HASH)


@stated(f"WITH {_PLAN} SELECT sem AS semantic_id, type_id, operator, field, array_to_string(rows, ',') AS rows, target, gold, entry_id FROM pl")
def q_generation_plan(s, d):
    return _plan(s, d).select("semantic_id", "type_id", "operator", "field", F.array_join("row_ids", ",").alias("rows"), "target", "gold", "entry_id")


@stated(f"WITH {_PLAN}, b(type_id, requested) AS (VALUES {', '.join(f'({_q(t)}, {n})' for t, n in BUDGETS.items())}) SELECT type_id, requested::BIGINT AS requested, count(sem) AS planned, requested - count(sem) AS shortfall FROM b LEFT JOIN pl USING (type_id) GROUP BY type_id, requested")
def q_budget_shortfall(s, d):
    return plan.shortfall(_plan(s, d), BUDGETS)


@stated(f"WITH {_PLAN} SELECT qa AS id, array_to_string(audio_ids, ',') AS audio, question, gold AS answer, type_id, operator FROM rec")
def q_realize(s, d):
    return plan.model_facing(_records(s, d)).withColumn("audio", F.array_join("audio", ","))


@stated(f"WITH {_PLAN} SELECT qa AS qa_id, shown AS shown_target, array_to_string(CASE len(rows) WHEN 1 THEN [v0] ELSE [v0, v1] END, ',') AS hidden_values, array_to_string(CASE len(rows) WHEN 1 THEN [w0] ELSE [w0, w1] END, ',') AS hidden_ids FROM rec")
def q_internal_records(s, d):
    return _records(s, d).select("qa_id", "shown_target", F.array_join("hidden_values", ",").alias("hidden_values"), F.array_join("hidden_ids", ",").alias("hidden_ids"))


@stated(f"WITH {_PLAN}, e AS (SELECT audio_ids[i] AS audio_id, rows[i] AS row_id FROM pl, range(1, 3) r(i) WHERE i <= len(rows)) SELECT audio_id, min(row_id) AS row_id, count(*) AS required_by FROM e GROUP BY 1")
def q_plan_manifest(s, d):
    return plan.manifest(_plan(s, d))


@stated(f"WITH {_PLAN} SELECT count(*) AS n, true AS same FROM pl")
def q_determinism(s, d):
    a, b = (plan.fingerprint(_plan(s, d).drop("quotes")) for _ in range(2))
    return a.select("n", F.col("hash").alias("x")).join(F.broadcast(b.select(F.col("hash").alias("y")))).select("n", (F.col("x") == F.col("y")).alias("same"))


def _faulty(s, d) -> DataFrame:
    """The records, each with one fault by its number, so that every check has records that fail it."""
    r = _records(s, d)
    n = F.pmod(F.conv(F.substring("qa_id", 4, 6), 16, 10).cast("long"), F.lit(30))
    q = F.col("question")
    first = lambda c: F.get(F.col(c), F.lit(0))
    return r.withColumn("n", n).select(
        F.when(F.col("n") == 0, F.lit("qa_same")).otherwise(F.col("qa_id")).alias("qa_id"),
        F.when(F.col("n") == 1, F.lit("sem_same")).otherwise(F.col("semantic_id")).alias("semantic_id"),
        F.when(F.col("n") == 2, F.lit("nothing")).when(F.col("n") == 3, F.lit("balance_direct")).otherwise(F.col("type_id")).alias("type_id"),
        "operator",
        F.when(F.col("n") == 4, F.lit("none")).when(F.col("n") == 5, F.lit("d5")).when(F.col("n") == 6, F.lit("e1")).otherwise(F.col("entry_id")).alias("entry_id"),
        "row_ids",
        F.when(F.col("n") == 7, F.array(first("audio_ids"), first("audio_ids"))).when(F.col("n") == 8, F.concat(F.col("audio_ids"), F.array(F.lit("audio_more")))).otherwise(F.col("audio_ids")).alias("audio_ids"),
        F.when(F.col("n") == 9, F.lit(None).cast("string")).otherwise(F.col("target")).alias("target"),
        F.when(F.col("n") == 10, F.lit("shown")).otherwise(F.col("shown_target")).alias("shown_target"),
        F.when(F.col("n") == 11, F.when(F.col("gold") == "true", "false").when(F.col("gold") == "false", "true").when(F.col("gold") == "A", "B").otherwise("A")).when(F.col("n") == 12, F.lit(None).cast("string")).otherwise(F.col("gold")).alias("gold"),
        F.when(F.col("n") == 13, F.concat(q, F.lit(" [UNIT]"))).when(F.col("n") == 14, F.concat(q, F.lit(" "), first("hidden_ids"))).when(F.col("n") == 15, F.concat(q, F.lit(" a-1.WAV"))).when(F.col("n") == 16, F.concat(q, F.lit(" row "), first("row_ids"))).when(F.col("n") == 17, F.concat(q, F.lit(" speakerID"))).when(F.col("n") == 18, F.concat(q, F.lit(" "), F.lower(first("hidden_values")))).otherwise(q).alias("question"),
        F.when(F.col("n") == 19, F.array(F.lit("X"), F.lit("X"))).otherwise(F.col("hidden_values")).alias("hidden_values"),
        "hidden_ids",
    )


_N = "CAST('0x' || substr(qa, 4, 6) AS BIGINT) % 30"
_FAULTY = f"""fl AS (SELECT CASE n WHEN 0 THEN 'qa_same' ELSE qa END AS qa, CASE n WHEN 1 THEN 'sem_same' ELSE sem END AS sem, CASE n WHEN 2 THEN 'nothing' WHEN 3 THEN 'balance_direct' ELSE type_id END AS type_id, CASE n WHEN 4 THEN 'none' WHEN 5 THEN 'd5' WHEN 6 THEN 'e1' ELSE entry_id END AS entry_id, rows,
  CASE n WHEN 7 THEN [audio_ids[1], audio_ids[1]] WHEN 8 THEN list_append(audio_ids, 'audio_more') ELSE audio_ids END AS audio_ids, CASE WHEN n <> 9 THEN target END AS target, CASE n WHEN 10 THEN 'shown' ELSE shown END AS shown,
  CASE n WHEN 11 THEN CASE gold WHEN 'true' THEN 'false' WHEN 'false' THEN 'true' WHEN 'A' THEN 'B' ELSE 'A' END WHEN 12 THEN NULL ELSE gold END AS gold,
  question || CASE n WHEN 13 THEN ' [UNIT]' WHEN 14 THEN ' ' || w0 WHEN 15 THEN ' a-1.WAV' WHEN 16 THEN ' row ' || rows[1] WHEN 17 THEN ' speakerID' WHEN 18 THEN ' ' || lower(v0) ELSE '' END AS question, CASE n WHEN 19 THEN ['X', 'X'] ELSE CASE len(rows) WHEN 1 THEN [v0] ELSE [v0, v1] END END AS hv, CASE len(rows) WHEN 1 THEN [w0] ELSE [w0, w1] END AS hw FROM (SELECT *, {_N} AS n FROM rec)),
  ok AS (SELECT qa, sem, type_id, entry_id, rows, audio_ids, target, shown, gold, question, CASE len(rows) WHEN 1 THEN [v0] ELSE [v0, v1] END AS hv, CASE len(rows) WHEN 1 THEN [w0] ELSE [w0, w1] END AS hw FROM rec)"""
_FO = lambda x: f"lower(trim(regexp_replace(coalesce({x}, ''), '\\s+', ' ', 'g')))"


def _audit_sql(frame: str) -> str:
    leak = f"len(list_filter(hv, lambda v: v <> '' AND contains({_FO('question')}, lower(v)) AND (operator IN ('DIRECT', 'EQUALITY') OR target IS NULL AND {_FO('v')} <> '' OR {_FO('v')} <> {_FO('target')}))) > 0"
    mn = [f"CASE WHEN hv[{i}] IS NULL OR target IS NULL THEN {_FO(f'hv[{i}]')} = {_FO('target')} ELSE {_FO(f'hv[{i}]')} = {_FO('target')} END" for i in (1, 2)]
    one = f"({mn[0]}) <> ({mn[1]})"
    same = f"({_FO('hv[1]')} = {_FO('hv[2]')})"
    right = f"CASE operator WHEN 'DIRECT' THEN gold IS NOT DISTINCT FROM hv[1] WHEN 'EQUALITY' THEN (gold = 'true') IS NOT DISTINCT FROM {same} WHEN 'TARGET_MATCH' THEN (gold = 'true') IS NOT DISTINCT FROM ({mn[0]}) ELSE {one} AND gold IS NOT DISTINCT FROM CASE WHEN {mn[0]} THEN 'A' ELSE 'B' END END"
    arity = "CASE WHEN operator IN ('DIRECT', 'TARGET_MATCH') THEN 1 ELSE 2 END"
    tests = {
        "TYPE_SUPPORTED": "NOT supported", "TYPE_FULL_TRAIN_CAPACITY_SUFFICIENT": "type_id NOT IN (SELECT type_id FROM cap)", "KNOWN_LANGUAGE_ENTRY": "op IS NULL", "LANGUAGE_ENTRY_ACTIVE": "op IS NOT NULL AND NOT enabled",
        "LANGUAGE_COMPATIBLE": "op IS NOT NULL AND NOT goes", "OPERATOR_MATCH": "op <> operator", "SEMANTIC_CLASS_MATCH": "bcls <> cls", "ANSWER_KIND_MATCH": "ans <> answer_kind", "AUDIO_COUNT_MATCH": f"len(audio_ids) <> {arity}",
        "NO_UNRESOLVED_SLOT": r"regexp_matches(question, '\[[A-Z_]+(:[A-Za-z_]+)?\]')", "TARGET_ALLOWED": f"CASE WHEN shows THEN shown IS NULL OR NOT contains({_FO('question')}, {_FO('shown')}) ELSE shown IS NOT NULL END", "GOLD_DETERMINISTIC": f"NOT ({right})",
        "NEGATIVE_TARGET_IS_NEGATIVE": f"operator = 'TARGET_MATCH' AND gold = 'false' AND (target IS NULL OR ({mn[0]}))", "EQUALITY_RELATION_CORRECT": f"operator = 'EQUALITY' AND (gold = 'true') IS DISTINCT FROM {same}", "PAIRWISE_SELECTION_XOR": f"operator = 'PAIRWISE_SELECTION' AND NOT ({one})",
        "NO_IDENTICAL_AUDIO_PAIR": "len(list_distinct(audio_ids)) < len(audio_ids)", "NO_HIDDEN_IDENTIFIER_LEAK": f"len(list_filter(hw, lambda v: v <> '' AND contains({_FO('question')}, lower(v)))) > 0",
        "NO_FILENAME_LEAK": rf"regexp_matches(question, '(?i)\b[\w-]+\.wav\b') OR len(list_filter(rows, lambda v: contains({_FO('question')}, v))) > 0", "NO_PROVENANCE_LEAK": f"len(list_filter({list(audit.PROVENANCE)}, lambda p: contains({_FO('question')}, p))) > 0",
        "NO_VISIBLE_GOLD_LEAK": leak, "ANSWER_WITHOUT_AUDIO": leak, "SCHEMA_VALID": "gold IS NULL",
    }
    cells = [("KNOWN_TYPE", "operator IS NULL"), *[(k, f"operator IS NOT NULL AND ({x})") for k, x in tests.items()], ("QA_ID_UNIQUE", "qa_n > 1"), ("SEMANTIC_INSTANCE_UNIQUE", "sem_n > 1")]
    each = " UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) FILTER ({x}) AS n_fail, count(*) - count(*) FILTER ({x}) AS n_pass FROM j" for k, x in cells)
    return f"""WITH {_PLAN}, {_FAULTY}, cap AS (SELECT type_id FROM con WHERE type_id <> 'balance_direct'), gd AS (SELECT DISTINCT type_id, entry_id FROM wd),
  j AS (SELECT f.*, operator, answer_kind, shows, supported, con.cls, op, bank.cls AS bcls, ans, enabled, (f.type_id, f.entry_id) IN (SELECT (type_id, entry_id) FROM gd) AS goes, count(*) OVER (PARTITION BY qa) AS qa_n, count(*) OVER (PARTITION BY sem) AS sem_n FROM {frame} f LEFT JOIN con USING (type_id) LEFT JOIN bank USING (entry_id)) {each}"""


def _checked(s, d, records: DataFrame) -> DataFrame:
    contracts = plan.contract_frame(s, CONTRACTS, FIELDS)
    enough = contracts.select("type_id", (F.col("type_id") != "balance_direct").alias("sufficient"))
    return audit.record_checks(records, contracts, plan.bank_frame(s, BANK), _compatible(s).where("reasons = ''"), enough)


@stated(_audit_sql("ok"))
def q_audit_record(s, d):
    return audit.check_counts(_checked(s, d, _records(s, d)))


@stated(_audit_sql("fl"))
def q_audit_record_faults(s, d):
    return audit.check_counts(_checked(s, d, _faulty(s, d)))


@stated(f"WITH {_PLAN}, a AS (SELECT type_id, {count_if(chr(39) + 'true' + chr(39) + ' = gold', 'positive')}, {count_if(chr(39) + 'true' + chr(39) + ' <> gold', 'negative')} FROM rec WHERE operator IN ('EQUALITY', 'TARGET_MATCH') GROUP BY 1) SELECT *, round(positive / (positive + negative), 6) AS ratio, abs(positive / (positive + negative) - 0.5) <= 1 / (positive + negative) + 1e-9 AS within FROM a")
def q_label_ratio(s, d):
    return audit.label_ratio(_records(s, d), 0.5)


@stated(f"WITH {_PLAN}, a AS (SELECT type_id, {count_if(chr(39) + 'A' + chr(39) + ' = gold', 'gold_a')}, {count_if(chr(39) + 'A' + chr(39) + ' <> gold', 'gold_b')} FROM rec WHERE operator = 'PAIRWISE_SELECTION' GROUP BY 1) SELECT *, gold_a + gold_b >= 2 AND least(gold_a, gold_b) = 0 AS severe_bias FROM a")
def q_position_bias(s, d):
    return audit.position_bias(_records(s, d))


@stated(f"WITH {_PLAN} SELECT bank.entry_id, bank.kind, count(rec.qa) AS n FROM bank LEFT JOIN rec USING (entry_id) GROUP BY 1, 2")
def q_wording_usage(s, d):
    return audit.wording_usage(_records(s, d), plan.bank_frame(s, BANK))


@stated(f"WITH {_PLAN} SELECT type_id, shown AS target, count(*) AS n FROM rec WHERE operator IN ('TARGET_MATCH', 'PAIRWISE_SELECTION') GROUP BY 1, 2")
def q_target_frequency(s, d):
    return audit.target_frequency(_records(s, d))


@stated(f"WITH {_PLAN}, e AS (SELECT type_id, unnest(rows) AS r FROM rec) SELECT type_id, count(*) AS n_refs, count(DISTINCT r) AS n_rows FROM e GROUP BY 1")
def q_type_reuse(s, d):
    return audit.type_reuse(_records(s, d))


@stated(f"WITH {_PLAN}, {_FAULTY}, t AS (SELECT lower(concat_ws(' ', question, gold, array_to_string(audio_ids, ' '))) AS t FROM fl) SELECT count(*) AS n, count(*) FILTER (len(list_filter({list(audit.PROVENANCE)}, lambda p: contains(t, p))) > 0) AS token_leaks, 0 AS path_leaks FROM t")
def q_model_leaks(s, d):
    return audit.model_leaks(plan.model_facing(_faulty(s, d)))


@stated(f"""WITH {_PLAN}, {_FAULTY}, e AS (SELECT unnest([CASE WHEN type_id IN ('segment_equality', 'segment_pairwise_selection') AND len(audio_ids) <> 2 THEN 'PAIR_REQUIRES_TWO_AUDIO' END, CASE WHEN type_id IN ('segment_equality', 'segment_pairwise_selection') AND NOT contains(question, 'both') THEN 'PAIR_REQUIRES_WORDING' END, CASE WHEN type_id = 'segment_direct' AND len(audio_ids) <> 1 THEN 'SINGLE_REQUIRES_ONE_AUDIO' END,
  CASE WHEN type_id NOT IN ('segment_equality', 'segment_pairwise_selection', 'segment_direct') THEN 'INACTIVE_TYPE' END]) AS fault FROM fl) SELECT fault, count(*) AS n FROM e WHERE fault IS NOT NULL GROUP BY 1""")
def q_release_arity(s, d):
    return audit.release_arity(plan.model_facing(_faulty(s, d)), ("segment_equality", "segment_pairwise_selection"), ("segment_direct",), "both")


_SEEN = f"len(list_filter([v0, v1], lambda v: v IS NOT NULL AND v <> '' AND contains({_FO('question')}, {_FO('v')}))) > 0"


@stated(f"""WITH {_PLAN}, k AS (SELECT type_id, gold = 'true' AS y, {_SEEN} AS s FROM rec), g AS (SELECT type_id, count(*) AS n, count(*) FILTER (y = s) AS hits, count(*) FILTER (y) AS yes FROM k GROUP BY 1)
  SELECT type_id, n, round(greatest(yes, n - yes) / n, 4) AS base_rate, round(hits / n, 4) AS copy_accuracy, CASE WHEN hits / n >= 0.6 THEN 'COPY_VISIBLE_FIELD' WHEN greatest(yes, n - yes) / n >= 0.6 THEN 'BASE_RATE_PRIOR' END AS risk FROM g""")
def q_text_shortcut(s, d):
    return audit.text_shortcut(_records(s, d))


@stated(f"WITH {_PLAN} SELECT type_id, count(*) AS n, count(*) FILTER (contains(question, gold)) AS exposed_raw, count(*) FILTER (contains({_FO('question')}, {_FO('gold')})) AS exposed FROM rec GROUP BY 1")
def q_component_visibility(s, d):
    return audit.component_visibility(_records(s, d))


_VARIANTS = {"segment_direct": ["Which segment?", "Name the segment.", "What is it?"], "region_equality": ["Same region?", "One region or two?"]}


@stated(f"""WITH {_PLAN}, v AS (SELECT *, CAST('0x' || substr(sha256(concat_ws('|', qa, type_id, 'p1')), 1, 16) AS UBIGINT) AS h FROM rec) SELECT qa AS qa_id, type_id, CASE type_id WHEN 'segment_direct' THEN ['Which segment?', 'Name the segment.', 'What is it?'][1 + CAST(h % 3 AS INTEGER)] WHEN 'region_equality' THEN ['Same region?', 'One region or two?'][1 + CAST(h % 2 AS INTEGER)] ELSE question END AS question,
  CASE len(audio_ids) WHEN 2 THEN 'pair_' || substr(sha256('{{"a":"' || audio_ids[1] || '","b":"' || audio_ids[2] || '","recipe":"beep"}}'), 1, 20) ELSE audio_ids[1] END AS audio_id, gold FROM v""")
def q_logical_release(s, d):
    return plan.logical_release(_records(s, d), _VARIANTS, "p1", "beep")


@stated(f"""WITH {_PLAN}, u AS (SELECT DISTINCT 'segment' AS field, segment AS x FROM src UNION SELECT 'region', region FROM src), dq AS (SELECT * FROM rec WHERE operator = 'DIRECT'),
  w AS (SELECT qa, gold, u.x, row_number() OVER (PARTITION BY qa ORDER BY {digest("'wrong'", 'qa', 'u.x')}) AS n, count(*) OVER (PARTITION BY qa) AS k FROM dq JOIN u ON u.field = dq.field AND u.x <> gold), a AS (SELECT qa, gold, x FROM w WHERE n <= 3 AND k >= 3 UNION ALL SELECT qa, gold, gold FROM dq WHERE qa IN (SELECT qa FROM w WHERE k >= 3)),
  l AS (SELECT qa, gold, list(x ORDER BY {digest("'shown'", 'qa', 'x')}) AS c FROM a GROUP BY 1, 2)
  SELECT rec.qa AS qa_id, CASE WHEN operator IN ('EQUALITY', 'TARGET_MATCH') THEN 'BINARY' WHEN operator = 'PAIRWISE_SELECTION' THEN 'SELECTION' WHEN l.c IS NOT NULL THEN 'MULTIPLE_CHOICE' ELSE 'OPEN_ENDED' END AS format, CASE WHEN operator IN ('EQUALITY', 'TARGET_MATCH') THEN 'true|false' WHEN operator = 'PAIRWISE_SELECTION' THEN 'A|B' ELSE array_to_string(l.c, '|') END AS choices,
    CAST(CASE WHEN operator IN ('EQUALITY', 'TARGET_MATCH') THEN (rec.gold = 'false')::INT WHEN operator = 'PAIRWISE_SELECTION' THEN (rec.gold = 'B')::INT ELSE list_position(l.c, rec.gold) - 1 END AS BIGINT) AS position FROM rec LEFT JOIN l ON l.qa = rec.qa""")
def q_response_format(s, d):
    pool = source(s, d).select(F.explode(F.array(F.struct(F.lit("segment").alias("field"), F.col("segment").alias("value")), F.struct(F.lit("region").alias("field"), F.col("region").alias("value")))).alias("e")).select("e.*").distinct()
    return plan.response_format(_records(s, d), pool)


@stated(f"""SELECT 'c_' || substr(sha256(concat_ws('|', 'beep', CAST(least(a, b) AS VARCHAR), CAST(greatest(a, b) AS VARCHAR))), 1, 16) AS composite_id, CASE WHEN {digest("'heard'", 'a')} <= {digest("'heard'", 'b')} THEN a || ',' || b ELSE b || ',' || a END AS components FROM (SELECT c_custkey AS a, c_custkey + 1 AS b FROM customer)""")
def q_composite_manifest(s, d):
    return plan.composite_manifest(table(s, d, "customer").select(F.col("c_custkey").alias("a"), (F.col("c_custkey") + 1).alias("b")), "beep")


@stated("SELECT o_orderkey, 'Which priority?' || chr(10) || chr(10) || 'A. ' || o_orderstatus || chr(10) || 'B. ' || o_orderpriority AS text FROM orders")
def q_mcq_text(s, d):
    return table(s, d, "orders").select("o_orderkey", plan.mcq_text(F.lit("Which priority?"), F.array("o_orderstatus", "o_orderpriority")).alias("text"))


@stated(f"""WITH t AS (SELECT c_custkey, c_name, c_mktsegment, c_custkey % 4 AS k FROM customer) SELECT c_custkey, CASE k WHEN 0 THEN 'Is ' || c_mktsegment || ' the segment?' WHEN 3 THEN CASE WHEN c_mktsegment <> 'BUILDING' THEN 'It is ' || c_mktsegment || '.' END END AS text,
  CASE k WHEN 0 THEN '' WHEN 1 THEN 'hidden_context_requested' WHEN 2 THEN 'undeclared_context_field' ELSE CASE WHEN c_mktsegment <> 'BUILDING' THEN '' ELSE 'missing_context_value' END END AS fault FROM t""")
def q_context_binding(s, d):
    k = F.col("c_custkey") % 4
    template = F.when(k == 0, "is  [CONTEXT:segment] the segment ?").when(k == 1, "is [CONTEXT:name] right?").when(k == 2, "in [CONTEXT:town]?").otherwise("it is [CONTEXT:segment].")
    segment = F.when((k != 3) | (F.col("c_mktsegment") != "BUILDING"), F.col("c_mktsegment"))
    text, fault = plan.bind_context(template, {"segment": segment, "name": F.col("c_name")}, {"segment": "visible", "name": "hidden"})
    return table(s, d, "customer").select("c_custkey", text.alias("text"), fault.alias("fault"))


@stated("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Give: (1) the text; (2) whether both are equal' || ' for ' || c_mktsegment || '.' WHEN c_custkey % 3 = 1 THEN 'Answer for ' || c_mktsegment || ' .'[2:] ELSE 'Give: (1) the text; (2) whether both are equal [UNIT].' END AS text,
  CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN 'missing_instruction:text;missing_instruction:same' ELSE 'missing_target;unresolved_slot' END AS issues FROM customer""")
def q_composite_wording(s, d):
    k = F.col("c_custkey") % 3
    pattern = F.when(k == 0, "give: [OUTPUTS] for [TARGET_VALUE] .").when(k == 1, "answer for [TARGET_VALUE].").otherwise("give: [OUTPUTS] [UNIT].")
    text, issues = plan.composite_wording(pattern, {"text": "the text", "same": "whether both are equal"}, F.col("c_mktsegment"))
    return table(s, d, "customer").select("c_custkey", text.alias("text"), issues.alias("issues"))


@stated("""SELECT o_orderkey, (o_orderkey % 3 = 0) AND (o_orderkey % 2 = 0) AS ambiguous FROM orders""")
def q_repeated_token(s, d):
    k = F.col("o_orderkey")
    sentence = F.when(k % 3 == 0, F.lit('The cat, "the" dog.')).otherwise(F.lit("A cat and the dog."))
    ordinal = F.when(k % 2 == 1, F.lit(2))
    return table(s, d, "orders").select("o_orderkey", audit.repeated_token(sentence, F.lit("The"), ordinal, F.lit("Which is number 2?")).alias("ambiguous"))


@stated(f"""WITH p AS (SELECT o_orderkey AS a, (o_orderkey + 4) % (SELECT count(*) FROM orders) AS b, o_orderkey % 10 < 5 AS same FROM orders), s AS (SELECT o_orderkey AS row_id, CASE WHEN {hash_int('o_orderkey')} % 10 < 8 THEN 'train' ELSE 'test' END AS split FROM orders WHERE o_orderkey % 50 <> 7),
  e AS (SELECT a AS row_id FROM p UNION ALL SELECT b FROM p) SELECT count(*) AS n_refs, count(*) FILTER (split <> 'train') AS outside, count(*) FILTER (split IS NULL) AS unknown FROM e LEFT JOIN s USING (row_id)""")
def q_split_isolation(s, d):
    o = table(s, d, "orders")
    n = o.agg(F.count("*").alias("n"))
    pairs = o.join(F.broadcast(n)).select(F.col("o_orderkey").alias("a"), F.pmod(F.col("o_orderkey") + 4, "n").alias("b"))
    splits = o.where("o_orderkey % 50 <> 7").select(F.col("o_orderkey").alias("row_id"), F.when(K.hash_int("o_orderkey") % 10 < 8, "train").otherwise("test").alias("split"))
    return audit.split_isolation(pairs, splits, "train")


def _neighborhood(s, d):
    from ..operators import pairs

    return pairs.neighborhood(table(s, d, "customer"), "c_custkey", "c_mktsegment", 2, 2)


@stated("""SELECT (SELECT count(*) FROM customer) AS anchors, (SELECT count(*) FROM customer) * 4 AS n, (SELECT count(*) FROM customer) * 2 AS n_same, (SELECT count(*) FROM customer) * 2 AS n_different, 0 AS anchors_off, 0 AS self_pairs, 0 AS repeated, 0 AS wrong_gold""")
def q_anchor_plan(s, d):
    groups = table(s, d, "customer").select(F.col("c_custkey").alias("row_id"), F.col("c_mktsegment").alias("grp"))
    return audit.anchor_plan(_neighborhood(s, d), groups, 2, 2)
