"""DuckDB statements whose rows the queries must equal."""

from __future__ import annotations


from . import assets, checks, queries, records, texts  # noqa: F401
from .oracle_capacity import CAPACITY as _CAPACITY
from .registry import ORACLES as _STATED
from .registry import audio as _audio
from .registry import digest as _digest
from .registry import hash_int as _hash_int
from .registry import spoken as _spoken


def _bucket(n: str) -> str:
    return f"CASE WHEN {n} <= 5 THEN '01-05' WHEN {n} <= 10 THEN '06-10' WHEN {n} <= 20 THEN '11-20' WHEN {n} <= 40 THEN '21-40' WHEN {n} <= 80 THEN '41-80' ELSE '81+' END"


_CN = "customer JOIN nation ON c_nationkey = n_nationkey"
_TOPIC = {"customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]}


def _neighborhood(same: int, different: int) -> str:
    return f"""
  WITH r AS (SELECT c_custkey AS id, c_mktsegment AS g, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {_digest('c_custkey')}, c_custkey) - 1 AS place FROM customer WHERE c_mktsegment IS NOT NULL),
  z AS (SELECT g, count(*) AS m FROM r GROUP BY g),
  st AS (SELECT g, m, sum(m) OVER (ORDER BY {_digest('g')}, g) - m AS first, sum(m) OVER () AS n, max(m) OVER () AS largest FROM z),
  c AS (SELECT id, g, place, m, n, largest, first + place AS at FROM r JOIN st USING (g)),
  p AS (
    SELECT x.id AS a, y.id AS b, true AS same FROM c x, range(1, {same} + 1) k(i), c y WHERE x.m >= 2 * {same} + 1 AND y.g = x.g AND y.place = (x.place + k.i) % x.m
    UNION ALL
    SELECT x.id, y.id, false FROM c x, range({different}) k(i), c y WHERE 2 * (x.largest + {different} - 1) < x.n AND y.at = (x.at + x.largest + k.i) % x.n)
"""


_SELECTION = _neighborhood(1, 1) + f"""
  SELECT CASE WHEN f THEN a ELSE b END AS row_a, CASE WHEN f THEN b ELSE a END AS row_b, CASE WHEN f THEN 'A' ELSE 'B' END AS answer, a AS anchor
  FROM (SELECT *, {_hash_int('a')} % 2 = 0 AS f FROM p WHERE NOT same)"""
_TEMPLATE = f"SELECT o_orderkey AS row_id, CAST({_hash_int(chr(39) + 'template' + chr(39), 'o_orderkey')} % 7 AS INTEGER) AS template FROM orders"
_DEP = """SELECT count(*) AS n_sources, CAST(sum((n >= 2)::INT) AS BIGINT) AS n_reusable, CAST(sum((t > 1)::INT) AS BIGINT) AS n_violations,
  sum((t > 1)::INT) = 0 AND sum((n >= 2)::INT) > 0 AS holds, '{1}' AS relation FROM (SELECT count(*) AS n, count(DISTINCT n_regionkey) AS t FROM """ + _CN + " GROUP BY {0})"
_KEYED = f"SELECT doc_id, text, lang, source, sha256({_spoken('text')}) AS k FROM documents WHERE text IS NOT NULL"

_BANDED = "b AS (SELECT p_size, CAST(CASE WHEN p_partkey % 5 = 0 THEN p_partkey % 4 ELSE least(3, p_size // 13) END AS INTEGER) AS rank FROM part)"


ORACLES: dict[str, str] = {
    "q_profile_table": " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS field, count(*) AS n, CAST(sum(({c} IS NULL)::INT) AS BIGINT) AS n_missing, count(DISTINCT {c}) AS n_distinct FROM {t}" for t, cs in _TOPIC.items() for c in cs),
    "q_missing_normalize": "SELECT user_id, count(*) AS n, count(v) AS n_present, count(DISTINCT v) AS n_kinds FROM (SELECT user_id, CASE WHEN lower(trim(event_type)) IN ('error', 'none', '') THEN NULL ELSE event_type END AS v FROM events) GROUP BY user_id",
    "q_textnorm_ascii": f"SELECT doc_id, sha256({_spoken('text')}) AS text_key, {_audio('docs', 'doc_id')} AS audio_id FROM documents",
    "q_field_dependency": _DEP.format("n_nationkey", "nation->region") + " UNION ALL " + _DEP.format("c_mktsegment", "segment->region"),
    "q_group_conflict": "SELECT o_custkey, count(*) AS n_rows, count(DISTINCT o_orderstatus) AS n_values, count(DISTINCT o_orderstatus) > 1 AS conflict FROM orders GROUP BY 1",
    "q_comparator_collision": f"SELECT {_spoken('p_name')} AS norm, count(*) AS n, count(DISTINCT p_name) AS n_raw, count(DISTINCT p_type) AS n_types FROM part GROUP BY 1",
    "q_group_shortcut": "SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN k = 1 THEN n ELSE 0 END) AS BIGINT) AS n_implied, round(sum(CASE WHEN k = 1 THEN n ELSE 0 END) / sum(n), 6) AS rate FROM (SELECT count(*) AS n, count(DISTINCT o_orderstatus) AS k FROM orders GROUP BY o_custkey)",
    "q_contingency": f"SELECT n_regionkey, c_mktsegment, count(*) AS n, count(DISTINCT c_nationkey) AS n_nations FROM {_CN} GROUP BY 1, 2",
    "q_entropy_info": """SELECT CAST(n AS BIGINT) AS n, classes, round(h, 6) AS entropy, round(h / log2(classes), 6) AS normalized, round(pow(2.0, h), 6) AS effective, round(most / n, 6) AS majority, least * classes AS balanced
      FROM (SELECT sum(c) AS n, count(*) AS classes, max(c) AS most, min(c) AS least, log2(sum(c)) - sum(c * log2(c)) / sum(c) AS h FROM (SELECT count(*) AS c FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment))""",
    "q_hist_audit": f"SELECT lang, {_bucket('w')} AS bucket, count(*) AS n, CAST(sum(regexp_matches(text, '[0-9]')::INT) AS BIGINT) AS n_digits, CAST(sum(length(text)) AS BIGINT) AS chars FROM (SELECT lang, text, len(string_split({_spoken('text')}, ' ')) AS w FROM documents WHERE text IS NOT NULL) GROUP BY 1, 2",
    "q_capacity_all": _CAPACITY,
    "q_capacity_topology": "SELECT v AS value, p, p * (p - 1) // 2 AS both, CAST((n - p) * (n - p - 1) // 2 AS BIGINT) AS neither, CAST(p * (n - p) AS BIGINT) AS valid FROM (SELECT c_mktsegment AS v, count(*) AS p, sum(count(*)) OVER () AS n FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1)",
    "q_neighborhood_feasible": "SELECT v AS value, m, m * (m - 1) // 2 >= 4 * m AS same_ok, 2 * (l + 3) < n AS different_ok FROM (SELECT o_orderpriority AS v, count(*) AS m, sum(count(*)) OVER () AS n, max(count(*)) OVER () AS l FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1)",
    "q_budget_equal": f"SELECT field AS name, CAST(least(share, direct) AS BIGINT) AS budget, share > direct AS capped FROM (SELECT field, direct, 10000 // k + (i < 10000 % k)::INT AS share FROM (SELECT field, direct, count(*) OVER () AS k, row_number() OVER (ORDER BY field) - 1 AS i FROM ({_CAPACITY})))",
    "q_direct_roundrobin": f"SELECT c_custkey AS row_id, c_mktsegment AS value, CAST(turn AS INTEGER) AS turn FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {_digest('c_custkey')}, c_custkey) AS turn FROM customer WHERE c_mktsegment IS NOT NULL) ORDER BY turn, value LIMIT 200",
    "q_pairs_positive": "SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey",
    "q_pairs_neighborhood": _neighborhood(2, 2) + "SELECT a, b, same FROM p",
    "q_pairwise_selection": _SELECTION,
    "q_circular_next": "SELECT s_suppkey, coalesce(lead(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey), min(s_suppkey) OVER (PARTITION BY s_nationkey)) AS next FROM supplier",
    "q_reference_match": f"WITH k AS ({_KEYED}), f AS (SELECT k, min(doc_id) AS r, arg_min(text, doc_id) AS t FROM k GROUP BY k) SELECT doc_id, r AS reference_id, CASE WHEN text = t THEN 'RAW_EQUAL' WHEN lower(text) = lower(t) THEN 'CASE_ONLY' ELSE 'PUNCTUATION_OR_SPACE' END AS difference FROM k JOIN f USING (k) WHERE doc_id <> r",
    "q_mcq_distractors_fixed": f"""WITH g AS (SELECT c_custkey AS id, r_name AS gold FROM {_CN} JOIN region ON n_regionkey = r_regionkey),
      w AS (SELECT id, gold, r_name AS x, row_number() OVER (PARTITION BY id ORDER BY {_digest("'wrong'", 'id', 'r_name')}) AS n FROM g JOIN region ON r_name <> gold),
      a AS (SELECT id, gold, x FROM w WHERE n <= 3 UNION ALL SELECT id, gold, gold FROM g),
      o AS (SELECT id, gold, list(x ORDER BY {_digest("'order'", 'id', 'x')}) AS c FROM a GROUP BY id, gold)
      SELECT id AS row_id, gold AS answer, array_to_string(c, '|') AS choices, CAST(list_position(c, gold) - 1 AS BIGINT) AS position FROM o""",
    "q_template_hash": _TEMPLATE,
    "q_hash_topk_nested": f"SELECT l_returnflag, l_orderkey, l_linenumber, CAST(n AS INTEGER) AS n FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {_digest('l_orderkey', 'l_linenumber')}, l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n <= 50",
    "q_rank_first_usable": f"SELECT c_nationkey, arg_min(c_custkey, {_digest('c_custkey')}) AS c_custkey, count(*) AS n_usable FROM customer WHERE c_acctbal >= 0 GROUP BY 1",
    "q_contamination": "SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)",
    "q_dup_conflict": f"SELECT k AS text_key, count(*) AS n, count(DISTINCT source) AS n_labels, min(doc_id) AS first_id, count(DISTINCT source) > 1 AS conflict FROM ({_KEYED}) GROUP BY k HAVING count(*) > 1",
    "q_terminal_class": f"SELECT class, count(*) AS n FROM (SELECT CASE WHEN e AND t THEN 'RESERVED_OVERLAP' WHEN e THEN 'RESERVED' WHEN v AND t THEN 'VAL_OVERLAP' WHEN v THEN 'VAL_ONLY' ELSE 'CLEAN_TRAIN' END AS class FROM (SELECT bool_or(s < 8) AS t, bool_or(s = 8) AS v, bool_or(s = 9) AS e FROM (SELECT o_custkey, {_hash_int('o_orderkey')} % 10 AS s FROM orders) GROUP BY o_custkey)) GROUP BY 1",
    "q_cross_split_overlap": f"WITH x AS (SELECT DISTINCT k, source FROM ({_KEYED}) WHERE source IS NOT NULL) SELECT p.source AS a, q.source AS b, count(*) AS n_texts FROM x p JOIN x q ON p.k = q.k AND p.source < q.source GROUP BY 1, 2",
    "q_vocab_seen_unseen": f"WITH w AS (SELECT lang, ({_hash_int('doc_id')} % 10 < 8)::INT AS train, unnest(string_split({_spoken('text')}, ' ')) AS w FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL), p AS (SELECT lang, w, sum(train) AS t, sum(1 - train) AS o FROM w WHERE w <> '' GROUP BY 1, 2 HAVING sum(1 - train) > 0) SELECT lang, count(*) AS types, CAST(sum((t = 0)::INT) AS BIGINT) AS unseen_types, CAST(sum(o) AS BIGINT) AS occurrences, CAST(sum(CASE WHEN t = 0 THEN o ELSE 0 END) AS BIGINT) AS unseen_occurrences FROM p GROUP BY lang",
    "q_interval_overlap": "SELECT user_id, count(*) AS n, CAST(sum(coalesce((g < 3600)::INT, 0)) AS BIGINT) AS n_overlaps FROM (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) - lag(CAST(floor(epoch(ts)) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events) GROUP BY 1",
    "q_calibrate_boundary": """WITH p AS (SELECT p_retailprice AS v, sum((p_size <= 20)::INT) AS lo, sum((p_size > 20)::INT) AS hi FROM part GROUP BY 1),
      r AS (SELECT v, sum(lo) OVER w + sum(hi) OVER () - sum(hi) OVER w AS r, sum(lo + hi) OVER () AS n FROM p WINDOW w AS (ORDER BY v ROWS UNBOUNDED PRECEDING))
      SELECT v AS boundary, CAST(r AS BIGINT) AS "right", CAST(n AS BIGINT) AS n, round(r / n, 6) AS accuracy FROM r ORDER BY r DESC, v LIMIT 1""",
    "q_classify": "WITH d(class) AS (VALUES ('slow'), ('medium'), ('fast'), ('very fast')), c AS (SELECT CASE WHEN l_quantity < 10 THEN 'slow' WHEN l_quantity < 25 THEN 'medium' WHEN l_quantity < 60 THEN 'fast' ELSE 'very fast' END AS class, count(*) AS c FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1) SELECT class, coalesce(c, 0) AS n FROM d LEFT JOIN c USING (class)",
    "q_audit_plan": _neighborhood(2, 2) + """, j AS (SELECT p.*, x.c_mktsegment AS ga, y.c_mktsegment AS gb FROM p JOIN customer x ON x.c_custkey = a JOIN customer y ON y.c_custkey = b)
      SELECT count(*) AS n, CAST(sum(((ga = gb) <> same)::INT) AS BIGINT) AS wrong_gold, CAST(sum((a = b)::INT) AS BIGINT) AS self_pairs, (SELECT CAST(sum((k > 1)::INT) AS BIGINT) FROM (SELECT count(*) AS k FROM j GROUP BY least(a, b), greatest(a, b))) AS repeated FROM j""",
    "q_dependency_manifest": _neighborhood(2, 2) + f"SELECT {_audio('customer', 'r')} AS audio_id, count(*) AS n_refs FROM (SELECT a AS r FROM p UNION ALL SELECT b FROM p) GROUP BY r",
    "q_union_release": f"SELECT *, row_number() OVER (ORDER BY {_digest(chr(39) + 'union' + chr(39), 'id')}, id) - 1 AS place FROM (SELECT 'o' || row_id AS id, 'DIRECT' AS operator, CAST(template AS VARCHAR) AS answer FROM ({_TEMPLATE}) UNION ALL SELECT 'c' || anchor, 'SELECTION', answer FROM ({_SELECTION}))",
    "q_json_props": "SELECT event_type, count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_k, min(k) AS min_k, max(k) AS max_k FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY 1",
    "q_class_boundaries": f"WITH {_BANDED}, c AS (SELECT rank, min(p_size) AS a, max(p_size) AS z FROM b GROUP BY 1), l AS (SELECT rank, z AS low_most, lead(a) OVER (ORDER BY rank) AS high_least FROM c) SELECT *, high_least - low_most AS gap, high_least > low_most AS clean, round((low_most + high_least) / 2, 6) AS midpoint FROM l WHERE high_least IS NOT NULL",
    "q_monotonicity": f"WITH {_BANDED}, v AS (SELECT DISTINCT p_size, rank FROM b), l AS (SELECT lag(rank) OVER (ORDER BY p_size, rank) > rank AS f FROM v) SELECT (SELECT count(*) FROM v) AS n_pairs, (SELECT count(*) FROM l WHERE f) AS n_inversions, (SELECT count(*) FROM (SELECT p_size FROM v GROUP BY 1 HAVING count(*) > 1)) AS n_conflicts",
    "q_search3": f"""WITH {_BANDED}, v AS (SELECT DISTINCT p_size AS v FROM b), t AS (SELECT min(v) - 1.0::DOUBLE AS t FROM v UNION ALL SELECT coalesce((v + lead(v) OVER (ORDER BY v)) / 2, v + 1.0::DOUBLE) FROM v),
      p AS (SELECT t, count(*) FILTER (rank = 0 AND p_size < t) AS p0, count(*) FILTER (rank = 1 AND p_size < t) AS p1, count(*) FILTER (rank = 2 AND p_size < t) AS p2, count(*) FILTER (rank = 3 AND p_size >= t) AS q3, count(*) AS n FROM t, b GROUP BY t)
      SELECT i.t AS t1, j.t AS t2, k.t AS t3, i.p0 + j.p1 - i.p1 + k.p2 - j.p2 + k.q3 AS "right", i.n AS n, round((i.p0 + j.p1 - i.p1 + k.p2 - j.p2 + k.q3) / i.n, 6) AS accuracy
      FROM p i JOIN p j ON i.t < j.t JOIN p k ON j.t < k.t ORDER BY "right" DESC, t1, t2, t3 LIMIT 1""",
    "q_leakage": r"""SELECT source, count(*) AS n, count(*) FILTER (contains(lower(text), lower(source))) AS label_leaks, count(*) FILTER (regexp_matches(lower(text), '(^|\s)(/[a-z]|[a-z]:\\)[^\s]*')) AS path_leaks, count(*) FILTER (regexp_matches(lower(text), 'https?://')) AS url_leaks FROM documents WHERE text IS NOT NULL GROUP BY 1""",
}
ORACLES["q_audit_mcq"] = f"""WITH m AS ({ORACLES['q_mcq_distractors_fixed']}), s AS (SELECT 'sound' AS of, * FROM m UNION ALL SELECT 'faulty', row_id, CASE WHEN row_id % 11 = 0 THEN 'NOWHERE' ELSE answer END, choices, CASE WHEN row_id % 7 = 0 THEN (position + 1) % 4 ELSE position END FROM (SELECT row_id, answer, choices, position FROM m UNION ALL SELECT row_id, answer, choices, position FROM m WHERE row_id % 100 = 0)),
  c AS (SELECT *, string_split(choices, '|') AS l FROM s), i AS (SELECT of, count(*) AS repeated_ids FROM (SELECT of, row_id FROM s GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1)
  SELECT c.of, count(*) AS n, count(*) FILTER (NOT list_contains(l, answer)) AS answer_missing, count(*) FILTER (len(list_distinct(l)) < len(l)) AS repeated_choices, count(*) FILTER (l[position + 1] IS DISTINCT FROM answer) AS wrong_gold, coalesce(any_value(i.repeated_ids), 0) AS repeated_ids FROM c LEFT JOIN i ON c.of = i.of GROUP BY c.of"""

_N_WORDS = r"len(regexp_split_to_array(trim(text), '\s+'))"
ORACLES["q_percentiles"] = " UNION ALL ".join(
    f"""SELECT l_returnflag, CAST({q} AS DOUBLE) AS point, n, round(v[1 + CAST(round_even({q}::DOUBLE * (n - 1), 0) AS BIGINT)], 6) AS nearest, round(v[CAST(ceil({q}::DOUBLE * n) AS BIGINT)], 6) AS ceiled, round(c, 5) AS linear, round(v[1 + n // 2], 6) AS middle
    FROM (SELECT l_returnflag, count(*) AS n, list_sort(list(l_extendedprice)) AS v, quantile_cont(l_extendedprice, {q}) AS c FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1)"""
    for q in (0.01, 0.05, 0.5, 0.95, 0.99)
)
ORACLES["q_distribution"] = "SELECT l_returnflag, count(l_extendedprice) AS n, round(min(l_extendedprice), 6) AS least, round(max(l_extendedprice), 6) AS most, round(avg(l_extendedprice), 4) AS mean, round(stddev_pop(l_extendedprice), 4) AS dev FROM lineitem GROUP BY 1"


def _tiers(source: str, key: str, speaker: str, tiers: list[list[str]]) -> str:
    """CTEs neg(a, b, tier) of rows with a partner of another speaker, from the definition: the speakers of a tier's group in
    hash order, one of the others by the row's hash, and a row of it by another hash."""
    out = [f"src AS (SELECT * FROM {source} WHERE {speaker} IS NOT NULL)"]
    for i, cols in enumerate(tiers):
        by = ", ".join([*cols, speaker])
        over = f"PARTITION BY {', '.join(cols)} " if cols else ""
        ok = " AND ".join([f"{c} IS NOT NULL" for c in cols] or ["true"])
        same = " AND ".join([f"s.{c} = x.{c}" for c in cols] or ["true"])
        here = " AND ".join(f"p.{c} = s.{c}" for c in [*cols, speaker])
        out += [
            f"p{i} AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {_digest(key)}, {key}) - 1 AS at FROM src WHERE {ok})",
            f"s{i} AS (SELECT *, row_number() OVER ({over}ORDER BY {_digest(speaker)}, {speaker}) - 1 AS turn, count(*) OVER ({over}) AS k FROM (SELECT {by}, count(*) AS size FROM p{i} GROUP BY {by}))",
            f"x{i} AS (SELECT p.*, s.turn, s.k FROM p{i} p JOIN s{i} s ON {here} WHERE s.k > 1)",
            f"n{i} AS (SELECT x.{key} AS a, p.{key} AS b FROM x{i} x JOIN s{i} s ON {same} AND s.turn = (x.turn + 1 + {_hash_int(chr(39) + 'speaker' + chr(39), str(i), 'x.' + key)} % (x.k - 1)) % x.k JOIN p{i} p ON {here} AND p.at = {_hash_int(chr(39) + 'row' + chr(39), str(i), 'x.' + key)} % s.size)",
        ]
    joins = " ".join(f"LEFT JOIN n{i} ON n{i}.a = src.{key}" for i in range(len(tiers)))
    case = " ".join(f"WHEN n{i}.b IS NOT NULL THEN {i}" for i in range(len(tiers)))
    return ", ".join([*out, f"neg AS (SELECT src.{key} AS a, coalesce({', '.join(f'n{i}.b' for i in range(len(tiers)))}) AS b, CASE {case} END AS tier FROM src {joins})"])


ORACLES["q_negative_tiered"] = f"WITH {_tiers(_CN, 'c_custkey', 'c_nationkey', [['n_regionkey', 'c_mktsegment'], ['n_regionkey'], []])} SELECT a, b, tier FROM neg"
_VERIFY = f"""WITH {_tiers('orders JOIN customer ON o_custkey = c_custkey', 'o_orderkey', 'o_custkey', [['c_nationkey', 'c_mktsegment'], ['c_nationkey'], []])},
  r AS (SELECT o_orderkey AS id, o_custkey AS w, row_number() OVER (PARTITION BY o_custkey ORDER BY {_digest('o_orderkey')}, o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_custkey) AS m FROM src),
  same AS (SELECT x.id AS a, y.id AS b FROM r x JOIN r y ON y.w = x.w AND y.i = (x.i + 1) % x.m WHERE x.m > 2 OR (x.m = 2 AND x.i = 0)),
  other AS (SELECT a, b, tier FROM (SELECT neg.*, row_number() OVER (PARTITION BY least(neg.a, neg.b), greatest(neg.a, neg.b) ORDER BY neg.a) AS k FROM neg JOIN same ON same.a = neg.a WHERE neg.b IS NOT NULL) WHERE k = 1),
  p AS (SELECT a, b, true AS same, NULL::INTEGER AS tier FROM same UNION ALL SELECT a, b, false, tier FROM other)
"""
ORACLES["q_verification_plan"] = _VERIFY + "SELECT a, b, same, tier FROM p"
ORACLES["q_plan_shortfall"] = _VERIFY + "SELECT count(*) FILTER (same) AS n_same, count(*) FILTER (NOT same) AS n_different, count(*) FILTER (same) - count(*) FILTER (NOT same) AS shortfall FROM p"
ORACLES["q_most_used"] = _VERIFY + ", u AS (SELECT a AS r FROM p UNION ALL SELECT b FROM p) SELECT r AS row_id, count(*) AS n_refs FROM u GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
ORACLES["q_reuse_stats"] = _neighborhood(2, 2) + """, u AS (SELECT count(*) AS k FROM (SELECT a AS r FROM p UNION ALL SELECT b FROM p) GROUP BY r), l AS (SELECT list_sort(list(k)) AS l, count(*) AS n FROM u)
  SELECT count(*) AS n_rows, min(k) AS least, max(k) AS most, round(avg(k), 6) AS mean, (SELECT l[1 + n // 2] FROM l) AS median, (SELECT l[CAST(ceil(n * 0.95) AS BIGINT)] FROM l) AS p95 FROM u"""
ORACLES["q_target_match"] = f"""WITH d AS (SELECT v, length(v) AS len, row_number() OVER (ORDER BY length(v), {_digest('v')}, v) - 1 AS pos, count(*) OVER () AS size FROM (SELECT DISTINCT p_type AS v FROM part WHERE p_type IS NOT NULL)),
  f AS (SELECT x.v, x.pos, x.size, min(y.pos) AS lo, max(y.pos) + 1 AS hi FROM d x JOIN d y ON y.len / x.len BETWEEN 0.6 AND 1.67 GROUP BY ALL),
  g AS (SELECT v, pos, CASE WHEN hi - lo > 1 THEN lo ELSE 0 END AS lo, CASE WHEN hi - lo > 1 THEN hi - lo ELSE size END AS n, hi - lo <= 1 AS fallback FROM f)
  SELECT p_partkey AS row_id, p_type AS positive, d.v AS negative, g.fallback FROM part JOIN g ON g.v = p_type AND g.n > 1 JOIN d ON d.pos = g.lo + (g.pos - g.lo + 1 + {_hash_int('p_partkey')} % (g.n - 1)) % g.n"""
ORACLES["q_mcq_distractors_bucket"] = f"""WITH r AS (SELECT doc_id, sha256({_spoken('text')}) AS k, {_bucket(_N_WORDS)} AS bucket FROM documents WHERE text IS NOT NULL),
  p AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY k) - 1 AS ord, count(*) OVER (PARTITION BY b) AS size FROM (SELECT k, min(doc_id) AS other, arg_min(bucket, doc_id) AS b FROM r GROUP BY k)),
  names(o, i) AS (VALUES ('01-05', 0), ('06-10', 1), ('11-20', 2), ('21-40', 3), ('41-80', 4), ('81+', 5)), z AS (SELECT b, count(*) AS n FROM p GROUP BY b),
  w AS (SELECT x.o AS own, z.b, z.n, row_number() OVER (PARTITION BY x.o ORDER BY abs(x.i - y.i), z.b) - 1 AS turn FROM names x, z JOIN names y ON y.o = z.b),
  t AS (SELECT *, coalesce(sum(n - 1) OVER (PARTITION BY own ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sure FROM w),
  m AS (SELECT r.doc_id, t.turn, j, p.other FROM r JOIN t ON t.own = r.bucket AND t.sure < 3, range(4) s(j) JOIN p ON p.b = t.b AND p.ord = ({_hash_int('r.doc_id', 't.b')} + j) % t.n WHERE j < least(t.n, 4) AND p.k <> r.k)
  SELECT doc_id, CAST(n AS INTEGER) AS n, other AS distractor FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY turn, j) AS n FROM m) WHERE n <= 3"""
ORACLES["q_template_balanced"] = f"WITH b AS (SELECT o_orderkey AS row_id, (row_number() OVER (ORDER BY {_digest('o_orderkey')}, o_orderkey) - 1) // 5 AS block FROM orders) SELECT row_id, block, CAST(row_number() OVER (PARTITION BY block ORDER BY {_digest(chr(39) + 'turn' + chr(39), 'row_id')}, row_id) - 1 AS INTEGER) AS template FROM b"
ORACLES["q_mcq_composite"] = f"""WITH pool AS (SELECT sha256({_spoken('text')}) AS k, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY 1),
  o AS (SELECT doc_id, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS z FROM pool),
  m AS (SELECT x.doc_id AS a, CASE WHEN {_hash_int("'same'", 'x.doc_id')} % 2 = 0 THEN x.doc_id ELSE y.doc_id END AS b, w.doc_id AS t, {_hash_int("'same'", 'x.doc_id')} % 2 = 0 AS same
    FROM o x JOIN o y ON y.i = (x.i + 1) % x.z JOIN o w ON w.i = (x.i + 2) % x.z WHERE x.z >= 3),
  c AS (SELECT a, b, same, concat_ws(',', a, b, same) AS answer, unnest([concat_ws(',', a, b, same), concat_ws(',', a, b, NOT same), concat_ws(',', a, t, same), concat_ws(',', t, b, same)]) AS x FROM m),
  l AS (SELECT a, b, same, answer, list(x ORDER BY {_digest("'order'", 'a', 'x')}) AS c FROM c GROUP BY 1, 2, 3, 4)
  SELECT a, b, same, answer, array_to_string(c, '|') AS choices, list_position(c, answer)::BIGINT - 1 AS position FROM l"""


def _classes(rows: str) -> str:
    return f"""WITH j AS ({rows}), u AS (SELECT g, count(*) AS support, count(*) FILTER (s = g) AS r FROM j WHERE g IS NOT NULL GROUP BY 1), v AS (SELECT s, count(*) AS n FROM j WHERE g IS NOT NULL GROUP BY 1),
  w AS (SELECT u.*, coalesce(v.n, 0) AS said, CASE WHEN coalesce(v.n, 0) > 0 THEN r / v.n ELSE 0.0 END AS p, r / support AS q FROM u LEFT JOIN v ON v.s = u.g),
  c AS (SELECT g AS label, support, said, r AS "right", round(p, 6) AS precision, round(q, 6) AS recall, round(CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0.0 END, 6) AS f1 FROM w)
"""


_SAID = "SELECT source AS g, CASE WHEN source = 'src9' THEN NULL WHEN n_chars % 7 < 3 THEN source WHEN n_chars % 7 < 5 THEN 'src1' WHEN n_chars % 7 = 5 THEN 'elsewhere' END AS s FROM documents"
ORACLES["q_eval_confusion"] = _classes("SELECT quality AS g, (n_chars >= 1000)::INT AS s FROM labels JOIN documents USING (doc_id)") + "SELECT * FROM c"
ORACLES["q_eval_classes"] = _classes(_SAID) + "SELECT * FROM c"
ORACLES["q_eval_summary"] = _classes(_SAID) + "SELECT count(*) AS n, count(*) FILTER (s = g) AS right, round(count(*) FILTER (s = g) / count(*), 6) AS accuracy, (SELECT round(avg(f1), 5) FROM c) AS macro_f1, count(*) FILTER (s IS NULL) AS unread, round(count(*) FILTER (s IS NULL) / count(*), 6) AS unread_rate FROM j".replace("AS right,", 'AS "right",')
ORACLES["q_eval_matrix"] = f"SELECT g AS gold, coalesce(s, 'UNREAD') AS said, count(*) AS n FROM ({_SAID}) GROUP BY 1, 2"
ORACLES["q_eval_answers"] = """WITH g AS (SELECT o_orderkey % 6 AS k, CASE WHEN contains(o_orderpriority, '-') THEN string_split(o_orderpriority, '-')[-1] ELSE o_orderpriority END AS gold FROM orders)
  SELECT gold, said, how, count(*) AS n FROM (SELECT gold, CASE WHEN k IN (0, 1) AND gold IN ('LOW', 'HIGH', 'URGENT', 'MEDIUM') THEN gold WHEN k = 2 THEN 'HIGH' END AS said,
    CASE WHEN k = 0 AND gold IN ('LOW', 'HIGH', 'URGENT', 'MEDIUM') THEN 'exact' WHEN k = 1 AND gold IN ('LOW', 'HIGH', 'URGENT', 'MEDIUM') THEN 'contained' WHEN k = 2 THEN 'letter' ELSE 'unread' END AS how FROM g) GROUP BY 1, 2, 3"""
_DG = _digest("'indexed'", "row_id")
ORACLES["q_alternating_sample"] = f"SELECT row_id, CASE WHEN i % 2 = 0 THEN positive ELSE negative END AS target, i % 2 = 0 AS gold, CASE WHEN i // 2 % 2 = 0 THEN 'A' ELSE 'B' END AS side FROM (SELECT *, row_number() OVER (ORDER BY {_DG}, row_id) - 1 AS i FROM ({ORACLES['q_target_match']})) WHERE i < 100"
_NEXT = _hash_int("'next'", "doc_id")
ORACLES["q_external_split"] = rf"""WITH k AS (SELECT doc_id, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS g, CASE doc_id % 3 WHEN 0 THEN '  ' || text WHEN 1 THEN text || '.' ELSE '' END AS r FROM documents WHERE text IS NOT NULL),
  z AS (SELECT count(*) AS m FROM k GROUP BY g), t AS (SELECT count(*) AS n FROM k), p AS (SELECT sum(CASE WHEN m > 2 THEN m WHEN m = 2 THEN 1 ELSE 0 END)::BIGINT AS p, 2 * max(m) < sum(m) AS ok FROM z),
  e AS (SELECT 'TRANSCRIBE' AS type, 'text' AS gold, n FROM t UNION ALL SELECT 'REFERENCE_MATCH', (g = trim(regexp_replace(lower(r), '\s+', ' ', 'g')))::VARCHAR, count(*) FROM k GROUP BY 2 UNION ALL SELECT 'PAIR_EQUALITY', 'true', p FROM p UNION ALL SELECT 'PAIR_EQUALITY', 'false', n - p FROM p, t WHERE ok UNION ALL SELECT 'SELECTION', CASE WHEN {_NEXT} % 2 = 0 THEN 'A' ELSE 'B' END, count(*) FROM k GROUP BY 2)
  SELECT type, gold, n, n AS n_sets FROM e"""
_DP = _digest("'preview'", "a", "b")
ORACLES["q_preview_pairs"] = _VERIFY + f", m AS (SELECT p.a, p.b, p.same, x.o_orderstatus = y.o_orderstatus AS eq, {_DP} AS h FROM p JOIN orders x ON x.o_orderkey = p.a JOIN orders y ON y.o_orderkey = p.b) SELECT same, eq AS equal, arg_min(a, h) AS a, arg_min(b, h) AS b FROM m GROUP BY 1, 2"
ORACLES.update(_STATED)
