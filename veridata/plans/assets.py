"""Queries of asset accounts, id resolution, eligibility, samples and thresholds.

Orders stand for rows of two splits (by a hash of their key), customers for assets and speakers, the leading digit of the
priority for a number as text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import parsing as P
from ..functions import text as T
from ..operators import assets, profile, samples
from ..operators.terms import total
from ..sources.readers import table
from .registry import audio, count_if, digest, hash_int, query, spoken, stated


def _orders(s, d):
    h = K.hash_int("o_orderkey") % 20
    raw = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.concat(F.lit(" "), F.ceil(F.col("o_custkey") % 7 + F.when(h == 0, 1).otherwise(0)).cast("string"), F.when(h < 10, ".0").otherwise("")))
    asset = F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey"))
    return table(s, d, "orders").select("o_orderkey", asset.alias("asset"), raw.alias("raw"), "o_orderpriority", "o_orderstatus", F.when(h < 19, "train").otherwise("val").alias("split"))


def _split(s, d):
    o = _orders(s, d)
    return o.where("split = 'train'"), o.where("split = 'val'")


def _reserved(s, d):
    return table(s, d, "customer").where("c_custkey % 13 = 0").select(F.col("c_custkey").alias("asset"))


_O = f"""o AS (SELECT o_orderkey, CASE WHEN o_custkey % 11 <> 0 THEN o_custkey END AS asset, CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE ' ' || (o_custkey % 7 + (h = 0)::INT) || CASE WHEN h < 10 THEN '.0' ELSE '' END END AS raw, o_orderpriority, o_orderstatus,
    CASE WHEN h < 19 THEN 'train' ELSE 'val' END AS split FROM (SELECT *, {hash_int('o_orderkey')} % 20 AS h FROM orders)),
  x AS (SELECT *, CASE WHEN TRY_CAST(trim(raw) AS DECIMAL(38, 18)) > 0 THEN TRY_CAST(trim(raw) AS DECIMAL(38, 18)) END AS v FROM o),
  res AS (SELECT c_custkey AS asset FROM customer WHERE c_custkey % 13 = 0)"""
_INV = (
    _O
    + """,
  g AS (SELECT asset, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val, asset IN (SELECT asset FROM res) AS reserved, count(DISTINCT v) FILTER (split = 'train') AS k, bool_or(v IS NULL) FILTER (split = 'train') AS bad,
    count(DISTINCT o_orderpriority) FILTER (split = 'train') > 1 OR count(DISTINCT o_orderstatus) FILTER (split = 'train') > 1 AS differs, min(o_orderkey) FILTER (split = 'train') AS first_row FROM x WHERE asset IS NOT NULL GROUP BY asset),
  inv AS (SELECT asset, n_train, n_val, reserved, n_train > 0 AND (bad OR k > 1) AS conflict, n_val = 0 AND n_train > 1 AND differs AS metadata_differs,
    CASE WHEN n_val > 0 THEN 'VAL_RESERVED' WHEN reserved THEN 'RESERVED' WHEN n_train > 0 AND (bad OR k > 1) THEN 'CONFLICT' ELSE 'CLEAN' END AS status, first_row FROM g)"""
)


def _inventory(s, d):
    train, val = (assets.members(x, "asset", "o_orderkey", "raw", ["o_orderpriority", "o_orderstatus"]) for x in _split(s, d))
    return assets.inventory(train, val, _reserved(s, d))


@stated(f"WITH {_INV} SELECT * FROM inv")
def q_asset_inventory(s, d):
    return _inventory(s, d)


@stated(f"WITH {_INV} SELECT disposition, count(*) AS n, CAST(sum(row) AS BIGINT) AS rows FROM (SELECT o_orderkey AS row, CASE WHEN status = 'CLEAN' THEN CASE WHEN o_orderkey = first_row THEN 'KEPT_CANONICAL' ELSE 'COLLAPSED_DUPLICATE' END ELSE 'EXCLUDED_' || status END AS disposition FROM o JOIN inv USING (asset) WHERE split = 'train') GROUP BY 1")
def q_row_disposition(s, d):
    return assets.dispositions(_split(s, d)[0], _inventory(s, d), "asset", "o_orderkey").groupBy("disposition").agg(F.count("*").alias("n"), F.sum("row").alias("rows"))


@stated(f"""WITH {_INV}, t AS (SELECT *, n_train > 0 AND n_val = 0 AS solo FROM inv), sm AS (SELECT count(*) AS assets, {count_if('n_train > 0', 'train_assets')}, {count_if('n_val > 0', 'val_assets')}, {count_if('n_train > 0 AND n_val > 0', 'both')}, {count_if('solo', 'train_only')}, {count_if('solo AND n_train = 1', 'single')}, {count_if('solo AND conflict', 'conflicting')}, {count_if('solo AND NOT conflict AND n_train > 1', 'consistent_repeats')},
  CAST(coalesce(sum(n_train) FILTER (n_train > 0 AND n_val > 0), 0) AS BIGINT) AS rows_other_split, CAST(coalesce(sum(n_train) FILTER (solo AND conflict), 0) AS BIGINT) AS rows_conflict, CAST(coalesce(sum(n_train - 1) FILTER (solo AND NOT conflict), 0) AS BIGINT) AS rows_collapsed, CAST(coalesce(sum(n_train) FILTER (solo AND reserved), 0) AS BIGINT) AS rows_reserved,
  {count_if('solo AND NOT conflict', 'clean_before_reserved')}, {count_if("status = 'CLEAN' AND n_train > 0", 'clean')} FROM t) SELECT *, 0 AS disagree FROM sm""")
def q_sanitation(s, d):
    inv, (train, val) = _inventory(s, d), _split(s, d)
    again = assets.sanitation_again(train, val, _reserved(s, d), "asset", "raw")
    off = assets.symmetric_difference(assets.clean_assets(inv).select("asset"), again).agg(F.count("*").alias("disagree"))
    return assets.sanitation(inv).join(F.broadcast(off))


@stated(f"WITH {_O} SELECT split, count(*) AS n, count(v) AS valid, {count_if('v IS NULL', 'invalid')}, round(min(v), 6)::DOUBLE AS least, round(max(v), 6)::DOUBLE AS most FROM x GROUP BY 1")
def q_number_audit(s, d):
    v = P.positive_decimal("raw")
    return _orders(s, d).groupBy("split").agg(F.count("*").alias("n"), F.count(v).alias("valid"), total(v.isNull(), "invalid"), F.min(v).cast("double").alias("least"), F.max(v).cast("double").alias("most"))


@stated(f"""WITH {_O}, i AS (SELECT asset, count(DISTINCT v) AS k, bool_or(v IS NULL) AS bad, max(v) AS number FROM x WHERE asset IS NOT NULL GROUP BY 1),
  a AS (SELECT c_custkey AS asset FROM customer WHERE c_custkey % 3 = 0) SELECT CASE WHEN k IS NULL THEN 'not_found' WHEN k = 1 AND NOT bad THEN 'usable' ELSE 'ambiguous' END AS resolution, count(*) AS n, sum(CASE WHEN k = 1 AND NOT bad THEN number END)::DOUBLE AS total FROM a LEFT JOIN i USING (asset) GROUP BY 1""")
def q_resolution(s, d):
    asks = table(s, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("asset"))
    return assets.resolve(asks, _orders(s, d), "asset", "raw").groupBy("resolution").agg(F.count("*").alias("n"), F.sum("number").cast("double").alias("total"))


@stated(f"WITH {_O} SELECT coalesce(o_orderpriority, 'None') AS task, count(*) AS n, count(DISTINCT asset) AS n_assets FROM x WHERE asset IN (SELECT asset FROM res) GROUP BY 1")
def q_reserved_tasks(s, d):
    rows = _orders(s, d).join(_reserved(s, d), "asset", "left_semi")
    return assets.reserved_by_task(rows, "asset", "o_orderpriority")


@stated(f"""WITH k AS (SELECT doc_id, sha256({spoken('text')}) AS k, lang FROM documents WHERE text IS NOT NULL), c AS (SELECT k, count(*) AS n, count(DISTINCT coalesce(lang, '?')) AS l, min(doc_id) AS f FROM k GROUP BY 1 HAVING count(*) > 1)
  SELECT doc_id AS row, CASE WHEN l > 1 THEN 'CONFLICTING_EXCLUDE' WHEN doc_id = f THEN 'KEEP' ELSE 'SAME_LABEL_EXCLUDE' END AS decision FROM k JOIN c USING (k)""")
def q_duplicate_decisions(s, d):
    docs = table(s, d, "documents").where("text is not null").select("doc_id", F.sha2(K.spoken_key("text"), 256).alias("k"), "lang")
    return assets.duplicate_decisions(docs, "doc_id", "k", "lang")


_KEYED = f"k AS (SELECT doc_id, text, lang, source, sha256({spoken('text')}) AS k FROM documents WHERE text IS NOT NULL)"


@stated(f"""WITH {_KEYED}, t AS (SELECT * FROM k WHERE doc_id % 5 <> 0), e AS (SELECT * FROM k WHERE doc_id % 5 = 0)
  SELECT (SELECT count(*) FROM t WHERE sha256(text) IN (SELECT sha256(text) FROM e)) AS rows_hit, (SELECT count(*) FROM (SELECT text FROM t INTERSECT SELECT text FROM e)) AS exact_overlap, (SELECT count(*) FROM (SELECT k FROM t INTERSECT SELECT k FROM e)) AS key_overlap""")
def q_split_contamination(s, d):
    docs = table(s, d, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("x"), F.sha2(K.spoken_key("text"), 256).alias("k"))
    train, test = docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0")
    n = lambda d, c: d.agg(F.count("*").alias(c))
    hit = n(train.join(test.select("x").distinct(), "x", "left_semi"), "rows_hit")
    return hit.join(F.broadcast(n(train.select("x").intersect(test.select("x")), "exact_overlap"))).join(F.broadcast(n(train.select("k").intersect(test.select("k")), "key_overlap")))


@stated(f"""WITH {_KEYED}, dup AS (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS i FROM k) WHERE i > 1)
  SELECT doc_id AS row, CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' END AS gold FROM documents WHERE lang IN ('en', 'de') AND text IS NOT NULL AND trim(text) <> '' AND doc_id NOT IN (SELECT doc_id FROM dup)""")
def q_eligible_rows(s, d):
    docs = table(s, d, "documents")
    keyed = docs.where("text is not null").select("doc_id", F.sha2(K.spoken_key("text"), 256).alias("k"), F.lit("one").alias("label"))
    gone = assets.duplicate_decisions(keyed, "doc_id", "k", "label").where("decision <> 'KEEP'")
    return assets.eligible(docs, "doc_id", "lang", {"en": "English", "de": "German"}, "text", gone)


@stated("SELECT o_custkey, count(*) AS n, min(o_orderstatus) AS status FROM orders WHERE o_orderstatus <> 'P' AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1) GROUP BY 1")
def q_without_conflicts(s, d):
    rows = assets.without_conflicts(table(s, d, "orders"), "o_custkey", P.recoded("o_orderstatus", {"F": "F", "O": "O"}))
    return rows.groupBy("o_custkey").agg(F.count("*").alias("n"), F.min("o_orderstatus").alias("status"))


@stated("SELECT o_custkey, count(DISTINCT o_orderpriority) > 1 OR count(DISTINCT o_orderstatus) > 1 AS differs FROM orders GROUP BY 1")
def q_metadata_disagreement(s, d):
    return assets.metadata_disagreement(table(s, d, "orders"), "o_custkey", ["o_orderpriority", "o_orderstatus"])


def _levels(s, d):
    c = table(s, d, "customer").join(F.broadcast(table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(s, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    known = F.col("c_acctbal") >= 0
    return c.select("c_custkey", F.explode(F.array_compact(F.array(F.when(F.col("r_name").isNotNull(), F.struct(F.lit("region").alias("level"), F.col("r_name").alias("gold"))), F.when(known, F.struct(F.lit("nation").alias("level"), F.col("n_name").alias("gold"))), F.when(known & (F.col("c_mktsegment") != "BUILDING"), F.struct(F.lit("segment").alias("level"), F.col("c_mktsegment").alias("gold")))))).alias("e")).select("c_custkey", "e.*")


@stated("""WITH c AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) SELECT c_custkey, 'region' AS level, r_name AS gold FROM c WHERE r_name IS NOT NULL UNION ALL SELECT c_custkey, 'nation', n_name FROM c WHERE c_acctbal >= 0 UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM c WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'""")
def q_eligible_levels(s, d):
    return _levels(s, d)


_LEVEL_SQL = "WITH c AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), e AS (SELECT c_custkey, 'region' AS level, r_name AS gold FROM c UNION ALL SELECT c_custkey, 'nation', n_name FROM c WHERE c_acctbal >= 0 UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM c WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'), u AS (SELECT DISTINCT level, gold AS x FROM e)"


@stated(f"""{_LEVEL_SQL}, w AS (SELECT c_custkey, e.level, gold, x, row_number() OVER (PARTITION BY c_custkey, e.level ORDER BY {digest("'wrong'", 'e.level', 'c_custkey', 'x')}) AS n FROM e JOIN u ON u.level = e.level AND u.x <> e.gold),
  a AS (SELECT c_custkey, level, gold, x FROM w WHERE n <= 3 UNION ALL SELECT c_custkey, level, gold, gold FROM e), l AS (SELECT c_custkey, level, gold, list(x ORDER BY {digest("'shown'", 'level', 'c_custkey', 'x')}) AS c FROM a GROUP BY 1, 2, 3)
  SELECT c_custkey, level, gold AS answer, array_to_string(c, '|') AS choices, CAST(list_position(c, gold) - 1 AS BIGINT) AS position FROM l""")
def q_mcq_levels(s, d):
    e = _levels(s, d)
    universe = e.groupBy("level").agg(F.collect_set("gold").alias("u"))  # the values of three small dimensions
    by = lambda salt, xs: F.transform(F.array_sort(F.transform(xs, lambda x: F.struct(K.digest(F.lit(salt), "level", "c_custkey", x).alias("h"), x.alias("x")))), lambda p: p["x"])
    four = F.concat(F.slice(by("wrong", F.array_remove("u", F.col("gold"))), 1, 3), F.array("gold"))
    rows = e.join(F.broadcast(universe), "level").withColumn("c", by("shown", four))
    return rows.select("c_custkey", "level", F.col("gold").alias("answer"), F.array_join("c", "|").alias("choices"), (F.array_position("c", F.col("gold")) - 1).alias("position"))


def _anomalies(s, d):
    sig = F.when(F.col("l_quantity") > 49, "TOO_MANY").when(F.col("l_discount") > 0.09, F.concat(F.lit("D"), F.col("l_linenumber").cast("string"))).when(F.col("l_tax") > 0.079, F.lit(None))
    bad = (F.col("l_quantity") > 49) | (F.col("l_discount") > 0.09) | (F.col("l_tax") > 0.079)
    return table(s, d, "lineitem").where(bad).select(F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")).alias("row_id"), F.concat_ws("_", F.col("l_returnflag"), (F.col("l_linenumber") % 4).cast("string")).alias("task_id"), sig.alias("signature"))


_ANOMALY = """l AS (SELECT l_orderkey || '/' || l_linenumber || '/' || l_partkey AS row_id, l_returnflag || '_' || (l_linenumber % 4) AS task_id, CASE WHEN l_quantity > 49 THEN 'TOO_MANY' WHEN l_discount > 0.09 THEN 'D' || l_linenumber ELSE 'HETEROGENEOUS' END AS sig FROM lineitem WHERE l_quantity > 49 OR l_discount > 0.09 OR l_tax > 0.079),
  sz AS (SELECT l_returnflag || '_' || (l_linenumber % 4) AS task_id, count(*) AS rows FROM lineitem GROUP BY 1), p AS (SELECT task_id, sig, count(*) AS c FROM l GROUP BY 1, 2),
  t AS (SELECT task_id, sum(c) AS n, max(ROW(c, sig <> 'HETEROGENEOUS', sig)) AS top FROM p GROUP BY 1),
  k AS (SELECT task_id, CAST(n AS BIGINT) AS n, n / rows AS f, CASE WHEN top[2] AND top[1] / n >= 0.5 AND n >= 5 THEN 'SYSTEMATIC_CONTRACT_PATTERN' WHEN n / rows <= 0.02 THEN 'LOCAL_HETEROGENEOUS_NOISE' ELSE 'UNRESOLVED' END AS kind, top[3] AS s FROM t JOIN sz USING (task_id))"""


@stated(f"WITH {_ANOMALY} SELECT task_id, n, round(f, 6) AS fraction, kind, CASE kind WHEN 'SYSTEMATIC_CONTRACT_PATTERN' THEN 'BLOCKING' WHEN 'LOCAL_HETEROGENEOUS_NOISE' THEN 'AUTO_DROP_ROW' ELSE 'REVIEW' END AS severity, CASE WHEN kind = 'SYSTEMATIC_CONTRACT_PATTERN' THEN s END AS dominant FROM k")
def q_anomalies(s, d):
    size = table(s, d, "lineitem").groupBy(F.concat_ws("_", F.col("l_returnflag"), (F.col("l_linenumber") % 4).cast("string")).alias("task_id")).agg(F.count("*").alias("n"))
    return assets.anomalies(_anomalies(s, d), size)


@stated(f"WITH {_ANOMALY} SELECT task_id, CASE WHEN kind = 'SYSTEMATIC_CONTRACT_PATTERN' THEN 'BLOCKED_BY_CONTRACT' ELSE 'DROP_LOCAL_ANOMALY' END AS status, CASE WHEN kind = 'SYSTEMATIC_CONTRACT_PATTERN' THEN s ELSE 'local_anomaly' END AS reason, count(*) AS n FROM (SELECT DISTINCT row_id, task_id FROM l) JOIN k USING (task_id) GROUP BY 1, 2, 3")
def q_task_eligibility(s, d):
    a = _anomalies(s, d)
    return assets.task_eligibility(a, q_anomalies(s, d)).groupBy("task_id", "status", "reason").agg(F.count("*").alias("n"))


def _files(s, d):
    """Customers as rows with an id and a file; some without, some with a path that names none, some that share a name."""
    k = F.col("c_custkey")
    path = F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, F.concat(F.lit("https://x/"), k.cast("string"))).when(k % 23 == 0, "C:\\a\\same.wav").otherwise(F.concat(F.lit("/data/"), F.col("c_mktsegment"), F.lit("/"), k.cast("string"), F.lit(".wav")))
    return table(s, d, "customer").select(F.when(k % 29 != 0, k).alias("c_custkey"), path.alias("path"))


_FILES = r"""f AS (SELECT CASE WHEN c_custkey % 29 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS identity, CASE WHEN c_custkey % 17 = 0 THEN 'MISSING' WHEN c_custkey % 19 = 0 THEN 'NON_LOCAL' END AS bad, CASE WHEN c_custkey % 17 = 0 OR c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN 'same.wav' ELSE c_custkey || '.wav' END AS name FROM customer),
  e AS (SELECT identity, count(*) AS n, min(name) AS name, min(CASE WHEN identity IS NULL THEN 'MISSING_IDENTITY' ELSE bad END) AS bad FROM f GROUP BY 1), w AS (SELECT name, count(*) AS k FROM e WHERE bad IS NULL GROUP BY 1),
  ix AS (SELECT identity, e.name, coalesce(bad, CASE WHEN n > 1 THEN 'AMBIGUOUS_IDENTITY' WHEN k > 1 THEN 'BASENAME_COLLISION' END) AS fault FROM e LEFT JOIN w ON w.name = e.name AND w.k > 1)"""


@stated(f"WITH {_FILES} SELECT * FROM ix")
def q_audio_index(s, d):
    return assets.audio_index(_files(s, d), "c_custkey", "path")


def _records(s, d):
    """Orders as records of one or two customers' audio, with a few faults."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    other = F.pmod(c + 1, F.lit(50))
    rows = F.when(k % 2 == 0, F.array(c)).otherwise(F.array(c, other))
    ids = F.transform(rows, lambda r: F.concat(F.lit("audio_"), F.substring(F.sha2(F.concat_ws("|", F.lit("customer"), F.lit("r1"), r.cast("string")), 256), 1, 20)))
    ids = F.when(k % 31 == 0, F.reverse(ids)).when(k % 37 == 0, F.concat(ids, F.array(F.lit("audio_x")))).otherwise(ids)
    return table(s, d, "orders").select(k.alias("id"), ids.alias("audio_ids"), rows.alias("row_ids"))


_RECORDS = f"""rc AS (SELECT id, CASE WHEN id % 31 = 0 THEN list_reverse(a) WHEN id % 37 = 0 THEN list_append(a, 'audio_x') ELSE a END AS audio_ids, r AS row_ids FROM (SELECT id, r, list_transform(r, lambda x: {audio('customer', 'x')}) AS a FROM (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN [o_custkey] ELSE [o_custkey, (o_custkey + 1) % 50] END AS r FROM orders)))"""


@stated(f"""WITH {_FILES}, {_RECORDS}, z AS (SELECT id, len(audio_ids) = len(row_ids) AS ok, i - 1 AS position, audio_ids[i] AS audio_id, CAST(row_ids[i] AS VARCHAR) AS row_id FROM rc, range(1, 4) q(i) WHERE i <= greatest(len(audio_ids), len(row_ids))),
  m AS (SELECT z.*, name, CASE WHEN NOT ok THEN 'AUDIO_ROW_ARITY_MISMATCH' WHEN {audio('customer', 'row_id')} IS DISTINCT FROM audio_id THEN 'AUDIO_ID_LINK_MISMATCH' WHEN name IS NULL OR ix.fault IS NOT NULL THEN coalesce(ix.fault, 'UNRESOLVED_IDENTITY') END AS fault FROM z LEFT JOIN ix ON ix.identity = z.row_id)
  SELECT fault, count(*) AS n, count(DISTINCT CASE WHEN fault IS NULL THEN name END) AS n_names, CAST(sum(position) AS BIGINT) AS positions FROM m GROUP BY 1""")
def q_resolve_audio(s, d):
    met = assets.resolve_audio(_records(s, d), assets.audio_index(_files(s, d), "c_custkey", "path"), "customer", "r1")
    return met.groupBy("fault").agg(F.count("*").alias("n"), F.countDistinct("name").alias("n_names"), F.sum("position").alias("positions"))


@stated(f"WITH {_RECORDS} SELECT CASE WHEN id % 41 = 0 THEN 'MODEL_RECORD_WITHOUT_INTERNAL' WHEN list_sort(audio_ids) <> audio_ids THEN 'MODEL_INTERNAL_AUDIO_MISMATCH' END AS fault, count(*) AS n FROM rc GROUP BY 1")
def q_model_internal(s, d):
    r = _records(s, d)
    return assets.model_matches_internal(r.select("id", F.array_sort("audio_ids").alias("audio")), r.where("id % 41 <> 0")).groupBy("fault").agg(F.count("*").alias("n"))


@stated(f"""WITH {_RECORDS}, z AS (SELECT audio_ids[i] AS audio_id, CAST(row_ids[i] AS VARCHAR) AS row_id FROM rc, range(1, 4) q(i) WHERE i <= greatest(len(audio_ids), len(row_ids)))
  SELECT audio_id, min(row_id) AS row_id, count(DISTINCT row_id) > 1 AS ambiguous FROM z GROUP BY 1""")
def q_logical_audio(s, d):
    return assets.logical_mapping(_records(s, d))


@stated(f"""WITH {_RECORDS}, q AS (SELECT id, len(row_ids) AS n, row_ids[1] AS a, row_ids[2] AS b FROM rc), p AS (SELECT id, CASE WHEN n = 1 AND a < 100 THEN 's/' || a WHEN n = 2 AND a % 2 = 0 AND b = (a + 1) % 50 AND a IN (SELECT c_custkey FROM customer) THEN 'p/' || a END AS path FROM q) SELECT CASE WHEN path IS NULL THEN 'UNRESOLVED' END AS fault, count(*) AS n, count(DISTINCT path) AS n_paths FROM p GROUP BY 1""")
def q_physical_audio(s, d):
    c = table(s, d, "customer")
    k = F.col("c_custkey")
    singles = c.where("c_custkey < 100").select(k.alias("row_id"), F.concat(F.lit("s/"), k.cast("string")).alias("path"))
    pairs = c.where("c_custkey % 2 = 0").select(k.alias("a"), F.pmod(k + 1, F.lit(50)).alias("b"), F.concat(F.lit("p/"), k.cast("string")).alias("path"))
    return assets.physical_mapping(_records(s, d), singles, pairs).groupBy("fault").agg(F.count("*").alias("n"), F.countDistinct("path").alias("n_paths"))


@stated("SELECT count(*) AS planned, count(*) FILTER (c_acctbal >= 0) AS at_hand, count(*) FILTER (c_acctbal < 0) AS missing FROM customer")
def q_availability(s, d):
    c = table(s, d, "customer").select(F.col("c_name").alias("path"), "c_acctbal")
    return assets.availability(c, c.where("c_acctbal >= 0"))


@stated("""WITH a AS (SELECT DISTINCT p_name FROM part WHERE p_partkey % 40 = 0), f AS (SELECT p_name, min(p_partkey) AS f FROM part GROUP BY 1) SELECT outcome, count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS rows FROM (SELECT p_partkey, CASE WHEN p_name IN (SELECT p_name FROM a) THEN 'DUPLICATE_OF_APPROVED' WHEN p_partkey = f THEN 'ACCEPTED' ELSE 'DUPLICATE_IN_ROUND' END AS outcome FROM part JOIN f USING (p_name)) GROUP BY 1""")
def q_signature_dedup(s, d):
    p = table(s, d, "part")
    return assets.first_by_signature(p, "p_name", "p_partkey", p.where("p_partkey % 40 = 0")).groupBy("outcome").agg(F.count("*").alias("n"), F.sum("row").alias("rows"))


@stated("""SELECT 'sound' AS of, 0 AS overlap, 0 AS missing, 0 AS extra UNION ALL SELECT 'faulty', (SELECT count(*) FROM part WHERE p_size < 10 AND p_partkey % 10 = 0), (SELECT count(*) FROM part WHERE p_size >= 40 AND p_partkey % 10 <> 0), 1""")
def q_partition_exact(s, d):
    p = table(s, d, "part")
    sound = assets.partition_faults(p, {"a": p.where("p_size < 10"), "b": p.where("p_size >= 10 and p_size < 40"), "c": p.where("p_size >= 40")}, "p_partkey")
    odd = p.where("p_size >= 10 and p_size < 40").select("p_partkey").unionAll(s.range(-1, 0).select(F.col("id").alias("p_partkey")))
    faulty = assets.partition_faults(p, {"a": p.where("p_size < 10"), "b": odd, "c": p.where("p_partkey % 10 = 0 and (p_size < 10 or p_size >= 40)")}, "p_partkey")
    return profile.union_all([x.select(F.lit(n).alias("of"), "*") for n, x in (("sound", sound), ("faulty", faulty))])


@stated("SELECT CASE WHEN n = 0 THEN 'added' WHEN o = 0 THEN 'removed' ELSE 'unchanged' END AS change, count(*) AS n FROM (SELECT p_name, count(*) FILTER (p_partkey % 7 < 5) AS n, count(*) FILTER (p_partkey % 7 > 1) AS o FROM part GROUP BY 1 HAVING n + o > 0) GROUP BY 1")
def q_set_diff(s, d):
    p = table(s, d, "part")
    return assets.set_diff(p.where("p_partkey % 7 < 5"), p.where("p_partkey % 7 > 1"), "p_name").groupBy("change").agg(F.count("*").alias("n"))


@stated(f"SELECT c_custkey FROM customer WHERE c_custkey % 9 = 0 OR c_custkey % 10 = 0 AND c_mktsegment <> 'BUILDING'")
def q_snapshot_diff(s, d):
    c = table(s, d, "customer").select("c_custkey", F.sha2("c_mktsegment", 256).alias("h"))
    after = table(s, d, "customer").where("c_custkey % 9 <> 0").select("c_custkey", F.sha2(F.when(F.col("c_custkey") % 10 == 0, "BUILDING").otherwise(F.col("c_mktsegment")), 256).alias("h"))
    return assets.changed(c, after, "c_custkey", "h")


@stated("""WITH t AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0), v AS (SELECT * FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 100 = 1) SELECT (SELECT count(*) FROM t) AS n_train, (SELECT count(*) FROM v) AS n_val,
  (SELECT count(DISTINCT o_custkey) FROM t) AS speakers_train, (SELECT count(DISTINCT o_orderpriority) FROM t) AS provinces_train, (SELECT count(DISTINCT o_orderkey) FROM t) AS files_train, (SELECT count(DISTINCT o_custkey) FROM v) AS speakers_val, (SELECT count(DISTINCT o_orderpriority) FROM v) AS provinces_val, (SELECT count(DISTINCT o_orderkey) FROM v) AS files_val,
  (SELECT count(*) FROM (SELECT o_orderkey FROM t INTERSECT SELECT o_orderkey FROM v)) AS file_overlap, (SELECT count(*) FROM (SELECT o_custkey FROM t INTERSECT SELECT o_custkey FROM v)) AS speaker_overlap, 0 AS odd_provinces""")
def q_overlap_report(s, d):
    o = table(s, d, "orders")
    return assets.overlap_report(o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 3 = 0 or o_orderkey % 100 = 1"), "o_orderkey", "o_custkey", "o_orderpriority")


@stated("SELECT count(*) AS n, count(DISTINCT lang) AS n_groups, count(DISTINCT source) AS n_speakers, min(length(text)) AS least, max(length(text)) AS most, round(avg(length(text)), 1) AS mean, (SELECT count(*) FROM (SELECT source FROM documents GROUP BY 1 HAVING count(*) > 1)) AS repeated_speakers FROM documents")
def q_sample_stats(s, d):
    return assets.sample_stats(table(s, d, "documents"), "lang", "source", "text")


@stated("""SELECT 'rows' AS kind, '' AS name, count(*) AS n FROM customer UNION ALL SELECT 'identities', 'c_custkey', count(DISTINCT c_custkey) FROM customer UNION ALL SELECT 'unique', 'c_custkey', (count(DISTINCT c_custkey) = count(*))::BIGINT FROM customer UNION ALL SELECT 'eligible', 'c_name', count(c_name) FROM customer UNION ALL SELECT 'eligible', 'c_acctbal', count(c_acctbal) FROM customer UNION ALL SELECT 'groups', 'c_mktsegment', count(DISTINCT c_mktsegment) FROM customer""")
def q_source_inventory(s, d):
    return assets.source_inventory(table(s, d, "customer"), "c_custkey", ["c_name", "c_acctbal"], ["c_mktsegment"])


@stated("SELECT count(*) FILTER (l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL) AS n, round(count(*) FILTER (l_returnflag = l_linestatus) / count(*), 6) AS rate FROM lineitem")
def q_field_equality(s, d):
    return assets.field_equality(table(s, d, "lineitem"), "l_returnflag", "l_linestatus")


@stated(" UNION ALL ".join(f"SELECT '{f}' AS field, CAST(n AS INTEGER) AS n, v AS value FROM (SELECT v, row_number() OVER (ORDER BY o, v) AS n FROM (SELECT CAST({f} AS VARCHAR) AS v, min(p_partkey) AS o FROM part GROUP BY 1)) WHERE n <= 4" for f in ("p_type", "p_brand")))
def q_first_values(s, d):
    return assets.first_values(table(s, d, "part"), ["p_type", "p_brand"], "p_partkey", 4)


_RANKED = f"""r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY {digest("'rank'", 'c_custkey')}, c_custkey) - 1 AS rank FROM customer WHERE c_nationkey IS NOT NULL),
  t AS (SELECT c_nationkey AS grp, c_custkey AS row_id, rank, CASE WHEN c_custkey % 4 = 0 THEN 'key_overlap' WHEN c_mktsegment = 'BUILDING' THEN 'speaker_overlap' WHEN c_acctbal < 5000 OR c_nationkey = 7 THEN 'unusable' END AS reason FROM r),
  f AS (SELECT grp, min(rank) FILTER (reason IS NULL) AS rank, count(*) AS n FROM t GROUP BY 1), ch AS (SELECT f.grp, t.row_id, coalesce(f.rank, n) AS skipped FROM f LEFT JOIN t ON t.grp = f.grp AND t.rank = f.rank)"""


def _usable(s, d):
    c = table(s, d, "customer")
    blocked = s.createDataFrame([("BUILDING",)], "c_mktsegment string")
    return samples.first_usable(c, "c_custkey", "c_nationkey", (F.col("c_acctbal") >= 5000) & (F.col("c_nationkey") != 7), "c_mktsegment", c.where("c_custkey % 4 = 0"), blocked)


@stated(f"WITH {_RANKED} SELECT grp, row_id, skipped FROM ch")
def q_first_usable(s, d):
    return _usable(s, d)[0]


@stated(f"WITH {_RANKED} SELECT t.grp, t.row_id, t.rank, t.reason FROM t JOIN ch ON ch.grp = t.grp AND t.rank < ch.skipped")
def q_rejections(s, d):
    return _usable(s, d)[1]


@query
def q_spread_sample(s, d):
    o = table(s, d, "orders").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return samples.spread_sample(o, "o_orderkey", "c_mktsegment", "c_nationkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@stated(f"SELECT o_orderkey, row_number() OVER (ORDER BY {digest(chr(39) + 'order' + chr(39), 'o_orderkey')}, o_orderkey) - 1 AS place FROM orders")
def q_canonical_order(s, d):
    return samples.canonical_order(table(s, d, "orders").select("o_orderkey"), "o_orderkey")


_CUTS, _NAMES = (1000.0, 1400.0, 1800.0), ("sparse", "medium", "dense", "very dense")
_T = {"t1": 1000.0, "t2": 1400.0, "t3": 1800.0}
_CASE = "CASE WHEN p_retailprice < 1000 THEN 'sparse' WHEN p_retailprice < 1400 THEN 'medium' WHEN p_retailprice < 1800 THEN 'dense' ELSE 'very dense' END"
_GOLD = f"CASE WHEN p_partkey % 9 = 0 THEN 'dense' ELSE {_CASE} END"


@stated(" UNION ALL ".join(f"SELECT '{n}' AS threshold, '{side}' AS side, CAST(i AS INTEGER) AS n, v AS value FROM (SELECT p_retailprice AS v, row_number() OVER (ORDER BY p_retailprice {order}) AS i FROM part WHERE p_retailprice {op} {t}) WHERE i <= 10" for n, t in _T.items() for side, op, order in (("below", "<", "DESC"), ("above", ">=", "ASC"))))
def q_nearest_values(s, d):
    return samples.nearest(table(s, d, "part"), "p_retailprice", _T)


@stated(" UNION ALL ".join(f"SELECT '{n}' AS threshold, {b}::DOUBLE AS band, count(*) FILTER (abs(p_retailprice - {t}) <= {b}) AS n FROM part" for n, t in _T.items() for b in (0.15, 1.05, 20.05)))
def q_threshold_bands(s, d):
    return samples.near_threshold(table(s, d, "part"), "p_retailprice", _T, (0.15, 1.05, 20.05))


def _labelled(s, d):
    return table(s, d, "part").select("p_partkey", "p_retailprice", F.when(F.col("p_partkey") % 9 == 0, "dense").otherwise(samples.ordinal(F.col("p_retailprice"), _CUTS, _NAMES)).alias("gold"))


@stated(f"SELECT count(*) AS n, {count_if(f'{_CASE} = {_GOLD}', chr(34) + 'right' + chr(34))}, round(count(*) FILTER ({_CASE} = {_GOLD}) / count(*), 6) AS accuracy FROM part")
def q_reproduce(s, d):
    return samples.reproduced(_labelled(s, d), "p_retailprice", "gold", _CUTS, _NAMES)


@stated(f"""WITH d(class) AS (VALUES ('sparse'), ('medium'), ('dense'), ('very dense')), c AS (SELECT d.class, count(p_partkey) AS n FROM d LEFT JOIN part ON {_CASE} = d.class GROUP BY 1), t AS (SELECT sum(n) AS t, max(n) AS m, -sum(CASE WHEN n > 0 THEN n / (SELECT sum(n) FROM c) * log2(n / (SELECT sum(n) FROM c)) END) AS h FROM c)
  SELECT class, n, round(100 * n / t, 4) AS percent, round(m / t, 6) AS majority, round(h, 6) AS entropy, round(h / 2, 6) AS normalized, round(pow(2.0, h), 6) AS effective FROM c, t""")
def q_projected(s, d):
    return samples.projected(table(s, d, "part"), "p_retailprice", _CUTS, _NAMES)


_POPULATIONS = {"all": "part", "large": "part WHERE p_size > 30", "promo": "part WHERE p_type = 'PROMO'"}


@stated(" UNION ALL ".join(f"SELECT '{n}' AS population, {q}::DOUBLE AS point, count(*) AS n, round(quantile_cont(p_retailprice, {q}), 5) AS linear FROM {t}" for n, t in _POPULATIONS.items() for q in (0.1, 0.25, 0.5, 0.9)))
def q_populations(s, d):
    p = table(s, d, "part")
    return samples.populations({"all": p, "large": p.where("p_size > 30"), "promo": p.where("p_type = 'PROMO'")}, "p_retailprice", (0.1, 0.25, 0.5, 0.9))


@stated(f"""SELECT gold, count(*) AS n, round(min(p_retailprice), 6) AS least, round(max(p_retailprice), 6) AS most, round(avg(p_retailprice), 4) AS mean, round(stddev_pop(p_retailprice), 4) AS dev, {', '.join(f'round(quantile_cont(p_retailprice, {q}), 5) AS p{int(q * 100):02d}' for q in (0.05, 0.25, 0.5, 0.75, 0.95))}
  FROM (SELECT p_retailprice, {_GOLD} AS gold FROM part) GROUP BY 1""")
def q_class_statistics(s, d):
    return samples.class_statistics(_labelled(s, d), "p_retailprice", "gold")


@stated(f"WITH r AS (SELECT c_nationkey, c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY {digest(chr(39) + 'few' + chr(39), 'c_custkey')}, c_custkey) AS n FROM customer) SELECT c_nationkey, c_mktsegment, c_custkey, CAST(n AS INTEGER) AS n FROM r WHERE n <= 4")
def q_few_each(s, d):
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("c_nationkey", "c_mktsegment").orderBy(K.digest(F.lit("few"), "c_custkey"), "c_custkey"))
    return table(s, d, "customer").select("c_nationkey", "c_mktsegment", "c_custkey", n.alias("n")).where("n <= 4")


@stated(f"""WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS a, unnest(['F', 'O', 'P', 'X']) AS c FROM orders), l AS (SELECT id, a, list(c ORDER BY {digest('42', '3', 'id', 'c')}) AS c FROM o GROUP BY 1, 2) SELECT id AS row_id, array_to_string(c, '|') AS choices, chr(CAST(64 + list_position(c, a) AS INTEGER)) AS letter FROM l""")
def q_epoch_choices(s, d):
    rows = table(s, d, "orders").select("o_orderkey", "o_orderstatus", F.array(*[F.lit(x) for x in "FOPX"]).alias("c"))
    return samples.shuffled_choices(rows, "o_orderkey", "c", "o_orderstatus", epoch=3)
