"""Queries of text functions: comparators, levels, term audits, strict readings, ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import parsing as P
from ..functions import text as T
from ..operators import profile, terms
from ..operators.terms import total
from ..sources.readers import table
from .registry import bare, collapse, count_if, digest, fold, hash_int, split_of, spoken, stated, words_only

_NOT_NULL = "documents WHERE text IS NOT NULL"


@stated(f"SELECT doc_id, sha256({fold(collapse('text'))}) AS key, sha256(text) AS exact_key FROM {_NOT_NULL}")
def q_field_key(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", F.sha2(T.field_key("text"), 256).alias("key"), F.sha2(T.field_key("text", exact=True), 256).alias("exact_key"))


_COMPARED = {"exact": collapse("text"), "spoken": fold(collapse(bare("text"))), "label": collapse("text"), "folded": fold(collapse("text")), "transcript": fold(collapse(bare("text"))), "term": fold(collapse("text")), "integer": collapse("text")}


@stated(" UNION ALL ".join(f"SELECT '{n}' AS comparator, count(*) AS n, count(DISTINCT {x}) AS n_keys FROM {_NOT_NULL}" for n, x in _COMPARED.items()))
def q_comparators(s, d):
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("comparator"), F.sha2(c.key("text"), 256).alias("k")) for n, c in T.COMPARATORS.items()])).alias("e")
    return table(s, d, "documents").where("text is not null").select(kinds).groupBy("e.comparator").agg(F.count("*").alias("n"), F.countDistinct("e.k").alias("n_keys"))


def _variants(s, d):
    """Each document's text and a reference that differs from it in one of six ways."""
    t, k = F.col("text"), F.col("doc_id") % 6
    other = F.when(k == 0, t).when(k == 1, F.concat(F.lit(" "), t)).when(k == 2, F.upper(t)).when(k == 3, F.replace(t, F.lit(","), F.lit(" ;"))).when(k == 4, F.concat(F.upper(t), F.lit("!"))).otherwise(F.concat(t, F.lit(" more")))
    return table(s, d, "documents").where("text is not null").select("doc_id", t.alias("a"), other.alias("b"))


_VARIANTS = """v AS (SELECT doc_id, text AS a, CASE doc_id % 6 WHEN 0 THEN text WHEN 1 THEN ' ' || text WHEN 2 THEN upper(text) WHEN 3 THEN replace(text, ',', ' ;') WHEN 4 THEN upper(text) || '!' ELSE text || ' more' END AS b FROM documents WHERE text IS NOT NULL)"""
_WORDS = lambda x: collapse(fold(words_only(collapse(x))))
_CLASS = f"""CASE WHEN a = b THEN 'RAW_EQUAL' WHEN {collapse('a')} = {collapse('b')} THEN 'WHITESPACE_ONLY' WHEN {fold(collapse('a'))} = {fold(collapse('b'))} THEN 'CASE_ONLY'
  WHEN {_WORDS('a')} = {_WORDS('b')} THEN CASE WHEN {_WORDS('a')} <> {fold(collapse('a'))} OR {_WORDS('b')} <> {fold(collapse('b'))} THEN 'PUNCTUATION_OR_CASE_AND_PUNCTUATION_ONLY' ELSE 'PUNCTUATION_ONLY' END ELSE 'LEXICAL_OR_MIXED' END"""


@stated(f"WITH {_VARIANTS} SELECT {_CLASS} AS difference, count(*) AS n FROM v GROUP BY 1")
def q_difference_class(s, d):
    return _variants(s, d).groupBy(T.difference("a", "b").alias("difference")).agg(F.count("*").alias("n"))


@stated(f"WITH {_VARIANTS}, k AS (SELECT {_COMPARED['spoken'].replace('text', 'a')} = {_COMPARED['spoken'].replace('text', 'b')} AS x, {_WORDS('a')} = {_WORDS('b')} AS y FROM v) SELECT count(*) AS n, {count_if('x', 'n_equal')}, {count_if('x <> y', 'n_disagree')} FROM k")
def q_comparator_check(s, d):
    both = _variants(s, d).select(T.COMPARATORS["spoken"].same("a", "b").alias("x"), (T.independent_spoken_key("a") == T.independent_spoken_key("b")).alias("y"))
    return both.agg(F.count("*").alias("n"), total(F.col("x"), "n_equal"), total(F.col("x") != F.col("y"), "n_disagree"))


_ONLY = "c IN ('PUNCTUATION_ONLY', 'PUNCTUATION_OR_CASE_AND_PUNCTUATION_ONLY', 'CASE_ONLY', 'WHITESPACE_ONLY')"


@stated(f"""WITH {_VARIANTS}, k AS (SELECT a = b AS old, {_COMPARED['spoken'].replace('text', 'a')} = {_COMPARED['spoken'].replace('text', 'b')} AS new, {_CLASS} AS c FROM v)
  SELECT count(*) AS n, {count_if('old', 'old_true')}, {count_if('new', 'new_true')}, {count_if('NOT old AND new', 'false_to_true')}, {count_if('old AND NOT new', 'true_to_false')}, {count_if('old AND new', 'stay_true')}, {count_if('NOT old AND NOT new', 'stay_false')},
    {count_if(f'NOT old AND {_ONLY}', 'presentation_before')}, {count_if(f'NOT new AND {_ONLY}', 'presentation_after')} FROM k""")
def q_reference_repair(s, d):
    v = _variants(s, d)
    k = v.select((F.col("a") == F.col("b")).alias("old"), T.COMPARATORS["spoken"].same("a", "b").alias("new"), T.difference("a", "b").alias("c"))
    old, new = F.col("old"), F.col("new")
    only = F.col("c").isin("PUNCTUATION_ONLY", "PUNCTUATION_OR_CASE_AND_PUNCTUATION_ONLY", "CASE_ONLY", "WHITESPACE_ONLY")
    return k.agg(F.count("*").alias("n"), total(old, "old_true"), total(new, "new_true"), total(~old & new, "false_to_true"), total(old & ~new, "true_to_false"), total(old & new, "stay_true"), total(~old & ~new, "stay_false"), total(~old & only, "presentation_before"), total(~new & only, "presentation_after"))


@stated(rf"""WITH {_VARIANTS}, c AS (SELECT doc_id, unnest(list_distinct(list_concat(list_filter(string_split(a, ''), lambda x: NOT contains(b, x)), list_filter(string_split(b, ''), lambda x: NOT contains(a, x))))) AS sign FROM v)
  SELECT sign, count(*) AS n FROM c WHERE regexp_matches(sign, '[\p{{P}}]') GROUP BY 1""")
def q_repair_signs(s, d):
    x, y = F.split("a", ""), F.split("b", "")
    signs = _variants(s, d).select(F.explode(F.concat(F.array_except(x, y), F.array_except(y, x))).alias("sign"))
    return signs.where(F.col("sign").rlike(r"^\p{P}$")).groupBy("sign").agg(F.count("*").alias("n"))


@stated(f"SELECT doc_id, sha256(text) AS raw, sha256({fold('text')}) AS folded, sha256({collapse(bare('text'))}) AS bare, sha256({fold(collapse(bare('text')))}) AS bare_folded FROM {_NOT_NULL}")
def q_text_levels(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", *[F.sha2(c, 256).alias(n) for n, c in T.levels("text").items()])


@stated(f"SELECT doc_id, sha256({fold(collapse('text'))}) AS question, sha256(regexp_replace(regexp_replace({fold('trim(text)')}, '^[\\s.,;:!?\"''()\\[\\]{{}}<>*_`-]+', ''), '[\\s.,;:!?\"''()\\[\\]{{}}<>*_`-]+$', '')) AS answer, sha256({collapse('lower(text)')}) AS split FROM {_NOT_NULL}")
def q_answer_keys(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", F.sha2(T.question_key("text"), 256).alias("question"), F.sha2(T.answer_key("text"), 256).alias("answer"), F.sha2(T.split_key("text"), 256).alias("split"))


def _terms(s, d):
    """Parts with a text and a term list made of their own columns, the topic, the declared number of terms and the split."""
    n = F.col("p_name")
    listed = F.concat_ws("; ", F.col("p_type"), F.lower("p_type"), F.replace(n, F.lit(" "), F.lit("-")), F.replace(n, F.lit(" "), F.lit("  ")), F.replace(n, F.lit(" "), F.lit("")), F.when(F.col("p_size") % 3 == 0, F.col("p_brand")), F.when(F.col("p_size") % 5 == 0, F.col("p_type")))
    h = K.hash_int("p_partkey") % 10
    split = F.when(h < 8, "train").when(h == 8, "val").otherwise("test")
    return table(s, d, "part").select("p_partkey", "p_brand", F.concat(n, F.lit(" "), F.col("p_type")).alias("x"), listed.alias("terms"), (F.col("p_size") % 9).alias("declared"), split.alias("split"))


_TERMS = f"""r AS (SELECT p_partkey, p_brand, p_name || ' ' || p_type AS x, concat_ws('; ', p_type, lower(p_type), replace(p_name, ' ', '-'), replace(p_name, ' ', '  '), replace(p_name, ' ', ''), CASE WHEN p_size % 3 = 0 THEN p_brand END, CASE WHEN p_size % 5 = 0 THEN p_type END) AS terms,
  p_size % 9 AS declared, {split_of('p_partkey')} AS split FROM part),
l AS (SELECT *, list_filter(list_transform(string_split(terms, ';'), lambda t: trim(t)), lambda t: t <> '') AS li FROM r),
e AS (SELECT p_partkey, p_brand, x, split, unnest(li) AS t FROM l)"""
_BF = lambda x: fold(collapse(bare(x)))
_LEVEL = f"""CASE WHEN contains(x, t) THEN 'A_RAW' WHEN contains({fold('x')}, {fold('t')}) THEN 'B_CASE_ONLY' WHEN contains({_BF('x')}, {_BF('t')}) THEN 'C_PUNCT_OR_WS'
  WHEN contains(replace(replace({_BF('x')}, '-', ''), ' ', ''), replace(replace({_BF('t')}, '-', ''), ' ', '')) THEN 'HYPHENATION_VARIANT' ELSE 'LEXICAL_MISMATCH' END"""


@stated(f"WITH {_TERMS} SELECT {_LEVEL} AS level, count(*) AS n FROM e GROUP BY 1")
def q_term_match_level(s, d):
    return terms.match_levels(_terms(s, d), "x", "terms")


@stated(f"WITH {_TERMS}, v AS (SELECT DISTINCT {_LEVEL} AS level, p_partkey AS row_id, t AS term FROM e) SELECT level, row_id, term, CAST(n AS INTEGER) AS n FROM (SELECT *, row_number() OVER (PARTITION BY level ORDER BY row_id, term) AS n FROM v WHERE level <> 'A_RAW') WHERE n <= 5")
def q_term_examples(s, d):
    return terms.match_examples(_terms(s, d), "p_partkey", "x", "terms")


@stated(f"""WITH {_TERMS}, f AS (SELECT t, regexp_matches(t, '^[A-Z]{{2,}}$') AS a, regexp_matches(t, '^[A-Z][a-z]+( [A-Z][a-z]+)*$') AS c FROM e)
  SELECT {count_if("contains(t, ' ')", 'multiword')}, {count_if('a', 'acronym')}, {count_if('NOT a AND c', 'capitalized')}, {count_if('NOT a AND NOT c AND lower(t) = t AND upper(t) <> t', 'lowercase')}, {count_if("regexp_matches(t, '[0-9]')", 'digits')}, {count_if("contains(t, '-')", 'hyphen')}, {count_if("contains(t, '/')", 'slash')},
    (SELECT count(*) FROM l WHERE len(list_distinct(li)) < len(li)) AS repeating_rows FROM f""")
def q_term_forms(s, d):
    return terms.forms(_terms(s, d), "terms")


@stated(f"WITH {_TERMS} SELECT count(*) AS n, {count_if('declared = len(li)', 'exact')}, {count_if('declared <> len(li)', 'mismatch')}, {count_if('declared = 0 AND len(li) > 0', 'zero_but_terms')}, {count_if('declared > 0 AND len(li) = 0', 'some_but_none')} FROM l")
def q_term_counts(s, d):
    return terms.declared_counts(_terms(s, d), "declared", "terms")


@stated(f"""WITH {_TERMS}, p AS (SELECT li, list_transform(li, lambda t: instr({collapse(bare('lower(x)'))}, {collapse(bare('lower(t)'))})) AS s FROM l WHERE len(li) > 1),
  k AS (SELECT CASE WHEN list_contains(s, 0) THEN 'm' WHEN len(list_distinct(li)) < len(li) THEN 'r' WHEN s = list_sort(s) THEN 's' ELSE 'o' END AS k FROM p)
  SELECT count(*) AS n, {count_if("k = 's'", 'same_order')}, {count_if("k = 'o'", 'other_order')}, {count_if("k = 'm'", 'not_found')}, {count_if("k = 'r'", 'repeated')} FROM k""")
def q_term_order(s, d):
    return terms.order(_terms(s, d), "x", "terms")


_POOL = f"""WITH {_TERMS}, y AS (SELECT DISTINCT {{g}} AS g, {collapse('lower(t)')} AS t FROM e),
  o AS (SELECT p_partkey, {{g}} AS g, {collapse(bare('lower(x)'))} AS x, list_transform(li, lambda t: {collapse('lower(t)')}) AS own FROM l)
  SELECT p_partkey AS row_id, (SELECT count(*) FROM y WHERE y.g = o.g AND NOT list_contains(own, y.t) AND NOT contains(o.x, y.t)) AS pool FROM o"""


@stated(_POOL.replace("{g}", "''"))
def q_negative_pool(s, d):
    return terms.negative_pools(_terms(s, d), "p_partkey", "x", "terms")


@stated(_POOL.replace("{g}", "p_brand"))
def q_negative_pool_topic(s, d):
    return terms.negative_pools(_terms(s, d), "p_partkey", "x", "terms", "p_brand")


@stated(f"""WITH {_TERMS}, c AS (SELECT split, {collapse('lower(t)')} AS t, count(*) AS c FROM e GROUP BY 1, 2), m AS (SELECT c.split, c.c, k.c AS train FROM c LEFT JOIN c k ON k.split = 'train' AND k.t = c.t WHERE c.split <> 'train'),
  a AS (SELECT split, count(*) AS types, {count_if('train IS NOT NULL', 'seen')}, {count_if('train IS NULL', 'unseen')}, CAST(coalesce(sum(c) FILTER (train IS NOT NULL), 0) AS BIGINT) AS seen_occurrences, CAST(coalesce(sum(c) FILTER (train IS NULL), 0) AS BIGINT) AS unseen_occurrences, {count_if('train <= 2', 'rare')} FROM m GROUP BY 1)
  SELECT *, (SELECT count(*) FROM c WHERE split = 'train') AS train_types, round(unseen / (seen + unseen), 4) AS unseen_rate, round(unseen_occurrences / (seen_occurrences + unseen_occurrences), 4) AS unseen_occurrence_rate FROM a""")
def q_split_vocabulary(s, d):
    return terms.split_vocabulary(_terms(s, d), "split", "terms")


@stated(f"""WITH {_TERMS}, v AS (SELECT DISTINCT 'text' AS kind, x AS v, split FROM r UNION SELECT 'source', p_brand, split FROM r UNION SELECT 'id', CAST(p_partkey AS VARCHAR), split FROM r UNION SELECT 'term', {collapse('lower(t)')}, split FROM e)
  SELECT p.kind, p.split AS a, q.split AS b, count(*) AS n FROM v p JOIN v q ON p.kind = q.kind AND p.v = q.v AND p.split < q.split GROUP BY 1, 2, 3""")
def q_split_identity(s, d):
    r = _terms(s, d)
    return terms.split_identity(r, "split", {"text": F.array("x"), "source": F.array("p_brand"), "id": F.array(F.col("p_partkey").cast("string")), "term": F.transform(T.term_list("terms"), lambda t: T.collapse(F.lower(t)))})


@stated("SELECT count(*) AS n, count(*) FILTER (lang IS NULL OR trim(lang) = '') AS missing, count(DISTINCT lang) AS raw_labels, count(DISTINCT lower(trim(lang))) AS labels FROM documents")
def q_topic_labels(s, d):
    return terms.labels(table(s, d, "documents"), "lang")


def _numbers(s, d):
    """Texts of several tables that are read as numbers."""
    part, customer, orders, events = (table(s, d, t) for t in ("part", "customer", "orders", "events"))
    one = lambda f, c: F.struct(F.lit(f).alias("field"), c.cast("string").alias("raw"))
    return profile.union_all([
        part.select(F.explode(F.array(one("brand number", F.substring_index("p_brand", "#", -1)), one("brand", F.col("p_brand")))).alias("e")),
        customer.select(one("balance", F.concat(F.lit(" "), F.col("c_acctbal").cast("decimal(18,2)").cast("string"))).alias("e")),
        orders.select(one("priority", F.substring_index("o_orderpriority", "-", 1)).alias("e")),
        events.select(one("marker", F.when(F.col("event_type") == "error", None).when(F.col("event_type") == "view", "  ").when(F.col("event_type") == "click", "NaN").when(F.col("event_type") == "signup", "inf").otherwise("80.0")).alias("e")),
    ]).select("e.*")


_NUMBERS = """u AS (SELECT 'brand number' AS field, split_part(p_brand, '#', 2) AS raw FROM part UNION ALL SELECT 'brand', p_brand FROM part UNION ALL SELECT 'balance', ' ' || CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR) FROM customer
  UNION ALL SELECT 'priority', split_part(o_orderpriority, '-', 1) FROM orders UNION ALL SELECT 'marker', CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN '  ' WHEN 'click' THEN 'NaN' WHEN 'signup' THEN 'inf' ELSE '80.0' END FROM events)"""


@stated(f"""WITH {_NUMBERS}, v AS (SELECT field, raw, TRY_CAST(trim(raw) AS DOUBLE) AS v FROM u),
  k AS (SELECT field, CASE WHEN raw IS NULL OR trim(raw) = '' THEN 'missing' WHEN v IS NULL OR isnan(v) OR isinf(v) THEN 'malformed' WHEN v <= 0 THEN 'nonpositive' ELSE 'valid' END AS status, CASE WHEN TRY_CAST(trim(raw) AS DECIMAL(38, 18)) > 0 THEN TRY_CAST(trim(raw) AS DECIMAL(38, 18)) END AS dec FROM v)
  SELECT field, status, count(*) AS n, count(DISTINCT dec) AS n_values, count(dec) AS n_decimal FROM k GROUP BY 1, 2""")
def q_decimal_parse(s, d):
    rows = _numbers(s, d).select("field", P.number_status("raw").alias("status"), P.positive_decimal("raw").alias("dec"))
    return rows.groupBy("field", "status").agg(F.count("*").alias("n"), F.countDistinct("dec").alias("n_values"), F.count("dec").alias("n_decimal"))


def _ages(s, d):
    """Parts as rows of a speaker with an age as text."""
    raw = F.when(F.col("p_type") == "PROMO", "Unidentified").when(F.col("p_type") == "SMALL", F.concat(F.col("p_size").cast("string"), F.lit(" years"))).otherwise(F.concat(F.lit(" "), (F.col("p_size") + 10).cast("string")))
    speaker = F.when(F.col("p_partkey") % 50 != 0, F.concat_ws("/", "p_brand", (F.col("p_partkey") % 40).cast("string")))
    return table(s, d, "part").select("p_partkey", speaker.alias("speaker"), raw.alias("raw"), (F.col("p_retailprice") < 1500).alias("valid"), F.col("p_type").alias("locale"))


_AGES = r"""g AS (SELECT p_partkey, CASE WHEN p_partkey % 50 <> 0 THEN p_brand || '/' || (p_partkey % 40) END AS speaker, CASE p_type WHEN 'PROMO' THEN 'Unidentified' WHEN 'SMALL' THEN p_size || ' years' ELSE ' ' || (p_size + 10) END AS raw, p_retailprice < 1500 AS valid FROM part),
  a AS (SELECT *, CASE WHEN lower(trim(raw)) = 'unidentified' THEN 'unidentified' WHEN regexp_matches(trim(raw), '^[0-9]+$') THEN 'age' ELSE 'malformed' END AS status, CASE WHEN regexp_matches(trim(raw), '^[0-9]+$') THEN CAST(trim(raw) AS INTEGER) END AS age FROM g),
  b AS (SELECT *, CASE WHEN age < 18 THEN NULL WHEN age <= 29 THEN '18-29' WHEN age <= 59 THEN '30-59' WHEN age >= 60 THEN '60+' END AS bin FROM a)"""


@stated(f"WITH {_AGES} SELECT raw, status, count(*) AS n, count(DISTINCT speaker) AS n_speakers, min(age) AS age FROM b GROUP BY 1, 2")
def q_age_raw(s, d):
    return _ages(s, d).groupBy("raw", P.age_status("raw").alias("status")).agg(F.count("*").alias("n"), F.countDistinct("speaker").alias("n_speakers"), F.min(P.age("raw")).alias("age"))


@stated(f"WITH {_AGES} SELECT count(*) AS n, {count_if('age IS NOT NULL', 'n_ages')}, {count_if('status = ' + chr(39) + 'unidentified' + chr(39), 'n_unidentified')}, {count_if('status = ' + chr(39) + 'malformed' + chr(39), 'n_malformed')}, {count_if('age < 18', 'n_under_18')}, min(age) AS least, max(age) AS most, round(avg(age), 4) AS mean, median(age) AS median FROM b")
def q_age_audit(s, d):
    a, k = P.age("raw"), P.age_status("raw")
    return _ages(s, d).agg(F.count("*").alias("n"), F.count(a).alias("n_ages"), total(k == "unidentified", "n_unidentified"), total(k == "malformed", "n_malformed"), total(a < 18, "n_under_18"), F.min(a).alias("least"), F.max(a).alias("most"), F.round(F.avg(a), 4).alias("mean"), F.median(a).alias("median"))


@stated(f"""WITH {_AGES}, p AS (SELECT speaker, count(DISTINCT age) AS k, count(DISTINCT bin) AS bins FROM b WHERE speaker IS NOT NULL AND speaker <> '' GROUP BY 1)
  SELECT count(*) AS n_speakers, {count_if('k > 1 AND bins <= 1', 'raw_conflict_only')}, {count_if('bins > 1', 'bin_conflict')} FROM p""")
def q_age_consistency(s, d):
    per = profile.age_consistency(_ages(s, d), "speaker", "raw")
    return per.agg(F.count("*").alias("n_speakers"), total(F.col("raw_conflict") & ~F.col("bin_conflict"), "raw_conflict_only"), total(F.col("bin_conflict"), "bin_conflict"))


@stated(r"""WITH u AS (SELECT url, nullif(regexp_extract(trim(url), '/([A-Za-z0-9]+)(?:\?[^/]*)?$', 1), '') AS id FROM pages), c AS (SELECT id, count(*) AS n FROM u WHERE id IS NOT NULL GROUP BY 1)
  SELECT count(*) AS n, count(id) AS parsed, count(*) FILTER (url IS NULL OR trim(url) = '') AS missing, count(*) FILTER (trim(url) <> '' AND id IS NULL) AS malformed, (SELECT count(*) FROM c) AS n_ids, (SELECT count(*) FROM c WHERE n > 1) AS repeated_ids, (SELECT CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) FROM c) AS repeated_rows FROM u""")
def q_url_ids(s, d):
    return profile.id_audit(table(s, d, "pages"), "url")


def _clocks(s, d):
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    begin = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    clock = lambda x: F.concat_ws(":", F.floor(x / 3600).cast("string"), F.lpad(F.floor(x % 3600 / 60).cast("string"), 2, "0"), F.lpad((x % 60).cast("string"), 2, "0"))
    return e.select(F.col("user_id"), F.when(F.col("event_type") == "error", "12h30").otherwise(clock(begin)).alias("start"), clock(begin + F.floor(F.coalesce("value", F.lit(0.0)) * 20).cast("int")).alias("end"))


@stated("""WITH t AS (SELECT user_id, event_type, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS a, CAST(floor(coalesce(value, 0) * 20) AS INTEGER) AS w FROM events),
  i AS (SELECT user_id, a, a + w AS z FROM t WHERE event_type <> 'error'), o AS (SELECT user_id, a < lag(z) OVER (PARTITION BY user_id ORDER BY a, z) AS o FROM i),
  r AS (SELECT count(*) - count(DISTINCT (a, z)) AS r FROM i GROUP BY user_id)
  SELECT (SELECT count(*) FROM t WHERE event_type = 'error') AS unparseable, (SELECT CAST(coalesce(sum(r), 0) AS BIGINT) FROM r) AS repeated, (SELECT count(*) FROM o WHERE o) AS overlapping""")
def q_clock_intervals(s, d):
    from ..operators import sets

    return sets.interval_audit(_clocks(s, d), "user_id", "start", "end")


def _paths(s, d):
    u, k = F.col("url"), F.col("page_id") % 8
    last = F.concat(F.lit("f"), F.col("page_id").cast("string"))
    ref = F.when(k == 0, u).when(k == 1, F.concat(F.lit("C:\\data\\"), last, F.lit(".wav"))).when(k == 2, F.concat(F.lit("/data/audio/"), last, F.lit(".wav"))).when(k == 3, F.lit(" ")).when(k == 4, F.concat(F.lit("/data/"), last, F.lit("..wav"))).when(k == 5, F.lit("/data/")).when(k == 6, F.concat(F.lit("audio/train/"), last)).otherwise(F.concat(F.lit("D:"), last))
    return table(s, d, "pages").select("page_id", ref.alias("ref"))


_PATHS = r"""p AS (SELECT page_id, CASE page_id % 8 WHEN 0 THEN url WHEN 1 THEN 'C:\data\f' || page_id || '.wav' WHEN 2 THEN '/data/audio/f' || page_id || '.wav' WHEN 3 THEN ' ' WHEN 4 THEN '/data/f' || page_id || '..wav' WHEN 5 THEN '/data/' WHEN 6 THEN 'audio/train/f' || page_id ELSE 'D:f' || page_id END AS ref FROM pages),
  n AS (SELECT *, string_split(replace(trim(ref), '\', '/'), '/')[-1] AS name FROM p)"""


@stated(rf"""WITH {_PATHS}, f AS (SELECT *, CASE WHEN ref IS NULL OR trim(ref) = '' THEN 'MISSING' WHEN regexp_matches(trim(ref), '^[A-Za-z][A-Za-z0-9+.-]*://') THEN 'NON_LOCAL' WHEN name IN ('', '.', '..') THEN 'INVALID' WHEN contains(name, '..') THEN 'PATH_TRAVERSAL' WHEN regexp_matches(name, '^[A-Za-z]:') THEN 'INVALID' END AS fault FROM n)
  SELECT page_id, fault, CASE WHEN fault IS NULL THEN name END AS name FROM f""")
def q_portable_names(s, d):
    return _paths(s, d).select("page_id", P.path_fault("ref").alias("fault"), P.portable_name("ref").alias("name"))


@stated(rf"""WITH {_PATHS}, q AS (SELECT page_id, replace(ref, '\', '/') AS r, name FROM n) SELECT page_id, CASE WHEN contains(r, '/train/') THEN r WHEN contains(r, 'audio/') THEN replace(r, 'audio/', 'audio/train/') ELSE 'audio/train/' || string_split(r, '/')[-1] END AS path FROM q""")
def q_split_paths(s, d):
    return _paths(s, d).select("page_id", P.under_split("ref", "train").alias("path"))


@stated("SELECT l_returnflag AS code, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' END AS label, count(*) AS n FROM lineitem GROUP BY 1, 2")
def q_recode(s, d):
    return table(s, d, "lineitem").groupBy(F.col("l_returnflag").alias("code"), P.recoded("l_returnflag", {"A": "accepted", "N": "none"}).alias("label")).agg(F.count("*").alias("n"))


@stated(f"SELECT c_custkey, CAST(CAST(('0x' || substr({digest(chr(39) + 'seed' + chr(39), 'c_custkey')}, 1, 16)) AS UBIGINT) % 1000 AS BIGINT) AS spot, 'qa_' || substr({digest('c_custkey')}, 1, 16) AS id FROM customer")
def q_hash_seed(s, d):
    return table(s, d, "customer").select("c_custkey", (T.hash_seed(F.lit("seed"), "c_custkey") % 1000).cast("long").alias("spot"), T.row_id("qa_", "c_custkey").alias("id"))


@stated("""SELECT c_custkey, sha256('{"id":' || c_custkey || ',"none":null,"segment":"' || c_mktsegment || '"}') AS hash FROM customer""")
def q_canonical_json(s, d):
    return table(s, d, "customer").select("c_custkey", F.sha2(T.canonical_json(segment="c_mktsegment", id="c_custkey", none=F.lit(None).cast("string")), 256).alias("hash"))


@stated("SELECT count(*) AS n, count(DISTINCT text) AS n_texts, count(DISTINCT (" + spoken("text") + ")) AS n_keys FROM documents WHERE text IS NOT NULL")
def q_fingerprints(s, d):
    return table(s, d, "documents").where("text is not null").agg(F.count("*").alias("n"), F.countDistinct(T.fingerprint64("text")).alias("n_texts"), F.countDistinct(T.fingerprint64(K.spoken_key("text"))).alias("n_keys"))


@stated("SELECT event_type, count(*) AS n, count(k) AS n_objects, CAST(sum(k) AS BIGINT) AS sum_k FROM (SELECT event_type, CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM events) GROUP BY 1")
def q_json_in_text(s, d):
    said = F.concat(F.lit("Here it is:\n```json\n"), F.col("props"), F.when(F.col("event_type") == "error", "").otherwise("\n```"), F.lit(" as asked"))
    said = F.when(F.col("event_type") == "error", F.replace(said, F.lit("}"), F.lit(""))).otherwise(said)
    k = F.get_json_object(T.json_object(said), "$.k").cast("int")
    return table(s, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count(k).alias("n_objects"), F.sum(k).alias("sum_k"))
