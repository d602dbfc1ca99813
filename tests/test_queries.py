"""Every engine query against its statement, on the smallest tables."""

import hashlib
import itertools
import math
import random

import duckdb
import pytest

from veridata.plans import records
from veridata.plans.oracle import ORACLES
from veridata.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def test_every_query_has_a_statement():
    assert set(QUERIES) - set(ORACLES) == {"q_spread_sample"} and set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module", autouse=True)
def one_plan(spark, tmp_path_factory):
    """The records' queries all build one plan, which is the same at each build (q_determinism builds it twice)."""
    folder = str(tmp_path_factory.mktemp("plan"))
    build, realize = records._plan, records._records
    build(spark, SF).write.parquet(f"{folder}/plan")
    records._plan = lambda s, d: s.read.parquet(f"{folder}/plan")
    realize(spark, SF).write.parquet(f"{folder}/records")
    records._records = lambda s, d: s.read.parquet(f"{folder}/records")
    yield build
    records._plan, records._records = build, realize


def test_plan_builds_alike(spark, one_plan):
    a, b = one_plan(spark, SF), records._plan(spark, SF)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(a.columns).collect()))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    r = db.sql(ORACLES[name])
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    mine = sorted((tuple(map(norm, x)) for x in df.select(*cols).collect()), key=repr)
    assert mine == sorted((tuple(norm(x[i]) for i in at) for x in r.fetchall()), key=repr)


def test_unicode_key(spark):
    from veridata.functions.unicode import normalized

    df = spark.createDataFrame([("é  Straße",), ("É STRASSE",), (None,)], "t string")
    assert [x[0] for x in df.select(normalized("t")).collect()] == ["é strasse", "é strasse", None]


def test_readers(spark, tmp_path):
    from veridata.sources import readers

    (tmp_path / "a.tsv").write_text("1\ta\tb\nbad\n2\t\n3\tc\n")
    assert [tuple(x) for x in readers.read_tsv_pairs(spark, str(tmp_path / "a.tsv")).collect()] == [("1", "a\tb"), ("3", "c")]
    df = spark.createDataFrame([("train",), ("test",)], "split string")
    with pytest.raises(ValueError):
        readers.only_splits(df, "split", ("train",))


def test_stream(spark, tmp_path):
    from veridata.streaming.profile import windowed_profile

    src = spark.read.parquet(f"{SF}/events.parquet").limit(200)
    src.write.parquet(str(tmp_path / "e"))
    s = windowed_profile(spark.readStream.schema(src.schema).parquet(str(tmp_path / "e")))
    q = s.writeStream.format("memory").queryName("prof").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(n) from prof").first()[0] == 200


def test_threshold_edges(spark):
    from veridata.operators import calibrate

    df = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (3, 2), (4, 3), (5, 3), (None, 1), (6, None)], "v int, r int")
    assert [tuple(x) for x in calibrate.best_thresholds(df, "v", "r").collect()] == [(1.5, 2.5, 3.5, 6, 6, 1.0)]
    assert [tuple(x) for x in calibrate.boundaries(df, "v", "r").collect()][0] == (0, 1, 2, 1, True, 1.5)
    assert tuple(calibrate.monotonicity(df, "v", "r").first()) == (5, 0, 0)
    none = df.where("v > 9")
    assert calibrate.best_thresholds(none, "v", "r").count() == calibrate.boundaries(none, "v", "r").count() == 0
    assert tuple(calibrate.monotonicity(none, "v", "r").first()) == (0, 0, 0)


def test_choice_edges(spark):
    from veridata.operators import choices

    docs = spark.createDataFrame([(1, "a"), (2, "A!"), (3, None), (4, "b"), (5, "c"), (None, "d")], "doc_id long, text string")
    got = {r.a: r for r in choices.composite_choices(docs).collect()}
    assert set(got) == {1, 4, 5} and all(r.choices.split("|")[r.position] == r.answer for r in got.values())
    assert choices.composite_choices(docs.where("doc_id < 4")).count() == 0
    mcq = spark.createDataFrame([(1, "x", "x|y", 0), (1, "x", "y|y", 5), (2, None, None, None)], "row_id long, answer string, choices string, position long")
    assert choices.audit_choices(mcq).first().asDict() == {"n": 3, "answer_missing": 1, "repeated_choices": 1, "wrong_gold": 1, "repeated_ids": 1}


def test_every_anchor_gets_its_choices(spark):
    from veridata.operators import choices

    texts = ["one two", "one two", "one two", "a b c d e f", "a b c d e f", *[f"w{i} " * 15 for i in range(4)], None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in choices.bucket_choices(docs).collect():
        got.setdefault(r.doc_id, {})[r.n] = r.distractor
    assert set(got) == set(range(9))
    for i, c in got.items():
        assert sorted(c) == [1, 2, 3] and len({texts[x] for x in c.values()} | {texts[i]}) == 4
    assert all(texts[got[i][1]] == "a b c d e f" for i in range(3))  # the nearest bucket comes first
    few = docs.where("doc_id < 5")
    assert sorted(tuple(r) for r in choices.choice_shortfall(few, choices.bucket_choices(few)).collect()) == [(i, 2) for i in range(5)]
    assert choices.bucket_choices(docs.where("doc_id < 0")).count() == 0


def test_negatives_exist_where_another_speaker_does(spark):
    from veridata.operators import pairs

    rows = [(i, "s1" if i < 8 else f"s{i}", "g1" if i < 10 else "g2", None if i == 3 else "h") for i in range(14)] + [(99, None, "g1", "h")]
    df = spark.createDataFrame(rows, "id long, who string, g string, h string")
    who, g = {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}
    got = {r.a: r for r in pairs.tiered_negative(df, "id", "who", [["g", "h"], ["g"], []]).collect()}
    assert set(got) == set(range(14))
    for a, r in got.items():
        assert who[r.b] not in (None, who[a]) and r.tier == (1 if a == 3 else 0) and g[r.b] == g[a]
    lone = df.where("who = 's1'")
    assert {r.b for r in pairs.tiered_negative(lone, "id", "who", [["g"], []]).collect()} == {None}
    plan = pairs.verification_plan(df, "id", "who", [["g"], []])
    seen = [tuple(sorted(r[:2])) for r in plan.collect()]
    assert len(seen) == len(set(seen)) and pairs.plan_shortfall(plan).first().n_same == 8
    with pytest.raises(ValueError):
        pairs.same_group_pairs(df, "id", "g", largest=5)
    assert pairs.same_group_pairs(df, "id", "g").count() == 55 + 6


@pytest.mark.parametrize("strata", [1, 2, 7])
def test_strata_change_nothing(spark, strata):
    from pyspark.sql import functions as F

    from veridata.functions.keys import digest
    from veridata.functions.places import placed_by_hash
    from veridata.operators import calibrate

    rng = random.Random(4)
    rows = [(i, rng.choice([None, *range(40)]), rng.choice([None, 0, 1, 2, 3]), rng.choice(["a", "b", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v int, r int, g string")
    whole = lambda f: sorted(map(tuple, f.collect()), key=repr)
    both = lambda f: (whole(f(strata)), whole(f(1)))
    for f in (
        lambda n: calibrate.best_boundary(df.withColumn("low", F.coalesce(F.col("r") < 2, F.lit(False))), "v", "low", n),
        lambda n: calibrate.monotonicity(df, "v", "r", n),
        lambda n: calibrate.best_thresholds(df, "v", "r", n),
        lambda n: calibrate.percentiles(df, "g", "v", strata=n),
    ):
        x, y = both(f)
        assert x == y and x
    placed = {r.id: r.place for r in placed_by_hash(df.withColumn("h", digest("id")), ["g"], "h", ["id"], strata).collect()}
    for g in ("a", "b", None):
        mine = sorted((hashlib.sha256(f"42|{r[0]}".encode()).hexdigest(), r[0]) for r in rows if r[3] == g)
        assert [placed[i] for _, i in mine] == list(range(len(mine)))


def test_best_thresholds_against_all_triples(spark):
    from veridata.operators import calibrate

    rng = random.Random(6)
    rows = [(rng.randrange(9), rng.randrange(4)) for _ in range(60)]
    got = calibrate.best_thresholds(spark.createDataFrame(rows, "v int, r int"), "v", "r", strata=3).first()
    vs = sorted({v for v, _ in rows})
    cuts = [vs[0] - 1, *((a + b) / 2 for a, b in itertools.pairwise(vs)), vs[-1] + 1]
    right = lambda t: sum(sum(v >= x for x in t) == r for v, r in rows)
    best = min(itertools.combinations(cuts, 3), key=lambda t: (-right(t), t))
    assert (got.t1, got.t2, got.t3, got.right) == (*best, right(best))


def test_spread_sample_against_the_whole_table(spark):
    from veridata.operators import samples

    rng = random.Random(2)
    rows = [(i, rng.choice("NSC"), rng.choice("pqrstu"), rng.choice([None, *"abcdefgh"]), rng.choice([None, 0, 1]), "x" * rng.randrange(40)) for i in range(250)]
    df = spark.createDataFrame(rows, "id long, region string, province string, who string, gender int, t string")
    got = [r.row_id for r in samples.spread_sample(df, "id", "region", "province", "who", "gender", "t", 24).orderBy("n").collect()]
    h = {r[0]: hashlib.sha256(f"42|discover|{r[0]}".encode()).hexdigest() for r in rows}
    lengths = sorted(len(r[5]) for r in rows)
    q1, q2 = lengths[250 // 3], lengths[500 // 3]
    size = lambda r: 0 if len(r[5]) <= q1 else 1 if len(r[5]) <= q2 else 2
    count = {x: sum(r[1] == x for r in rows) for x in "NSC"}
    quota = {x: 8 for x in count}
    picked = []
    while len(picked) < 24:
        full = {x: sum(r[1] == x for r in picked) for x in count}
        left = [r for r in rows if r not in picked and (full[r[1]] < quota[r[1]] or all(full[x] >= quota[x] for x in quota))]
        new = lambda r, i: r[i] is not None and all(p[i] != r[i] for p in picked)  # noqa: B023, E731
        picked.append(min(left, key=lambda r: (full[r[1]] >= quota[r[1]], not new(r, 2), not new(r, 3), not new(r, 4), any(size(p) == size(r) for p in picked), h[r[0]])))  # noqa: B023
    assert got == [str(r[0]) for r in sorted(picked, key=lambda r: h[r[0]])]
    assert samples.spread_sample(df.where("id < 0"), "id", "region", "province", "who", "gender", "t").count() == 0


def test_unicode_comparators(spark):
    from veridata.functions import text as T

    pairs = [("Ｃａｆé", "café", "folded", True), ("cafe\u0301", "café", "label", True), ("cafe\u0301", "café", "exact", False), ("STRASSE", "straße", "term", True), ("a-b, C!", "a b c", "spoken", True), ("a+b", "a b", "spoken", False), (None, "  ", "exact", True), (" 7 ", "7", "integer", True)]
    for a, b, name, same in pairs:
        df = spark.createDataFrame([(a, b)], "a string, b string")
        assert df.select(T.COMPARATORS[name].same("a", "b")).first()[0] is same, (a, b, name)
    df = spark.createDataFrame([("a+b", "a b")], "a string, b string")
    assert df.select(T.independent_spoken_key("a") == T.independent_spoken_key("b")).first()[0]
    with pytest.raises(ValueError):
        T.Comparator("x", ("nothing",))
    assert T.comparator_set_hash(["exact", "term"]) == T.comparator_set_hash(["term", "exact", "term"]) != T.comparator_set_hash(["term"])
    rows = [("", "x"), (None, "x"), ("MRI", "an MRI scan"), ("mri", "an MRI scan"), ("x ray", "an X-ray, yes"), ("xray", "an x-ray"), ("ct", "an x-ray")]
    got = [r[0] for r in spark.createDataFrame(rows, "t string, x string").select(T.term_match("t", "x")).collect()]
    assert got == ["ANNOTATION_UNCLEAR"] * 2 + ["A_RAW", "B_CASE_ONLY", "C_PUNCT_OR_WS", "HYPHENATION_VARIANT", "LEXICAL_MISMATCH"]
    assert [r[0] for r in spark.createDataFrame([("0",), (None,), (" Ａ  b",)], "v string").select(T.field_key("v")).collect()] == ["", "", "a b"]


def test_targets_and_budgets(spark):
    from pyspark.sql import functions as F

    from veridata.operators import capacity, plan

    df = spark.createDataFrame([("“a b.”", True), ('"x"', True), ("“a”", False), (" y  , z", True), ("“", True)], "t string, q boolean")
    assert [r[0] for r in df.select(plan.bound_target("t", F.col("q"))).collect()] == ["a b.", "x", "“a”", "y, z", "“"]
    assert df.select(plan.question_text(F.lit("is it “[TARGET_VALUE]”?"), "t", F.col("q"))).first()[0] == "Is it “a b.”"
    assert [plan.positive_count(n, r) for n, r in ((5, None), (5, 0.5), (7, 0.5), (10, 0.3))] == [3, 2, 4, 3]
    types = spark.createDataFrame([("a", 3), ("b", 100), ("c", 100)], "f string, l long")
    got = [tuple(r) for r in capacity.resolve_budget(types, "f", "l", total=20, strict=True).orderBy("type").collect()]
    assert got == [("a", 7, 3, 4, "BUDGET_INFEASIBLE"), ("b", 7, 7, 0, "BUDGET_INFEASIBLE"), ("c", 6, 6, 0, "BUDGET_INFEASIBLE")]
    assert capacity.resolve_budget(types, "f", "l").first().status == "READY_AWAITING_BUDGET"
    with pytest.raises(ValueError):
        capacity.resolve_budget(types, "f", "l", per_type={"z": 1})
    u = spark.createDataFrame([(1, True), (2, False)], "k int, p boolean")
    with pytest.raises(ValueError):
        capacity.resolve_plan(u, "k", "p", 4, 1.0)
    short = spark.createDataFrame([("t", ["1"])], "type_id string, row_ids array<string>")
    with pytest.raises(ValueError):
        plan.require_budget(short, {"t": 2})
    assert plan.require_budget(short, {"t": 1}) is short


def test_equality_pairs_prefer_another_speaker(spark):
    from veridata.operators import plan

    rows = [(i, "g", "w1" if i % 2 else "w2") for i in range(9)] + [(100, "h", "w1"), (101, "h", "w1"), (102, "k", "w")]
    df = spark.createDataFrame(rows, "id long, g string, who string")
    got = plan.equality_positive(df, "id", "g", "who", 50).collect()
    who = {r[0]: r[2] for r in rows}
    assert len(got) == 10 and len({frozenset(r) for r in got}) == 10
    assert sum(who[r.a] != who[r.b] for r in got) >= 8
    assert plan.equality_negative(df, "id", "g", 50).count() == 0  # one group holds more than half


def test_empty_tables_and_nulls(spark):
    from veridata.operators import assets, calibrate, profile, terms

    none = spark.createDataFrame([], "id long, v double, r int, g string, t string, l string")
    for df in (none, spark.createDataFrame([(None,) * 6], none.schema)):
        assert calibrate.percentiles(df, "g", "v").count() == 0 and calibrate.best_boundary(df.withColumn("low", df.r < 2), "v", "low").count() == 0
        assert calibrate.evaluation(df, "g", "l").first().macro_f1 == 0.0 and calibrate.confusion(df, "g", "l").count() == 0
        assert terms.match_levels(df, "t", "l").count() == 0 and terms.order(df, "t", "l").first().n == 0
        assert profile.relation_verdict(df, "id", "g").first().reason == "derived_relation_data_unavailable"
        assert profile.stream_audit(df, "id", "t").first().n == 0
        m = assets.members(df, "id", "r", "t", ["g"])
        assert assets.inventory(m, m, df.select(df.id.alias("asset"))).where("asset is not null").count() == 0


def test_short_items_contaminate(spark):
    from veridata.operators import sets

    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    items = spark.createDataFrame([(n, " ".join(words[:n])) for n in range(1, 9)] + [(20, "absent"), (21, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " + " ".join(words) + " y"), (2, "xalphax"), (3, "alpha beta gamma"), (4, None)], "doc_id long, text string")
    for most in (1 << 20, 0):
        got = sorted(tuple(r) for r in sets.contains_reserved(docs, items, most).collect())
        assert got == [(1, n) for n in range(1, 9)] + [(2, 1), (3, 1), (3, 2), (3, 3)]
