"""The corpus operators against plain definitions, on small tables with nulls, repeats, long texts and clashing names."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from veridata.llm import decontaminate, lang_id, license_scan, lm_score, ngram_join, piece_codec, pii, pivot_search, substring_dedup, token_store
from veridata.llm.queries import tokenizer_path

R = random.Random(11)
VOCAB = ["".join(R.choice("abcdefgh") for _ in range(R.randint(2, 6))) for _ in range(400)]
W = re.compile(r"[^\x20\x09-\x0D]+")


def prose(n):
    return " ".join(R.choice(VOCAB) for _ in range(n))


BASE = prose(120)
EDITS = []
for _ in range(12):
    w = BASE.split()
    for _ in range(R.randint(1, 3)):
        w[R.randrange(len(w))] = "zz"
    EDITS.append(" ".join(w))
TEXTS = [None, "", "   \t", "one two three", "one two three", BASE, BASE, *EDITS, "x" * 50_000, "日本語 é́ 😀 " * 50, prose(3000), *[prose(R.randint(1, 80)) for _ in range(60)]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], "s", 0, "clash", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, block string, component long")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < 0")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_pii_spans():
    t = "mail a.b+c@x-y.org, 10.0.0.255 999.1.1.1 card 4111 1111 1111 1111 call +49 (30) 123-4567, ssn 123-45-6789 DE89 3704 0044 0532 0130 00"
    got = {(s.kind, t[s.start : s.end]) for s in pii.find_spans(t)}
    assert got == {("email", "a.b+c@x-y.org"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+49 (30) 123-4567"), ("ssn", "123-45-6789"), ("iban", "DE89 3704 0044 0532 0130 00")}
    assert "4111" not in pii.redact(t, pii.find_spans(t))


def test_pii_against_patterns():
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    digits = lambda x: re.sub("[^0-9]", "", x)
    keep = {"email": lambda x: True, "ip": lambda x: all(int(p) <= 255 for p in x.split(".")), "card": lambda x: 16 <= len(digits(x)) <= 19 and pii.luhn(digits(x)), "phone": lambda x: 8 <= len(digits(x)) <= 15}
    for _ in range(3000):
        t = "".join(R.choice(["a", "@", ".", "1", "23", "4111111111111111", "-", " ", "+", "(", "é", "b.c", "255", "%"]) for _ in range(R.randint(1, 25)))
        want = [(k, *m.span()) for k, p in kinds.items() for m in re.finditer(p, t) if keep[k](m[0])]
        assert [tuple(s[:3]) for s in pii.find_spans(t) if s.kind in kinds] == want, t


def test_pii_is_linear_and_whole(spark, docs, none):
    assert pii.find_spans("1" * 200_000 + "a" * 200_000 + "@" * 2000) == []
    assert pii.pii_report(docs).count() == len(TEXTS) and pii.pii_report(none).count() == 0
    out = pii.redact_documents(docs)
    assert out.columns == docs.columns and out.where("text is null").count() == 1 and pii.redact_documents(none).count() == 0


def test_repeated_rows_and_rows_without_id(spark):
    t = "Mail a.b@c-d.org or call +49 30 123456"
    rows = [(1, t), (1, t), (None, t), (2, None), (3, ""), (None, None), (1, "other words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_tokens": F.lit("clash"), "spans": F.lit(1), "start": F.lit(2.0), "score": F.lit(True), "lang": F.lit("en")})
    key = lambda r: repr(r)
    ids = lambda got: sorted((r.doc_id for r in got), key=key)
    want = sorted((i for i, _ in rows), key=key)
    spans = pii.pii_report(df).collect()
    assert ids(spans) == want and sorted(r.n_email for r in spans) == [0] * 4 + [1] * 3
    assert sorted(pii.redact_documents(df).select("doc_id").collect(), key=key) == sorted(df.select("doc_id").collect(), key=key)
    pieces = piece_codec.piece_report(df, tokenizer_path("piece_bpe_32k.model")).collect()
    assert ids(pieces) == want and sum(r.n_tokens == 0 for r in pieces) == 3
    lm = lm_score.score_texts(df).collect()
    assert ids(lm) == want and {r.train_tokens for r in lm} == {sum(len((x or "").split()) + 1 for _, x in rows)}
    store = sorted(token_store.token_report(df, tokenizer_path("byte_bpe_50k.json")).collect(), key=lambda r: r.start)
    assert ids(store) == want and [r.start for r in store] == list(itertools.accumulate([0, *(r.n_tokens for r in store)]))[:-1]
    assert [r.doc_id for r in store] == [None, None, 1, 1, 1, 2, 3]
    assert ids(lang_id.predict_languages(df).collect()) == want
    passage = prose(60)
    twice = spark.createDataFrame([(1, passage), (1, passage), (2, f"x {passage}"), (None, passage), (None, passage), (4, f"{passage} and {passage}")], "doc_id long, text string").withColumn("block", F.lit("clash"))
    got = substring_dedup.repeated_passages(twice).collect()
    assert [r.removed_bytes for r in got if r.doc_id == 1] == [0, 0] and all(r.has_passage and (r.doc_id == 1) == (r.removed_bytes == 0) for r in got)
    alone = substring_dedup.repeated_passages(twice.where("doc_id = 4")).first()
    assert not alone.has_passage and substring_dedup.repeated_passages(twice.where("doc_id = 9")).count() == 0


def test_scans_hand_results_on_by_slices(spark, docs, monkeypatch):
    import pyarrow as pa

    made, map_in_arrow = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *a: made.append(f) or map_in_arrow(self, f, *a))
    texts = [*TEXTS, *[f"{prose(300)} a.b@c-d.org" for _ in range(2000)], "y" * 3_000_000, *[None] * 3]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    plain = docs.select("doc_id", "text")
    for scan in (lambda: pii.pii_report(plain), lambda: pii.redact_documents(plain), lambda: lang_id.keep_identified(docs.select("doc_id", "text", "lang"))):
        scan()
        out = list(made[-1](iter([batch, batch.slice(0, 0)])))
        size = lambda b: sum(len(texts[i] or "") for i in b.column(0).to_pylist())
        assert len(out) > 4 and all(size(b) <= 1 << 20 or b.num_rows == 1 for b in out)
        whole = [i for b in out for i in b.column(0).to_pylist()]
        assert whole == sorted(set(whole)) and (whole == list(range(len(texts))) or len(made) > 2)


def test_empty_pipeline_stages(spark, docs, none):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, "/root/testdata/sf0.001")
        assert out.count() == 0, name
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns, name


def test_pieces(docs, none):
    model = tokenizer_path("piece_bpe_32k.model")
    c = piece_codec.PieceCodec(model, keep=200)
    for t in [*TEXTS, "  a  b ", "▁x", "<s>a<0x41>", "a\x00b\n\n c", "......!!!???" * 30]:
        assert c.encode(t) == c.sp.encode(t or "")
    for r in piece_codec.piece_report(docs, model).collect():
        ids = c.sp.encode(TEXTS[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((c.sp.decode(ids) if ids else "").encode()).hexdigest()
    assert piece_codec.piece_report(none, model).count() == 0


def test_pipeline_gives_ids(spark, docs):
    import corpus_pipeline

    c = piece_codec.PieceCodec(tokenizer_path("piece_bpe_32k.model"))
    for r in corpus_pipeline.encode(spark, docs, "").collect():
        assert r.ids == c.sp.encode(TEXTS[r.doc_id] or "") and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()


def test_lm(docs, none):
    got = {r.doc_id: r for r in lm_score.score_texts(docs).collect()}
    c, pairs, toks = Counter(), Counter(), {}
    for i, t in enumerate(TEXTS):
        toks[i] = [*W.findall(lower(t)), None]
        if zlib.crc32(str(i).encode()) % 10:
            c.update(toks[i])
            pairs.update(zip([0, *toks[i][:-1]], toks[i]))
    n, v = sum(c.values()), len(c)
    z = n + 0.1 * (v + 1)
    assert set(got) == set(toks)
    for i, w in toks.items():
        p = [(c[x] + 0.1) / z for x in w]
        s = sum(math.log10((pairs[a, x] + 20 * q) / (c[None if a == 0 else a] + 20)) for a, x, q in zip([0, *w[:-1]], w, p))
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(c[x] > 0 for x in w), n, zlib.crc32(str(i).encode()) % 10 == 0)
        assert math.isclose(r.base_score, sum(map(math.log10, p)), abs_tol=1e-6) and math.isclose(r.score, s, abs_tol=1e-6)
    assert lm_score.score_texts(none).count() == 0


def brute_components(texts):
    sets = {}
    for i, t in enumerate(texts):
        w = W.findall(lower(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("chunk", "rows", "hot"), [(4_000_000, 256, 1000), (300, 256, 1000), (4_000_000, 3, 1), (4_000_000, 256, 12)])
def test_ngram_join(docs, none, chunk, rows, hot):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(docs, chunk_grams=chunk, chunk_rows=rows, hot_classes=hot).collect()}
    assert got == brute_components(TEXTS)
    assert ngram_join.ngram_components(none).count() == 0


def test_ngram_join_clears_its_disk(spark, docs):
    """Shuffle files and checkpointed n-grams go as soon as the next checkpoint stands, without the driver's collector."""
    from veridata.llm._common import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    blocks = sc._jsc.sc().env().blockManager().diskBlockManager()
    saved = Path(sc._jsc.sc().getCheckpointDir().get().removeprefix("file:"))

    def shuffled():
        files = blocks.getAllFiles()
        return {f.getName(): f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}

    def checkpointed():
        return {str(f): f.stat().st_size for f in saved.rglob("part-*")}

    old_files, old_parts = set(shuffled()), set(checkpointed())
    got = ngram_join.ngram_components(docs)
    for _ in range(50):  # executors remove files a moment after they are told
        left = sum(size for name, size in shuffled().items() if name not in old_files)
        if left < 4_000:
            break
        time.sleep(0.2)
    assert left < 4_000  # of totals of a row each
    assert sum(size for name, size in checkpointed().items() if name not in old_parts) < 8_000  # ids and classes, no n-grams
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    want = brute_components(TEXTS)
    for _ in range(2):
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want


@pytest.mark.parametrize("chunk", [4_000_000, 300])
def test_ngram_links(docs, none, chunk):
    sets = {}
    for i, t in enumerate(TEXTS):
        w = W.findall(lower(t))
        sets.setdefault(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else i, i)
    of = {i: s for s, i in sets.items() if s != i}
    want = {(a, b, len(of[a] & of[b])) for a, b in itertools.combinations(sorted(of), 2) if 100 * len(of[a] & of[b]) >= 80 * len(of[a] | of[b])}
    assert len(want) > len({x for p in want for x in p[:2]})  # more links than a walk needs
    got = [tuple(r) for r in ngram_join.ngram_links(docs, chunk_grams=chunk).collect()]
    assert len(got) == len(want) and set(got) == want
    ends = Counter(x for p in want for x in p[:2])
    assert {r.class_id: r.n_links for r in ngram_join.link_counts(docs, chunk_grams=chunk).collect()} == {i: ends[i] for i in sets.values()}
    assert ngram_join.link_counts(none).count() == 0


def test_ngram_links_statement(spark):
    import duckdb

    from veridata.llm import queries, sql

    c = duckdb.connect()
    c.sql("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    got = sorted((r.class_id, r.n_links) for r in queries.op4_ngram_links(spark, "/root/testdata/sf0.001").collect())
    assert got == sorted(c.sql(sql.ORACLES["op4_ngram_links"]).fetchall())


@pytest.mark.parametrize("rows", [256, 5])
def test_ngram_chains_and_apart_texts(spark, rows):
    """A chain, in which each text only links with its neighbours, a dense group, and texts that share much and link with none."""
    r = random.Random(21)
    line = [f"w{i}" for i in range(400)]
    texts = [" ".join(line[6 * i : 6 * i + 100]) for i in range(30)]
    stock = [" ".join(f"s{r.randrange(10**6)}" for _ in range(30)) for _ in range(4)]
    texts += [" ".join([*stock, *(f"o{r.randrange(10**6)}" for _ in range(55))]) for _ in range(25)]
    texts += [" ".join(["dense"] * r.randint(0, 3) + line[:60]) for _ in range(12)]
    r.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.ngram_components(df, chunk_rows=rows).collect()}
    assert got == brute_components(texts)


def test_ngram_nulls(spark):
    df = spark.createDataFrame([(None, BASE), (1, BASE), (1, BASE), (2, None)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in ngram_join.ngram_components(df).collect())
    assert got == [(-1, -1), (1, 1), (1, 1), (2, 2)]


def brute_topk(rows, k=5):
    q = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v) in enumerate(q):
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, (j, w) in enumerate(q) if m != n)[:k]
            out += [(i, r + 1, j, min(max(-s, -(2**63)), 2**63 - 1)) for r, (s, j) in enumerate(best)]
    return sorted(out)


def topk(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"label": F.lit(1), "n": F.lit("clash"), "v": F.lit(2)})
    return sorted(tuple(r) for r in pivot_search.top_inner_products(df, **more).collect())


@pytest.mark.parametrize("rows_a_segment", [20_000, 30])
def test_topk(spark, rows_a_segment):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(float).tolist()) for i in range(300)] + [(300 + i, [0.5] * 8) for i in range(20)]
    rows += [(400, None), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(450, [2.0, 1.0]), (451, []), (500, [0.25] * 12)]
    assert topk(spark, rows, segment_rows=rows_a_segment) == brute_topk(rows)
    assert topk(spark, rows[:0]) == [] and topk(spark, [(0, [1.0])]) == []


def test_topk_repeated_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, -1.0]), (1, [0.5, 0.5]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [0.0, 0.0]), (50, [-0.0, 1.0]), (50, [0.0, 1.0])]
    assert topk(spark, rows) == brute_topk(rows)
    assert topk(spark, [(0, [1.0])] * 9) == brute_topk([(0, [1.0])] * 9)


def test_topk_large_values(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=6) * 1e8).round(3).tolist()) for i in range(120)] + [(200 + i, [1e8, 1.0, 0.0, 0.0, 0.0, i / 256]) for i in range(30)]
    assert topk(spark, rows) == brute_topk(rows)
    rows = [(i, [x, 1.0]) for i, x in enumerate([1e300, -1e300, 3.0, 1e300, 5e299])]
    assert topk(spark, rows) == brute_topk(rows)


def test_blocks():
    for ids in ([], [0], [2**32 - 1, 0], [5] * 9000, list(range(70_000)), [R.randrange(50_000) for _ in range(20_000)]):
        data = token_store.encode_shard(np.array(ids, np.uint32))
        assert token_store.read_shard(data).tolist() == ids
        assert token_store.read_shard(data, 4000, 9000).tolist() == ids[4000:9000]


def test_unit_encoder():
    e = token_store.UnitEncoder(tokenizer_path("byte_bpe_50k.json"), keep=300)
    texts = [t for t in TEXTS if t] + ["<|endoftext|> a"]
    texts += ["".join(R.choice(["a", "b", " ", " ", "\n", "'s", "1", ".", "é", "\t", "\xa0", "\0", "日"]) for _ in range(R.randint(1, 14))) for _ in range(2000)]
    for t in texts:
        assert np.frombuffer(e.encode(t), "<u4").tolist() == e.tok.encode(t, add_special_tokens=False).ids, t


def test_token_store(docs, none):
    path = tokenizer_path("byte_bpe_50k.json")
    tok, at = token_store.UnitEncoder(path).tok, 0
    got = {r.doc_id: r for r in token_store.token_report(docs, path).collect()}
    for i, t in enumerate(TEXTS):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_store.token_report(none, path).count() == 0


def test_substring(spark):
    passage = prose(60)
    rows = [(i, f"{prose(40)} {passage if i % 2 else prose(50)} {prose(30)}") for i in range(30)] + [(90, None), (91, ""), (92, "a" * 5000)]
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, r in got.items() if r.has_passage} == {i for i in range(30) if i % 2}
    assert got[1].removed_bytes == 0 and got[3].removed_bytes >= substring_dedup.MIN_RUN and got[1].text == dict(rows)[1]
    assert len(got) == len(rows)


def covered_words(texts, n=51):
    """Numbers of each text's words in any n-word stretch that another text holds."""
    parts = {i: [m.span() for m in W.finditer(t)] for i, t in texts.items()}
    held = {}
    for i, p in parts.items():
        for k in range(len(p) - n + 1):
            held.setdefault(texts[i][p[k][0] : p[k + n - 1][1]], set()).add(i)
    return {i: {k + j for k in range(len(p) - n + 1) if len(held[texts[i][p[k][0] : p[k + n - 1][1]]]) > 1 for j in range(n)} for i, p in parts.items()}


def passages_of(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.doc_id: r for r in substring_dedup.repeated_passages(df, block_bytes=20_000).collect()}


def test_substring_finds_every_passage(spark):
    r = random.Random(8)
    short = lambda n: " ".join(r.choice("abcdefghijklmnopqrstuvwxyz") * r.randint(1, 2) for _ in range(n))
    texts = {}
    for i in range(40):
        same = short(51 if i % 2 else 50)
        for j in range(2):
            texts[2 * i + j] = f"{short(r.randint(0, 60))} {same} {short(r.randint(0, 60))}".strip()
    got, want = passages_of(spark, texts), covered_words(texts)
    assert all(want[i] for i in texts if i // 2 % 2)
    assert {i: (x.n_repeated, x.has_passage) for i, x in got.items()} == {i: (len(w), bool(w)) for i, w in want.items()}
    han = "".join(chr(0x4E00 + r.randrange(5000)) for _ in range(60))
    got = passages_of(spark, {1: f"甲乙{han}丙", 2: f"{prose(9)} 丁{han}戊", 3: "丁丙"})
    assert [got[i].n_repeated for i in (1, 2, 3)] == [60, 60, 0] and got[2].text.endswith("丁戊")


def test_substring_chains_no_phrases(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 8)))
    phrases = [" ".join(word() for _ in range(40)) for _ in range(8)]
    texts = {i: f"{word()} {p} {word()}" for i, p in enumerate(phrases)} | {100: " ".join(phrases)}
    got = passages_of(spark, texts)
    assert not any(x.has_passage or x.removed_bytes for x in got.values()) and got[100].text == texts[100]


def test_chunks_cover():
    for t in [b"", b"a", b"ab" * 40, prose(500).encode(), ("é😀" * 900).encode(), b"z" * 3000]:
        ends = substring_dedup.chunk_ends(t)
        assert (ends or [0])[-1] == len(t) and all(a < b <= a + substring_dedup.LONGEST for a, b in zip([0, *ends], ends))
        a = 0
        for e in ends:
            t[a:e].decode()
            a = e


def test_gear_window():
    d = np.frombuffer(prose(50).encode(), np.uint8)
    h = substring_dedup.gear_hash(d, 8)
    k = 40
    want = 0
    for x in d[k - 7 : k + 1]:
        want = ((want << 2) + int(substring_dedup._GEAR[x])) & 0xFFFFFFFF
    assert int(h[k]) == want


def test_suffix_automaton():
    for _ in range(100):
        ws = ["".join(R.choice("abc") for _ in range(R.randint(1, 8))) for _ in range(5)]
        subs = {w[i:j] for w in ws for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        a = lang_id.SuffixAutomaton(ws)
        for _ in range(30):
            s, n, i = "".join(R.choice("abcd") for _ in range(9)), 0, 0
            while i < len(s):
                j = i + 1
                while j < len(s) and s[i : j + 1] in subs:
                    j += 1
                n, i = n + 1, j
            assert a.phrases(s) == n


def test_language_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = lang_id.predict_languages(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert r[0] > 0.97 and r[1] >= 0 and r[2] <= 1


def brute_language(sample, text):
    """The label by the definition alone: longest substrings of the sampled words, one behind the other."""
    words = [w.lower() for w in re.findall(r"[^\W\d_]+", (text or "").lower()) if w.isalpha()]
    if not words or not sample:
        return "und", 0.0
    bits = {}
    for label, known in sample:
        subs = {f" {w} "[i:j] for w in known for i in range(len(w) + 2) for j in range(i + 1, len(w) + 3)}
        n = 0
        for w in words:
            s, i = f" {w} ", 0
            while i < len(s):
                j = i + 1
                while j < len(s) and s[i : j + 1] in subs:
                    j += 1
                n, i = n + 1, j
        bits[label] = n * math.log2(sum(len(w) + 2 for w in known) + 2) / sum(len(w) + 2 for w in words)
    best, *rest = sorted((b, k) for k, b in bits.items())
    return best[1], 1 - best[0] / rest[0][0] if rest else 1.0


def test_language_against_definition(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sample = lang_id.learn_sample(d, train_docs=20, train_words=300)
    texts = {r.doc_id: r.text for r in d.collect()}
    for r in lang_id.predict_languages(d, sample=sample).collect():
        label, score = brute_language(sample, texts[r.doc_id])
        assert r.lang_pred == label and math.isclose(r.score, score, abs_tol=1e-9), r


def test_language_ties_numerals_and_labels(spark):
    both = (("de", ("ab",)), ("en", ("ab",)))
    rows = [(1, "ab"), (2, "½ ² Ⅷ"), (3, "½ab²"), (4, "١٢ 三"), (None, "ab"), (1, "ab"), (5, "12 _ !")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit(None).cast("string"), "score": F.lit("clash"), "bits": F.lit(1)})
    got = [(r.doc_id, r.lang_pred, r.score) for r in lang_id.predict_languages(df, sample=both).collect()]
    assert got == [(1, "de", 0.0), (2, "und", 0.0), (3, "de", 0.0), (4, got[3][1], got[3][2]), (None, "de", 0.0), (1, "de", 0.0), (5, "und", 0.0)] and got[3][1] == "de"
    assert {r.lang_pred for r in lang_id.predict_languages(df).collect()} == {"und"}  # every label is null
    assert lang_id.keep_identified(df).count() == 0


def test_language_learns_from_every_text(spark):
    r = random.Random(23)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 7))) for _ in range(3000)]
    rows = [(i, " ".join(vocab[min(r.randrange(3000), r.randrange(3000))] for _ in range(r.randint(1, 12))), ["en", "de", None][i % 3]) for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fold = {i: zlib.crc32(str(i).encode()) % 4 for i, *_ in rows}
    counts = {x: Counter(w for i, t, lang in rows if lang == x and fold[i] != 2 for w in set(t.split())) for x in ("de", "en")}
    assert lang_id.learn_sample(df) == tuple((x, tuple(sorted(c))) for x, c in counts.items())
    for x, got in lang_id.learn_sample(df, train_words=500):
        least = min(counts[x][w] for w in got)
        assert abs(len(got) - 500) < 60 and {w for w, n in counts[x].items() if n > least} < set(got)
    sample = tuple((x, tuple(w for w, n in c.items() if n > 2)) for x, c in counts.items())
    parser, needs = lang_id.CrossParser({k: list(v) for k, v in sample}), {}
    for i, t, lang in rows:
        if lang and fold[i] != 2:
            won, _, need = parser.need(t)
            for k in (won, None):
                needs.setdefault(k, []).append(need)
    limits = lang_id.learn_limits(df, dict.fromkeys((0, 1, 3), sample))
    assert set(limits) == set(needs) and len(needs[None]) > 4000
    for k, v in needs.items():
        low = sorted(v)[-1 - len(v) // 1000]
        assert low < limits[k] / (1 + lang_id.SLACK + 1 / math.sqrt(len(v))) <= low + 1.001 / lang_id.NEED_BINS


def test_language_edges(docs, none):
    got = {r.doc_id: r for r in lang_id.predict_languages(docs).collect()}
    assert len(got) == len(TEXTS) and {got[i].lang_pred for i in (0, 1, 2)} == {"und"}
    assert lang_id.predict_languages(none).count() == 0
    assert lang_id.keep_identified(docs).columns == docs.columns


def test_unknown_languages_go(spark):
    import corpus_pipeline

    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = random.Random(5)
    bad = [
        " ".join(f"{r.getrandbits(32):08x}" for _ in range(200)),
        " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(100)),
        "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa",
        "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью",
    ]
    extra = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(bad)], "doc_id long, text string")
    docs = d.unionByName(extra, allowMissingColumns=True)
    gone = docs.select("doc_id").subtract(corpus_pipeline.identify(spark, docs, "").select("doc_id"))
    assert {x.doc_id for x in gone.collect()} == {10**9 + i for i in range(len(bad))}


NOTICES = {
    "This file is subject to the Apache\n/ License, Version 2.0": {"apache-2.0"},
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": {"unknown"},
    "Distributed under the terms of the ISC license": {"unknown"},
    "Licence MIT": {"mit"},
    "Lizenziert unter der MIT-Lizenz": {"mit"},
    "Eclipse Public License v2.0 applies": {"unknown"},
    "Dual licensed under MIT or Apache-2.0": {"mit", "apache-2.0"},
    "This work is licensed under the GNU General Public License, version 3.": {"gpl"},
    "All rights reserved.": {"proprietary"},
    "Licensed under CC BY-NC 4.0.": {"cc-by-nc"},
    "Er geht mit dem Hund.": set(),
    "Ungte mit.": set(),
    "The license plate was lost on the common road.": set(),
    "It was released under pressure.": set(),
}


def test_licenses(spark):
    rows = [(i, t) for i, t in enumerate(NOTICES)] + [(90, None), (91, ""), (92, "\n\n"), (93, "foo.\nLicensed under the MIT License.\nbar"), (None, "All rights reserved."), (94, "All rights reserved."), (94, "All rights reserved."), (95, "x " * 50_000 + "\n\nReleased under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"paragraph": F.lit("clash"), "family": F.lit(1), "p": F.lit(2)})
    got = license_scan.scan_licenses(df).collect()
    for i, want in enumerate(NOTICES.values()):
        assert {r.family for r in got if r.doc_id == i} == want, i
    assert [(r.paragraph, r.family, r.confirmed) for r in got if r.doc_id == 93] == [(1, "mit", True)]
    assert [r.family for r in got if r.doc_id is None] == ["proprietary"] and sum(r.doc_id == 94 for r in got) == 2
    assert [(r.paragraph, r.family) for r in got if r.doc_id == 95] == [(1, "mit")] and not any(r.doc_id in (90, 91, 92) for r in got)
    assert license_scan.scan_licenses(df.where("doc_id < 0")).count() == 0
    assert "Python" not in license_scan.scan_licenses(df)._jdf.queryExecution().executedPlan().toString()


def test_licenses_against_definition(spark):
    r = random.Random(31)
    lines = [t for t, *_ in license_scan.labelled(license_scan.corpus()["frames"])]
    texts = ["\n".join(r.choice([r.choice(lines), prose(r.randint(1, 9)), prose(r.randint(1, 9)) + ".", ""]) for _ in range(r.randint(1, 12))) for _ in range(150)]
    want = {(i, k, f) for i, t in enumerate(texts) for k, par in enumerate(re.split(license_scan._END, t)) for f in license_scan.predict(par)}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for skip in (True, False):
        assert {(x.doc_id, x.paragraph, x.family) for x in license_scan.scan_licenses(df, skip=skip).collect()} == want
    assert len(want) > 150


def test_licenses_of_unseen_ways(spark):
    rows = license_scan.labelled(license_scan.corpus()["frames"])
    classes, *_ = license_scan.trained()
    out = np.array([n % 5 == 1 for *_, n in rows])
    x, y = license_scan._matrix(rows, license_scan.features([r for r, o in zip(rows, out) if not o]), classes)
    w, b = license_scan.fit(x[~out], y[~out])
    hit = {"known": [], "unknown": [], "clean": []}
    for (_, label, _), z in zip([r for r, o in zip(rows, out) if o], x[out] @ w + b):
        said = {c for c, v in zip(classes[:-1], z) if v >= 0}
        kind = "clean" if not label else "unknown" if license_scan.UNKNOWN in label else "known"
        hit[kind].append(label <= said if kind == "known" else not said and (z[-1] >= 0) == (kind == "unknown"))
    assert all(np.mean(v) > 0.9 for v in hit.values()), {k: np.mean(v) for k, v in hit.items()}


def test_few_edges_need_few_stages(spark):
    from veridata.llm._graph import connected_components

    r = random.Random(31)
    pairs = [(i, i + 1) for i in range(300)] + [(1000 - i, 2000 + i) for i in range(40)] + [(r.randrange(5000, 6000), r.randrange(5000, 6000)) for _ in range(450)] + [(-7, 3), (8, 8)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    root = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in root:
        was = dict(root)
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
        if was == root:
            break
    tracker = spark.sparkContext.statusTracker()
    for most in (0, 100, 250_000):
        spark.sparkContext.setJobGroup(f"components-{most}", "")
        got = {(x.node, x.component) for x in connected_components(edges, driver_edges=most).collect()}
        assert got == set(root.items())
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = [len(tracker.getJobIdsForGroup(f"components-{most}")) for most in (0, 250_000)]
    assert jobs[1] <= 8 < jobs[0]
    assert connected_components(edges.where("a = b")).count() == 0


def test_decontaminate(spark):
    item, other = prose(30), prose(25)
    bench = spark.createDataFrame([(1, item), (2, other), (3, "rareword"), (4, None), (5, "")], "item_id long, text string")
    rows = [(10, f"{prose(200)} {item} {prose(100)}"), (11, prose(300)), (12, f"it is RAREWORD here"), (13, None), (14, ""), (None, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(7))
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contained_items(docs, bench).collect()) == [(10, 1), (12, 3)]
    assert decontaminate.contained_items(docs, bench.where("item_id < 0")).count() == 0
    assert sorted(r.doc_id or 0 for r in decontaminate.drop_contaminated(docs, bench).collect()) == [0, 11, 13, 14]


def test_decontaminate_against_definition(spark):
    r = random.Random(17)
    bench = {i: prose(r.randint(1, 40)) for i in range(25)} | {40: "a b c d e", 41: "a b c d", 42: "a b a b a b a b"}
    texts = {}
    for i in range(120):
        w = []
        for _ in range(r.randint(0, 4)):
            part = r.choice(list(bench.values())).split() if r.random() < 0.7 else prose(r.randint(1, 30)).split()
            cut = r.choice([0, 0, 1, 2, 5])
            w += part[cut:] if r.random() < 0.5 else part[: len(part) - cut]
        texts[i] = " ".join(w).upper() if i % 7 == 0 else " ".join(w)
    texts[200] = " ".join(prose(30_000).split() + bench[3].split())
    want = set()
    for k, b in bench.items():
        words = b.lower().split()
        n = min(5, len(words))
        own = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        for d, t in texts.items():
            w = t.lower().split()
            share = len(own & {tuple(w[i : i + n]) for i in range(len(w) - n + 1)})
            if share >= math.ceil(len(own) * 0.8 - 1e-12):
                want.add((d, k, share, len(own)))
    items = spark.createDataFrame(list(bench.items()), "item_id long, text string")
    docs = spark.createDataFrame([*texts.items(), (5, texts[5])], "doc_id long, text string").withColumns({"n": F.lit(1), "shingle": F.lit("clash"), "size": F.lit(3)})
    got = decontaminate.contained_items(docs, items.unionAll(items)).collect()
    assert {(x.doc_id, x.item_id, x.n_shared, x.n_item) for x in got} == want and len(got) == len(want) > 30
    assert "Python" not in decontaminate.contained_items(docs, items)._jdf.queryExecution().executedPlan().toString()


def test_pipeline(spark):
    import corpus_pipeline

    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = d
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == d.columns, name
    ids = {r.doc_id for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").select("doc_id").collect()}
    texts = {r.doc_id: r.text for r in d.collect()}
    left = {i for i, t in texts.items() if t and any(map(str.isalpha, t))}
    order = sorted(left)
    comp = brute_components([texts[i] for i in order])
    left = {order[i] for i, (_, c) in comp.items() if i == c}
    bench = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]

    def shingles(t):
        w = W.findall(t.lower())
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    items = [shingles(b) for b in bench]
    assert ids == {i for i in left if all(len(s & shingles(texts[i])) < 0.8 * len(s) for s in items)}
