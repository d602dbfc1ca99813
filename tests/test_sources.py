"""Readers, guards and writers on small files."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from veridata.sources import readers as R


def test_jsonl_and_digest(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": 1, "t": "x"}\n\n  \n{"id": 2, "t": null, "more": 3}\n')
    rows, sha = R.read_jsonl_with_digest(spark, str(p), "id long, t string")
    assert sorted(tuple(r) for r in rows.where("id is not null").collect()) == [(1, "x"), (2, None)] and sha == hashlib.sha256(p.read_bytes()).hexdigest()
    d = R.source_digest(spark, [str(p)]).first()
    assert (d.length, d.sha256) == (p.stat().st_size, sha)
    assert R.verify_source(spark, str(p), d.length, sha) == str(p)
    with pytest.raises(ValueError):
        R.verify_source(spark, str(p), d.length + 1, sha)


def test_csv(spark, tmp_path):
    p = tmp_path / "rows.csv"
    p.write_text('﻿id,Topic,n\n1,"a\nb",3\n2,,x\n3,"q ""z""", 4 \n', encoding="utf-8")
    got = R.read_csv_lenient(spark, str(p), {"topic": "topic"}, {"n": "int"})
    assert got.columns == ["id", "topic", "n", "n_raw"]
    assert sorted((r.id, r.topic, r.n, r.n_raw) for r in got.collect()) == [("1", "a\nb", 3, "3"), ("2", None, None, "x"), ("3", 'q "z"', 4, " 4 ")]
    assert tuple(R.line_counts(spark, str(p)).first()) == (5, 3)
    q = tmp_path / "exact.csv"
    q.write_text('id,t\n1,\n2," "\n')
    assert sorted(tuple(r) for r in R.read_csv_exact(spark, str(q), ["id", "t"]).collect()) == [("1", ""), ("2", " ")]
    with pytest.raises(ValueError):
        R.read_csv_exact(spark, str(q), ["t", "id"])
    (tmp_path / "rows.jsonl").write_text('{"id": "9"}\n')
    assert R.read_rows(spark, str(tmp_path / "rows"), "id string", {}, {}).first().id == "9"


def test_guards():
    assert R.train_path("/d/train_115.parquet") and R.train_path("/test/contest.csv")
    for bad in ("/d/test-0001.parquet", "a/val.jsonl", "x_hard2.csv"):
        with pytest.raises(ValueError):
            R.train_path(bad)
    c = R.Catalog({"d": {"train": "p", "test": "q"}})
    assert c.path("d", "train") == "p"
    for key in (("d", "test"), ("e", "train")):
        with pytest.raises(ValueError):
            c.path(*key)


def test_shards_and_payloads(spark, tmp_path):
    df = spark.range(20).select("id", F.struct(F.when(F.col("id") % 5 != 0, F.encode(F.col("id").cast("string"), "utf-8")).otherwise(F.encode(F.lit(""), "utf-8")).alias("bytes")).alias("audio"), F.lit(" Male ").alias("sex"))
    df.repartition(3).write.parquet(str(tmp_path / "s"))
    s = R.read_shards(spark, str(tmp_path / "s"), ["id"])
    assert s.select("_shard", "_row_index").distinct().count() == 20 and "bytes" not in s._jdf.queryExecution().executedPlan().toString()
    table = spark.read.parquet(str(tmp_path / "s"))
    got = {r.id: r.sha256 for r in R.payload_digests(table, "audio.bytes", "id").collect()}
    assert got[0] is None and got[7] == hashlib.sha256(b"7").hexdigest()
    assert {r.id for r in R.payload_of(table.select("id", "audio"), spark.range(3), "id", "audio").collect()} == {0, 1, 2}
    flat = R.flattened(table, {"row": "id", "raw": "sex"}, {"gender": ("raw", {"Male": "m"})})
    assert flat.first().gender == "m"
    with pytest.raises(ValueError):
        R.flattened(table, {"raw": "sex"}, {"gender": ("raw", {"F": "f"})})


def test_manifest(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    good = {"id": "1", "audio": ["a"], "question": "q", "choices": ["X", "y"], "answer": " x"}
    p.write_text(json.dumps(good) + "\n")
    assert R.load_manifest(spark, str(p), 1, hashlib.sha256(p.read_bytes()).hexdigest()).count() == 1
    with pytest.raises(ValueError):
        R.load_manifest(spark, str(p), 2)
    bad = [good, {**good, "audio": []}, {**good, "id": "2", "choices": ["X", "x "]}, {"id": None}]
    p.write_text("\n".join(map(json.dumps, bad)))
    df = R.read_jsonl(spark, str(p), "id string, audio array<string>, question string, choices array<string>, answer string")
    assert {r.fault: r.n for r in R.manifest_faults(df).collect()} == {"NO_AUDIO": 2, "ANSWER_NOT_ONE_CHOICE": 1, "NO_ID": 1, "NO_QUESTION": 1, "TOO_FEW_CHOICES": 1, "REPEATED_ID": 1}


def test_release(spark, tmp_path):
    internal = spark.createDataFrame([("q1", "a", None), ("q2", "b", 3)], "qa_id string, type_id string, x int")
    model = internal.select(F.col("qa_id").alias("id"), F.lit("é").alias("question"))
    audit = spark.createDataFrame([("CHECK", 0)], "check string, n_fail int")
    a, b = str(tmp_path / "r1"), str(tmp_path / "r2")
    m = R.write_release(a, internal, model, audit, {"p": 1}, {"a": 1, "b": 1})
    assert m["records"] == 2 and R.write_release(b, internal, model, audit, {"p": 1}, {"a": 1, "b": 1})["per_type"] == {"a": 1, "b": 1}
    lines = [x for f in sorted((tmp_path / "r1/internal").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == ['{"qa_id":"q1","type_id":"a","x":null}', '{"qa_id":"q2","type_id":"b","x":3}']
    x, y = (sorted(R.Files(spark).tree(f).values()) for f in (a, b))
    assert len(x) == len(y) and R.same_trees(spark, a, a) == []
    with pytest.raises(FileExistsError):
        R.write_release(a, internal, model, audit, {})
    with pytest.raises(ValueError):
        R.write_release(str(tmp_path / "r3"), internal, model, audit, {}, {"a": 2})
    assert not (tmp_path / "r3/manifest.json").exists()


def test_store_and_report(spark, tmp_path):
    f = tmp_path / "f.bin"
    f.write_bytes(b"abc")
    store = R.ArtifactStore(spark, str(tmp_path / "store"))
    sha = store.retain(str(f))
    assert sha == hashlib.sha256(b"abc").hexdigest() and store.retain(str(f)) == sha and open(store.resolve(sha), "rb").read() == b"abc"
    with pytest.raises(FileNotFoundError):
        store.resolve("0" * 64)
    text = R.report("T", {"one": spark.createDataFrame([(1, "a|b"), (2, None)], "n int, t string")})
    assert "| 1 | a\\|b |" in text and text.startswith("# T")
    assert R.Files(spark).write_text(str(tmp_path / "t.json"), "{}") == hashlib.sha256(b"{}").hexdigest()
