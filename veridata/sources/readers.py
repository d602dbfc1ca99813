"""Scans and sinks with the guards a dataset release needs. Paths are those of Spark's file systems."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import blank, recoded


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table; columns and filters are pruned by the plan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Files:
    """The few file operations that are not scans, on any file system that Spark can open, streamed through the JVM."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def path(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self.path(path)
        return fs.exists(p)

    def digest(self, path: str) -> tuple[int, str]:
        """Bytes and SHA-256 of one file of any size."""
        fs, p = self.path(path)
        md = self.jvm.java.security.MessageDigest.getInstance("SHA-256")
        stream = self.jvm.java.security.DigestInputStream(fs.open(p), md)
        self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, self.jvm.java.io.OutputStream.nullOutputStream(), 1 << 20, True)
        return fs.getFileStatus(p).getLen(), bytes(md.digest()).hex()

    def tree(self, folder: str) -> dict[str, str]:
        """SHA-256 of every file below a folder by its path in it, but for markers and checksum files."""
        fs, p = self.path(folder)
        root, found, todo = fs.resolvePath(p).toString().rstrip("/"), {}, [p]
        while todo:
            for st in fs.listStatus(todo.pop()):
                name = st.getPath().toString()
                if st.isDirectory():
                    todo.append(st.getPath())
                elif not st.getPath().getName().startswith(("_", ".")):
                    found[name.split(root, 1)[-1].lstrip("/")] = self.digest(name)[1]
        return dict(sorted(found.items()))

    def write_text(self, path: str, text: str) -> str:
        """The text as a file that is there whole or not at all; its SHA-256."""
        fs, p = self.path(path)
        part = self.jvm.org.apache.hadoop.fs.Path(f"{path}.part")
        out = fs.create(part, True)
        out.write(bytearray(text.encode("utf-8")))
        out.hsync()
        out.close()
        fs.delete(p, False)
        if not fs.rename(part, p):
            raise OSError(f"{path} could not be put in place")
        return self.digest(path)[1]

    def move(self, source: str, target: str) -> None:
        fs, p = self.path(source)
        if self.exists(target) or not fs.rename(p, self.path(target)[1]):
            raise FileExistsError(f"{target} is there already")

    def new_folder(self, path: str) -> str:
        """A folder that must not be there yet."""
        fs, p = self.path(path)
        if fs.exists(p):
            raise FileExistsError(f"{path} is there already")
        fs.mkdirs(p)
        return path


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under a declared schema; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def read_jsonl_with_digest(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, str]:
    """The rows, and the SHA-256 of the file's exact bytes."""
    return read_jsonl(spark, path, schema), Files(spark).digest(path)[1]


def read_csv_exact(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """CSV whose header must be exactly this one; all columns are strings, quoted newlines stay inside a field, and an empty
    field is an empty string."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', nullValue="\u0000", emptyValue="")
    if df.columns != header:
        raise ValueError(f"header {df.columns} is not {header}")
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in header])


def read_csv_lenient(spark: SparkSession, path: str, aliases: dict[str, str], numbers: dict[str, str]) -> DataFrame:
    """CSV with a header: a byte order mark and spaces around names go, names are those of ``aliases`` (in lower case) where it
    has them, and numeric columns keep their text beside the number (as ``<name>_raw``), which is null where there is none."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    names = [c.replace("﻿", "").strip() for c in df.columns]
    df = df.toDF(*[aliases.get(n.lower(), n) for n in names])
    for c, kind in numbers.items():
        df = df.withColumn(f"{c}_raw", F.col(c)).withColumn(c, F.trim(F.col(c)).try_cast(kind))
    return df


def read_rows(spark: SparkSession, stem: str, schema: str, aliases: dict[str, str], numbers: dict[str, str]) -> DataFrame:
    """``stem.jsonl`` if there is one, else ``stem.csv``."""
    if Files(spark).exists(f"{stem}.jsonl"):
        return read_jsonl(spark, f"{stem}.jsonl", schema)
    return read_csv_lenient(spark, f"{stem}.csv", aliases, numbers)


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """physical, logical: lines of a CSV file, its header among them, and its records; quoted newlines make the difference."""
    lines = spark.read.text(path).agg(F.count("*").alias("physical"))
    records = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"').agg(F.count("*").alias("logical"))
    return lines.join(F.broadcast(records))


def read_tsv_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Lines cut at the first tab only; lines without a tab or with an empty side are left out."""
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).select(F.trim(parts[0]).alias("segment_id"), F.trim(F.get(parts, F.lit(1))).alias("text")).where("segment_id <> '' and text is not null and text <> ''")


def read_shards(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Columns of a sharded Parquet table, without reading any other, with each row's shard and place in it: a stable order."""
    df = spark.read.parquet(path)
    return df.select(*columns, F.element_at(F.split("_metadata.file_path", "/"), -1).alias("_shard"), F.col("_metadata.row_index").alias("_row_index"))


def payload_digests(df: DataFrame, payload: str, key: str) -> DataFrame:
    """key and the SHA-256 of a binary column, null where it is empty; no other column is read."""
    return df.select(key, F.when(F.octet_length(payload) > 0, F.sha2(payload, 256)).alias("sha256"))


def payload_of(df: DataFrame, keys: DataFrame, key: str, payload: str) -> DataFrame:
    """key and payload of the named rows; a few keys are broadcast by the engine's own size check, so the payload of others is
    never shuffled."""
    return df.select(key, payload).join(keys.select(key).distinct(), key, "left_semi")


def flattened(df: DataFrame, columns: dict[str, str], recode: dict[str, tuple[str, dict[str, str]]], markers: tuple[str, ...] = ()) -> DataFrame:
    """A manifest of nested rows: names by path, texts trimmed, markers as null, codes as labels. A code without a label is an
    error that names it, not a null."""
    clean = lambda c: F.when(F.lower(F.trim(c)).isin("", *markers), F.lit(None)).otherwise(F.trim(c))
    kinds = dict(df.select(*[F.col(p).alias(n) for n, p in columns.items()]).dtypes)
    out = df.select(*[(clean(F.col(p)) if kinds[n] == "string" else F.col(p)).alias(n) for n, p in columns.items()])
    for name, (source, codes) in recode.items():
        unknown = out.where(~blank(source) & recoded(source, codes).isNull()).select(source).limit(1).collect()
        if unknown:
            raise ValueError(f"{source} has the unknown code {unknown[0][0]!r}")
        out = out.withColumn(name, recoded(source, codes))
    return out


def source_digest(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, length, sha256 of source files, streamed, so of any size."""
    files = Files(spark)
    return spark.createDataFrame([(p, *files.digest(p)) for p in paths], "path string, length long, sha256 string")


def verify_source(spark: SparkSession, path: str, length: int, sha256: str) -> str:
    """The path, once its bytes are shown to be the pinned ones."""
    got = Files(spark).digest(path)
    if got != (length, sha256):
        raise ValueError(f"{path} has {got[0]} bytes of {got[1]}, not {length} of {sha256}")
    return path


RESERVED = ("test", "val", "valid", "validation", "dev", "hard")


def train_path(path: str, reserved: tuple[str, ...] = RESERVED) -> str:
    """The path, if no part of its file name is that of a reserved split."""
    name = path.replace("\\", "/").rsplit("/", 1)[-1].lower()
    hit = [t for t in re.split(r"[^a-z0-9]+", name) if re.sub(r"\d+$", "", t) in reserved]
    if hit:
        raise ValueError(f"{path} names the reserved split {hit[0]}")
    return path


class Catalog:
    """Where each dataset's splits lie; a split that isn't listed for a dataset is refused."""

    def __init__(self, paths: dict[str, dict[str, str]], allowed: tuple[str, ...] = ("train",)):
        self.paths, self.allowed = paths, allowed

    def path(self, dataset: str, split: str) -> str:
        if split not in self.allowed:
            raise ValueError(f"split {split} is not among {self.allowed}")
        try:
            return self.paths[dataset][split]
        except KeyError:
            raise ValueError(f"no path for {dataset}/{split}") from None


def only_splits(df: DataFrame, split: str, allowed: tuple[str, ...]) -> DataFrame:
    """The table, once it is shown to hold no other split."""
    other = df.where(~F.col(split).isin(*allowed) | F.col(split).isNull()).select(split).limit(1).collect()
    if other:
        raise ValueError(f"split {other[0][0]!r} is not among {allowed}")
    return df


def manifest_faults(df: DataFrame) -> DataFrame:
    """fault, n over rows (id, audio, question, choices, answer): missing parts, an answer that is not exactly one of the
    choices after folding, and ids that occur again."""
    fold = lambda c: F.lower(F.trim(c))
    hits = F.size(F.filter("choices", lambda c: fold(c) == fold(F.col("answer"))))
    none = F.coalesce(F.size("choices") < 2, F.lit(True))
    faults = F.array_compact(F.array(F.when(blank("id"), "NO_ID"), F.when(F.coalesce(F.size("audio") < 1, F.lit(True)), "NO_AUDIO"), F.when(blank("question"), "NO_QUESTION"), F.when(none, "TOO_FEW_CHOICES"), F.when(~none & F.coalesce(hits != 1, F.lit(True)), "ANSWER_NOT_ONE_CHOICE")))
    again = df.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").agg(F.count("*").alias("n")).where("n > 0").select(F.lit("REPEATED_ID").alias("fault"), "n")
    return df.select(F.explode(faults).alias("fault")).groupBy("fault").agg(F.count("*").alias("n")).unionAll(again)


def load_manifest(spark: SparkSession, path: str, rows: int | None = None, sha256: str | None = None) -> DataFrame:
    """A question manifest that keeps its contract: its bytes, its number of rows, and no faults."""
    if sha256 and Files(spark).digest(path)[1] != sha256:
        raise ValueError(f"{path} is not the file with hash {sha256}")
    df = read_jsonl(spark, path, "id string, audio array<string>, question string, choices array<string>, answer string")
    faults = [tuple(r) for r in manifest_faults(df).collect()]  # a row a kind of fault
    if faults:
        raise ValueError(f"{path}: {faults}")
    if rows is not None and df.count() != rows:
        raise ValueError(f"{path} has {df.count()} rows, not {rows}")
    return df


class ArtifactStore:
    """Files by the hash of their bytes."""

    def __init__(self, spark: SparkSession, root: str):
        self.files, self.root = Files(spark), root.rstrip("/")

    def retain(self, path: str) -> str:
        """Keep a copy of the file; its hash, which is its name here."""
        sha = self.files.digest(path)[1]
        target = f"{self.root}/{sha[:2]}/{sha}"
        if not self.files.exists(target):
            (fs, p), (fs2, q) = self.files.path(path), self.files.path(target)
            self.files.jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, fs2, q, False, self.files.conf)
        return sha

    def resolve(self, sha: str) -> str:
        target = f"{self.root}/{sha[:2]}/{sha}"
        if not self.files.exists(target) or self.files.digest(target)[1] != sha:
            raise FileNotFoundError(f"no whole artefact {sha}")
        return target


def json_line(df: DataFrame) -> Column:
    """Each row as one JSON object by name order, nulls written."""
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})


def write_jsonl(df: DataFrame, folder: str, order: list[str]) -> None:
    """Sorted JSON lines; a folder that exists is refused."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists").json(folder)


def write_jsonl_atomic(df: DataFrame, folder: str, order: list[str]) -> dict[str, str]:
    """Sorted JSON lines with sorted names in a folder that is there whole or not at all; the hash of each file."""
    spark = df.sparkSession
    files = Files(spark)
    if files.exists(folder):
        raise FileExistsError(f"{folder} is there already")
    lines = df.select(*order, json_line(df).alias("value"))
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(f"{folder}.part")
    files.move(f"{folder}.part", folder)
    return files.tree(folder)


def write_release(folder: str, internal: DataFrame, model: DataFrame, audit: DataFrame, policy: dict, expected: dict[str, int] | None = None) -> dict:
    """A release: internal and model records, audit and policy, and a manifest with the hash of every file.

    Records are counted by type in what was written, which no recomputed task can count twice. Counts other than the expected
    ones stop the release before the manifest, without which a folder is no release.
    """
    spark = internal.sparkSession
    files = Files(spark)
    files.new_folder(folder)
    hashes = {f"internal/{k}": v for k, v in write_jsonl_atomic(internal, f"{folder}/internal", ["qa_id"]).items()}
    written = spark.read.schema("type_id string").json(f"{folder}/internal")
    counts = {r.type_id: r.n for r in written.groupBy("type_id").agg(F.count("*").alias("n")).collect()}  # a row a type
    if expected is not None and counts != {t: n for t, n in expected.items() if n}:
        raise ValueError(f"release has {counts}, not {expected}")
    hashes |= {f"model/{k}": v for k, v in write_jsonl_atomic(model, f"{folder}/model", ["id"]).items()}
    told = [r.asDict(recursive=True) for r in audit.collect()]  # a row a check
    for name, what in (("audit", told), ("policy", policy)):
        hashes[f"{name}.json"] = files.write_text(f"{folder}/{name}.json", json.dumps(what, sort_keys=True, ensure_ascii=False, default=str))
    manifest = {"records": sum(counts.values()), "per_type": counts, "files": dict(sorted(hashes.items()))}
    files.write_text(f"{folder}/manifest.json", json.dumps(manifest, sort_keys=True))
    return manifest


def report(title: str, tables: dict[str, DataFrame], rows: int = 200) -> str:
    """A Markdown page of small tables; a table of more than ``rows`` rows is named, not shown."""
    out = [f"# {title}", ""]
    for name, df in tables.items():
        held = df.limit(rows + 1).collect()
        out += [f"## {name}", ""]
        if len(held) > rows:
            out += [f"More than {rows} rows.", ""]
            continue
        out += ["| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in held] + [""]
    return "\n".join(out)


def same_trees(spark: SparkSession, a: str, b: str) -> list[str]:
    """Files that two output folders don't share byte for byte."""
    files = Files(spark)
    x, y = files.tree(a), files.tree(b)
    return sorted(k for k in x.keys() | y.keys() if x.get(k) != y.get(k))
