"""Shared plumbing of the corpus operators: inputs, sizes, byte-level words."""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Read one driver table by a path that only Spark has to understand."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns the operators read, under fixed names; other columns never get further, so their names cannot clash."""
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


#: Bytes of text whose results a scan holds before it hands them on.
SLICE_BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of at most SLICE_BYTES in column ``text``, or of one row; an empty batch stays.

    A batch has a number of rows, whatever their size: what a worker makes of a whole one may be many times its text.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at, n = 0, batch.num_rows
        while at < n or not n:
            full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right"))
            to = min(n, max(at + 1, full))
            yield batch.slice(at, to - at)
            at = to
            if not n:
                break
        del batch  # before the next one is read
        trim()


def per_document(docs: DataFrame, row: Callable[[], Callable[[str], tuple]], schema: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Narrow scan of whole texts: ``row()`` is called once a task and gives the function from a text to its output values.
    Results leave by slices of the text, so that a worker holds those of one slice at a time.

    Null text counts as empty. No shuffle; a lost task is recomputed from its input split alone.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    full = StructType.fromDDL(f"doc_id long, {schema}")
    arrow = to_arrow_schema(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = row()
        for batch in slices(batches, 1):
            out = [one(x.as_py() or "") for x in batch.column(1)]
            cols = [batch.column(0)] + [pa.array([r[i] for r in out], t.type) for i, t in enumerate(list(arrow)[1:])]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return id_text(docs, doc_id, text).mapInArrow(run, full)


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, one map-side combined aggregate; sizes the partitionings below, never selects rows."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def parts_for(spark: SparkSession, volume: int, each: int) -> int:
    """Partitions so that each holds about ``each`` bytes, two waves of the cluster's cores at least."""
    return max(2 * spark.sparkContext.defaultParallelism, math.ceil(volume / each))


#: What a worker process keeps between tasks: the tables of one operator at a time.
_KEPT: dict = {}
_RELEASE: list[Callable[[], None]] = []


#: Of the C library, where it has one.
_MALLOC_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def trim() -> None:
    """Give freed memory back to the system: workers are kept between tasks, and what one holds unused the others lack."""
    pa.default_memory_pool().release_unused()
    if _MALLOC_TRIM is not None:
        _MALLOC_TRIM(0)


def release() -> None:
    """Forget what other operators' tasks have kept in this process."""
    _KEPT.clear()
    for f in _RELEASE:
        f()
    trim()


def kept(key, make):
    """The object of this key, made once a worker process; one of another key is dropped first."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
        gc.freeze()  # the tables hold no cycles; without this each collection walks them
    return _KEPT[key]


def words(text: str | None) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z: exactly what the bytes methods do."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the session names; set one only where none is set, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            import tempfile

            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="veridata-ckpt-")
        sc.setCheckpointDir(named)


#: Spark removes the shuffle files of a statement as it ends, instead of when the driver's collector finds its plan unused.
_FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame) -> DataFrame:
    """The rows, checkpointed, without the shuffle files that led to them: nothing reads these again, and how long the
    collector would leave them lying depends on how much else the driver does."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(_FILES_GO, "false")
    spark.conf.set(_FILES_GO, "true")
    try:
        return df.select("*").checkpoint()  # a plan takes the setting as it is made
    finally:
        spark.conf.set(_FILES_GO, before)


def drop_checkpoint(df: DataFrame) -> None:
    """Remove the files of a ``settled`` frame that nothing reads any more."""
    file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        drop_folder(df.sparkSession, file.get())


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the session's checkpoint folder for a written table."""
    import uuid

    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a written table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
