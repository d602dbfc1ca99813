"""Token ids in binary blocks: patched frame of reference.

A block holds up to ``BLOCK`` ids. Its smallest id is subtracted, the rest is packed at the width that covers a
percentile of the block, and the few ids that need more bits stand in an exception list (position, high bits).
A shard is a run of blocks with an index of where each block starts in the bytes and in the ids, so a reader can take any
range of ids by touching only its blocks. Layout, little-endian:

  header  "PFR1", block count u32, id count u64
  index   for each block: byte offset u64
  block   minimum u32, id count u16, width u8, (unused u8), exception count u16, then the packed bits padded to bytes,
          exception positions u16 each, exception high bits u32 each

Documents lie one behind the other in ascending doc_id; each ends with the end id. Null or empty text is the end id only.
Repeated doc_ids stay next to each other, ordered by their text.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ._common import id_text, kept, parts_for, shared_folder, text_bytes

BLOCK = 4096
PERCENTILE = 95
SHARD_TEXT_BYTES = 24 << 20
SHARD_IDS = 1 << 21
#: A space that white space or the end follows, where a run of white space is not cut before its last space.
_GAP = re.compile(r" (?=\s|\Z)")
#: Up to the next space that other than white space follows.
_UNIT = re.compile(r"(?s: ?(?:(?! \S).)+| )")
_HEAD, _BLOCK = struct.Struct("<4sIQ"), struct.Struct("<IHBxH")


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """Lowest ``width`` bits of each value, one behind the other, low bits first."""
    if not width:
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, width: int, n: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    whole = np.zeros((n, 32), np.uint8)
    whole[:, :width] = bits
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel()


def encode_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One block of up to 65535 ids."""
    low = int(ids.min())
    rest = (ids - low).astype(np.uint32)
    at = np.partition(rest, k := min(len(rest) - 1, len(rest) * percentile // 100))[k]
    width = int(at).bit_length()
    over = np.flatnonzero(rest >> width) if width < 32 else np.empty(0, np.int64)
    high = (rest[over] >> width).astype("<u4")
    return _BLOCK.pack(low, len(ids), width, len(over)) + pack_bits(rest, width) + over.astype("<u2").tobytes() + high.tobytes()


def decode_block(data: bytes, at: int = 0) -> np.ndarray:
    low, n, width, k = _BLOCK.unpack_from(data, at)
    at += _BLOCK.size
    packed = -(-n * width // 8)
    out = unpack_bits(data[at : at + packed], width, n)
    at += packed
    if k:
        over = np.frombuffer(data, "<u2", k, at)
        out[over] |= np.frombuffer(data, "<u4", k, at + 2 * k) << np.uint32(width)
    return out + np.uint32(low)


def encode_shard(ids: np.ndarray, block: int = BLOCK) -> bytes:
    ids = np.asarray(ids, np.uint32)
    blocks = [encode_block(ids[i : i + block]) for i in range(0, len(ids), block)]
    first = _HEAD.size + 8 * len(blocks)
    offsets = np.array([first, *accumulate(map(len, blocks), initial=first)][1:-1] if blocks else [], "<u8")
    return _HEAD.pack(b"PFR1", len(blocks), len(ids)) + offsets.tobytes() + b"".join(blocks)


def read_shard(data: bytes, start: int = 0, stop: int | None = None, block: int = BLOCK) -> np.ndarray:
    """Ids start to stop of a shard; only the blocks that hold them are unpacked."""
    magic, blocks, n = _HEAD.unpack_from(data)
    if magic != b"PFR1":
        raise ValueError("not a shard of token ids")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.empty(0, np.uint32)
    offsets = np.frombuffer(data, "<u8", blocks, _HEAD.size)
    a, b = start // block, (stop - 1) // block
    got = np.concatenate([decode_block(data, int(offsets[i])) for i in range(a, b + 1)])
    return got[start - a * block : stop - a * block]


class UnitEncoder:
    """The tokenizers library's ids with a bounded table of text units.

    A byte-level pre-tokenizer always cuts before a space that other than white space follows, so the text between two
    such cuts has the same ids wherever it stands, and is handed to the library once. ``own_end``: the end token's string
    in a text is the special token, as in the library.
    """

    def __init__(self, path: str, keep: int = 1_500_000):
        self.tok = Tokenizer.from_file(path)
        self.keep, self.units = keep, {}
        spec = self.tok.to_str()[:4000]
        self.plain = '"type":"ByteLevel","add_prefix_space":false' in spec and '"normalizer":null' in spec
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = iter(range(256, 512))
        self.show = {b: chr(b if b in shown else next(hidden)) for b in range(256)}
        # Fixed value: the library's byte-level pre-tokenizing pattern.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def _put(self, unit: str, ids: bytes) -> bytes:
        if len(unit) <= 64:
            if len(self.units) >= self.keep:
                self.units.clear()
            self.units[unit] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece[1:].isalpha():  # shown as itself but for the space
            shown = piece if piece[0] != " " else self.show[32] + piece[1:]
        else:
            shown = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.show)
        return array("I", [t.id for t in self.tok.model.tokenize(shown)]).tobytes()

    def _miss(self, unit: str) -> bytes:
        word = unit[1:] if unit[:1] == " " else unit
        if word.isalpha():
            return self._put(unit, self._piece(unit))
        if word[-1:] in (".", ",") and word[:-1].isalpha():
            pieces = [unit[:-1], unit[-1]]
        else:
            pieces = self.pattern.findall(unit)
        get = self.units.get
        return self._put(unit, b"".join([get(p) or self._put(p, self._piece(p)) for p in pieces]))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if not self.plain or any(s in text for s in self.special):
            return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()
        get, miss = self.units.get, self._miss
        if "\0" not in text and not _GAP.search(text):
            units = text.replace(" ", "\0 ").split("\0")
            if not units[0]:
                del units[0]
        else:
            units = _UNIT.findall(text)
        return b"".join([get(u) or miss(u) for u in units])


def _encoder(path: str) -> UnitEncoder:
    """One a worker process, so its table serves all tasks of the process."""
    return kept(("units", path), lambda: UnitEncoder(path))


def write_token_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode whole texts and write shards, in ascending doc_id, as a table (part, shard, doc_ids, n_tokens, ids binary).

    One range exchange of the raw texts; each part is cut into shards of about SHARD_IDS ids. The table is written
    through Spark, so any shared store that Spark reaches will do, and a lost task is written again.
    """
    docs = id_text(docs, doc_id, text)
    n = parts_for(docs.sparkSession, text_bytes(docs), SHARD_TEXT_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, end = _encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        part, shard, size, held, counts = TaskContext.get().partitionId(), 0, 0, [], []

        def flush():
            nonlocal shard, size, held, counts
            ids = np.frombuffer(b"".join(x for _, x in held), "<u4")
            row = [[part], [shard], [[d for d, _ in held]], [counts], [encode_shard(ids)]]
            shard, size, held, counts = shard + 1, 0, [], []
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _SHARD_ARROW, strict=True)], names=_SHARD_NAMES)

        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = enc.encode(t.as_py() or "") + end
                held.append((d, x))
                counts.append(len(x) // 4)
                size += len(x) // 4
                if size >= SHARD_IDS:
                    yield flush()
        if held:
            yield flush()

    ordered = docs.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, "part int, shard int, doc_ids array<long>, n_tokens array<long>, ids binary").write.parquet(folder)


_SHARD_NAMES = ["part", "shard", "doc_ids", "n_tokens", "ids"]
_SHARD_ARROW = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]


def read_token_shards(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the written shards.

    Where a shard starts follows from the shards' id counts: one small row a shard (SHARD_IDS ids), summed by a window
    over the shards alone.
    """
    shards = spark.read.parquet(folder)
    from pyspark.sql import Window

    totals = shards.select("part", "shard", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    per_part = totals.groupBy("part").agg(F.sum("n").alias("part_n"))
    before_part = per_part.select("part", (F.sum("part_n").over(Window.orderBy("part")) - F.col("part_n")).alias("before_part"))
    within = Window.partitionBy("part").orderBy("shard")
    starts = totals.withColumn("before", F.sum("n").over(within) - F.col("n")).join(before_part, "part").select("part", "shard", (F.col("before") + F.col("before_part")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_ids, counts, data, first in zip(*(b.column(i) for i in range(4)), strict=True):
                ids, n, at = read_shard(data.as_py()), counts.as_py(), 0
                crc, starts = [], []
                for k in n:
                    crc.append(zlib.crc32(ids[at : at + k].astype("<u4").tobytes()))
                    starts.append(first.as_py() + at)
                    at += k
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids.as_py(), pa.int64()), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.join(starts, ["part", "shard"]).select("doc_ids", "n_tokens", "ids", "first").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_report(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the shards to the session's shared folder and report each document as read back from them."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-shards")
    write_token_shards(docs, tokenizer, folder, end_id)
    return read_token_shards(spark, folder)
