"""Blocks and fragments: exact corpus-wide counts of 64-bit keys without a row per key.

Documents are dealt to blocks of bounded text by a hash of their content. A block sends the sorted distinct keys of its
documents, pre-aggregated, to the fragments: P equal ranges of the global key order. A fragment combines what all blocks
sent and answers each block key by key; the block, which makes its keys again from the same texts, reads the answers in
order. A key that a third of all documents share is one entry a block, so no task gathers its rows. Only ranges that hold
a key of the block are sent, so there is at most one row a key, however many blocks and fragments there are. Blocks and
fragments are dealt to tasks by their number, one a task. The same exchange of texts serves both visits to the block. The keys a block makes depend on the set of its rows alone, so a recomputed
task after a loss sends and reads the same.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import _KEPT, _RELEASE, id_text, parts_for, release, text_bytes, trim, words

BLOCK_BYTES = 10 << 20


class _WordKeys(dict):
    """word -> 64-bit hash, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_WORD_KEYS = _WordKeys()
_RELEASE.append(_WORD_KEYS.clear)


def word_keys(text: str | None) -> np.ndarray:
    w = words(text)
    return np.fromiter(map(_WORD_KEYS.__getitem__, w), np.uint64, len(w))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and for each key its place among them."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    kinds = ranked[new]
    del ranked  # a block's arrays are most of a worker's memory
    rank = np.cumsum(new)
    rank -= 1
    place = np.empty(len(keys), np.int64)
    place[order] = rank
    return kinds, place


def fragment_edges(keys: np.ndarray, fragments: int) -> np.ndarray:
    """Where each of the equal ranges of the key order starts and ends in sorted keys."""
    step = (1 << 64) / fragments
    starts = np.array([int(i * step) for i in range(1, fragments)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, starts), [len(keys)]])


def blocked(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(block, doc_id, text) dealt by block, and the number of blocks."""
    docs = id_text(docs)
    n = parts_for(docs.sparkSession, text_bytes(docs), block_bytes)
    return docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("block"), "doc_id", "text").repartitionById(n, "block"), n


def held_cuts(keys: np.ndarray, fragments: int) -> list[tuple[int, int, int]]:
    """(fragment, start, end) of the ranges that sorted keys fall into."""
    edges = fragment_edges(keys, fragments)
    return [(int(i), int(edges[i]), int(edges[i + 1])) for i in np.flatnonzero(edges[1:] > edges[:-1])]


def planes(a: np.ndarray, dtype: str) -> bytes:
    """Numbers with their first bytes first, then their second ones and so on: what is alike compresses in the shuffle."""
    a = np.ascontiguousarray(a, dtype)
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def from_planes(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps between them, whose upper bytes are mostly 0."""
    return planes(np.diff(keys, prepend=np.uint64(0)), "<u8")


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, "<u8"), dtype=np.uint64)


def _trimmed(f: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """``f``, after which the memory of its arrays goes back to the system."""

    def one(table: pa.Table) -> pa.Table:
        out = f(table)
        trim()
        return out

    def two(table: pa.Table, told: pa.Table) -> pa.Table:
        out = f(table, told)
        trim()
        return out

    return two if f.__code__.co_argcount == 2 else one  # Spark reads the number of arguments off the function


def through_fragments(
    rows: DataFrame,
    n: int,
    keys_of: Callable[[pa.Table], tuple[np.ndarray, list[np.ndarray]]],
    combine: Callable[[np.ndarray, list[np.ndarray]], list[np.ndarray]],
    finish: Callable[[pa.Table, list[np.ndarray]], pa.Table],
    schema: str,
    sends: list[str],
    answers: list[str],
) -> DataFrame:
    """``keys_of`` a block: its sorted distinct keys and columns of the dtypes ``sends`` beside them. ``combine`` the keys
    and columns that reached a fragment: an answer for each entry in columns of the dtypes ``answers``. ``finish`` a block: its
    table and the answers for its keys."""

    def up(table: pa.Table) -> pa.Table:
        if _KEPT:
            release()
        keys, cols = keys_of(table)
        cuts = held_cuts(keys, n)
        cut = lambda a, t: pa.array([planes(a[x:y], t) for _, x, y in cuts], pa.binary())
        data = [pa.array([f for f, *_ in cuts], pa.int32()), pa.array([table["block"][0].as_py()] * len(cuts), pa.int32()), pa.array([packed_keys(keys[x:y]) for _, x, y in cuts], pa.binary())]
        return pa.table(data + [cut(c, t) for c, t in zip(cols, sends, strict=True)], names=["fragment", "block", "keys", *(f"c{i}" for i in range(len(sends)))])

    def across(table: pa.Table) -> pa.Table:
        parts = [unpacked_keys(x.as_py()) for x in table["keys"]]
        cols = [np.concatenate([from_planes(x.as_py(), t) for x in table[f"c{i}"]]) for i, t in enumerate(sends)]
        edges = np.cumsum([0, *map(len, parts)])
        keys = np.concatenate(parts)
        del parts
        out = combine(keys, cols)
        cut = lambda a, t: [planes(a[x:y], t) for x, y in zip(edges[:-1], edges[1:], strict=True)]
        data = [table["block"].combine_chunks(), table["fragment"].combine_chunks()]
        return pa.table(data + [pa.array(cut(a, t), pa.binary()) for a, t in zip(out, answers, strict=True)], names=["block", "fragment", *(f"a{i}" for i in range(len(answers)))])

    def down(table: pa.Table, told: pa.Table) -> pa.Table:
        order = np.argsort(told["fragment"].to_numpy())
        got = [np.concatenate([*(from_planes(told[f"a{i}"][int(k)].as_py(), t) for k in order), np.empty(0, t)]) for i, t in enumerate(answers)]
        return finish(table, got)

    binaries = lambda p, k: "".join(f", {p}{i} binary" for i in range(k))
    sent = rows.groupBy("block").applyInArrow(_trimmed(up), "fragment int, block int, keys binary" + binaries("c", len(sends)))
    told = sent.repartitionById(n, "fragment").groupBy("fragment").applyInArrow(_trimmed(across), "block int, fragment int" + binaries("a", len(answers)))
    return rows.groupBy("block").cogroup(told.repartitionById(n, "block").groupBy("block")).applyInArrow(_trimmed(down), schema)
