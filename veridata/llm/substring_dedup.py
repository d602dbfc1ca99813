"""Repeated passages: over 50 words that stand, byte for byte, in two or more documents.

A window is PASSAGE words in a row with what separates them; it is repeated if a document with another id holds the same
bytes. A word that a repeated window covers is repeated, so a passage is as long as its windows reach, each of which
stands whole in one other document. Passages begin and end at word ends.

1. Each window names the smallest hash among its PART-word pieces, which depends on the window alone. The named hashes
   of all blocks meet, fragment by fragment; a window whose named hash stands in one document only can't be repeated.
2. The windows that are left meet the same way by a hash of all their bytes. A key is one entry a block, however many
   documents share it. Keys are 64 bits.

A word is a run of bytes without ASCII whitespace. Characters of scripts written without spaces (Han, kana, Thai, Lao,
Khmer, Burmese) are words of their own. A word of over MIN_RUN bytes is taken in content-defined chunks: a gear hash rolls
over the bytes (each byte adds its table value and shifts the rest by two bits), and a chunk ends where it is smallest
within ``REACH`` bytes on both sides, or after ``LONGEST`` bytes, never inside a character; each chunk counts as a word.

A repeated word stays in the first document with its window (smallest doc_id) and goes from the others. A passage that
only repeats inside one document is no repeat across documents: it is not sought. All rows with one doc_id are that
document, so equal rows keep their texts; all rows with a null doc_id are one document too, as if its id were the largest.
Null or empty texts have no words. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._blocks import _KEPT, BLOCK_BYTES, _trimmed, blocked, distinct, from_planes, held_cuts, mix, packed_keys, planes, release, unpacked_keys

WINDOW, REACH, LONGEST, MIN_RUN = 16, 14, 256, 128
#: A passage has this many words at least; any such passage holds the same smallest PART-word piece in all its copies.
PASSAGE, PART = 51, 20
#: Bytes of texts whose windows are made at once.
_AT_ONCE = 1 << 20
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_LAST = np.iinfo(np.int64).max
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def gear_hash(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Hash of the ``window`` bytes (a power of two) that end at each byte; fewer at the start."""
    h, w = _GEAR[data], 1
    while w < window:
        # twice the window: what ended w bytes earlier has been shifted 2 w bits by then
        h[w:] += h[:-w] << np.uint32(2 * w) if 2 * w < 32 else np.uint32(0)
        w *= 2
    return h


def _smallest(h: np.ndarray, reach: int) -> np.ndarray:
    """Minimum of h over the ``reach`` values from each place on."""
    out, w = h.copy(), 1
    while w < reach:
        step = min(w, reach - w)
        out[:-step] = np.minimum(out[:-step], out[step:])
        w += step
    return out


def chunk_ends(data: bytes, reach: int = REACH, longest: int = LONGEST) -> list[int]:
    """Ends of the chunks of a text's bytes."""
    n = len(data)
    if n <= 2 * reach + 1:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    h = gear_hash(raw).astype(np.uint64)
    h[:-1][(raw[1:] & 0xC0) == 0x80] = 1 << 40  # the next byte goes on with a character
    ahead = _smallest(h, reach)
    at = np.arange(reach, n - reach)
    cut = at[(h[at] < ahead[at - reach]) & (h[at] <= ahead[at + 1]) & (h[at] < 1 << 40)] + 1
    ends = [*cut.tolist(), n]
    if max(np.diff([0, *ends])) <= longest:
        return ends
    out, last = [], 0
    for e in ends:
        while e - last > longest:
            last += longest
            while raw[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        out.append(e)
        last = e
    return out


def _runs(flag: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def word_edges(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 bytes."""
    out = ~_SPACE[raw]
    first = out.copy()
    first[1:] &= ~out[:-1]
    then = np.concatenate([raw[1:], [0]])
    alone = ((raw >= 0xE3) & (raw <= 0xE9)) | ((raw == 0xE0) & (then >= 0xB8) & (then <= 0xBB))
    alone |= ((raw == 0xE1) & (((then >= 0x80) & (then <= 0x82)) | (then == 0x9E) | (then == 0x9F))) | ((raw == 0xF0) & (then >= 0xA0) & (then <= 0xB3))
    if alone.any():
        first |= alone
        after = np.flatnonzero(alone) + np.where(raw[alone] >= 0xF0, 4, 3)
        after = after[after < len(raw)]
        first[after] |= out[after]
    starts = np.flatnonzero(first)
    last = out & np.concatenate([first[1:] | ~out[1:], [True]])
    ends = np.flatnonzero(last) + 1
    long_ = np.flatnonzero(ends - starts > MIN_RUN)
    if len(long_):
        cuts = [int(starts[k]) + e for k in long_ for e in chunk_ends(raw[starts[k] : ends[k]].tobytes())[:-1]]
        starts, ends = np.sort(np.append(starts, cuts)).astype(np.int64), np.sort(np.append(ends, cuts)).astype(np.int64)
    return starts, ends


def _hashed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """A function of n: hash of the bytes from each word's start to the end of the n-th word on, of all such places."""
    power = np.full(len(raw) + 1, _BASE)
    power[0] = 1
    np.cumprod(power, out=power)
    so_far = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power[:-1], out=so_far[1:])
    power[1:] = _UNBASE
    np.cumprod(power, out=power)

    def of(n: int) -> np.ndarray:
        a, z = starts[: len(starts) - n + 1], ends[n - 1 :]
        return mix((so_far[z] - so_far[a]) * power[a] + (z - a).astype(np.uint64) * _BASE)

    return of


def windows(texts: list[bytes]):
    """(text, first word, words) of each bundle of texts, all its words' starts and ends, and each window's place among
    the words, text, named hash and own hash."""
    at = 0
    while at < len(texts):
        upto, size = at + 1, len(texts[at])
        while upto < len(texts) and size + len(texts[upto]) <= _AT_ONCE:
            size += len(texts[upto])
            upto += 1
        raw = np.frombuffer(b" ".join(texts[at:upto]), np.uint8)
        # a space parts the texts, so no word spans two
        begin = np.cumsum([0, *(len(t) + 1 for t in texts[at:upto])])
        starts, ends = word_edges(raw)
        own = np.searchsorted(begin, starts, side="right") - 1
        k = max(0, len(starts) - PASSAGE + 1)
        place = np.flatnonzero(own[:k] == own[PASSAGE - 1 :]) if k else np.empty(0, np.int64)
        if len(place):
            of = _hashed(raw, starts, ends)
            # the smallest of many hashes are small ones: mixed again they fill the key range evenly
            named = mix(_smallest(of(PART), PASSAGE - PART + 1)[place])
            yield at, begin, starts, ends, own, place, named, of(PASSAGE)[place]
        else:
            yield at, begin, starts, ends, own, place, np.empty(0, np.uint64), np.empty(0, np.uint64)
        at = upto


def _block(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    ids = np.array([_LAST if d is None else d for d in table["doc_id"].to_pylist()], np.int64)
    return ids, [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in table["text"]]


def _by_key(keys: list[np.ndarray], docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the smallest document of each, and whether another one has it."""
    key, doc = np.concatenate([*keys, np.empty(0, np.uint64)]), np.concatenate([*docs, np.empty(0, np.int64)])
    kinds, place = distinct(key)
    least, most = np.full(len(kinds), _LAST), np.full(len(kinds), np.iinfo(np.int64).min)
    np.minimum.at(least, place, doc)
    np.maximum.at(most, place, doc)
    return kinds, least, (least != most).astype(np.uint8)


def _sent(table: pa.Table, n: int, keys: np.ndarray, least: np.ndarray, many: np.ndarray) -> pa.Table:
    cuts = held_cuts(keys, n)
    cut = lambda a, t: pa.array([planes(a[x:y], t) for _, x, y in cuts], pa.binary())
    return pa.table([pa.array([f for f, *_ in cuts], pa.int32()), pa.array([table["block"][0].as_py()] * len(cuts), pa.int32()), pa.array([packed_keys(keys[x:y]) for _, x, y in cuts], pa.binary()), cut(least, "<i8"), cut(many, "u1")], names=["fragment", "block", "keys", "least", "many"])


def _among(keys: np.ndarray, told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is among the sorted told ones, and where."""
    at = np.searchsorted(told, keys)
    at[at == len(told)] = 0
    return (told[at] == keys) if len(told) else np.zeros(len(keys), bool), at


def _told(told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a block that are repeated, sorted, and the first document of each."""
    order = np.argsort(told["fragment"].to_numpy())
    keys = [unpacked_keys(told["keys"][int(k)].as_py()) for k in order]
    first = [from_planes(told["first"][int(k)].as_py(), "<i8") for k in order]
    return np.concatenate([*keys, np.empty(0, np.uint64)]), np.concatenate([*first, np.empty(0, np.int64)])


def _across(table: pa.Table) -> pa.Table:
    """Of the keys that blocks sent to a fragment, the repeated ones back to each block that has them."""
    read = lambda name, t: np.concatenate([from_planes(x.as_py(), t) for x in table[name]])
    parts = [unpacked_keys(x.as_py()) for x in table["keys"]]
    edges = np.cumsum([0, *map(len, parts)])
    keys, doc, many = np.concatenate(parts), read("least", "<i8"), read("many", "u1")
    kinds, place = distinct(keys)
    first, most, any_ = np.full(len(kinds), _LAST), np.full(len(kinds), np.iinfo(np.int64).min), np.zeros(len(kinds), np.uint8)
    np.minimum.at(first, place, doc)
    np.maximum.at(most, place, doc)
    np.maximum.at(any_, place, many)
    again = ((first != most) | (any_ > 0))[place]
    first = first[place]
    held = [slice(x, y) for x, y in zip(edges[:-1], edges[1:], strict=True)]
    told = [pa.array([packed_keys(keys[h][again[h]]) for h in held], pa.binary()), pa.array([planes(first[h][again[h]], "<i8") for h in held], pa.binary())]
    return pa.table([table["block"].combine_chunks(), table["fragment"].combine_chunks(), *told], names=["block", "fragment", "keys", "first"])


def repeated_passages(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_repeated, repeated_bytes, longest_run, has_passage, removed_bytes, text (without later copies)."""
    rows, n = blocked(docs, block_bytes)

    def name(table: pa.Table) -> pa.Table:
        if _KEPT:
            release()
        ids, texts = _block(table)
        keys, doc = [], []
        for at, _, _, _, own, place, named, _ in windows(texts):
            # neighbours mostly name the same piece
            new = np.ones(len(named), bool)
            new[1:] = (named[1:] != named[:-1]) | (own[place[1:]] != own[place[:-1]])
            keys.append(named[new])
            doc.append(ids[at + own[place[new]]])
        return _sent(table, n, *_by_key(keys, doc))

    def match(table: pa.Table, told: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table({"fragment": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), "keys": pa.array([], pa.binary()), "least": pa.array([], pa.binary()), "many": pa.array([], pa.binary())})
        maybe, _ = _told(told)
        ids, texts = _block(table)
        keys, doc = [], []
        for at, _, _, _, own, place, named, whole in windows(texts):
            left = _among(named, maybe)[0]
            keys.append(whole[left])
            doc.append(ids[at + own[place[left]]])
        return _sent(table, n, *_by_key(keys, doc))

    def finish(table: pa.Table, told: pa.Table) -> pa.Table:
        again, first = _told(told)
        ids, texts = _block(table)
        out = []
        for at, begin, starts, ends, own, place, _, whole in windows(texts):
            hit, where = _among(whole, again)
            kept_by = first[where] if len(again) else np.empty(0, np.int64)

            def covered(flag: np.ndarray, starts=starts, place=place) -> np.ndarray:
                edge = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edge, place[flag], 1)
                np.add.at(edge, place[flag] + PASSAGE, -1)
                return np.cumsum(edge[:-1]) > 0

            repeated = covered(hit)
            later = hit.copy()
            later[hit] = kept_by[hit] < ids[at + own[place[hit]]] if hit.any() else False
            drop = covered(later)
            bounds = np.searchsorted(own, np.arange(len(begin)))
            for i in range(len(begin) - 1):
                here = slice(bounds[i], bounds[i + 1])
                text, a, z = texts[at + i], starts[here] - begin[i], ends[here] - begin[i]
                runs = [(int(a[x]), int(z[y - 1])) for x, y in _runs(repeated[here])]
                pieces, last = [], 0
                for x, y in _runs(drop[here]):
                    pieces.append(text[last : a[x]])
                    last = int(z[y - 1])
                stays = b"".join([*pieces, text[last:]])
                d = int(ids[at + i])
                out.append((None if d == _LAST else d, len(a), int(repeated[here].sum()), sum(y - x for x, y in runs), max((y - x for x, y in runs), default=0), bool(runs), len(text) - len(stays), stays.decode("utf-8", "surrogatepass")))
        types = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.string()]
        names = ["doc_id", "n_words", "n_repeated", "repeated_bytes", "longest_run", "has_passage", "removed_bytes", "text"]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * len(types), types, strict=True)], names=names)

    sends, answers = "fragment int, block int, keys binary, least binary, many binary", "block int, fragment int, keys binary, first binary"

    def met(sent: DataFrame) -> DataFrame:
        told = sent.repartitionById(n, "fragment").groupBy("fragment").applyInArrow(_trimmed(_across), answers)
        return told.repartitionById(n, "block")

    maybe = met(rows.groupBy("block").applyInArrow(_trimmed(name), sends))
    again = met(rows.groupBy("block").cogroup(maybe.groupBy("block")).applyInArrow(_trimmed(match), sends))
    return rows.groupBy("block").cogroup(again.groupBy("block")).applyInArrow(_trimmed(finish), "doc_id long, n_words long, n_repeated long, repeated_bytes long, longest_run long, has_passage boolean, removed_bytes long, text string")


def substring_report(docs: DataFrame) -> DataFrame:
    """The counts of each document, and a digest of the text that stays."""
    from pyspark.sql import functions as F

    return repeated_passages(docs).withColumn("kept_sha256", F.sha2("text", 256)).drop("text")
