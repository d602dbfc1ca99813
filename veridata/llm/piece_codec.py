"""Merge-type subword encoding through a table of prefixes, and decoding.

For every prefix of a run of known characters exactly one token can be the last of its encoding. The table stores that
token: of the vocabulary entries that end at the position (one pass of an automaton), it is the one whose own start has a
last token that it may stand beside. Ids are then read backwards from the end. Whether two tokens may stand side by side
is decided once per pair from the parts that their edges go through while they are merged, and kept.

Words start at the space mark, and no entry crosses it (checked when the model is read), so each word with its mark is
encoded once and its ids are kept in a bounded table; a model with crossing entries is encoded as one run instead.

Null or empty text has no ids and decodes to the empty text.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import ahocorasick
import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from ._common import kept, per_document

MARK = "▁"


class PieceCodec:
    """Encoder and decoder of one model file. ``keep`` bounds the word table and the pair table."""

    def __init__(self, path: str, keep: int = 500_000):
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.keep, self.ids_of, self.rank = keep, {}, {}
        self.byte_ids = {}
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids_of[piece], self.rank[piece] = i, -sp.get_score(i)
        self.text_of = {i: p for p, i in self.ids_of.items()}
        self.known = frozenset(c for p in self.ids_of for c in p)
        inner = frozenset(p[k : k + 2] for p in self.ids_of for k in range(len(p) - 1))
        self.inner = inner
        self.decimal = [str(i) for i in range(sp.vocab_size())]
        self.by_word = not any(MARK in p.lstrip(MARK) for p in self.ids_of)
        cut = "" if "\n" in self.known else "\n"
        self.unit = re.compile(f"{MARK}*[^{MARK}{cut}]+|{MARK}+" + (f"|{cut}" if cut else ""))
        self.find = ahocorasick.Automaton()
        for piece, i in self.ids_of.items():
            self.find.add_word(piece, (i, len(piece)))
        self.find.make_automaton()
        self._spines: dict[tuple[int, int], list[tuple[str, float, float]] | None] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._units: dict[str, bytes] = {}

    def _merged(self, text: str, stop: int = 1) -> list[str]:
        """Merge neighbours, best rank first, leftmost of equals, until none joins to an entry or ``stop`` are left."""
        parts = list(text)
        while len(parts) > stop:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.rank.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s < best):
                    best, at = s, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, token: int, side: int) -> list[tuple[str, float, float]] | None:
        """The parts of a token that touch its left (0) or right (-1) edge while it is merged: text, the rank at which
        the part stands and the rank at which it is used up. None for an entry whose own text merges to something else."""
        key = (token, side)
        if key not in self._spines:
            part, until, out = self.text_of[token], float("inf"), []
            while out is not None:
                made = self.rank[part] if len(part) > 1 else float("-inf")
                out.append((part, made, until))
                if len(part) == 1:
                    break
                halves = self._merged(part, 2)
                if len(halves) != 2 or self._merged(part) != [part]:
                    out = None
                else:
                    part, until = halves[side], made
            self._spines[key] = out
        return self._spines[key]

    def _fits(self, left: int, right: int) -> bool:
        """Whether two tokens may be neighbours: while each is merged, no part at the left one's end and part at the right
        one's start stand at the same time and join to an entry of a rank that comes before either is used up."""
        got = self._pairs.get((left, right))
        if got is None:
            if len(self._pairs) >= self.keep // 2:
                self._pairs.clear()
            got = self._pairs[left, right] = self._compatible(left, right)
        return got

    def _compatible(self, left: int, right: int) -> bool:
        ys = self._spine(right, 0)
        if left < 0 or ys is None:
            return ys is not None
        rank = self.rank.get
        for x, made_x, used_x in self._spine(left, -1) or ():
            for y, made_y, used_y in ys:
                r = rank(x + y)
                if r is not None and (t := max(r, made_x, made_y)) < used_x and t <= used_y:
                    return False
        return True

    def _run(self, text: str) -> list[int]:
        """Ids of characters that are all in the vocabulary."""
        last: list[tuple[int, int]] = [(-1, 0)] * (len(text) + 1)
        for end, (i, n) in self.find.iter(text):
            start = end + 1 - n
            if (last[start][1] or not start) and not last[end + 1][1] and self._fits(last[start][0] if start else -1, i):
                last[end + 1] = (i, n)
        out, at = [], len(text)
        while at:
            i, n = last[at]
            if not n:
                raise ValueError(f"no encoding ends at {at} of {text!r}")
            out.append(i)
            at -= n
        return out[::-1]

    def _word(self, text: str) -> list[int]:
        if self.known.issuperset(text):
            return self._run(text)
        out: list[int] = []
        start = 0
        for k, c in enumerate(text):
            if c not in self.known:
                out += self._run(text[start:k]) if k > start else []
                out += [self.byte_ids[b] for b in c.encode()] if self.byte_ids else [self.sp.unk_id()]
                start = k + 1
        return out + (self._run(text[start:]) if start < len(text) else [])

    def _kept(self, unit: str) -> bytes:
        """Ids of a unit as 32-bit integers."""
        got = self._units.get(unit)
        if got is None:
            # no entry holds this neighbour pair, so the last sign is a run of its own
            if 2 < len(unit) <= 64 and unit[-2:] not in self.inner:
                got = self._kept(unit[:-1]) + self._kept(unit[-1])
            else:
                got = array("I", self._word(unit)).tobytes()
            if len(self._units) >= self.keep:
                self._units.clear()
            if len(unit) <= 64:
                self._units[unit] = got
        return got

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        units = self.unit.findall(marked) if self.by_word else [marked]
        table, miss = self._units, self._kept
        return array("I", b"".join([table.get(u) or miss(u) for u in units])).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids) if ids else ""


def codec(path: str) -> PieceCodec:
    """One codec a worker process and model, so its tables serve all tasks of the process."""
    return kept(("pieces", path), lambda: PieceCodec(path))


def encode_pieces(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded string for every whole text; a narrow scan."""

    def row():
        c = codec(model)

        def one(t: str) -> tuple:
            ids = c.encode(t)
            return ids, c.decode(ids)

        return one

    return per_document(docs, row, "ids array<int>, decoded string", doc_id, text)


def piece_report(docs: DataFrame, model: str) -> DataFrame:
    """Number of ids, digest of the ids and digest of the decoded text for each document."""

    def row():
        c, sha = codec(model), hashlib.sha256

        def one(t: str) -> tuple:
            ids = c.encode(t)
            return len(ids), sha(",".join([c.decimal[i] for i in ids]).encode()).hexdigest(), sha(c.decode(ids).encode()).hexdigest()

        return one

    return per_document(docs, row, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_report(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, the ids of each whole text, and the columns of ``piece_report`` beside them; a narrow scan."""

    def row():
        c, sha = codec(model), hashlib.sha256

        def one(t: str) -> tuple:
            ids = c.encode(t)
            # four bytes an id until the batch is written
            return np.array(ids, np.int32), len(ids), sha(",".join([c.decimal[i] for i in ids]).encode()).hexdigest(), sha(c.decode(ids).encode()).hexdigest()

        return one

    return per_document(docs, row, "ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string")
