"""Scores texts with a smoothed n-gram model read as a weighted backoff automaton.

Model (word pairs, counts of the whole training part of the corpus, nothing pruned):
  unigram  p(w)   = (c(w) + A) / (N + A * (V + 1))
  bigram   p(w|v) = (c(v,w) + M * p(w)) / (c(v) + M)
States are the words seen as contexts, and a root. The state of v has an arc for each seen pair (v, w) that weighs
log10 p(w|v), and a failure arc to the root that weighs log10(M / (c(v) + M)); the root has an arc for each word that
weighs log10 p(w), unknown words included. A text is read once from left to right; each word moves the state and adds
the weights of the arcs taken. The probabilities of all words after any context sum to 1.

An automaton for the whole corpus grows with it, so no task holds it: a block of texts gets the arcs its own n-grams can
take, with exact corpus-wide counts, through the fragment exchange of ``_blocks``. Words and pairs are keyed by 63-bit hashes:
of 10^12 distinct pairs, about 54,000 share a key with another and get both counts. N and V are counted from the words.

Tokens: words of ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, then one end token. Null or empty text is the end
token alone. Repeated rows count as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._blocks import BLOCK_BYTES, blocked, distinct, mix, through_fragments, word_keys

ADD = 0.1
CONTEXT_MASS = 20.0
FOLDS = 10
#: No word has these keys: words contain no white space.
_END, _START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_ONE = np.uint64(1)


def held_out(doc_id: int | None, folds: int = FOLDS) -> bool:
    return zlib.crc32(str(doc_id).encode()) % folds == 0 if doc_id is not None else False


class BackoffAutomaton:
    """States and arcs that a block's texts can reach. Words are numbered; word i is also the state after it."""

    def __init__(self, word_count: np.ndarray, end: int, pair_count: np.ndarray, pair_words: np.ndarray, total: float, kinds: float, add: float, mass: float):
        p = (word_count + add) / (total + add * (kinds + 1))
        context = np.append(word_count, word_count[end]).astype(float)  # the start state, after the last word, stands before every text
        self.start = len(word_count)
        self.root = np.log10(p)
        self.fail = np.log10(mass / (context + mass))
        left, right = pair_words
        seen = pair_count > 0
        self.arc = np.full(len(pair_count), np.nan)
        self.arc[seen] = np.log10((pair_count[seen] + mass * p[right[seen]]) / (context[left[seen]] + mass))

    def traverse(self, states: np.ndarray, symbols: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Weight of each step of the left-to-right walk: the state's own arc, or its failure arc and then the root's."""
        own = self.arc[pairs]
        return np.where(np.isnan(own), self.fail[states] + self.root[symbols], own)


def _tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Word keys of all texts of a block, each with its end token, and the texts' token counts."""
    parts, sizes = [], []
    for t in table["text"]:
        w = word_keys(t.as_py())
        parts += [w, [_END]]
        sizes.append(len(w) + 1)
    return np.concatenate([np.asarray(p, np.uint64) for p in parts]), np.array(sizes)


def _grams(table: pa.Table):
    """Sorted keys of the block's words and pairs with the place of each token's word and pair among them."""
    tok, sizes = _tokens(table)
    first = np.cumsum(sizes) - sizes
    prev = np.empty_like(tok)
    prev[1:] = tok[:-1]
    prev[first] = _START
    words, word_at = distinct(tok & ~_ONE)
    pairs, pair_at = distinct(mix(prev * np.uint64(0x9FB21C651E98DF25) + tok) | _ONE)
    keys = np.concatenate([words, pairs])
    order = np.argsort(keys, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    return tok, sizes, first, keys[order], place[: len(words)], place[len(words) :], word_at, pair_at


def corpus_size(docs: DataFrame, folds: int = FOLDS) -> tuple[int, int]:
    """N and V: tokens and distinct tokens of the training texts, ends included; distinct words meet map-side combined."""
    learnt = docs.where(~F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % folds == 0, F.lit(False)))
    plain = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # an empty word stands for the end token: one a text
    words = F.concat(F.array_remove(F.split(plain, r"[\x20\x09-\x0D]+"), ""), F.array(F.lit("")))
    per = learnt.select(F.explode(words).alias("w")).groupBy("w").agg(F.count("*").alias("c"))
    total, kinds = per.agg(F.sum("c"), F.count("*")).first()
    return total or 0, kinds


def score_texts(docs: DataFrame, folds: int = FOLDS, add: float = ADD, mass: float = CONTEXT_MASS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, model_bits (bits per token) of all texts.

    The model learns from documents whose crc32 of the id's text is not 0 modulo ``folds`` (a null id is learnt from).
    """
    rows, n = blocked(docs, block_bytes)
    total, kinds = corpus_size(docs, folds)

    def keys_of(table: pa.Table):
        tok, sizes, _, keys, word_place, pair_place, word_at, pair_at = _grams(table)
        learn = np.repeat([not held_out(d.as_py(), folds) for d in table["doc_id"]], sizes)
        counts = np.zeros(len(keys), np.uint32)
        counts[word_place] = np.bincount(word_at[learn], minlength=len(word_place))
        counts[pair_place] = np.bincount(pair_at[learn], minlength=len(pair_place))
        return keys, [counts]

    def combine(keys: np.ndarray, cols: list[np.ndarray]):
        kinds, place = distinct(keys)
        return [np.bincount(place, weights=cols[0], minlength=len(kinds))[place]]

    def finish(table: pa.Table, told: list[np.ndarray]) -> pa.Table:
        tok, sizes, first, _, word_place, pair_place, word_at, pair_at = _grams(table)
        count = told[0].astype(float)
        word_count, pair_count = count[word_place], count[pair_place]
        states = np.empty(len(tok), np.int64)
        states[1:] = word_at[:-1]
        states[first] = len(word_count)
        left, right = np.empty(len(pair_count), np.int64), np.empty(len(pair_count), np.int64)
        left[pair_at], right[pair_at] = states, word_at
        automaton = BackoffAutomaton(word_count, word_at[-1], pair_count, np.array([left, right]), total, kinds, add, mass)
        score = np.add.reduceat(automaton.traverse(states, word_at, pair_at), first)
        base = np.add.reduceat(automaton.root[word_at], first)
        known = np.add.reduceat((word_count[word_at] > 0).astype(np.int64), first)
        out = [table["doc_id"].combine_chunks(), pa.array([held_out(d.as_py(), folds) for d in table["doc_id"]], pa.bool_()), sizes, known, np.full(len(sizes), int(total)), base, score, -score / sizes / np.log10(2)]
        return pa.table([x if isinstance(x, pa.Array) else pa.array(x) for x in out], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "model_bits"])

    return through_fragments(rows, n, keys_of, combine, finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, model_bits double", ["<u4"], ["<u8"])
