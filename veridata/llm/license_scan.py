"""Licence notices in texts: a trained paragraph classifier, a calibrated unknown class, template confirmation.

Training (driver, NumPy) is on the labelled corpus of ``notices.json``: a few dozen ways to state a licence, each with the
names of each family, sentences of the licences' own texts, the same ways with other licences' names, and with words that
name no licence. Logistic regression on the word 1- to 3-grams of a paragraph, made sparse by an L1 penalty, has a head for
each family and one for "this is a licence notice", so a notice may be of several families. The heads are calibrated by a
temperature fitted on a third of the ways that the fitted models have not seen, a third at a time. A notice in which no
family reaches MIN_PROBABILITY is ``unknown``; a paragraph that is no notice gives no row. A family is confirmed if the
paragraph holds enough of the words, in pairs, of one of its names or sentences.

A paragraph ends at an empty line, or at the end of a line that ends a sentence: a notice wrapped over lines is one
paragraph. Scoring uses DataFrame functions only, in a narrow scan of whole texts without a shuffle. Paragraphs without any
of some words read off the weights (``needed_words``) are not scored: all other features together can't make a head pass, so
the result is the same with and without that step.

Null and empty texts give no rows; repeated rows give their rows each, also with a null doc_id; an empty table gives none;
other columns are ignored; long texts are scored whole.
"""

from __future__ import annotations

import functools
import json
import re
from importlib import resources

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"
MIN_PROBABILITY, MIN_SIMILARITY = 0.5, 0.5
GRAMS = 3
#: Weights below this are left out: they tell little, but common words hold many of their features.
LEAST_WEIGHT = 0.3
#: Sentences of licences also stand inside other text; there are fewer of them than ways to state a name.
AROUND = ("{}", "{} This is all.", "Here it is: {}", "The following holds here. {} See above for more.")
MORE_AROUND = ("Note that {}", "{} Thank you.", "Legal: {}", "He wrote: {} And he left.", "{} So it goes on.", "Read this. {}")
_WORD = r"[^a-z0-9]+"
_END = r"(?<=[.!?:;])[ \t\r]*\n|\n[ \t\r]*\n"


def words(text: str) -> list[str]:
    return [w for w in re.split(_WORD, text.lower()) if w]


def grams(ws: list[str], n: int = GRAMS) -> set[str]:
    return {" ".join(ws[i : i + k]) for k in range(1, n + 1) for i in range(len(ws) - k + 1)}


@functools.lru_cache(1)
def corpus() -> dict:
    return json.loads(resources.files(__package__).joinpath("notices.json").read_text(encoding="utf-8"))


def labelled(frames: list[str]) -> list[tuple[str, frozenset[str], int]]:
    """(text, families, number of its frame): notices, with UNKNOWN for those of no family, and texts without a label."""
    c = corpus()
    rows, plain = [], {w for t in c["ordinary"] for w in words(t)}
    # every third way for each name, in turn; a name that is an ordinary word too is no notice by itself
    stated = lambda names, third: [(f.format(n), i) for i, f in enumerate(frames) for j, n in enumerate(names) if (i + j) % third == 0 and not (f.strip(".") == "{}" and set(words(n)) <= plain)]
    for family, of in sorted(c["families"].items()):
        rows += [(t, frozenset((family,)), i) for t, i in stated(of["names"], 2)]
        rows += [(f.format(t), frozenset((family,)), j) for j, t in enumerate(of["sentences"]) for f in AROUND]
    other = frozenset((UNKNOWN,))
    rows += [(t, other, i) for t, i in stated(c["others"]["names"], 2)]
    rows += [(f.format(t), other, j) for j, t in enumerate(c["others"]["sentences"]) for f in AROUND]
    rows += [(t, frozenset(), i) for t, i in stated(c["fillers"], 2) if "icen" not in t and "izen" not in t]
    rows += [(t, frozenset(), j) for j, t in enumerate(c["ordinary"])]
    # ordinary texts are longer than notices: their words together must not add up to one
    rows += [(" ".join(c["ordinary"][j :: 7]), frozenset(), j) for j in range(7)]
    return rows


def fit(x: np.ndarray, y: np.ndarray, l1: float = 5e-4, steps: int = 200, rate: float = 4.0, ordinary: float = 5.0) -> tuple[np.ndarray, np.ndarray]:
    """Proximal gradient descent of one logistic regression a column of y. Rows of both labels weigh the same in all; among
    those without the label, texts that are no notice weigh ``ordinary`` times as much as other families' notices."""
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.full(y.shape[1], -2.0, np.float32)
    y = y.astype(np.float32)
    less = np.where(y[:, -1:] > 0, 1.0, ordinary) * (1 - y)
    each = (np.where(y > 0, 0.5 / np.maximum(y.sum(axis=0), 1), 0.5 * less / np.maximum(less.sum(axis=0), 1))).astype(np.float32)
    for _ in range(steps):
        g = (1 / (1 + np.exp(-(x @ w + b))) - y) * each
        w -= rate * (x.T @ g)
        w = np.sign(w) * np.maximum(np.float32(0), np.abs(w) - np.float32(rate * l1))
        b = np.minimum(b - np.float32(rate) * g.sum(axis=0), np.float32(-1.0))  # without any feature no head passes
    return np.where(np.abs(w) < LEAST_WEIGHT, np.float32(0), w), b


def _matrix(rows: list, names: list[str], classes: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    at = {n: i for i, n in enumerate(names)}
    x = np.zeros((len(rows), len(names)), np.float32)
    for i, (t, *_) in enumerate(rows):
        x[i, [at[g] for g in grams(words(t)) if g in at]] = 1
    y = np.array([[float(bool(k)) if c == UNKNOWN else float(c in k) for c in classes] for _, k, _ in rows])
    return x, y


def features(rows: list) -> list[str]:
    """N-grams that two notices or more hold and no ordinary text: one that both hold tells nothing, nor one of a single text."""
    count: dict[str, int] = {}
    for t, k, _ in rows:
        for g in grams(words(t)):
            count[g] = count.get(g, 0) + 1 if k else -(10**9)
    return sorted(g for g, c in count.items() if c > 1)


@functools.lru_cache(1)
def trained() -> tuple[tuple[str, ...], dict[str, tuple[float, ...]], tuple[float, ...], float]:
    """Heads (the last one for any notice), weights by feature, intercepts and temperature. Deterministic."""
    c = corpus()
    classes = (*sorted(c["families"]), UNKNOWN)
    rows = labelled(c["frames"])
    sentences = [(t, frozenset((k,))) for k, of in sorted(c["families"].items()) for t in of["sentences"]] + [(t, frozenset((UNKNOWN,))) for t in c["others"]["sentences"]]
    rows += [(f.format(t), k, j) for j, (t, k) in enumerate(sentences) for f in MORE_AROUND]
    names = features(rows)
    x, y = _matrix(rows, names, classes)
    w, b = fit(x, y)
    grid, loss = np.linspace(0.5, 3, 26), np.zeros(26)
    for k in range(3):
        out = np.array([n % 3 == k for *_, n in rows])
        wk, bk = fit(x[~out], y[~out], steps=80)
        z = (x[out] @ wk + bk)[:, :, None] / grid
        loss += np.logaddexp(0, np.where(y[out][:, :, None] > 0, -z, z)).sum(axis=(0, 1))
    used = np.abs(w).max(axis=1) > 1e-6
    weights = {n: tuple(np.round(v, 5).tolist()) for n, v, u in zip(names, w, used, strict=True) if u}
    return classes, weights, tuple(np.round(b, 5).tolist()), float(round(grid[loss.argmin()], 5))


def common_words() -> dict[str, int]:
    """How often the corpus's ordinary texts hold each word."""
    out: dict[str, int] = {}
    for t, k, _ in labelled(corpus()["frames"]):
        for w in () if k else words(t):
            out[w] = out.get(w, 0) + 1
    return out


@functools.lru_cache(4)
def needed_words(min_probability: float = MIN_PROBABILITY) -> tuple[str, ...]:
    """Words without any of which no head can pass: all positive weights of the features that hold none of them, taken
    together, leave each head under the probability. Picked one by one, by the weight they account for in the heads that
    could still pass, over how common they are in ordinary texts."""
    _, weights, bias, heat = trained()
    seen = common_words()
    room = heat * np.log(min_probability / (1 - min_probability)) - np.array(bias) - 1e-6
    left = {g: np.maximum(0, v) for g, v in weights.items() if max(v) > 0}
    of: dict[str, set[str]] = {}
    for g in left:
        for w in g.split():
            of.setdefault(w, set()).add(g)
    picked = []
    while left and ((open_ := sum(left.values()) - room) > 0).any():
        over = open_ > 0
        gain = {w: sum(left[g][over].sum() for g in gs) / (1 + 3 * seen.get(w, 0)) for w, gs in of.items()}
        best = max(gain, key=lambda w: (gain[w], w))
        picked.append(best)
        for g in of.pop(best):
            del left[g]
            for w in g.split():
                if w in of:
                    of[w].discard(g)
    return tuple(sorted(picked))


def predict(text: str, min_probability: float = MIN_PROBABILITY) -> set[str]:
    """The families of one paragraph, by the definition; UNKNOWN for a notice of none, empty if it is no notice."""
    classes, weights, bias, heat = trained()
    z = np.array(bias) + sum((np.array(weights[g]) for g in grams(words(text)) if g in weights), np.zeros(len(bias)))
    p = 1 / (1 + np.exp(-z / heat))
    said = {c for c, v in zip(classes[:-1], p, strict=False) if v >= min_probability}
    return said or ({UNKNOWN} if p[-1] >= min_probability else set())


def _runs(w: Column, k: int) -> Column:
    spots = F.when(F.size(w) >= k, F.sequence(F.lit(1), F.size(w) - (k - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(spots, lambda i: F.concat_ws(" ", *[F.element_at(w, i + F.lit(j)) for j in range(k)]))


def scan_licenses(docs: DataFrame, min_probability: float = MIN_PROBABILITY, min_similarity: float = MIN_SIMILARITY, skip: bool = True) -> DataFrame:
    """doc_id, paragraph (from 0), family, probability, similarity, confirmed: a row for each family of each notice. With
    ``skip``, paragraphs that can't be one are left before they are scored."""
    classes, weights, bias, heat = trained()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text") != "")
    need = r"(?i)(?<![a-z0-9])(?:" + "|".join(needed_words(min_probability)) + r")(?![a-z0-9])"
    rows = rows.select("doc_id", F.posexplode(F.split("text", _END)).alias("paragraph", "par"))
    rows = rows.where(F.col("par").rlike(need)) if skip else rows
    numbers = lambda v: F.array(*[F.lit(float(x)) for x in v])
    names = F.array(*[F.lit(n) for n in weights])
    table = F.map_from_arrays(names, F.array(*[numbers(v) for v in weights.values()]))
    share = lambda ps, c: F.size(F.array_intersect(c, F.array(*[F.lit(p) for p in ps]))) / F.lit(len(ps))

    def probabilities(found: Column) -> Column:
        """Of each head, from the distinct grams of a paragraph."""
        logits = F.aggregate(F.array_intersect(found, names), numbers(bias), lambda acc, g: F.zip_with(acc, F.element_at(table, g), lambda a, b: a + b))
        return F.transform(logits, lambda z: 1 / (1 + F.exp(-z / F.lit(heat))))

    def similarity(family: str, w: Column, pairs: Column) -> Column:
        """The largest share of a name's or sentence's word pairs (the word, if it has one) that the paragraph holds."""
        of, best = corpus()["families"][family], [F.lit(0.0)]
        for t in map(words, of["names"] + of["sentences"]):
            best.append(share(sorted({" ".join(x) for x in zip(t, t[1:], strict=False)}), pairs) if len(t) > 1 else share(t, w))
        return F.greatest(*best)

    def told(w: Column, pairs: Column, p: Column) -> Column:
        """The families that pass, UNKNOWN if only the head for any notice does, none otherwise."""
        said = lambda c, i, like: F.struct(F.lit(c).alias("family"), F.round(F.get(p, F.lit(i)), 6).alias("probability"), like.alias("similarity"))
        over = lambda i: F.get(p, F.lit(i)) >= min_probability
        families = F.array_compact(F.array(*[F.when(over(i), said(c, i, F.round(similarity(c, w, pairs), 6))) for i, c in enumerate(classes[:-1])]))
        last = len(classes) - 1
        none = F.array_compact(F.array(F.when(over(last), said(UNKNOWN, last, F.lit(0.0)))))
        return F.when(F.exists(F.slice(p, 1, last), lambda v: v >= min_probability), families).otherwise(none)

    # each step is bound to a lambda variable, so that it is made once a paragraph
    once = lambda x, f: F.element_at(F.transform(F.array(x), f), 1)
    split = F.filter(F.split(F.lower("par"), _WORD), lambda x: x != "")
    notices = once(split, lambda w: once(_runs(w, 2), lambda pairs: once(probabilities(F.array_distinct(F.concat(w, pairs, _runs(w, 3)))), lambda p: told(w, pairs, p))))
    out = rows.select("doc_id", "paragraph", F.explode(notices).alias("e")).select("doc_id", "paragraph", "e.*")
    return out.withColumn("confirmed", (F.col("family") != UNKNOWN) & (F.col("similarity") >= min_similarity))
