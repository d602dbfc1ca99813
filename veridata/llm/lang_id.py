"""Language of a text by cross-parsing entropy.

For each label a suffix automaton holds the words that most of its texts hold. A text is parsed word by word against each
automaton: the longest match from where the last one ended is a phrase, a sign that no match starts with is a phrase of its
own. Phrases, times the log of the automaton's own length, over the text's signs estimate the
cross entropy between the text and the label; the label that needs fewest so normalised phrases wins.

Phrases end at word ends, so a word's phrase counts depend on the word alone and are kept in a bounded table. Words are
runs of letters in lower case, with a mark at both ends.

Learning: every labelled text of the learning folds is read, and it is counted in how many texts of each label a word
stands. A label's automaton holds TRAIN_WORDS words, or all that there are: those in most texts, and of words in equally
many, where not all have room, those with low hashes.

``keep_identified`` rejects text of no learnt language by the winner's bits per sign. Its limits come from all the labelled
texts of the learning folds, each fold measured by automata of the other ones: a winner's limit is what its texts need, but
for one in a thousand (labels can be wrong), and SLACK more. Needs are counted in bins of 1 / NEED_BINS bits. A text of w
distinct words is measured by their bits / (1 + 1 / sqrt(w)): few words prove little, and a word repeated proves no more.

Null text, or text without letters: ``und``, score 0. No labels at all: ``und``. Ties go to the smaller label. Labels
that are null are not learnt. Repeated rows are predicted one by one. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import ensure_checkpoint_dir, kept, per_document, slices

TRAIN_WORDS = 12_000
FOLDS, HELD = 4, 2
#: With how many texts a winner has its own limit, and bins a bit.
LIMIT_LEAST, NEED_BINS = 100, 1024
SLACK = 0.1
NONE = "und"
_WORD, _LETTERS = re.compile(r"[^\W\d_]+"), regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    """Runs of letters of a text, as it stands; numerals such as fractions and Roman ones are no letters."""
    found = _WORD.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return [x for w in found for x in ([w] if w.isalpha() else _LETTERS.findall(w))]


class SuffixAutomaton:
    """All substrings of the added words; one flat table of arcs, (state << 21 | code point) -> state."""

    def __init__(self, words: list[str]):
        self.arcs: dict[int, int] = {}
        self.signs = 0
        link, size, out = [-1], [0], [[]]
        arcs = self.arcs
        for word in words:
            last = 0
            for c in map(ord, word):
                self.signs += 1
                there = arcs.get(last << 21 | c)
                if there is not None and size[there] == size[last] + 1:
                    last = there  # the word so far is known and its state may end here
                    continue
                new, walk = len(size), last
                split_only = there is not None
                if not split_only:
                    size.append(size[last] + 1)
                    link.append(0)
                    out.append([])
                    while walk >= 0 and (walk << 21 | c) not in arcs:
                        arcs[walk << 21 | c] = new
                        out[walk].append(c)
                        walk = link[walk]
                if walk >= 0:
                    old = arcs[walk << 21 | c]
                    if size[old] == size[walk] + 1:
                        link[new] = old
                    else:
                        twin = len(size)
                        size.append(size[walk] + 1)
                        link.append(link[old])
                        out.append(list(out[old]))
                        for x in out[old]:
                            arcs[twin << 21 | x] = arcs[old << 21 | x]
                        link[old] = twin
                        if split_only:
                            new = twin
                        else:
                            link[new] = twin
                        while walk >= 0 and arcs.get(walk << 21 | c) == old:
                            arcs[walk << 21 | c] = twin
                            walk = link[walk]
                last = new

    def phrases(self, word: str) -> int:
        """Longest matches, one behind the other, that the word falls into."""
        arcs, state, n = self.arcs, 0, 0
        for c in map(ord, word):
            there = arcs.get(state << 21 | c)
            if there is None:
                n += state > 0
                there = arcs.get(c)
                if there is None:
                    n += 1
                    there = 0
            state = there
        return n + (state > 0)


class CrossParser:
    """Phrase counts of texts for each label; ``sample``: the words of each label."""

    def __init__(self, sample: dict[str, list[str]], keep: int = 400_000):
        self.labels = sorted(sample)
        self.automata = [SuffixAutomaton([f" {w} " for w in sample[x]]) for x in self.labels]
        self.weight = np.array([math.log2(a.signs + 2) for a in self.automata])
        self.keep, self.table = keep, {}

    def _word(self, word: str) -> bytes:
        marked = f" {word} "
        got = array("I", [a.phrases(marked) for a in self.automata]).tobytes()
        if len(word) <= 64:
            if len(self.table) >= self.keep:
                self.table.clear()
            self.table[word] = got
        return got

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Label, score (how far the runner-up's entropy lies above the winner's, 0 to 1), the winner's bits per sign."""
        words = words_of(text.lower()) if text else []
        if not words or not self.labels:
            return NONE, 0.0, 0.0
        get, miss = self.table.get, self._word
        counts = np.frombuffer(b"".join([get(w) or miss(w) for w in words]), np.uint32).reshape(len(words), -1).sum(axis=0, dtype=np.int64)
        bits = counts * self.weight / (sum(map(len, words)) + 2 * len(words))
        best = int(np.argmin(bits))
        rest = np.delete(bits, best)
        return self.labels[best], float(1 - bits[best] / rest.min()) if len(rest) else 1.0, float(bits[best])

    def need(self, text: str | None) -> tuple[str, float, float]:
        """Label, score, and the winner's bits per sign over the text's distinct words, lowered where those are few."""
        label, score, _ = self.predict(text)
        if label == NONE:
            return label, score, 0.0
        at, kinds = self.labels.index(label), set(words_of(text.lower()))
        phrases = sum(memoryview(self.table.get(w) or self._word(w)).cast("I")[at] for w in kinds)
        bits = phrases * float(self.weight[at]) / (sum(map(len, kinds)) + 2 * len(kinds))
        return label, score, bits / (1 + 1 / math.sqrt(len(kinds)))


def _labelled(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())


def _low(share: dict[str, float], key: str) -> Column:
    """Whether the hash of ``key`` is in the share of the row's label; 52 bits of it: a share may be as small as a double can tell."""
    of = F.create_map(*[F.lit(x) for k, v in sorted(share.items()) for x in (k, v)])
    return F.shiftrightunsigned(F.xxhash64(key), 12) < of[F.col("lang")] * (1 << 52)


def _fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % folds


def count_words(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(lang, word, n): in how many of a label's texts a word stands, n an array by fold."""
    ensure_checkpoint_dir(docs.sparkSession)
    said = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1))
    words = _labelled(docs).select("lang", _fold(folds).alias("fold"), F.explode(said).alias("word"))
    return words.groupBy("lang", "word").agg(F.array(*[F.count_if(F.col("fold") == i) for i in range(folds)]).alias("n")).checkpoint()


def choose_words(counted: DataFrame, of: list[int], train_words: int = TRAIN_WORDS) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """The words of each label's automaton by the counts of the folds ``of``. What reaches the driver: a row per label and count, then
    about ``train_words`` words per label."""
    counted = counted.select("lang", "word", sum((F.col("n")[i] for i in of), F.lit(0)).alias("n")).where("n > 0")
    room, least, share = {}, {}, {}
    for r in sorted(counted.groupBy("lang", "n").agg(F.count("*").alias("kinds")).collect(), key=lambda r: -r.n):
        left = room.setdefault(r.lang, train_words)
        if left > 0:
            least[r.lang], share[r.lang] = r.n, min(1.0, left / r.kinds)
            room[r.lang] = left - r.kinds
    if not least:
        return ()
    last = F.create_map(*[F.lit(x) for kv in sorted(least.items()) for x in kv])[F.col("lang")]
    out: dict[str, list[str]] = {}
    for r in counted.where((F.col("n") > last) | (F.col("n") == last) & _low(share, "word")).select("lang", "word").collect():
        out.setdefault(r.lang, []).append(r.word)
    return tuple((k, tuple(sorted(v))) for k, v in sorted(out.items()))


def learn_sample(docs: DataFrame, train_docs: int | None = None, train_words: int = TRAIN_WORDS, folds: int = FOLDS, held: int = HELD) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """The words of each label by all texts of the learning folds; with ``train_docs``, by so many a label, as expected."""
    learn = _labelled(docs).where(_fold(folds) != held)
    if train_docs is not None:
        share = {r.lang: min(1.0, train_docs / r.n) for r in learn.groupBy("lang").agg(F.count("*").alias("n")).collect()}
        learn = learn.where(_low(share, "doc_id")) if share else learn
    return choose_words(count_words(learn, folds), [i for i in range(folds) if i != held], train_words)


def _parser(sample: tuple) -> CrossParser:
    """One a worker process and sample, so its table serves all tasks of the process."""
    return kept(("languages", sample), lambda: CrossParser({k: list(v) for k, v in sample}))


def predict_languages(docs: DataFrame, sample: tuple | None = None, folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits; a narrow scan after the words are learnt."""
    model = learn_sample(docs, folds=folds, held=held) if sample is None else sample

    def row():
        return _parser(model).predict

    out = per_document(docs, row, "lang_pred string, score double, bits double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits")


def learn_limits(docs: DataFrame, samples: dict[int, tuple], folds: int = FOLDS) -> dict[str | None, float]:
    """The largest need that still counts as a learnt language, by winner; under None, that of winners with few texts.
    ``samples``: by fold the words that its texts are measured by, every one whose label has words there. What reaches the driver: how many
    texts a winner has in each bin."""
    by: dict[str | None, Counter] = {}
    for fold, sample in samples.items():  # one after the other: a worker keeps the automata of one sample

        def row(sample=sample):
            return _parser(sample).need

        known = _labelled(docs).where((_fold(folds) == fold) & F.col("lang").isin([k for k, _ in sample]))
        needs = per_document(known, row, "won string, score double, need double").where(F.col("won") != NONE)
        for r in needs.groupBy("won", F.floor(F.col("need") * NEED_BINS).alias("bin")).agg(F.count("*").alias("n")).collect():
            for k in (r.won, None):
                by.setdefault(k, Counter())[r.bin] += r.n
    out = {}
    for k, bins in by.items():
        n = bins.total()
        if k is None or n >= LIMIT_LEAST:
            beyond, order = n // 1000, iter(sorted(bins, reverse=True))
            while beyond >= 0:
                top = next(order)
                beyond -= bins[top]
            out[k] = (top + 1) / NEED_BINS * (1 + SLACK + 1 / math.sqrt(n))
    return out


def keep_identified(docs: DataFrame, min_score: float = 0.0, folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """The documents whose language is identified: not ``und``, of a learnt language by the limits of ``learn_limits``, and
    not under ``min_score``. A narrow map after the words and the limits are learnt."""
    counted, learn = count_words(docs.where(_fold(folds) != held), folds), [i for i in range(folds) if i != held]
    model = choose_words(counted, learn)
    limits = learn_limits(docs, {i: choose_words(counted, [j for j in learn if j != i]) for i in learn}, folds)
    other = limits.get(None, math.inf)
    text = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        parser = _parser(model)
        for b in slices(batches, text):
            said = (parser.need(t.as_py()) for t in b.column(text))
            yield b.filter(pa.array([p[0] != NONE and p[1] >= min_score and p[2] <= limits.get(p[0], other) for p in said], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
