"""Comparators, text levels and difference classes.

Regular expressions and case mapping stay in the JVM; Unicode normal forms and full case folding, which Spark has no
expression for, are one Arrow-batched function each. A null text counts as empty in comparators, as a missing value does
in the data this engine reads.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import digest


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normal_form(c: Column | str, form: str) -> Column:
    """The text in NFC, NFD, NFKC or NFKD; null stays null. ASCII text is handed back as it is."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize(form, x))

    return run(as_column(c))


def casefold(c: Column | str) -> Column:
    """Full case folding (one sign may become several); null stays null."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x is None else x.casefold())

    return run(as_column(c))


def collapse(c: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(as_column(c), r"(?U)\s+", " "))


def no_punctuation(c: Column | str) -> Column:
    """Every sign of a Unicode punctuation category as a space."""
    return F.regexp_replace(as_column(c), r"\p{P}", " ")


def spoken_signs(c: Column | str) -> Column:
    """Everything that is neither a word sign nor white space as a space."""
    return F.regexp_replace(as_column(c), r"(?U)[^\w\s]", " ")


#: What a comparator may do to a text, in any order.
STEPS = {
    "nfc": lambda c: normal_form(c, "NFC"),
    "nfkc": lambda c: normal_form(c, "NFKC"),
    "no_punctuation": no_punctuation,
    "collapse": collapse,
    "strip": F.trim,
    "casefold": casefold,
    "equal": lambda c: c,
}


@dataclass(frozen=True)
class Comparator:
    """Two texts are equal under a comparator if they are equal after its steps, then its form and case policy."""

    name: str
    steps: tuple[str, ...]
    form: str | None = None
    fold: bool = False
    invariances: tuple[str, ...] = field(default=())

    def __post_init__(self):
        unknown = [s for s in self.steps if s not in STEPS]
        if unknown:
            raise ValueError(f"comparator {self.name} has unknown steps {unknown}")

    def key(self, c: Column | str) -> Column:
        out = F.coalesce(as_column(c).cast("string"), F.lit(""))
        for step in self.steps:
            out = STEPS[step](out)
        if self.form:
            out = normal_form(out, self.form)
        if self.fold and "casefold" not in self.steps[-1:]:
            out = casefold(out)
        return collapse(out)

    def same(self, a: Column | str, b: Column | str) -> Column:
        return self.key(a) == self.key(b)


_SPACE = ("letter case", "surrounding space", "repeated space")
#: The registered comparators by name.
COMPARATORS = {
    c.name: c
    for c in (
        Comparator("exact", ("collapse", "strip"), invariances=_SPACE[1:]),
        Comparator("spoken", ("no_punctuation", "collapse", "strip", "casefold", "equal"), fold=True, invariances=(*_SPACE, "punctuation")),
        Comparator("label", ("nfc", "collapse", "strip"), invariances=_SPACE[1:]),
        Comparator("folded", ("collapse", "strip", "casefold"), "NFKC", True, _SPACE),
        Comparator("transcript", ("no_punctuation", "collapse", "strip", "casefold"), "NFC", True, (*_SPACE, "punctuation")),
        Comparator("term", ("collapse", "strip", "casefold"), "NFC", True, _SPACE),
        Comparator("integer", ("strip",), invariances=_SPACE[1:2]),
    )
}


def comparator_set_hash(names: list[str]) -> str:
    """One hash of the definitions of several comparators, whatever order they are named in."""
    told = [[c.name, list(c.steps), c.form, c.fold] for c in (COMPARATORS[n] for n in sorted(set(names)))]
    return hashlib.sha256(json.dumps(told, separators=(",", ":")).encode()).hexdigest()


def independent_spoken_key(c: Column | str) -> Column:
    """A second definition of spoken equality, by word signs instead of punctuation categories, to check the first."""
    return casefold(collapse(spoken_signs(F.coalesce(as_column(c).cast("string"), F.lit("")))))


def field_key(c: Column | str, exact: bool = False) -> Column:
    """Comparison key of a field's value: NFKC, then as it stands or collapsed and folded. Null, 0 and false count as empty."""
    text = as_column(c).cast("string")
    value = F.when(text.isNull() | text.isin("0", "0.0", "false"), F.lit("")).otherwise(text)
    out = normal_form(value, "NFKC")
    return out if exact else casefold(collapse(out))


def question_key(c: Column | str) -> Column:
    return casefold(collapse(normal_form(as_column(c), "NFC")))


def split_key(c: Column | str) -> Column:
    """Lower case and collapsed, without any Unicode normal form."""
    return collapse(F.lower(as_column(c)))


ENDS = r"""[\s.,;:!?"'“”‘’()\[\]{}<>*_`-]+"""


def answer_key(c: Column | str) -> Column:
    """An answer's text for comparison: NFKC, folded, no punctuation at the ends. Null is empty."""
    out = casefold(F.trim(normal_form(F.coalesce(as_column(c).cast("string"), F.lit("")), "NFKC")))
    return F.regexp_replace(F.regexp_replace(out, "^" + ENDS, ""), ENDS + "$", "")


def levels(c: Column | str) -> dict[str, Column]:
    """A text as it is, folded, without punctuation, and both."""
    c = as_column(c)
    bare = collapse(no_punctuation(c))
    return {"raw": c, "folded": casefold(c), "bare": bare, "bare_folded": casefold(bare)}


def difference(a: Column | str, b: Column | str) -> Column:
    """What tells two texts apart: nothing, white space, case, punctuation, case and punctuation, or words."""
    a, b = as_column(a), as_column(b)
    x, y = collapse(a), collapse(b)
    fx, fy = casefold(x), casefold(y)
    wx, wy = (collapse(casefold(spoken_signs(t))) for t in (x, y))
    mixed = (fx != fy) & ((wx != fx) | (wy != fy))
    spoken = F.when(mixed, "PUNCTUATION_OR_CASE_AND_PUNCTUATION_ONLY").otherwise("PUNCTUATION_ONLY")
    return F.when(a == b, "RAW_EQUAL").when(x == y, "WHITESPACE_ONLY").when(fx == fy, "CASE_ONLY").when(wx == wy, spoken).otherwise("LEXICAL_OR_MIXED")


def term_list(c: Column | str) -> Column:
    """Terms of a semicolon list, trimmed, in their spelling; null and empty parts give none."""
    return F.filter(F.transform(F.split(F.coalesce(as_column(c), F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")


def term_match(term: Column | str, text: Column | str) -> Column:
    """How a term stands in a text: as it is, in other case, with other punctuation or spacing, hyphenated otherwise, or not.

    A term that stands at word boundaries of the bare texts also stands in them as a substring, so that level has no rows.
    """
    t, x = levels(F.coalesce(as_column(term), F.lit(""))), levels(F.coalesce(as_column(text), F.lit("")))
    tight = lambda c: F.replace(F.replace(c, F.lit("-"), F.lit("")), F.lit(" "), F.lit(""))
    return (
        F.when((t["raw"] == "") | (x["raw"] == ""), "ANNOTATION_UNCLEAR")
        .when(F.contains(x["raw"], t["raw"]), "A_RAW")
        .when(F.contains(x["folded"], t["folded"]), "B_CASE_ONLY")
        .when(F.contains(x["bare_folded"], t["bare_folded"]), "C_PUNCT_OR_WS")
        .when(F.contains(tight(x["bare_folded"]), tight(t["bare_folded"])), "HYPHENATION_VARIANT")
        .otherwise("LEXICAL_MISMATCH")
    )


def hash_seed(*parts: Column | str) -> Column:
    """First 64 bits of the digest as a decimal(20): the stable seed of the parts."""
    return F.conv(F.substring(digest(*parts), 1, 16), 16, 10).cast("decimal(20,0)")


def fingerprint64(c: Column | str) -> Column:
    """64 bits of a text for distinct counts."""
    return F.xxhash64(as_column(c).cast("string"))


def row_id(namespace: str, *parts: Column | str) -> Column:
    """Namespace and 16 hex digits of the parts' digest."""
    return F.concat(F.lit(namespace), F.substring(digest(*parts), 1, 16))


def json_object(text: Column | str) -> Column:
    """The first JSON object in free text, a code fence around it or not; null if what stands between the braces is none."""
    inner = F.regexp_replace(as_column(text), r"(?s)```[a-zA-Z]*\n?", "")
    found = F.nullif(F.regexp_extract(inner, r"(?s)(\{.*\})", 1), F.lit(""))
    return F.when(F.try_parse_json(found).isNotNull(), found)


def canonical_json(**columns: Column | str) -> Column:
    """One JSON object by name order, without spaces, nulls as null; for ids that must not depend on column order."""
    parts = []
    for name in sorted(columns):
        c = as_column(columns[name])
        shown = F.coalesce(F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1), F.lit(""))
        parts.append(F.concat(F.lit(f'"{name}":'), F.when(shown == "", F.lit("null")).otherwise(shown)))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
