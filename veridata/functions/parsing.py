"""Strict readings of text fields, each with a status, and the bins and recodes that follow from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column


def blank(c: Column | str) -> Column:
    """Null, or nothing but white space."""
    text = as_column(c).cast("string")
    return text.isNull() | (F.trim(text) == "")


def positive_decimal(c: Column | str) -> Column:
    """A finite decimal over 0, or null: equal numbers are equal however they are written."""
    v = F.trim(as_column(c).cast("string")).try_cast("decimal(38,18)")
    return F.when(v > 0, v)


def number_status(c: Column | str) -> Column:
    """missing, malformed (also infinite and not a number), nonpositive or valid."""
    v = F.trim(as_column(c).cast("string")).try_cast("double")
    bad = v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return F.when(blank(c), "missing").when(bad, "malformed").when(v <= 0, "nonpositive").otherwise("valid")


def age_status(c: Column | str, unknown: str = "unidentified") -> Column:
    """age, unidentified or malformed; only whole numbers without a sign are ages."""
    text = F.trim(as_column(c).cast("string"))
    return F.when(F.lower(text) == unknown, "unidentified").when(F.coalesce(text.rlike("^[0-9]+$"), F.lit(False)), "age").otherwise("malformed")


def age(c: Column | str) -> Column:
    return F.when(age_status(c) == "age", F.trim(as_column(c).cast("string")).try_cast("int"))


def age_group(years: Column | str) -> Column:
    """18-29, 30-59, 60 and over; null under 18."""
    a = as_column(years)
    return F.when(a < 18, F.lit(None)).when(a <= 29, "18-29").when(a <= 59, "30-59").when(a >= 60, "60+")


def url_id(c: Column | str, pattern: str = r"/([A-Za-z0-9]+)(?:\?[^/]*)?$") -> Column:
    """The id that a URL's last path part holds, or null."""
    return F.nullif(F.regexp_extract(F.trim(as_column(c)), pattern, 1), F.lit(""))


def clock_seconds(c: Column | str) -> Column:
    """Seconds of a clock text of any number of parts, each of digits; null otherwise."""
    text = F.trim(as_column(c).cast("string"))
    parts = F.transform(F.split(text, ":"), lambda x: x.try_cast("long"))
    return F.when(text.rlike("^[0-9]+(:[0-9]+)*$"), F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a * 60 + x))


def path_fault(c: Column | str) -> Column:
    """Why a reference to a file gives no portable name, or null: missing, a URL, no name, parent steps, a drive."""
    text = F.trim(as_column(c).cast("string"))
    name = F.substring_index(F.replace(text, F.lit("\\"), F.lit("/")), "/", -1)
    return (
        F.when(blank(c), "MISSING")
        .when(text.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), "NON_LOCAL")
        .when(name.isin("", ".", ".."), "INVALID")
        .when(F.contains(name, F.lit("..")), "PATH_TRAVERSAL")
        .when(name.rlike("^[A-Za-z]:"), "INVALID")
    )


def portable_name(c: Column | str) -> Column:
    """The last part of a Windows or POSIX path, or null where ``path_fault`` says why not."""
    text = F.trim(as_column(c).cast("string"))
    return F.when(path_fault(c).isNull(), F.substring_index(F.replace(text, F.lit("\\"), F.lit("/")), "/", -1))


def recoded(c: Column | str, codes: dict[str, str]) -> Column:
    """The label of a raw code, compared as trimmed text; null for codes without one."""
    table = F.create_map(*[F.lit(x) for pair in sorted(codes.items()) for x in pair])
    return F.try_element_at(table, F.trim(as_column(c).cast("string")))


def under_split(c: Column | str, split: str, root: str = "audio") -> Column:
    """A path moved into the split's folder below ``root``; one that already names the split stays."""
    path = F.replace(as_column(c), F.lit("\\"), F.lit("/"))
    named = F.contains(path, F.lit(f"/{split}/"))
    inside = F.contains(path, F.lit(f"{root}/"))
    return F.when(named, path).when(inside, F.replace(path, F.lit(f"{root}/"), F.lit(f"{root}/{split}/"))).otherwise(F.concat(F.lit(f"{root}/{split}/"), F.substring_index(path, "/", -1)))
