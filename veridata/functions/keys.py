"""Hash ranks, ids and text comparison keys, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = "42"


def digest(*parts: Column | str) -> Column:
    """SHA-256 of the seed and the parts' text, joined by a vertical bar; nulls count as 'None'."""
    return F.sha2(F.concat_ws("|", F.lit(SEED), *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p.cast("string"), F.lit("None")) for p in parts]), 256)


def hash_int(*parts: Column | str) -> Column:
    """First 32 bits of the digest as a non-negative long."""
    return F.conv(F.substring(digest(*parts), 1, 8), 16, 10).cast("long")


def spoken_key(text: str) -> Column:
    """Lower case, other than letters, digits and underscore to one space, trimmed."""
    plain = F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}_\s]", " ")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def audio_id(dataset: str, revision: str, row: str) -> Column:
    """Opaque id of a row: a prefix and 20 hex digits."""
    return F.concat(F.lit("audio_"), F.substring(F.sha2(F.concat_ws("|", F.lit(dataset), F.lit(revision), F.col(row).cast("string")), 256), 1, 20))


def word_bucket(n: Column) -> Column:
    """Label of the word-count range."""
    out = F.lit("81+")
    for low, high in ((41, 80), (21, 40), (11, 20), (6, 10), (1, 5)):
        out = F.when(n <= high, F.lit(f"{low:02d}-{high:02d}")).otherwise(out)
    return out


def missing_to_null(value: str, markers: tuple[str, ...]) -> Column:
    """The value, or null where it is one of the markers after trimming, in any case."""
    return F.when(F.lower(F.trim(F.col(value))).isin(*markers), F.lit(None)).otherwise(F.col(value))


def comb2(n: Column) -> Column:
    """Unordered pairs of n things."""
    return (n * (n - 1) / 2).cast("long")
