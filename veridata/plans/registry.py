"""Every query by name with the DuckDB statement whose rows it must equal, and the SQL phrases that statements share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def stated(sql: str) -> Callable:
    """Registers a query under its function's name, beside its statement."""

    def mark(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return mark


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def digest(*parts: str) -> str:
    return "sha256(concat_ws('|', '42', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), 'None')" for p in parts) + "))"


def hash_int(*parts: str) -> str:
    return f"CAST(('0x' || substr({digest(*parts)}, 1, 8)) AS BIGINT)"


def collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def bare(x: str) -> str:
    return rf"regexp_replace({x}, '[\p{{P}}]', ' ', 'g')"


def fold(x: str) -> str:
    """Case folding of the signs that the tables hold."""
    return f"replace(lower({x}), 'ß', 'ss')"


def words_only(x: str) -> str:
    return rf"regexp_replace({x}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')"


def spoken(x: str) -> str:
    return f"trim(regexp_replace({words_only(f'lower({x})')}, '\\s+', ' ', 'g'))"


def audio(dataset: str, row: str) -> str:
    return f"'audio_' || substr(sha256(concat_ws('|', '{dataset}', 'r1', CAST({row} AS VARCHAR))), 1, 20)"


def count_if(x: str, name: str) -> str:
    return f"count(*) FILTER ({x}) AS {name}"


SPLIT = "CASE WHEN {h} < 8 THEN 'train' WHEN {h} = 8 THEN 'val' ELSE 'test' END"


def split_of(key: str) -> str:
    return SPLIT.format(h=f"({hash_int(key)} % 10)")
