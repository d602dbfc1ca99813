"""The statement of the capacity formulas, which several queries share."""

from __future__ import annotations


def _capacity(t: str, c: str) -> str:
    return f"""SELECT '{c}' AS field, CAST(sum(c) AS BIGINT) AS direct, CAST(sum(c * (c - 1) // 2) AS BIGINT) AS equal_pos,
  CAST(sum(c) * (sum(c) - 1) // 2 - sum(c * (c - 1) // 2) AS BIGINT) AS equal_neg, CAST(sum(c) AS BIGINT) AS match_pos, CAST(sum(c) * (count(*) - 1) AS BIGINT) AS match_neg,
  CAST(sum(c) * sum(c) - sum(c * c) AS BIGINT) AS selection FROM (SELECT count(*) AS c FROM {t} WHERE {c} IS NOT NULL GROUP BY {c})"""


CAPACITY = " UNION ALL ".join(_capacity(*x) for x in (("customer", "c_mktsegment"), ("customer", "c_nationkey"), ("orders", "o_orderpriority")))
