"""Unicode normal forms and full case folding, which have no built-in expression: one Arrow-batched function."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(column: str | Column, form: str = "NFKC", casefold: bool = True) -> Column:
    """The text in a normal form, white space collapsed, case folded if asked. Null stays null."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        def one(x):
            if x is None:
                return None
            y = " ".join(unicodedata.normalize(form, x).split())
            return y.casefold() if casefold else y

        return s.map(one)

    return run(column)
