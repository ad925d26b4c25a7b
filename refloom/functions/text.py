"""Text normalisation."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


def fold(text: str | None) -> str | None:
    """Lower case without accents: NFKD, combining marks dropped."""
    if text is None:
        return None
    if text.isascii():
        return text.lower()
    return "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch)).lower()


def _fold(s: pd.Series) -> pd.Series:
    return s.map(fold, na_action="ignore")


def folded(text: Column) -> Column:
    """`fold` as a column; Spark has no Unicode decomposition, so this is an Arrow UDF."""
    return pandas_udf(_fold, StringType())(text)


def words(text: Column, least: int = 3) -> Column:
    """The maximal runs of a-z and 0-9 of at least `least` characters in a folded text; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"[a-z0-9]{{{least},}}"), F.lit(0)), F.array().cast("array<string>"))
