"""Interactive reads: filter, search, sort, page, select."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def search(df: DataFrame, text: str, *cols: str) -> DataFrame:
    """Rows with the text, without case, in any of the columns."""
    test = F.lit(False)
    for c in cols:
        test = test | F.coalesce(F.lower(c).contains(text.lower()), F.lit(False))
    return df.where(test)


def page(df: DataFrame, order: list[Column], size: int = 200, number: int = 0) -> DataFrame:
    """A page of the whole sorted result; give an order without ties."""
    return df.orderBy(*order).offset(size * number).limit(size)


def by_value(c: str, falling: bool) -> Column:
    """NULL last both ways."""
    return F.col(c).desc_nulls_last() if falling else F.col(c).asc_nulls_last()


def download(df: DataFrame, date: str, first: str, last: str, cols: list[str]) -> DataFrame:
    """Rows in a range of dates, and those without one."""
    return df.where(F.col(date).isNull() | F.col(date).between(F.lit(first), F.lit(last))).select(*cols)
