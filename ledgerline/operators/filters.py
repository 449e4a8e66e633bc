"""Optional serving filters (FLT-1, FLT-2); values bound as literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.wire import MONTH


def _as_date(v):
    return dt.date.fromisoformat(v) if isinstance(v, str) else v


def between_dates(df: DataFrame, col: str, date_from=None, date_to=None) -> DataFrame:
    """Inclusive [date_from, date_to]; empty string or None means no bound.

    A written mart also gets the bound on its month folders, so other months are not read.
    """
    by_month = MONTH in df.columns
    for bound, above in ((date_from, True), (date_to, False)):
        if not bound:
            continue
        day = _as_date(bound)
        df = df.where(F.col(col) >= F.lit(day) if above else F.col(col) <= F.lit(day))
        if by_month:
            month = F.lit(f"{day:%Y-%m}")
            df = df.where(F.col(MONTH) >= month if above else F.col(MONTH) <= month)
    return df


def where_category(df: DataFrame, col: str, value: str | None = None) -> DataFrame:
    return df.where(F.col(col) == F.lit(value)) if value else df
