"""Wall-clock timestamp literals independent of the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz_lit(t) -> Column:
    """TIMESTAMP_NTZ literal from a naive datetime or ISO string.

    ``F.lit(datetime)`` goes through the process / session time zone; a
    typed SQL literal keeps the wall-clock value as written.
    """
    if isinstance(t, str):
        t = dt.datetime.fromisoformat(t)
    return F.expr(f"TIMESTAMP_NTZ '{t.isoformat(sep=' ')}'")
