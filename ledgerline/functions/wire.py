"""Serving representation of results (what a JSON API hands out).

Dates become ISO strings, timestamps ``yyyy-MM-dd HH:mm:ss.SSSSSS`` strings and
DECIMAL measures doubles, the way the serving layer serialises rows. The month
folder of a written mart is no part of an answer. Work stays in Spark: this is
a final projection, never a collect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Partition column of written marts: the month of the date column.
MONTH = "_month"


def to_wire(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.drop(MONTH).schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        cols.append(c.alias(f.name))
    return df.select(*cols)
