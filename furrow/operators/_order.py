"""Order specifications shared by first / last / latest operators.

An order is a list of column names; a leading '-' means descending. Like
PostgreSQL, ascending puts NULLs last and descending puts NULLs first.

``rank_struct`` turns an order into one struct whose natural ascending
order is the requested order, so "first row per key" becomes a
``min_by(payload, rank)`` aggregation: partial (map-side) aggregation
keeps a hot key from landing whole in one task, unlike a window sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_order(order) -> list[tuple[str, bool]]:
    out = []
    for o in order:
        if o.startswith("-"):
            out.append((o[1:], True))
        else:
            out.append((o, False))
    return out


def _negate(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)):
        return -c
    if isinstance(dtype, T.DateType):
        return -F.unix_date(c)
    if isinstance(dtype, T.TimestampNTZType):
        # microseconds since the epoch read as wall clock: no session time zone involved
        return -F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    if isinstance(dtype, T.TimestampType):
        return -F.unix_micros(c)
    if isinstance(dtype, T.BooleanType):
        return ~c
    raise TypeError(f"descending order on {dtype} needs a numeric, date, timestamp or boolean column")


def rank_struct(df: DataFrame, order, reverse: bool = False) -> Column:
    """Struct ordered like ``order`` (``reverse`` flips every direction)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    fields = []
    for i, (name, desc) in enumerate(parse_order(order)):
        if reverse:
            desc = not desc
        c = F.col(name)
        if desc:
            # NULLs first, then larger values first.
            fields.append(c.isNotNull().alias(f"n{i}"))
            fields.append(_negate(c, types[name]).alias(f"v{i}"))
        else:
            fields.append(c.isNull().alias(f"n{i}"))
            fields.append(c.alias(f"v{i}"))
    return F.struct(*fields)


def window_order(order, reverse: bool = False) -> list[Column]:
    out = []
    for name, desc in parse_order(order):
        if reverse:
            desc = not desc
        out.append(F.col(name).desc_nulls_first() if desc else F.col(name).asc_nulls_last())
    return out
