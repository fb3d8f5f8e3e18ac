"""Arithmetic, date and unit functions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.functions._util import col, cols

# 16-point compass used for the wind-direction channel.
COMPASS_16 = ("N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
              "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW")
# Unit conversion factors of the weather channels.
MPS_TO_MPH = 2.23694
MM_TO_INCH = 0.0393701


def safe_ratio(n, d, otherwise=None) -> Column:
    """n / d only when d > 0, else ``otherwise`` (NULL by default)."""
    r = F.when(col(d) > 0, col(n) / col(d))
    return r if otherwise is None else r.otherwise(F.lit(otherwise))


def clamp_nonneg(a, b) -> Column:
    """GREATEST(a - b, 0); NULL when ``a`` (the limit) is NULL (unlimited)."""
    return F.when(col(a).isNotNull(), F.greatest(col(a) - F.coalesce(col(b), F.lit(0)), F.lit(0)))


def coalesce_chain(*cs) -> Column:
    return F.coalesce(*cols(cs))


def default_dates(d, base, days: int) -> Column:
    """d when present, else base + days."""
    return F.coalesce(col(d), F.date_add(col(base), days))


def age_days(later, earlier) -> Column:
    return F.datediff(col(later), col(earlier))


def reorder_point(burn_per_week, cushion_weeks, lead_weeks, factor=None, same_units=None) -> Column:
    """burn/week x (cushion + lead) x unit factor, 2 places (half-even, as
    the loader rounds in Python); the factor defaults to 1 only when the
    burn and order units match."""
    f = F.lit(1.0) if factor is None else col(factor)
    if same_units is not None:
        f = F.coalesce(f, F.when(col(same_units), F.lit(1.0)))
    v = col(burn_per_week) * (F.coalesce(col(cushion_weeks), F.lit(0)) + F.coalesce(col(lead_weeks), F.lit(0))) * f
    return F.bround(v, 2)


def bulk_weight(*cs) -> Column:
    """Product of all factors when every one is present and non-zero, 2 places."""
    c = cols(cs)
    ok = F.lit(True)
    prod = F.lit(1.0)
    for x in c:
        ok = ok & x.isNotNull() & (x != 0)
        prod = prod * x
    return F.when(ok, F.bround(prod, 2))


def generated_average(*cs) -> Column:
    c = cols(cs)
    total = c[0]
    for x in c[1:]:
        total = total + x
    return total / F.lit(len(c))


def elapsed_hours(start, stop, captured=None, per: int = 3600) -> Column:
    """(stop - start) seconds / 3600 (or / 60 with per=60); captured hours win."""
    secs = F.timestamp_diff("SECOND", col(start), col(stop))
    v = secs / F.lit(float(per))
    return v if captured is None else F.coalesce(col(captured), v)


def round_binary(c, n: int) -> Column:
    """Round the *binary* double value half away from zero, as C / Python
    float rounding does (1.255 is stored as 1.25499.. and gives 1.25);
    Spark's ``round`` rounds the decimal text instead (1.26)."""
    f = float(10 ** n)
    x = col(c)
    return F.signum(x) * F.floor(F.abs(x) * f + 0.5) / f


def unit_convert(kind, raw, exponent) -> Column:
    """Weather channel conversion: value = raw / 10^exponent, then per type.
    Returns struct<value double, label string>: numeric channels fill
    ``value``, the compass and power channels fill ``label``."""
    v = col(raw) / F.pow(F.lit(10.0), col(exponent))
    k = col(kind)
    temp = k.isin("TEMPERATURE", "WET_BULB_TEMPERATURE", "DEW_POINT_TEMPERATURE")
    compass = F.array(*[F.lit(x) for x in COMPASS_16])
    value = (
        F.when(temp, round_binary((v / 100) * 9 / 5 + 32, 2))
        .when(k == "HUMIDITY", round_binary(v / 100, 2))
        .when(k.isin("WIND_AVERAGE_SPEED", "WIND_AVERAGE_MAX_SPEED"), round_binary((v / 100) * MPS_TO_MPH, 2))
        .when(k == "RAIN", round_binary((v / 1000) * MM_TO_INCH, 4))
        .when(k.isin("PAR", "ATMOSPHERIC_PRESSURE"), round_binary(v / 100, 2))
        .when(~k.isin("WIND_DIRECTION", "POWER_SUPPLY"), v)
    )
    label = (F.when(k == "WIND_DIRECTION", F.try_element_at(compass, v.cast("int") + 1))
             .when(k == "POWER_SUPPLY", F.when(col(raw).cast("int") == 1, F.lit("On")).otherwise(F.lit("Off"))))
    return F.struct(value.alias("value"), label.alias("label"))


def utc_to_local_ntz(c, offset: str = "-10:00") -> Column:
    """UTC instant -> fixed-offset wall clock as TIMESTAMP_NTZ."""
    return F.from_utc_timestamp(col(c).cast("timestamp"), offset).cast("timestamp_ntz")


def date_parts(df: DataFrame, c: str, prefix: str = "") -> DataFrame:
    """year, month, ISO year, ISO week, day of week (Sunday = 0)."""
    d = col(c)
    return df.withColumns({
        f"{prefix}year": F.year(d),
        f"{prefix}month": F.month(d),
        f"{prefix}iso_year": F.extract(F.lit("YEAROFWEEK"), d),
        f"{prefix}iso_week": F.weekofyear(d),
        f"{prefix}dow": F.dayofweek(d) - 1,
    })


def week_start_sunday(d) -> Column:
    """Sunday-based week start (EXTRACT(DOW) has Sunday = 0)."""
    return F.date_sub(col(d).cast("date"), F.dayofweek(col(d)) - 1)


def round_half_up_int(c) -> Column:
    """NUMERIC::int rounds; Spark's cast truncates, so round first."""
    return F.round(col(c)).cast("int")


def share_round(amount, part, whole, scale: int = 2, weight_scale: int = 0) -> Column:
    """round(amount x part / whole, scale) computed exactly, half away from
    zero (NUMERIC semantics): the amount in units of its last digit and the
    weights in units of 10^-weight_scale are whole numbers, and the product
    is divided as such, so neither a rounded weight nor a binary-float tie
    can move the last digit. Weights with more decimals than
    ``weight_scale`` are rounded to it."""
    unit = F.lit(10 ** weight_scale)
    m = (col(amount) * F.lit(10 ** scale)).cast("decimal(18,0)")
    w = F.round(col(part) * unit).cast("decimal(19,0)")
    wt = F.round(col(whole) * unit).cast("decimal(19,0)")
    prod = m * w
    q = F.call_function("div", F.abs(prod) * F.lit(2) + wt, wt * F.lit(2))
    signed = F.when(prod < 0, -q).otherwise(q)
    return (signed.cast("decimal(18,0)") * F.lit(10 ** -scale).cast(f"decimal({scale + 1},{scale})")).cast(f"decimal(18,{scale})")
