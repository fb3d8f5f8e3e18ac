"""ANSI-safe parsers for untyped spreadsheet cells (Column -> Column).

Spark 4 runs with ANSI mode on, so every parser here uses ``try_*``
functions and returns NULL on bad input instead of failing the job.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from furrow.functions._util import col

# The accepted date / date-time layouts, in the order they are tried.
DATE_FORMATS = ("M/d/yyyy", "M/d/yy", "yyyy-M-d")
DATE_FORMATS_WITH_SLASH_ISO = ("M/d/yyyy", "M/d/yy", "yyyy-M-d", "yyyy/M/d")
TS_FORMATS = (
    "M/d/yyyy H:m:s",
    "M/d/yyyy H:m",
    "M/d/yy H:m:s",
    "M/d/yy H:m",
    "yyyy-M-d H:m:s",
    "M/d/yyyy",
    "M/d/yy",
    "yyyy-M-d",
)
DATE_ONLY_FORMATS = ("M/d/yyyy", "M/d/yy", "yyyy-M-d")
TIME_FORMATS = ("H:m:s", "H:m")
TIME_FORMATS_AMPM = ("h:m:s a", "h:m a")
TRUE_WORDS = ("TRUE", "YES", "1")
FALSE_WORDS = ("FALSE", "NO", "0")
POSITIVE_WORDS = ("true", "positive", "detected")
# Two-digit years 69-99 belong to the 1900s (the C library pivot).
TWO_DIGIT_YEAR_PIVOT = 69


_WS = " \t\r\n\f\v"


def _strip(c) -> Column:
    """Python ``str.strip()`` (all ASCII whitespace), without a regex."""
    return F.btrim(col(c).cast("string"), F.lit(_WS))


def _expand_two_digit_year(s: Column, fmt: str):
    """For a layout with a two-digit year, rewrite the cell's year to four
    digits with the C / Python pivot (69-99 -> 19xx, 00-68 -> 20xx) and
    return (text, four-digit layout); other layouts pass through."""
    if "yy" not in fmt or "yyyy" in fmt:
        return s, fmt
    body = _layout_body(fmt)
    pre, post = body.split(r"\d{2}", 1)
    rx = "^(?<pre>" + pre + r")(?<yy>\d{2})(?<post>" + post + ")$"
    yy = F.regexp_extract(s, rx, 2)
    text = F.when(yy.try_cast("int") >= TWO_DIGIT_YEAR_PIVOT, F.regexp_replace(s, rx, "${pre}19${yy}${post}")) \
        .otherwise(F.regexp_replace(s, rx, "${pre}20${yy}${post}"))
    return text, fmt.replace("yy", "yyyy", 1)


def _try_ts(s: Column, fmt: str) -> Column:
    text, fmt4 = _expand_two_digit_year(s, fmt)
    return F.try_to_timestamp(text, F.lit(fmt4)).cast("timestamp_ntz")


_LAYOUT_TOKENS = {"yyyy": r"\d{4}", "yy": r"\d{2}", " a": r"\s*[AaPp][Mm]"}


def _layout_body(fmt: str) -> str:
    def tok(m):
        t = m.group(0)
        return _LAYOUT_TOKENS.get(t, r"\d{1,2}")

    return re.sub(r"yyyy|yy| a|M+|d+|H+|h+|m+|s+", tok, fmt)


def _layout_regex(fmt: str) -> str:
    """Digit layout of a datetime pattern: 'M/d/yyyy' -> one or two digits, slash, ..., four digits."""
    return "^" + _layout_body(fmt) + "$"


def parse_ts_multi(c, fmts=TS_FORMATS, date_only_hour: int = 0, date_only_fmts=DATE_ONLY_FORMATS, stripped: bool = False) -> Column:
    """First layout that matches the whole cell wins; date-only layouts get
    ``date_only_hour`` (12 in the food-safety sheets, 0 elsewhere)."""
    s = col(c) if stripped else _strip(c)
    tries = []
    for fmt in fmts:
        t = _try_ts(s, fmt)
        if fmt in date_only_fmts and date_only_hour:
            t = t + F.make_dt_interval(F.lit(0), F.lit(date_only_hour))
        # parse only when the layout matches; a NULL falls through to the next layout
        tries.append(F.when(s.rlike(_layout_regex(fmt)), t))
    return F.coalesce(*tries)


def parse_date_multi(c, fmts=DATE_FORMATS, before_space: bool = False) -> Column:
    """First of ``m/d/Y``, ``m/d/y``, ``Y-m-d`` (variants add ``Y/m/d`` or take
    the part before a space) -> DATE; NULL when nothing matches."""
    s = _strip(c)
    if before_space:
        s = F.substring_index(s, " ", 1)
    return parse_ts_multi(s, fmts, stripped=True).cast("date")


def parse_time_multi(c, ampm: bool = False) -> Column:
    """``H:M[:S]`` (optionally ``h:M[:S] AM/PM``) -> 'HH:mm:ss' text."""
    s = _strip(c)
    fmts = TIME_FORMATS + (TIME_FORMATS_AMPM if ampm else ())
    tries = []
    for fmt in fmts:
        t = F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), F.upper(s)), F.lit("yyyy-MM-dd " + fmt))
        tries.append(F.when(s.rlike(_layout_regex(fmt)), F.date_format(t, "HH:mm:ss")))
    return F.coalesce(*tries)


def combine_date_time(d, t, default: str | None = None) -> Column:
    """date + 'HH:mm:ss' -> wall-clock TIMESTAMP_NTZ; ``default`` used when the
    time is blank (the schedule uses 07:00)."""
    tt = col(t) if default is None else F.coalesce(col(t), F.lit(default))
    return F.try_to_timestamp(
        F.concat(F.date_format(col(d), "yyyy-MM-dd"), F.lit(" "), tt), F.lit("yyyy-MM-dd HH:mm:ss")
    ).cast("timestamp_ntz")


def split_period(period, check=None) -> Column:
    """'d1 - d2' -> struct<start, end, check_date>. Check date falls back to
    end then start; start / end fall back to the check date."""
    p = _strip(period)
    has = p.contains(" - ")
    start = F.when(has, parse_date_multi(F.substring_index(p, " - ", 1)))
    end = F.when(has, parse_date_multi(F.substr(p, F.instr(p, " - ") + 3)))
    chk = F.coalesce(parse_date_multi(check) if check is not None else F.lit(None).cast("date"), end, start)
    return F.struct(
        F.coalesce(start, chk).alias("start"),
        F.coalesce(end, chk).alias("end"),
        chk.alias("check_date"),
    )


def with_split_period(df, period, check=None, out: str = "period_parts"):
    """DataFrame form of ``split_period``: each date is parsed once, in its
    own projection (Catalyst keeps the projections apart because merging
    them would duplicate the parse), then packed into the same struct."""
    d = df.withColumn("_sp_p", _strip(period))
    p = F.col("_sp_p")
    has = p.contains(" - ")
    d = d.withColumn("_sp_s", F.when(has, parse_date_multi(F.substring_index(p, " - ", 1)))) \
          .withColumn("_sp_e", F.when(has, parse_date_multi(F.substr(p, F.instr(p, " - ") + 3))))
    chk = parse_date_multi(check) if check is not None else F.lit(None).cast("date")
    d = d.withColumn("_sp_c", F.coalesce(chk, F.col("_sp_e"), F.col("_sp_s")))
    return d.withColumn(out, F.struct(F.coalesce("_sp_s", "_sp_c").alias("start"), F.coalesce("_sp_e", "_sp_c").alias("end"),
                                      F.col("_sp_c").alias("check_date"))).drop("_sp_p", "_sp_s", "_sp_e", "_sp_c")


def parse_number(c, default=None, strip: str = ",", dtype: str = "double") -> Column:
    """Remove separators (``,`` and optionally ``%``), ``try_cast``; blank or
    invalid -> ``default`` (NULL when None)."""
    s = _strip(c)
    if strip:
        s = F.regexp_replace(s, "[" + "".join("\\" + ch if ch in "]\\^-" else ch for ch in strip) + "]", "")
    v = F.when(s != "", s).try_cast(dtype)
    return v if default is None else F.coalesce(v, F.lit(default).cast(dtype))


def parse_int_trunc(c, default=None) -> Column:
    """``int(float(x))``: truncation toward zero; text, nan, infinity and
    values beyond 64 bits are invalid."""
    x = parse_number(c, strip="")
    v = F.when(~F.isnan(x), x).try_cast("long")
    return v if default is None else F.coalesce(v, F.lit(default).cast("long"))


def parse_bool(c, extra=()) -> Column:
    """Two-valued: TRUE / YES / 1 (plus ``extra`` such as T / Y) -> True, else False."""
    return F.coalesce(F.upper(_strip(c)).isin(*TRUE_WORDS, *extra), F.lit(False))


def parse_bool3(c, extra_true=(), extra_false=()) -> Column:
    """Three-valued: True / False / NULL for blank or unknown."""
    u = F.upper(_strip(c))
    return F.when(u.isin(*TRUE_WORDS, *extra_true), True).when(u.isin(*FALSE_WORDS, *extra_false), False)


def parse_positive(c) -> Column:
    """'true' / 'positive' / 'detected' -> True; other text -> False; blank -> NULL."""
    s = F.lower(_strip(c))
    return F.when((s == "") | s.isNull(), F.lit(None).cast("boolean")).otherwise(s.isin(*POSITIVE_WORDS))


def parse_mixed_fraction(c) -> Column:
    """'23 7/8' -> 23.875 rounded to 4 places; N/A, no digit or a zero denominator -> NULL."""
    s = _strip(c)
    parts = F.split(F.regexp_replace(s, r"\s+", " "), " ")
    terms = F.transform(
        parts,
        lambda p: F.when(
            p.contains("/"),
            F.try_divide(F.substring_index(p, "/", 1).try_cast("double"), F.substring_index(p, "/", -1).try_cast("double")),
        ).otherwise(p.try_cast("double")),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    bad = s.isNull() | (s == "") | (F.upper(s) == "N/A") | ~s.rlike(r"\d")
    return F.when(bad, F.lit(None).cast("double")).otherwise(F.round(total, 4))


def percent_to_ratio(c) -> Column:
    """'40%' -> 0.4 (4 places)."""
    v = parse_number(c, strip=",%")
    return F.round(v / 100.0, 4)
