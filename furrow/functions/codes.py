"""Key, code and dictionary functions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from furrow.functions._util import col


def zero_pad(c, width: int = 2, only_digits: bool = True) -> Column:
    """Left-pad numeric codes: '3' -> '03' (width 2) or '0042' (width 4)."""
    s = F.trim(col(c))
    cond = s.rlike(r"^\d+$") if only_digits else F.lit(True)
    return F.when(cond & (F.length(s) < width), F.lpad(s, width, "0")).otherwise(s)


def map_values(c, mapping: dict[str, str], miss: str = "null", default: str | None = None) -> Column:
    """Canonical value from a lower-cased dictionary. ``miss``: 'null',
    'raw', 'default' (``default``) or 'other' ('Other')."""
    key = F.lower(F.trim(col(c)))
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k.lower()), F.lit(v))])
    hit = F.try_element_at(m, key)
    if miss == "raw":
        return F.coalesce(hit, col(c))
    if miss == "default":
        return F.coalesce(hit, F.lit(default))
    if miss == "other":
        return F.when(col(c).isNull() | (F.trim(col(c)) == ""), F.lit(None)).otherwise(F.coalesce(hit, F.lit("Other")))
    return hit


def whitelist_or_null(c, allowed) -> Column:
    return F.when(col(c).isin(*allowed), col(c))


def user_or_default(c, default: str) -> Column:
    s = F.trim(col(c))
    return F.when(s.contains("@"), s).otherwise(F.lit(default))


def prefix_classify(c, rules, default=None) -> Column:
    """Ordered tests ``[(kind, pattern, label)]``; kind in startswith /
    contains / rlike; first hit wins."""
    s = col(c)
    out = None
    for kind, pat, label in rules:
        cond = {"startswith": s.startswith(pat), "contains": s.contains(pat), "rlike": s.rlike(pat)}[kind]
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default)) if default is not None else out


def normalize_site_code(c, aliases: dict[str, str] | None = None, width: int = 2) -> Column:
    """trim, lower, alias map, pad single digits; a miss keeps the raw code."""
    s = F.lower(F.trim(col(c)))
    if aliases:
        s = F.coalesce(map_values(s, aliases), s)
    return zero_pad(s, width)


def compose_key(template: str, **parts) -> Column:
    """Build an id from parts, e.g. ``compose_key('{farm}_{site}_trap_{n}',
    farm=..., site=..., n=...)``; NULL when any part is NULL (``concat``)."""
    pieces = []
    rest = template
    while rest:
        i = rest.find("{")
        if i < 0:
            pieces.append(F.lit(rest))
            break
        if i:
            pieces.append(F.lit(rest[:i]))
        j = rest.index("}", i)
        pieces.append(col(parts[rest[i + 1:j]]).cast("string"))
        rest = rest[j + 1:]
    return F.concat(*pieces)


def split_pair_cell(c, codes: dict[str, str] | None = None, mixed=("Mixed", None)) -> Column:
    """'A/B' -> struct<primary, secondary>; a 'Mixed' cell -> fixed pair;
    names mapped to codes when a dictionary is given."""
    s = F.trim(col(c))
    a = F.trim(F.substring_index(s, "/", 1))
    b = F.when(s.contains("/"), F.trim(F.substring_index(s, "/", -1)))
    if codes:
        a = map_values(a, codes, miss="raw")
        b = map_values(b, codes, miss="raw")
    is_mixed = F.lower(s) == mixed[0].lower()
    pair = mixed[1] or ("", "")
    return F.struct(
        F.when(is_mixed, F.lit(pair[0])).otherwise(a).alias("primary"),
        F.when(is_mixed, F.lit(pair[1])).otherwise(b).alias("secondary"),
    )


def offset_key(c, cond, offset: int) -> Column:
    """Shift row numbers of one block: ``when(cond, c + offset)``."""
    return F.when(cond, col(c) + offset).otherwise(col(c))


def rewrite_path(c, pairs) -> Column:
    """Chain of literal prefix rewrites ``[(old, new), ...]`` applied in order."""
    s = col(c)
    for old, new in pairs:
        s = F.when(s.startswith(old), F.concat(F.lit(new), F.substr(s, F.lit(len(old) + 1)))).otherwise(s)
    return s


def normalize_ts_key(c) -> Column:
    """Drop zone suffix and fractions so two clocks compare equal:
    text or timestamp -> TIMESTAMP_NTZ truncated to the second."""
    s = F.regexp_replace(col(c).cast("string"), r"(Z|[+-]\d{2}:?\d{2})$", "")
    s = F.regexp_replace(s, "T", " ")
    return F.date_trunc("second", F.try_to_timestamp(F.regexp_replace(s, r"\.\d+$", ""))).cast("timestamp_ntz")


def lot_code(pack_date, harvest_date, given=None) -> Column:
    """'YYYYMMDD-YYYYMMDD' (pack-harvest) unless a non-blank lot is given."""
    gen = F.concat(F.date_format(col(pack_date), "yyyyMMdd"), F.lit("-"), F.date_format(col(harvest_date), "yyyyMMdd"))
    if given is None:
        return gen
    return F.coalesce(F.when(F.trim(col(given)) != "", F.trim(col(given))), gen)


def cycle_code(d, site, variety) -> Column:
    """'{YY}{MM}{SITE}{VARIETY}' upper-cased."""
    return F.upper(F.concat(F.date_format(col(d), "yyMM"), col(site).cast("string"), col(variety).cast("string")))


def parse_cycle_code(c) -> Column:
    """Inverse of ``cycle_code`` for 7-character codes (optional 'S-' trial
    prefix): struct<is_trial, year, month, site, variety, seeding_month>;
    century pivot 70 (yy >= 70 -> 19yy)."""
    s = F.upper(F.trim(col(c)))
    trial = s.startswith("S-")
    core = F.when(trial, F.substr(s, F.lit(3))).otherwise(s)
    ok = core.rlike(r"^\d{4}[0-9A-Z]{2}[A-Z]$")
    yy = F.substr(core, F.lit(1), F.lit(2)).try_cast("int")
    mm = F.substr(core, F.lit(3), F.lit(2)).try_cast("int")
    year = F.when(yy >= 70, yy + 1900).otherwise(yy + 2000)
    valid = ok & (mm >= 1) & (mm <= 12)
    return F.when(
        valid,
        F.struct(
            trial.alias("is_trial"),
            year.alias("year"),
            mm.alias("month"),
            F.substr(core, F.lit(5), F.lit(2)).alias("site"),
            F.substr(core, F.lit(7), F.lit(1)).alias("variety"),
            F.make_date(year, mm, F.lit(1)).alias("seeding_month"),
        ),
    )


def signed_amount(amount, credit, given=None) -> Column:
    """Credit flag flips the sign unless a precomputed value is given."""
    v = F.when(col(credit), -col(amount)).otherwise(col(amount))
    return v if given is None else F.coalesce(col(given), v)


def regex_extract_events(c, patterns: dict[str, str], pm_before: int = 7) -> Column:
    """Extract named times from free notes: ``{name: regex with one group
    capturing H or H:MM}`` -> map<name, 'HH:mm'>; hours below ``pm_before``
    are afternoon (h + 12)."""
    entries = []
    for name, pat in patterns.items():
        raw = F.regexp_extract(col(c), pat, 1)
        h = F.substring_index(raw, ":", 1).try_cast("int")
        m = F.when(raw.contains(":"), F.substring_index(raw, ":", -1)).otherwise(F.lit("00"))
        hh = F.when(h < pm_before, h + 12).otherwise(h)
        val = F.when(raw != "", F.concat(F.lpad(hh.cast("string"), 2, "0"), F.lit(":"), F.lpad(m, 2, "0")))
        entries += [F.lit(name), val]
    return F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull())
