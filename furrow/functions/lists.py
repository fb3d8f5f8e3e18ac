"""Delimited-cell and note-building functions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from furrow.functions._util import col

# Blank-like cell contents skipped when building notes.
BLANK_MARKERS = ("", "N/A")


def split_list(c, sep: str = r"[+;&,]", dedupe: bool = False) -> Column:
    """Split on a separator regex, trim, drop blanks, optionally de-duplicate
    keeping the first occurrence."""
    parts = F.transform(F.split(col(c), sep), lambda x: F.trim(x))
    parts = F.filter(parts, lambda x: x != "")
    return F.array_distinct(parts) if dedupe else parts


def _nonblank(c: Column) -> Column:
    s = F.trim(c.cast("string"))
    return F.when(~F.coalesce(F.upper(s).isin(*BLANK_MARKERS), F.lit(True)), s)


def join_labelled_notes(pairs, sep: str = " | ") -> Column:
    """'Label: value' for each non-blank cell, joined by ``sep``; NULL when none."""
    parts = [F.when(_nonblank(col(c)).isNotNull(), F.concat(F.lit(label + ": "), _nonblank(col(c)))) for label, c in pairs]
    out = F.concat_ws(sep, *parts)
    return F.when(out != "", out)


def concat_paragraphs(cs, sep: str = "\n\n") -> Column:
    """Non-blank, non-'N/A' cells joined by blank lines; NULL when none."""
    out = F.concat_ws(sep, *[_nonblank(col(c)) for c in cs])
    return F.when(out != "", out)


def collect_nonblank(cs) -> Column:
    """Non-blank cells -> array (order kept)."""
    return F.filter(F.array(*[_nonblank(col(c)) for c in cs]), lambda x: x.isNotNull())


def carry_unmatched(raw, looked_up, notes) -> Column:
    """When a lookup misses, keep the raw text inside the notes: '[raw] notes'."""
    tagged = F.concat(F.lit("["), col(raw), F.lit("]"))
    return F.when(
        col(looked_up).isNull() & col(raw).isNotNull(),
        F.when(F.coalesce(F.trim(col(notes)), F.lit("")) == "", tagged).otherwise(F.concat(tagged, F.lit(" "), col(notes))),
    ).otherwise(col(notes))
