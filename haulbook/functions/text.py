"""Text helpers as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .dates import as_col

# Markup decoded in survey notes.
MARKUP = [("&#39;", "'"), ("&#36;", "$"), ("&#34;", '"')]

# Markup and line ends removed from order notes.
BREAKS = ["<br />", "<br>", "\r\n"]

# The status codes for which a kit line must carry its numbers.
KIT_STATUS_CODES = "DSHOPMY#GS"


def clean_markup(c) -> Column:
    out = as_col(c)
    for mark, char in MARKUP:
        out = F.replace(out, F.lit(mark), F.lit(char))
    return out


def strip_breaks(c) -> Column:
    """Note text on one line; NULL becomes empty."""
    out = as_col(c)
    for mark in BREAKS:
        out = F.replace(out, F.lit(mark), F.lit(""))
    return F.coalesce(out, F.lit(""))


def strip_quotes(c) -> Column:
    return F.replace(as_col(c), F.lit("'"), F.lit(""))


def same_code(c, code: str) -> Column:
    """Codes compare without regard to case or trailing blanks."""
    return F.lower(F.rtrim(as_col(c))) == code.rstrip().lower()


def code_in(c, codes) -> Column:
    return F.lower(F.rtrim(as_col(c))).isin([x.lower() for x in codes])


def code_in_string(c, codes: str = KIT_STATUS_CODES) -> Column:
    """The trimmed code occurs as a substring of ``codes``; blank and NULL codes do not."""
    code = F.trim(as_col(c))
    return F.coalesce((code != "") & (F.position(code, F.lit(codes)) > 0), F.lit(False))


def prefix_like(c, prefix: str) -> Column:
    return F.lower(as_col(c)).startswith(prefix.lower())


def text_length(c) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(as_col(c)))


def label_with_id(name, key, gap: str = "   (", end: str = ")") -> Column:
    return F.concat(as_col(name), F.lit(gap), as_col(key).cast("string"), F.lit(end))


def person_name(last, first, middle=None) -> Column:
    """``Last, First[ Middle]``; NULL if any part is NULL."""
    parts = [as_col(last), F.lit(", "), as_col(first)]
    if middle is not None:
        parts += [F.lit(" "), as_col(middle)]
    return F.rtrim(F.concat(*parts))


def driver_label(first, last) -> Column:
    """``First L.``"""
    return F.concat(as_col(first), F.lit(" "), F.substring(as_col(last), 1, 1), F.lit("."))


def is_numeric(c) -> Column:
    return as_col(c).try_cast("double").isNotNull()
