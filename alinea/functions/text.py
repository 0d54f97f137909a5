"""Text functions of the pipeline as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeeze(c: Column) -> Column:
    """Runs of white space, of any kind, to one blank, none at the ends; null to the empty string."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def coded_text(c: Column, part: str) -> Column:
    """``code`` or ``text`` of "(CODE) text"; the empty string where a text has no leading code."""
    return F.regexp_extract(c, r"(?s)^\(([^)]+)\)\s*(.*)$", {"code": 1, "text": 2}[part])


def shorten(c: Column, width: int) -> Column:
    """The first ``width`` characters with an ellipsis where there are more."""
    return F.when(F.length(c) > width, F.concat(F.left(c, F.lit(width)), F.lit("…"))).otherwise(c)


def position_key(prefix: str, number: Column, digits: int) -> Column:
    return F.format_string(f"{prefix}%0{digits}d", number)


def lookup_key(code: Column, ident: Column) -> Column:
    """The code, or the first eight characters of the id where the code is missing."""
    bare = F.lower(F.trim(code))
    return F.when(code.isNotNull() & ~bare.isin("", "nan", "none"), code).otherwise(F.left(ident, F.lit(8)))


def round_at(c: Column, places: int) -> Column:
    """Half up on the binary value, by the same arithmetic in every engine."""
    return F.floor(c * float(10**places) + 0.5) / float(10**places)


def stable_id(*parts: Column) -> Column:
    """An id that the same parts always give, so that recomputed rows keep theirs."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def html_escape(c: Column) -> Column:
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(safe))
    return c


def reply_json(c: Column) -> Column:
    """The JSON object of a model's reply: without fences and without prose around it; null without one."""
    return F.nullif(F.regexp_extract(F.regexp_replace(c, r"```(?:json)?", ""), r"(?s)(\{.*\})", 1), F.lit(""))


def tokens(c: Column, least: int = 2) -> Column:
    """Words in lower case of ``least`` or more letters, digits or underscores; null gives an empty list."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(rf"([\p{{L}}\p{{N}}_]{{{least},}})"), 1)
