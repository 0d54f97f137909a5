"""Clean forms of codes, ids, texts and grade labels as column expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The words that pandas reads as "no value", besides blanks.
NULL_WORDS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

#: Grammar of a clean code.
CODE = r"^(EI|EF|EM)[0-9]{2}[A-Z]{2,3}[0-9]{2,7}$"
#: White space, zero-width marks and the byte order mark: as a class of patterns, and one by one.
BLANK = r"[\s\x{00a0}\x{1680}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
BLANKS = " \t\n\v\f\r\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200E))) + "\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
#: A code that opens a text, in any of its spellings, perhaps in brackets.
OPENING_CODE = (
    r"(?i)^[^\p{L}\p{N}]*(E[IFM][\x{200b}\-.]?[0-9]{2}[\x{200b}\x{00a0} \-.]?[A-Z]{2,3}[\x{200b}\x{00a0} \-.]?[0-9]{2,7})"
    r"(?![\p{L}\p{N}])"
)


def strip(c: Column) -> Column:
    """The text without blanks and zero-width marks at both ends."""
    return F.btrim(c, F.lit(BLANKS))


def null_if_blank(c: Column) -> Column:
    """Null for blanks and for words that mean "no value"; other values as they are."""
    bare = strip(c)
    return F.when((bare != "") & ~bare.isin(*NULL_WORDS), c)


def clean_code(c: Column) -> Column:
    """The clean code, or null where the value has no clean form."""
    bare = F.upper(F.regexp_replace(c, "[^0-9A-Za-z]", ""))
    return F.when(c.rlike(CODE), c).when(bare.rlike(CODE), bare)


def id_bytes(c: Column) -> Column:
    """The id as 16 bytes, for keys that are shuffled; null where the value has no clean form.

    Blanks and words for "no value" have none. Most ids differ from the clean form in hyphens at
    most: those need no pattern.
    """
    bare = F.replace(c, F.lit("-"), F.lit(""))
    plain = F.when(F.length(bare) == 32, F.unhex(bare))
    digits = F.regexp_replace(F.lower(c), r"^[^0-9a-z]*(urn:)?(uuid:)?|[^0-9a-z]", "")
    return F.coalesce(plain, F.when(digits.rlike("^[0-9a-f]{32}$"), F.unhex(digits)))


def id_text(b: Column) -> Column:
    """The clean text of an id of 16 bytes."""
    h = F.lower(F.hex(b))
    part = lambda at, n: F.substring(h, at, n)
    return F.when(b.isNotNull(), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)))


def clean_id(c: Column) -> Column:
    """The clean id (8-4-4-4-12), or null where the value has no clean form."""
    return id_text(id_bytes(c))


def opening_code(text: Column) -> Column:
    """The clean code that opens the text, or the empty string."""
    return F.coalesce(clean_code(F.regexp_extract(text, OPENING_CODE, 1)), F.lit(""))


_ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñºª°"
_PLAIN = "aaaaaaeeeeiiiiooooouuuucnoao"


def fold(c: Column) -> Column:
    """Lower case without accents, composed or not."""
    return F.translate(F.regexp_replace(F.lower(c), r"\p{M}+", ""), _ACCENTED, _PLAIN)


def grade_years(c: Column) -> Column:
    """Number of school years that a grade label covers: an early-years band counts 1, null 0.

    Lists ("1º, 2º e 3º anos"), ranges ("6º–9º ano", "6º ao 9º") and single years are read in any
    style of the ordinal sign; a label without a number counts 1.
    """
    label = fold(null_if_blank(c))
    years = F.regexp_replace(label, r"\([^)]*\)", " ")
    first = F.regexp_extract(years, r"(\d+)", 1).try_cast("int")
    last = F.regexp_extract(years, r"(\d+)\D*$", 1).try_cast("int")
    is_range = years.rlike(r"\d+[oa]?\s*(?:[-–—]|a|ao|ate)\s*\d+")
    listed = F.size(F.array_distinct(F.regexp_extract_all(years, F.lit(r"(\d+)"), 1)))
    return (
        F.when(label.isNull(), 0)
        .when(label.rlike("bebe|crianca") | ~years.rlike(r"\d"), 1)
        .when(is_range & (last >= first), last - first + 1)
        .otherwise(listed)
        .cast("int")
    )
