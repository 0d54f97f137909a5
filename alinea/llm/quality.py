"""Measures of a text that tell natural prose from lists, tables and junk."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable
from functools import cache, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alinea.functions.clean import BLANK

#: Published thresholds, by the names of their reasons. From Rae et al. 2021, table A1 (words to
#: function words and duplicate lines), Raffel et al. 2020 (sentences, curly brackets) and Penedo et
#: al. 2024 (line ends, short lines, characters in duplicate lines). A text fails a rule beyond them.
PUBLISHED = {
    "fewest words": 50, "most words": 100_000, "shortest mean word": 3.0, "longest mean word": 10.0, "symbols to words": 0.1, "bullet lines": 0.9, "ellipsis lines": 0.3,
    "words with letters": 0.8, "different common words": 2, "sentences": 3, "line ends": 0.12, "short lines": 0.67, "duplicate lines": 0.3, "duplicate line characters": 0.1,
}
#: Thresholds of our own: three rules beside the published ones, whose lists of words and bullets are
#: short, and what tells the kind of a text that failed a rule.
THRESHOLDS = {
    "common words": 0.05,
    "numbered lines": 0.5,
    "repetition": 0.22,  # different sequences of four words among all
    "symbol_share": 0.25,  # signs that are no letters, digits, blanks or usual punctuation
    "symbol_share_in_cells": 0.35,  # the same where rules and bars of tables count as signs
    "single_letter_share": 0.6,  # words of one character
    "single_letter_share_in_cells": 0.85,
    "long_token_share": 0.5,  # characters in unbroken runs of 40 and more
    "run_share": 0.3,  # characters in runs of one or two repeated characters
    "garbled_share": 0.04,  # signs that only decoding errors leave, per character
    "majority": 0.5,
}

_CODE_ITEM = r"(?<![A-Za-z0-9])E[IFM][0-9]{2}[A-Z]{2,3}[0-9]{2,7}(?![A-Za-z0-9])"
_BULLET = r"^(?:[-*•–·‣▪◦]|\d{1,3}[.)]|\(?[A-Za-z][.)]|[ivx]{1,4}[.)]|\[[ xX]?\])\s"
_PLAIN_TAG = r"</?(?:p|P|br|BR|b|B|i|I|u|em|strong|span|h[1-6])(?:\s[^<>]*)?/?>"
#: A line break inside a sentence: the next line goes on in lower case and is no item or named field.
_WRAP = r"\n(?<=[\p{L}\p{N},’'\-]\n)(?=\p{Ll}(?![).])[^:;|\t\n]{0,60}(?:[\n.,;!?]|.{60}|$))"
_TRAILING = r"[ \t\x{a0}]+\n"
#: Signs of programs, of drawing and of decoding errors; letters, digits and usual punctuation aren't among them.
_SYMBOLS = "#$&+<=>@\\^_`{|}~¢£¤¥¦§¨©¬\xad®¯±²³´µ¶¸¹»«¼½¾×÷"
_SYMBOL_RANGES = ((0x80, 0x9F), (0x2030, 0x2038), (0x2190, 0x2BFF), (0xE000, 0xF8FF), (0xFFFD, 0xFFFD))
_BLANKS = "\t\n\v\f\r \x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_BULLETS = "-*+•–·‣▪◦●"
_STOPS = ".!?…"
_CLOSING = _STOPS + "\"'”’»)"
#: One bit per kind of sign that is counted.
_LETTER, _BLANK, _SYMBOL, _STOP, _CLOSE, _BULLET_SIGN, _ERROR, _WORD = (1 << k for k in range(8))
#: Characters of texts that are measured in one go.
_CHUNK = 1 << 20
#: An odd factor of 64 bits and its inverse: powers of them make hashes of any span from running sums.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


@cache
def _kinds() -> np.ndarray:
    """The kinds of each code point; once per Python worker."""
    table = np.zeros(0x110000, dtype=np.uint8)

    def mark(points: Iterable[int], kind: int) -> None:
        table[list(points)] |= kind

    mark((c for c in range(0x30000) if chr(c).isalpha()), _LETTER)
    mark((c for c in range(0x30000) if chr(c).isalnum() or unicodedata.category(chr(c))[0] == "M"), _WORD)
    mark([*map(ord, _SYMBOLS), *(c for low, high in _SYMBOL_RANGES for c in range(low, high + 1))], _SYMBOL)
    mark(map(ord, _BLANKS), _BLANK)
    mark([0xFFFD, 0xA4, 0xA7, *range(0x80, 0xA0)], _ERROR)
    for signs, kind in ((_STOPS, _STOP), (_CLOSING, _CLOSE), (_BULLETS, _BULLET_SIGN)):
        mark(map(ord, signs), kind)
    return table


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts behind each other as code points, each followed by a line break, and where each begins."""
    cp = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return cp, np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]]).astype(np.int64)


@lru_cache(2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(size, _FACTOR, dtype=np.uint64)), np.cumprod(np.full(size, _INVERSE, dtype=np.uint64))


def _span_hashes(cp: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """64-bit hashes of spans first..last; equal spans have equal hashes wherever they lie."""
    powers, inverse = _powers(1 << (len(cp) - 1).bit_length())
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(cp * powers[: len(cp)])])

        def hashes(first: np.ndarray, last: np.ndarray) -> np.ndarray:
            return (sums[last + 1] - sums[first]) * inverse[first] + (last - first).astype(np.uint64) * np.uint64(_FACTOR)

    return hashes


def _repeats(of: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True for all but one of the entries of one text that have the same hash."""
    key = h + (of.astype(np.uint64) + np.uint64(1)) * np.uint64(_INVERSE)
    order = np.argsort(key)
    key = key[order]
    out = np.zeros(len(h), dtype=bool)
    out[order[1:]] = key[1:] == key[:-1]
    return out


def _sign_counts(cp: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """Symbols, decoding errors, runs, and what is counted over tokens between blanks."""
    kind = _kinds()[cp]
    blank = kind & _BLANK != 0
    per_text = lambda flag: np.add.reduceat(flag.astype(np.int64), starts)
    of = lambda at: np.searchsorted(starts, at, side="right") - 1
    add = lambda at, n: np.bincount(of(at), weights=n, minlength=len(starts)).astype(np.int64)

    after = np.append(cp[1:], 10)
    lone = (cp == 0xC3) & (((after >= 97) & (after <= 122)) | np.append(blank[1:], True))
    errors = (kind & _ERROR != 0) | lone

    # Runs of one character: four or more, of full stops eight or more.
    begin = np.concatenate([[0], np.flatnonzero(cp[1:] != cp[:-1]) + 1])
    size = np.diff(np.append(begin, len(cp)))
    dots = cp[begin] == 46
    run = ((size >= 4) & ~dots & ~blank[begin]) | ((size >= 8) & dots)
    in_runs = add(begin[run], size[run])
    # Two letters that come three times or more.
    same = np.concatenate([[False], cp[2:] == cp[:-2], [False]])
    edge = np.flatnonzero(same[1:] != same[:-1])
    first, length = edge[::2], edge[1::2] - edge[::2]
    pair = (length >= 4) & (kind[first] & kind[np.minimum(first + 1, len(cp) - 1)] & _LETTER != 0) & (cp[first] != cp[np.minimum(first + 1, len(cp) - 1)])
    in_runs = in_runs + add(first[pair], length[pair] + 2)

    head = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    tail = np.flatnonzero(~blank & np.append(blank[1:], True))
    width = tail - head + 1
    framing = np.concatenate([[0], np.cumsum((cp == 60) | (cp == 124))])
    letters = np.concatenate([[0], np.cumsum(kind & _LETTER != 0)])
    long = (width >= 40) & (framing[tail + 1] == framing[head])
    stop = kind & _STOP != 0
    return {
        "n_symbols": per_text(kind & _SYMBOL != 0), "n_errors": per_text(errors), "n_in_runs": in_runs,
        "n_tokens": add(head, np.ones(len(head))), "n_token_chars": add(head, width), "n_single": add(head, (width == 1).astype(float)), "n_in_long": add(head[long], width[long]),
        "n_with_letters": add(head, (letters[tail + 1] > letters[head]).astype(float)),
        "n_marks": per_text((cp == 35) | (cp == 0x2026)) + add(begin[dots], size[dots] // 3), "n_curly": per_text(cp == 123),
        "n_sentences": per_text(stop & np.append(blank[1:], True) & ~np.append(stop[1:], False)),
    }


def _line_counts(cp: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """What is counted over lines that aren't blank, without their outer blanks."""
    kind = _kinds()[cp]
    blank = kind & _BLANK != 0
    hashes = _span_hashes(cp)
    inked = np.flatnonzero(~blank)
    line = np.cumsum((cp == 10) | (cp == 13))[inked]
    change = np.flatnonzero(np.diff(line, prepend=-1))
    first, last = inked[change], inked[np.append(change[1:], len(inked)) - 1]
    of = np.searchsorted(starts, first, side="right") - 1
    add = lambda flag: np.bincount(of, weights=flag.astype(float), minlength=len(starts)).astype(np.int64)
    size = last - first + 1
    repeated = _repeats(of, hashes(first, last))
    dotted = (cp[last] == 46) & (cp[np.maximum(last - 1, 0)] == 46) & (cp[np.maximum(last - 2, 0)] == 46)
    # Named fields: the line's first colon comes early and is followed by a blank.
    colons = np.flatnonzero(cp == 58)
    at = np.append(colons, len(cp))[np.searchsorted(colons, first)]
    field = (at <= np.minimum(first + 25, last - 1)) & blank[np.minimum(at + 1, len(cp) - 1)] & (at > first)
    names = _repeats(of[field], hashes(first[field], at[field] - 1))
    # Numbers of items: up to three digits before a full stop or a bracket.
    digit = (cp >= 48) & (cp <= 57)
    more = lambda k: np.minimum(first + k, len(cp) - 1)
    digits = digit[first].astype(int) * (1 + digit[more(1)] * (1 + digit[more(2)]))
    numbered = (digits > 0) & np.isin(cp[np.minimum(first + digits, len(cp) - 1)], (41, 46))
    n_fields = np.bincount(of[field], minlength=len(starts))
    return {
        "n_lines": add(np.ones(len(first))), "n_bullets": add((kind[first] & _BULLET_SIGN != 0) & blank[np.minimum(first + 1, len(cp) - 1)]),
        "n_punct_ends": add(kind[last] & _CLOSE != 0), "n_ellipses": add(dotted | (cp[last] == 0x2026)), "n_numbered": add(numbered), "n_short_lines": add(size < 30),
        "n_repeated_lines": add(repeated), "n_repeated_chars": add(np.where(repeated, size, 0)),
        "n_fields": n_fields, "n_field_names": n_fields - np.bincount(of[field], weights=names, minlength=len(starts)).astype(np.int64),
    }


def _word_counts(cp: np.ndarray, starts: np.ndarray, common: np.ndarray) -> dict[str, np.ndarray]:
    """What is counted over words, runs of letters, digits and marks, of texts in lower case."""
    inside = _kinds()[cp] & _WORD != 0
    head = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
    tail = np.flatnonzero(inside & np.append(~inside[1:], True))
    of = np.searchsorted(starts, head, side="right") - 1
    add = lambda flag: np.bincount(of, weights=flag.astype(float), minlength=len(starts)).astype(np.int64)
    h = _span_hashes(cp)(head, tail)
    known = np.isin(h, common)
    four = h.copy()  # the word and up to three behind it in the same text
    with np.errstate(over="ignore"):
        for k in (1, 2, 3):
            same = np.append(of[k:], np.full(min(k, len(of)), -1)) == of
            four = four * np.uint64(_FACTOR) + np.where(same, np.append(h[k:], np.zeros(min(k, len(h)), np.uint64)), np.uint64(k))
    words = add(np.ones(len(head)))
    return {
        "n_words": words, "n_word_chars": add(tail - head + 1), "n_common": add(known), "n_common_kinds": add(known & ~_repeats(of, h)), "n_fours": words - add(_repeats(of, four)),
    }


def _hashes(words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    cp, starts = _code_points(words)
    return _span_hashes(cp)(starts, np.append(starts[1:], len(cp)) - 2)


_COUNTS = [
    "n_symbols", "n_errors", "n_in_runs", "n_tokens", "n_token_chars", "n_single", "n_in_long", "n_with_letters", "n_marks", "n_curly", "n_sentences",
    "n_lines", "n_bullets", "n_punct_ends", "n_ellipses", "n_numbered", "n_short_lines", "n_repeated_lines", "n_repeated_chars", "n_fields", "n_field_names",
    "n_words", "n_word_chars", "n_common", "n_common_kinds", "n_fours",
]


def text_counts(text: Column, common_words: list[str]) -> Column:
    """The counts of a text as a struct: whole Arrow batches as arrays of code points, in chunks of bounded size."""
    common = _hashes(sorted({w.lower() for w in common_words if w}))

    def measure(texts: list[str]) -> pd.DataFrame:
        own, low = _code_points(texts), _code_points([t.lower() for t in texts])
        return pd.DataFrame(_sign_counts(*own) | _line_counts(*own) | _word_counts(*low, common))

    @F.pandas_udf(T.StructType([T.StructField(n, T.LongType()) for n in _COUNTS]))
    def counts(batch: pd.Series) -> pd.DataFrame:
        out, part, chars = [], [], 0
        for t in batch:
            part.append(t or "")
            chars += len(part[-1])
            if chars >= _CHUNK:
                out.append(measure(part))
                part, chars = [], 0
        if part:
            out.append(measure(part))
        return pd.concat(out, ignore_index=True)[_COUNTS] if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in _COUNTS})

    return counts(text)


def _count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def _times(c: Column, part: str) -> Column:
    """How often a plain string occurs."""
    return F.floor((F.length(c) - F.length(F.replace(c, F.lit(part), F.lit("")))) / len(part)).cast("int")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that later columns use many times but that is worked out once per row.

    A generator of one row keeps the optimizer from copying the expression into each of its uses.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def line_counts(line: Column) -> Column:
    """What the classes of lines are told by, from plain string searches where these do."""
    few = lambda part, sign: F.when(F.contains(line, F.lit(sign)), _times(line, part)).otherwise(0)
    logged = line.rlike(r"^(?:(?:[0-9a-fA-F]{2}\s){8}|\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d\S*\s+\p{Lu}{4,})")
    program = (F.contains(line, F.lit("function")) & line.rlike(r"function\s*\(")) | F.contains(line, F.lit("<script")) | F.contains(line, F.lit("</script"))
    return F.struct(
        (_times(line, " ") + 1).alias("words"), few(";", ";").alias("semi"), few("; ", ";").alias("semi_blank"), few(",", ",").alias("comma"), few(", ", ",").alias("comma_blank"),
        F.right(line, F.lit(2)).rlike(r"[.!?…]['\"”)]?$").alias("stops"), line.rlike(_BULLET).alias("bullet"), line.rlike(r"[.!?…]\s+\p{L}").alias("inner_stop"), line.rlike(r"^\p{Ll}").alias("lower"),
        (logged | program).alias("machine"),
    )


def line_class(line: Column, f: Column) -> Column:
    """table, record (a named field), item, short or prose: what one trimmed line looks like."""
    words, seps = f["words"], f["semi_blank"] + f["comma_blank"]
    tag = (F.contains(line, F.lit("<t")) | F.contains(line, F.lit("<T")) | F.contains(line, F.lit("</t"))) & line.rlike(r"(?i)</?t(?:able|r|d|h|body|head)\b")
    quoted = line.startswith('"') & F.contains(line, F.lit('","'))
    columns = F.contains(line, F.lit("\t")) | line.startswith("|") | line.startswith("+--") | line.startswith("+==") | F.contains(line, F.lit("   "))
    numeric = line.rlike(r"^[\s\d.,%+\-/|]*$") & (words >= 3)
    bare_semi = (f["semi"] >= 2) & (f["semi_blank"] == 0)
    bare_comma = (f["comma"] >= 2) & (f["comma_blank"] == 0) & ~line.rlike(r"\p{L}{3,} \p{L}{2,} \p{L}{2,}")
    codes = line.rlike(r"^\(?E[IFM]\d\d") & (_count(line, _CODE_ITEM) == _count(line, r"[^\s,;.()]+"))
    leader = F.contains(line, F.lit("....")) & line.rlike(r"[.·_]{4,}\s*\d+$")
    short_parts = ((seps >= 3) & (words <= 6 * (seps + 1)) & ~f["stops"]) | ((seps >= 5) & (words <= 4 * (seps + 1)))
    row_of_items = ~f["inner_stop"] & (short_parts | ((f["semi_blank"] >= 3) & (words <= 10 * (f["semi_blank"] + 1))))
    return (
        F.when(columns | tag | quoted | bare_semi | bare_comma | numeric, "table")
        .when(codes | leader, "item")
        .when((words <= 14) & F.contains(line, F.lit(": ")) & line.rlike(r"^[\p{L}_][\p{L}\p{N}_\- ]{0,24}: \S"), "record")
        .when(f["bullet"] & (words <= 18), "item")
        .when(row_of_items, "item")
        .when((words <= 11) & ~f["stops"] & ~line.endswith(":") & ~f["inner_stop"], "short")
        .otherwise("prose")
    )


def _share(n: Column | str, of: Column | str) -> Column:
    n, of = (F.col(c) if isinstance(c, str) else c for c in (n, of))
    return F.when(of > 0, n / of).otherwise(0.0)


def failed_rules() -> dict[str, Column]:
    """Whether a text fails each published rule or one of our three, over the columns of ``text_counts``."""
    t, own = PUBLISHED, THRESHOLDS
    mean = _share("n_token_chars", "n_tokens")
    return {
        "few words": F.col("n_tokens") < t["fewest words"], "many words": F.col("n_tokens") > t["most words"],
        "short mean word": mean < t["shortest mean word"], "long mean word": mean > t["longest mean word"],
        "symbols to words": _share("n_marks", "n_tokens") > t["symbols to words"],
        "bullet lines": _share("n_bullets", "n_lines") > t["bullet lines"], "ellipsis lines": _share("n_ellipses", "n_lines") > t["ellipsis lines"],
        "words without letters": _share("n_with_letters", "n_tokens") < t["words with letters"],
        "few common words": F.col("n_common_kinds") < t["different common words"],
        "few sentences": F.col("n_sentences") < t["sentences"], "curly bracket": F.col("n_curly") > 0,
        "open line ends": _share("n_punct_ends", "n_lines") <= t["line ends"], "short lines": _share("n_short_lines", "n_lines") >= t["short lines"],
        "duplicate lines": (_share("n_repeated_lines", "n_lines") > t["duplicate lines"]) | (_share("n_repeated_chars", "n_chars") >= t["duplicate line characters"]),
        "common words": _share("n_common", "n_words") < own["common words"], "numbered lines": _share("n_numbered", "n_lines") > own["numbered lines"], "repetition": _share("n_fours", "n_words") < own["repetition"],
    }


def line_shapes(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One row per text that failed a rule (``failed``): the columns ``keep``, and its lines' characters by class.

    Lines are exploded, told apart in the JVM and summed per text before the shuffle, since all lines
    of a text come from one row. Texts that failed nothing pass through without lines. Rows of one
    doc_id count as one text.
    """
    t = F.replace(F.col("text"), F.lit("\r\n"), F.lit("\n"))
    t = F.replace(F.when(F.contains(t, F.lit("<")), F.regexp_replace(t, _PLAIN_TAG, "\n")).otherwise(t), F.lit("\r"), F.lit("\n"))
    t = F.when(F.contains(t, F.lit("\n")), F.regexp_replace(F.regexp_replace(t, _TRAILING, "\n"), _WRAP, " ")).otherwise(t)
    lines = docs.select("doc_id", F.struct(*keep).alias("keep"), F.explode_outer(F.when(F.col("failed"), F.split(t, "\n"))).alias("raw"))
    lines = _once(lines, "line", F.btrim("raw", F.lit(_BLANKS + "\u200b\ufeff"))).drop("raw")
    lines = _once(lines, "f", line_counts(F.col("line")))
    lines = _once(lines, "class", line_class(F.col("line"), F.col("f"))).withColumn("n", F.length("line").cast("long"))
    of = lambda c: F.sum(F.when(F.col("class") == c, F.col("n")).otherwise(0))
    some = F.col("line") != ""
    return lines.groupBy("doc_id").agg(
        F.first("keep").alias("keep"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_line_chars"),
        of("table").alias("table_chars"), of("record").alias("record_chars"), of("item").alias("item_chars"), of("short").alias("short_chars"), of("prose").alias("prose_chars"),
        F.count_if(some & (F.col("class") == "short")).alias("n_short"), F.count_if(some & (F.col("class") == "short") & F.col("f.lower")).alias("n_short_lower"), F.count_if(some & F.col("f.stops")).alias("n_stops"), F.count_if(some & F.col("f.machine")).alias("n_machine"),
    ).select("doc_id", "keep.*", "n_line_chars", "table_chars", "record_chars", "item_chars", "short_chars", "prose_chars", "n_short", "n_short_lower", "n_stops", "n_machine")


def kind_of(measures: DataFrame) -> DataFrame:
    """``kind`` by what holds most of the characters, for texts that failed a published rule; prose for others.

    Any sign of junk makes junk; else the class that holds most of the characters: table, list or
    prose. Named fields whose names repeat are records of a table, others entries of a list; short
    lines without closing punctuation are entries of a list unless they go on in lower case, as
    wrapped prose does.
    """
    t = THRESHOLDS
    all_chars = F.col("n_line_chars")
    prose_like = (F.col("prose_chars") + F.col("short_chars")) > t["majority"] * all_chars
    framed = (F.col("table_chars") + F.col("item_chars")) > t["majority"] * all_chars
    symbols, singles = _share("n_symbols", "n_chars"), _share("n_single", "n_tokens")
    common, distinct = _share("n_common", "n_words"), _share("n_fours", "n_words")
    junk = [
        (symbols > t["symbol_share_in_cells"]) | ((symbols > t["symbol_share"]) & ~framed),
        (F.col("n_words") >= 8) & ((singles > t["single_letter_share_in_cells"]) | ((singles > t["single_letter_share"]) & ~framed)),
        (_share("n_in_long", "n_chars") > t["long_token_share"]) & ~framed,
        (_share("n_in_runs", "n_chars") > t["run_share"]) & ~framed,
        _share("n_errors", "n_chars") > t["garbled_share"],
        F.col("n_machine") > t["majority"] * F.col("n_lines"),
        (distinct < t["repetition"]) & (F.col("n_words") >= 24) & (F.col("table_chars") + F.col("record_chars") <= t["majority"] * all_chars),
        (common < t["common words"]) & (F.col("n_words") >= 25) & prose_like & (F.col("n_stops") + F.col("prose_chars") > F.col("short_chars")),
    ]
    repeated_fields = F.col("n_field_names") * 2 <= F.col("n_fields")
    wrapped = F.col("n_short_lower") * 2 > F.col("n_short")
    table_chars = F.col("table_chars") + F.when(repeated_fields, F.col("record_chars")).otherwise(0)
    list_chars = F.col("item_chars") + F.when(repeated_fields, 0).otherwise(F.col("record_chars")) + F.when(wrapped & (F.col("prose_chars") > 0), 0).otherwise(F.col("short_chars"))
    is_junk = F.exists(F.array(*junk), lambda x: x)
    kind = F.when(F.size("reasons") == 0, "prose").when(is_junk, "junk").when(table_chars > t["majority"] * all_chars, "table").when(list_chars > t["majority"] * all_chars, "list").otherwise("prose")
    return measures.withColumn("kind", kind)


def quality(docs: DataFrame, doc_id: str, text: str, common_words: DataFrame) -> DataFrame:
    """Measures, ``reasons`` and ``kind`` (prose, list, table, junk) of every text that isn't null or blank.

    One pass over the texts. Their statistics are worked out on arrays of code points, then the
    published rules are applied (``PUBLISHED``): each that fails adds its name to ``reasons``, and a
    text that fails none is prose. Rules of that kind also fail short or unusual prose, so an exact
    check follows on the texts that failed: their lines' shapes tell the kind (``kind_of``).

    ``common_words`` is a small table (lang, word); more than 10,000 words raise an error. Null and
    blank texts give no row; an empty table gives no rows; other columns of ``docs`` are left out.
    """
    words = [r["word"] for r in common_words.select("word").distinct().limit(10_001).collect() if r["word"]]
    if len(words) > 10_000:
        raise ValueError("the table of common words is too large")
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").rlike(f"[^{BLANK[1:-1]}]"))
    own = own.withColumn("s", text_counts(F.col("text"), words)).select("doc_id", "text", "s.*", F.length("text").alias("n_chars"))
    failed = F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in failed_rules().items())), lambda x: x.isNotNull())
    own = _once(own, "reasons", failed).withColumn("failed", F.size("reasons") > 0)
    return kind_of(line_shapes(own, ["n_chars", "reasons", *_COUNTS]))

