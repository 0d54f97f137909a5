"""Fragments of ANSI SQL for the check queries: clean forms as the column expressions define them."""

from __future__ import annotations

from alinea.functions.clean import NULL_WORDS

_WORDS = ", ".join(f"'{w}'" for w in NULL_WORDS)


def code(c: str) -> str:
    bare = f"upper(regexp_replace({c}, '[^0-9A-Za-z]', '', 'g'))"
    return f"(CASE WHEN regexp_matches({bare}, '^(EI|EF|EM)[0-9]{{2}}[A-Z]{{2,3}}[0-9]{{2,7}}$') THEN {bare} END)"


def uid(c: str) -> str:
    bare = f"regexp_replace(regexp_replace(lower({c}), '^[^0-9a-z]*(urn:)?(uuid:)?', ''), '[^0-9a-z]', '', 'g')"
    return f"(CASE WHEN regexp_matches({bare}, '^[0-9a-f]{{32}}$') THEN regexp_replace({bare}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') END)"


def present(c: str) -> str:
    """The value, or null for blanks and words that mean "no value"."""
    bare = f"trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))"
    return f"(CASE WHEN {bare} <> '' AND {bare} NOT IN ({_WORDS}) THEN {c} END)"
