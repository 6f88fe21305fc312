"""Accent folding, key sanitising and token tests as column expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def _folding_tables() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition leaves ASCII: one-to-one and one-to-many."""
    one_from, one_to, many = [], [], {}
    for code in range(128, sys.maxunicode + 1):
        char = chr(code)
        if 0xD800 <= code <= 0xDFFF or not unicodedata.decomposition(char):
            continue
        ascii_part = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")
        if len(ascii_part) == 1:
            one_from.append(char)
            one_to.append(ascii_part)
        elif ascii_part:
            many[char] = ascii_part
    return "".join(one_from), "".join(one_to), many


def fold_text(col: Column) -> Column:
    """Lower-case ASCII form of a text: Vietnamese d, then compatibility folding, then trim."""
    ascii_text = F.when(_is_ascii(col), col).otherwise(_with(col, _to_ascii))
    return F.lower(F.trim(ascii_text, F.lit(_ASCII_SPACES)))


def _to_ascii(col: Column) -> Column:
    one_from, one_to, many = _folding_tables()
    # The two ways the letter d with stroke reads after a wrong decoding, and the letter.
    text = F.replace(col, F.lit("Ä‘"), F.lit("d"))
    text = F.replace(text, F.lit("Ä\u0090"), F.lit("D"))
    text = F.translate(text, "đĐ" + one_from, "dD" + one_to)

    def drop_rest(t: Column) -> Column:
        # What is still outside ASCII is rare: expand ligatures and fractions, drop the rest.
        expanded = F.array_join(
            F.transform(F.split(t, ""), lambda c: F.coalesce(F.try_element_at(_literal_map(many), c), c)), ""
        )
        cleaned = F.regexp_replace(F.when(t.rlike(_any_of(many)), expanded).otherwise(t), r"[^\x00-\x7F]", "")
        return F.when(_is_ascii(t), t).otherwise(cleaned)

    return _with(text, drop_rest)


def _is_ascii(col: Column) -> Column:
    """One byte per character; far cheaper than looking at the characters."""
    return F.octet_length(col) == F.char_length(col)


def _with(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_ASCII_SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.map_from_arrays(F.lit(list(pairs)), F.lit(list(pairs.values())))


def _any_of(chars) -> str:
    """A character class, with neighbouring code points written as ranges."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def has_any(col: Column, tokens: tuple[str, ...]) -> Column:
    """True when one of the tokens occurs anywhere, also inside a longer word."""
    found = col.contains(tokens[0])
    for token in tokens[1:]:
        found = found | col.contains(token)
    return found


def key_part(col: Column) -> Column:
    """A value as one part of an object key; an empty result becomes ``unknown``."""
    stripped = F.regexp_replace(col, r"^\s+|\s+$", "")
    safe = F.regexp_replace(stripped, r"[^A-Za-z0-9_.=-]+", "_")
    safe = F.regexp_replace(safe, r"^_+|_+$", "")
    return F.when(safe == "", F.lit("unknown")).otherwise(safe)


def run_document_key(job: Column, run: Column, logical_date: Column) -> Column:
    """metadata/pipeline_runs/<job>[/<date>]/<run>.json; the date part is left out when unset."""
    day = F.when(
        logical_date.isNotNull() & (logical_date != ""), key_part(F.substring(logical_date, 1, 10))
    )
    return F.concat_ws(
        "/", F.lit("metadata"), F.lit("pipeline_runs"), key_part(job), day, F.concat(key_part(run), F.lit(".json"))
    )


def pad(col: Column, width: int) -> Column:
    return F.lpad(col.cast("string"), width, "0")
