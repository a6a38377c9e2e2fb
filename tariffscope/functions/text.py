"""Text cleansing: blanks, money, code page and quote repair."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A quote with an ordinary character on both sides breaks the CSV rules.
STRAY_QUOTE = r'(?<=[^,"\r\n])"(?=[^,"\r\n])'

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def blank_to_null(text: Column) -> Column:
    """Trim, and turn an empty text into NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def money(text: Column) -> Column:
    """``"$1,200.50"`` -> 1200.5; anything that is not a plain number -> NULL."""
    bare = F.trim(F.replace(F.replace(text, F.lit("$"), F.lit("")), F.lit(","), F.lit("")))
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def contains_ignoring_case(text: Column, part: Column) -> Column:
    return F.contains(F.lower(text), F.lower(part))


def pipe_list(text: Column) -> Column:
    """``"a | b|"`` -> [a, b]."""
    return F.filter(F.transform(F.split(text, r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def ascii_words(pattern: str) -> str:
    """The pattern with \\b taken as the border of a word of ASCII signs, so accented letters count as separators."""
    return re.sub(r"\\b(\w+)\\b", r"(?<![0-9A-Za-z_])\1(?![0-9A-Za-z_])", pattern)


def _code_page_table() -> tuple[str, str]:
    """Where Windows-1252 differs from ISO-8859-1: bytes 0x80-0x9F, undefined ones to U+FFFD."""
    bytes_ = [bytes([b]) for b in range(0x80, 0xA0)]
    return "".join(b.decode("latin-1") for b in bytes_), "".join(b.decode("cp1252", "replace") for b in bytes_)


def is_bad_utf8(line: Column) -> Column:
    return ~F.is_valid_utf8(line)


def repair_encoding(line: Column) -> Column:
    """Keep valid UTF-8 lines; read any other line as Windows-1252."""
    latin, windows = _code_page_table()
    decoded = F.decode(line.cast("binary"), "ISO-8859-1")
    return F.when(F.is_valid_utf8(line), line).otherwise(F.translate(decoded, latin, windows))


def has_stray_quote(line: Column) -> Column:
    return F.contains(line, F.lit('"')) & line.rlike(STRAY_QUOTE)


def repair_quotes(line: Column) -> Column:
    """Double every stray quote so the value survives parsing."""
    return F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, STRAY_QUOTE, '""')).otherwise(line)
