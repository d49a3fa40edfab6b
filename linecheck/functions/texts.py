"""Identifiers and report texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linecheck import schemas as S


def without_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def model_key(mcid: Column) -> Column:
    """The part of a model name before the first ``#``, without spaces."""
    return without_spaces(F.substring_index(mcid, "#", 1))


def suffix(path: Column) -> Column:
    """The text after the last dot of a path."""
    return F.regexp_replace(path, r".*\.", "")


def joined(parts: list[Column], delimiter: str = "_") -> Column:
    return F.concat_ws(delimiter, *[part.cast("string") for part in parts])


def fixed_decimals(number: Column, decimals: int = 2) -> Column:
    """Number text rounded half up, as the Java formatter writes it."""
    return F.format_string(f"%.{decimals}f", number)


def line_text(line: Column, lead_offset: Column, pad_offset: Column, decimals: int = 2) -> Column:
    pattern = S.LINE_TEXT.format(offset=f"%.{decimals}f")
    return F.format_string(pattern, line, lead_offset, pad_offset)


def missing_lines_text(found: Column, wanted: Column) -> Column:
    return F.format_string(S.MISSING_TEXT, found, wanted)


def _choice(code: Column, texts: dict[int, str]) -> Column:
    other = texts[S.QUALIFIED]
    chosen = None
    for value, text in texts.items():
        if value != S.QUALIFIED:
            chosen = (F if chosen is None else chosen).when(code == value, text)
    return chosen.otherwise(other)


def result_text(code: Column) -> Column:
    return _choice(code, S.RESULT_TEXT)


def code_text(code: Column) -> Column:
    return _choice(code, S.CODE_TEXT)
