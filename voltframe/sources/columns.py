"""Declared columns of source files: all text is read as text, trimmed, emptied to null and cast; a bad value is an error."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import snake_case

TYPES = {"i": "bigint", "d": "double", "s": "string"}


class SourceError(ValueError):
    """A file that doesn't have the declared form."""


@dataclass(frozen=True)
class Field:
    header: str
    kind: str = "s"
    called: str | None = None

    @property
    def name(self) -> str:
        return self.called or snake_case(self.header)


def fields(*declared: str) -> tuple[Field, ...]:
    """``"MW:d"`` is a double with the header MW; without a mark it is text."""
    out = []
    for text in declared:
        header, mark, kind = text.rpartition(":")
        out.append(Field(header, kind) if mark and kind in TYPES else Field(text))
    return tuple(out)


def cast(text: Column, kind: str) -> Column:
    """Trimmed and cast, "" as null. Whole numbers may be written ``3.0``; other text in a number is an error."""
    clean = F.nullif(F.trim(text), F.lit(""))
    if kind == "s":
        return clean
    if kind == "d":
        return clean.cast("double")
    number = clean.try_cast("double")
    bad = F.raise_error(F.concat(F.lit("not a whole number: "), clean)).cast("bigint")
    whole = F.when(clean.rlike(r"^[+-]?\d+$"), clean.try_cast("bigint")).when(number == F.floor(number), number.cast("bigint"))
    return F.when(clean.isNotNull(), F.coalesce(whole, bad))


def typed(records: DataFrame, layout: list[tuple[str, str]], tokens: str, *keep: str) -> DataFrame:
    """Columns of an array of texts by place; a short array ends in nulls."""
    return records.select(*keep, *[cast(F.get(tokens, F.lit(i)), kind).alias(name) for i, (name, kind) in enumerate(layout)])
