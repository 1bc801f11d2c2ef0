"""Text rules that identity and matching share."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_key(name: Column) -> Column:
    """Capital letters and digits only."""
    return F.regexp_replace(F.upper(name), "[^A-Z0-9]", "")


def squeezed(name: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(name)), r"\s+", " ")


def digest(text: Column) -> Column:
    """Sixteen hexadecimal digits that identify a text."""
    return F.substring(F.sha1(text.cast("binary")), 1, 16)


def flag(text: Column, prefix: str) -> Column:
    """Whether a written flag begins with ``prefix``; null stays null."""
    return F.upper(text).startswith(prefix)


def leading_int(text: Column) -> Column:
    return F.regexp_extract(F.trim(text), r"^(\d+)", 1).try_cast("bigint")


def kind_of(text: Column, rules: list[tuple[str, str]], other: str = "unknown", *, prefix: bool = False) -> Column:
    """The kind of the first rule whose mark the text has (or begins with)."""
    upper, out = F.upper(text), F.lit(other)
    for mark, kind in reversed(rules):
        out = F.when(upper.startswith(mark) if prefix else upper.contains(mark), kind).otherwise(out)
    return out


def snake_case(header: str) -> str:
    """Column name of a file's header."""
    s = header.strip()
    for old, new in (("PSS/E", "psse"), ("p.u", "pu"), ("&", " and "), ("#", " number ")):
        s = s.replace(old, new)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s))
    return re.sub(r"[^A-Za-z0-9]+", "_", s).strip("_").lower()
