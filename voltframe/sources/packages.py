"""Packages of files to typed tables, all members and all tables in one pass.

A scan reads each member once. Its name, or its header, says which layout it has; its rows are cast there and then, and travel as
VARIANT values with the name of their table, so that one job and one write partitioned by table serve all tables of a package. A
table's frame is a projection of its partition.
"""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import layouts, psse
from .columns import TYPES, Field, SourceError
from .files import decoded, header_of
from .workbook import sheet_rows

#: Rows that leave a member's reader at once.
BATCH = 5_000
#: A member that none of the rules fits holds no table, and is listed with this.
UNKNOWN = "unknown"


def value(text: str | None, kind: str, label: str) -> str | int | float | None:
    """Trimmed, "" as null; whole numbers may be written ``3.0``."""
    text = text.strip() if text else ""
    if not text or kind == "s":
        return text or None
    try:
        if kind == "i":
            return int(text) if re.fullmatch(r"[+-]?\d+", text) else _whole(float(text))
        return float(text)
    except ValueError:
        raise SourceError(f"{label}: {text!r} is no {'whole ' if kind == 'i' else ''}number") from None


def _whole(x: float) -> int:
    if x != int(x):
        raise ValueError
    return int(x)


def table_of(content: bytes, tables: dict[str, tuple[Field, ...]], path: str) -> str:
    """The table whose header a member carries; of equal headers the one that the member's name tells."""
    header = header_of(content)
    found = [t for t, layout in tables.items() if header == tuple(f.header for f in layout)]
    if not found:
        raise SourceError(f"{path}: no table has the header {list(header)[:6]}")
    return next((t for t in found if len(found) > 1 and layouts.BY_STEM.get(t, "\0") in path), found[0])


def kind_of(path: str, rules: list[tuple[str, str]]) -> str:
    return next((kind for pattern, kind in rules if re.search(pattern, path)), UNKNOWN)


def read(path: str, content: bytes, family: str) -> Iterator[tuple[str, dict]]:
    """(table, row) of a member: none of one that isn't known, and of an empty file of a known one."""
    rules, tables, _ = layouts.FAMILIES[family]
    kind = kind_of(path, rules)
    if kind == "raw":
        for section, records in psse.sections(decoded(content)):
            shape = psse.shape(section)
            for tokens, note in records:
                row = {n: value(t, k, f"{path}: {section}") for (n, k), t in zip(shape, [*tokens, *[None] * (len(shape) - len(tokens))], strict=False)}
                yield f"psse_{section}", row | {"header_comment" if section == "case" else "comment": note if section == "case" else psse.inner(note)}
    elif kind == "sheets":
        for sheet, (table, layout) in layouts.CRR_SHEETS.items():
            cells = sheet_rows(content, sheet)
            yield from _rows(table, layout, iter(cells), f"{path} [{sheet}]")
    elif kind != UNKNOWN:
        table = table_of(content, tables, path) if kind == "header" else kind
        text = decoded(content)
        bars = table == "crr_outages"
        mark = "|" if bars and "|" in text.partition("\n")[0] else ","
        yield from _rows(table, layouts.TABLES[table], csv.reader(io.StringIO(text, newline=""), delimiter=mark, quoting=csv.QUOTE_NONE if bars else csv.QUOTE_MINIMAL), path)


def _rows(table: str, layout: tuple[Field, ...], lines: Iterator[list], label: str) -> Iterator[tuple[str, dict]]:
    header = [(x or "").strip() for x in next(lines, [])]
    while header and not header[-1] and len(header) > len(layout):
        header.pop()
    if header != [f.header for f in layout]:
        raise SourceError(f"{label}: the header of {table} is {header[:4]}..., not the declared one")
    for line in lines:
        if any(x and x.strip() for x in line):
            yield table, {f.name: value(x, f.kind, f"{label}: {table}.{f.name}") for f, x in zip(layout, [*line, *[None] * (len(layout) - len(line))], strict=False)}


def identity(path: str, family: str) -> dict[str, str | int | None]:
    """What a member's name says of its rows; dates as ISO texts."""
    out: dict[str, str | int | None] = {}
    for name, kind, pattern in layouts.FAMILIES[family][2]:
        found = re.search(pattern, path.rsplit("/", 1)[-1])
        text = next((g for g in found.groups() if g), None) if found else None
        out[name] = int(text) if text and kind == "bigint" else _date(text) if text and kind == "date" else text.lower() if text and name == "auction" else text
    return out


def _date(text: str) -> str:
    for form in ("%m%d%Y", "%Y.%b", "%b_%Y", "%d-%b-%y"):
        try:
            return datetime.strptime(text.title() if "%b" in form else text, form).date().isoformat()
        except ValueError:
            continue
    raise SourceError(f"{text!r} is no date")


def parsed(members: DataFrame, family: str) -> DataFrame:
    """emil_id, blob_sha256, member_sha256, member_path, table, ordinal, row (VARIANT) of every row of every member.

    Members without rows are listed once with a null row: under their table if they have one, else under ``unknown``. A member that breaks its layout fails the job.
    """
    keep = ["emil_id", "blob_sha256", "member_sha256", "member_path"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for m in pdf.itertuples(index=False):
                own, some, any_row = identity(m.member_path, family), [], False
                for n, (table, row) in enumerate(read(m.member_path, m.content, family)):
                    any_row = True
                    some.append((table, n, json.dumps(own | row, allow_nan=False)))
                    if len(some) == BATCH:
                        yield frame(m, some)
                        some = []
                if not any_row:
                    some = [(UNKNOWN if (kind := kind_of(m.member_path, layouts.FAMILIES[family][0])) == UNKNOWN else kind, 0, None)]
                if some:
                    yield frame(m, some)

    def frame(m, some: list[tuple]) -> pd.DataFrame:
        table, n, row = zip(*some, strict=True)
        return pd.DataFrame({c: getattr(m, c) for c in keep} | {"table": table, "ordinal": n, "row": row})

    rows = members.select(*keep, "content").mapInPandas(run, ", ".join(f"{c} string" for c in keep) + ", table string, ordinal bigint, row string")
    return rows.withColumn("row", F.parse_json("row"))


def fields_of(table: str, family: str) -> list[tuple[str, str]]:
    """(column, type) of a table of a family: the members' identity first; a column that the file has itself isn't repeated."""
    if table.startswith("psse_"):
        section = table.removeprefix("psse_")
        own = [(n, TYPES[k]) for n, k in psse.shape(section)] + [("header_comment" if section == "case" else "comment", "string")]
    else:
        own = [(f.name, TYPES[f.kind]) for f in layouts.TABLES[table]]
    taken = {n for n, _ in own}
    return [(n, k) for n, k, _ in layouts.FAMILIES[family][2] if n not in taken] + own


def typed(rows: DataFrame, table: str, family: str) -> DataFrame:
    """A table's frame of what ``parsed`` gave (or what was written of it), with row_number, the row's place in its member."""
    some = rows.where((F.col("table") == table) & F.col("row").isNotNull())
    return some.select("emil_id", "blob_sha256", "member_sha256", "member_path", F.col("ordinal").alias("row_number"), *[F.variant_get("row", f"$['{n}']", k).alias(n) for n, k in fields_of(table, family)])
