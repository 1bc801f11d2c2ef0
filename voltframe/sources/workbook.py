"""Sheets of XLSX workbooks by the standard library, and the limits workbook, wide to long."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import local_instant
from .columns import SourceError

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def sheet_rows(content: bytes, sheet: str) -> list[list[str | None]]:
    """All cells of a sheet as texts, by row and column; missing cells are null."""
    z = zipfile.ZipFile(io.BytesIO(content))

    def xml(name: str):
        return ElementTree.fromstring(z.read(name))

    ids = {s.get("name"): s.get(_REL) for s in xml("xl/workbook.xml").iter(f"{_NS}sheet")}
    if sheet not in ids:
        raise SourceError(f"no sheet {sheet!r}")
    target = {r.get("Id"): r.get("Target") for r in xml("xl/_rels/workbook.xml.rels")}[ids[sheet]]
    path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    shared = ["".join(t.text or "" for t in s.iter(f"{_NS}t")) for s in xml("xl/sharedStrings.xml").iter(f"{_NS}si")] if "xl/sharedStrings.xml" in z.namelist() else []
    out = []
    for row in xml(path).iter(f"{_NS}row"):
        cells: list[str | None] = []
        for c in row.iter(f"{_NS}c"):
            letters = re.match(r"[A-Z]*", c.get("r") or "")[0]
            at = len(cells)
            if letters:
                at = -1
                for x in letters:
                    at = (at + 1) * 26 + ord(x) - 65
            value = c.find(f"{_NS}v")
            text = "".join(t.text or "" for t in c.iter(f"{_NS}t")) if c.get("t") == "inlineStr" else None if value is None else shared[int(value.text)] if c.get("t") == "s" else value.text
            cells += [None] * (at + 1 - len(cells))
            cells[at] = text
        out.append(cells)
    return out


def sheet(files: DataFrame, name: str) -> DataFrame:
    """Identity columns of the members, ``row`` (0 is the header) and ``cells``."""
    keep = [c for c in files.columns if c != "content"]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                found = sheet_rows(row.pop("content"), name)
                yield pd.DataFrame({**{c: [row[c]] * len(found) for c in keep}, "row": range(len(found)), "cells": found})

    return files.mapInPandas(parse, ", ".join([*[f"`{c}` {files.schema[c].dataType.simpleString()}" for c in keep], "row bigint, cells array<string>"]))


def limits(files: DataFrame, name: str = "Results", by: str = "member_sha256") -> DataFrame:
    """Hourly limits: a column ``Time``, then for each constraint one of its name (rt) and one of its name and DAM (dam).

    A second row of the same local time is the repeated hour; an hour that the clock skips, columns that don't pair up and bad times are errors.
    """
    cells = sheet(files, name)
    keep = [c for c in files.columns if c != "content"]
    clean = F.transform("cells", lambda c: F.trim(c))
    dam = F.lit(r"(?i)\s*DAM$")
    heads = cells.where("row = 0").select(F.col(by).alias("__by"), clean.alias("heads"))
    rt_names = F.array_sort(F.filter(F.slice("heads", 2, 100_000), lambda c: ~F.regexp_like(c, dam)))
    dam_names = F.array_sort(F.transform(F.filter(F.slice("heads", 2, 100_000), lambda c: F.regexp_like(c, dam)), lambda c: F.regexp_replace(c, r"(?i)\s*DAM$", "")))
    bad = F.raise_error(F.lit("the first column isn't Time, or columns don't pair up")).cast("array<string>")
    heads = heads.withColumn("heads", F.when((F.lower(F.get("heads", F.lit(0))) == "time") & (rt_names == dam_names), F.col("heads")).otherwise(bad))
    rows = cells.where("row > 0").withColumn("interval_start", F.to_timestamp(F.trim(F.get("cells", F.lit(0))), "yyyy-MM-dd HH:mm:ss"))
    again = F.row_number().over(Window.partitionBy(by, "interval_start").orderBy("row")) > 1
    rows = rows.withColumn("interval_start_utc", local_instant(F.col("interval_start"), again))
    long = rows.join(heads, F.col(by) == F.col("__by")).select(*keep, "interval_start", "interval_start_utc", F.posexplode(F.slice("heads", 2, 100_000)).alias("at", "head"), "cells")
    is_dam = F.regexp_like("head", dam)
    return long.select(
        *keep, F.col("interval_start").cast("timestamp_ntz").alias("interval_start"), "interval_start_utc", F.to_date("interval_start").alias("delivery_date"),
        (F.hour("interval_start") + 1).cast("bigint").alias("hour_ending"), F.regexp_replace("head", r"(?i)\s*DAM$", "").alias("gtc_name"),
        F.when(is_dam, "dam").otherwise("rt").alias("market"), F.trim(F.get("cells", F.col("at") + 1)).try_cast("double").alias("limit_mw"),
    )
