"""Files as rows: documents, members of zip files, and delimited text with a declared header."""

from __future__ import annotations

import csv
import hashlib
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import Field, SourceError, cast

MEMBER = "blob_sha256 string, member_sha256 string, member_path string, content binary"
BATCH = 20_000


def documents(spark: SparkSession, path: str) -> DataFrame:
    """path, content and sha256 of every file below a folder."""
    return spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(path).select("path", "content", F.sha2("content", 256).alias("blob_sha256"))


def members(docs: DataFrame) -> DataFrame:
    """One row for each file in each zip; a document that isn't one is its own member. A member is held in memory whole."""

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content, blob in zip(pdf["path"], pdf["content"], pdf["blob_sha256"], strict=True):
                packed = zipfile.ZipFile(io.BytesIO(content)) if path.lower().endswith(".zip") else None
                names = [n for n in packed.namelist() if not n.endswith("/")] if packed else [path.rsplit("/", 1)[-1]]
                for name in names:
                    data = packed.read(name) if packed else content
                    yield pd.DataFrame({"blob_sha256": [blob], "member_sha256": [hashlib.sha256(data).hexdigest()], "member_path": [name], "content": [data]})

    return docs.select("path", "content", "blob_sha256").mapInPandas(expand, MEMBER)


def decoded(content: bytes) -> str:
    try:
        return content.decode("utf-8-sig")
    except UnicodeDecodeError:
        return content.decode("latin-1")


def header_of(content: bytes, delimiter: str = ",") -> tuple[str, ...]:
    """The first line's names, without a byte order mark, line end or closing delimiter."""
    row = next(csv.reader(io.StringIO(decoded(content)), delimiter=delimiter), [])
    names = [n.strip() for n in row]
    return tuple(names[:-1] if names and not names[-1] else names)


def delimited(files: DataFrame, layout: tuple[Field, ...], delimiter: str = ",", quoting: bool = True) -> DataFrame:
    """Rows of members (their identity columns first), typed. The header must be the declared one; fields beyond it are dropped, missing ones are null, empty lines go."""
    headers, width = [f.header for f in layout], len(layout)
    keep = [c for c in files.columns if c != "content"]
    quote = csv.QUOTE_MINIMAL if quoting else csv.QUOTE_NONE

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                content = row.pop("content")
                if list(header_of(content, delimiter)) != headers:
                    raise SourceError(f"{row.get('member_path')}: the header is {header_of(content, delimiter)[:4]}..., not the declared one")
                lines = csv.reader(io.StringIO(decoded(content), newline=""), delimiter=delimiter, quoting=quote)
                next(lines)
                some: list[list[str | None]] = []
                for line in lines:
                    if line:
                        some.append([*line[:width], *[None] * (width - len(line))])
                    if len(some) == BATCH:
                        yield frame(row, some)
                        some = []
                if some:
                    yield frame(row, some)

    def frame(row: dict, some: list) -> pd.DataFrame:
        return pd.DataFrame({**{c: [row[c]] * len(some) for c in keep}, "__t": some})

    schema = ", ".join([*[f"`{c}` {files.schema[c].dataType.simpleString()}" for c in keep], "__t array<string>"])
    rows = files.mapInPandas(parse, schema)
    taken = {f.name for f in layout}
    return rows.select(*[c for c in keep if c not in taken], *[cast(F.get("__t", F.lit(i)), f.kind).alias(f.name) for i, f in enumerate(layout)])


def classified(files: DataFrame, rules: list[tuple[str, str]], path: str = "member_path") -> DataFrame:
    """``kind`` of the first rule (pattern, kind) that a member's name fits, ``unknown`` of none."""
    kind: Column = F.lit("unknown")
    for pattern, name in reversed(rules):
        kind = F.when(F.col(path).rlike(pattern), name).otherwise(kind)
    return files.withColumn("kind", kind)


def identity(files: DataFrame, pattern: str, names: list[tuple[str, str]], path: str = "member_path") -> DataFrame:
    """Columns from the groups of a pattern on a member's name: (column, type), null where it doesn't fit."""
    return files.withColumns({name: F.nullif(F.regexp_extract(path, pattern, i + 1), F.lit("")).cast(kind) for i, (name, kind) in enumerate(names)})
