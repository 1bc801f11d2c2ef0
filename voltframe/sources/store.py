"""A content-addressed store of files: each is kept once under the digest of its bytes, whoever brings it and however often.

Executors write, each what it has read: bytes go to a name of the attempt's own, and a rename gives them their place. An attempt
that dies leaves only its own name behind, which no reader sees; two that bring the same bytes end in one file of the same
bytes, whichever renames last. ``root`` is a folder or URI that all machines share and pyarrow's file systems can reach.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workers import ship

STORED = "blob_sha256 string, size bigint, path string, is_new boolean, members array<struct<member_path: string, member_sha256: string, size: bigint>>"
#: What the names of attempts begin with.
ATTEMPT = ".attempt-"


def place(digest: str) -> str:
    """Where a blob lies below the root."""
    return f"{digest[:2]}/{digest}"


def _open(root: str) -> tuple[fs.FileSystem, str]:
    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root.rstrip("/")


def keep(system: fs.FileSystem, root: str, content: bytes) -> tuple[str, str, bool]:
    """(digest, place, whether it is new) of bytes that are in the store now."""
    digest = hashlib.sha256(content).hexdigest()
    folder, path = f"{root}/{digest[:2]}", f"{root}/{place(digest)}"
    found = system.get_file_info(path)
    if found.type == fs.FileType.File and found.size == len(content):
        return digest, place(digest), False
    own = f"{folder}/{ATTEMPT}{uuid.uuid4().hex}"
    system.create_dir(folder, recursive=True)
    with system.open_output_stream(own) as out:
        out.write(content)
    system.move(own, path)
    return digest, place(digest), True


def members(content: bytes) -> list[dict]:
    """Path, digest and size of each file of a zip, from the bytes that are at hand; none of anything else."""
    if content[:4] not in (b"PK\x03\x04", b"PK\x05\x06"):
        return []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        found = ((n, z.read(n)) for n in z.namelist() if not n.endswith("/"))
        return [{"member_path": n, "member_sha256": hashlib.sha256(data).hexdigest(), "size": len(data)} for n, data in found]


def put(docs: DataFrame, root: str, content: str = "content") -> DataFrame:
    """The columns of ``docs`` but ``content``, and blob_sha256, size, path (below ``root``), is_new and members of each row's file.

    Files are written when the frame is evaluated, again if it is evaluated again, to no other effect. Null contents are nothing: their rows have nulls. A file
    is held in memory whole.
    """
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c != content]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = _open(root)
        for pdf in batches:
            rows = []
            for data in pdf[content]:
                if data is None:
                    rows.append((None, None, None, None, None))
                    continue
                data = bytes(data)
                digest, path, is_new = keep(system, folder, data)
                rows.append((digest, len(data), path, is_new, members(data)))
            out = pdf[rest].copy()
            for name, values in zip(("blob_sha256", "size", "path", "is_new", "members"), zip(*rows, strict=True) if rows else [()] * 5, strict=True):
                out[name] = pd.Series(list(values), index=out.index, dtype=object)
            yield out

    kinds = ", ".join([*[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest], STORED])
    return docs.select(*rest, content).mapInPandas(run, kinds)


def blobs(spark: SparkSession, root: str) -> DataFrame:
    """blob_sha256, size and content of what the store holds; attempts aren't listed, nor the empty file, which Spark doesn't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.substring_index("path", "/", -1)
    return files.where(~name.startswith(ATTEMPT)).select(name.alias("blob_sha256"), F.col("length").alias("size"), "content")


def damaged(spark: SparkSession, root: str) -> DataFrame:
    """blob_sha256 and size of files whose bytes don't have the digest that they are named by."""
    return blobs(spark, root).where(F.sha2("content", 256) != F.col("blob_sha256")).select("blob_sha256", "size")


def discard(root: str, digests: list[str]) -> None:
    """Removes blobs of the names given, and says nothing of those that aren't there."""
    system, folder = _open(root)
    for digest in digests:
        if system.get_file_info(f"{folder}/{place(digest)}").type == fs.FileType.File:
            system.delete_file(f"{folder}/{place(digest)}")
