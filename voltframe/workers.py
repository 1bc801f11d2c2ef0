"""What Python workers need, and the cluster's shared folder."""

from __future__ import annotations

import gc
import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies (in a cluster: installed at the same path, or by --py-files)."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Where none is set, one beside the warehouse, but only if all runs on one machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
            folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def _storable(kind: T.DataType) -> bool:
    """Whether Parquet can hold it; it has no type for columns of nothing but null."""
    if isinstance(kind, T.StructType):
        return all(_storable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _storable(kind.elementType)
    if isinstance(kind, T.MapType):
        return _storable(kind.keyType) and _storable(kind.valueType)
    return not isinstance(kind, T.NullType)


def shared(df: DataFrame) -> DataFrame:
    """``df``, written once to the shared folder and read from there: its lineage is cut, lost executors lose nothing.

    The files go when the session ends, or by ``discard``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    if len(set(df.columns)) < len(df.columns) or not all(_storable(f.dataType) for f in df.schema.fields):
        return df.checkpoint()
    df.write.option("compression", "zstd").parquet(path)
    jvm_path, fs = _file_system(spark, path)
    fs.deleteOnExit(jvm_path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def discard(*frames: DataFrame) -> None:
    """Delete what ``shared`` wrote for these frames; nothing may read them any more."""
    for df in frames:
        if path := getattr(df, "_shared_path", None):
            jvm_path, fs = _file_system(df.sparkSession, path)
            fs.delete(jvm_path, True)


def settle(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more.

    Its cleaner works when the driver collects garbage, which may be half an hour after a shuffle's rows were written
    to the shared folder; until then, executors keep them on disk.
    """
    gc.collect()
    spark._jvm.System.gc()
