"""Files and tables in the shared folder that ``spark.checkpoint.dir`` names.

Tasks write files of their own formats here (WARC archives, token shards,
automata).  A file's name carries a random part, and only the manifest row of
the task attempt that succeeded names it, so a retried or speculative attempt
leaves at most an unread file behind.  Paths may be of any scheme that
``pyarrow.fs`` opens (``file``, ``hdfs``, ``s3``, ``gs``).
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from riskframe.session import scratch_path


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of ``path`` and the path inside it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for files that tasks write."""
    return scratch_path(spark, name)


def new_file(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def create(path: str):
    """A writable stream; parent folders are made where the store has folders."""
    files, inner = filesystem(path)
    files.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return files.open_output_stream(inner, compression=None)


def open_random(path: str) -> pa.NativeFile:
    """A file for range reads."""
    files, inner = filesystem(path)
    return files.open_input_file(inner)


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, but keeps columns apart, so
    that each later job reads only the columns it uses.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def add_file(spark: SparkSession, data: bytes, name: str) -> str:
    """Place ``data`` on every executor's disk once; tasks find it by
    ``SparkFiles.get(name)`` and memory-map it.  Returns the unique name."""
    name = f"{uuid.uuid4().hex[:12]}-{name}"
    path = f"{shared_folder(spark, 'files')}/{name}"
    with create(path) as out:
        out.write(data)
    spark.sparkContext.addFile(path)
    return name


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with more underscores in front if the table has that column."""
    while wanted in df.columns:
        wanted = "_" + wanted
    return wanted


def bounded_batches(spark: SparkSession) -> None:
    """Hand texts to Python tasks in batches of at most 8 MB, unless the
    session says otherwise (Spark's own limit is 64 MB, held several times)."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, "8m")


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null gives empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]
