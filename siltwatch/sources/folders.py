"""Folders of micro-batches in the shared file system, whichever it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _file_system(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> bool:
    where, fs = _file_system(spark, path)
    return fs.delete(where, True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders and files that a glob pattern names."""
    where, fs = _file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(where) or []))


def files_below(spark: SparkSession, path: str, suffix: str = ".parquet") -> list[str]:
    """Data files of a folder, at any depth."""
    where, fs = _file_system(spark, path)
    if not fs.exists(where):
        return []
    listed, out = fs.listFiles(where, True), []
    while listed.hasNext():
        name = listed.next().getPath().toString()
        if name.endswith(suffix):
            out.append(name)
    return sorted(out)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all; an earlier one is replaced."""
    where, fs = _file_system(spark, path)
    part, _ = _file_system(spark, f"{where.getParent()}/.{where.getName()}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(where):
        fs.delete(where, False)
    if not fs.rename(part, where):
        raise OSError(f"{path} could not be written")


def batch_number(folder: str) -> int:
    """Number of a ``stream_batch=n`` folder."""
    return int(folder.rstrip("/").rpartition("=")[2])


def forget_before(spark: SparkSession, path: str, batch_id: int) -> int:
    """Remove the folders of micro-batches before one; returns how many.

    A stream replays its newest micro-batch at most, so what only older ones need can go.
    """
    old = [f for f in folders(spark, f"{path}/stream_batch=*") if batch_number(f) < batch_id]
    return sum(remove(spark, f) for f in old)


def read_text(spark: SparkSession, path: str) -> str:
    """Text of a small file."""
    where, fs = _file_system(spark, path)
    stream = fs.open(where)
    try:
        utf8 = spark.sparkContext._jvm.java.nio.charset.StandardCharsets.UTF_8
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, utf8)
    finally:
        stream.close()
