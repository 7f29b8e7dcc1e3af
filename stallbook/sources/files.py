"""Small files and folders, through the file systems that Spark reads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, p = _at(spark, path)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise RuntimeError(f"{path} could not be renamed to {to}")


def size(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes of files that are named as Spark names its input files. Each folder is
    listed once."""
    jvm = spark._jvm
    wanted: dict[str, set[str]] = {}
    for name in paths:
        folder, _, file = name.rpartition("/")
        wanted.setdefault(folder, set()).add(file)
    total = 0
    for folder, found in wanted.items():
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p):
            if s.getPath().toUri().toString().rpartition("/")[2] in found:
                total += s.getLen()
    return total


def split_size(spark: SparkSession) -> int:
    """Bytes that a task reads of large files."""
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def head(spark: SparkSession, path: str, most: int | None = None) -> bytes:
    """The first bytes of a file, or all of it."""
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes() if most is None else stream.readNBytes(most))
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, content: bytes) -> None:
    """A file that is there as a whole or not at all: written under another name
    and renamed."""
    fs, p = _at(spark, f"{path}.new")
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    rename(spark, f"{path}.new", path)
