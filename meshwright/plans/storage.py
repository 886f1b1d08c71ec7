"""Small files of a run on the file system that Spark's tables are on: a local path, or any that Hadoop knows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.setVerifyChecksum(False)  # people edit these files
    fs.setWriteChecksum(False)
    return place, fs


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _at(spark, path)
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    place, fs = _at(spark, path)
    fs.delete(place, True)


def write(spark: SparkSession, path: str, text: str | Iterable[str], portion: int = 1 << 20) -> str:
    """Write a text, in portions of about a megabyte if it comes in pieces; a file appears whole, in place of an older one."""
    place, fs = _at(spark, path)
    new, _ = _at(spark, f"{path}.new")
    fs.mkdirs(place.getParent())
    out = fs.create(new, True)
    try:
        held, size = [], 0
        for piece in [text] if isinstance(text, str) else text:
            held.append(piece)
            size += len(piece)
            if size >= portion:
                out.write(bytearray("".join(held).encode()))
                held, size = [], 0
        out.write(bytearray("".join(held).encode()))
    finally:
        out.close()
    fs.delete(place, False)
    fs.rename(new, place)
    return path


def read(spark: SparkSession, path: str) -> str | None:
    """The text of a file, or nothing if there is none."""
    place, fs = _at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()

