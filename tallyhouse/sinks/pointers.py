"""Numbered notes beside a table, each written once: what the table's readers go by.

A note is a small file whose name is its number. Creating it fails if it is there, so of
two writers that saw the same last note one has to start again, and readers see the note
before or the note after, never a half. Files are reached through Hadoop's file systems, so
a table may lie wherever Spark can write; the store has to create files exclusively, as
HDFS and local disks do.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Folder of the notes; the underscore hides it from the table's readers.
NOTES = "_notes"

#: What a whole note ends with.
END = "\n"

#: How many of the last notes a sweep leaves.
KEPT_NOTES = 20


class StaleNote(RuntimeError):
    """Another writer was first."""


def _files(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _files(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder."""
    files, where = _files(spark, path)
    if not files.exists(where):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(where))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that no reader can need any more; one that is gone does no harm."""
    files, where = _files(spark, path)
    files.delete(where, True)


def latest(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The greatest number given to a note of the table, and the text of the last whole one;
    (-1, None) before the first. A note whose writer died over it is not whole."""
    names = [n for n in children(spark, f"{path}/{NOTES}") if n.isdigit()]
    for name in reversed(names):
        files, where = _files(spark, f"{path}/{NOTES}/{name}")
        stream = files.open(where)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if text.endswith(END):
            return int(names[-1]), text.removesuffix(END)
    return int(names[-1]) if names else -1, None


def advance(spark: SparkSession, path: str, number: int, text: str) -> None:
    """Write note ``number``. A :class:`StaleNote` tells that another writer has taken it."""
    files, where = _files(spark, f"{path}/{NOTES}/{number:012d}")
    try:
        stream = files.create(where, False)
    except Py4JJavaError as error:
        if files.exists(where):
            raise StaleNote(where.toString()) from error
        raise
    try:
        stream.write(bytearray((text + END).encode()))
    finally:
        stream.close()


def forget(spark: SparkSession, path: str, upto: int) -> None:
    """Delete the notes long before ``upto``."""
    for name in children(spark, f"{path}/{NOTES}"):
        if name.isdigit() and int(name) <= upto - KEPT_NOTES:
            remove(spark, f"{path}/{NOTES}/{name}")
