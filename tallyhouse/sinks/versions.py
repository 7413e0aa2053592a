"""Tables that are replaced as a whole while others read them.

Each replacement goes to a folder of its own below ``versions``; when it is written and
committed, a note (:mod:`~tallyhouse.sinks.pointers`) makes it the current one. A write
that fails leaves the old rows as they are, and a reader sees the version it resolved for
as long as it reads: versions are deleted some replacements later.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyhouse.sinks import pointers

VERSIONS = "versions"

#: Versions left by a replacement: the current one and those that readers may still hold.
KEPT_VERSIONS = 3


def replace(df: DataFrame, path: str, write: Callable[[DataFrame, str], None],
            kept: int = KEPT_VERSIONS) -> str:
    """Make ``df`` the table at ``path``; ``write(df, folder)`` stores it.

    ``df`` may read the table itself. Returns the folder of the new version. Of two
    replacements at once one fails with a :class:`~tallyhouse.sinks.pointers.StaleNote`.
    """
    spark = df.sparkSession
    number, _ = pointers.latest(spark, path)
    name = f"{number + 1:012d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/{VERSIONS}/{name}"
    try:
        write(df, folder)
        pointers.advance(spark, path, number + 1, name)
    except BaseException:
        pointers.remove(spark, folder)
        raise
    sweep(spark, path, kept)
    return folder


def sweep(spark: SparkSession, path: str, kept: int = KEPT_VERSIONS) -> list[str]:
    """Delete all but the last ``kept`` versions, and what broken writes left before them."""
    number, _ = pointers.latest(spark, path)
    gone = [name for name in pointers.children(spark, f"{path}/{VERSIONS}")
            if int(name.split("-")[0]) <= number - kept]
    for name in gone:
        pointers.remove(spark, f"{path}/{VERSIONS}/{name}")
    pointers.forget(spark, path, number)
    return gone


def current(spark: SparkSession, path: str) -> str:
    """Folder of the current version. A folder without versions is its own, so that tables
    written by others are read alike."""
    _, name = pointers.latest(spark, path)
    return path if name is None else f"{path}/{VERSIONS}/{name}"


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of the current version."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(current(spark, path))
