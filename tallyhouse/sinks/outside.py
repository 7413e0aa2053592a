"""Rows handed to an outside store, each job's exactly once.

Tasks stage blocks of rows and report what they staged; only when all tasks have ended are
the blocks of the successful attempts published, in one step and under the number of the
run. A job that fails leaves nothing but staged blocks, which are discarded, and a run that
is repeated after it was published changes nothing. It is a Python data source, so Spark
brings the reports of the tasks together.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tallyhouse.session import ship_package


class Store(Protocol):
    """An outside store; its objects travel to the tasks."""

    def stage(self, run: str, block: pa.RecordBatch) -> str:
        """Keep a block out of sight; returns what names it."""

    def publish(self, run: str, blocks: list[str]) -> None:
        """Make all blocks visible at once, unless the run has been published."""

    def discard(self, blocks: list[str]) -> None:
        """Drop staged blocks."""


@dataclass
class Staged(WriterCommitMessage):
    """What one task staged."""

    blocks: list[str]


class _Writer(DataSourceArrowWriter):
    def __init__(self, store: Store, run: str) -> None:
        self.store, self.run = store, run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        staged: list[str] = []
        try:
            for block in iterator:
                if block.num_rows:
                    staged.append(self.store.stage(self.run, block))
        except BaseException:
            self.store.discard(staged)
            raise
        return Staged(staged)

    def commit(self, messages: list[Staged | None]) -> None:
        self.store.publish(self.run, [b for m in messages if m is not None for b in m.blocks])

    def abort(self, messages: list[Staged | None]) -> None:
        self.store.discard([b for m in messages if m is not None for b in m.blocks])


def write_outside(df: DataFrame, store: Store, run: str) -> None:
    """Hand the rows of ``df`` to ``store`` as run ``run``, such as a date or a batch number."""
    ship_package(df.sparkSession)
    name = f"outside_{uuid.uuid4().hex[:8]}"

    class Outside(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> _Writer:
            return _Writer(store, run)

    df.sparkSession.dataSource.register(Outside)
    df.write.format(name).mode("append").save()


@dataclass(frozen=True)
class FolderStore:
    """Blocks as Parquet files in a folder that all executors reach, with a list for each run.

    Serves as an exchange folder for loaders that are not Spark's, and as the pattern for
    stores with a staging table and a transaction.
    """

    uri: str

    def _files(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.uri if "://" in self.uri else f"file://{self.uri.removeprefix('file:')}")

    def stage(self, run: str, block: pa.RecordBatch) -> str:
        files, root = self._files()
        files.create_dir(f"{root}/blocks", recursive=True)
        name = f"{run}-{uuid.uuid4().hex}.parquet"
        with files.open_output_stream(f"{root}/blocks/{name}") as out:
            pq.write_table(pa.Table.from_batches([block]), out)
        return name

    def publish(self, run: str, blocks: list[str]) -> None:
        files, root = self._files()
        files.create_dir(f"{root}/runs", recursive=True)
        if files.get_file_info(f"{root}/runs/{run}.json").type != fs.FileType.NotFound:
            self.discard(blocks)
            return
        draft = f"{root}/runs/.{run}-{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write(json.dumps(blocks).encode())
        files.move(draft, f"{root}/runs/{run}.json")

    def discard(self, blocks: list[str]) -> None:
        files, root = self._files()
        for name in blocks:
            if files.get_file_info(f"{root}/blocks/{name}").type != fs.FileType.NotFound:
                files.delete_file(f"{root}/blocks/{name}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The published rows. The lists of the runs name files only, so the driver reads them."""
        files, root = self._files()
        names = []
        for info in files.get_file_info(fs.FileSelector(f"{root}/runs")):
            if not info.base_name.startswith("."):
                with files.open_input_stream(info.path) as source:
                    names += json.loads(source.read())
        return spark.read.parquet(*[f"{self.uri}/blocks/{name}" for name in names])
