"""A sink that keeps answers as they come: a Python data source whose tasks commit every few rows by themselves.

A task writes what it has so far as a small file under its final name, in one step, and goes on. When it ends it puts its small files
into one and deletes them. A task, job or driver that is lost leaves the files that it has finished, which the next run reads; what a
repeated task writes a second time is told by its key. File names hold numbers of rows, so listing the folder says how far a run has come.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .storage import Stages

FORMAT = "quillmine_answers"
NAME = re.compile(r"part-\d+-[0-9a-f]+-(\d+)\.parquet$")
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@dataclass
class Kept(WriterCommitMessage):
    rows: int


class AnswersWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.uri, self.rows = options["path"], int(options["rows"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Kept:
        from pyspark import TaskContext

        fs, folder = pafs.FileSystem.from_uri(self.uri)
        fs.create_dir(folder, recursive=True)
        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        files: list[tuple[str, int]] = []

        def put(table: pa.Table) -> tuple[str, int]:
            name = f"part-{part:05d}-{uuid.uuid4().hex}-{table.num_rows}.parquet"
            pq.write_table(table, f"{folder}/_{name}", filesystem=fs)
            fs.move(f"{folder}/_{name}", f"{folder}/{name}")
            return f"{folder}/{name}", table.num_rows

        for batch in iterator:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= self.rows:
                files.append(put(pa.Table.from_batches(held)))
                held = []
        if held:
            files.append(put(pa.Table.from_batches(held)))
        total = sum(n for _, n in files)
        if len(files) > 1:  # a reader between these steps sees rows twice, never too few
            name = f"part-{part:05d}-{uuid.uuid4().hex}-{total}.parquet"
            schema = pq.read_schema(files[0][0], filesystem=fs)
            with pq.ParquetWriter(f"{folder}/_{name}", schema, filesystem=fs) as out:
                for path, _ in files:
                    out.write_table(pq.read_table(path, filesystem=fs, partitioning=None))
            fs.move(f"{folder}/_{name}", f"{folder}/{name}")
            for path, _ in files:
                fs.delete_file(path)
        return Kept(total)

    def commit(self, messages: list[Kept | None]) -> None:
        """Every task has committed its own rows."""

    def abort(self, messages: list[Kept | None]) -> None:
        """What tasks have committed stays."""


class AnswersSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> AnswersWriter:
        return AnswersWriter(self.options)


class Answers:
    """The answers of one kind of calls, in a folder."""

    def __init__(self, stages: Stages, name: str):
        self.stages, self.spark, self.folder = stages, stages.spark, f"{stages.root}/{name}"

    def kept(self) -> int:
        """Rows committed so far, by the files' names."""
        return sum(int(m[1]) for m in map(NAME.match, self.stages.names(self.folder)) if m)

    def read(self, schema: T.StructType) -> DataFrame:
        if not any(NAME.match(n) for n in self.stages.names(self.folder)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.folder)

    def add(self, rows: DataFrame, every: int) -> None:
        """Writes ``rows`` in one job; each task commits every ``every`` rows, which is also what goes to Python at a time."""
        self.spark.dataSource.register(AnswersSource)
        before = self.spark.conf.get(BATCH)
        self.spark.conf.set(BATCH, str(every))
        try:
            rows.write.format(FORMAT).option("path", self.stages.uri(self.folder)).option("rows", str(every)).mode("append").save()
        finally:
            self.spark.conf.set(BATCH, before)

    def clear(self) -> None:
        self.stages.delete(self.folder)
