"""A sink of one JSON document per key: each is a file of its own name, put in place whole.

A task writes a document beside its place and moves it there, so a reader finds the old document or the new one. When all tasks have
ended, the driver lists what the run has written in ``_documents.json``; documents of earlier runs stay, but are not listed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .storage import Stages

FORMAT = "quillmine_documents"
LIST = "_documents.json"
LISTED = 10_000  # names in the list; of more only their number is listed


@dataclass
class Written(WriterCommitMessage):
    number: int = 0
    names: list[str] = field(default_factory=list)


class DocumentsWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.uri = options["path"]

    def _put(self, fs: pafs.FileSystem, folder: str, name: str, text: str) -> None:
        with fs.open_output_stream(f"{folder}/_{name}") as out:
            out.write(text.encode())
        fs.move(f"{folder}/_{name}", f"{folder}/{name}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = pafs.FileSystem.from_uri(self.uri)
        fs.create_dir(folder, recursive=True)
        out = Written()
        for batch in iterator:
            for key, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                name = f"{quote(key, safe=' ()+,=@')}.json"
                self._put(fs, folder, name, value)
                out.number += 1
                if len(out.names) < LISTED:
                    out.names.append(name)
        return out

    def commit(self, messages: list[Written | None]) -> None:
        found = [m for m in messages if m]
        number, names = sum(m.number for m in found), sorted(n for m in found for n in m.names)
        fs, folder = pafs.FileSystem.from_uri(self.uri)
        fs.create_dir(folder, recursive=True)
        self._put(fs, folder, LIST, json.dumps({"documents": number, "names": names if number == len(names) <= LISTED else None}, ensure_ascii=False, indent=1))

    def abort(self, messages: list[Written | None]) -> None:
        """Documents are whole, whoever wrote them; the list stays that of the last run that ended."""


class DocumentsSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> DocumentsWriter:
        return DocumentsWriter(self.options)


def write_documents(rows: DataFrame, folder: str, key: Column, value: Column) -> None:
    """A document ``<key>.json`` for each row (names are quoted as in URLs); keys are to be distinct, rows without key are left out."""
    spark = rows.sparkSession
    spark.dataSource.register(DocumentsSink)
    named = rows.select(key.cast("string").alias("key"), F.coalesce(value, F.lit("null")).alias("value")).where("key is not null")
    named.write.format(FORMAT).option("path", Stages(spark, folder).uri(folder)).mode("append").save()


def paper_documents(final: DataFrame, papers: DataFrame) -> DataFrame:
    """(paper_id, document) for each of ``papers``, with and without final topics: its topics in order, and how many have which status.

    A paper's topics meet in one row, as its document asks; papers are dealt over all tasks, nothing is sorted beyond a paper.
    """
    fields = [c for c in final.columns if c != "paper_id"]
    listed = final.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("topic_ordinal", F.struct(*fields).alias("t")))).alias("_t"), F.count_if(F.col("status") == "accepted").alias("accepted"), F.count_if(F.col("status") == "review").alias("review"))
    every = papers.select("paper_id").distinct().join(listed, "paper_id", "left")
    topics = F.coalesce(F.transform("_t", lambda x: x["t"]), F.array().cast(T.ArrayType(T.StructType([final.schema[c] for c in fields]))))
    counts = F.struct(*(F.coalesce(c, F.lit(0)).alias(c) for c in ("accepted", "review")))
    return every.select("paper_id", F.to_json(F.struct("paper_id", counts.alias("counts"), topics.alias("final_topics")), {"ignoreNullFields": "false", "pretty": "true"}).alias("document"))
