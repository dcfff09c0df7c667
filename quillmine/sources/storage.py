"""Durable intermediate results, versioned stage tables, papers, JSON artifacts."""

from __future__ import annotations

import json
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share. Where it is unset, a local session gets one of its own; others must set it."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and not context.master.startswith("local") or context.master.startswith("local-cluster") and not path:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(path or tempfile.mkdtemp(prefix="quillmine-"))
    return context._jsc.sc().getCheckpointDir().get()


def spread(df: DataFrame, *columns: str, most: int | None = None) -> DataFrame:
    """``df`` dealt over all tasks by these columns: for narrow rows from few files that much is made of, as a small file is read by one task. ``most``: into no more parts, if all cores have one."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * cores)
    return df.repartition(n if most is None else max(cores, min(n, most)), *columns)


def saved(df: DataFrame) -> DataFrame:
    """``checkpoint()``: lineage is cut by a copy in the shared folder, which survives executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet in the shared folder and read again, and its folder, for ``removed``."""
    path = f"{shared_dir(df.sparkSession)}/quillmine-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again."""
    return written(df, name)[0]


def removed(spark: SparkSession, path: str) -> None:
    """Deletes what ``written`` has written, once nothing reads it any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_papers(spark: SparkSession, path: str) -> DataFrame:
    """(paper_id, markdown) of Markdown files, whole; the id is the file's name without suffix. A byte order mark stays."""
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("_file"), F.col("value").alias("markdown"))
    return rows.select(F.regexp_replace(F.url_decode(F.regexp_extract("_file", r"([^/]+)$", 1)), r"\.[^.]*$", "").alias("paper_id"), "markdown")


def read_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A JSON document per file, with or without a byte order mark."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A JSON object per line; blank lines are skipped, a malformed line fails the query."""
    text = spark.read.text(path).select(F.regexp_replace("value", "^\\ufeff", "").alias("value")).where(F.trim("value") != "")
    return text.select(F.from_json("value", schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema), {"mode": "FAILFAST"}).alias("r")).select("r.*")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    write_jsonl(df, path, "append")


def write_json(df: DataFrame, path: str, by: str = "paper_id") -> None:
    """One JSON document per row, in a folder per key."""
    df.select(F.col(by), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").partitionBy(by).text(path)


class Stages:
    """Stage tables in a folder. A version of a table is a folder of its own; one small pointer file says which version counts.

    The pointer names the version, what it was made from, whether it is complete, and what was measured while it was written. It is
    replaced in one step after the version's data are there, so a driver that is lost at any time leaves the old version or the new one,
    never a mixture. The version before the current one stays for readers that have begun; older ones, and those that no pointer ever named,
    are deleted by the next commit. All files go through Spark's own file system layer, so the folder can be in any store. One driver
    at a time writes to a folder.
    """

    def __init__(self, spark: SparkSession, root: str, resume: bool = True):
        self.spark, self.root, self.resume = spark, root.rstrip("/"), resume

    def _pointer(self, stage: str) -> str:
        return f"{self.root}/_pointers/{stage}"

    def _file(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def uri(self, path: str) -> str:
        """A path as every process names it, whatever the default file system is."""
        p, fs = self._file(path)
        return re.sub(r"^file:/+", "file:///", str(fs.makeQualified(p).toString()))

    def exists(self, path: str) -> bool:
        p, fs = self._file(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """What is in a folder; nothing if it is not there."""
        p, fs = self._file(path)
        return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []

    def read_text(self, path: str) -> str | None:
        p, fs = self._file(path)
        if not fs.exists(p):
            return None
        opened = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
        finally:
            opened.close()

    def write_text(self, path: str, text: str) -> None:
        """Replaces a file in one step: by renaming, or by closing it where a store knows no renaming over a file."""
        jvm = self.spark._jvm
        p, fs = self._file(path)
        new = jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_new-{uuid.uuid4().hex}")
        try:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(p).toUri(), self.spark._jsc.hadoopConfiguration())
        except Exception as e:  # no such file system there
            if "UnsupportedFileSystem" not in str(e):
                raise
            context, new = None, p
        out = fs.create(new, True)
        out.write(bytearray(text.encode()))
        out.close()
        if context is not None:
            rename = jvm.org.apache.hadoop.fs.Options.Rename
            how = self.spark.sparkContext._gateway.new_array(rename, 1)
            how[0] = rename.OVERWRITE
            context.rename(fs.makeQualified(new), fs.makeQualified(p), how)

    def manifest(self, stage: str) -> dict | None:
        """The pointer: version, made_from, complete, measured; None if the stage was never committed."""
        said = self.read_text(self._pointer(stage))
        return json.loads(said) if said else None

    def path(self, stage: str) -> str:
        """The folder of the version that counts."""
        found = self.manifest(stage)
        if found is None:
            raise FileNotFoundError(f"{self.root}/{stage}")
        return f"{self.root}/{stage}/{found['version']}"

    def usable(self, stage: str, made_from: dict) -> bool:
        found = self.manifest(stage) if self.resume else None
        return found is not None and found["complete"] and found["made_from"] == json.loads(json.dumps(made_from))

    def read(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(self.path(stage))

    def measured(self, stage: str) -> dict:
        return (self.manifest(stage) or {}).get("measured", {})

    def write(self, stage: str, rows: DataFrame, measures: dict[str, Column] | None = None) -> tuple[str, dict]:
        """(version, measured) of a new version that nothing points to yet; what is measured, and the number of rows, is observed while rows are written."""
        version, seen = uuid.uuid4().hex, Observation()
        columns = {"rows": F.count(F.lit(1)), **(measures or {})}
        rows.observe(seen, *(c.alias(n) for n, c in columns.items())).write.parquet(f"{self.root}/{stage}/{version}")
        return version, {n: int(v or 0) for n, v in seen.get.items()}

    def commit(self, stage: str, version: str, made_from: dict, complete: bool, measured: dict) -> None:
        before = (self.manifest(stage) or {}).get("version")
        self.write_text(self._pointer(stage), json.dumps({"version": version, "made_from": made_from, "complete": complete, "measured": measured}, sort_keys=True))
        for name in self.names(f"{self.root}/{stage}"):
            if name not in (version, before):
                self.delete(f"{self.root}/{stage}/{name}")

    def table(self, stage: str, made_from: dict, make, complete=None, measures: dict[str, Column] | None = None) -> DataFrame:
        """The stage's table: as committed if usable, else made anew. ``complete``: whether what was measured makes a whole table."""
        made_from = json.loads(json.dumps(made_from))
        if not self.usable(stage, made_from):
            version, measured = self.write(stage, make(), measures)
            self.commit(stage, version, made_from, complete(measured) if complete else True, measured)
        return self.read(stage)

    def delete(self, path: str) -> None:
        p, fs = self._file(path)
        fs.delete(p, True)

    def clear(self, stage: str) -> None:
        self.delete(self._pointer(stage))
        self.delete(f"{self.root}/{stage}")


DIGEST = ("digest_a", "digest_b")


def digest_measures(*columns: str | Column) -> dict[str, Column]:
    """Two sums of hashes over rows, whatever their order."""
    return {n: F.sum(F.xxhash64(F.lit(i), F.to_json(F.struct(*columns))).cast("decimal(38,0)")) for i, n in enumerate(DIGEST)}


def digest_of(measured: dict) -> str:
    return ":".join(str(measured[n] or 0) for n in ("rows", *DIGEST))


def content_digest(rows: DataFrame, *columns: str | Column) -> str:
    """A digest of a table's rows in any order, made of sums of hashes: one small aggregate, whatever the table's size."""
    return digest_of(rows.agg(F.count("*").alias("rows"), *(c.alias(n) for n, c in digest_measures(*columns).items())).first().asDict())
