"""Pieces the corpus operators share: word rules, Arrow plumbing; durable intermediate results are the library's."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.storage import removed, saved, stored, written  # noqa: F401

#: Byte table: A-Z to lower case, every ASCII byte that is not a letter or digit to a space.
#: Bytes of 0x80 and above (all parts of non-ASCII characters) stay, so words keep them.
ALNUM_TABLE = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased (bytes methods are ASCII-only)."""
    return text.lower().split()


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased."""
    return text.translate(ALNUM_TABLE).split()


def texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without a decode and encode in between."""
    values = batch.column(batch.schema.get_field_index(column))
    return values.cast(pa.binary() if not pa.types.is_large_string(values.type) else pa.large_binary()).to_pylist()


def pieces(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``max_bytes`` of ``column`` (or one row), so that memory is bounded by bytes, not rows."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        if batch.column(at).nbytes <= max_bytes:
            if batch.num_rows:
                yield batch
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def appended(
    docs: DataFrame,
    text: str,
    keep: dict[str, Column],
    columns: str,
    make: Callable[[], Callable[..., list[pa.Array]]],
    also: list[str] | None = None,
    max_bytes: int = 16 << 20,
) -> DataFrame:
    """``docs`` reduced to ``keep`` (output name -> column) plus columns computed from whole texts.

    ``make`` is called once a task and returns the function from texts (and the arrays of the columns ``also``) to
    arrays. There is no shuffle.
    """
    also, schema = also or [], T.StructType.fromDDL(columns)
    inner = docs.select(F.col(f"`{text}`").cast("string").alias("_text"), *(F.col(f"`{c}`").alias(f"_a{i}") for i, c in enumerate(also)), *(c.alias(f"_c{i}") for i, c in enumerate(keep.values())))
    kept = [T.StructField(f"_c{i}", f.dataType) for i, f in enumerate(inner.schema.fields[1 + len(also) :])]
    made = [T.StructField(f"_m{i}", f.dataType) for i, f in enumerate(schema.fields)]
    names = [f.name for f in kept + made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in pieces(batches, "_text", max_bytes):
            done = work(texts(batch, "_text"), *batch.columns[1 : 1 + len(also)])
            yield pa.RecordBatch.from_arrays([*batch.columns[1 + len(also) :], *done], names=names)

    out = inner.mapInArrow(run, T.StructType(kept + made))
    return out.select(
        *(F.col(f"_c{i}").alias(n) for i, n in enumerate(keep)), *(F.col(f"_m{i}").alias(f.name) for i, f in enumerate(schema.fields))
    )


def carried(id_col: str, carry: list[str] | None) -> dict[str, Column]:
    """The id as ``doc_id``, and the columns that a caller wants beside the result as the struct ``carried``, where no name clashes."""
    return {"doc_id": F.col(f"`{id_col}`")} | ({"carried": F.struct(*(F.col(f"`{c}`") for c in carry))} if carry else {})


def numbered(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``df`` with the place of each row in ``order``, from 0: a range sort, then numbers within partitions plus offsets."""
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = saved(df.sort(*order).withColumns({"_part": F.spark_partition_id(), "_at": within}))
    starts, total = {}, 0
    for part, n in sorted(placed.groupBy("_part").count().collect()):  # a row per partition
        starts[part], total = total, total + n
    if not starts:
        return placed.withColumn(name, F.lit(0).cast("long")).drop("_part", "_at")
    offsets = F.create_map(*(F.lit(x).cast("long") for pair in starts.items() for x in pair))
    start = F.get(F.map_values(offsets), F.array_position(F.map_keys(offsets), F.col("_part").cast("long")).cast("int") - 1)
    return placed.withColumn(name, start + F.col("_at")).drop("_part", "_at")


def freed(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of steps that nothing refers to any more; by itself it does so when the driver happens to run short of memory."""
    for _ in range(3):  # what Python lets go of reaches the JVM a moment later
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.7)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
