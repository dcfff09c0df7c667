"""Line deduplication across documents: sorted line hashes, streamed first occurrences, compressed keep bitmaps.

Plan. One pass makes a row for each (document, distinct line key): a 128-bit hash and the line's positions. The rows are
range-partitioned and sorted by hash, then document from the largest, then position; each partition streams its runs of one hash and
returns what is dropped, not text. Ranges also split within one hash, so a line that very many documents share is spread; a run that
touches an end of its partition may go on in the next one, so its rows are passed on undecided, and a count per
hash with partial aggregation decides them. Positions become one compressed bitmap per row of the table (id and hash of the text), and texts are
only read again to be joined with bitmaps.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import appended, carried, pieces, saved, table, texts

LEAST_LENGTH = 20
LEAST_DOCUMENTS = 3
HELD = 4096  # rows of one run that a task holds
MOST_SENT = 100_000  # hashes of undecided runs that are sent to all tasks; more are joined by merging
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"


def line_key(line: bytes) -> bytes:
    return line.strip(BLANK).lower()


def code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def _lines(least: int):
    """Rows (doc_id, version, text) -> (high, low, doc_id, version, at), one for each line key of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 16 << 20):
            docs, versions, high, low, at = [], [], [], [], []
            for doc_id, version, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch, "text"), strict=True):
                own: dict[bytes, list[int]] = {}
                for i, line in enumerate((text or b"").split(b"\n")):
                    if len(line) >= least:
                        key = line_key(line)
                        if len(key) >= least and code_points(key) >= least:
                            own.setdefault(xxhash.xxh3_128_digest(key), []).append(i)
                for h, positions in own.items():
                    docs.append(doc_id)
                    versions.append(version)
                    high.append(int.from_bytes(h[:8], "big", signed=True))
                    low.append(int.from_bytes(h[8:], "big", signed=True))
                    at.append(positions)
            yield pa.RecordBatch.from_arrays(
                [pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(docs, pa.int64()), pa.array(versions, pa.int64()), pa.array(at, pa.list_(pa.int32()))],
                names=["high", "low", "doc_id", "version", "at"],
            )

    return run


def _stream(least_documents: int, most_held: int):
    """Rows (high, low, doc_id, version, at), sorted by hash and from the largest document -> what is dropped (decided), and undecided rows.

    Undecided are the rows of a partition's first and last run, and of runs of more than ``most_held`` rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("doc_id", pa.int64()), ("version", pa.int64()), ("at", pa.list_(pa.int32())), ("decided", pa.bool_())])
        key, held, is_open = None, [], True

        for batch in batches:
            out = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if row[:2] != key:
                    if key is not None and not is_open:
                        if len(held) >= least_documents and len({r[2] for r in held}) >= least_documents:
                            out += [(*r, True) for r in held if r[2] != held[0][2]]
                    elif held:
                        out += [(*r, False) for r in held]
                    is_open, key, held = key is None, row[:2], []
                held.append(row)
                if len(held) > most_held:
                    out += [(*r, False) for r in held]
                    is_open, held = True, []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*((*r, False) for r in held), strict=True), schema, strict=True)], schema=schema)

    return run


@F.pandas_udf(T.BinaryType())
def keep_bitmap(positions: pd.Series) -> pd.Series:
    """zlib of one bit per line, 1 to keep, up to the last dropped line; later lines stay."""

    def one(at: np.ndarray) -> bytes:
        bits = np.ones(int(at.max()) // 8 * 8 + 8, bool)  # whole bytes: what fills the last one is kept
        bits[at] = False
        return zlib.compress(np.packbits(bits).tobytes())

    return positions.map(one)


def dropped(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    """Which of ``n_lines`` lines a bitmap drops."""
    if bitmap is None:
        return np.zeros(n_lines, bool)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n_lines]
    return np.r_[bits == 0, np.zeros(n_lines - len(bits), bool)]


def line_bitmaps(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text", held: int = HELD
) -> DataFrame:
    """One row per document that loses lines: doc_id, version, n_lost, bitmap. ``version`` tells the texts of one id apart.

    Texts are split at \\n; a line's key is the line without blanks ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased. Keys of at least
    ``least_length`` code points in at least ``least_documents`` documents lose all their lines except in the largest id that has
    them (all of its own lines stay). Null and empty texts have one empty line, which never falls. Rows that repeat an id count as
    one document, and rows without id as one that is smaller than any; each row loses its own lines at its own places, whatever the texts
    of its namesakes. Very long texts are one row as any other: places go with them, not text.
    An empty table gives no rows; other columns are not read.
    """
    rows = versions(docs, id_col, text_col).select("doc_id", "version", "text")
    lines = saved(rows.mapInArrow(_lines(least_length), "high long, low long, doc_id long, version long, at array<int>"))
    by = ["high", "low", F.col("doc_id").desc_nulls_last()]
    found = lines.repartitionByRange(*by).sortWithinPartitions(*by, "version", "at")
    found = saved(found.mapInArrow(_stream(least_documents, held), "high long, low long, doc_id long, version long, at array<int>, decided boolean"))
    open_ = found.where("not decided")
    hashes = open_.select("high", "low", "doc_id").distinct().groupBy("high", "low").agg(F.count("*").alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= least_documents)
    # Two a partition, and one for each run of more than ``held`` rows: few, but that is counted before they are sent anywhere.
    hashes = saved(hashes)
    hashes = F.broadcast(hashes) if hashes.count() <= MOST_SENT else hashes.hint("merge")
    falls = open_.join(hashes, ["high", "low"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    falls = found.where("decided").select("doc_id", "version", "at").unionByName(falls.select("doc_id", "version", "at"))
    marks = falls.groupBy("doc_id", "version").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"))
    return marks.select("doc_id", "version", F.size("at").cast("long").alias("n_lost"), keep_bitmap("at").alias("bitmap"))


def versions(docs: DataFrame, id_col: str, text_col: str, **more: Column) -> DataFrame:
    """(doc_id, version, text, and ``more``): a hash of the text tells rows apart that share an id, or have none."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"), *(c.alias(n) for n, c in more.items()))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, digest: bool = False, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_text (``digest``: kept_sha256), and ``carry`` as the struct carried.

    ``bitmaps`` are those of ``line_bitmaps`` for the same rows. A null text has one empty line, as an empty one has; rows that repeat an
    id are all returned. An empty table gives no rows.
    """
    keep = carried(id_col, carry)
    rows = versions(docs, id_col, text_col, **{f"_keep{i}": c for i, c in enumerate(keep.values())})
    marks = bitmaps.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.col("bitmap").alias("_bitmap"))
    rows = rows.join(marks, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version")), "left")

    def make():
        def work(found: list[bytes | None], bitmaps: pa.Array) -> list[pa.Array]:
            n_lines, n_dropped, out = [], [], []
            for text, bitmap in zip(found, bitmaps.to_pylist(), strict=True):
                text = text or b""
                lines = text.count(b"\n") + 1
                lost = 0
                if bitmap is not None:
                    mask = dropped(bitmap, lines)
                    lost = int(mask.sum())
                    text = b"\n".join(x for x, m in zip(text.split(b"\n"), mask.tolist(), strict=True) if not m)
                n_lines.append(lines)
                n_dropped.append(lost)
                out.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
            return [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(out, pa.string())]

        return work

    name = "kept_sha256" if digest else "kept_text"
    return appended(rows, "text", {c: F.col(f"_keep{i}") for i, c in enumerate(keep)}, f"n_lines long, n_dropped long, {name} string", make, also=["_bitmap"])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return apply_bitmaps(docs, line_bitmaps(docs), digest=True)


OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos FROM documents
),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
),
heavy AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT x.doc_id, x.pos, x.line, h.k IS NOT NULL AND x.doc_id <> h.last AS lost FROM keyed x LEFT JOIN heavy h ON x.k = h.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
