"""Vector compression: codebooks for the parts of vectors, by Lloyd rounds in integers with Hamerly's bounds.

Every part of a vector keeps an upper bound of the distance to its own entry and a lower bound of the distance to any other one. When
entries move, the bounds move by as much; only where the upper one is no longer strictly below the lower one is the own
distance taken anew, and only where that does not help are all entries compared, by exact integer distances, the lowest index first.
Bounds are rounded outwards, so a part that keeps its entry has no other one as near.

Plan. The kept vectors are stored once as integers. A round reads them with their codes and bounds, writes them with new ones (no
shuffle), and adds up the parts of each entry within tasks; what is shuffled is a row per task and entry. The driver holds the codebooks
only, whose size is that of ``k`` vectors. Each round's table is deleted when the next one is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import removed, table, written

ENTRIES, ROUNDS, PARTS, SCALE = 256, 4, 4, 1024
SLACK = 2.0**-50  # outward rounding of bounds
LOW_BITS = 24  # sums are kept in two numbers, of the low bits and of the others, so that they do not overflow
LARGEST = 1 << 62  # scaled components saturate here
HELD = 1 << 21  # distances that a task holds at a time
MOST_SENT = 100_000  # labels whose sums are broadcast; more are joined by merging
STATE = "vec_id long, label {label}, x array<long>, code array<int>, upper array<double>, lower array<double>, scanned int"


def exact(bound: int) -> type:
    """The numbers in which sums up to ``bound`` are exact."""
    return np.float64 if bound < 1 << 52 else np.int64 if bound < 1 << 62 else object


def largest(*arrays: np.ndarray) -> int:
    return max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``x`` to every entry."""
    kind = exact(4 * x.shape[1] * largest(x, entries) ** 2)
    a, b = x.astype(kind), entries.astype(kind)
    return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)


def own_squared(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row."""
    kind = exact(4 * x.shape[1] * largest(x, chosen) ** 2)
    off = x.astype(kind) - chosen.astype(kind)
    return (off * off).sum(axis=1)


def root(s: np.ndarray, sign: int) -> np.ndarray:
    """Square roots, rounded up (sign 1) or down (-1)."""
    return np.sqrt(s.astype(np.float64)) * (1 + sign * SLACK)


def scan(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest entry, upper bound, lower bound of the second nearest) of each row, by comparing all entries."""
    code, up, low = np.zeros(len(x), np.int32), np.zeros(len(x)), np.full(len(x), np.inf)
    step = max(1, HELD // (len(entries) + x.shape[1]))
    for i in range(0, len(x), step):
        s = squared(x[i : i + step], entries)
        code[i : i + step] = s.argmin(axis=1)
        up[i : i + step] = root(s.min(axis=1), 1)
        if len(entries) > 1:
            low[i : i + step] = root(np.partition(s.astype(np.float64), 1, axis=1)[:, 1], -1)
    return code, up, low


def reassigned(x: np.ndarray, code: np.ndarray, up: np.ndarray, low: np.ndarray, entries: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Codes and bounds after entries have moved by at most ``moves``, and the number of rows that compared all entries."""
    others = np.full(len(moves), moves.max(initial=0.0))
    if len(moves) > 1:
        others[moves.argmax()] = np.partition(moves, -2)[-2]
    code, up, low = code.copy(), (up + moves[code]) * (1 + SLACK), (low - others[code]) - (np.abs(low) + others[code]) * SLACK
    at = np.flatnonzero(~(up < low))
    if len(at):
        up[at] = root(own_squared(x[at], entries[code[at]]), 1)
        at = at[~(up[at] < low[at])]
    if len(at):
        code[at], up[at], low[at] = scan(x[at], entries)
    return code, up, low, len(at)


def _vectors(batch: pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(batch.num_rows, -1)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel(), kind))


def _assign(books: np.ndarray, moves: np.ndarray | None):
    """Rows of the state -> the same with the codes and bounds for ``books`` (part, entry, component)."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, HELD // max(1, books.shape[0] * books.shape[2]))
            for i in range(0, whole.num_rows, step):
                batch = whole.slice(i, step)
                x = _vectors(batch, "x", np.int64)
                width = x.shape[1] // parts
                code, up, low = np.zeros((len(x), parts), np.int32), np.zeros((len(x), parts)), np.zeros((len(x), parts))
                scanned = np.zeros(len(x), np.int32)
                old = None if moves is None else (_vectors(batch, "code", np.int32), _vectors(batch, "upper", np.float64), _vectors(batch, "lower", np.float64))
                for p in range(parts):
                    part = x[:, p * width : (p + 1) * width]
                    if old is None:
                        code[:, p], up[:, p], low[:, p] = scan(part, books[p])
                        n = len(x)
                    else:
                        code[:, p], up[:, p], low[:, p], n = reassigned(part, *(o[:, p] for o in old), books[p], moves[p])
                    scanned[0] += n
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("vec_id", "label", "x")), _lists(code, pa.int32()), _lists(up, pa.float64()), _lists(low, pa.float64()), pa.array(scanned)],
                    names=["vec_id", "label", "x", "code", "upper", "lower", "scanned"],
                )

    return run


def _sums(parts: int, k: int):
    """Rows (x, code) -> (part, entry, n, high, low), a row per task and entry in use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = high = low = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, code = _vectors(batch, "x", np.int64), _vectors(batch, "code", np.int32)
            width = x.shape[1] // parts
            if n is None:
                n, high, low = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64), np.zeros((parts, k, width), np.int64)
            for p in range(parts):
                order = np.argsort(code[:, p], kind="stable")
                entries, start = np.unique(code[order, p], return_index=True)
                values = x[order, p * width : (p + 1) * width]
                n[p, entries] += np.diff(np.r_[start, len(x)])
                high[p, entries] += np.add.reduceat(values >> LOW_BITS, start, axis=0)
                low[p, entries] += np.add.reduceat(values & ((1 << LOW_BITS) - 1), start, axis=0)
        if n is not None:
            part, entry = np.nonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry]), _lists(high[part, entry], pa.int64()), _lists(low[part, entry], pa.int64())],
                names=["part", "entry", "n", "high", "low"],
            )

    return run


def moved_books(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks with every used entry replaced by the floor of its parts' mean."""
    sums = state.select("x", "code").mapInArrow(_sums(len(books), books.shape[1]), "part int, entry int, n long, high array<long>, low array<long>")
    each = sums.select("part", "entry", "n", F.posexplode(F.arrays_zip("high", "low")).alias("at", "s"))
    totals = each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s.high").alias("high"), F.sum("s.low").alias("low"))
    out = books.copy()
    for part, entry, found in totals.groupBy("part", "entry").agg(F.sort_array(F.collect_list(F.struct("at", "n", "high", "low")))).collect():  # the size of the codebooks
        out[part, entry] = [((high << LOW_BITS) + low) // n for _, n, high, low in found]
    return out


class Compressed(NamedTuple):
    """``codes``: vec_id, label, code (array of indexes), error. ``books``: (part, entry, component). ``scanned``: parts that compared all entries, by round."""

    codes: DataFrame
    books: np.ndarray
    scanned: list[int]


def integers(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    v = F.col(f"`{vector_col}`").cast("array<double>")
    scaled = F.transform(v, lambda x: F.greatest(F.least(F.floor(x * scale), F.lit(LARGEST)), F.lit(-LARGEST)))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(v.isNotNull() & fine).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), scaled.alias("x"))


def _errors(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, code = _vectors(batch, "x", np.int64), _vectors(batch, "code", np.int32)
            width = x.shape[1] // len(books)
            error = [0] * len(x)
            for p in range(len(books)):
                error = [a + int(b) for a, b in zip(error, own_squared(x[:, p * width : (p + 1) * width], books[p][code[:, p]]), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "label", "code")), pa.array([min(e, (1 << 63) - 1) for e in error], pa.int64())], names=["vec_id", "label", "code", "error"])

    return run


def compress(
    vectors: DataFrame, k: int = ENTRIES, rounds: int = ROUNDS, parts: int = PARTS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> Compressed:
    """Codes of the vectors, and the codebooks.

    Components become floor(scale * x). A codebook starts as its part of the ``k`` smallest ids' vectors (all of them where there are fewer;
    null ids last, rows that repeat an id by their components). ``rounds`` times every part takes the nearest entry (squared Euclidean
    distance, ties to the lower index) and used entries move to floor(sum / count); then parts are assigned once more. ``error`` is
    the sum of the final squared distances. Dropped are rows whose vector is null, empty or has null or non-finite components, and those
    whose length is not that of the first kept id's vector; that length has to be a multiple of ``parts``, else no row is kept. Rows that
    repeat an id are all returned. Scaled components beyond 2^62, and errors beyond 2^63, saturate there. An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    label = vectors.select(F.col(f"`{label_col}`")).schema[0].dataType.simpleString()
    fit = integers(vectors, scale, id_col, vector_col, label_col).where((F.size("x") > 0) & (F.size("x") % parts == 0))
    order = [F.col("vec_id").asc_nulls_last(), "x"]
    state, path = written(fit, "vectors")
    first = state.orderBy(*order).select(F.size("x")).first()
    if first is None:
        return Compressed(state.select("vec_id", "label", F.array().cast("array<int>").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64), [])
    state = state.where(F.size("x") == first[0])
    start = np.array([r[0] for r in state.orderBy(*order).select("x").limit(k).collect()], np.int64)  # k vectors
    books = start.reshape(len(start), parts, -1).transpose(1, 0, 2).copy()
    moves, scanned = None, []
    for i in range(rounds + 1):
        state, new = written(state.mapInArrow(_assign(books, moves), STATE.format(label=label)), f"round{i}")
        removed(spark, path)
        path = new
        scanned.append(state.agg(F.sum("scanned")).first()[0])
        if i < rounds:
            old, books = books, moved_books(state, books)
            moves = np.stack([root(own_squared(a, b), 1) for a, b in zip(old, books, strict=True)])
    return Compressed(state.mapInArrow(_errors(books), f"vec_id long, label {label}, code array<int>, error long"), books, scanned)


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def hex_code(code: Column, entries: int) -> Column:
    width = max(2, len(f"{max(entries - 1, 0):x}"))
    return F.array_join(F.transform(code, lambda c: F.lower(F.lpad(F.hex(c), width, "0"))), "")


def digest(found: Compressed) -> DataFrame:
    """vec_id, code (hexadecimal digits), error, label_error (sum over equal labels, nulls together), codebooks_sha256."""
    sums = found.codes.groupBy(F.col("label").alias("_label")).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1)).cast("long").alias("label_error"))
    sums = written(sums, "labels")[0]
    sums = F.broadcast(sums) if sums.count() <= MOST_SENT else sums.hint("merge")
    out = found.codes.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", hex_code(F.col("code"), found.books.shape[1]).alias("code"), "error", "label_error", F.lit(books_sha256(found.books)).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(compress(table(spark, sf_dir, "embeddings")))


def _round_sql(i: int) -> str:
    """The codes of round ``i``, and the codebooks after it."""
    return f"""
near{i} AS (
  SELECT vec_id, p, arg_min(j, s * 256 + j) AS j, min(s) AS s
  FROM (SELECT x.vec_id, x.p, b.j, sum((x.v - b.v) * (x.v - b.v))::BIGINT AS s FROM x JOIN book{i} b ON x.p = b.p AND x.d = b.d GROUP BY ALL) GROUP BY ALL
),
mean{i} AS (SELECT x.p, n.j, x.d, floor(sum(x.v)::DOUBLE / count(*))::BIGINT AS v FROM x JOIN near{i} n ON x.vec_id = n.vec_id AND x.p = n.p GROUP BY ALL),
book{i + 1} AS (SELECT b.p, b.j, b.d, coalesce(m.v, b.v) AS v FROM book{i} b LEFT JOIN mean{i} m ON b.p = m.p AND b.j = m.j AND b.d = m.d),"""


OP11_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, embedding AS e, len(embedding) // 4 AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
x AS (
  SELECT vec_id, (i - 1) // w AS p, (i - 1) % w AS d, floor(1024 * e[i]::DOUBLE)::BIGINT AS v FROM (SELECT vec_id, e, w, unnest(range(1, len(e) + 1)) AS i FROM kept)
),
starts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS j FROM kept ORDER BY vec_id LIMIT 256),
book0 AS (SELECT x.p, starts.j, x.d, x.v FROM x JOIN starts ON x.vec_id = starts.vec_id),{"".join(_round_sql(i) for i in range(ROUNDS + 1))}
coded AS (SELECT vec_id, string_agg(lpad(lower(to_hex(j)), 2, '0'), '' ORDER BY p) AS code, sum(s)::BIGINT AS error FROM near{ROUNDS} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, j, d)) AS sha FROM book{ROUNDS})
SELECT c.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error, books.sha AS codebooks_sha256
FROM coded c JOIN kept k ON c.vec_id = k.vec_id CROSS JOIN books
"""
