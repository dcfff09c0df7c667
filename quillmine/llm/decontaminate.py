"""Benchmark decontamination by suffix arrays over the training texts.

Plan. Every task takes its own rows as shards: it numbers their words by the vocabulary of the benchmark (any
other word is 0 and matches nothing), sorts the suffixes into a suffix array and binary-searches all benchmark
suffixes in it at once. Suffixes whose first words do not occur together anywhere in the benchmark are left out of
the array, as no match can begin there. Nothing is shuffled and no key exists that could be hot. The benchmark
is broadcast in blocks of bounded size, one at a time: a pass against all shards is written before the next block is fetched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alnum_words, appended, carried, pieces, removed, saved, stored, table, texts, written

WINDOW = 13
BLOCK_BYTES = 16 << 20


class Vocabulary(dict):
    """Word -> number from 1; words outside get 0."""

    def __missing__(self, word: bytes) -> int:
        return 0


class Benchmark:
    """The items of one block: all their suffixes, as numbers, and what of each is a window's start."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int = WINDOW):
        self.vocabulary = Vocabulary()
        words, starts, ends, owner = [], [], [], []
        self.item_ids: list[int | None] = []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in alnum_words(text or b"")]
            if ids:
                starts += range(len(words), len(words) + len(ids))
                words += ids
                ends += [len(words)] * len(ids)
                owner += [len(self.item_ids)] * len(ids)
                self.item_ids.append(item_id)
        self.words = np.array(words, np.int64)
        self.starts, self.owner = np.array(starts, np.int64), np.array(owner, np.int64)
        self.room = np.array(ends, np.int64) - self.starts  # words from a suffix's start to its item's end
        first = np.r_[True, self.owner[1:] != self.owner[:-1]] if words else np.zeros(0, bool)
        #: Length of the window that starts here; 0 where none does.
        self.window = np.where(self.room >= window, window, np.where(first, self.room, 0))
        self.depth = int(self.room.max(initial=0))
        #: Leading words that a suffix of the array must share with some item: as many as the shortest window, three at most.
        self.lead = int(min(3, self.window[self.window > 0].min(initial=3)))
        span = len(self.vocabulary) + 1
        self.weights = [span**k for k in range(self.lead)][::-1]  # 3 * 21 bits: numbers stay below 2 ** 21
        enough = self.starts[self.room >= self.lead]
        self.leads = np.unique(sum(w * self.words[enough + k] for k, w in enumerate(self.weights))) if words else np.zeros(0, np.int64)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self._slot(self.leads)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def candidates(self, ids: np.ndarray) -> np.ndarray:
        """Positions in ``ids`` at which some item's leading words stand."""
        n = len(ids) - self.lead + 1
        if n <= 0 or not len(self.leads):
            return np.zeros(0, np.int64)
        codes = sum(w * ids[k : n + k] for k, w in enumerate(self.weights))
        at = np.flatnonzero(self.bits[self._slot(codes)])
        found = np.searchsorted(self.leads, codes[at])
        return at[self.leads[np.minimum(found, len(self.leads) - 1)] == codes[at]]


def suffix_array(words: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    """``positions`` in the order of their suffixes' first ``depth`` words: groups of equal prefixes are refined word by word.

    ``words`` must be followed by at least ``depth`` zeros' worth of room, or end in 0 (reads are clipped to the last).
    """
    order = positions[np.argsort(words[positions], kind="stable")]
    last = len(words) - 1
    group = np.r_[0, np.cumsum(np.diff(words[order]) != 0)] if len(order) else np.zeros(0, np.int64)
    live = np.arange(len(order))
    for d in range(1, depth):
        if not len(live):
            break
        same = np.diff(group[live]) == 0  # alone in its group: in place already
        live = live[np.r_[same, False] | np.r_[False, same]]
        if not len(live):
            break
        next_word = words[np.minimum(order[live] + d, last)]
        by = np.lexsort((next_word, group[live]))
        order[live], next_word, old = order[live][by], next_word[by], group[live][by]
        group[live] = np.r_[0, np.cumsum((np.diff(old) != 0) | (np.diff(next_word) != 0))]
        live = live[next_word != 0]  # ended: the rest of it matches nothing
    return order


def search(words: np.ndarray, array: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each benchmark suffix: length of its longest match, a suffix-array slot with it, and the slots [low, high) of its window.

    All suffixes are searched together; each word narrows the slots by two bisections.
    """
    n = len(bench.starts)
    longest, slot, low, high = (np.zeros(n, np.int64) for _ in range(4))
    live, lo, hi = np.arange(n), np.zeros(n, np.int64), np.full(n, len(array), np.int64)
    last = len(words) - 1

    def bound(want: np.ndarray, lo: np.ndarray, hi: np.ndarray, d: int, upper: bool) -> np.ndarray:
        lo, hi = lo.copy(), hi.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            here = words[np.minimum(array[np.minimum(mid, len(array) - 1)] + d, last)]
            right = open_ & ((here <= want) if upper else (here < want))
            lo, hi = np.where(right, mid + 1, lo), np.where(open_ & ~right, mid, hi)
        return lo

    for d in range(bench.depth):
        keep = bench.room[live] > d
        live, lo, hi = live[keep], lo[keep], hi[keep]
        want = bench.words[bench.starts[live] + d]
        lo, hi = bound(want, lo, hi, d, False), bound(want, lo, hi, d, True)
        keep = lo < hi
        live, lo, hi = live[keep], lo[keep], hi[keep]
        if not len(live):
            break
        longest[live], slot[live] = d + 1, lo
        whole = bench.window[live] == d + 1
        low[live[whole]], high[live[whole]] = lo[whole], hi[whole]
    return longest, slot, low, high


def ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the range, number in it) for all numbers of all ranges."""
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[which]


class Shard:
    """The texts of one slice of a partition, as one sequence of numbers; texts are separated by zeros."""

    def __init__(self, found: list[bytes | None], bench: Benchmark):
        number, self.n_words, parts = bench.vocabulary.__getitem__, [], []
        for text in found:
            words = alnum_words(text) if text else []
            self.n_words.append(len(words))
            parts.append(np.fromiter(map(number, words), np.int64, len(words)))
            parts.append(np.zeros(1, np.int64))
        self.ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.starts = np.cumsum([0, *(n + 1 for n in self.n_words)])[:-1]
        self.array = suffix_array(self.ids, bench.candidates(self.ids), bench.depth)
        self.longest, self.slot, self.low, self.high = search(self.ids, self.array, bench)

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1


COLUMNS = "n_words long, n_hit long, items array<long>, hit_words binary"


def _hits(block: Broadcast, window: int):
    """Adds what the windows of one block hit to what earlier blocks hit, if any."""

    def make():
        bench = Benchmark(block.value, window)

        def work(found: list[bytes | None], *before: pa.Array) -> list[pa.Array]:
            shard = Shard(found, bench)
            which, slots = ranges(shard.low, shard.high)
            at = shard.array[slots]
            edges = np.bincount(at, minlength=len(shard.ids) + 1) - np.bincount(at + bench.window[which], minlength=len(shard.ids) + 1)
            hit = np.cumsum(edges) > 0
            pairs = np.unique(np.c_[shard.document(at), bench.owner[which]], axis=0)
            items = [set() for _ in found]
            for doc, item in pairs.tolist():
                items[doc].add(bench.item_ids[item])
            masks = [hit[s : s + n] for s, n in zip(shard.starts.tolist(), shard.n_words, strict=True)]
            if before:
                masks = [m | np.unpackbits(np.frombuffer(b, np.uint8), count=len(m)).astype(bool) for m, b in zip(masks, before[1].to_pylist(), strict=True)]
                items = [a | set(b) for a, b in zip(items, before[0].to_pylist(), strict=True)]
            listed = [sorted(x, key=lambda k: (k is None, k)) for x in items]
            return [
                pa.array(shard.n_words, pa.int64()),
                pa.array([int(m.sum()) for m in masks], pa.int64()),
                pa.array(listed, pa.list_(pa.int64())),
                pa.array([np.packbits(m).tobytes() for m in masks], pa.binary()),
            ]

        return work

    return make


def numbered(benchmark: DataFrame, id_col: str, text_col: str, max_bytes: int) -> tuple[DataFrame, int]:
    """(item_id, text, block) of the items with a text, and the number of blocks (1 at least): of ``max_bytes`` at most, or one item.

    One task deals a benchmark of several blocks, as a stream; nothing of it comes to the driver here.
    """
    items = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text != ''")
    if (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) <= max_bytes:
        return items.withColumn("block", F.lit(0)), 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = 0, 0
        for batch in pieces(batches, "text", max_bytes):
            of = []
            for n in pc.binary_length(batch.column(1)).to_pylist():
                if size and size + n > max_bytes:
                    block, size = block + 1, 0
                size += n
                of.append(block)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of, pa.int32())], names=["item_id", "text", "block"])

    items = saved(items.coalesce(1).mapInArrow(run, "item_id long, text string, block int"))
    return items, items.agg(F.max("block")).first()[0] + 1


def sent(items: DataFrame, block: int) -> Broadcast:
    """One block of the benchmark, broadcast; the driver keeps none of it."""
    found = items.where(F.col("block") == block).select("item_id", "text").toArrow()
    rows = list(zip(found.column(0).to_pylist(), found.column(1).cast(pa.binary()).to_pylist(), strict=True))
    return items.sparkSession.sparkContext.broadcast(rows)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    share: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    carry: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted ids with occurring windows), hit_words (a bit per word),
    contaminated, and ``carry`` as the struct carried.

    A window is ``window`` consecutive words of an item, or the whole of a shorter one; a word inside any occurrence
    is hit; contaminated means n_hit > 0 and share * n_hit >= n_words. Null and empty texts, of documents or items, have no
    words, hit nothing and are hit by nothing. Repeated documents are judged one by one; items with equal texts all
    count. An empty benchmark hits nothing, and an empty table gives no rows. Very long texts are shards of their own. A benchmark of one block
    (the usual case) needs one pass without a shuffle. With more blocks, each pass is written, texts included, and adds to the one before by
    hit word, per document; no two blocks are held at a time.
    """
    out, text, keep = docs, text_col, carried(id_col, carry)
    items, n = numbered(benchmark, item_col, item_text_col, block_bytes)
    before = None
    for k in range(n):
        block, last = sent(items, k), k + 1 == n
        more = {} if last else {"_text": F.col(f"`{text}`")}
        out = appended(out, text, keep | more, COLUMNS, _hits(block, window), also=["items", "hit_words"] if k else [])
        if not last:
            out, path = written(out, f"hits{k}")
            block.unpersist(blocking=True)
            if before:  # the pass that this one has read
                removed(docs.sparkSession, before)
            before = path
        text, keep = "_text", {c: F.col(c) for c in keep}
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per benchmark suffix with a match of at least the array's leading words: item_id, item_word (its start),
    n_words (the longest verbatim match), doc_id, doc_word (the place of one, the smallest doc_id's first).

    Each task searches its shards and passes on one row per suffix; the longest is taken over all of them.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found, best = None, F.max_by(F.struct("n_words", "doc_id", "doc_word"), F.struct(F.col("n_words"), -F.col("doc_id"), -F.col("doc_word"))).alias("best")
    items, n = numbered(benchmark, item_col, item_text_col, block_bytes)
    for k in range(n):
        block = sent(items, k)

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            bench = Benchmark(block.value)
            offset = np.arange(len(bench.starts)) - np.searchsorted(bench.owner, bench.owner)
            for batch in pieces(batches, "text", 16 << 20):
                shard = Shard(texts(batch, "text"), bench)
                hit = np.flatnonzero(shard.longest >= bench.lead)
                at = shard.array[shard.slot[hit]]
                doc = shard.document(at)
                ids = batch.column(0).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bench.item_ids[i] for i in bench.owner[hit].tolist()], pa.int64()),
                        pa.array(offset[hit]),
                        pa.array(shard.longest[hit]),
                        ids,
                        pa.array(at - shard.starts[doc]),
                    ],
                    names=["item_id", "item_word", "n_words", "doc_id", "doc_word"],
                )

        part = rows.mapInArrow(run, "item_id long, item_word long, n_words long, doc_id long, doc_word long")
        part = part.groupBy("item_id", "item_word").agg(best).select("item_id", "item_word", "best.*")
        if n > 1:
            part = stored(part, f"matches{k}")
            block.unpersist(blocking=True)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("item_id", "item_word").agg(best).select("item_id", "item_word", "best.*")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names.cast("binary"), 256).alias("items_sha256"), "contaminated")


OP4_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, n, win FROM (
    SELECT id AS item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i : array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS win
    FROM words WHERE kind = 'b' AND len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT id AS doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i : array_to_string(w[i:i + n - 1], ' '))) AS win
  FROM words, lengths WHERE kind = 'd' AND len(w) >= n
),
found AS (SELECT g.doc_id, g.i, g.n, t.item_id FROM grams g JOIN windows t ON g.win = t.win AND g.n = t.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS item FROM found) GROUP BY doc_id)
SELECT d.id AS doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM words d LEFT JOIN hit h ON h.doc_id = d.id LEFT JOIN items t ON t.doc_id = d.id WHERE d.kind = 'd'
"""


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, all columns as they were.

    Null and empty texts are not. Rows are judged one by one, repeated ones alike. An empty table stays empty, and a benchmark without
    words keeps all. Names of columns do not matter: only ``doc_id`` and ``text`` are read.
    """
    out = contamination(docs, table(spark, sf_dir, "benchmark"), carry=docs.columns)
    return out.where(~F.col("contaminated")).select("carried.*")
