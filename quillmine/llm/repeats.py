"""Substring deduplication: windows of words that start more than once, counted in buckets of their minimisers.

A window's minimiser is the smallest hash among its sequences of ``MINIMISER`` words, at its first place. Consecutive windows that share
it are a super-k-mer: one packed string of their words, a few dozen more than there are windows. Equal windows have equal minimisers at
different places, so they meet in one bucket as parts of two strings, where windows are sorted by a rolling hash and compared word by word.

Plan. (1) One pass makes (minimiser, document, place) of each super-k-mer, without text; those whose minimiser occurs only once
hold no window that occurs twice, and stay at home. (2) Documents are joined with the places of the others, and these travel as packed
strings; equal strings of one piece of documents travel once, with all their places. A minimiser of very many super-k-mers has
several buckets, so no group grows with the data. (3) A bucket tells which windows repeat. What is alone in its bucket, but whose minimiser
has several, is counted once more by a 128-bit fingerprint. (4) Places that are covered are gathered by document and joined to the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import appended, carried, freed, pieces, removed, saved, table, texts, written
from .line_dedup import versions
from .near_dedup import mixed

WINDOW = 35
MINIMISER = 8
BUCKET = 1 << 13  # super-k-mers of one minimiser that share a bucket
PIECE = 4 << 20  # bytes of text that a task takes apart at a time
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out, have = np.minimum(out[:-step], out[step:]), have + step
    return out


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive numbers: the sum of h[i + j] * STEP^j."""
    powers = np.full(len(h), STEP)
    powers[:1] = 1
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(h * np.cumprod(powers))]
    back = np.full(len(h) - width + 1, BACK)
    back[0] = 1
    return mixed((sums[width:] - sums[:-width]) * np.cumprod(back))


def super_kmers(found: list[bytes | None], window: int, minimiser: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts' words: (words, where each text begins, and for each super-k-mer: text, place of its first window, windows, minimiser)."""
    words, begins = [], np.zeros(len(found) + 1, np.int64)
    for i, text in enumerate(found):
        if text:
            words += text.split()
        begins[i + 1] = len(words)
    if len(words) < window:
        none = np.zeros(0, np.int64)
        return words, begins, none, none, none, none.astype(np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    each = rolling(h, minimiser)
    low = sliding_min(each, window - minimiser + 1)
    text = np.repeat(np.arange(len(found)), np.diff(begins))
    at = np.flatnonzero(text[: len(low)] == text[window - 1 :])
    low = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (low[1:] != low[:-1]) | (np.diff(at) != 1) | (each[at[:-1]] == low[:-1])  # another minimiser, or another place of it
    first = np.flatnonzero(new)
    return words, begins, text[at[first]], at[first] - begins[text[at[first]]], np.diff(np.r_[first, len(at)]), low[first]


def _places(window: int, minimiser: int):
    """Rows (doc_id, version, text) -> (doc_id, version, minimiser, at), one for each super-k-mer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            _, _, text, at, _, low = super_kmers(texts(batch, "text"), window, minimiser)
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(low.view(np.int64)), pa.array(at.astype(np.int32))], names=["doc_id", "version", "minimiser", "at"])

    return run


def _packed(window: int, minimiser: int):
    """Rows (doc_id, version, text, shared (at, buckets)) -> packed super-k-mers with all their places in the piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            wanted = [{s["at"]: s["buckets"] for s in of} for of in batch.column(3).to_pylist()]
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words, begins, text, at, windows, low = super_kmers(texts(batch, "text"), window, minimiser)
            own: dict[bytes, list] = {}
            for t, a, n, m in zip(text.tolist(), at.tolist(), windows.tolist(), low.view(np.int64).tolist(), strict=True):
                if (buckets := wanted[t].get(a)) is not None:
                    start = begins[t] + a
                    packed = b" ".join(words[start : start + n + window - 1])
                    if packed not in own:
                        bucket = xxhash.xxh3_64_intdigest(f"{marks[t]}:{a}".encode()) % buckets if buckets > 1 else 0
                        own[packed] = [m, bucket, buckets > 1, [], [], []]
                    for held, value in zip(own[packed][3:], (ids[t], marks[t], a), strict=True):
                        held.append(value)
            columns = list(zip(*own.values(), strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), pa.array(list(own), pa.binary())], names=["minimiser", "bucket", "several", "doc_ids", "versions", "ats", "words"])

    return run


def window_classes(codes: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """A number for each window (its first word's place in ``codes``): equal for equal windows."""
    key = rolling(mixed(codes.astype(np.uint64) + np.uint64(1)), window)[at]
    order = np.argsort(key, kind="stable")
    a, b = at[order[:-1]], at[order[1:]]
    meet = np.flatnonzero(key[order[:-1]] == key[order[1:]])
    same = np.ones(len(meet), bool)
    for j in range(window):
        same &= codes[a[meet] + j] == codes[b[meet] + j]
    if not same.all():  # different windows with one hash: all windows are sorted by their words
        return np.unique(codes[at[:, None] + np.arange(window)], axis=0, return_inverse=True)[1].ravel()
    new = np.ones(len(at), bool)
    new[1 + meet] = False
    out = np.empty(len(at), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


FOUND = "doc_id long, version long, at int, n int, fingerprint binary, weight int"


def _repeated(window: int):
    """Packed super-k-mers sorted by bucket -> places of repeated windows (at, n); for minimisers of several buckets also windows by fingerprint."""

    def decided(held: list[tuple]) -> Iterator[tuple]:
        strings = [r[-1] for r in held]
        sizes = np.array([s.count(b" ") + 1 for s in strings])
        ends = np.cumsum(sizes)
        words = b" ".join(strings).split(b" ")
        codes = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy()
        row = np.repeat(np.arange(len(held)), sizes)
        at = np.flatnonzero(row[: len(row) - window + 1] == row[window - 1 :])
        of, row = window_classes(codes, at, window), row[at]
        times = np.zeros(of.max() + 1, np.int64)
        np.add.at(times, of, np.array([len(r[3]) for r in held])[row])
        twice = times[of] > 1
        place = at - (ends - sizes)[row]

        begins = np.flatnonzero(twice & ~np.r_[False, twice[:-1] & (np.diff(at) == 1)])
        stops = np.flatnonzero(twice & ~np.r_[twice[1:] & (np.diff(at) == 1), False])
        for i, j in zip(begins.tolist(), stops.tolist(), strict=True):
            for doc_id, version, first in {*zip(*held[row[i]][3:6], strict=True)}:
                yield doc_id, version, first + int(place[i]), j - i + 1, None, 0
        told = set()
        for i in np.flatnonzero(np.array([r[2] for r in held])[row]).tolist():
            if twice[i] and of[i] in told:
                continue
            print_ = xxhash.xxh3_128_digest(b" ".join(words[at[i] : at[i] + window]))
            if twice[i]:
                told.add(of[i])
                yield None, None, 0, 0, print_, 2
            else:
                doc_ids, marks, firsts = held[row[i]][3:6]
                yield doc_ids[0], marks[0], firsts[0] + int(place[i]), 1, print_, 1

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=["doc_id", "version", "at", "n", "fingerprint", "weight"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[:2] != key and size > PIECE:
                    if found := list(decided(held)):
                        yield rows(found)
                    held, size = [], 0
                key = r[:2]
                held.append(r)
                size += len(r[-1])
        if held and (found := list(decided(held))):
            yield rows(found)

    return run


def _shared(docs: DataFrame, window: int, minimiser: int, id_col: str, text_col: str, bucket: int) -> DataFrame:
    """(_id, _version, _shared): the places of a document's super-k-mers whose minimiser occurs again, with the number of its buckets."""
    places, path = written(versions(docs, id_col, text_col).mapInArrow(_places(window, minimiser), "doc_id long, version long, minimiser long, at int"), "places")
    often = places.groupBy("minimiser").agg(F.count("*").alias("_n")).where("_n > 1").select("minimiser", F.ceil(F.col("_n") / bucket).cast("int").alias("buckets"))
    often = saved(often)  # joined by an exchange of its own, which Spark can split where a minimiser is very frequent
    out = saved(places.join(often.hint("merge"), "minimiser").groupBy(F.col("doc_id").alias("_id"), F.col("version").alias("_version")).agg(F.collect_set(F.struct("at", "buckets")).alias("_shared")))
    removed(docs.sparkSession, path)
    return out


def _found(docs: DataFrame, shared: DataFrame, window: int, minimiser: int, id_col: str, text_col: str) -> DataFrame:
    """What the buckets have found, as rows of ``FOUND``."""
    rows = versions(docs, id_col, text_col).join(shared.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version")))
    packed = rows.select("doc_id", "version", "text", "_shared").mapInArrow(_packed(window, minimiser), "minimiser long, bucket int, several boolean, doc_ids array<long>, versions array<long>, ats array<int>, words binary")
    return saved(packed.repartition("minimiser", "bucket").sortWithinPartitions("minimiser", "bucket").mapInArrow(_repeated(window), FOUND))


def repeated_windows(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """One row per document with repeated windows: doc_id, version (a hash of the text), repeats: the set of (at, n), n windows from word ``at``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a window is ``window`` consecutive words of one document, and repeats if its words also
    start anywhere else, in the same document or another one. Null and empty texts, and texts of fewer words, have no windows. Rows that
    repeat an id are documents of their own, as are rows without id, so a text that comes twice repeats itself.
    Very long texts are taken whole. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    shared = _shared(docs, window, minimiser, id_col, text_col, bucket)
    freed(spark)
    found = _found(docs, shared, window, minimiser, id_col, text_col)
    freed(spark)
    open_ = found.where("fingerprint is not null")
    heavy = open_.groupBy("fingerprint").agg(F.sum("weight").alias("_times")).where("_times > 1").select("fingerprint")
    late = open_.where("n > 0").join(heavy.hint("merge"), "fingerprint")
    marks = found.where("fingerprint is null").select("doc_id", "version", "at", "n").unionByName(late.select("doc_id", "version", "at", "n"))
    return marks.groupBy("doc_id", "version").agg(F.collect_set(F.struct("at", "n")).alias("repeats"))


def without_repeats(docs: DataFrame, repeats: DataFrame, window: int = WINDOW, digest: bool = False, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (``digest``: kept_sha256), and ``carry`` as the struct carried.

    ``repeats`` are those of ``repeated_windows`` for the same rows. Every word of a repeated window is removed; the others are joined by one space.
    Null and empty texts have no words, and the empty text is kept of them; rows that repeat an id are all returned.
    """
    keep = carried(id_col, carry)
    rows = versions(docs, id_col, text_col, **{f"_keep{i}": c for i, c in enumerate(keep.values())})
    marks = repeats.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.col("repeats").alias("_repeats"))
    rows = rows.join(marks.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version")), "left")

    def make():
        def work(found: list[bytes | None], marks: pa.Array) -> list[pa.Array]:
            n_words, n_removed, out = [], [], []
            for text, spans in zip(found, marks.to_pylist(), strict=True):
                words = text.split() if text else []
                n_words.append(len(words))
                if spans:
                    stays = np.ones(len(words), bool)
                    for s in spans:
                        stays[s["at"] : s["at"] + s["n"] + window - 1] = False
                    words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                n_removed.append(n_words[-1] - len(words))
                kept = b" ".join(words)
                out.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
            return [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(out, pa.string())]

        return work

    name = "kept_sha256" if digest else "kept_text"
    return appended(rows, "text", {c: F.col(f"_keep{i}") for i, c in enumerate(keep)}, f"n_words long, n_removed long, {name} string", make, also=["_repeats"])


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return without_repeats(docs, repeated_windows(docs), digest=True)


OP13_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words)),
often AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows SEMI JOIN often USING (k)),
each AS (SELECT doc_id, w[i] AS word, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM each ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT x.doc_id, len(x.w)::BIGINT AS n_words, (len(x.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words x LEFT JOIN kept k ON x.doc_id = k.doc_id
"""
