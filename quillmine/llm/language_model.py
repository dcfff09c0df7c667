"""Language-model scoring by cross-entropy difference: a target and a background n-gram model over one vocabulary.

Plan. Counts of all words and all pairs of words, without a limit on either, and no table of them that any task or the driver would hold:
(1) Texts are dealt into pieces of bounded size by a hash of their ids, together with the ids of the target: one shuffle of texts.
(2) A piece asks for the totals of its distinct codes (64-bit hashes of words and pairs): one sorted, packed row for each range of codes,
with its own counts. (3) The task that has a range adds up the counts of all pieces and answers each row, in the order asked. (4) Answers
meet the piece's texts again, and each token gets its loss in both models. A word that stands in every text is one entry of each piece, so
no key is hot; what is shuffled is proportional to the texts.

A piece sends ``MOST_RANGES`` rows at most, so rows that are shuffled grow with the number of pieces, not with its square. Ranges of a
larger corpus are cut into parts by the task that has them: rows become a row per part that they touch (never more than entries), which a sort
within the task, able to spill, brings together; answers of the parts are packed into rows again before they leave.

A document is scored by models that have not seen it: its own counts are taken off the background's, and off the target's where it
belongs to that. Both models interpolate pair, word and uniform probabilities with the same weights, so that a difference in loss is a
difference in counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import alnum_words, carried, table, texts
from .quality import held_out

WEIGHTS = (0.6, 0.35, 0.05)  # of pairs, words, and the uniform distribution
TYPES = 1 << 24  # word types of the uniform distribution
PIECE_BYTES = 8 << 20  # text of a piece, about; twice as much at most, or one text
RANGE_BYTES = 8 << 20  # text for each part of a range of codes
MOST_RANGES = 1024  # rows that a piece sends: about a thousand codes in each, or more
TASK_BYTES = 1 << 30  # text for each task, which goes through it piece by piece, or range by range
ROW_BYTES = 64  # what a row counts beside its text
TOTAL = 0  # the code under which all words are counted; no word or pair has it


def coded(found: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes of all words, codes of the pairs that they end, document of each word); a text's first word ends no pair: TOTAL."""
    of, sizes, parts = xxhash.xxh3_64_intdigest, [], [np.zeros(0, np.uint64)]
    for text in found:
        words = alnum_words(text) if text else []
        sizes.append(len(words))
        parts.append(np.fromiter(map(of, words), np.uint64, len(words)))
    word = np.maximum(np.concatenate(parts), np.uint64(1))
    doc = np.repeat(np.arange(len(sizes)), sizes)
    x = np.r_[np.uint64(0), word[:-1]][: len(word)] * np.uint64(0x9E3779B97F4A7C15) + word
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    pair = np.maximum(x ^ (x >> np.uint64(32)), np.uint64(1))
    pair[np.r_[True, doc[1:] != doc[:-1]][: len(doc)]] = TOTAL
    return word, pair, doc


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte plane by byte plane, compressed."""
    planes = (np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(body: bytes, k: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8).reshape(k, 8, -1)
    return [np.ascontiguousarray(x.T).view("<u8").ravel() for x in raw]


def whole_pieces(batches: Iterator[pa.RecordBatch], pieces: int, most: int) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Rows (piece, is_doc, id, text, ...) sorted by the first three -> (number, rows from text on, which are of the target).

    A piece of more than ``most`` bytes, ``ROW_BYTES`` for each row among them, is cut, row by row, so that cuts don't depend on how rows are batched.
    """
    key, cut, size, ids, held = None, 0, 0, set(), []

    def done():
        rows = pa.Table.from_batches(b for b, _ in held).combine_chunks().to_batches()[0]
        return key + cut * pieces, rows.drop_columns(["piece", "is_doc", "id"]), np.concatenate([f for _, f in held])

    for batch in batches:
        start, flags = 0, []
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0).to_pylist()
        for i, (piece, is_doc, id_, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), lengths, strict=True)):
            if piece != key or not is_doc or (size and size + n + ROW_BYTES > most):
                if i > start:
                    held.append((batch.slice(start, i - start), np.array(flags, bool)))
                if piece != key:
                    if held:
                        yield done()
                    key, cut, size, ids, held = piece, 0, 0, set(), []
                elif is_doc:
                    yield done()
                    cut, size, held = cut + 1, 0, []
                start, flags = i, []
            if not is_doc:
                ids.add(id_)
                start = i + 1
                continue
            size += n + ROW_BYTES
            flags.append(id_ in ids)
        if batch.num_rows > start:
            held.append((batch.slice(start), np.array(flags, bool)))
    if held:
        yield done()


def _asked(pieces: int, most: int, ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, rows, target in whole_pieces(batches, pieces, most):
            word, pair, doc = coded(texts(rows, "text"))
            of_target = target[doc]
            # TOTAL, under which first words have fallen among the pairs, gets the number of words.
            codes, n = np.unique(np.concatenate([[np.uint64(TOTAL)], word, pair]), return_counts=True)
            theirs, n_theirs = np.unique(np.concatenate([word[of_target], pair[of_target]]), return_counts=True)
            n_target = np.zeros(len(codes), np.int64)
            n_target[np.searchsorted(codes, theirs)] = n_theirs
            n[0], n_target[0] = len(word), of_target.sum()
            bounds = np.searchsorted((codes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1))
            at = np.flatnonzero(np.diff(bounds))
            bodies = [packed(np.diff(codes[a:b], prepend=np.uint64(0)), n[a:b], n_target[a:b]) for a, b in zip(bounds[at].tolist(), bounds[at + 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([piece] * len(at), pa.int64()), pa.array(at, pa.int64()), pa.array(bodies, pa.binary())], names=["piece", "at", "body"])

    return run


def _parted(ranges: int, parts: int):
    """Rows of ``_asked`` -> a row per part of a range that they touch; ``at`` is then the part's number among all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, at, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes, *counts = unpacked(body, 3)
                codes = np.cumsum(codes, dtype=np.uint64)
                # Where a code stands in its range, of 2^32 places; ranges are cut by the high half of codes, see ``_asked``.
                within = (codes >> np.uint64(32)) * np.uint64(ranges) & np.uint64(0xFFFFFFFF)
                bounds = np.searchsorted(within * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1))
                some = np.flatnonzero(np.diff(bounds))
                bodies = [packed(np.diff(codes[a:b], prepend=np.uint64(0)), *(c[a:b] for c in counts)) for a, b in zip(bounds[some].tolist(), bounds[some + 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([piece] * len(some), pa.int64()), pa.array(at * parts + some, pa.int64()), pa.array(bodies, pa.binary())], names=["piece", "at", "body"])

    return run


def _joined(parts: int):
    """Answers of parts, sorted by piece and part -> a row per piece and range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done():
            body = packed(*map(np.concatenate, zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([body], pa.binary())], names=["piece", "at", "body"])

        for batch in batches:
            for piece, at, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (piece, at // parts) != key:
                    if held:
                        yield done()
                    key, held = (piece, at // parts), []
                held.append(unpacked(body, 2))
        if held:
            yield done()

    return run


def _kept(pieces: int, most: int):
    """The texts of each piece, and the columns that go with them, as one row with ``at`` -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, rows, target in whole_pieces(batches, pieces, most):
            rows, sink = rows.append_column("target", pa.array(target)), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as out:
                out.write_batch(rows)
            body = zstandard.ZstdCompressor(level=1).compress(sink.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int64()), pa.array([-1], pa.int64()), pa.array([body], pa.binary())], names=["piece", "at", "body"])

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_asked`` sorted by range -> the totals of their codes over all pieces."""
    key, held = None, []

    def done():
        pieces, asked = [p for p, _ in held], [x for _, x in held]
        codes, at = np.unique(np.concatenate([np.cumsum(x[0]) for x in asked]), return_inverse=True)
        totals = [np.bincount(at, weights=np.concatenate([x[k] for x in asked]), minlength=len(codes)).astype(np.int64)[at] for k in (1, 2)]
        ends = np.cumsum([len(x[0]) for x in asked])[:-1]
        bodies = [packed(*x) for x in zip(*(np.split(t, ends) for t in totals), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(pieces, pa.int64()), pa.array([key] * len(pieces), pa.int64()), pa.array(bodies, pa.binary())], names=["piece", "at", "body"])

    for batch in batches:
        for piece, at, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != key:
                if held:
                    yield done()
                key, held = at, []
            held.append((piece, unpacked(body, 3)))
    if held:
        yield done()


def losses(found: list[bytes | None], target: np.ndarray, totals: list[np.ndarray], weights: tuple[float, float, float]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(words of each text, [sums of losses in the target model, in the background model]); ``totals``: of the codes that were asked for."""
    word, pair, doc = coded(found)
    codes, at = np.unique(np.concatenate([[np.uint64(TOTAL)], word, pair]), return_inverse=True)
    of_word, of_pair = at[1 : 1 + len(word)], at[1 + len(word) :]
    sizes = np.bincount(doc, minlength=len(found))

    def own(code: np.ndarray) -> np.ndarray:
        _, at, n = np.unique(doc * len(codes) + code, return_inverse=True, return_counts=True)
        return n[at]

    own_word, own_pair, first = own(of_word), own(of_pair), pair == TOTAL
    before = np.r_[0, of_word[:-1]][: len(word)], np.r_[0, own_word[:-1]][: len(word)]
    out = []
    for m in (1, 0):
        n, seen = totals[m], target[doc] if m else np.ones(len(doc), bool)  # a document's own words are in the counts if seen

        def rest(code: np.ndarray, own: np.ndarray, n=n, seen=seen) -> np.ndarray:
            return n[code] - own * seen

        p = weights[1] * rest(of_word, own_word) / np.maximum(n[0] - sizes[doc] * seen, 1) + weights[2] / TYPES
        p += np.where(first, 0, weights[0] * rest(of_pair, own_pair) / np.maximum(rest(*before), 1))
        out.append(np.bincount(doc, weights=-np.log(p), minlength=len(found)))
    return sizes, out


def _scored(schema: pa.Schema, weights: tuple[float, float, float]):
    """Rows of ``_kept`` and ``_answered``, sorted by piece and range -> one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, held = None, None, []

        def done():
            totals = [np.concatenate(x).astype(np.int64) for x in zip(*held, strict=True)]
            n, (target, background) = losses(texts(rows, "text"), rows.column("target").to_numpy(zero_copy_only=False), totals, weights)
            mean = [x / np.maximum(n, 1) for x in (target, background)]
            kept = [rows.column(i) for i, name in enumerate(rows.schema.names) if name not in ("text", "target")]
            return pa.RecordBatch.from_arrays([*kept, pa.array(n), *map(pa.array, mean), pa.array(mean[0] - mean[1])], names=schema.names)

        for batch in batches:
            for piece, at, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if piece != key:
                    if held:
                        yield done()
                    key, held = piece, []
                if at < 0:
                    rows = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)).read_next_batch()
                else:
                    held.append(unpacked(body, 2))
        if held:
            yield done()

    return run


def target_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good, none held out."""
    return labels.where((F.col("quality") == 1) & ~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("_id")).where("_id is not null").distinct()


def score_documents(
    docs: DataFrame,
    targets: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    weights: tuple[float, float, float] = WEIGHTS,
    piece_bytes: int = PIECE_BYTES,
    range_bytes: int = RANGE_BYTES,
    most_ranges: int = MOST_RANGES,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, target_loss, background_loss, score, and ``carry`` as the struct carried.

    The background counts all ``docs``, the target those whose ids the first column of ``targets`` has; both leave out the document that is
    scored. Losses are means over the words, in nats; score is target_loss - background_loss, lower for texts that are more like the
    target. Null and empty texts have no tokens, and 0 for all three. Rows that repeat an id, and rows without one (never of the
    target), are documents of their own, repeated texts included. A very long text is a piece of its own. Without targets all target losses are
    those of the uniform distribution. An empty table gives no rows.
    """
    doc_id, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))
    pieces, parts = (max(tasks, -(-total // n)) for n in (piece_bytes, range_bytes))
    ranges = min(parts, max(tasks, most_ranges))
    parts = -(-parts // ranges)  # of each range

    def piece_of(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(pieces)).cast("long").alias("piece")

    keep = carried(id_col, carry)
    rows = docs.select(
        piece_of(F.coalesce(doc_id, F.when(text != "", F.xxhash64(text)), F.monotonically_increasing_id())), F.lit(True).alias("is_doc"), doc_id.alias("id"), text.alias("text"), F.xxhash64(text).alias("_version"), *(c.alias(f"_c{i}") for i, c in enumerate(keep.values()))
    )
    kept = [f for f in rows.schema.fields if f.name.startswith("_c")]
    ids = targets.select(F.col(targets.columns[0]).cast("long").alias("id")).where("id is not null").distinct()
    rows = rows.unionByName(ids.select(piece_of(F.col("id")), F.lit(False).alias("is_doc"), "id"), allowMissingColumns=True)
    # Rows without id and text ask for nothing, so it does not matter which piece they go to. Numbers of pieces and ranges deal them out evenly, where hashes of them would put several into one task and none into another.
    rows = rows.repartitionById(tasks, F.pmod("piece", F.lit(tasks)).cast("int")).sortWithinPartitions("piece", "is_doc", "id", "_version").drop("_version")

    form, most = "piece long, at long, body binary", 2 * piece_bytes
    asked = rows.mapInArrow(_asked(pieces, most, ranges), form).repartitionById(tasks, F.pmod("at", F.lit(tasks)).cast("int"))
    if parts > 1:
        asked = asked.mapInArrow(_parted(ranges, parts), form)
    answered = asked.sortWithinPartitions("at", "piece").mapInArrow(_answered, form)
    if parts > 1:
        answered = answered.sortWithinPartitions("piece", "at").mapInArrow(_joined(parts), form)
    both = answered.unionByName(rows.mapInArrow(_kept(pieces, most), form)).repartitionById(tasks, F.pmod("piece", F.lit(tasks)).cast("int")).sortWithinPartitions("piece", "at")
    made = T.StructType.fromDDL("_n long, _t double, _b double, _s double").fields
    schema = T.StructType(kept + made)
    out = both.mapInArrow(_scored(pa.schema([(f.name, pa.null()) for f in schema.fields]), weights), schema)
    names = [*keep, "n_tokens", "target_loss", "background_loss", "score"]
    out = out.select(*(F.col(f.name).alias(n) for f, n in zip(schema.fields, names, strict=True)))
    return out.select("doc_id", *(["carried"] if carry else []), "n_tokens", "target_loss", "background_loss", "score")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored; target: documents labelled good; background: all documents."""
    return score_documents(table(spark, sf_dir, "documents"), target_ids(table(spark, sf_dir, "labels")))
