"""Phrase mining by pivot partitioning: fragments of texts go to the rarest word of the phrases that they hold.

A phrase can only be frequent if all its words are. Frequent words are numbered from the most frequent one, so a phrase's rarest
word, its pivot, is the largest number (its first place, where it stands there twice). Each place of a text is the pivot of
those phrases around it that have no larger number: what it sends is the neighbourhood, up to the next rarer word to the left and
right. A pivot's fragments hold every occurrence of its phrases, once, so they are counted there and nowhere else.

Plan. (1) Texts become chunks: the distinct words with their counts, and the text as places in them; that is stored, tokens are made
once. (2) Words are counted, the frequent ones numbered, and joined to the chunks that have them; no dictionary is sent around.
(3) Equal fragments of a chunk are added up and packed by partition. The fragments of a very frequent pivot go to several partitions, whose counts are
added up; others are final where they are made, so only frequent phrases leave the task. (4) Cuts are joined to the counts of their
two sides; ranks are limited before words are put back in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import numbered, pieces, saved, table, texts, written
from .near_dedup import mixed

LONGEST = 5
LEAST = 100
SHARE = (100, 100)
TOP = 2000
CHUNK = 4 << 20  # bytes of text of a chunk
WAITING = 16 << 20  # of all languages' chunks that a task has begun
PARTITION = 1 << 19  # words that a partition's fragments come from, about
PIVOT = 1 << 17  # occurrences of a pivot that go to one partition
STOP = b"\xff"  # in no UTF-8 text
#: A-Z to lower case, ends of pieces to STOP.
PIECES = bytes(b + 32 if 0x41 <= b <= 0x5A else 0xFF if b in b".,;:!?\x0a\x0b\x0c\x0d" else b for b in range(256))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) -> chunks of one language: (chunk, lang, words, counts, codes)."""
    part, made = TaskContext.get().partitionId(), 0
    waiting: dict[str, tuple[list[bytes], int]] = {}

    def chunk(lang: str) -> pa.RecordBatch:
        nonlocal made
        tokens = STOP.join(waiting.pop(lang)[0]).replace(STOP, b" \xff ").split()
        found = pa.array(tokens, pa.binary()).dictionary_encode()
        codes, words = found.indices.to_numpy(), found.dictionary.to_pylist()
        stop = words.index(STOP) if STOP in words else len(words)
        counts = np.delete(np.bincount(codes, minlength=len(words)), stop) if stop < len(words) else np.bincount(codes, minlength=len(words))
        codes = np.where(codes == stop, 0, codes + (codes < stop)).astype(np.uint16 if len(words) < 1 << 16 else np.uint32)
        made += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + made]), pa.array([lang]), pa.array([[w for i, w in enumerate(words) if i != stop]], pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([zstandard.compress(codes.tobytes(), 1)]), pa.array([codes.itemsize], pa.int32())],
            names=["chunk", "lang", "words", "counts", "codes", "width"],
        )

    for batch in pieces(batches, "text", CHUNK):
        for lang, text in zip(batch.column(0).to_pylist(), texts(batch, "text"), strict=True):
            if text:
                held, size = waiting.setdefault(lang, ([], 0))
                held.append(text.translate(PIECES))
                waiting[lang] = held, size + len(text)
                if size + len(text) >= CHUNK:
                    yield chunk(lang)
        while sum(size for _, size in waiting.values()) >= WAITING:
            yield chunk(max(waiting, key=lambda x: waiting[x][1]))
    for lang in list(waiting):
        yield chunk(lang)


def added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ``keys`` (int32), and the sums of their weights."""
    width = keys.shape[1]
    packed = pa.Array.from_buffers(pa.binary(4 * width), len(keys), [None, pa.py_buffer(np.ascontiguousarray(keys))])
    sums = pa.table({"k": packed, "w": weights}).group_by("k", use_threads=False).aggregate([("w", "sum")]).combine_chunks()
    found = sums.column("k").combine_chunks()
    found = found.chunk(0) if isinstance(found, pa.ChunkedArray) else found
    rows = np.frombuffer(found.buffers()[1], np.int32, len(found) * width, found.offset * 4 * width)
    return rows.reshape(-1, width), sums.column("w_sum").to_numpy()


def neighbourhoods(ids: np.ndarray, longest: int) -> np.ndarray:
    """A row for each place that can be a pivot: the numbers around it, the pivot in the middle, -1 where the neighbourhood has ended."""
    reach = longest - 1
    padded = np.r_[np.full(reach, -1, np.int32), ids, np.full(reach, -1, np.int32)]
    out = np.full((len(ids), 2 * reach + 1), -1, np.int32)
    out[:, reach] = ids
    left, right = ids >= 0, ids >= 0
    for j in range(1, reach + 1):
        before, after = padded[reach - j : reach - j + len(ids)], padded[reach + j : reach + j + len(ids)]
        left = left & (before >= 0) & (before < ids)  # the first place of the largest number is the pivot
        right = right & (after >= 0) & (after <= ids)
        out[left, reach - j] = before[left]
        out[right, reach + j] = after[right]
    return out[(out[:, reach] >= 0) & ((out[:, reach - 1] >= 0) | (out[:, reach + 1] >= 0))]


def _fragments(longest: int, partitions: int, pivot: int):
    """Rows (codes, width, numbered words) -> (partition, several, packed): fragments with weights, packed by partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, width, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes = np.frombuffer(zstandard.decompress(codes), np.uint16 if width == 2 else np.uint32)
                of = np.full(int(codes.max(initial=0)) + 1, -1, np.int32)
                times = np.zeros(len(of), np.int64)
                for w in words:
                    of[w["at"] + 1], times[w["at"] + 1] = w["id"], w["n"]
                found = neighbourhoods(of[codes], longest)
                if not len(found):
                    continue
                found, weights = added(found, np.ones(len(found), np.int64))
                middle = found[:, longest - 1]
                order = np.argsort(of, kind="stable")
                buckets = -(-times[order[np.searchsorted(of[order], middle)]] // pivot)
                salt = found.astype(np.uint64) @ (np.arange(found.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15))
                salt = mixed(salt) % np.maximum(buckets, 1).astype(np.uint64)
                to = (mixed(middle.astype(np.uint64) + (salt << np.uint64(32))) % np.uint64(partitions)).astype(np.int64)
                group = to * 2 + (buckets > 1)
                order = np.lexsort((middle, group))
                found, weights, group = found[order], weights[order], group[order]
                starts = np.r_[0, np.flatnonzero(np.diff(group)) + 1, len(group)]
                packed = [zstandard.compress(np.c_[found[i:j], weights[i:j]].astype(np.int64 if weights[i:j].max() >= 1 << 31 else np.int32).T.tobytes(), 1) for i, j in zip(starts[:-1], starts[1:], strict=True)]
                large = [bool(weights[i:j].max() >= 1 << 31) for i, j in zip(starts[:-1], starts[1:], strict=True)]
                at = group[starts[:-1]]
                yield pa.RecordBatch.from_arrays([pa.array(at >> 1), pa.array((at & 1) == 1), pa.array(large), pa.array(packed)], names=["partition", "several", "large", "packed"])

    return run


def _mined(longest: int, least: int):
    """Packed fragments, sorted by partition -> (phrase, a, several); of pivots with several partitions also what is rare so far."""
    columns = 2 * longest

    def phrases(held: list[np.ndarray], several: bool) -> Iterator[pa.RecordBatch]:
        found = np.concatenate(held, axis=1)
        found, weights = added(np.ascontiguousarray(found[:-1].T.astype(np.int32)), found[-1].astype(np.int64))
        for m in range(2, longest + 1):
            keys, sums = [], []
            for start in range(longest - m, longest):
                full = (found[:, start] >= 0) & (found[:, start + m - 1] >= 0)
                keys.append(found[full, start : start + m])
                sums.append(weights[full])
            rows, a = added(np.concatenate(keys), np.concatenate(sums))
            if not several:
                rows, a = rows[a >= least], a[a >= least]
            if len(rows):
                names = rows.astype(">i4").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([names[i : i + 4 * m] for i in range(0, len(names), 4 * m)], pa.binary()), pa.array(a), pa.array([several] * len(rows))], names=["phrase", "a", "several"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for to, several, large, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (to, several) != key:
                    if held:
                        yield from phrases(held, key[1])
                    key, held = (to, several), []
                held.append(np.frombuffer(zstandard.decompress(packed), np.int64 if large else np.int32).reshape(columns, -1))
        if held:
            yield from phrases(held, key[1])

    return run


def as_phrase(number: Column) -> Column:
    """A word's number as a phrase of one word: four bytes, the largest first."""
    return F.unhex(F.lpad(F.hex(number), 8, "0"))


def words_at(phrase: Column, first: Column, n: Column) -> Column:
    return F.substr(phrase, first * 4 + 1, n * 4)


def frequent_phrases(docs: DataFrame, longest: int, least: int, lang_col: str, text_col: str, pivot: int = PIVOT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases: phrase, a), (words: lang, word, n, id), (languages: lang, total)."""
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    chunks = written(rows.mapInArrow(_chunks, "chunk long, lang string, words array<string>, counts array<long>, codes binary, width int"), "chunks")[0]
    of_chunk = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    totals = of_chunk.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("n"))
    languages = saved(chunks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("total")))
    words = saved(numbered(totals.where(F.col("n") >= least), [F.col("n").desc(), "lang", "word"], "id").withColumn("id", F.col("id").cast("int")))
    known = of_chunk.select("chunk", "lang", "at", F.col("w.words").alias("word")).join(words.hint("merge"), ["lang", "word"], "left")
    known = known.groupBy("chunk").agg(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("at", "id", "n"))).alias("_known"))  # no more than a chunk has words
    partitions = max(1, -(-(languages.agg(F.sum("total")).first()[0] or 0) // PARTITION))
    sent = chunks.select("chunk", "codes", "width").join(known.hint("merge"), "chunk").select("codes", "width", "_known")
    sent = sent.mapInArrow(_fragments(longest, partitions, pivot), "partition long, several boolean, large boolean, packed binary")
    found = sent.repartition("partition").sortWithinPartitions("partition", "several")
    found = saved(found.mapInArrow(_mined(longest, least), "phrase binary, a long, several boolean"))
    summed = found.where("several").groupBy("phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return found.where("not several").select("phrase", "a").unionByName(summed), words, languages


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: tuple[int, int] = SHARE, top: int = TOP, lang_col: str = "lang", text_col: str = "text", pivot: int = PIVOT
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A-Z is lower-cased, texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words ``[^\\x20\\x09]+``. n counts a language's
    words, a phrase's count all its occurrences in pieces, overlaps included. Candidates have 2 to ``longest`` words and a count a of at least
    ``least``. A cut after k words gives counts l and r of the two sides and floor(1000 * a * n / (l * r)), in decimals of 38 digits; the smallest
    is the score, the first cut where there are ties. A candidate is dropped if a longer one that holds it has share[1] * count >= share[0] * a.
    The order is by score and a, descending, then by the phrase's bytes. Null languages are ``und``; null and empty texts have no words. Rows
    that repeat an id count each, ids are not read. A very long text is a chunk of its own. An empty table gives no rows; other columns are not read.
    """
    found, words, languages = frequent_phrases(docs, longest, least, lang_col, text_col, pivot)
    found = saved(found.select("phrase", "a", F.expr("int(octet_length(phrase) / 4)").alias("m")))
    units = found.select(F.col("phrase").alias("side"), F.col("a").alias("times")).unionByName(words.select(as_phrase(F.col("id")).alias("side"), F.col("n").alias("times")))

    # Cuts, with the counts of both sides.
    k = F.explode(F.sequence(F.lit(1), F.col("m") - 1))
    cuts = found.select("phrase", "a", "m", k.alias("k")).select("phrase", "a", "k", words_at(F.col("phrase"), F.lit(0), F.col("k")).alias("left"), words_at(F.col("phrase"), F.col("k"), F.col("m") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(units.withColumnsRenamed({"side": side, "times": name}).hint("merge"), side).drop(side)
    cuts = cuts.groupBy("phrase", "a").agg(F.collect_list(F.struct("k", "l", "r")).alias("cuts"))

    # What a longer candidate makes superfluous: if any one does, one with a single word more does.
    longer = found.where("m > 2").select("a", F.explode(F.array(words_at(F.col("phrase"), F.lit(0), F.col("m") - 1), words_at(F.col("phrase"), F.lit(1), F.col("m") - 1))).alias("phrase"))
    longer = longer.groupBy("phrase").agg(F.max("a").alias("most"))
    cuts = cuts.join(longer.hint("merge"), "phrase", "left").where(F.coalesce(F.lit(share[1]) * F.col("most") < F.lit(share[0]) * F.col("a"), F.lit(True)))

    langs = words.select(as_phrase(F.col("id")).alias("_first"), "lang").join(languages, "lang")
    scored = cuts.withColumn("_first", words_at(F.col("phrase"), F.lit(0), F.lit(1))).join(langs.hint("merge"), "_first")
    wide = "decimal(16,0)"
    best = F.expr(f"array_min(transform(cuts, c -> struct((cast(1000 as decimal(4,0)) * cast(a as {wide}) * cast(total as {wide})) div (cast(c.l as {wide}) * cast(c.r as {wide})) as score, c.k as k, c.l as l, c.r as r)))")
    scored = scored.select("lang", "phrase", "a", F.col("total").alias("n"), best.alias("b")).select("lang", "phrase", "a", "n", "b.score", "b.l", "b.r")
    by = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    near = scored.withColumn("_rank", F.rank().over(by)).where(F.col("_rank") <= top).drop("_rank")

    place = F.posexplode(F.sequence(F.lit(0), F.expr("int(octet_length(phrase) / 4)") - 1))
    named = near.select("*", place.alias("_pos", "_at")).withColumn("_word", words_at(F.col("phrase"), F.col("_at"), F.lit(1)))
    named = named.join(words.select(as_phrase(F.col("id")).alias("_word"), "word").hint("merge"), "_word")
    named = named.groupBy("lang", "phrase", "a", "l", "r", "n", "score").agg(F.sort_array(F.collect_list(F.struct("_pos", "word"))).alias("_words"))
    named = named.withColumn("phrase", F.array_join(F.col("_words.word"), " "))
    out = named.withColumn("rank", F.row_number().over(by.orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")).cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
runs AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, range(1, 6) AS r(m) WHERE len(w) >= m),
counts AS (SELECT lang, w[i:i + m - 1] AS p, m, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT * FROM counts WHERE m > 1),
cuts AS (
  SELECT c.lang, c.p, c.m, c.f AS a, k, x.f AS l, y.f AS r, ((1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score, t.n
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN counts x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN counts y ON y.lang = c.lang AND y.p = c.p[k + 1:c.m] JOIN totals t ON t.lang = c.lang
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
parts AS (SELECT lang, p[1:m - 1] AS p, f FROM candidates WHERE m > 2 UNION ALL SELECT lang, p[2:m], f FROM candidates WHERE m > 2),
longer AS (SELECT lang, p, max(f) AS f FROM parts GROUP BY ALL),
stay AS (SELECT b.* FROM best b LEFT JOIN longer o ON b.lang = o.lang AND b.p = o.p WHERE o.f IS NULL OR 100 * o.f < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM (SELECT *, array_to_string(p, ' ') AS phrase FROM stay) QUALIFY rank <= 2000
"""
