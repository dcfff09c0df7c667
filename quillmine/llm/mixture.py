"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

Plan. Word counts are computed once and stored without texts. Per-source totals, ranks and targets are small frames;
the water level is found by a few aggregates over the sources. A fraction of a repetition goes to the documents that
come first in a seeded order: a histogram of words over ranges of the seeded hash finds the range in which
the fraction is reached, and only that range's documents are sorted. There are as many ranges as a range has documents, about (the square root
of a source's), so no source, however large, meets in one task. What a round takes is all that fits the gap up to a place in the order: a source
keeps its rounds' (gap, place), the documents are never written again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import numbered, saved, stored, table

WEIGHTS = [1, 2, 3]
MOST_SENT = 100_000  # sources whose small tables are broadcast; those of more are joined by merging


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 by code point, null last."""
    return numbered(sources, [F.col("source").asc_nulls_last()], "rank")


def water_fill(sources: DataFrame, most: int) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``: shares by weight, capped at ``most`` times the size, the excess reshared."""
    cap = F.col("source_size") * F.lit(most)
    level = 0.0
    while True:
        full = cap < F.lit(level) * F.col("weight")
        total, held, open_ = sources.agg(F.sum("source_size"), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if not total or not open_:
            break
        now = (total - (held or 0)) / open_
        if now <= level:
            break
        level = now
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def buckets(rows: int) -> int:
    """A power of two of about the square root of a source's rows: as many ranges of the hash, and as many rows in each of them."""
    return 1 << max(6, (max(rows, 1) - 1).bit_length() // 2)


def mix(docs: DataFrame, weights: list[float] = WEIGHTS, most: int = 3, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size (words), source_size, target, repeats, taken (= size * repeats).

    Sources by code point, null last, weigh ``weights``, repeating. A null or empty text has size 0, and takes nothing; a source
    of such texts has target 0. The extra repetition goes to whole documents in a seeded order, while the target allows; documents that
    are longer than what is missing are passed over, and the order is gone through again until no document fits. One
    more document, of the size nearest to what is then missing, closes the gap if that brings the source nearer to its target.
    Rows that share id and text are decided one by one, next to each other in the order (ties by row). The same
    rows give the same result in any partitioning, up to which of several such rows is taken. Very long texts are counted whole.
    An empty table gives no rows; other columns are not read.
    """
    return placed_mix(docs, F.monotonically_increasing_id(), weights, most, seed, id_col, text_col, source_col).drop("row")


def placed_mix(docs: DataFrame, row: Column, weights: list[float] = WEIGHTS, most: int = 3, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``mix`` with ``row``, a number of each row of ``docs``."""
    text, doc_id = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.col(f"`{id_col}`").cast("long")
    sizes = saved(
        docs.select(
            doc_id.alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"), F.xxhash64(F.lit(seed), doc_id).alias("_hash"), row.alias("row")
        )
    )
    sources = ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows")))
    most_rows, n_sources = sources.agg(F.max("_rows"), F.count("*")).first()
    n = buckets(most_rows or 0)

    def small(found: DataFrame) -> DataFrame:
        """A table with a row per source at most: broadcast if the sources are known to be few."""
        return F.broadcast(found) if n_sources <= MOST_SENT else found.hint("merge")

    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights)).cast("int"))
    sources = water_fill(sources.withColumn("weight", weight), most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = sources.withColumn("_whole", F.floor(rate)).withColumn("_need", F.col("target") - F.col("_whole") * F.col("source_size"))
    of_source = F.col("source").eqNullSafe(F.col("_source"))
    key = F.struct("_bucket", "_hash", "doc_id", "size", "row")  # the seeded order
    rows = sizes.withColumn("_bucket", F.shiftrightunsigned("_hash", 64 - (n.bit_length() - 1)).cast("int"))
    extra = F.exists("_taken", lambda x: (F.col("size") <= x["gap"]) & (key <= x["to"]))
    fits = ~extra & (F.col("size") > 0) & (F.col("size") <= F.col("_gap"))
    taken = "array<struct<gap:double,to:struct<_bucket:int,_hash:bigint,doc_id:bigint,size:bigint,row:bigint>>>"
    sources = saved(sources.select(F.col("source").alias("_source"), "source_size", "target", "_whole", F.col("_need").alias("_gap"), F.array().cast(taken).alias("_taken"), F.lit(True).alias("_open")))
    while True:
        levels = rows.join(small(sources.where("_open")), of_source).where(fits).groupBy("_source", "_gap", "_taken", "_bucket").agg(F.sum("size").alias("_words"))
        levels = levels.withColumn("_to", F.sum("_words").over(W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)))
        # The range in which the gap is reached; without one, all that fits is taken.
        over = F.when(F.col("_to") > F.col("_gap"), F.struct(F.col("_bucket"), (F.col("_to") - F.col("_words")).alias("_before")))
        cuts = levels.groupBy("_source", "_gap", "_taken").agg(F.min(over).alias("_at"), F.sum("_words").alias("_all"))
        cuts = saved(cuts.select("_source", "_gap", "_taken", F.coalesce("_at._bucket", F.lit(n)).alias("_cut"), F.coalesce("_at._before", "_all").alias("_before")))
        if cuts.isEmpty():
            break
        up_to = F.sum("size").over(W.partitionBy("_source").orderBy("_hash", "doc_id", "size", "row").rowsBetween(W.unboundedPreceding, W.currentRow))
        cut = rows.join(small(cuts), of_source).where(fits & (F.col("_bucket") == F.col("_cut"))).withColumn("_up_to", up_to)
        cut = cut.where(F.col("_up_to") <= F.col("_gap") - F.col("_before")).groupBy("_source").agg(F.max(key).alias("_last"), F.max("_up_to").alias("_in"))
        below = F.struct(F.col("_cut").alias("_bucket"), F.lit(-1 << 63).alias("_hash"), *(F.lit(None).cast("long").alias(c) for c in ("doc_id", "size", "row")))
        step = F.struct(F.col("_gap").alias("gap"), F.coalesce("_last", below).alias("to"))
        found = cuts.join(small(cut.withColumnRenamed("_source", "_of")), F.col("_source").eqNullSafe(F.col("_of")), "left")
        found = found.select(F.col("_source").alias("_of"), (F.col("_gap") - F.col("_before") - F.coalesce("_in", F.lit(0))).alias("_less"), F.concat("_taken", F.array(step).cast(taken)).alias("_more"))
        now = sources.join(small(found), F.col("_source").eqNullSafe(F.col("_of")), "left")
        sources = saved(now.select("_source", "source_size", "target", "_whole", F.coalesce("_less", "_gap").alias("_gap"), F.coalesce("_more", "_taken").alias("_taken"), F.col("_more").isNotNull().alias("_open")))
    off = F.abs(F.col("size") - F.col("_gap"))
    last = rows.join(small(sources), of_source).where(~extra & (off < F.col("_gap"))).groupBy("_source").agg(F.min_by("row", F.struct(off.alias("off"), "_hash", "doc_id", "row")).alias("_last"))
    last = saved(sources.join(small(last.withColumnRenamed("_source", "_of")), F.col("_source").eqNullSafe(F.col("_of")), "left"))
    out = rows.join(small(last), of_source)
    repeats = F.col("_whole") + ((F.col("size") > 0) & (extra | F.coalesce(F.col("row") == F.col("_last"), F.lit(False)))).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"), (F.col("size") * repeats).alias("taken"), "row")


def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def stage_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, all columns as they were, and ``repeats``: how many times each (a column of that name is replaced).

    Rows are stored with a number first, so the second reading finds them whatever the partitions are by then. Null and empty texts have no
    words and are never taken. Rows are decided one by one, also where they share an id or have none. An empty table stays empty. Names of other
    columns do not matter.
    """
    rows = stored(docs.select(F.struct("*").alias("carried"), F.monotonically_increasing_id().alias("_row")), "numbered")
    read = rows.select(*(F.col(f"carried.{c}").alias(c) for c in ("doc_id", "text", "source")), "_row")
    taken = placed_mix(read, F.col("_row")).where("repeats > 0").select(F.col("row").alias("_taken"), F.col("repeats").alias("_repeats"))
    kept = [F.col(f"carried.`{c}`") for c in docs.columns if c.lower() != "repeats"]
    return rows.join(taken, F.col("_row") == F.col("_taken")).select(*kept, F.col("_repeats").alias("repeats"))
