"""Near duplicates by circulant MinHash, banding, and exact Jaccard verification on whole shingle sets.

Signature. A shingle's hash is permuted (sigma) to a slot of a table that holds a permutation (pi) of ``SLOTS`` numbers;
coordinate k is the minimum of pi at slot + k over the set. Shifting pi by k is reading the table k further on, so a shingle adds
one contiguous slice of the table to all coordinates.

Plan. (1) One pass makes (id, set size, set key, band hashes). Equal sets form classes; the smallest id, and its text, stands for a class.
(2) Buckets of equal band hashes give star edges to their smallest member, a number linear in the members; components of this
graph hold every candidate pair. (3) Only documents in such components are read again. A component is dealt into blocks of bounded
size, each with the component's pivots, which join the blocks' classes; a block's task links its members by exact comparison, skipping pairs that are linked
already. (4) Where a component has several blocks and its members aren't all linked, the members outside of its largest
class of linked ones visit every block, in chunks of bounded size. (5) Components of the verified links, joined to the ids.
No pair is lost to a cap, no group meets in one task, and what is emitted is at most one link for each member of a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, saved, space_words, table, texts
from .components import connected_components

SHINGLE = 5
BANDS, ROWS = 48, 6  # at a similarity of 0.8 a pair is missed with a probability of 5e-7, at 0.1 it is a candidate with 5e-5
COORDINATES = BANDS * ROWS
SLOTS = 1 << 21
SEED = 20_11
COMPARED = 160  # coordinates that estimate a similarity before sets are compared
#: An estimate this far below the threshold is no pair: 5.5 standard deviations of 160 coordinates.
MARGIN = 0.175
BLOCK = 1 << 15  # shingles in a block of the first pass, which spreads large components
WIDE_BLOCK = 1 << 18  # of the second one, where each visitor is sent to every block
SHINGLES_EACH = 256  # short texts count as so many shingles when blocks are dealt, so that members of a block are bounded, too
PIVOTS = 16  # members of a component that every block of it gets, about


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of k words; of the whole sequence where there are fewer words."""
    words = space_words(text) if text else []
    if not words:
        return np.zeros(0, np.uint64)
    of = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(of, words), np.uint64, len(words))
    size = min(k, len(words))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i])
    out.sort()
    return out[np.r_[True, out[1:] != out[:-1]]]


class Circulant:
    """The two permutations; ``signature`` is of a non-empty set."""

    def __init__(self, coordinates: int = COORDINATES):
        pi = np.random.default_rng(SEED).permutation(SLOTS).astype(np.uint32)
        self.windows = np.lib.stride_tricks.sliding_window_view(np.r_[pi, pi[: coordinates - 1]], coordinates)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        slots = (mixed(shingles ^ np.uint64(SEED)) >> np.uint64(64 - 21)).astype(np.int64)
        out = self.windows[slots[:1024]].min(axis=0)
        for i in range(1024, len(slots), 1024):
            np.minimum(out, self.windows[slots[i : i + 1024]].min(axis=0), out=out)
        return out


def _features(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circulant = Circulant()
        salt = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in pieces(batches, "text", 16 << 20):
            sizes, keys, bands = [], [], []
            for text in texts(batch, "text"):
                shingles = shingle_set(text, k)
                sizes.append(len(shingles))
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                if len(shingles):
                    rows, h = circulant.signature(shingles).reshape(BANDS, ROWS).astype(np.uint64), salt
                    for r in range(ROWS):
                        h = mixed(h + rows[:, r] * np.uint64(0x9E3779B97F4A7C15))
                    bands.append(h.view(np.int64))
            flat = pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64))
            ends = np.cumsum([0] + [BANDS if n else 0 for n in sizes]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), flat)],
                names=["doc_id", "version", "n_shingles", "key", "bands"],
            )

    return run


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """den * intersection >= num * union, for sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if den * len(a) < num * len(b):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return (den + num) * both >= num * (len(a) + len(b))


def links(nodes: list[int], sets: list[np.ndarray], signatures: np.ndarray, label: np.ndarray, visiting: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """A forest of verified links that joins what ``label`` has apart; of pairs with a visiting member, or all pairs where all visit."""
    out, sizes = [], np.array([len(s) for s in sets])
    least = num / den - MARGIN
    label = np.unique(label, return_inverse=True)[1]
    everyone = bool(visiting.all())
    for i in np.flatnonzero(visiting).tolist():
        other = (label != label[i]) & (den * sizes >= num * sizes[i]) & (num * sizes <= den * sizes[i])
        if everyone:
            other[i:] = False
        js = np.flatnonzero(other)
        if not len(js):
            continue
        near = (signatures[js] == signatures[i]).mean(axis=1)
        js = js[near >= least][np.argsort(-near[near >= least], kind="stable")]
        for j in js.tolist():
            if label[j] != label[i] and similar(sets[i], sets[j], num, den):
                out.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    return out


def _linked(k: int, num: int, den: int):
    """Rows (comp, block, chunk, node, label, visiting, text) sorted by the first three -> links (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circulant = Circulant(COMPARED)
        key, held = None, {}

        def done():
            nodes = list(held)
            if len(nodes) > 1:
                signatures = np.stack([s[1] for s in held.values()])
                label, visiting = np.array([s[2] for s in held.values()]), np.array([s[3] for s in held.values()])
                yield from links(nodes, [s[0] for s in held.values()], signatures, label, visiting, num, den)

        def batch(found):
            a, b = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for part in pieces(batches, "text", 16 << 20):
            found = []
            comp, block, chunk, node, label, visiting = (part.column(i).to_pylist() for i in range(6))
            for at, n, lab, visits, text in zip(zip(comp, block, chunk, strict=True), node, label, visiting, texts(part, "text"), strict=True):
                if at != key:
                    found += done()
                    key, held = at, {}
                if n not in held:
                    shingles = shingle_set(text, k)
                    held[n] = (shingles, circulant.signature(shingles).astype(np.uint16), lab, visits)
                elif visits and not held[n][3]:
                    held[n] = (*held[n][:3], True)
            if found:
                yield batch(found)
        if found := list(done()):
            yield batch(found)

    return run


def near_dedup(
    docs: DataFrame, k: int = SHINGLE, threshold: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, wide_block: int = WIDE_BLOCK
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, version (a hash of the text), stays.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a set holds the distinct shingles of ``k`` words, of the whole sequence
    where there are fewer words. Sets are linked if den * intersection >= num * union for ``threshold`` (num, den); component_id is
    the smallest id whose text has a set of the component; kept where it is the own id. Null and empty texts have no shingles and no links.
    Rows that repeat an id are documents of their own: each is in the component of its own set, so different texts of one id never cost
    each other, and all links count. ``stays`` is true for one text of each component, the smallest (id, version), and for all rows without shingles;
    rows that repeat an id and its text are all returned and stay or go together. A row without id belongs to the
    component of its set, or to none (null; kept, and stays) if no id has it. A very long text is one set as any other. An empty table gives no rows;
    other columns are not read. Sets are compared as 64-bit hashes of shingles.
    """
    num, den = threshold
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))
    features = saved(rows.mapInArrow(_features(k), "doc_id long, version long, n_shingles long, key binary, bands array<long>"))
    # Nodes are sets, not ids; what is saved has its number for good.
    classes = features.where("n_shingles > 0 and doc_id is not null").groupBy("key").agg(F.min(F.struct("doc_id", "version")).alias("low"), F.min("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = saved(classes.withColumn("node", F.monotonically_increasing_id()))
    members = classes.select("node", F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(F.min("node").alias("low"), F.count("*").alias("n")).where("n > 1").select("band", "low")
    stars = members.join(buckets.hint("merge"), "band").where("node != low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    near = connected_components(stars)

    nodes = saved(near.join(classes.select("node", "n", "low").hint("merge"), "node"))
    # Only components of several blocks need their size; saved, it is joined by an exchange that Spark can split.
    weight = F.greatest("n", F.lit(SHINGLES_EACH))
    sizes = saved(nodes.groupBy("comp").agg(F.sum(weight).alias("total"), F.count("*").alias("members")).where(F.col("total") > block))
    nodes = nodes.join(sizes.hint("merge"), "comp", "left").fillna(1, ["total", "members"])
    named = nodes.withColumns({"doc_id": F.col("low.doc_id"), "version": F.col("low.version")}).drop("low")
    with_text = saved(named.join(rows.hint("merge"), ["doc_id", "version"]))

    def blocks(size: int) -> Column:
        return F.ceil(F.col("total") / size).cast("int")

    def block_of(size: int) -> Column:
        return F.pmod(F.xxhash64("node"), blocks(size)).cast("int")

    def each_block(size: int) -> Column:
        return F.explode(F.sequence(F.lit(0), blocks(size) - 1))

    def linked(dealt: DataFrame) -> DataFrame:
        by = ["comp", "block", "chunk"]
        dealt = dealt.select(*by, "node", "label", "visiting", "text").repartition(*by).sortWithinPartitions(*by, "node")
        return saved(dealt.mapInArrow(_linked(k, num, den), "a long, b long"))

    own = with_text.withColumns({"block": block_of(block), "chunk": F.lit(0), "label": F.col("node"), "visiting": F.lit(True)})
    chosen = (F.col("node") == F.col("comp")) | (F.pmod(F.xxhash64("node", F.lit(2)), F.ceil(F.col("members") / PIVOTS)) == 0)
    pivots = own.where(chosen & (blocks(block) > 1)).withColumn("block", each_block(block))
    labels = connected_components(linked(own.unionByName(pivots)))

    several = with_text.where(blocks(block) > 1).join(labels.withColumnRenamed("comp", "label").hint("merge"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = several.groupBy("comp", "label").agg(F.sum(weight).alias("_n"))
    largest = groups.groupBy("comp").agg(F.max_by("label", F.struct("_n", "label")).alias("_main"), F.count("*").alias("_labels"), F.sum("_n").alias("_all"), F.max("_n").alias("_most"))
    largest = saved(largest.where("_labels > 1").select("comp", "_main", F.ceil((F.col("_all") - F.col("_most")) / wide_block).cast("int").alias("chunks")))
    apart = saved(several.join(largest.hint("merge"), "comp"))
    if not apart.isEmpty():
        staying = apart.withColumns({"block": block_of(wide_block), "visiting": F.lit(False)}).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        visitors = apart.where("label != _main").withColumns({"chunk": F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int"), "visiting": F.lit(True)})
        more = linked(staying.unionByName(visitors.withColumn("block", each_block(wide_block))))
        if not more.isEmpty():  # links between classes of linked ones: a small graph
            of = apart.select("node", "label")
            ends = [of.select(F.col("node").alias(c), F.col("label").alias(f"_{c}")).hint("merge") for c in ("a", "b")]
            joined = connected_components(more.join(ends[0], "a").join(ends[1], "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
            every = near.select("node").join(labels.hint("merge"), "node", "left").select("node", F.coalesce("comp", "node").alias("label"))
            labels = every.join(joined.select(F.col("node").alias("label"), "comp").hint("merge"), "label", "left").select("node", F.coalesce("comp", "label").alias("comp"))

    linked_ones = saved(labels.join(classes.select("node", "low").hint("merge"), "node"))
    firsts = saved(linked_ones.groupBy("comp").agg(F.min("low").alias("first")))
    linked_ones = linked_ones.join(firsts.hint("merge"), "comp").select("node", "first")
    found = classes.select("key", "node", "low").join(linked_ones.hint("merge"), "node", "left").select("key", F.coalesce("first", "low").alias("first"))
    out = features.select("doc_id", "version", "n_shingles", "key").join(found.hint("merge"), "key", "left")
    some = F.col("n_shingles") > 0
    component = F.when(some, F.col("first.doc_id")).otherwise(F.col("doc_id"))
    stays = ~some | F.col("first").isNull() | F.struct("doc_id", "version").eqNullSafe(F.col("first"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"), "version", stays.alias("stays"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), k=4).drop("version", "stays")


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each component, that of the smallest id, and of several texts of that id the one with the smallest hash (shingles of five words, similarity 0.8); all columns as they were.

    Texts without words have no likeness and stay. Rows that repeat an id and its text stay or go together, texts of one id are judged one by one;
    a row without id goes only where a document with an id has the same shingles. An empty table stays empty. Names of columns do not matter: only ``doc_id`` and ``text`` are read.
    """
    stay = near_dedup(docs).where("stays").select(F.col("doc_id").alias("_stay"), F.col("version").alias("_kept")).distinct()
    rows = docs.select(F.struct("*").alias("carried"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.col("text").cast("string")).alias("_version"))
    return rows.join(stay, F.col("_id").eqNullSafe(F.col("_stay")) & (F.col("_version") == F.col("_kept")), "left_semi").select("carried.*")
