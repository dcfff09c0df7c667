"""Exact duplicates by Patricia tries: length-and-hash partitions, full byte strings, owners in terminal nodes.

Plan. Each input task feeds a trie with its own texts and passes on one row per distinct text (map-side combine), so a group of
copies, however large, reaches its partition as one row per input task and spill. Rows are dealt by (length, hash), and a second trie per
partition takes in the whole byte strings, which share their common openings. When a trie outgrows its budget, in either
pass, its largest subtree is passed on and freed. The first pass passes on texts; the second one digests, owners and counts, of which a
small aggregate adds up what spills have parted. Group membership comes from a join on the digest that Spark can split when skewed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, saved, table, texts


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NODE = 400  # bytes of a node, its bytes object and its table of kids, beside the edge's bytes; measured in tests


class Node:
    __slots__ = ("edge", "kids", "count", "owner")

    def __init__(self, edge: bytes, count: int = 0, owner: int | None = None):
        self.edge, self.kids, self.count, self.owner = edge, {}, count, owner


def shared_prefix(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``, by bisection over slice comparisons."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class PatriciaTrie:
    """A compressed radix trie. Terminal nodes (count > 0) hold the smallest or largest identifier inserted; ``size`` is what it takes in memory."""

    def __init__(self, keep: str = "min"):
        self.root, self.pick, self.size = Node(b""), {"min": min, "max": max}[keep], 0

    def insert(self, key: bytes, owner: int | None, count: int = 1) -> bool:
        """True if ``key`` is new."""
        node, at = self.root, 0
        while at < len(key):
            kid = node.kids.get(key[at])
            if kid is None:
                node.kids[key[at]] = Node(key[at:], count, owner)
                self.size += NODE + len(key) - at
                return True
            if key.startswith(kid.edge, at):
                node, at = kid, at + len(kid.edge)
                continue
            n = shared_prefix(kid.edge, key, at)
            fork = Node(kid.edge[:n])
            self.size += NODE
            node.kids[key[at]] = fork
            kid.edge = kid.edge[n:]
            fork.kids[kid.edge[0]] = kid
            node, at = fork, at + n
        new = not node.count
        node.owner = owner if node.owner is None else node.owner if owner is None else self.pick(node.owner, owner)
        node.count += count
        return new

    @staticmethod
    def terminals(node: Node, prefix: bytes) -> Iterator[tuple[bytes, int | None, int]]:
        """(key, owner, count) in byte order, without recursion."""
        stack = [(node, prefix)]
        while stack:
            at, path = stack.pop()
            path += at.edge
            if at.count:
                yield path, at.owner, at.count
            stack += [(at.kids[b], path) for b in sorted(at.kids, reverse=True)]

    def drain(self) -> Iterator[tuple[bytes, int | None, int]]:
        node, self.root, self.size = self.root, Node(b""), 0
        yield from self.terminals(node, b"")

    def spill(self) -> Iterator[tuple[bytes, int | None, int]]:
        """Takes the largest subtree below the first fork out of the trie and yields what it held."""
        parent, prefix = self.root, b""
        while len(parent.kids) == 1 and (kid := next(iter(parent.kids.values()))).kids and not kid.count:
            parent = kid
            prefix += parent.edge
        sizes = {b: sum(NODE + len(n.edge) for n in walk(kid)) for b, kid in parent.kids.items()}
        b = max(sizes, key=sizes.get)
        self.size -= sizes[b]
        yield from self.terminals(parent.kids.pop(b), prefix)


def walk(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        at = stack.pop()
        yield at
        stack += at.kids.values()


def normal(text: bytes | None) -> bytes:
    """A-Z lower-cased, null as empty."""
    return (text or b"").lower()


def _tries(keep: str, budget: int, of_texts: bool):
    """Rows (doc_id or owner, text, and count where a first pass has made them) -> a row for each terminal node of the task's trie."""

    def out(found: list[tuple[bytes, int | None, int]]) -> pa.RecordBatch:
        text, owner, count = zip(*found, strict=True)
        if of_texts:
            names = ["length", "hash", "text"]
            key = [pa.array(map(len, text), pa.int64()), pa.array((int.from_bytes(xxhash.xxh3_64_digest(t), "big", signed=True) for t in text), pa.int64()), pa.array(text, pa.binary())]
        else:
            names, key = ["sha"], [pa.array((hashlib.sha256(t).digest() for t in text), pa.binary())]
        return pa.RecordBatch.from_arrays([*key, pa.array(owner, pa.int64()), pa.array(count, pa.int64())], names=[*names, "owner", "count"])

    def rows(found: Iterator[tuple[bytes, int | None, int]]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for one in found:
            held.append(one)
            size += len(one[0])
            if size > 8 << 20 or len(held) >= 10_000:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(keep)
        for batch in pieces(batches, "text", budget // 2):
            counts = [1] * batch.num_rows if of_texts else batch.column(2).to_pylist()
            for owner, text, n in zip(batch.column(0).to_pylist(), texts(batch, "text"), counts, strict=True):
                trie.insert(normal(text) if of_texts else text, owner, n)
            while trie.size > budget:
                yield from rows(trie.spill())
        yield from rows(trie.drain())

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, "text", 16 << 20):
        sha = [hashlib.sha256(normal(t)).digest() for t in texts(part, "text")]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sha, pa.binary())], names=["doc_id", "sha"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", budget: int = 32 << 20) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. ``keep`` says whether the smallest or the largest id
    of a group stays. ``budget`` bounds the bytes of a task's trie (a single longer text is held alone). A null text counts as empty, so null
    and empty texts form one group. Rows that repeat an id and its text are all counted and all kept if their id is.
    A null id is kept only where its group has no other id. An empty table gives no rows; other columns are not read.
    """
    pick = {"min": F.min, "max": F.max}[keep]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    distinct = rows.mapInArrow(_tries(keep, budget, True), "length long, hash long, text binary, owner long, count long")
    dealt = distinct.repartition("length", "hash").select("owner", "text", "count")
    owners = dealt.mapInArrow(_tries(keep, budget, False), "sha binary, owner long, count long")
    owners = saved(owners.groupBy("sha").agg(pick("owner").alias("keep_id"), F.sum("count").alias("group_size")))
    members = rows.mapInArrow(_digests, "doc_id long, sha binary")
    return members.join(owners.hint("merge"), "sha", "left").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


OP8_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


def stage_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose row stays (the largest id of equal texts), all columns as they were.

    Null and empty texts are equal. Rows that repeat an id and its text stay together; a row without id stays only where no equal text has
    one. An empty table stays empty. Names of columns do not matter: only ``doc_id`` and ``text`` are read.
    """
    stay = exact_dedup(docs, keep="max").where("kept").select(F.col("doc_id").alias("_stay"), "text_sha256")
    key = F.sha2(F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, UPPER.lower()).cast("binary"), 256)
    rows = docs.select(F.struct("*").alias("carried"), F.col("doc_id").cast("long").alias("_id"), key.alias("_sha"))
    stay = stay.withColumnRenamed("text_sha256", "_digest").distinct()
    return rows.join(stay, F.col("_id").eqNullSafe(F.col("_stay")) & (F.col("_sha") == F.col("_digest")), "left_semi").select("carried.*")
