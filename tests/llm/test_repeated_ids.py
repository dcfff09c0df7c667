"""Stages on rows that share an id, and on other partitions when a table is read again."""

from collections import Counter

from quillmine.llm import mixture, near_dedup

A = " ".join(f"a{i}" for i in range(40))
B = " ".join(f"b{i}" for i in range(40))
U = " ".join(f"u{i}" for i in range(40))
SCHEMA = "doc_id long, text string"


def test_texts_of_one_id_never_cost_each_other(spark):
    docs = spark.createDataFrame([(5, A), (5, U), (3, A + " more")], SCHEMA)
    assert sorted((r["doc_id"], r["text"][:1]) for r in near_dedup.stage_near_dedup(spark, docs, "").collect()) == [(3, "a"), (5, "u")]
    docs = spark.createDataFrame([(5, A), (5, B), (2, B + " more"), (3, A + " more"), (None, A), (None, U)], SCHEMA)
    got = Counter((r["doc_id"], r["component_id"], r["kept"], r["stays"]) for r in near_dedup.near_dedup(docs).collect())
    assert got == {(5, 3, False, False): 1, (5, 2, False, False): 1, (2, 2, True, True): 1, (3, 3, True, True): 1, (None, 3, False, False): 1, (None, None, True, True): 1}
    assert {r["doc_id"] for r in near_dedup.stage_near_dedup(spark, docs, "").collect()} == {2, 3, None}


def test_one_of_two_like_texts_of_an_id_stays(spark):
    docs = spark.createDataFrame([(5, A), (5, A + " more"), (5, A), (9, A + " other")], SCHEMA)
    kept = [r["text"] for r in near_dedup.stage_near_dedup(spark, docs, "").collect()]
    assert len(set(kept)) == 1 and kept in ([A, A], [A + " more"])
    assert {r["component_id"] for r in near_dedup.near_dedup(docs).collect()} == {5}


def test_the_mix_does_not_depend_on_partitions(spark, tmp_path):
    """The number of cores changes between planning and running: files are packed into other partitions."""
    rows = [(i, " ".join(["w"] * (1 + i % 23)), f"s{i % 3}") for i in range(600)] + [(7, "w w w", "s1")] * 5
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(12).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    want = Counter((r["doc_id"], r["repeats"]) for r in mixture.mix(docs).where("repeats > 0").collect())
    name = "spark.sql.leafNodeDefaultParallelism"
    try:
        spark.conf.set(name, "2")
        planned = mixture.stage_mixture(spark, docs, "")
        spark.conf.set(name, "9")
        got = Counter((r["doc_id"], r["repeats"]) for r in planned.collect())
    finally:
        spark.conf.unset(name)
    assert got == want and sum(got.values()) > 300
