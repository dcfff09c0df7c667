"""The corpus operators' queries against SQL, or against brute force where SQL cannot express them."""

import hashlib
import re
import zlib

import pytest

from quillmine.llm import licenses, mixture, near_dedup, urls
from quillmine.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import compare

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name):
    return {r[0]: r for r in QUERIES[name](spark, SF).collect()}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    n, differing = compare(QUERIES[name](spark, SF), ORACLE_SQL[name], SF)
    assert n > 0 and not differing, differing


def test_near_dedup(spark, docs):
    got, want = rows(spark, "op1_near_dedup"), brute.near({i: r["text"] for i, r in docs.items()}, 4)
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (n, c, c == i) for i, (n, c) in want.items()}


def test_url_filter(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got, w = rows(spark, "op2_url_filter"), urls.fit(spark)
    assert got.keys() == pages.keys()
    for i, r in got.items():
        host, path, rule = brute.url(pages[i], [x for x, _ in urls.RULES])
        verdict = dict(urls.RULES)[rule] if rule else "block" if brute.url_score(host, path, w, urls.SIZE) >= 0.5 else "allow"
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)


def test_url_scores_match_a_plain_version(spark):
    w = urls.fit(spark)
    out = urls.filter_urls(spark.read.parquet(f"{SF}/pages.parquet"), w).collect()
    assert all(abs(r["score"] - brute.url_score(r["host"], r["path"], w, urls.SIZE)) < 1e-9 for r in out)


def test_url_verdicts_on_urls_that_were_not_trained_on(spark):
    from quillmine.llm import url_table

    listed = url_table.labelled_urls()
    held = [x for x in listed if url_table.held_out(x[0])]
    assert len(held) > 600 and len(listed) > 3500
    known = [("https://github.com/apache/spark", 0), ("https://stackoverflow.com/questions/12/how", 0), ("https://de.wikipedia.org/wiki/Berlin", 0), ("https://www.nytimes.com/2023/05/01/world/x.html", 0), ("http://poker-online.example.info/en/1", 1), ("http://best-casino-bonus.com/win", 1), ("http://cheap-viagra.biz/", 1)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(held + known)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] == "block" for r in urls.filter_urls(pages, urls.fit(spark), []).collect()}
    right = [got[i] == bool(y) for i, (_, y) in enumerate(held + known)]
    assert sum(right[: len(held)]) / len(held) >= 0.9 and all(right[len(held) :])


def test_many_rules_are_joined_and_give_the_same(spark, monkeypatch):
    w = urls.fit(spark, [("http://a.com/", 0), ("http://b.com/", 1)], rounds=1)
    rules = [*urls.RULES, ("com/", "block"), ("example.com/en/1", "allow"), ("www.ththhe.example.com/", "allow"), ("a.b.c.d.e.f/", "block")]
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").unionByName(spark.createDataFrame([(-1, "x://y.a.b.c.d.e.f/z"), (-2, None), (None, "x://com"), (None, "x://com/")], "page_id long, url string"))
    want = sorted(map(str, urls.filter_urls(pages, w, rules).collect()))
    for sent in (100, 0):
        monkeypatch.setattr(urls, "MOST_SENT", sent)
        monkeypatch.setattr(urls, "MOST_IN_PLAN", 0)
        assert sorted(map(str, urls.filter_urls(pages, w, rules).collect())) == want
        assert sorted(map(str, urls.filter_urls(pages, w, spark.createDataFrame(rules, "rule string, verdict string")).collect())) == want
        assert urls.filter_urls(pages, w, spark.createDataFrame([], "rule string, verdict string")).where("rule is not null").count() == 0


def test_quality_holds_on_labels_that_were_not_learned_from(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op5_quality"](spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    tested = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == q for p, q in tested) / len(tested) > 0.97


def test_quality_scores_match_a_plain_version(spark, docs):
    """Sizes of every piece, compressed anew with either dictionary, and the logistic function by hand."""
    import math

    import zstandard

    from quillmine.llm import quality

    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    compressors = [zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(x), write_content_size=False, write_dict_id=False) for x in (model.good, model.bad)]
    for i, r in rows(spark, "op5_quality").items():
        text, d, share = (docs[i]["text"] or "").encode(), 0.0, 0.0
        if text:
            good, bad = (sum(len(c.compress(text[k : k + quality.PIECE])) for k in range(0, len(text), quality.PIECE)) for c in compressors)
            d, share = (bad - good) / max(bad, good), min(bad, good) / len(text)
        z = model.weights[0] + model.weights[1] * d + model.weights[2] * share
        assert abs(r["score"] - 1 / (1 + math.exp(-max(-60, min(60, z))))) < 1e-9 and r["predicted"] == (r["score"] >= 0.7)


def test_licenses(spark, docs):
    templates = licenses.all_templates()
    for i, r in rows(spark, "op6_licenses").items():
        n, at, labels = brute.phrases(docs[i]["text"], licenses.BASE)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (n, len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))
        assert r["labels"] == ",".join(sorted(labels | brute.templates(docs[i]["text"], templates)))
        assert 0 <= r["score"] <= 1


def test_mixture(spark, docs):
    got = rows(spark, "op7_mixture")
    sizes = {i: len((r["text"] or "").encode().split()) for i, r in docs.items()}
    targets = brute.water_fill({i: (r["source"], sizes[i]) for i, r in docs.items()}, mixture.WEIGHTS, 3)
    taken: dict = {}
    for i, r in got.items():
        source = docs[i]["source"]
        assert r["size"] == sizes[i] and abs(r["target"] - targets[source]) < 1e-6 and 0 <= r["taken"] <= 3 * r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
    largest = {s: max(sizes[i] for i, r in docs.items() if r["source"] == s) for s in targets}
    assert all(abs(taken[s] - t) <= largest[s] for s, t in targets.items())
    assert got == rows(spark, "op7_mixture")


def test_mixture_takes_what_a_plain_version_takes(spark, docs):
    """The seeded order comes from Spark's hash; all else is done by hand."""
    from pyspark.sql import functions as F

    table = spark.read.parquet(f"{SF}/documents.parquet")
    order = [r["doc_id"] for r in table.select("doc_id", F.shiftrightunsigned(F.xxhash64(F.lit(17), "doc_id"), 58).alias("b"), F.xxhash64(F.lit(17), "doc_id").alias("h")).orderBy("b", "h").collect()]
    sizes = {i: len((r["text"] or "").encode().split()) for i, r in docs.items()}
    targets = brute.water_fill({i: (r["source"], sizes[i]) for i, r in docs.items()}, mixture.WEIGHTS, 3)
    got = {r["doc_id"]: r for r in mixture.mix(table).collect()}
    for source, target in targets.items():
        own = {i: sizes[i] for i, r in docs.items() if r["source"] == source}
        total = sum(own.values())
        whole = int(target / total) if total else 0
        want = brute.taken(own, target - whole * total, whole, [i for i in order if i in own])
        assert sum(got[i]["taken"] for i in own) == sum(n * sizes[i] for i, n in want.items())
        assert {i: got[i]["repeats"] for i in own} == want


def test_secrets(spark, docs):
    from quillmine.llm import secrets

    for i, r in rows(spark, "op10_secrets").items():
        text = docs[i]["text"] or ""
        found = brute.secrets(text)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[3] == k for x in found) for k in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in found).encode()).hexdigest()
        more = [(a, 3 + [c.kind for c in secrets.CLASSES].index(k), b, k) for a, b, k in brute.entropy_spans(text, secrets.CLASSES, secrets.ALLOWED) if not any(x[0] <= a and b <= x[2] for x in found)]
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found + more))


def test_near_dedup_in_small_blocks(spark, docs):
    want = brute.near({i: r["text"] for i, r in docs.items()}, 4)
    got = near_dedup.near_dedup(spark.read.parquet(f"{SF}/documents.parquet"), k=4, block=500, wide_block=800).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in want.items()}


def test_pipeline(spark, docs):
    import corpus_pipeline
    from quillmine.llm import quality
    from quillmine.llm.common import table

    all_docs = table(spark, SF, "documents")
    model = quality.fit(all_docs, table(spark, SF, "labels"))
    score = model.scorer()
    left = {i: r["text"] or "" for i, r in docs.items() if score((r["text"] or "").encode()) >= 0.7}
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    last = {lower(t): i for i, t in sorted(left.items())}
    left = {i: t for i, t in left.items() if last[lower(t)] == i}
    left = {i: left[i] for i, (_, c) in brute.near(left, 5).items() if c == i}
    items = {r["item_id"]: r["text"] for r in table(spark, SF, "benchmark").collect()}
    left = {i: t for i, t in left.items() if not brute.contaminated(t, items)}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} <= left.keys() and all(1 <= r["repeats"] <= 3 for r in out)
    mixed = mixture.mix(all_docs.where(all_docs["doc_id"].isin(list(left)))).where("repeats > 0").collect()
    assert {(r["doc_id"], r["repeats"]) for r in mixed} == {(r["doc_id"], r["repeats"]) for r in out}


def agree(got, want):
    assert got.keys() == want.keys()
    for i, (n, t, b) in want.items():
        r = got[i]
        assert r["n_tokens"] == n and abs(r["target_loss"] - t) < 1e-9 and abs(r["background_loss"] - b) < 1e-9 and abs(r["score"] - (t - b)) < 1e-9


@pytest.mark.parametrize("sizes", [None, (1, 1), (20_000, 3000), (1 << 20, 100), (20_000, 150, 9)])
def test_lm_score(spark, docs, sizes):
    """All words and pairs are counted; pieces, ranges and parts of ranges of any size give the same scores."""
    from quillmine.llm import language_model as lm

    target = lm.target_ids(spark.read.parquet(f"{SF}/labels.parquet"))
    want = brute.lm_scores({i: r["text"] for i, r in docs.items()}, {r[0] for r in target.collect()}, lm.WEIGHTS, lm.TYPES)
    if sizes is None:
        agree(rows(spark, "op9_lm_score"), want)
    else:
        some = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
        agree({r["doc_id"]: r for r in lm.score_documents(some, target, piece_bytes=sizes[0], range_bytes=sizes[1], most_ranges=(*sizes, lm.MOST_RANGES)[2]).collect()}, want)
