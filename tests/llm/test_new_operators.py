"""Codes, phrases and repeats against plain versions; nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmine.llm import codes, phrases, repeats

BLANK = r"[^\x20\x09-\x0D]+"


# Vector codes


def plain_codes(rows, k, rounds, parts):
    kept = sorted(((i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for _, v in kept] for p in range(parts)]
    books, assigned = [part[:k] for part in cut], []
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for r in range(rounds + 1):
        assigned = [[min(range(len(books[p])), key=lambda j: (distance(v, books[p][j]), j)) for v in cut[p]] for p in range(parts)]  # noqa: B023
        if r < rounds:
            for p in range(parts):
                new = list(books[p])
                for j in range(len(new)):
                    mine = [v for v, a in zip(cut[p], assigned[p], strict=True) if a == j]
                    if mine:
                        new[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
                books[p] = new
    out = Counter((i, tuple(assigned[p][n] for p in range(parts)), min((1 << 63) - 1, sum(distance(cut[p][n], books[p][assigned[p][n]]) for p in range(parts)))) for n, (i, _) in enumerate(kept))
    return out, books


@pytest.mark.parametrize("scale", [1.0, 1e5, 1e9])
def test_codes_against_plain_rounds(spark, scale):
    """Coarse numbers make ties; large ones leave the range in which floating point is exact."""
    r = random.Random(5)
    rows = [(r.choice([None, *range(150)]), [r.randint(-6, 6) / 8 * scale for _ in range(8)]) for _ in range(220)] + [(7, [0.5 * scale] * 8)] * 30
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int").repartition(3)
    found = codes.compress(table, k=16, rounds=3, parts=2)
    want, books = plain_codes(rows, 16, 3, 2)
    assert found.books.tolist() == books
    assert Counter((x["vec_id"], tuple(x["code"]), x["error"]) for x in found.codes.collect()) == want
    assert found.scanned[0] == 2 * len(rows) and sum(found.scanned[1:]) < 3 * 2 * len(rows)


def test_bounds_spare_most_comparisons_and_keep_the_nearest():
    rng = np.random.default_rng(1)
    x = np.r_[rng.integers(-40, 40, (300, 4)) + 1000, rng.integers(-40, 40, (300, 4))]
    entries = np.array([[1000] * 4, [0] * 4, [500] * 4, [500] * 4])
    code, up, low = codes.scan(x, entries)
    moved = entries + rng.integers(-2, 3, entries.shape)
    moves = codes.root(codes.own_squared(entries, moved), 1)
    again = codes.reassigned(x, code, up, low, moved, moves)
    assert again[3] < 30 and (again[0] == codes.squared(x, moved).argmin(axis=1)).all()
    assert codes.scan(np.array([[500] * 4]), entries)[0][0] == 2  # ties go to the lower index


def test_codes_of_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, label string, code int, error string"
    rows = [(3, [1.0, 0.0, 0.0, 1.0]), (1, [0.0, 1.0, 1.0, 0.0]), (2, None), (4, [1.0, None, 0.0, 0.0]), (5, [float("nan")] * 4), (6, [float("inf"), 0.0, 0.0, 0.0]), (8, [1.0] * 8), (9, []), (None, [1.0, 0.0, 0.0, 1.0])]
    table = spark.createDataFrame([(i, v, None if i in (1, None) else "a", 5, "x") for i, v in rows], schema)
    found = codes.compress(table)
    assert {r["vec_id"] for r in found.codes.collect()} == {3, 1, None} and found.books.shape == (4, 3, 1)
    got = {r["vec_id"]: r for r in codes.digest(found).collect()}
    assert got[3]["code"] == got[None]["code"] and got[3]["label_error"] == 0 and {r["error"] for r in got.values()} == {0}
    assert got[1]["codebooks_sha256"] == hashlib.sha256(",".join(map(str, found.books.ravel().tolist())).encode()).hexdigest()
    empty = codes.digest(codes.compress(table.limit(0)))
    assert empty.count() == 0 and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert codes.digest(codes.compress(table.where("vec_id = 9"))).count() == 0


# Phrases


def plain_phrases(rows, longest, least, share, top):
    out, by_lang = [], {}
    for lang, text in rows:
        by_lang.setdefault(lang or "und", []).append(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    for lang, texts in by_lang.items():
        count, n = Counter(), 0
        for text in texts:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                count.update(tuple(w[i : i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        ranked = []
        for p, a in found.items():
            if not any(len(q) > len(p) and share[1] * b >= share[0] * a and inside(p, q) for q, b in found.items()):
                score, k = min((int(Fraction(1000 * a * n, count[p[:k]] * count[p[k:]])), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


def text_rows(seed=3, n=150):
    r = random.Random(seed)
    words = ["the", "Of", "é", "new", "york", "city", "x", "\xa0", "zz\x00", "a-b"]
    rows = [(r.choice(["en", "de", None, "und"]), " ".join(r.choices(words, weights=range(10, 0, -1), k=r.randint(0, 30))).replace("x", r.choice(["x", "\n", ". ", ";"]))) for _ in range(n)]
    return rows + [("en", None), (None, ""), ("en", "New York  City\tnew york city " * 200), ("fr", "the the the the the the")]


@pytest.mark.parametrize(("share", "pivot"), [((100, 100), 1 << 17), ((80, 100), 5)])
def test_phrases_against_plain_counts(spark, share, pivot):
    rows = text_rows()
    table = spark.createDataFrame([(a, b, 1, "s") for a, b in rows], "lang string, text string, n int, score string").repartition(4)
    got = phrases.collocations(table, longest=4, least=6, share=share, top=25, pivot=pivot)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = sorted(tuple(r) for r in got.collect())
    assert found == plain_phrases(rows, 4, 6, share, 25) and {r[0] for r in found} >= {"en", "de", "und"}


def test_phrases_of_nothing(spark):
    table = spark.createDataFrame([("en", None), ("en", "a b")], "lang string, text string")
    assert phrases.collocations(table).count() == 0 and phrases.collocations(table.limit(0)).count() == 0


# Repeats


def plain_repeats(rows, window):
    words = [re.findall(BLANK, t or "") for _, t in rows]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = Counter()
    for (i, _), w in zip(rows, words, strict=True):
        gone = {j for s in range(len(w) - window + 1) if count[tuple(w[s : s + window])] > 1 for j in range(s, s + window)}
        out[i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)] += 1
    return out


def repeat_rows(seed=8):
    r = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(90):
        w = [f"w{r.randint(0, 400)}" for _ in range(r.randint(0, 60))]
        if i % 3 == 0:
            at = r.randint(0, len(w))
            mine = list(passage)
            if i % 2:
                mine[r.randint(0, 39)] = f"edit{i}"
            w[at:at] = mine
        rows.append((r.choice([None, i, 5]), r.choice(["  ", "\n", " \t"]).join(w)))
    return rows + rows[:10] + [(1, None), (2, ""), (3, "same " * 30), (4, "ab cd " * 20), (6, " ".join(str(i) for i in range(5000)))]


@pytest.mark.parametrize("bucket", [1 << 13, 2])
def test_repeats_against_plain_windows(spark, bucket):
    """Near copies of one passage, a text that repeats itself, rows that repeat an id; with and without several buckets of a minimiser."""
    rows = repeat_rows()
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n_words int, minimiser string").repartition(5)
    found = repeats.repeated_windows(docs, 9, 4, bucket=bucket)
    out = repeats.without_repeats(docs, found, 9, carry=["minimiser"]).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in out) == plain_repeats(rows, 9) and {r["carried"]["minimiser"] for r in out} == {"k"}


def test_repeats_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert repeats.repeated_windows(docs.limit(0)).count() == 0
    assert repeats.without_repeats(docs, repeats.repeated_windows(docs)).first()["kept_text"] == "a b"


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    values = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4] * 3)
    at = np.arange(len(values) - 2)
    want = [tuple(values[i : i + 3]) for i in at]
    monkeypatch.setattr(repeats, "rolling", lambda h, width: np.zeros(len(h) - width + 1, np.uint64))
    got = repeats.window_classes(values, at, 3)
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i in at for j in at)


def test_super_kmers_hold_every_window_once_and_equal_windows_share_a_minimiser():
    found = [t.encode() if t is not None else None for _, t in repeat_rows(2)]
    words, begins, text, at, n, low = repeats.super_kmers(found, 9, 4)
    owner, seen = {}, Counter()
    for t, a, m, x in zip(text.tolist(), at.tolist(), n.tolist(), low.tolist(), strict=True):
        for i in range(a, a + m):
            seen[t, i] += 1
            assert owner.setdefault(tuple(words[begins[t] + i : begins[t] + i + 9]), x) == x
    assert set(seen.values()) == {1} and len(seen) == sum(max(0, len((t or b"").split()) - 8) for t in found) and n.max() <= 6
