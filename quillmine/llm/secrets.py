"""Secret scans in DataFrame expressions only: fixed patterns, and sliding-window entropy over candidate strings.

Plan. One projection over the texts, without a shuffle. Places of matches come from running sums over the lengths of the pieces between
matches (``split``) and of the matches (``regexp_extract_all``). Cheap substring tests keep most texts away from the
patterns. The entropy of a window is log2(w) - S / w with S the sum of n log2 n over the counts n of its characters;
moving the window by one changes two counts and S by four terms.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried, table

# The base patterns, (kind, pattern, group whose length counts, least length).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run that is long enough is found whole by either form; the shorter runs are skipped without being cut out.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "api_key", "apikey"]
KINDS = ["assign", "access", "hex"]


@dataclass(frozen=True)
class CharClass:
    """Candidates are runs of ``alphabet`` that match ``pattern``; a window of ``window`` characters is a finding from ``entropy`` bits."""

    kind: str
    alphabet: str
    pattern: str
    window: int
    entropy: float


UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
CLASSES = [
    CharClass("entropy_hex", DIGITS + "abcdefABCDEF", r"(?<![A-Za-z0-9])(?=[A-Fa-f]*[0-9])(?=[0-9]*[A-Fa-f])[0-9A-Fa-f]{16,}(?![A-Za-z0-9])", 16, 2.9),
    CharClass("entropy_base64", UPPER + LOWER + DIGITS + "+/_-", r"(?<![A-Za-z0-9+/_-])(?=[A-Z+/_-]*[a-z0-9+/_-]*[A-Z0-9])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}", 20, 3.5),
]
#: What one of these matches is cut out of a candidate, and the parts on either side of it are judged by themselves; a match of a whole
#: candidate (``^...$``) leaves nothing. The base patterns are not affected. One group at most, the first, may be referred to by ``\\1``.
ALLOWED = ["example", r"(.)\1{5,}", "0123456789", "abcdefgh", "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"]


BLOCK = 64  # values that one fold adds up


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), use), 0)


def running(values: Column) -> Column:
    """Sums of an int array up to each place, in folds over blocks, as a fold copies what it has each time."""
    none = F.array().cast("array<int>")

    def fold(part: Column, start: Column) -> Column:
        step = lambda state, x: F.struct((state["at"] + x).alias("at"), F.concat(state["out"], F.array(state["at"] + x)).alias("out"))
        return F.aggregate(part, F.struct(start.alias("at"), none.alias("out")), step, lambda s: s["out"])

    def blocks(all_: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), lambda k: F.slice(all_, k * BLOCK + 1, BLOCK))
        ends = lambda parts: fold(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda n, x: n + x)), F.lit(0))
        return let(parts, lambda parts: let(ends(parts), lambda ends: F.flatten(F.transform(parts, lambda p, k: fold(p, F.coalesce(F.get(ends, k - 1), F.lit(0)))))))

    return let(values, lambda all_: F.when(F.size(all_) > 0, blocks(all_)).otherwise(none))


def places(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches: array of (start, end, match, part), in code points, end exclusive. part: the group."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("gap"), found.alias("match"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part")
    )

    def place(ends: Column) -> Callable[[Column, Column], Column]:
        return lambda x, k: F.struct((F.get(ends, k) - F.length(x["match"])).alias("start"), F.get(ends, k).alias("end"), x["match"].alias("match"), x["part"].alias("part"))

    return let(zipped, lambda z: let(running(F.transform(z, lambda x: F.length(x["gap"]) + F.length(x["match"]))), lambda ends: F.transform(z, place(ends))))


def between(text: Column, pattern: str) -> Column:
    """What the matches of a pattern leave: array of (start, text), in order; all of it where there are none."""
    left = F.split(text, pattern, -1)
    cut = F.concat(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array(F.lit("")))
    zipped = F.arrays_zip(left.alias("left"), F.slice(cut, F.lit(1), F.size(left)).alias("cut"))
    one = lambda ends: lambda x, k: F.struct((F.get(ends, k) - F.length(x["cut"]) - F.length(x["left"])).alias("start"), x["left"].alias("text"))
    return let(zipped, lambda z: let(running(F.transform(z, lambda x: F.length(x["left"]) + F.length(x["cut"]))), lambda ends: F.transform(z, one(ends))))


def spans(found: Column, order: int, kind: str, keep=lambda x: F.lit(True)) -> Column:
    """(start, order of the kind, end, kind): sorts as results are listed."""
    return F.transform(F.filter(found, keep), lambda x: F.struct(x["start"], F.lit(order).alias("order"), x["end"], F.lit(kind).alias("kind")))


def _n_log_n(n: Column) -> Column:
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def windows(candidate: Column, of: CharClass) -> Column:
    """(first, last): starts of the first and last window with at least ``of.entropy`` bits; -1 where there is none."""
    codes = F.transform(F.split(candidate, "", -1), lambda c: F.instr(F.lit(of.alphabet), c))
    codes = F.filter(codes, lambda c: c > 0)
    pairs = F.arrays_zip(codes.alias("new"), F.slice(F.concat(F.array_repeat(F.lit(0), of.window), codes), F.lit(1), F.size(codes)).alias("old"))
    start = F.struct(F.array_repeat(F.lit(0), len(of.alphabet)).alias("n"), F.lit(0.0).alias("s"), F.lit(0).alias("i"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    full = math.log2(of.window)

    def step(state: Column, x: Column) -> Column:
        n = F.transform(state["n"], lambda v, k: v + F.when(k + 1 == x["new"], 1).otherwise(0) - F.when(k + 1 == x["old"], 1).otherwise(0))
        more, less = F.get(state["n"], x["new"] - 1), F.get(state["n"], x["old"] - 1)
        s = state["s"] + F.when(x["new"] == x["old"], F.lit(0.0)).otherwise(
            _n_log_n(more + 1) - _n_log_n(more) + F.when(x["old"] > 0, _n_log_n(less - 1) - _n_log_n(less)).otherwise(F.lit(0.0))
        )
        at = state["i"] - (of.window - 1)
        return F.struct(n.alias("n"), s.alias("s"), (state["i"] + 1).alias("i"), _first(state, at, s, full, of).alias("first"), _last(state, at, s, full, of).alias("last"))

    return F.aggregate(pairs, start, step, lambda z: F.struct(z["first"].alias("first"), z["last"].alias("last")))


def _high(at: Column, s: Column, full: float, of: CharClass) -> Column:
    return (at >= 0) & (full - s / of.window >= of.entropy - 1e-9)


def _first(state, at, s, full, of) -> Column:
    return F.when((state["first"] < 0) & _high(at, s, full, of), at).otherwise(state["first"])


def _last(state, at, s, full, of) -> Column:
    return F.when(_high(at, s, full, of), at).otherwise(state["last"])


def entropy_spans(text: Column, order: int, of: CharClass, allowed: list[str]) -> Column:
    """Parts of candidates of one class with a window of high entropy: from the first such window's start to the last one's end."""

    def parts(x: Column) -> Column:
        whole = F.array(F.struct(F.lit(0).alias("start"), x["match"].alias("text")))
        left = between(x["match"], "(?i)" + "|".join(allowed)) if allowed else whole
        return F.transform(left, lambda y: F.struct((x["start"] + y["start"]).alias("at"), y["text"].alias("text")))

    long = F.filter(F.flatten(F.transform(places(text, of.pattern), parts)), lambda x: F.length(x["text"]) >= of.window)
    tried = F.transform(long, lambda x: F.struct(x["at"], windows(x["text"], of).alias("w")))
    return F.transform(
        F.filter(tried, lambda x: x["w"]["first"] >= 0),
        lambda x: F.struct((x["at"] + x["w"]["first"]).alias("start"), F.lit(order).alias("order"), (x["at"] + x["w"]["last"] + of.window).alias("end"), F.lit(of.kind).alias("kind")),
    )


NONE = "array<struct<start:int,order:int,end:int,kind:string>>"


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: list[CharClass] = CLASSES, allowed: list[str] = ALLOWED, carry: list[str] | None = None
) -> DataFrame:
    """One row per document: doc_id, base and added (arrays of (start, order, end, kind) by start, then kind), and ``carry`` as the struct carried.

    base: matches of the fixed patterns; added: spans of high entropy in what ``allowed`` leaves of candidates, unless a base span holds them.
    Null counts as empty; an empty text has no spans, and an empty table gives no rows. Rows are judged one by one, repeated ones alike;
    other columns are not read but for ``carry``. Whole texts are scanned, however long; the time for a text grows with its length and its
    number of matches.
    """
    some = lambda when, what: F.when(when, what).otherwise(F.array().cast(NONE))
    rows = docs.select(*(c.alias(n) for n, c in carried(id_col, carry).items()), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    text, low = F.col("_text"), F.lower("_text")
    has_word = low.contains(ASSIGN_WORDS[0])
    for word in ASSIGN_WORDS[1:]:
        has_word = has_word | low.contains(word)
    rows = rows.withColumn(
        "base",
        F.array_sort(
            F.concat(
                some(has_word, spans(places(text, ASSIGN, 2), 0, KINDS[0], lambda x: F.length(x["part"]) >= ASSIGN_LEAST)),
                some(text.contains("AKIA"), spans(places(text, ACCESS), 1, KINDS[1])),
                some(text.rlike(HEX), spans(places(text, HEX), 2, KINDS[2])),
            )
        ),
    )
    found = [some(text.rlike(c.pattern), entropy_spans(text, len(KINDS) + i, c, allowed)) for i, c in enumerate(classes)]
    rows = rows.withColumn("_more", F.concat(*found) if found else F.array().cast(NONE))
    inside = lambda x: F.exists(F.col("base"), lambda y: (y["start"] <= x["start"]) & (x["end"] <= y["end"]))
    rows = rows.withColumn("added", F.when(F.size("_more") == 0, F.col("_more")).otherwise(F.array_sort(F.filter("_more", lambda x: ~inside(x)))))
    return rows.drop("_text", "_more")


def listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_secrets(table(spark, sf_dir, "documents"))
    number = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *map(number, KINDS), F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.array_sort(F.concat("base", "added"))).alias("spans"))
