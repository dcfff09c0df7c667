"""Text rules as column expressions, with Python's notion of white space, lines and rounding.

``WS`` is what Python strips: Java's Unicode white space plus U+001C to U+001F. ``BREAK`` is where ``splitlines`` breaks.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WS = r"(?U)[\s\x1c-\x1f]"
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
# What ``WS`` matches, and of that what is no break, for a class.
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
BLANKS = r"[\t \x1f\xa0\u1680\u2000-\u200a\u202f\u205f\u3000]"

# Curly quotes, dashes and the no-break space, and what they count as.
ODD_MARKS, PLAIN_MARKS = "\u2018\u2019\u201c\u201d\u2013\u2014\u00a0", "''\"\"-- "


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WS_CHARS))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WS_CHARS))


def collapse(c: Column) -> Column:
    """Runs of white space to one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def lines(c: Column) -> Column:
    """Like ``splitlines``: no empty line after a final break, none at all for an empty text."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(c, rf"(?:{BREAK})\z", ""), BREAK, -1))


@F.pandas_udf(T.StringType())
def _nfkc(c: pd.Series) -> pd.Series:
    return c.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


def nfkc(c: Column) -> Column:
    """Compatibility composition by a function over all rows; ``with_nfkc`` does without it where it can."""
    return _nfkc(c)


@functools.cache
def composition() -> tuple[str, str, str]:
    """(hard, single, forms), made from the interpreter's own tables.

    Hard are characters that join with what stands before them, or whose form has several characters; a text without them is composed
    character by character, and each of ``single`` has one of ``forms``.
    """
    joins = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}  # vowels and finals of Hangul
    every = [chr(c) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for c in every:
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            joins.add(chr(int(parts[1], 16)))
    hard, single, forms = [], [], []
    for c in every:
        form = unicodedata.normalize("NFKC", c)
        if c in joins or unicodedata.combining(c) or len(form) > 1 or form in joins or unicodedata.combining(form):
            hard.append(c)
        elif form != c:
            single.append(c)
            forms.append(form)
    return "".join(hard), "".join(single), "".join(forms)


def with_nfkc(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with ``name``, the text in NFKC: as it is, or translated where each character has a form of its own; only texts in which some join reach a function.

    What decides is a text's characters beyond ASCII, so that plain text is looked through once.
    """
    hard, single, forms = composition()
    rows = rows.withColumn("_odd", F.regexp_replace(text, r"[\x00-\x7F]+", ""))
    joins = F.length(F.translate("_odd", hard, "")) != F.length("_odd")
    rows = rows.withColumn("_composed", nfkc(F.when(joins, F.col(text))))
    simple = F.when(F.translate("_odd", single, forms) != F.col("_odd"), F.translate(text, single, forms)).otherwise(F.col(text))
    return rows.withColumn(name, F.coalesce("_composed", simple)).drop("_odd", "_composed")


def match_form(c: Column, composed: bool = True) -> Column:
    """The form for comparisons: odd marks plain, white space collapsed, lower case. ``composed``: ``c`` is in NFKC already."""
    return F.lower(collapse(F.translate(c if composed else nfkc(c), ODD_MARKS, PLAIN_MARKS)))


def compact_form(c: Column, composed: bool = True) -> Column:
    """``match_form`` with each run of other characters than a-z and 0-9 as one blank; text without Latin letters becomes empty."""
    return compacted(match_form(c, composed))


def compacted(form: Column) -> Column:
    """``compact_form`` of a text in ``match_form``."""
    return F.trim(F.regexp_replace(form, "[^a-z0-9]+", " "))


def topic_key(c: Column) -> Column:
    """Lower case without anything but word characters and CJK."""
    return F.regexp_replace(F.lower(collapse(c)), r"(?U)[^\w\u4e00-\u9fff]+", "")


def tokens(c: Column) -> Column:
    """Runs of ASCII letters, digits and underscores, and single CJK characters, in lower case."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[A-Za-z0-9_]+|[\u4e00-\u9fff]"), F.lit(0))


def paragraph(line_array: Column) -> Column:
    """Lines without trailing white space, joined, at most one blank line in a row."""
    return F.regexp_replace(strip(F.array_join(F.transform(line_array, rstrip), "\n")), r"\n{3,}", "\n\n")


def paragraphs(c: Column) -> Column:
    """``paragraph`` of each run of lines that are not blank; only text with blanks at the end of a line, or other breaks than newlines, is rewritten."""
    odd = rf"(?=[^!-~])(?:{BLANKS}\n|[\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029])"
    plain = F.when(c.rlike(odd), F.regexp_replace(c, f"(?=[^!-~]){BLANKS}*+(?:{BREAK})", "\n")).otherwise(c)
    return F.filter(F.transform(F.split(plain, r"\n{2,}", -1), strip), lambda x: x != "")


def inline(c: Column) -> Column:
    """Without bold marks, white space collapsed, blanks and hyphens off the ends."""
    plain = F.replace(F.replace(strip(c), F.lit("**"), F.lit("")), F.lit("__"), F.lit(""))
    return F.btrim(F.regexp_replace(plain, f"{WS}+", " "), F.lit(" -"))


def rest_of_split(c: Column) -> Column:
    """What remains after a cut: no separators in front."""
    return F.ltrim(c, F.lit(" \t\r\n,;:"))


def excerpt(c: Column, most: int = 1800) -> Column:
    """White space collapsed; of more than ``most`` characters the first 65 % and the last ones, with dots between."""
    flat, head = collapse(c), int(most * 0.65)
    tail = most - head - len(" ... ")
    if tail <= 0:
        return F.substring(flat, 1, most)
    cut = F.concat(F.rtrim(F.substring(flat, 1, head)), F.lit(" ... "), F.ltrim(F.right(flat, F.lit(tail))))
    return F.when(F.length(flat) <= most, flat).otherwise(cut)


def error_summary(c: Column, most: int = 160) -> Column:
    flat = collapse(c)
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(F.substring(flat, 1, most - 3), F.lit("...")))


def rounded(c: Column, digits: int) -> Column:
    """Round half even on the exact binary value, as Python does; ``round`` and ``bround`` differ on ties of printed decimals."""
    return F.replace(F.format_number(c, digits), F.lit(","), F.lit("")).cast("double")


def ordinal_id(prefix: str, n: Column, width: int) -> Column:
    return F.format_string(f"{prefix}_%0{width}d", n)


def strip_topic_prefix(c: Column) -> Column:
    """Without leading ``r<round>_g<group>_`` parts."""
    return F.regexp_replace(c, "^(?:r[^_]+_g[^_]+_)+", "")


def round_topic_id(round_: Column, group: Column, topic: Column, position: Column) -> Column:
    """``r<round>_g<group>_<topic>``; a blank part is ``x``, a blank topic its ordinal, a null round or group ``None``."""
    part = lambda c: F.when(strip(c.cast("string")) == "", "x").otherwise(F.coalesce(strip(c.cast("string")), F.lit("None")))
    bare = strip(F.coalesce(topic, F.lit("")))
    return F.concat(F.lit("r"), part(round_), F.lit("_g"), part(group), F.lit("_"), F.when(bare == "", ordinal_id("topic", position, 4)).otherwise(bare))


def unique_texts(c: Column) -> Column:
    """Stripped, without blanks, the first of equal ones."""
    return F.array_distinct(stripped_texts(c))


def stripped_texts(c: Column) -> Column:
    return F.filter(F.transform(c, strip), lambda x: x != "")


def lines_digest(line_array: Column) -> Column:
    """SHA-256 over lines that each end in a newline; of no lines, over nothing."""
    return F.sha2(F.when(F.size(line_array) == 0, F.lit("")).otherwise(F.concat(F.array_join(line_array, "\n"), F.lit("\n"))).cast("binary"), 256)


def fingerprint(ordinal: Column, line: Column) -> Column:
    """An aggregate: ``lines_digest`` of a group's lines in the order of ``ordinal``."""
    return lines_digest(F.transform(F.array_sort(F.collect_list(F.struct(ordinal.alias("o"), line.alias("l")))), lambda x: x["l"]))
