"""URL filters in DataFrame expressions only: rules by host and path, and a logistic regression for the rest.

Plan. One projection over the URLs, without a shuffle: rules are a chain of conditions, longest first (a large table of them is joined by
domain); the features are character trigrams of host and path, hashed to ``SIZE`` slots; the weights are one array literal. The
regression is fitted on the driver to a small labelled table (``url_table``) whose features come from the same expression.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried, saved, table
from .url_table import held_out, labelled_urls

# Fixed values: (rule, verdict).
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
CAUTION = 2.0  # what all harmless URLs weigh in the fit against all others, as what is blocked is lost
SIZE = 8191  # a prime: slots of the hashed trigrams
MOST_LABELLED = 20_000  # rows of a labelled table that the driver may hold
MOST_IN_PLAN = 500  # rules that are part of the plan; more are joined
MOST_SENT = 100_000  # rules that are broadcast; more are joined by merging


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; path: then up to ``?``, ``#`` or end."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def slots(host: Column, path: Column) -> Column:
    """Slot numbers of the trigrams of ``^host$`` and of the path with its end."""

    def of(text: Column, salt: int) -> Column:
        codes = F.transform(F.split(text, "", -1), F.ascii)
        n = F.greatest(F.size(codes) - 2, F.lit(0))
        at = lambda k: F.slice(codes, F.lit(k), n)
        mixed = F.zip_with(F.zip_with(at(1), at(2), lambda a, b: a * 7919 + b * 10473), at(3), lambda ab, c: ab + c * 1299)
        return F.transform(mixed, lambda x: (x + salt) % SIZE)

    return F.concat(of(F.concat(F.lit("^"), host, F.lit("$")), 0), of(F.concat(path, F.lit("$")), 1231))


def fit(spark: SparkSession, labelled: list[tuple[str, int]] | None = None, rounds: int = 400, rate: float = 30.0, decay: float = 1e-5) -> list[float]:
    """Weights by slot, the last one the intercept: gradient descent on the log loss over presence of trigrams.

    ``labelled``: (url, 1 for block), 1 to MOST_LABELLED rows; by default the rows of ``url_table`` that are not held out.
    """
    labelled = [x for x in labelled_urls() if not held_out(x[0])] if labelled is None else labelled
    if not labelled or len(labelled) > MOST_LABELLED:
        raise ValueError(f"a labelled table has 1 to {MOST_LABELLED} rows; this one has {len(labelled)}")
    quoted = ", ".join("('{}', {})".format(u.replace("\\", "\\\\").replace("'", "\\'"), int(y)) for u, y in labelled)
    rows = spark.sql(f"SELECT * FROM VALUES {quoted} AS t(url, y)").select(F.array_distinct(slots(*host_and_path(F.col("url")))).alias("s"), "y").collect()
    n = np.array([len(r["s"]) for r in rows])
    at, row = np.concatenate([np.array(r["s"], int) for r in rows]), np.repeat(np.arange(len(rows)), n)
    value, y, w, bias = 1 / np.sqrt(n[row]), np.array([r["y"] for r in rows], float), np.zeros(SIZE), 0.0
    share = np.where(y == 1, 1 / max(y.sum(), 1), CAUTION / max((1 - y).sum(), 1)) / (1 + CAUTION)
    for _ in range(rounds):
        margin = np.bincount(row, weights=value * w[at], minlength=len(rows)) + bias
        off = share * (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - y)
        w -= rate * (np.bincount(at, weights=value * off[row], minlength=SIZE) + decay * w)
        bias -= off.sum()
    return [round(float(v), 6) for v in (*w, bias)]


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule; null where none fits."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the last one tested first
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def with_rule(rows: DataFrame, rules: list[tuple[str, str]] | DataFrame) -> DataFrame:
    """``rows`` (host, path, ...) with rule and rule_verdict. ``rules``: (rule, verdict) pairs, or a table of these columns; many are joined.

    Each host meets the rules of its own and its parent domains; of the rules that fit, the longest one comes back to its row. The rules
    are broadcast if they are few, and else joined by merging, which Spark can split where very many hosts have one domain.
    """
    if isinstance(rules, list) and len(rules) <= MOST_IN_PLAN:
        rows, says = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)), F.lit(None).cast("string")
        for rule, verdict in rules:
            says = F.when(F.col("rule") == rule, verdict).otherwise(says)
        return rows.withColumn("rule_verdict", says)
    spark = rows.sparkSession
    listed = spark.createDataFrame(rules, "rule string, verdict string") if isinstance(rules, list) else rules.select("rule", "verdict")
    end = F.instr("rule", "/")
    listed = listed.where(end > 0).dropDuplicates(["rule"]).select("rule", "verdict", F.substring("rule", F.lit(1), end - 1).alias("_domain"), F.substring("rule", end, F.length("rule")).alias("_path"))
    listed = saved(listed)
    found = listed.agg(F.count("*"), F.max(F.size(F.split("_domain", r"\.")))).first()
    deepest, sent = found[1] or 0, F.broadcast(listed) if found[0] <= MOST_SENT else listed.hint("merge")
    rows = saved(rows.withColumn("_row", F.monotonically_increasing_id()))
    labels = F.split("host", r"\.")
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(deepest))), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    tried = rows.select("_row", "path", F.explode(F.when(F.lit(deepest) > 0, parents).otherwise(F.array())).alias("_domain"))
    fits = tried.join(sent, "_domain").where(F.col("path").startswith(F.col("_path")))
    best = saved(fits.groupBy("_row").agg(F.max(F.struct(F.length("rule"), "rule", "verdict")).alias("_best")))
    out = rows.join(best.hint("merge"), "_row", "left")
    return out.withColumns({"rule": F.col("_best.rule"), "rule_verdict": F.col("_best.verdict")}).drop("_row", "_best")


def filter_urls(
    urls: DataFrame, weights: list[float], rules: list[tuple[str, str]] | DataFrame = RULES, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url", carry: list[str] | None = None
) -> DataFrame:
    """One row per url: page_id, host, path, rule, score (the regression's, for block), verdict, and ``carry`` as the struct carried.

    A rule ``host/path`` fits its host and all subdomains if the url's path starts with its path; the longest wins (of equally long ones the
    greater string) and gives the verdict; where none fits, block means score >= threshold. A null url and one without ``://`` have empty host
    and path, which the method judges by its intercept and their few trigrams. Very long urls are whole strings as any other. Rows are
    judged one by one, repeated ones alike; an empty table gives no rows; other columns are not read but for ``carry``. ``rules``
    can be a list or a table (rule, verdict); a list of at most MOST_IN_PLAN needs no join.
    """
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    keep = carried(id_col, carry)
    rows = urls.select(keep.pop("doc_id").alias("page_id"), *(c.alias(n) for n, c in keep.items()), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_slots", F.array_distinct(slots(F.col("host"), F.col("path"))))
    table_ = F.split(F.lit(" ".join(map(repr, weights[:-1]))), " ").cast("array<double>")  # folded to one literal
    total = F.aggregate("_slots", F.lit(0.0), lambda s, k: s + F.get(table_, k))
    margin = F.lit(weights[-1]) + total / F.sqrt(F.greatest(F.size("_slots"), F.lit(1)))
    rows = with_rule(rows.withColumn("score", 1 / (1 + F.exp(-margin))).drop("_slots"), rules)
    by_score = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return rows.withColumn("verdict", F.coalesce("rule_verdict", by_score)).drop("rule_verdict")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), fit(spark)).select("page_id", "host", "path", "rule", "verdict")
