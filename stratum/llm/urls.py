"""URL filtering: rules, and gradient-boosted trees on lexical features for the rest, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import smallest_hashes
from .store import store, unstore

#: (host and path prefix, verdict); a rule fits its host and all subdomains when the url's path starts with its path
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("net/fr/", "block"))
FEATURES = ("length", "depth", "digits", "entropy", "params", "host_labels", "path_length", "suffix_rows", "suffix_blocked")
BINS = 16


@dataclass(frozen=True)
class Boosting:
    """``sample`` bounds the labelled rows that trees are fitted on (the rows of the smallest url hashes)."""

    trees: int = 8
    depth: int = 3
    rate: float = 0.4
    ridge: float = 1.0
    sample: int = 20_000


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, url, host, path) of every row: see ``filter_urls``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    base = pages.select(F.col(id_col).alias("id"), url.alias("url"), rest.alias("rest"))
    host = F.regexp_extract("rest", r"^[^/?#]*", 0)
    return base.select("id", "url", lower_ascii(host).alias("host"), F.regexp_extract(
        F.substr(F.col("rest"), F.length(host) + 1), r"^[^?#]*", 0).alias("path"))


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: len(r[0])):      # the longest is tested first
        domain, _, prefix = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + prefix)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def lexical(rows: DataFrame) -> DataFrame:
    """Adds the features of (url, host, path) that need no other row, and the host's last label as ``suffix``."""
    url = F.col("url")
    n = F.length(url)
    chars = F.split(url, "")
    # entropy in bits of the characters; sorting brings equal characters together, so it needs no nested scan
    ordered = F.array_sort(F.filter(chars, lambda c: c != ""))
    rows = rows.withColumn("cs", ordered).withColumn("ends", F.filter(F.transform("cs", lambda c, i: F.when(
        F.coalesce(F.get("cs", i + 1) == c, F.lit(False)), F.lit(0)).otherwise(i + 1)), lambda i: i > 0))
    counts = F.transform("ends", lambda e, k: (e - F.coalesce(F.get("ends", k - 1), F.lit(0))).cast("double"))
    entropy = F.when(n > 0, F.log2(n.cast("double")) - F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * F.log2(c)) / n).otherwise(0.0)
    return rows.withColumns({
        "length": n.cast("double"), "depth": F.regexp_count(F.col("path"), F.lit("/")).cast("double"),
        "digits": F.when(n > 0, F.regexp_count(url, F.lit("[0-9]")) / n).otherwise(0.0), "entropy": entropy,
        "params": F.when(F.instr(url, "?") > 0, 1 + F.regexp_count(url, F.lit("&"))).otherwise(0).cast("double"),
        "host_labels": F.regexp_count(F.col("host"), F.lit(r"[^.]+")).cast("double"),
        "path_length": F.length("path").cast("double"), "suffix": F.regexp_extract("host", r"[^.]*$", 0)}).drop("cs", "ends")


def with_suffixes(rows: DataFrame) -> DataFrame:
    """Adds statistics of each suffix over all rows: log of its rows, and the blocked share of its ruled rows."""
    stats = rows.groupBy("suffix").agg(F.log2(F.count(F.lit(1)) + 1).alias("suffix_rows"), (
        (F.count_if(F.col("verdict") == "block") + 1) / (F.count("verdict") + 2)).alias("suffix_blocked"))
    return rows.join(stats, "suffix")


def fit(labelled: DataFrame, boosting: Boosting) -> Column:
    """The log-odds of "block" as an expression over FEATURES, from rows with a 0/1 column ``y``.

    Every level of every tree is one grouped sum of gradients and curvatures over (leaf, feature, bin): as many rows
    as leaves x features x bins reach the driver, whatever the number of labelled rows.
    """
    cut_row = labelled.agg(*(F.percentile_approx(f, [k / BINS for k in range(1, BINS)], 10000).alias(f) for f in FEATURES),
                           F.avg("y").alias("mean"), F.count(F.lit(1)).alias("n")).first()
    if not cut_row["n"] or cut_row["mean"] in (0.0, 1.0):
        return F.lit(0.0 if not cut_row["n"] else (4.0 if cut_row["mean"] else -4.0))
    cuts = {f: sorted(set(cut_row[f])) for f in FEATURES}
    mean = min(max(cut_row["mean"], 1e-3), 1 - 1e-3)
    import math

    base = math.log(mean / (1 - mean))
    score = F.lit(base)
    binned, path = store(labelled.select("y", *FEATURES, F.array(*(F.struct(
        F.lit(f).alias("f"), sum(((F.col(f) > c).cast("int") for c in cuts[f]), F.lit(0)).alias("b")) for f in FEATURES)).alias("x")).coalesce(4), "binned")
    for _ in range(boosting.trees):
        p = 1 / (1 + F.exp(-score))
        rows = binned.withColumn("g", F.col("y") - p).withColumn("h", p * (1 - p))
        splits: dict[int, tuple[str, float]] = {}      # node -> (feature, bound); children 2k + 1 (at most) and 2k + 2
        open_nodes, values = {0}, {}
        for _level in range(boosting.depth):
            leaf = _leaf(splits, 0)
            sums = rows.select(leaf.alias("leaf"), F.explode("x").alias("x"), "g", "h").groupBy("leaf", "x.f", "x.b").agg(
                F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            for node in sorted(open_nodes):
                here = [r for r in sums if r.leaf == node]
                one = [r for r in here if r.f == FEATURES[0]]
                g, h = sum(r.g for r in one), sum(r.h for r in one)
                values[node] = boosting.rate * g / (h + boosting.ridge)
                best = (1e-6, None, None, 0.0, 0.0)
                for f in FEATURES:
                    gl = hl = 0.0
                    by = {r.b: r for r in here if r.f == f}
                    for b, bound in enumerate(cuts[f]):
                        if b in by:
                            gl, hl = gl + by[b].g, hl + by[b].h
                        gain = gl * gl / (hl + boosting.ridge) + (g - gl) ** 2 / (h - hl + boosting.ridge) - g * g / (h + boosting.ridge)
                        if gain > best[0] + 1e-9 and hl > 1e-3 and h - hl > 1e-3:
                            best = (gain, f, bound, gl, hl)
                open_nodes.discard(node)
                if best[1] is not None:
                    _, f, bound, gl, hl = best
                    splits[node] = (f, bound)
                    open_nodes |= {2 * node + 1, 2 * node + 2}
                    values[2 * node + 1] = boosting.rate * gl / (hl + boosting.ridge)
                    values[2 * node + 2] = boosting.rate * (g - gl) / (h - hl + boosting.ridge)
            if not open_nodes:
                break
        score = score + _leaf(splits, 0, values)
    unstore(labelled.sparkSession, path)
    return score


def _leaf(splits: dict, node: int, values: dict | None = None) -> Column:
    if node not in splits:
        return F.lit(node if values is None else float(values.get(node, 0.0)))
    f, bound = splits[node]
    return F.when(F.col(f) <= bound, _leaf(splits, 2 * node + 1, values)).otherwise(_leaf(splits, 2 * node + 2, values))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
                boosting: Boosting | None = None) -> DataFrame:
    """Per row of ``pages``: id_col, host, path, rule, verdict, block_score.

    host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``,
    ``#`` or the end; both empty for a null url or one without ``://``.  ``rule`` is the longest rule that fits, else
    null; ``verdict`` is the rule's, else "block" where the boosted trees give it log-odds above 0.  The trees are
    trained on urls that a rule decides (their verdicts are the labels), at most ``boosting.sample`` of them, those
    with the smallest hashes; suffix statistics count all rows.  Without labelled urls, or with one label only,
    the score is a constant.  Null ids and repeated rows are judged like any row; an empty table gives no rows.
    """
    boosting = boosting or Boosting()
    base = parts(pages, id_col, url_col)
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    slim, _ = store(lexical(base.withColumns({"rule": rule, "verdict": verdict})), "urls")
    rows = with_suffixes(slim)
    known = rows.where("verdict IS NOT NULL").withColumn("y", (F.col("verdict") == "block").cast("double"))
    labelled, label_path = store(smallest_hashes(known, F.xxhash64("url", "id"), boosting.sample).select("y", *FEATURES), "labelled")
    score = fit(labelled, boosting)
    unstore(pages.sparkSession, label_path)
    return rows.withColumn("block_score", score).select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("block_score") > 0, "block").otherwise("allow")).alias("verdict"), "block_score")
