"""Quality rules with adaptive thresholds per language and source, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import store

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
SHARP = 5                 # a sketch bin is at most 1/32 of its value wide; values below 64 have a bin each
FENCE = 6                 # distances between quartiles above the upper quartile
PRIOR = 20                # rows that a parent's quartiles weigh as, against the group's own rows
#: rule -> the least distance between quartiles that counts: values that lie closer are not told apart
SPREADS = {"symbols": 15, "dup_lines": 45, "word_length": 80}
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def measured(docs: DataFrame, prefix: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the base measures as bigint columns named ``prefix`` + measure.

    n_words, word_chars (code points in words), n_symbols, n_lines and n_dup_lines (lines with a word; equal to an
    earlier one), n_repeat_words (words in 5-word windows found twice or more).  Null text measures 0.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    w, lines, g, s, at = (F.col(prefix + c) for c in ("w", "l", "g", "s", "at"))
    out = docs.withColumns({
        prefix + "w": word_array(F.col(text_col)),
        prefix + "l": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    windows = F.when(F.size(w) > 4, F.transform(
        F.sequence(F.lit(0), F.size(w) - 5), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(5))))).otherwise(
        F.array().cast("array<bigint>"))
    out = out.withColumns({
        prefix + "n_words": F.size(w).cast("long"), prefix + "word_chars": F.length(F.array_join(w, "")).cast("long"),
        prefix + "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        prefix + "n_lines": F.size(lines).cast("long"),
        prefix + "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"), prefix + "g": windows})
    # Columns of their own, not nested lambdas: a lambda's inner arrays would be made anew for every element.
    # Windows sorted by hash stand beside their equals; the repeated ones' sorted starts give the covered words.
    out = out.withColumn(prefix + "s", F.when(F.size(F.array_distinct(g)) < F.size(g), F.sort_array(
        F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    out = out.withColumn(prefix + "at", F.sort_array(F.transform(F.filter(s, lambda x, i: F.coalesce(
        F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))
    again = F.aggregate(F.transform(at, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(at, k + 1) - x, F.lit(5)))),
                        F.lit(0), lambda a, x: a + x)
    return out.withColumn(prefix + "n_repeat_words", F.coalesce(again, F.lit(0)).cast("long")).drop(
        *(prefix + c for c in ("w", "l", "g", "s", "at")))


def base_failed(m) -> Column:
    return (m("n_words") < MIN_WORDS) | (100 * m("n_repeat_words") > MAX_REPEAT_PERCENT * m("n_words"))


def ratios(m) -> dict[str, Column]:
    """The adaptive rules' values, as integers so that sketches hold exact counts: symbols per 1000 word characters,
    repeated lines per 1000 lines, hundredths of a word's mean length."""
    def per(a, b, k):
        return F.when(b > 0, F.floor(a * k / F.greatest(b, F.lit(1)))).otherwise(0).cast("long")

    return {"symbols": per(m("n_symbols"), m("word_chars"), 1000), "dup_lines": per(m("n_dup_lines"), m("n_lines"), 1000),
            "word_length": per(m("word_chars"), m("n_words"), 100)}


def sketch_bin(value: str) -> str:
    """SQL of the largest value in ``value``'s bin: exact below 64, then 32 bins for each doubling."""
    step = f"shiftleft(1L, greatest(0, length(bin({value})) - {SHARP + 1}))"
    return f"(({value} div {step}) + 1) * {step} - 1"


def sketches(values: DataFrame, keys: list[str], rules: list[str]) -> DataFrame:
    """(keys, rule, bin, n): mergeable histograms; two tables' sketches merge by adding n."""
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.expr(sketch_bin(r)).alias("bin")) for r in rules)))
    return values.select(*keys, each.alias("x")).groupBy(*keys, "x.rule", "x.bin").agg(F.count(F.lit(1)).alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rule, total, q1, q3) of every group and rule, from its histogram."""
    w = Window.partitionBy(*keys, "rule").orderBy("bin")
    ranked = sketch.withColumn("upto", F.sum("n").over(w)) \
        .withColumn("total", F.sum("n").over(Window.partitionBy(*keys, "rule")))
    return ranked.groupBy(*keys, "rule").agg(
        F.max("total").alias("total"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bin"))).alias("q3"))


def thresholds(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group with a column ``top_<rule>``: upper quartile + FENCE * quartile distance (SPREADS at least).

    Sketches merge upwards: dropping the last key and adding the counts gives the parent's sketch, up to the whole corpus.  A
    group's quartiles are drawn to its parent's, which weigh as PRIOR rows: (total * own + PRIOR * parent) div (total + PRIOR).  So
    a group of a few rows is judged by its language, a rare language by the corpus, and a large group by itself.
    """
    merged = sketch.groupBy("rule", "bin").agg(F.sum("n").alias("n"))
    above = quartiles(merged, []).select("rule", F.col("q1").alias("up1"), F.col("q3").alias("up3"))
    for depth in range(1, len(keys) + 1):
        mine = keys[:depth]
        level = quartiles(sketch.groupBy(*mine, "rule", "bin").agg(F.sum("n").alias("n")), mine)
        parent = above.select(*(F.col(k).alias("up_" + k) for k in mine[:-1]), F.col("rule").alias("up_rule"), "up1", "up3")
        on = F.col("rule") == F.col("up_rule")
        for k in mine[:-1]:
            on = on & F.col(k).eqNullSafe(F.col("up_" + k))
        drawn = [F.expr(f"(total * q{i} + {PRIOR} * up{i}) div (total + {PRIOR})").alias(f"up{i}") for i in (1, 3)]
        above = level.join(parent, on).select(*mine, "rule", *drawn)
    spread = F.element_at(F.create_map(*(F.lit(x) for r, f in SPREADS.items() for x in (r, f))), F.col("rule"))
    top = above.select(*keys, "rule", (F.col("up3") + FENCE * F.greatest(spread, F.col("up3") - F.col("up1"))).alias("top"))
    return top.groupBy(*keys).agg(*(F.max(F.when(F.col("rule") == r, F.col("top"))).alias(f"top_{r}") for r in SPREADS))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def judged(docs: DataFrame, carry: list[str], text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source") -> tuple[DataFrame, str]:
    """The columns ``carry`` of every row of ``docs`` with measures and verdict, and the prefix of the added columns.

    Added: MEASURES, base_failed, the rules' values (symbols, dup_lines, word_length), their thresholds (top_...), kept.
    A row is kept when the base rules pass (10 words or more, at most a fifth of them in repeated 5-word windows)
    and no value lies above the threshold of its language and source.  Thresholds are upper quartile + 6 quartile
    distances over the rows that pass the base rules, read from mergeable histogram sketches of the group, its
    language and the corpus (see ``thresholds``).  The texts are measured once: carried columns and measures are a written table.

    Null language or source is a group of its own; null text counts as empty and fails; repeated rows count each;
    columns of ``docs`` with the added names keep their content, for the prefix then differs.
    """
    p = "q_"
    while any(c.lower().startswith(p) for c in docs.columns):
        p = "q" + p

    def m(c):
        return F.col(p + c)

    keys = [p + "lang", p + "source"]
    wide = measured(docs.withColumns({keys[0]: F.col(lang_col), keys[1]: F.col(source_col)}), p, text_col)
    held, _ = store(wide.select(*carry, *keys, *(m(c) for c in MEASURES), base_failed(m).alias(p + "base_failed"),
                                *(v.alias(p + k) for k, v in ratios(m).items())), "measured")
    passed = held.where(~m("base_failed")).select(*keys, *(m(r).alias(r) for r in SPREADS))
    limits = thresholds(sketches(passed, keys, list(SPREADS)), keys).select(
        *(F.col(k).alias(k + "_limit") for k in keys), *(F.col(f"top_{r}").alias(f"{p}top_{r}") for r in SPREADS))
    fine = ~m("base_failed")
    for rule in SPREADS:
        fine = fine & (m(rule) <= m("top_" + rule))
    out = held.join(limits, F.col(keys[0]).eqNullSafe(F.col(keys[0] + "_limit"))
                    & F.col(keys[1]).eqNullSafe(F.col(keys[1] + "_limit")), "left")
    return out.withColumn(p + "kept", F.coalesce(fine, F.lit(False))).drop(*keys, *(k + "_limit" for k in keys)), p


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source") -> DataFrame:
    """One row per document: id_col, the base measures, base_failed, kept, the rules' values and thresholds."""
    out, p = judged(docs, [id_col], text_col, lang_col, source_col)
    first = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines")
    return out.select(id_col, *(F.col(p + c).alias(c) for c in (*first, *SPREADS, *(f"top_{r}" for r in SPREADS))))


def filtered(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    out, p = judged(docs, docs.columns, text_col, lang_col, source_col)
    return out.where(F.col(p + "kept")).select(*docs.columns)
