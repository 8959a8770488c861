"""Quality rules with thresholds that follow each language and source.

Rates of every document (whole numbers) go into quantile sketches: values rounded to
their six leading bits, with counts. Sketches merge by adding counts, so those of a
language or of the whole corpus are sums of those per language and source, and their
size depends on the number range, not on the documents. A document is rejected when a
rate lies many spreads beyond the median of its group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.shared import SEPARATORS, stored, whole_text, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: Documents a group needs for thresholds of its own; smaller ones take the next level.
GROUP_ROWS = 100
#: Spreads (median to the tenth or ninetieth percentile) that are tolerated.
SPREADS = 10
LEVELS = ["group", "language", "corpus"]


def _per(part: str, whole: str, times: int) -> Column:
    return F.floor(F.col(part) * times / F.greatest(F.col(whole), F.lit(1))).cast("long")


#: Rate: part, whole, times, and how far it may always leave the median.
RATES = {
    "symbol_rate": ("n_symbols", "n_words", 1000, 200),
    "dup_line_rate": ("n_dup_lines", "n_lines", 1000, 300),
    "repeat_rate": ("n_repeat_words", "n_words", 1000, 100),
    "word_length": ("word_chars", "n_words", 100, 300),
}


def text_counts(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, source and the counts that the rules are made of.

    A null or empty text has no words and no lines; null languages and sources count as
    empty ones. Long texts stay in one row: everything is linear but for one sort of the
    text's windows. Rows are kept one by one; other columns do not matter.
    """
    text = whole_text()
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        F.length(F.translate(text, SEPARATORS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        F.transform(words(text), lambda w: F.xxhash64(w)).alias("_words"),
    )
    # Each array is used more than once below, so Spark computes it once and for all.
    counted = rows.select(
        "doc_id",
        "lang",
        "source",
        "word_chars",
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)),
                lambda i: F.struct(F.xxhash64(F.slice("_words", i, WINDOW)).alias("h"), i.alias("i")),
            ),
        ).alias("_windows"),
    )
    ordered = counted.withColumn("_windows", F.sort_array("_windows"))
    twins = F.zip_with(
        "_windows",
        F.slice("_windows", F.lit(2), F.size("_windows")),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull()))))
    placed = ordered.withColumn("_places", places).drop("_windows")
    # A place covers the words up to the next place, but no more than a window.
    covered = F.zip_with(
        "_places",
        F.slice("_places", F.lit(2), F.size("_places")),
        lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)).cast("long"),
    )
    repeated = F.aggregate(covered, F.lit(0).cast("long"), lambda total, x: total + x)
    return placed.withColumn("n_repeat_words", F.coalesce(repeated, F.lit(0).cast("long"))).drop("_places")


def _rounded(value: Column) -> Column:
    """The number cut to its six leading bits."""
    bits = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.floor(value / F.pow(F.lit(2), bits)).cast("long") * F.pow(F.lit(2), bits).cast("long")


def sketches(counts: DataFrame) -> DataFrame:
    """lang, source, rate, value, n: one sketch per language, source and rate."""
    rates = F.explode(
        F.map_from_arrays(
            F.array(*[F.lit(x) for x in RATES]),
            F.array(*[_rounded(_per(*r[:3])) for r in RATES.values()]),
        )
    ).alias("rate", "value")
    return counts.select("lang", "source", rates).groupBy("lang", "source", "rate", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def thresholds(merged: DataFrame, keys: list[str]) -> DataFrame:
    """low and high per group and rate, from a sketch table with `n` per `value`."""
    group = Window.partitionBy(*keys, "rate")
    ranked = merged.select(
        *keys,
        "rate",
        "value",
        F.sum("n").over(group.orderBy("value")).alias("upto"),
        F.sum("n").over(group).alias("total"),
    )

    def quantile(percent: int) -> Column:
        return F.min(F.when(F.col("upto") * 100 >= F.col("total") * percent, F.col("value")))

    found = ranked.groupBy(*keys, "rate").agg(
        quantile(10).alias("q10"), quantile(50).alias("q50"), quantile(90).alias("q90"), F.max("total").alias("rows")
    )
    slack = F.coalesce(*[F.when(F.col("rate") == name, F.lit(r[3])) for name, r in RATES.items()])
    return found.select(
        *keys,
        "rate",
        "rows",
        (F.col("q50") - SPREADS * (F.col("q50") - F.col("q10")) - slack).alias("low"),
        (F.col("q50") + SPREADS * (F.col("q90") - F.col("q50")) + slack).alias("high"),
    )


def _wide(limits: DataFrame, keys: list[str], level: str) -> DataFrame:
    """One row per group, with its number of rows and a low and a high of each rate."""
    pick = [
        F.max(F.when(F.col("rate") == name, F.col(side))).alias(f"{level}_{side}_{name}")
        for name in RATES
        for side in ("low", "high")
    ]
    return limits.groupBy(*keys).agg(F.max("rows").alias(f"{level}_rows"), *pick)


def judge(docs: DataFrame) -> DataFrame:
    """One row per document with its counts, `base_failed` and `kept`.

    `base_failed`: fewer than 10 words, or more than 20 % of them in repeated windows of
    five. Such documents are not kept and do not shape thresholds. The others are kept
    unless a rate lies outside the limits of their language and source, or, for groups
    of under 100 such documents, of their language or the corpus. No documents: no rows.
    """
    counts = text_counts(docs).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")),
    )
    counts = stored(counts, "counts")
    parts = stored(sketches(counts.filter(~F.col("base_failed"))), "sketches")
    judged = counts
    for level, keys in zip(LEVELS, (["lang", "source"], ["lang"], []), strict=True):
        merged = parts.groupBy(*keys, "rate", "value").agg(F.sum("n").alias("n"))
        limits = _wide(thresholds(merged, keys), keys, level)
        judged = judged.join(limits, keys, "left") if keys else judged.join(F.broadcast(limits), how="left")
    enough = [F.col(f"{level}_rows") >= GROUP_ROWS for level in LEVELS[:2]]

    def limit(side: str, name: str) -> Column:
        group, language, corpus = (F.col(f"{level}_{side}_{name}") for level in LEVELS)
        return F.when(enough[0], group).when(enough[1], language).otherwise(corpus)

    inside = F.lit(True)
    for name, rate in RATES.items():
        value = _per(*rate[:3])
        inside = inside & (value >= limit("low", name)) & (value <= limit("high", name))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"),
    )
