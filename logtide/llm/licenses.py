"""Licences of files: statements compared with templates, then inherited along paths.

Lines, comment runs, paragraphs and sliding windows of terms are compared with template
statements, headers, licence texts and tags by the cosine of sparse TF-IDF vectors. How
many files have each of the templates' terms is counted first. What resembles a template
must have enough of its rarer terms, so other files are left where they are read. Of the
rest, windows are looked for around the rarest terms, and units are left out whose terms of
the templates, against the number of the others, are too few. Terms of what remains are
rows, which are counted, weighed and summed. A file has the licence of its best unit. A licence file, by its name
or because such a unit is a large part of it, licenses its directory; files without one
take the licence of the nearest directory above. Directories, not files, meet their
ancestors.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.license_scores import TAG_START, Lexicon
from logtide.llm.license_texts import BLOCKS
from logtide.llm.shared import stored, whole_text, words

#: Usual statements of common licences, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under Creative Commons Attribution NonCommercial, CC BY-NC 4.0",
    "CC0-1.0": "Dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License. Permission is hereby granted, free of charge",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
}
#: Every template has one of these words; what has none must come closer to a template.
SPEAKS = "(?i)licen[cs]e|copyright|permission|permitted|public domain"
NAMES = "(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
TERM = "[a-z0-9]+([.-][a-z0-9]+)*"
THRESHOLD = 0.5
#: Windows have the size of their template, so what states a licence comes closer to it.
WINDOW_THRESHOLD = 0.7
#: Words of any English prose, which are looked at last.
COMMON = (
    "a an and any are as at be but by for from following form free have in is it may must no not of on or other "
    "software source code terms that the their this to under use work with without you your 1 2 3"
).split()
#: Share of a file's words that makes it a licence file, in percent.
MOSTLY = 20
DIGITS = 6
#: `TERM` without ways back, so that a term of many parts needs no deep stack.
_TERM = "[a-z0-9]++(?:[.-][a-z0-9]++)*+"
_TAGGED = "spdx-license-identifier:"
_TAG = _TAGGED + "[\\x20\\t]*\\(?"
#: Lines that end a paragraph, and a run of comment lines; a line ends with a line feed only.
_BLANK = "(?md)^[\\x20\\t\\r]*$"
_NO_COMMENT = "(?md)^(?![\\x20\\t]*(?:#|//|/\\*|\\*|--|;|<!--|%|REM(?![A-Za-z0-9_]))).*$"
#: Part of the threshold's square that a template's most usual terms may have without being looked for.
SPENT = 0.8


def statements(
    files: DataFrame, templates: Mapping[str, str] = TEMPLATES, blocks: Sequence[tuple[str, str]] = BLOCKS
) -> DataFrame:
    """path, license, score and share (percent of the file's words) of what fits best in each file.

    Lines, runs of comment lines and paragraphs are compared with the statements; windows
    across line breaks and inside long lines with statements and blocks, under a higher
    threshold. Lines end with a line feed. Only files with a unit at or above its threshold
    have a row; of equal scores the first licence by name counts, of its units lines.
    """
    kinds = [Lexicon(list(templates.items()), COMMON, False)]
    kinds += [Lexicon(list(blocks), COMMON, True)] if blocks else []
    read = files.select("path", whole_text().alias("text"))
    read = _once(_once(read, "low", F.lower("text")), "terms", _terms(F.col("low")))
    known = sorted({name for x in kinds for name in x.names})
    counted = read.select(F.explode(F.array_intersect("terms", _texts(known))).alias("term")).groupBy("term").count()
    often = {r["term"]: r["count"] for r in counted.collect()}

    lines = _marks(kinds[0], THRESHOLD, often)
    close = [_marks(x, WINDOW_THRESHOLD, often) for x in kinds]
    marked = sorted({x["term"] for marks in (lines, *close) for mark in marks for x in mark["parts"]})
    read = _once(read, "marks", F.array_intersect("terms", _texts(marked)))
    told = _any(close[0], "marks") | (_speaks(F.col("low")) & _any(lines, "marks"))
    read = _once(read, "told", (F.size("marks") > 0) & told)
    near = F.col("told")
    if blocks:
        near |= ((F.size("marks") > 0) & _any(close[1], "marks")) | F.contains("low", F.lit(_TAGGED))
    kept = stored(read.filter(near).select("path", "text", "told"), "near-files")
    cuts = _units(kept.filter("told"), kinds[0]).unionByName(_windows(kept, kinds, often))
    cuts = stored(cuts.withColumn("id", F.monotonically_increasing_id()), "units")
    scores = _cosines(cuts, kinds).filter(F.col("score") >= F.col("least"))
    found = scores.join(cuts.select("id", "path", "kind", "share"), "id")
    best = F.min(F.struct((-F.col("score")).alias("down"), "license", "kind", (-F.col("share")).alias("share")))
    return found.groupBy("path").agg(best.alias("best")).select(
        "path", "best.license", (-F.col("best.down")).alias("score"), (-F.col("best.share")).alias("share")
    )


def _terms(low: Column) -> Column:
    return F.regexp_extract_all(low, F.lit(_TERM), F.lit(0))


def _texts(names: Sequence[str]) -> Column:
    return F.expr(f"CAST(array({', '.join(map(repr, names))}) AS array<string>)")


def _speaks(low: Column) -> Column:
    return low.rlike(SPEAKS)


def _once(table: DataFrame, name: str, value: Column) -> DataFrame:
    """`table` with a column that is computed once, not again wherever it is named."""
    return table.select("*", F.explode(F.array(value)).alias(name))


_MARK = "least double, parts array<struct<term: string, part: double>>"


def _marks(lexicon: Lexicon, threshold: float, often: Mapping[str, int], spent: float = SPENT) -> list[dict]:
    """Of each template the terms that count, their parts of its squared weight, and their least sum."""
    rows = zip(*lexicon.anchors(threshold, spent, often), strict=True)
    return [
        # A little less, as doubles are summed in any order.
        {"least": float(least) - 1e-9, "parts": _entries(lexicon, row, part=row)} for row, least in rows
    ]


def _entries(lexicon: Lexicon, row: Sequence[float], **columns: Sequence[float]) -> list[dict]:
    some = [i for i, x in enumerate(row) if x > 0]
    return [{"term": lexicon.names[i]} | {k: float(x[i]) for k, x in columns.items()} for i in some]


def _literal(rows: list[dict], shape: str) -> Column:
    """An array of structs, which Catalyst reads once."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{shape}>>")


def _enough(mark: Column, held: str) -> Column:
    """Whether the different terms in `held` have the least sum."""

    def add(total: Column, x: Column) -> Column:
        return total + F.when(F.array_contains(held, x["term"]), x["part"]).otherwise(0.0)

    return F.aggregate(mark["parts"], F.lit(0.0), add) >= mark["least"]


def _any(marks: list[dict], held: str) -> Column:
    return F.exists(_literal(marks, _MARK), lambda mark: _enough(mark, held))


def _units(files: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Lines, runs of comment lines and paragraphs that may reach their thresholds, as terms.

    A unit's vector is at least as long as its terms that are the template's, and the terms
    that are in no template with the weight of those that occur once.
    """

    def runs(ends: str) -> Column:
        pieces = F.transform(F.split("text", ends, -1), lambda x: F.trim(x, F.lit("\n")))
        return F.filter(pieces, lambda x: F.contains(x, F.lit("\n")))

    every = F.concat(F.split("text", "\n", -1), runs(_NO_COMMENT), runs(_BLANK))
    units = _once(files.select("path", "text"), "n_words", F.size(words(F.col("text"))))
    units = units.select("path", "n_words", F.explode(every).alias("unit"))
    units = _once(_once(units, "low", F.lower("unit")), "said", _terms(F.col("low")))
    units = _once(units, "held", F.filter("said", lambda x: x.isin(lexicon.names)))
    units = _once(units.filter(F.size("held") > 0), "different", F.array_distinct("held"))
    units = _once(units, "speaks", _speaks(F.col("low")))
    others = (F.size("said") - F.size("held")) * F.lit(lexicon.rare**2)

    def weighed(x: Column) -> Column:
        own = F.size(F.filter("held", lambda y: y == x["term"])) * x["idf"]
        return F.struct(own.alias("own"), x["weight"].alias("weight"))

    def add(total: Column, x: Column) -> Column:
        dot = total["dot"] + x["own"] * x["weight"]
        return F.struct(dot.alias("dot"), (total["square"] + x["own"] * x["own"]).alias("square"))

    def near(mark: Column, threshold: float) -> Column:
        start = F.struct(F.lit(0.0).alias("dot"), others.alias("square"))
        least = (threshold - 1e-5) * mark["norm"]
        reaches = F.aggregate(
            F.transform(mark["parts"], weighed), start, add, lambda sums: sums["dot"] >= least * F.sqrt(sums["square"])
        )
        return _enough(mark, "different") & reaches

    def may(threshold: float) -> Column:
        marks = [
            mark | {"norm": float(norm), "parts": _entries(lexicon, row, part=(row / norm) ** 2, idf=lexicon.idf, weight=row)}
            for mark, row, norm in zip(_marks(lexicon, threshold, {}, 0.0), lexicon.weights, lexicon.norms, strict=True)
        ]
        shape = "least double, norm double, parts array<struct<term: string, part: double, idf: double, weight: double>>"
        return F.exists(_literal(marks, shape), lambda mark: near(mark, threshold))

    units = units.filter(F.when(F.col("speaks"), may(THRESHOLD)).otherwise(may(WINDOW_THRESHOLD)))
    return units.select(
        "path",
        F.lit(0).alias("s"),
        F.lit(None).cast("int").alias("template"),
        F.when(F.col("speaks"), THRESHOLD).otherwise(WINDOW_THRESHOLD).alias("least"),
        F.lit(0).alias("kind"),
        _percent(F.size(words(F.col("unit"))), F.col("n_words")).alias("share"),
        "said",
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.floor(100 * part.cast("long") / F.greatest(whole, F.lit(1))).cast("long")


def _windows(files: DataFrame, kinds: Sequence[Lexicon], often: Mapping[str, int]) -> DataFrame:
    """Windows whose terms may reach the threshold, as terms.

    They have the template's size and start at every eighth of it. Each has one of the
    template's rarest terms and is found from the first of them in it.
    """
    looks, pivots = [], []
    for s, lexicon in enumerate(kinds):
        every = _marks(lexicon, WINDOW_THRESHOLD, often, 0.0)
        rarest = _marks(lexicon, WINDOW_THRESHOLD, often, 1.0)
        for i, (mark, rare, size) in enumerate(zip(every, rarest, map(int, lexicon.sizes), strict=True)):
            own = [x["term"] for x in rare["parts"]]
            pivots += [(name, len(looks), s, i, size, max(size // 8, 1)) for name in own]
            looks.append(mark | {"rarest": own})
    look = F.get(_literal(looks, _MARK + ", rarest array<string>"), F.col("look"))
    shape = "term string, look int, s int, template int, size int, step int"
    pivots = F.broadcast(files.sparkSession.createDataFrame(pivots, shape))

    low, tagged = F.col("low"), F.contains("low", F.lit(_TAGGED))
    read = _once(files.select("path", "text"), "low", F.lower("text"))
    # A text with tags has other terms where those count.
    plain = F.struct(F.lit(True).alias("plain"), (~tagged).alias("tags"), _terms(low).alias("terms"))
    named = _terms(F.regexp_replace("low", _TAG, TAG_START.decode()))
    named = F.struct(F.lit(False).alias("plain"), F.lit(True).alias("tags"), named.alias("terms"))
    read = read.select("path", F.inline(F.when(tagged, F.array(plain, named)).otherwise(F.array(plain))))
    hits = read.select("*", F.posexplode("terms").alias("pos", "term")).join(pivots, "term")
    hits = hits.filter(F.when(F.col("s") == 0, F.col("plain")).otherwise(F.col("tags")))
    places = ["path", "n_terms", "look", "s", "template", "size", "step", "pos", "begin"]
    hits = hits.withColumns({"n_terms": F.size("terms"), "begin": F.greatest(F.col("pos") - F.col("size") + 1, F.lit(0))})
    around = F.slice("terms", F.col("begin") + 1, F.col("pos") + F.col("size") - F.col("begin"))
    hits = hits.select(*places, F.explode(F.array(around)).alias("around")).filter(_enough(look, "around"))
    first = F.ceil(F.col("begin") / F.col("step")).cast("int")
    turns = F.sequence(first, F.floor(F.col("pos") / F.col("step")).cast("int"))
    cuts = hits.withColumn("turn", F.explode(turns)).withColumn("start", F.col("turn") * F.col("step"))
    cuts = _once(cuts, "said", F.slice("around", F.col("start") - F.col("begin") + 1, F.col("size")))
    earlier = F.slice("said", F.lit(1), F.col("pos") - F.col("start"))
    cuts = cuts.filter(~F.arrays_overlap(earlier, look["rarest"]) & _enough(look, "said"))
    return cuts.select(
        "path",
        "s",
        "template",
        F.lit(WINDOW_THRESHOLD).alias("least"),
        (F.col("s") + 1).alias("kind"),
        _percent(F.size("said"), F.col("n_terms")).alias("share"),
        "said",
    )


def _cosines(cuts: DataFrame, kinds: Sequence[Lexicon]) -> DataFrame:
    """id, least, license, score of units with their own template, or all where they have none."""
    spark = cuts.sparkSession
    idf = [(s, n, float(x)) for s, k in enumerate(kinds) for n, x in zip(k.names, k.idf, strict=True)]
    weights = [
        (s, k.names[i], t, name, float(k.weights[t, i]), float(k.norms[t]))
        for s, k in enumerate(kinds)
        for t, name in enumerate(k.licenses)
        for i in k.weights[t].nonzero()[0].tolist()
    ]
    idf = F.broadcast(spark.createDataFrame(idf, "s int, term string, idf double"))
    shape = "s int, term string, other int, license string, theirs double, norm double"
    weights = F.broadcast(spark.createDataFrame(weights, shape))
    rare, times = F.lit(kinds[0].rare), F.col("times").cast("double")
    for s, k in enumerate(kinds):
        rare = F.when(F.col("s") == s, k.rare).otherwise(rare)
        times = F.when((F.col("s") == s) & F.lit(k.damp), F.log("times") + 1.0).otherwise(times)
    unit = ["id", "s", "template", "least"]
    rows = cuts.select(*unit, F.explode("said").alias("term")).repartition("id")
    counts = rows.groupBy(*unit, "term").agg(F.count(F.lit(1)).alias("times")).join(idf, ["s", "term"], "left")
    counts = counts.withColumn("own", times * F.coalesce("idf", rare))
    named = F.when(F.col("idf").isNotNull(), F.struct("term", "own"))
    whole = counts.groupBy(*unit).agg(F.sum(F.col("own") * F.col("own")).alias("square"), F.collect_list(named).alias("named"))
    pairs = whole.select(*unit, "square", F.inline("named")).join(weights, ["s", "term"])
    pairs = pairs.filter(F.coalesce(F.col("template") == F.col("other"), F.lit(True)))
    dots = pairs.groupBy("id", "least", "square", "other", "license", "norm").agg(
        F.sum(F.col("own") * F.col("theirs")).alias("dot")
    )
    score = F.round(F.col("dot") / (F.col("norm") * F.sqrt("square")), DIGITS)
    return dots.select("id", "least", "license", score.alias("score"))


def directory(path: Column) -> Column:
    """What stands before the last slash; the empty root where there is none."""
    return F.regexp_replace(F.regexp_replace(path, "[^/]*$", ""), "/$", "")


def scan(
    files: DataFrame, templates: Mapping[str, str] = TEMPLATES, blocks: Sequence[tuple[str, str]] = BLOCKS
) -> DataFrame:
    """One row per file: path, own_license, score, license, license_dir.

    `files` has path and text. `license` is the file's own or that of the nearest
    directory at or above its own which has a licence file; `license_dir` names that
    directory where it is inherited. Of several licence files in a directory the one
    with the first path counts. A null text says nothing; a null path counts as empty
    and lies in the root. Rows that repeat a path share what any of them says. No files
    give no rows; other columns do not matter.
    """
    rows = files.select(F.coalesce("path", F.lit("")).alias("path"), whole_text().alias("text"))
    said = stored(statements(rows, templates, blocks), "statements")
    legal = said.filter(F.col("path").rlike(NAMES) | (F.col("share") >= MOSTLY))
    licensed = legal.groupBy(directory(F.col("path")).alias("above")).agg(
        F.min_by("license", "path").alias("inherited")
    )
    # A directory meets its ancestors once, however many files it has.
    places = rows.select(directory(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    depths = F.sequence(F.lit(0), F.size(parts))
    above = F.transform(depths, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    ancestors = places.select("dir", F.posexplode(F.array_distinct(above)).alias("depth", "above"))
    nearest = ancestors.join(licensed, "above").groupBy("dir").agg(
        F.max_by(F.struct("above", "inherited"), "depth").alias("near")
    )
    placed = rows.select("path").join(said.drop("share"), "path", "left")
    placed = placed.withColumn("dir", directory(F.col("path"))).join(nearest, "dir", "left")
    return placed.select(
        "path",
        F.col("license").alias("own_license"),
        "score",
        F.coalesce("license", "near.inherited").alias("license"),
        F.when(F.col("license").isNull(), F.col("near.above")).alias("license_dir"),
    )
