"""Repeated passages of words by prefix-partitioned suffix trees.

A suffix of a text is told by the words it starts with, 20 of them being enough here:
five symbols of four words each. Suffixes whose start can repeat (see `seeds`) are
partitioned by prefixes of one, two, ... symbols: a prefix with too many suffixes for one
task is lengthened until its groups fit. Each group becomes a subtree, kept in array form:
suffixes in order, with the symbols each shares with the one before. Internal nodes of
depth five or more are the maximal repeats; of their suffixes all but the first occur
earlier as well. A group that is still too large at full depth holds one passage only; it
is dealt out, each part finds its own first suffix, and those meet once more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.seeds import (
    STEP,
    Prefixes,
    distinct_texts,
    repeated_seeds,
    results_for,
    symbols_of,
    with_places,
    word_bounds,
)
from logtide.llm.shared import column_bytes, discard, partitions_for, plain_batch, steps, stored

WINDOW = 20
SYMBOL = 4
GRAM = 8
DEPTH = WINDOW // SYMBOL
#: Suffixes in one subtree.
GROUP = 50_000
SUFFIX = "s1 long, s2 long, s3 int, first long, tie long, place int"


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes of windows that hold a repeated seed, with their first five symbols."""
    for batch in batches:
        first_ids, ties = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        lists = batch.column(2)
        list_at, list_all = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        data, offsets = column_bytes(batch.column(3))
        for first, last in steps(offsets, STEP):
            part = data[offsets[first] : offsets[last]]
            symbols, bounds = symbols_of(part, offsets[first : last + 1] - offsets[first], "words")
            if len(symbols) < WINDOW:
                continue
            text = np.repeat(np.arange(last - first), np.diff(list_at[first : last + 1]))
            seeds = list_all[list_at[first] : list_at[last]].astype(np.int64)
            low = np.maximum(seeds - (WINDOW - GRAM), 0) + bounds[text]
            high = np.minimum(seeds, np.diff(bounds)[text] - WINDOW) + bounds[text]
            fits = high >= low
            marks = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(marks, low[fits], 1)
            np.add.at(marks, high[fits] + 1, -1)
            starts = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
            if not len(starts):
                continue
            blocks = (Prefixes(symbols).runs(SYMBOL) >> np.uint64(20)).astype(np.uint32)
            s = [blocks[starts + SYMBOL * i].astype(np.uint64) for i in range(DEPTH)]
            text = np.searchsorted(bounds, starts, "right") - 1
            yield plain_batch(
                {
                    "s1": (s[0] << np.uint64(32) | s[1]).view(np.int64),
                    "s2": (s[2] << np.uint64(32) | s[3]).view(np.int64),
                    "s3": s[4].astype(np.uint32).view(np.int32),
                    "first": first_ids[first + text],
                    "tie": ties[first + text],
                    "place": (starts - bounds[text]).astype(np.int32),
                }
            )


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes below deep internal nodes; `leads` marks the first of each node.

    The rows come in the order of their symbols, so a subtree's leaves follow each other
    and only the node at the end of a batch has to be carried on.
    """
    before: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
        group, s1, s2, s3 = columns[0], *columns[1:4]
        key = np.stack([group, s1, s2, s3.astype(np.int64)], axis=1)
        # The symbols shared with the leaf before; a deep node ends where they are fewer.
        fewer = np.ones(len(key), bool)
        fewer[1:] = (key[1:] != key[:-1]).any(axis=1)
        if before is not None:
            fewer[0] = tuple(key[0]) != before
        before = tuple(key[-1])
        yield plain_batch(
            {
                "s1": s1,
                "s2": s2,
                "s3": s3,
                "first": columns[4],
                "tie": columns[5],
                "place": columns[6],
                "leads": fewer,
                "again": batch.column(7),
            }
        )


def repeats(suffixes: DataFrame) -> DataFrame:
    """first, tie, place of the suffixes whose first 20 words also start earlier."""
    keys = ["s1", "s2", "s3"]
    # Prefixes with more suffixes than a subtree takes; there are few, whatever the input.
    sized = suffixes
    for n in (1, 2, 3):
        counted = suffixes.groupBy(*keys[:n]).agg(F.count(F.lit(1)).alias(f"n{n}"))
        large = stored(counted.filter(F.col(f"n{n}") > GROUP), f"prefixes{n}")
        sized = sized.join(large, keys[:n], "left")
    parts = F.ceil(F.col("n3") / GROUP).cast("int")
    dealt = F.when(F.col("n3").isNotNull(), F.pmod(F.xxhash64("first", "tie", "place"), parts)).otherwise(F.lit(0))
    group = (
        F.when(F.col("n1").isNull(), F.xxhash64("s1"))
        .when(F.col("n2").isNull(), F.xxhash64("s1", "s2"))
        .otherwise(F.xxhash64("s1", "s2", "s3", dealt))
    )
    grouped = sized.select(group.alias("group"), *suffixes.columns, F.col("n3").isNotNull().alias("again"))
    order = ["group", *keys, "first", "tie", "place"]
    shape = ", ".join([SUFFIX, "leads boolean, again boolean"])
    count = 2 * partitions_for(suffixes)

    def subtrees(rows: DataFrame) -> DataFrame:
        dealt_rows = rows.repartition(count, "group").sortWithinPartitions(*order)
        return dealt_rows.select(*order, "again").mapInArrow(_subtrees, shape)

    # First suffixes are of use only where they lead a part of a passage.
    found = stored(subtrees(grouped).filter("NOT leads OR again"), "leaves")
    later = found.filter("NOT leads").select("first", "tie", "place")
    # Those of the parts of one passage meet once more, a row for each part.
    leads = found.filter("leads").select(F.xxhash64(*keys).alias("group"), *suffixes.columns, F.lit(False).alias("again"))
    return later.unionByName(subtrees(leads).filter("NOT leads").select("first", "tie", "place"))


def _cut(batches: Iterator[pa.RecordBatch], as_is: bool) -> Iterator[pa.RecordBatch]:
    """Words left once every word of the windows at `places` is taken out.

    With `as_is`, texts that lose nothing keep their white space.
    """
    for batch in batches:
        lists = batch.column(2)
        list_at, list_all = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        data, offsets = column_bytes(batch.column(3))
        for first, last in steps(offsets, STEP):
            part = data[offsets[first] : offsets[last]]
            starts, ends, bounds = word_bounds(part, offsets[first : last + 1] - offsets[first])
            text = np.repeat(np.arange(last - first), np.diff(list_at[first : last + 1]))
            at = list_all[list_at[first] : list_at[last]].astype(np.int64) + bounds[text]
            marks = np.zeros(len(starts) + WINDOW + 1, np.int64)
            np.add.at(marks, at, 1)
            np.add.at(marks, at + WINDOW, -1)
            gone = np.cumsum(marks)[: len(starts)] > 0
            raw = part.tobytes()
            kept, removed = [], []
            for i in range(last - first):
                own = np.arange(bounds[i], bounds[i + 1])
                stay = own[~gone[own]]
                removed.append(len(own) - len(stay))
                if as_is and not removed[-1]:
                    kept.append(raw[offsets[first + i] - offsets[first] : offsets[first + i + 1] - offsets[first]])
                    continue
                spans = zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)
                kept.append(b" ".join([raw[a:b] for a, b in spans]))
            yield plain_batch(
                {
                    "first": batch.column(0).slice(first, last - first),
                    "tie": batch.column(1).slice(first, last - first),
                    "n_words": np.diff(bounds),
                    "n_removed": np.array(removed, np.int64),
                    "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                }
            )


def remove_repeats(
    docs: DataFrame,
    kept: Callable[[Column], Column] = lambda text: text,
    carry: Sequence[str] = (),
    as_is: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and kept_text.

    A word goes if it lies in a window of 20 words that also starts earlier: in a
    document of smaller id, or in the same one further left. Windows are judged on the
    input. The kept words are joined by single spaces. A null text has no words. Rows of
    equal id and text are one document and get one result each; texts of one id that
    differ are ordered by a hash. A null id comes after all others. Of equal texts, those
    of larger ids go whole if they have a window. No documents give no rows.
    """
    copies, texts = distinct_texts(docs)
    seeds = repeated_seeds(texts, "words", GRAM, WINDOW)
    suffixes = stored(with_places(texts, seeds).mapInArrow(_suffixes, SUFFIX), "suffixes")
    found = repeats(suffixes)
    discard(seeds, suffixes)
    gone = found.groupBy("first", "tie").agg(F.collect_list("place").alias("places"))
    marked = texts.join(gone, ["first", "tie"], "left").select(
        "first", "tie", F.coalesce("places", F.array().cast("array<int>")).alias("places"), "text"
    )
    cut = marked.mapInArrow(lambda x: _cut(x, as_is), "first long, tie long, n_words long, n_removed long, kept_text string")
    return results_for(docs, copies, cut, "n_words", WINDOW, kept, carry)
