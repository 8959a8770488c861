"""Where repeated passages can be: seeds that equal windows must share.

Texts are sequences of symbols, bytes or words. Of all runs of `gram` symbols in a window
the one with the least hash is its seed, and equal windows have equal seeds, so a window
can only occur twice if its seed does. Seeds are a small part of all places; their hashes
alone are shuffled, and what occurs once is left out without losing a repeat.

Equal texts are one text here, named by the least doc_id that has it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.shared import column_bytes, partitions_for, plain_batch, steps, stored, whole_text

#: Stands for a null doc_id: it comes after all others.
NO_ID = (1 << 63) - 1
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
LARGEST = np.uint64((1 << 64) - 1)
#: Bytes of text in one vectorised step.
STEP = 1_000_000
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers stirred (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_SYMBOLS = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


def powers(size: int, kind: str) -> np.ndarray:
    """base ** i (or its inverse) modulo 2 ** 64 for i below `size`."""
    known = _powers.get(kind)
    if known is None or len(known) < size:
        row = np.full(max(size, STEP), BASE if kind == "up" else BASE_INVERSE)
        row[0] = 1
        known = np.cumprod(row, dtype=np.uint64)
        if len(known) <= 4 * STEP:
            _powers[kind] = known
    return known[:size]


class Prefixes:
    """Polynomial hashes of all ranges of a symbol sequence, from prefix sums."""

    def __init__(self, symbols: np.ndarray):
        size = len(symbols)
        self.sums = np.zeros(size + 1, np.uint64)
        np.cumsum(symbols * powers(size, "up"), out=self.sums[1:])
        self.down = powers(size + 1, "down")

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def runs(self, length: int) -> np.ndarray:
        """Of the range of `length` symbols at every place."""
        count = max(len(self.sums) - length, 0)
        return (self.sums[length:] - self.sums[:count]) * self.down[:count]


def is_separator(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each text) of the words in the bytes of some texts."""
    inside = ~is_separator(data)
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edge = offsets[(offsets < len(data)) & (offsets >= 0)]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends_of_text = offsets[1:][offsets[1:] > 0] - 1
    after[ends_of_text] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    return mixed(Prefixes(BYTE_SYMBOLS[data]).of(starts, ends) + (ends - starts).astype(np.uint64))


def symbols_of(data: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, bounds of the texts in symbols)."""
    if unit == "bytes":
        return BYTE_SYMBOLS[data], offsets
    starts, ends, bounds = word_bounds(data, offsets)
    return word_hashes(data, starts, ends), bounds


def _sliding(values: np.ndarray, width: int, combine) -> np.ndarray:
    """`combine` over each `width` neighbours, first to last; shorter by width - 1."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = combine(out[: len(out) - step], out[step:])
        have += step
    return out


def seed_places(
    symbols: np.ndarray, bounds: np.ndarray, gram: int, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the seeds of all windows that lie inside a text."""
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    size = len(symbols)
    if size < window:
        return none
    grams = mixed(Prefixes(symbols).runs(gram))
    width = window - gram + 1
    least = _sliding(grams, width, np.minimum)
    # Windows that reach into the next text count for nothing.
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = text[: len(least)] == text[window - 1 :]
    least = np.where(whole, least, np.uint64(0))
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1 : width - 1 + len(least)] = least
    most = _sliding(padded, width, np.maximum)
    places = np.flatnonzero((grams == most) & (most > 0))
    return places, grams[places]


def distinct_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(copies, texts): md5, first per text; and first, tie, text of each text once.

    `first` is the least doc_id with the text, `tie` tells texts of equal ids apart. `key`
    stands for both: the id, or a negative number from the text's hash where several texts
    have no id or the same. So texts without ids are as many keys as texts.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("first"), whole_text().alias("text")
    ).withColumn("md5", F.unhex(F.md5("text")))
    copies = stored(rows.groupBy("md5").agg(F.min("first").alias("first")), "copies")
    # Joined by hash and id, the copies of a hot text are dealt to all tasks.
    once = rows.join(copies, ["md5", "first"]).dropDuplicates(["md5", "first"])
    # Stored, so that Spark knows how few they usually are and sends them to the texts.
    shared = copies.filter(F.col("first") != NO_ID).groupBy("first").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(shared.select("first", F.lit(True).alias("shared")), "shared-ids")
    tie = F.xxhash64("text").alias("tie")
    named = once.join(shared, "first", "left").select("first", tie, "text", "shared")
    hashed = -F.shiftrightunsigned("tie", 1) - 1
    key = F.when((F.col("first") == NO_ID) | F.col("shared"), hashed).otherwise(F.col("first")).alias("key")
    return copies, stored(named.select("first", "tie", key, "text"), "texts")


def repeated_seeds(texts: DataFrame, unit: str, gram: int, window: int) -> DataFrame:
    """key, places: where texts have seeds that occur more than once, one row per `key`."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = column_bytes(batch.column(1))
            for first, last in steps(offsets, STEP):
                part = data[offsets[first] : offsets[last]]
                symbols, bounds = symbols_of(part, offsets[first : last + 1] - offsets[first], unit)
                places, grams = seed_places(symbols, bounds, gram, window)
                if not len(places):
                    continue
                text = np.searchsorted(bounds, places, "right") - 1
                order = np.argsort(grams, kind="stable")
                ranked = grams[order]
                new = np.r_[True, ranked[1:] != ranked[:-1]]
                counts = np.diff(np.r_[np.flatnonzero(new), len(ranked)])
                known = np.empty(len(grams), bool)
                known[order] = np.repeat(counts > 1, counts)
                # Seeds met twice here are known to repeat. They need not meet again; one row
                # without a place tells the others, so a common seed is a row per step.
                told = ranked[new][counts > 1]
                yield plain_batch(
                    {
                        "gram": np.r_[grams, told].view(np.int64),
                        "key": pa.array(np.r_[ids[first + text], np.zeros(len(told), np.int64)]),
                        "place": np.r_[places - bounds[text], np.full(len(told), -1)].astype(np.int32),
                        "known": np.r_[known, np.zeros(len(told), bool)],
                    }
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if b.num_rows]
        if not own:
            return
        found = pa.Table.from_batches(own)
        gram, key, place, known = (found.column(i).to_numpy() for i in range(4))
        order = np.argsort(gram[~known], kind="stable")
        ranked = gram[~known][order]
        starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, np.int64)
        counts = np.diff(np.r_[starts, len(ranked)])
        own_key, own_place = key[~known][order], place[~known][order]
        told = np.logical_or.reduceat(own_place < 0, starts) if len(starts) else np.zeros(0, bool)
        keep = np.repeat((counts > 1) | told, counts) & (own_place >= 0)
        yield plain_batch(
            {"key": np.r_[key[known], own_key[keep]], "place": np.r_[place[known], own_place[keep]]}
        )

    seeds = texts.select("key", "text").mapInArrow(emit, "gram long, key long, place int, known boolean")
    route = F.when(F.col("known"), F.xxhash64("key", "place")).otherwise(F.col("gram"))
    met = seeds.repartition(2 * partitions_for(texts), route).mapInArrow(meet, "key long, place int")
    return stored(met.groupBy("key").agg(F.collect_list("place").alias("places")), "seeds")


def results_for(
    docs: DataFrame,
    copies: DataFrame,
    cut: DataFrame,
    size: str,
    window: int,
    kept: Callable[[Column], Column],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Results of texts given to their documents; later copies of a text go whole.

    `cut` has first, tie, `size`, n_removed, other numbers and kept_text, of which
    `kept` is carried along. Copies too short for a window have nothing removed. Columns
    of `docs` named in `carry` go along.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.md5(whole_text())).alias("md5"),
        F.xxhash64(whole_text()).alias("tie"),
        *[F.col(f"`{c}`").alias(f"_carried_{c}") for c in carry],
    ).join(copies, "md5")
    own = F.coalesce("doc_id", F.lit(NO_ID)) == F.col("first")
    whole = ~own & (F.col(size) >= window)
    others = [c for c in cut.columns if c not in ("first", "tie", size, "n_removed", "kept_text")]
    joined = rows.join(cut.withColumn("kept_text", kept(F.col("kept_text"))), ["first", "tie"])
    nothing = kept(F.lit("").cast(cut.schema["kept_text"].dataType))
    return joined.select(
        "doc_id",
        size,
        F.when(whole, F.col(size)).otherwise(F.col("n_removed")).alias("n_removed"),
        *[F.when(whole, F.lit(1)).otherwise(F.col(c)).cast("long").alias(c) for c in others],
        F.when(whole, nothing).otherwise(F.col("kept_text")).alias("kept_text"),
        *[F.col(f"_carried_{c}").alias(c) for c in carry],
    )


def with_places(texts: DataFrame, found: DataFrame) -> DataFrame:
    """first, tie, places (ascending), text of the texts that have such places."""
    return texts.join(found, "key").select("first", "tie", F.sort_array("places").alias("places"), "text")
