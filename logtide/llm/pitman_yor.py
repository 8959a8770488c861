"""Scores of texts by a hierarchical Pitman-Yor model of word pairs.

Each context, the word before, has a restaurant; all of them share one parent, the
restaurant of single words, whose base is uniform. A pair that occurs once sits at one
table. The seats of the others are drawn by Gibbs sweeps: given the parent's probability
of the word and the other tables of the restaurant, the customers of a pair are seated
anew one after the other, however many they are. Two chains run side by side; what they predict after the last
sweep is averaged. Pairs, contexts and words are rows spread over the cluster, so a
context with a third of all words is as many rows as it has different followers.

Words are named by 64-bit hashes; in the model a word has 40 bits of it and a context 24,
so that a pair is one number and rare contexts may share a restaurant. Documents are
dealt into groups by a hash. A group asks for the words and pairs in it, the counts of
all groups meet by key, and the answers come back to the group, where its texts are
scored: neither the texts' words nor the model are joined word by word. Groups repeat
the draws of their pairs; the tables of frequent pairs, many draws each, are told.
Between tasks the numbers of a row are bytes, since arrays cost Spark time per number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.seeds import STEP, mixed, word_bounds, word_hashes
from logtide.llm.shared import column_bytes, discard, plain_batch, steps, stored, whole_text

CHAINS = 2
SWEEPS = 2
STRENGTH = 1.0
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
WORD_BITS, CONTEXT_BITS = np.uint64(40), np.uint64(24)
#: Turns in which groups are scored.
TURNS = 2
#: Bytes of text a group has on average; a task holds one group with its answers.
GROUP_BYTES = 8_000_000
WORDS, PAIRS, TYPES, REPEATED, ALONE_IN, ALONE_OF, TOTALS, FREQUENT = range(8)
#: Customers from which on a pair's tables are told to the groups, as drawing them takes many steps.
FREQUENT_FROM = 1000
#: Rows seated in one vectorised step, and customers of those that are seated together later on.
SEATED_ROWS, LATE_FROM = 1 << 16, 64
#: Rows below which draws of many steps are made at once, and the steps.
FEW_ROWS, AHEAD = 2000, 64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
ROWS = "kind int, bucket int, grp int, keys binary, counts binary"
#: What a step asks of a bucket is one row, however many groups there are: the keys of one group after the other.
ASKED = "kind int, bucket int, groups binary, sizes binary, keys binary, counts binary"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def prepared(docs: DataFrame) -> DataFrame:
    """doc_id, held, grp and the text; there are as many groups as the amount of text asks for.

    Every group meets every bucket of keys, so their number must not follow the shuffle
    partitions: of few texts in many partitions, groups would have a key a bucket.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // GROUP_BYTES))
    text = whole_text()
    table = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held"),
        F.pmod(F.xxhash64("doc_id", text), F.lit(groups)).cast("int").alias("grp"),
        text.alias("text"),
    )
    table.groups = groups
    return table


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, contexts, bounds of the texts): words, A-Z lowered, and one end a text."""
    data = LOWER[data]
    starts, ends, bounds = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    texts = len(offsets) - 1
    text = np.repeat(np.arange(texts), np.diff(bounds))
    tokens = np.full(len(words) + texts, END)
    tokens[np.arange(len(words)) + text] = words
    own = bounds + np.arange(texts + 1)
    contexts = np.empty(len(tokens), np.uint64)
    contexts[1:] = tokens[:-1]
    contexts[own[:-1]] = START
    return tokens, contexts, own


def pair_keys(contexts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return (contexts >> WORD_BITS << WORD_BITS) | (tokens >> CONTEXT_BITS)


def _as_bytes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns of lists of numbers as the bytes of these, which are not copied."""
    for batch in batches:
        columns = {}
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            if pa.types.is_list(column.type):
                width = column.type.value_type.bit_width // 8
                offsets = column.offsets.to_numpy() * np.int32(width)
                numbers = column.values.to_numpy()
                column = pa.Array.from_buffers(
                    pa.binary(), len(column), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(numbers)]
                )
            columns[name] = column
        yield plain_batch(columns)


def _numbers(column: pa.Array, kind: type = np.int64) -> np.ndarray:
    """All numbers of a column of bytes, one row after the other."""
    return column_bytes(column)[0].view(kind)


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """Numbers from zero on, each in as few bytes as the largest needs."""
    return numbers.astype(np.min_scalar_type(int(numbers.max()))) if numbers.size else numbers


def _wide(keys: pa.Array, numbers: pa.Array, width: int = 1) -> np.ndarray:
    """What `_narrow` made, in rows with `width` numbers a key."""
    data, ends = column_bytes(numbers)
    sizes = np.diff(ends) * 8 // np.maximum(np.diff(column_bytes(keys)[1]) * width, 1)
    edges = np.r_[0, np.flatnonzero(np.diff(sizes)) + 1, len(sizes)]
    out = [np.zeros(0, np.int64)]
    for first, last in zip(edges[:-1], edges[1:], strict=True):
        if first < last and sizes[first]:
            out.append(data[ends[first] : ends[last]].view(f"u{sizes[first]}").astype(np.int64))
    return np.concatenate(out)


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of grp, keys and counts as rows of grp, key and n."""
    for batch in batches:
        _, offsets = column_bytes(batch.column(1))
        for first, last in steps(offsets, STEP):
            part = batch.slice(first, last - first)
            sizes = np.diff(offsets[first : last + 1]) // 8
            grp = np.repeat(part.column(0).to_numpy(zero_copy_only=False), sizes)
            yield plain_batch({"grp": grp, "key": _numbers(part.column(1)), "n": _wide(part.column(1), part.column(2))})


def _gathered(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches joined to such of about so many rows."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _asked(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Per bucket the different words and pairs of each group in a step.

    counts: occurrences in training, times two, plus one if also asked for by a held-out
    text. The start of a text is asked for as a word that never occurs.
    """
    for batch in batches:
        groups = batch.column(2).to_numpy(zero_copy_only=False)
        held = batch.column(1).to_numpy(zero_copy_only=False)
        data, offsets = column_bytes(batch.column(3))
        order = np.argsort(groups, kind="stable")
        if (np.diff(order) != 1).any():
            batch = batch.take(pa.array(order))
            groups, held = groups[order], held[order]
            data, offsets = column_bytes(batch.column(3))
        for first, last in steps(offsets, STEP):
            part = data[offsets[first] : offsets[last]]
            tokens, contexts, bounds = tokens_of(part, offsets[first : last + 1] - offsets[first])
            sizes = np.diff(bounds)
            present, nth = np.unique(groups[first:last], return_inverse=True)
            group = np.repeat(nth, sizes)
            is_held = np.repeat(held[first:last], sizes)
            for kind, keys in ((WORDS, tokens), (PAIRS, pair_keys(contexts, tokens))):
                bucket = (mixed(keys) >> np.uint64(33)).astype(np.int64) % buckets
                place = bucket * len(present) + group
                order = np.argsort(keys)
                order = order[np.argsort(place[order].astype(np.min_scalar_type(int(place.max()))), kind="stable")]
                k, p = keys[order], place[order]
                new = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (p[1:] != p[:-1])])
                seen = np.add.reduceat((~is_held[order]).astype(np.int64), new)
                also = np.logical_or.reduceat(is_held[order], new)
                yield _asked_rows(kind, present, p[new], k[new], 2 * seen + also)
            at = int(mixed(np.array([START]))[0] >> np.uint64(33)) % buckets
            starts, none = np.full(len(present), START), np.zeros(len(present), np.int64)
            yield _asked_rows(WORDS, present, at * len(present) + np.arange(len(present)), starts, none)


def _asked_rows(kind: int, present: np.ndarray, place: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """One row per bucket; `place` is the bucket times the number of `present` groups, and the group's turn."""
    runs = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    bucket = place[runs] // len(present)
    rows = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    groups = pa.array(np.r_[rows, len(runs)].astype(np.int32))
    bounds = pa.array(np.r_[runs[rows], len(place)].astype(np.int32))
    sizes = np.diff(np.r_[runs, len(place)]).astype(np.int32)
    return plain_batch(
        {
            "kind": np.full(len(rows), kind, np.int32),
            "bucket": bucket[rows].astype(np.int32),
            "groups": pa.ListArray.from_arrays(groups, pa.array(present[place[runs] % len(present)].astype(np.int32))),
            "sizes": pa.ListArray.from_arrays(groups, pa.array(sizes)),
            "keys": pa.ListArray.from_arrays(bounds, pa.array(keys.view(np.int64))),
            "counts": pa.ListArray.from_arrays(bounds, pa.array(_narrow(counts))),
        }
    )


def _array_rows(kind: int, place: np.ndarray, keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per place (group and bucket), which come in order."""
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, np.int64)
    bounds = pa.array(np.r_[starts, len(place)].astype(np.int32))
    own = place[starts]
    return plain_batch(
        {
            "kind": np.full(len(own), kind, np.int32),
            "bucket": (own % buckets).astype(np.int32),
            "grp": (own // buckets).astype(np.int32),
            "keys": pa.ListArray.from_arrays(bounds, pa.array(keys.view(np.int64))),
            "counts": pa.ListArray.from_arrays(bounds, pa.array(_narrow(counts))),
        }
    )


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the whole corpus for what the groups asked, and what the model needs.

    Rows come in the order of kind and bucket; one bucket is held at a time. A pair with
    a count of one is told to held-out texts only: the training text that has it knows.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        kinds, buckets = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        edges = np.flatnonzero((kinds[1:] != kinds[:-1]) | (buckets[1:] != buckets[:-1])) + 1
        for a, b in zip(np.r_[0, edges], np.r_[edges, len(kinds)], strict=True):
            if held and (held[-1].column(0)[0].as_py(), held[-1].column(1)[0].as_py()) != (kinds[a], buckets[a]):
                yield from _met_bucket(held)
                held = []
            if b > a:
                held.append(batch.slice(int(a), int(b - a)))
    if held:
        yield from _met_bucket(held)


def _met_bucket(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wanted = rows[0].column(0)[0].as_py()
    kinds = (np.int32, np.int32, np.uint64)
    grp, sizes, keys = (np.concatenate([_numbers(b.column(i), kind) for b in rows]) for i, kind in enumerate(kinds, 2))
    counts = np.concatenate([_wide(b.column(4), b.column(5)) for b in rows])
    order = np.argsort(keys)
    k, c, g = keys[order], counts[order], np.repeat(grp, sizes)[order].astype(np.int64)
    new = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    total = np.add.reduceat(c >> 1, new)
    spread = np.repeat(total, np.diff(np.r_[new, len(k)]))
    totals = np.zeros(4, np.int64)
    if wanted == WORDS:
        totals[:2] = total.sum(), (total > 0).sum()
        told = np.ones(len(k), bool)
        yield _array_rows(TYPES, np.zeros(len(new), np.int64), k[new], total, 1)
    else:
        totals[2:] = (total == 1).sum(), (total == 2).sum()
        told = (spread > 1) | ((spread == 1) & (c & 1 > 0))
        many, one = total > 1, total == 1
        yield _array_rows(REPEATED, np.zeros(many.sum(), np.int64), k[new][many], total[many], 1)
        alone = k[new][one]
        for name, part in ((ALONE_IN, alone >> WORD_BITS), (ALONE_OF, alone << CONTEXT_BITS >> CONTEXT_BITS)):
            values, times = np.unique(part, return_counts=True)
            yield _array_rows(name, np.zeros(len(values), np.int64), values, times, 1)
    # A group may have asked in several steps.
    k, g, spread = k[told], g[told], spread[told]
    order = np.argsort(g, kind="stable")
    k, g, spread = k[order], g[order], spread[order]
    once = np.r_[True, (k[1:] != k[:-1]) | (g[1:] != g[:-1])] if len(k) else np.zeros(0, bool)
    k, g, spread = k[once], g[once], spread[once]
    if wanted == PAIRS:
        often = spread >= FREQUENT_FROM
        yield _array_rows(FREQUENT, g[often], k[often], spread[often], 1)
        k, g, spread = k[~often], g[~often], spread[~often]
    yield _array_rows(wanted, g, k, spread, 1)
    yield _array_rows(TOTALS, np.zeros(4, np.int64), np.arange(4, dtype=np.uint64), totals, 1)


def seat(
    keys: np.ndarray, counts: np.ndarray, chance: np.ndarray, tables: np.ndarray, discount: float, chain: int
) -> np.ndarray:
    """Tables of each dish after seating its `counts` customers anew.

    `chance`: the parent's probability of the dish; `tables`: those of the restaurant
    without one of the dish. Every customer opens a table with its own probability. That
    falls until the next one is opened, so the customers before one that might open are
    passed by a geometric number at the highest probability, and that one opens with the
    share of its own in it: all seats have the law of seating one by one, in steps that
    grow with the tables and the logarithm of the customers. Draws depend on the key, the
    chain and the step only.
    """
    out = np.ones(len(keys), np.int64)
    rows = np.flatnonzero(counts > 1)
    key, left, p, others = keys[rows], counts[rows].astype(np.float64), chance[rows], tables[rows].astype(np.float64)
    seen, own = np.ones(len(rows)), np.ones(len(rows))
    salt, step = (chain + 1) * 0xD1342543DE82EF95, 0
    while len(rows):
        # Of few rows the draws of many steps are made at once; rows that are done stay as they are.
        ahead = AHEAD if len(rows) < FEW_ROWS else 1
        draws = _draws(key, np.uint64((salt + step) % (1 << 64)) + np.arange(2 * ahead, dtype=np.uint64)[:, None])
        waits = -np.log1p(-draws[0::2])
        with np.errstate(divide="ignore"):
            for wait, draw in zip(waits, draws[1::2], strict=True):
                opens = (STRENGTH + discount * (others + own)) * p
                weight = opens + seen - discount * own
                passed = np.floor(wait / np.log1p(opens / (weight - opens)))
                reach = np.minimum(2 * seen, left)
                might = seen + passed < reach
                own += might & (draw * (weight + passed) < weight)
                seen = np.where(might, seen + passed + 1, reach)
        step += 2 * ahead
        done = seen >= left
        if done.any():
            out[rows[done]] = own[done].astype(np.int64)
            rows, key, left, p, others, seen, own = (x[~done] for x in (rows, key, left, p, others, seen, own))
    return out


def _draws(keys: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """One number between zero and one, never either, per salt and key."""
    return ((mixed(keys ^ salts) >> np.uint64(12)) + 0.5) / float(1 << 52)


def _sample(rows: DataFrame, discount: float, sweep: int) -> DataFrame:
    """`rows` (pair, c, p0, p1, o0, o1) with new tables t0, t1 of both chains."""

    def drawn(batch: pa.RecordBatch) -> pa.RecordBatch:
        pair, c = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        tables = {}
        for chain in range(CHAINS):
            p, o = (batch.column(2 + i + chain).to_numpy(zero_copy_only=False) for i in (0, CHAINS))
            tables[f"t{chain}"] = seat(pair.view(np.uint64), c, p, o, discount, 16 * sweep + chain)
        return plain_batch({"pair": batch.column(0), "c": batch.column(1), **tables})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A step lasts as long as its most frequent pair, so frequent pairs are seated together.
        late: list[pa.RecordBatch] = []
        for batch in _gathered(batches, SEATED_ROWS):
            often = pc.greater_equal(batch.column(1), LATE_FROM)
            late.append(batch.filter(often))
            yield drawn(batch.filter(pc.invert(often)))
            if sum(x.num_rows for x in late) >= SEATED_ROWS:
                yield from map(drawn, _gathered(late, SEATED_ROWS))
                late = []
        yield from map(drawn, _gathered(late, SEATED_ROWS))

    names = ["pair", "c"] + [f"{x}{i}" for x in "po" for i in range(CHAINS)]
    shape = "pair long, c long, " + ", ".join(f"t{i} long" for i in range(CHAINS))
    return rows.select(*names).mapInArrow(run, shape)


def _seat_words(counts: DataFrame, discount: float, uniform: float, types: int, sweep: int) -> DataFrame:
    """word, n0, n1 with the tables t0, t1 of the words in the parent.

    The tables of other words move little in a sweep, so a table a word is assumed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, SEATED_ROWS):
            word = batch.column(0).to_numpy(zero_copy_only=False)
            chance, others = np.full(len(word), uniform), np.full(len(word), max(types - 1, 0))
            drawn = {
                f"t{i}": seat(
                    word.view(np.uint64),
                    batch.column(1 + i).to_numpy(zero_copy_only=False),
                    chance,
                    others,
                    discount,
                    16 * (100 + sweep) + i,
                )
                for i in range(CHAINS)
            }
            yield plain_batch({n: batch.column(i) for i, n in enumerate(batch.schema.names)} | drawn)

    shape = "word long, " + ", ".join([f"n{i} long" for i in range(CHAINS)] + [f"t{i} long" for i in range(CHAINS)])
    return counts.mapInArrow(run, shape)


def _context(pair: str) -> Column:
    return F.shiftrightunsigned(pair, int(WORD_BITS))


def _word(pair: str) -> Column:
    return F.col(pair).bitwiseAND(F.lit((1 << int(WORD_BITS)) - 1))


def discount_of(ones: int, twos: int) -> float:
    """The usual estimate from how many things were seen once and twice."""
    return min(max(ones / (ones + 2 * twos), 0.05), 0.95) if ones else 0.5


class Parent(NamedTuple):
    """The restaurant of single words in one chain; all words there share the base."""

    discount: float
    customers: int
    tables: int
    uniform: float

    def chance(self, customers, tables):
        """Of words with so many customers and tables; works on columns and arrays."""
        rest = (STRENGTH + self.discount * self.tables) * self.uniform
        return (customers - self.discount * tables + rest) / (STRENGTH + self.customers)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of grp, kind, key, n and numbers as rows of arrays, one per group and step."""
    for batch in _gathered(batches, SEATED_ROWS):
        columns = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
        order = np.argsort(columns[0], kind="stable")
        group, kind, key, n = (x[order] for x in columns[:4])
        numbers = np.stack([x[order] for x in columns[4:]], axis=1)
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        ends = np.r_[starts, len(group)]
        bounds = pa.array(ends.astype(np.int32))
        wide = pa.array((ends * numbers.shape[1]).astype(np.int32))
        yield plain_batch(
            {
                "grp": group[starts],
                "kind": kind[starts],
                "keys": pa.ListArray.from_arrays(bounds, pa.array(key)),
                "counts": pa.ListArray.from_arrays(bounds, pa.array(_narrow(n))),
                "numbers": pa.ListArray.from_arrays(wide, pa.array(_narrow(numbers.ravel()))),
            }
        )


PACKED = "grp int, kind int, keys binary, counts binary, numbers binary"


class Stage(NamedTuple):
    """Restaurants of contexts (n0, n1: tables) and of words (n, t of both chains)."""

    contexts: DataFrame
    parent: DataFrame
    parents: list[Parent]


class Model:
    """Counts, restaurants and averaged predictions of a corpus."""

    def __init__(self, docs: DataFrame):
        # As much text a bucket as a group has, whatever the shuffle partitions.
        buckets = docs.groups
        asked = docs.select("doc_id", "held", "grp", "text").mapInArrow(lambda x: _as_bytes(_asked(x, buckets)), ASKED)
        dealt = asked.repartition(2 * buckets, "kind", "bucket").sortWithinPartitions("kind", "bucket")
        met = dealt.mapInArrow(lambda x: _as_bytes(_met(x)), ROWS)
        self.met = stored(met, "counts", "kind")
        totals = {r["key"]: r["n"] for r in self.rows(TOTALS).groupBy("key").agg(F.sum("n").alias("n")).collect()}
        self.tokens, self.types, ones, twos = (totals.get(i) or 0 for i in range(4))
        self.discount = discount_of(ones, twos)
        self.words = self.rows(TYPES).filter("n > 0")
        self._sweep()

    def rows(self, kind: int) -> DataFrame:
        """grp, key, n of one kind."""
        rows = self.met.filter(F.col("kind") == kind).select("grp", "keys", "counts")
        return rows.mapInArrow(_one_by_one, "grp int, key bigint, n bigint")

    def _sweep(self) -> None:
        repeated = stored(self.rows(REPEATED).select(F.col("key").alias("pair"), F.col("n").alias("c")), "pairs")
        fixed = tuple(
            stored(self.rows(kind).groupBy("key").agg(F.sum("n").alias("n")), "alone") for kind in (ALONE_IN, ALONE_OF)
        )
        seated = repeated.select("pair", "c", *[F.lit(1).cast("long").alias(f"t{i}") for i in range(CHAINS)])
        for sweep in range(SWEEPS):
            inside = self._tables(seated, fixed[0], _context("pair"), "context")
            parent = self._parent(seated, fixed[1], sweep)
            # The last sweep starts from here; who knows this can repeat its draws.
            self.before = Stage(stored(inside, "contexts"), parent, self.parents)
            chances = [self.parents[i].chance(F.col(f"n{i}"), F.col(f"t{i}")) for i in range(CHAINS)]
            placed = repeated.withColumns({"context": _context("pair"), "word": _word("pair")})
            placed = placed.join(parent.select("word", *[x.alias(f"p{i}") for i, x in enumerate(chances)]), "word")
            others = [(F.col(f"n{i}") - 1).alias(f"o{i}") for i in range(CHAINS)]
            placed = placed.join(self.before.contexts.select("context", *others), "context")
            seated = stored(_sample(placed, self.discount, sweep), "seated")
        contexts = stored(self._tables(seated, fixed[0], _context("pair"), "context"), "contexts")
        parent = self._parent(seated, fixed[1], SWEEPS)
        self.after = Stage(contexts, parent, self.parents)
        self.seated = seated
        discard(repeated, *fixed)

    @staticmethod
    def _tables(seated: DataFrame, alone: DataFrame, key: Column, name: str) -> DataFrame:
        """`name`, n0, n1: tables in both chains, of contexts or of words."""
        numbers = [f"n{i}" for i in range(CHAINS)]
        moving = seated.select(key.alias(name), *[F.col(f"t{i}").alias(f"n{i}") for i in range(CHAINS)])
        fixed = alone.select(F.col("key").alias(name), *[F.col("n").alias(x) for x in numbers])
        return moving.unionByName(fixed).groupBy(name).agg(*[F.sum(x).alias(x) for x in numbers])

    def _parent(self, seated: DataFrame, alone: DataFrame, sweep: int) -> DataFrame:
        """word, n0, n1, t0, t1: customers and tables of the parent in both chains.

        Its customers are the tables of all contexts; they are seated like those of pairs.
        """
        counts = self._tables(seated, alone, _word("pair"), "word")
        uniform = 1.0 / (self.types + 1)
        if sweep == 0:
            once = [F.count_if(F.col("n0") == i).alias(f"once{i}") for i in (1, 2)]
            seen = counts.agg(*once).first()
            self.parent_discount = discount_of(*seen)
        both = stored(_seat_words(counts, self.parent_discount, uniform, self.types, sweep), "parent")
        sums = both.agg(*[F.sum(f"{x}{i}").alias(f"{x}{i}") for x in "nt" for i in range(CHAINS)]).first()
        self.parents = [
            Parent(self.parent_discount, sums[f"n{i}"] or 0, sums[f"t{i}"] or 0, uniform) for i in range(CHAINS)
        ]
        return both

    def answers(self) -> DataFrame:
        """Per group: the words and pairs it asked for, with their counts.

        Words have customers and tables in the parent, of both chains, and tables in the
        word's own restaurant, before and after the last sweep, then its customers. Seats
        of pairs follow from that, as their draws depend on nothing else: see `seats`.
        Frequent pairs come with their tables in both chains.
        """
        own = F.shiftrightunsigned("key", int(CONTEXT_BITS)).alias("word")
        context = F.shiftrightunsigned("key", int(WORD_BITS)).alias("context")
        # A word is followed each time it occurs; the end is not, the start once a text.
        start = F.lit(int(START.view(np.int64))).alias("key")
        is_end = F.col("key") == F.lit(int(END.view(np.int64)))
        known = self.words.select("key", F.when(is_end, 0).otherwise(F.col("n")).alias("n"))
        known = known.unionByName(self.words.filter(is_end).select(start, "n")).withColumns(
            {"word": own, "context": context}
        )
        table = known.join(known.groupBy("context").agg(F.sum("n").alias("customers")), "context").drop("n")
        names = []
        for label, stage in (("b", self.before), ("a", self.after)):
            parent = stage.parent.withColumnsRenamed({f"{x}{i}": f"{label}{x}{i}" for x in "nt" for i in range(CHAINS)})
            rooms = stage.contexts.withColumnsRenamed({f"n{i}": f"{label}u{i}" for i in range(CHAINS)})
            table = table.join(parent, "word", "left").join(rooms, "context", "left")
            names += [f"{label}{x}{i}" for x in "ntu" for i in range(CHAINS)]
        names.append("customers")
        # One row per known word, so that what the groups asked is joined once.
        table = stored(table.select("key", *names), "table")
        words = self.rows(WORDS).join(table, "key", "left")
        zero = F.lit(0).cast("long")
        words = words.select("grp", F.lit(WORDS).alias("kind"), "key", "n", *[F.coalesce(x, zero).alias(x) for x in names])
        told = stored(words.mapInArrow(lambda x: _as_bytes(_packed(x)), PACKED), "words")
        tables = [f"t{i}" for i in range(CHAINS)]
        seated = self.seated.filter(F.col("c") >= FREQUENT_FROM).select(F.col("pair").alias("key"), *tables)
        frequent = self.rows(FREQUENT).join(seated, "key").select("grp", F.lit(FREQUENT).alias("kind"), "key", "n", *tables)
        frequent = stored(frequent.mapInArrow(lambda x: _as_bytes(_packed(x)), PACKED), "frequent")
        discard(table, *self.before[:2], *self.after[:2])
        for kind in (WORDS, TYPES, REPEATED, ALONE_IN, ALONE_OF, FREQUENT):
            discard(self.met, part=f"kind={kind}")
        none = F.lit(bytearray()).alias("numbers")
        pairs = self.met.filter(F.col("kind") == PAIRS).select("grp", "kind", "keys", "counts", none)
        return told.unionByName(pairs).unionByName(frequent)


class Numbers:
    """What a group was told of its words, as arrays in the order of their keys."""

    WIDTH = 6 * CHAINS + 1

    def __init__(self, keys: np.ndarray, counts: np.ndarray, numbers: np.ndarray):
        self.keys, self.counts = keys, counts
        parts = np.split(numbers, range(CHAINS, 6 * CHAINS + 1, CHAINS), axis=1)
        self.before, self.after, self.customers = parts[:3], parts[3:6], parts[6][:, 0]

    def seats(self, pairs: np.ndarray, counts: np.ndarray, discount: float, parents: list[Parent]) -> list[np.ndarray]:
        """The tables of pairs after the last sweep, in both chains."""
        if not len(pairs):
            return [np.zeros(0, np.int64)] * CHAINS
        last = len(self.keys) - 1
        word = np.searchsorted(self.keys >> CONTEXT_BITS, pairs << CONTEXT_BITS >> CONTEXT_BITS)
        word = np.minimum(word, last)
        # Words of one context hash share a restaurant; those never trained on know no tables.
        rooms = self.keys >> WORD_BITS
        starts = np.flatnonzero(np.r_[True, rooms[1:] != rooms[:-1]])
        room = np.minimum(np.searchsorted(rooms[starts], pairs >> WORD_BITS), len(starts) - 1)
        found = []
        for i in range(CHAINS):
            chance = parents[i].chance(self.before[0][word, i], self.before[1][word, i])
            tables = np.maximum.reduceat(self.before[2][:, i], starts)[room]
            rows = (pairs, counts, chance, tables - 1)
            parts = [[x[at : at + SEATED_ROWS] for x in rows] for at in range(0, len(pairs), SEATED_ROWS)]
            found.append(np.concatenate([seat(*part, discount, 16 * (SWEEPS - 1) + i) for part in parts]))
        return found


def score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Both scores are log10 probabilities of the whole lowered text and its end. The base
    knows single words of the training texts only; `score` is the model's. A null or
    empty text is its end. Repeated rows count and are scored each; a null id trains.
    If there is nothing to train on, all words are unknown and both scores are zero,
    since one type is all there is. No documents give no rows.
    """
    texts = prepared(docs)
    model = Model(texts)
    tokens, types, discount = model.tokens, model.types, model.discount

    before, after, answers = model.before.parents, model.after.parents, model.answers()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        told = Numbers(*_answer(right, WORDS, Numbers.WIDTH))
        pairs, customers, _ = _answer(right, PAIRS, 0)
        if not left.num_rows:
            return pa.Table.from_batches([], schema=RESULT)
        word_keys, counts = told.keys, told.counts
        seats = told.seats(pairs, customers, discount, before)
        often, more, tables = _answer(right, FREQUENT, CHAINS)
        pairs, customers = np.r_[pairs, often], np.r_[customers, more]
        order = np.argsort(pairs, kind="stable")
        pairs, customers = pairs[order], customers[order]
        seats = [np.r_[x, tables[:, i]][order] for i, x in enumerate(seats)]
        single = [after[i].chance(told.after[0][:, i], told.after[1][:, i]) for i in range(CHAINS)]
        whole = STRENGTH + told.customers
        weight = [(STRENGTH + discount * told.after[2][:, i]) / whole for i in range(CHAINS)]
        left_over = [customers - discount * seats[i] for i in range(CHAINS)]
        tables = []
        for batch in left.combine_chunks().to_batches():
            data, offsets = column_bytes(batch.column(3))
            held = batch.column(1).to_numpy(zero_copy_only=False)
            for first, last in steps(offsets, STEP):
                part = data[offsets[first] : offsets[last]]
                own, contexts, bounds = tokens_of(part, offsets[first : last + 1] - offsets[first])
                word = np.searchsorted(word_keys, own)
                context = np.empty_like(word)
                context[1:] = word[:-1]
                context[bounds[:-1]] = np.searchsorted(word_keys, START)
                pair = pair_keys(contexts, own)
                where = np.searchsorted(pairs, pair)
                found = np.append(pairs, 0)[where] == pair
                # A context never seen in training has no restaurant, even if its hash has.
                found &= (where < len(pairs)) & (told.customers[context] > 0)
                # What nobody told of a pair: a training text is the only one that has it.
                alone = np.where(np.repeat(held[first:last], np.diff(bounds)), 0.0, 1.0 - discount)
                chance = 0.0
                for i in range(CHAINS):
                    inside = np.where(found, np.append(left_over[i], 0.0)[where], alone)
                    chance = chance + (inside / whole[context] + weight[i][context] * single[i][word]) / CHAINS
                base = (counts[word] + 0.5) / (tokens + 0.5 * (types + 1))
                known = (counts[word] > 0).astype(np.int64)
                tables.append(
                    pa.table(
                        {
                            "doc_id": batch.column(0).slice(first, last - first),
                            "held_out": batch.column(1).slice(first, last - first),
                            "n_tokens": np.diff(bounds),
                            "n_known": np.add.reduceat(known, bounds[:-1]),
                            "train_tokens": np.full(last - first, tokens, np.int64),
                            "base_score": np.add.reduceat(np.log10(base), bounds[:-1]),
                            "score": np.add.reduceat(np.log10(chance), bounds[:-1]),
                        }
                    )
                )
        return pa.concat_tables(tables)

    shape = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    texts = texts.select("doc_id", "held", "grp", "text")

    def scored(turn: int) -> DataFrame:
        mine = F.col("grp") % TURNS == turn
        both = texts.filter(mine).groupBy("grp").cogroup(answers.filter(mine).groupBy("grp"))
        return both.applyInArrow(run, shape)

    # The groups take turns, so that a part of the texts and answers is in motion at a time.
    done = [stored(scored(turn), "scores") for turn in range(TURNS - 1)]
    result = scored(TURNS - 1)
    for table in done:
        result = result.unionByName(table)
    return result


def _answer(right: pa.Table, kind: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys in order, counts, numbers) of one kind."""
    rows = right.filter(pa.array(right.column("kind").to_numpy() == kind))
    if not rows.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, width), np.int64)
    chunks = [(x.column("keys"), x.column("counts"), x.column("numbers")) for x in rows.to_batches()]
    keys = np.concatenate([_numbers(x, np.uint64) for x, _, _ in chunks])
    counts = np.concatenate([_wide(x, y) for x, y, _ in chunks])
    numbers = np.concatenate([_wide(x, z, width) for x, _, z in chunks]) if width else np.zeros(0, np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order], numbers.reshape(len(keys), width)[order]


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)
