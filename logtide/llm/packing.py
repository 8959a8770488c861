"""Packing pieces of documents into as few fixed-size sequences as possible.

Pieces of one length are interchangeable, so the plan is made on the counts by length:
a table of at most `capacity` rows, whatever the corpus. First the dominance criterion
of Martello and Toth fixes sequences that are at least as good as any other with that
piece: pieces that nothing fits beside, perfect pairs, and pairs or triples that all
other companions could replace. The rest goes by best fit, longest pieces first. A plan
step sends a range of ranks of one length to a range of sequences; Spark numbers the
pieces of each length and looks their places up.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.bpe import vocabulary
from logtide.llm.quick_tokens import encoder
from logtide.llm.shared import column_bytes, partitions_for, plain_batch, steps, stored, whole_text

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Step(NamedTuple):
    """Pieces `first` to `first + count` of a length, `each` to a sequence from `sequence` on."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


def reduce_dominated(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, how often) of sequences fixed by dominance; `counts` keeps the rest.

    A set holding the piece j dominates when the companions in any other feasible set can
    be exchanged for its own. With companions of at most two pieces that can be told from
    the lengths alone.
    """
    fixed: list[tuple[tuple[int, ...], int]] = []
    for length in sorted(counts, reverse=True):
        while counts.get(length, 0):
            chosen = _dominating(counts, length, capacity)
            if chosen is None:
                break
            times = min(counts[x] // chosen.count(x) for x in set(chosen))
            fixed.append((chosen, times))
            for x in chosen:
                counts[x] -= times
                if not counts[x]:
                    del counts[x]
    return fixed


def _dominating(counts: dict[int, int], length: int, capacity: int) -> tuple[int, ...] | None:
    """A set with one piece of `length` that dominates all others, if there is one."""
    room = capacity - length
    others = counts | {length: counts[length] - 1}
    sizes = sorted(x for x, n in others.items() if n)
    fitting = sizes[: bisect_right(sizes, room)]
    if not fitting:
        return (length,)
    largest = fitting[-1]
    if largest == room:
        return (length, largest)
    smallest = _smallest(others, sizes, 3)
    if len(smallest) < 2 or smallest[0] + smallest[1] > room:
        return (length, largest)  # nothing holds two companions
    if len(smallest) == 3 and sum(smallest) <= room:
        return None
    # At most two companions. The largest with the most that fits beside it dominates
    # unless two companions that are both larger than the second fit together.
    left = others | {largest: others[largest] - 1}
    beside = [x for x in fitting if x <= room - largest and left[x]]
    if not beside:
        second = 0
    else:
        second = beside[-1]
    larger = _smallest(others, sizes[bisect_left(sizes, second + 1) :], 2)
    if len(larger) < 2 or sum(larger) > room:
        return (length, largest, second) if second else (length, largest)
    return None


def _smallest(counts: dict[int, int], sizes: list[int], most: int) -> list[int]:
    """The smallest lengths, repeated ones included."""
    found: list[int] = []
    for x in sizes[:most]:
        found += [x] * min(counts[x], most)
    return found[:most]


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Step], int]:
    """Steps that place every piece, and the number of sequences."""
    left = {x: n for x, n in counts.items() if n}
    if any(not 0 < x <= capacity for x in left):
        raise ValueError("lengths must be from 1 to the capacity")
    used = dict.fromkeys(left, 0)
    steps_: list[Step] = []
    sequences = 0

    def place(length: int, count: int, sequence: int, each: int, offset: int) -> None:
        steps_.append(Step(length, used[length], count, sequence, each, offset))
        used[length] += count

    for chosen, times in reduce_dominated(left, capacity):
        offset = 0
        for x in chosen:
            place(x, times, sequences, 1, offset)
            offset += x
        sequences += times
    # Ranges (first, number) of sequences with equal room left.
    by_room: dict[int, list[tuple[int, int]]] = {}
    for length in sorted(left, reverse=True):
        count = left[length]
        for room in sorted(r for r in by_room if r >= length):
            if not count:
                break
            each, ranges = room // length, by_room.pop(room)
            while ranges:
                first, number = ranges.pop()
                if not count:
                    by_room.setdefault(room, []).append((first, number))
                    continue
                full = min(number, count // each)
                if full:
                    place(length, full * each, first, each, capacity - room)
                    by_room.setdefault(room - each * length, []).append((first, full))
                    count -= full * each
                    first, number = first + full, number - full
                if number and count and count < each:
                    place(length, count, first, each, capacity - room)
                    by_room.setdefault(room - count * length, []).append((first, 1))
                    first, number, count = first + 1, number - 1, 0
                if number:
                    by_room.setdefault(room, []).append((first, number))
        each = capacity // length
        for number, held in ((count // each, each), (1, count % each)):
            if number and held:
                place(length, number * held, sequences, held, 0)
                by_room.setdefault(capacity - held * length, []).append((sequences, number))
                sequences += number
    return steps_, sequences


def token_pieces(docs: DataFrame, vocabulary_path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Every whole text encoded, `end_id` appended and cut where it exceeds `capacity`.

    One row a piece, with its place in the document and the CRC-32 of its ids. Of a
    document that is cut, all pieces but the first have `capacity` tokens. A null text is
    empty, which leaves the end id. Null and repeated ids keep a row a piece each.
    """
    name = vocabulary(docs, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = encoder(SparkFiles.get(name)), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            _, offsets = column_bytes(batch.column(1))
            for first, last in steps(offsets):
                keys = batch.column(0).slice(first, last - first).to_pylist()
                found = []
                for key, text in zip(keys, batch.column(1).slice(first, last - first).to_pylist(), strict=True):
                    ids = encode(text) + tail
                    size, at, piece = len(ids) // 4, 0, 0
                    while at < size:
                        end = at + ((size - at) % capacity or capacity)
                        found.append((key, piece, at, end - at, zlib.crc32(memoryview(ids)[4 * at : 4 * end])))
                        at, piece = end, piece + 1
                columns = list(zip(*found, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ("doc_id", "piece", "start", "length", "ids_crc32")
                yield plain_batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, PIECE_SCHEMA)


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`; needs a column `length` from 1 to `capacity`.

    Every row is placed, repeated rows and rows of null ids too; sequences are filled
    without gaps from offset 0. Other columns go along. No rows give no rows.
    """
    spark, names = pieces.sparkSession, pieces.columns
    # Ranks within parts of a length, so that a length of a third of all pieces is many
    # parts. Rows are dealt by their place in the input, as they may be alike in all columns.
    # They are stored, since they must be those of the rows that are counted.
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(partitions_for(pieces))).cast("int")
    own = Window.partitionBy("_part", "length").orderBy("length")
    numbered = stored(
        pieces.withColumn("_part", part).withColumn("_rank", F.row_number().over(own).cast("long") - 1), "pieces"
    )
    by_part = numbered.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # At most `capacity` rows.
    counts = {r["length"]: r["n"] for r in numbered.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    steps_, _ = plan(counts, capacity)
    ordered = sorted(steps_, key=lambda s: (s.length, s.first))
    table = np.array(ordered, np.int64).reshape(-1, len(Step._fields))
    step_of_length = np.searchsorted(table[:, 0], np.arange(capacity + 2))
    shared = spark.sparkContext.broadcast((table, step_of_length))  # by lengths, not by rows

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, step_of_length = shared.value
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            ranks = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            chosen = np.empty(len(lengths), np.int64)
            for x in np.unique(lengths):
                low, high = step_of_length[x], step_of_length[x + 1]
                own = lengths == x
                chosen[own] = low + np.searchsorted(table[low:high, 1], ranks[own], "right") - 1
            length, first, _, sequence, each, offset = table[chosen].T
            past = ranks - first
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            yield plain_batch(
                columns | {"sequence_id": sequence + past // each, "offset": offset + past % each * length}
            )

    placed = numbered.join(bases, ["_part", "length"]).select(
        *[numbered[n] for n in names], (F.col("_base") + F.col("_rank")).alias("_rank")
    )
    result = pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    return placed.mapInArrow(look_up, result.schema)
