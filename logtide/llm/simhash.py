"""Near duplicates by SimHash, found with BK-trees.

Fingerprints of 64 bits that differ in at most four bits agree in two of any six blocks
of them, since four bits touch at most four blocks. So every distinct fingerprint goes
to one shard for each of the 15 pairs of blocks, keyed by the pair and its bits (about
21): the same shards at every size, with a few fingerprints each. A shard is searched
with a BK-tree, whose children hang at their distance from the parent; a search follows
the edges within the radius. A large shard is cut into chunks of bounded size, and the
tree of each chunk is sent to the tasks that search it with the fingerprints of the
other chunks. Only links that join something new are given out, at most one less than
the fingerprints of a shard, so a group of copies does not yield its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.components import connected
from logtide.llm.shared import partitions_for, plain_batch, stored, whole_text, words

SHINGLE = 4
RADIUS = 4
BITS = 64
#: Fingerprints of a shard in one tree.
CHUNK = 2048


def lower_ascii(text: Column) -> Column:
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(text, upper, upper.lower())


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per run of hashes the bits set in over half of them; zero for no hashes."""
    out = np.zeros(len(bounds) - 1, np.uint64)
    sizes = np.diff(bounds)
    full = np.flatnonzero(sizes)
    for some in np.array_split(full, max(1, int(sizes.sum()) // 100_000)):
        if not len(some):
            continue
        low, high = bounds[some[0]], bounds[some[-1] + 1]
        bits = np.unpackbits(hashes[low:high].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, bounds[some] - low, axis=0, dtype=np.int64)
        chosen = (2 * ones > sizes[some, None]).astype(np.uint8)
        out[some] = np.packbits(chosen, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the 64-bit SimHash of every whole text (as a signed number).

    A null or empty text has fingerprint zero. Rows are kept one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            bounds = lists.offsets.to_numpy().astype(np.int64)
            hashes = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False)).view(np.uint64)
            yield plain_batch({"doc_id": batch.column(0), "fp": majority(hashes, bounds).view(np.int64)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(lower_ascii(whole_text())).alias("w"))
    count = F.size("w")
    runs = F.sequence(F.lit(1), F.greatest(count - (SHINGLE - 1), F.lit(1)))
    # `w` is used twice, so Spark splits each text once.
    hashed = F.transform(runs, lambda i: F.xxhash64(F.array_join(F.slice("w", i, SHINGLE), " ")))
    rows = rows.select("doc_id", F.when(count > 0, hashed).otherwise(F.array().cast("array<bigint>")).alias("h"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _blocks() -> list[tuple[int, int]]:
    """(first bit, bits) of six blocks."""
    edges = [round(i * BITS / (RADIUS + 2)) for i in range(RADIUS + 3)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def shard_keys(fp: Column) -> Column:
    """The 15 shards of a fingerprint, each as one number."""
    parts = [
        F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << size) - 1)) for first, size in _blocks()
    ]
    pairs = list(combinations(range(len(parts)), 2))
    return F.array(
        *[
            F.shiftleft(F.shiftleft(F.lit(n).cast("long"), 11) + parts[a], 11) + parts[b]
            for n, (a, b) in enumerate(pairs)
        ]
    )


class BKTree:
    """Numbers under the Hamming distance."""

    def __init__(self):
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while True:
            distance = (value ^ node[0]).bit_count()
            child = node[1].get(distance)
            if child is None:
                if distance:
                    node[1][distance] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> Iterator[int]:
        todo = [self.root] if self.root else []
        while todo:
            own, children = todo.pop()
            distance = (value ^ own).bit_count()
            if distance <= radius:
                yield own
            for edge in range(max(1, distance - radius), distance + radius + 1):
                child = children.get(edge)
                if child is not None:
                    todo.append(child)


def shard_links(values: list[int], others: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that join all near values: within a chunk, or between two chunks."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    tree, links = BKTree(), []
    for value in values:
        if others is None:
            links += _join(tree.within(value, RADIUS), value, find, root)
        tree.add(value)
    for value in others or []:
        links += _join(tree.within(value, RADIUS), value, find, root)
    return links


def _join(near: Iterator[int], value: int, find, root: dict[int, int]) -> Iterator[tuple[int, int]]:
    for other in near:
        one, two = find(other), find(value)
        if one != two:
            root[one] = two
            yield other, value


def near_links(prints: DataFrame) -> DataFrame:
    """a, b: links between distinct fingerprints (column `fp`) that connect all near ones."""
    distinct = prints.select("fp").distinct()
    sharded = distinct.select("fp", F.explode(shard_keys(F.col("fp"))).alias("shard"))
    sharded = stored(sharded.repartition(2 * partitions_for(prints), "shard"), "shards")
    sizes = sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    placed = sharded.join(sizes, "shard").withColumn("chunks", chunks)
    chunk = F.pmod(F.xxhash64("fp", "shard"), F.col("chunks")).cast("int")
    # Chunk i meets every chunk j: once as the tree (i <= j), else as the searching side.
    meets = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    pairs = placed.withColumn("chunk", chunk).select("fp", "shard", "chunk", meets)
    pairs = pairs.select(
        "fp",
        "shard",
        F.least("chunk", "other").alias("i"),
        F.greatest("chunk", "other").alias("j"),
        (F.col("chunk") > F.col("other")).alias("searches"),
    )
    pairs = pairs.repartition(2 * partitions_for(prints), "shard", "i", "j")
    pairs = pairs.sortWithinPartitions("shard", "i", "j", "searches")
    return pairs.mapInArrow(_search, "a long, b long")


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Searches run by run; a run holds two chunks at most and may span batches."""
    held: list[np.ndarray] = []

    def links_of(rows: np.ndarray) -> list[tuple[int, int]]:
        found: list[tuple[int, int]] = []
        keys = rows[:, 1:4]
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip(np.r_[0, edges], np.r_[edges, len(rows)], strict=True):
            if b - a < 2:
                continue
            run = rows[a:b]
            values = (run[:, 0].view(np.uint64)).tolist()
            if run[0, 2] == run[0, 3]:
                found += shard_links(values)
            else:
                trees = int((run[:, 4] == 0).sum())
                found += shard_links(values[:trees], values[trees:])
        return found

    def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return plain_batch({"a": np.ascontiguousarray(pairs[:, 0]), "b": np.ascontiguousarray(pairs[:, 1])})

    for batch in batches:
        columns = [batch.column(i).cast(pa.int64()).to_numpy(zero_copy_only=False) for i in range(5)]
        rows = np.stack(columns, axis=1)
        if not len(rows):
            continue
        if held and (held[-1][-1, 1:4] == rows[-1, 1:4]).all():
            held.append(rows)
            continue
        last = np.flatnonzero((rows[:, 1:4] != rows[-1, 1:4]).any(axis=1))
        cut = int(last[-1]) + 1 if len(last) else 0
        if held or cut:
            yield batch_of(links_of(np.concatenate([*held, rows[:cut]])))
        held = [rows[cut:]]
    if held:
        yield batch_of(links_of(np.concatenate(held)))


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per row of `docs`.

    `component_id` is the smallest doc_id reachable over links of at most four differing
    bits, the document itself included. Texts without words have fingerprint zero, which
    links like any other. Repeated rows share their component. A null id is never the
    smallest unless its component has no other. No documents give no rows.
    """
    prints = stored(fingerprints(docs), "fingerprints")
    smallest = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "smallest")
    links = near_links(smallest)
    roots = connected(links, smallest.select(F.col("fp").alias("node"), F.col("first").alias("label")))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(roots.withColumnRenamed("node", "fp"), "fp").select(
        "doc_id", hexed.alias("fingerprint"), F.col("label").alias("component_id")
    )
