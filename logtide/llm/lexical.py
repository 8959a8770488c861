"""Ranked lexical search over inverted lists in blocks of similar documents.

Documents are searched shard by shard: some thousand documents whose vectors one task
holds. In a shard the documents that hold a term form its list. A list is clustered by
the similarity of whole document vectors, and each block keeps a summary: the largest
value of any of its documents in every coordinate. The product of a query and a summary
bounds every score in the block, so a block is skipped only if that bound is below the
score of the last document that counts so far; the results are exact. Lists are looked
at from the one that can add most, and those that together cannot lift a document over
that score are left alone. Summaries of a list keep the terms that occur in a query
beside the list's own; other coordinates never meet a query.

Queries are the smaller side. They go to the tasks in blocks of bounded bytes, one pass
over the documents each; a task returns its best documents per query, not its matches.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.shared import column_bytes, stored, whole_text

MOST = 10
#: Bytes of query texts that go to the tasks at once.
QUERY_BYTES = 4_000_000
#: Documents and values of a shard.
SHARD_ROWS, SHARD_VALUES = 4096, 400_000
#: Documents of a block, and numbers that stand for a document when lists are clustered.
BLOCK, SKETCH = 32, 16
#: Cells of summaries that a task keeps.
CELLS = 16_000_000
#: Tasks whose results are ranked together before all are.
TASKS = 100
#: ASCII letters and digits are parts of terms, as is every byte above ASCII.
FOLD = bytes(
    i + 32 if 65 <= i <= 90 else i if i > 127 or chr(i).isalnum() else 32 for i in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII; only A-Z are lower-cased."""
    return text.translate(FOLD).split()


@dataclass
class Queries:
    """A block of queries: the numbers of their terms and how often each occurs."""

    item_rows: list[int]
    item_ids: list[int | None]
    numbers: dict[bytes, int]
    rows: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, items: list[tuple[int, int | None, str | None]]) -> Queries:
        numbers: dict[bytes, int] = {}
        rows = []
        for _, _, text in items:
            counts = Counter(numbers.setdefault(t, len(numbers)) for t in terms((text or "").encode()))
            held = sorted(counts)
            rows.append((np.array(held, np.int64), np.array([counts[t] for t in held], np.int64)))
        return cls([i[0] for i in items], [i[1] for i in items], numbers, rows)

    def weighted(self, weights: np.ndarray) -> None:
        """Multiply counts with the weights of terms; those of weight zero go."""
        weighted = [(held, counts * weights[held]) for held, counts in self.rows]
        self.rows = [(held[w > 0], w[w > 0]) for held, w in weighted]

    def beside(self) -> list[np.ndarray]:
        """For each term the terms of all queries that hold it."""
        found: list[list[np.ndarray]] = [[] for _ in self.numbers]
        for held, _ in self.rows:
            for term in held.tolist():
                found[term].append(held)
        return [np.unique(np.concatenate(x)) if x else np.zeros(0, np.int64) for x in found]


def vectors(docs: DataFrame, numbers) -> DataFrame:
    """doc_id, n (terms of the text), ids and tfs (those in the broadcast `numbers`), per row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            sizes, ids, tfs, held = [], [], [], [0]
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                found = terms(data[a:b].tobytes())
                counts = Counter(map(known.get, found))
                counts.pop(None, None)
                sizes.append(len(found))
                ids.extend(counts)
                tfs.extend(counts.values())
                held.append(len(ids))
            ends = pa.array(held, pa.int32())
            columns = [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "ids", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<int>")


class Best:
    """The documents of highest score, equal ones by ascending id, null ids last."""

    def __init__(self, most: int):
        self.most = most
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.nulls = np.zeros(0, bool)

    def least(self) -> int:
        """The score that a document must reach to count."""
        return int(self.scores[-1]) if len(self.scores) == self.most else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        able = scores >= self.least()
        if not able.any():
            return
        scores = np.r_[self.scores, scores[able]]
        ids, nulls = np.r_[self.ids, ids[able]], np.r_[self.nulls, nulls[able]]
        order = np.lexsort((ids, nulls, -scores))[: self.most]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]


class Shard:
    """Documents as sparse vectors, their lists per term and the blocks of these."""

    def __init__(self, ids, nulls, held, counts, values, beside, sketches):
        self.ids, self.nulls, self.beside = ids, nulls, beside
        self.starts = np.r_[0, np.cumsum(counts)]
        self.counts, self.held, self.values = counts, held, values
        rows = np.repeat(np.arange(len(ids)), counts)
        order = np.argsort(held, kind="stable")
        self.list_rows = rows[order]
        self.list_starts = np.searchsorted(held[order], np.arange(len(beside) + 1))
        self.largest = np.zeros(len(beside), np.int64)
        np.maximum.at(self.largest, held, values)
        # A few products with fixed random directions stand for a document's vector.
        self.points = np.zeros((len(ids), SKETCH), np.float32)
        full = np.flatnonzero(counts)
        if len(full):
            parts = sketches[held] * values[:, None].astype(np.float32)
            self.points[full] = np.add.reduceat(parts, self.starts[full], axis=0)
            self.points /= np.maximum(np.linalg.norm(self.points, axis=1, keepdims=True), 1e-9)
        self.blocks: dict[int, tuple] = {}
        self.cells = 0

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all values of the rows, and where each row's begin."""
        counts = self.counts[rows]
        begins = np.cumsum(counts) - counts
        return np.repeat(self.starts[rows] - begins, counts) + np.arange(int(counts.sum())), begins

    def blocked(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents by block, where blocks begin, summaries) of the list of a term."""
        known = self.blocks.get(term)
        if known is not None:
            return known
        rows = self.list_rows[self.list_starts[term] : self.list_starts[term + 1]]
        blocks = math.ceil(len(rows) / BLOCK)
        leaders = rows[np.arange(blocks) * len(rows) // blocks]
        nearest = (self.points[rows] @ self.points[leaders].T).argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        rows, nearest = rows[order], nearest[order]
        first = np.flatnonzero(np.r_[True, nearest[1:] != nearest[:-1]])
        block = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(rows)]))
        axes = self.beside[term]
        places, _ = self.entries(rows)
        held = self.held[places]
        axis = np.minimum(np.searchsorted(axes, held), len(axes) - 1)
        seen = axes[axis] == held
        cells = np.repeat(block, self.counts[rows]) * len(axes) + axis
        summary = np.zeros(len(first) * len(axes), np.int64)
        np.maximum.at(summary, cells[seen], self.values[places[seen]])
        if self.cells + len(summary) > CELLS:
            self.blocks.clear()
            self.cells = 0
        self.cells += len(summary)
        self.blocks[term] = rows, np.r_[first, len(rows)], summary.reshape(len(first), len(axes))
        return self.blocks[term]

    def search(self, held: np.ndarray, weights: np.ndarray, scale: np.ndarray, best: Best) -> None:
        """Add the documents to `best`; `scale` holds a zero per term and is left so."""
        adds = weights * self.largest[held]
        order = np.argsort(-adds, kind="stable")
        left = int(adds.sum())
        if left < best.least():
            return
        scale[held] = weights
        met = np.zeros(len(self.ids), bool)
        for i in order.tolist():
            if left < best.least() or not adds[i]:
                break
            left -= int(adds[i])
            term = int(held[i])
            rows, first, summary = self.blocked(term)
            bounds = summary[:, np.searchsorted(self.beside[term], held)] @ weights
            todo = np.argsort(-bounds, kind="stable")
            step = 2
            while len(todo) and bounds[todo[0]] >= best.least():
                some = [rows[first[b] : first[b + 1]] for b in todo[:step].tolist() if bounds[b] >= best.least()]
                new = np.concatenate(some)
                new = new[~met[new]]
                met[new] = True
                if len(new):
                    places, begins = self.entries(new)
                    scores = np.add.reduceat(scale[self.held[places]] * self.values[places], begins)
                    best.add(scores, self.ids[new], self.nulls[new])
                todo, step = todo[step:], 2 * step
        scale[held] = 0


def _searched(queries, documents: int, all_terms: int, most: int):
    """The step that searches vectors, shard by shard, and gives the best at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Queries = queries.value
        beside = asked.beside()
        sketches = np.random.default_rng(42).standard_normal((len(beside), SKETCH), np.float32)
        scale = np.zeros(len(beside), np.int64)
        best = [Best(most) for _ in asked.rows]
        waiting: list[tuple] = []

        def flush() -> None:
            ids, nulls, held, counts, values = (np.concatenate(x) for x in zip(*waiting, strict=True))
            waiting.clear()
            shard = Shard(ids, nulls, held, counts, values, beside, sketches)
            for (terms_held, weights), found in zip(asked.rows, best, strict=True):
                shard.search(terms_held, weights, scale, found)

        for batch in batches:
            ends = batch.column(2).offsets.to_numpy().astype(np.int64)
            held = batch.column(2).values.to_numpy().astype(np.int64)
            tfs = batch.column(3).values.to_numpy().astype(np.int64)
            nulls = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy()
            length = 100 - 75 + (75 * batch.column(1).to_numpy() * documents) // all_terms
            first = 0
            while first < len(ids):
                last = int(np.searchsorted(ends, ends[first] + SHARD_VALUES, "right")) - 1
                last = min(max(last, first + 1), first + SHARD_ROWS, len(ids))
                a, b = ends[first], ends[last]
                counts = np.diff(ends[first : last + 1])
                tf, per = tfs[a:b], np.repeat(length[first:last], counts)
                values = (1_000_000_000 * tf) // (1000 * tf + 8 * per)
                part = (ids[first:last], nulls[first:last], held[a:b], counts, values)
                size = sum(len(x[2]) for x in waiting) + len(values)
                if waiting and (size > SHARD_VALUES or sum(len(x[0]) for x in waiting) + len(part[0]) > SHARD_ROWS):
                    flush()
                waiting.append(part)
                first = last
        if waiting:
            flush()
        task = TaskContext.get().partitionId()
        sizes = [len(x.ids) for x in best]
        if not sum(sizes):
            return
        which = np.repeat(np.arange(len(best)), sizes)
        columns = [
            pa.array([task] * len(which), pa.int32()),
            pa.array(np.array(asked.item_rows, np.int64)[which]),
            pa.array(asked.item_ids, pa.int64()).take(pa.array(which)),
            pa.array(np.concatenate([x.ids for x in best]), mask=np.concatenate([x.nulls for x in best])),
            pa.array(np.concatenate([x.scores for x in best])),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["task", "item_row", "item_id", "doc_id", "score"])

    return run


def _search_block(docs: DataFrame, items: list[tuple[int, int | None, str | None]], most: int) -> DataFrame | None:
    queries = Queries.of(items)
    context = docs.sparkSession.sparkContext
    held = stored(vectors(docs, context.broadcast(queries.numbers)), "term-vectors")
    total = held.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    if not total.documents:
        return None
    df = np.zeros(len(queries.numbers), np.int64)
    # At most one row per term of the block of queries.
    for row in held.select(F.explode("ids").alias("id")).groupBy("id").count().collect():
        df[row.id] = row["count"]
    of_all = 2 * total.documents + 2
    weights = [math.floor(1000 * math.log(of_all / (2 * n + 1))) if n else 0 for n in df.tolist()]
    queries.weighted(np.array(weights, np.int64))
    run = _searched(context.broadcast(queries), total.documents, total.terms, most)
    return held.mapInArrow(run, "task int, item_row long, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, most: int = MOST) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the `most` best documents of every row of `items`.

    `docs` has doc_id and text, `items` item_id and text; other columns are not looked at.
    Equal scores are ranked by ascending doc_id, null ids last. Repeated rows count and are
    ranked one by one. Null and empty texts have no terms: such documents do not count, such
    items have no rows, and neither have items none of whose terms is in a document.
    """
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    rows = stored(rows.withColumn("item_row", F.monotonically_increasing_id()), "queries")
    size = rows.agg(F.sum(F.octet_length(whole_text()))).first()[0] or 0
    blocks = math.ceil(size / QUERY_BYTES)
    block = F.pmod(F.xxhash64("item_row"), F.lit(max(blocks, 1)))
    found = None
    for number in range(blocks):
        held = rows.filter(block == number).select("item_row", "item_id", "text").collect()
        part = _search_block(docs, [tuple(x) for x in held], most)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    # Each task gives a few rows per query; some tasks are ranked together, then all.
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["item_row", F.floor(F.col("task") / TASKS)], ["item_row"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best)))
        found = found.filter(F.col("rank") <= most)
    return found.select("item_id", "rank", "doc_id", "score")
