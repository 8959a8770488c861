"""Repeated byte strings by a hash-compared suffix sort.

Every seed that occurs more than once (see `seeds`) gives one suffix: the bytes from the
seed on, with the few bytes before it that a common string could also hold. Suffixes with
the same seed meet in one group. Groups are merge-sorted; a comparison finds how far two
suffixes agree by binary search over prefix hashes and looks at one byte behind. Bytes
before the seed are sorted likewise from right to left. Agreements between neighbours
are then checked byte by byte, which excludes hash collisions, and tell for each offset
which suffixes lie in the same 50 bytes. Equal surroundings nearby are one suffix
that lists its places. A seed with too many suffixes is replaced by longer ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.seeds import (
    BYTE_SYMBOLS,
    STEP,
    Prefixes,
    distinct_texts,
    mixed,
    repeated_seeds,
    results_for,
    with_places,
)
from logtide.llm.shared import column_bytes, discard, partitions_for, plain_batch, steps, stored

WINDOW = 50
GRAM = 24
LEFT = WINDOW - GRAM
SPAN = LEFT + WINDOW
#: Suffixes of one seed that a task sorts; seeds with more are lengthened by half of LEFT.
GROUP = 20_000
HALF = LEFT // 2
#: Seeds whose surroundings are laid out at once.
SLICE = 20_000
CONTEXT = "seed long, body binary, pad int, least long, firsts array<long>, ties array<long>, places array<int>"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The surroundings of repeated seeds; equal ones of a slice are one row.

    `body` has LEFT + WINDOW bytes. Where the text ends sooner it is filled up, with
    `pad` = bytes missing on the left * 256 + bytes missing on the right.
    """
    for batch in batches:
        firsts, ties = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        lists = batch.column(2)
        list_at, list_all = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        data, offsets = column_bytes(batch.column(3))
        for first, last in steps(offsets, STEP):
            part = data[offsets[first] : offsets[last]]
            bounds = offsets[first : last + 1] - offsets[first]
            text = np.repeat(np.arange(last - first), np.diff(list_at[first : last + 1]))
            seeds = list_all[list_at[first] : list_at[last]].astype(np.int64)
            inside = seeds + GRAM <= np.diff(bounds)[text]
            text, seeds = text[inside], seeds[inside]
            if not len(seeds):
                continue
            own_firsts, own_ties = firsts[first + text], ties[first + text]
            for low in range(0, len(seeds), SLICE):
                few = slice(low, low + SLICE)
                yield _surroundings(part, bounds, text[few], seeds[few], own_firsts[few], own_ties[few])


def _surroundings(
    part: np.ndarray,
    bounds: np.ndarray,
    text: np.ndarray,
    seeds: np.ndarray,
    firsts: np.ndarray,
    ties: np.ndarray,
) -> pa.RecordBatch:
    at = seeds + bounds[text]
    left = np.minimum(seeds, LEFT)
    right = np.minimum(np.diff(bounds)[text] - seeds, WINDOW)
    near = part[at[0] : at[-1] + GRAM]
    grams = mixed(Prefixes(BYTE_SYMBOLS[near]).of(at - at[0], at - at[0] + GRAM))
    columns = np.arange(SPAN)
    body = part[np.clip(at[:, None] - LEFT + columns, 0, len(part) - 1)]
    body[(columns < LEFT - left[:, None]) | (columns >= LEFT + right[:, None])] = 0
    pad = ((LEFT - left) * 256 + WINDOW - right).astype(np.int32)
    whole = np.ascontiguousarray(np.concatenate([body, pad.view(np.uint8).reshape(-1, 4)], axis=1))
    _, chosen, inverse = np.unique(whole.view(f"V{SPAN + 4}")[:, 0], return_index=True, return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(inverse, minlength=len(chosen)))])
    lists = pa.array(ends.astype(np.int32))
    bodies = pa.py_buffer(np.ascontiguousarray(body[chosen]))
    return plain_batch(
        {
            "seed": grams[chosen].view(np.int64),
            "body": pa.FixedSizeBinaryArray.from_buffers(pa.binary(SPAN), len(chosen), [None, bodies]).cast(pa.binary()),
            "pad": pad[chosen],
            "least": np.minimum.reduceat(firsts[order], ends[:-1]),
            "firsts": pa.ListArray.from_arrays(lists, pa.array(firsts[order])),
            "ties": pa.ListArray.from_arrays(lists, pa.array(ties[order])),
            "places": pa.ListArray.from_arrays(lists, pa.array(seeds[order].astype(np.int32))),
        }
    )


class HashedSuffixes:
    """Suffixes as rows of bytes, compared by the prefix hashes of each row."""

    def __init__(self, rows: np.ndarray, lengths: np.ndarray):
        self.rows, self.lengths = rows, lengths
        width = rows.shape[1]
        scale = np.cumprod(np.full(width, np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)
        self.hashes = np.zeros((len(rows), width + 1), np.uint64)
        np.cumsum(BYTE_SYMBOLS[rows] * scale, axis=1, out=self.hashes[:, 1:])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes the suffixes share, by binary search over their hashes."""
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.lengths[a], self.lengths[b])
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            equal = self.hashes[a, middle] == self.hashes[b, middle]
            low = np.where(open_ & equal, middle, low)
            high = np.where(open_ & ~equal, middle - 1, high)
        return low

    def after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix a comes after suffix b; the shorter of two comes first."""
        same = self.common(a, b)
        ended_a, ended_b = same >= self.lengths[a], same >= self.lengths[b]
        last = self.rows.shape[1] - 1
        byte_a = self.rows[a, np.minimum(same, last)].astype(np.int16)
        byte_b = self.rows[b, np.minimum(same, last)].astype(np.int16)
        return np.where(ended_a | ended_b, ~ended_a & ended_b, byte_a > byte_b)

    def checked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Shared bytes of neighbours, verified: a hash collision only shortens them."""
        same = self.common(a, b)
        differ = self.rows[a] != self.rows[b]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), self.rows.shape[1])
        return np.minimum(same, first)


def merge_sort(suffixes: HashedSuffixes, groups: np.ndarray) -> np.ndarray:
    """Order of the suffixes within their groups, which are consecutive.

    All groups are merged at once, bottom up: an element's place in a merged pair of runs
    is its place in its own run plus its rank in the other, found by binary search.
    """
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[starts, len(groups)])
    start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    order = np.arange(len(groups))
    inside = order - start
    width = 1
    while width < sizes.max():
        active = np.flatnonzero(size > width)
        run = inside[active] // width
        own = inside[active] - run * width
        pair = start[active] + (run - run % 2) * width
        is_left = run % 2 == 0
        other = pair + np.where(is_left, width, 0)
        end = start[active] + size[active]
        low, high = np.zeros(len(active), np.int64), np.clip(end - other, 0, width)
        me = order[active]
        while (open_ := low < high).any():
            middle = np.where(open_, (low + high) // 2, 0)
            it = order[np.minimum(other + middle, len(order) - 1)]
            # Equal suffixes keep the order of their runs.
            left_first = suffixes.after(np.where(is_left, me, it), np.where(is_left, it, me))
            before_me = np.where(is_left, left_first, ~left_first)
            low = np.where(open_ & before_me, middle + 1, low)
            high = np.where(open_ & ~before_me, middle, high)
        merged = order.copy()
        merged[pair + own + low] = me
        order = merged
        width *= 2
    return order


def _classes(order: np.ndarray, shared: np.ndarray, least: int) -> np.ndarray:
    """Class numbers of suffixes whose neighbours in order share `least` bytes or more."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < least)
    return out


def _spans(
    groups: np.ndarray, body: np.ndarray, pad: np.ndarray, least: np.ndarray, low: np.ndarray, high: np.ndarray
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per offset: (rows, least id of a text with the same window)."""
    right = HashedSuffixes(np.ascontiguousarray(body[:, LEFT:]), WINDOW - pad % 256)
    left = HashedSuffixes(np.ascontiguousarray(body[:, :LEFT][:, ::-1]), LEFT - pad // 256)
    ordered = []
    for side in (right, left):
        order = merge_sort(side, groups)
        shared = np.full(len(order), -1, np.int64)
        same = groups[order[1:]] == groups[order[:-1]]
        shared[1:][same] = side.checked(order[1:][same], order[:-1][same])
        ordered.append((order, shared))
    found = []
    for offset in range(LEFT + 1):
        fits = (offset <= LEFT - pad // 256) & (WINDOW - offset <= WINDOW - pad % 256)
        rows = np.flatnonzero(fits & (low <= offset) & (offset <= high))
        if not len(rows):
            continue
        one = _classes(*ordered[0], WINDOW - offset)[rows]
        two = _classes(*ordered[1], offset)[rows]
        key = one * (len(body) + 1) + two
        order = np.argsort(key, kind="stable")
        edges = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
        smallest = np.minimum.reduceat(least[rows][order], edges)
        out = np.empty(len(rows), np.int64)
        out[order] = np.repeat(smallest, np.diff(np.r_[edges, len(rows)]))
        found.append((offset, rows, out))
    return found


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """first, tie, start, stop of bytes that also lie in a text of smaller id.

    Rows come in the order of their groups. Whole groups are gathered up to a bound.
    """

    def spans(table: pa.Table) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        groups = table.column("group").to_numpy()
        body = np.frombuffer(b"".join(table.column("body").to_pylist()), np.uint8).reshape(-1, SPAN)
        pad, least = table.column("pad").to_numpy().astype(np.int64), table.column("least").to_numpy()
        low, high = (table.column(c).to_numpy().astype(np.int64) for c in ("low", "high"))
        lists = {c: table.column(c).combine_chunks() for c in ("firsts", "ties", "places")}
        lists = {c: x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for c, x in lists.items()}
        sizes = np.diff(lists["firsts"].offsets.to_numpy())
        firsts, ties, places = (x.flatten().to_numpy(zero_copy_only=False) for x in lists.values())
        row_of = np.repeat(np.arange(len(sizes)), sizes)
        start = np.full(len(firsts), np.iinfo(np.int64).max)
        stop = np.full(len(firsts), -1)
        for offset, rows, smallest in _spans(groups, body, pad, least, low, high):
            bound = np.full(len(sizes), np.iinfo(np.int64).max)
            bound[rows] = smallest
            gone = bound[row_of] < firsts
            # The windows of one seed overlap, so their union is one span.
            start = np.where(gone, np.minimum(start, places - offset), start)
            stop = np.where(gone, np.maximum(stop, places - offset + WINDOW), stop)
        hit = stop >= 0
        return plain_batch(
            {
                "first": firsts[hit],
                "tie": ties[hit],
                "start": start[hit].astype(np.int32),
                "stop": stop[hit].astype(np.int32),
            }
        )

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = batch.column(0).to_numpy(zero_copy_only=False)
        rows += batch.num_rows
        last = np.flatnonzero(groups != groups[-1])
        cut = int(last[-1]) + 1 if len(last) else 0
        if rows >= 2 * GROUP and (cut or groups[-1] != held[-1].column(0)[-1].as_py() if held else cut):
            yield spans(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held, rows = [batch.slice(cut)], batch.num_rows - cut
        else:
            held.append(batch)
    if held:
        yield spans(pa.Table.from_batches(held))


def repeated_spans(contexts: DataFrame) -> DataFrame:
    """first, tie, start, stop from the surroundings of repeated seeds."""
    counted = contexts.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    common = stored(counted.filter(F.col("n") > GROUP), "common")
    sized = contexts.join(common, "seed", "left")
    # Windows that start close to the seed hold more bytes after it, the others more
    # before it: two longer seeds see all windows of a common one.
    after = F.struct(
        F.xxhash64("seed", F.substring("body", LEFT + GRAM + 1, HALF)).alias("group"),
        F.lit(0).alias("low"),
        F.lit(HALF).alias("high"),
    )
    before = F.struct(
        F.xxhash64("seed", F.substring("body", HALF, HALF + 1), F.lit(1)).alias("group"),
        F.lit(HALF + 1).alias("low"),
        F.lit(LEFT).alias("high"),
    )
    plain = F.struct(F.col("seed").alias("group"), F.lit(0).alias("low"), F.lit(LEFT).alias("high"))
    ways = F.explode(F.when(F.col("n").isNull(), F.array(plain)).otherwise(F.array(after, before)))
    grouped = sized.withColumn("way", ways).select("way.*", *[c for c in contexts.columns if c != "seed"])
    grouped = grouped.repartition(2 * partitions_for(contexts), "group").sortWithinPartitions("group")
    return grouped.mapInArrow(_search, "first long, tie long, start int, stop int")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes left once all spans are taken out, and the number of maximal runs removed."""
    for batch in batches:
        spans = batch.column(2)
        at = spans.offsets.to_numpy()
        fields = spans.values
        starts, stops = (fields.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        data, offsets = column_bytes(batch.column(3))
        for first, last in steps(offsets, STEP):
            part = data[offsets[first] : offsets[last]]
            bounds = offsets[first : last + 1] - offsets[first]
            text = np.repeat(np.arange(last - first), np.diff(at[first : last + 1]))
            own = slice(at[first], at[last])
            marks = np.zeros(len(part) + 1, np.int64)
            np.add.at(marks, starts[own] + bounds[text], 1)
            np.add.at(marks, stops[own] + bounds[text], -1)
            gone = np.cumsum(marks)[:-1] > 0
            before = np.r_[False, gone[:-1]] if len(gone) else gone
            before[bounds[:-1][bounds[:-1] < len(part)]] = False
            begins = np.r_[0, np.cumsum(gone & ~before)]
            removed = np.r_[0, np.cumsum(gone)]
            stays = part[~gone].tobytes()
            kept_at = bounds - removed[bounds]
            kept = [stays[a:b] for a, b in zip(kept_at[:-1].tolist(), kept_at[1:].tolist(), strict=True)]
            yield plain_batch(
                {
                    "first": batch.column(0).slice(first, last - first),
                    "tie": batch.column(1).slice(first, last - first),
                    "n_bytes": np.diff(bounds),
                    "n_removed": np.diff(removed[bounds]),
                    "n_spans": np.diff(begins[bounds]),
                    "kept_text": pa.array(kept, pa.binary()),
                }
            )


def remove_repeats(docs: DataFrame, kept: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and kept_text (bytes).

    A byte of the UTF-8 text goes if it lies in a 50-byte string that also starts in a
    document of smaller id; strings overlap and are judged on the input. n_spans counts
    maximal removed runs. A null text is empty. Rows of equal ids do not remove each
    other's bytes. A null id comes after all others. Of equal texts, those of larger ids
    go whole if they have 50 bytes. No documents give no rows. `kept` is what to make of
    kept_text before it moves, such as a digest.
    """
    copies, texts = distinct_texts(docs)
    seeds = repeated_seeds(texts, "bytes", GRAM, WINDOW)
    contexts = stored(with_places(texts, seeds).mapInArrow(_contexts, CONTEXT), "contexts")
    discard(seeds)
    found = stored(repeated_spans(contexts), "spans")
    discard(contexts)
    spans = found.groupBy("first", "tie").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    none = F.array().cast("array<struct<start:int,stop:int>>")
    marked = texts.join(spans, ["first", "tie"], "left").select(
        "first", "tie", F.coalesce("spans", none).alias("spans"), "text"
    )
    shape = "first long, tie long, n_bytes long, n_removed long, n_spans long, kept_text binary"
    return results_for(docs, copies, marked.mapInArrow(_cut, shape), "n_bytes", WINDOW, kept)
