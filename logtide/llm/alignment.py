"""Which tokens of two tokenizers say the same bytes of a text.

Both tokenizers cut the same bytes, so their token ends are two rising rows of byte
offsets. A text is divided at ends that both share: near the middle of an interval a
common end is looked for by bisecting the other row, nearer ends first, and both halves
are divided on; an interval without a common end inside is a group. All open intervals
of a chunk of texts are divided together, as arrays.

How often an id pair is linked is counted per text over the whole corpus. A chunk of
texts first counts its distinct pairs, so only those are shuffled, and gets their
corpus-wide counts back as one table beside its own texts, whose links are stored as
places in that table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.bpe import PIECES, Vocabulary, vocabulary
from logtide.llm.shared import column_bytes, map_arrow, partitions_for, steps, stored, whole_text

#: Bytes of text whose tokens are aligned together.
CHUNK_BYTES = 3_000_000
#: Bits of an id of the second tokenizer within a pair.
SHIFT = 20


class Tokens:
    """A tokenizer: ids of a text, and for every id its bytes, their number and its decimals."""

    def __init__(self, entries: list[bytes], encode):
        self.entries, self.encode = entries, encode
        self.sizes = np.array([len(x) for x in entries], np.int64)

    def ids(self, text: str, spaced: bytes) -> np.ndarray | None:
        """None if the entries do not join to the bytes of space and text."""
        ids = self.encode(text)
        if b"".join(map(self.entries.__getitem__, ids)) != spaced:
            return None
        return np.array(ids, np.int64)


@lru_cache(maxsize=2)
def byte_tokens(path: str) -> Tokens:
    """Byte-level BPE of space and text, strings of special tokens being plain text."""
    ordinary = Vocabulary(path).ordinary
    inner = tiktoken.Encoding("vocabulary", pat_str=PIECES, mergeable_ranks={t: n for n, t in ordinary.items()}, special_tokens={})
    entries = [ordinary.get(i, b"") for i in range(max(ordinary) + 1)]
    return Tokens(entries, lambda text: inner.encode_ordinary(" " + text))


@lru_cache(maxsize=2)
def piece_tokens(path: str) -> Tokens:
    """Pieces, of which the first gets the space itself."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        entries.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return Tokens(entries, model.encode)


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in `a_ends` and in `b_ends` of all ends in both, by divide and conquer.

    Both rise, start at or above 1 and end with the same number.
    """
    if not len(a_ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a_cuts, b_cuts = [len(a_ends) - 1], [len(b_ends) - 1]
    # Intervals of ends strictly between cuts: a in [low, high), b in [under, over).
    low, high = np.array([0]), np.array([len(a_ends) - 1])
    under, over = np.array([0]), np.array([len(b_ends) - 1])
    reach = np.array([0])
    while True:
        open_ = (low < high) & (under < over)
        low, high, under, over, reach = (x[open_] for x in (low, high, under, over, reach))
        if not len(low):
            break
        # The end `reach` places from the middle: 0, 1, -1, 2, -2, ...
        middle = (low + high) >> 1
        probe = middle + np.where(reach & 1, (reach + 1) >> 1, -(reach >> 1))
        inside = (probe >= low) & (probe < high)
        at = np.searchsorted(b_ends, a_ends[np.where(inside, probe, low)])
        hit = inside & (b_ends[at] == a_ends[np.where(inside, probe, low)])
        a_cuts.extend([probe[hit]] if hit.any() else [])
        b_cuts.extend([at[hit]] if hit.any() else [])
        miss = ~hit & (reach + 1 <= 2 * (high - low))
        zero = np.zeros(int(hit.sum()), np.int64)
        low, high, under, over, reach = (
            np.concatenate([low[hit], probe[hit] + 1, low[miss]]),
            np.concatenate([probe[hit], high[hit], high[miss]]),
            np.concatenate([under[hit], at[hit] + 1, under[miss]]),
            np.concatenate([at[hit], over[hit], over[miss]]),
            np.concatenate([zero, zero, reach[miss] + 1]),
        )
    return np.sort(np.hstack(a_cuts)), np.sort(np.hstack(b_cuts))


def linked(a_ends: np.ndarray, b_ends: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray):
    """Places (a, b) of all pairs of tokens whose bytes overlap, in order.

    Between two ends next to each other, of whichever tokenizer, lies one token of each.
    """
    own = np.ones(len(b_ends), bool)
    own[b_cuts] = False
    rest = b_ends[own]
    ends = np.empty(len(a_ends) + len(rest), np.int64)
    from_b = np.searchsorted(a_ends, rest) + np.arange(len(rest))
    is_a = np.ones(len(ends), bool)
    is_a[from_b] = False
    ends[from_b], ends[is_a] = rest, a_ends
    a = np.cumsum(is_a) - is_a
    is_b = np.ones(len(ends), bool)
    is_b[is_a] = False
    shared = np.flatnonzero(is_a)[a_cuts]
    is_b[shared] = True
    return a, np.cumsum(is_b) - is_b


class Decimals:
    """The ids of both tokenizers as texts with the mark that follows them."""

    def __init__(self, a_size: int, b_size: int):
        names = [f"{i}{m}".encode() for m in ",|" for i in range(a_size)]
        names += [f"{i}{m}".encode() for m in ",;" for i in range(b_size)]
        self.a_size, self.b_size = a_size, b_size
        self.lengths = np.array([len(x) for x in names], np.int64)
        self.cells = np.array(names, f"S{self.lengths.max()}").view(np.uint8).reshape(len(names), -1)

    def said(self, a_ids, b_ids, a_cuts, b_cuts) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All groups as one text `a,a|b;a|b;`, the lengths of its parts, and places of tokens of b."""
        a_sizes, b_sizes = np.diff(np.r_[-1, a_cuts]), np.diff(np.r_[-1, b_cuts])
        code_a, code_b = a_ids.copy(), b_ids + 2 * self.a_size
        code_a[a_cuts] += self.a_size
        code_b[b_cuts] += self.b_size
        codes = np.empty(len(a_ids) + len(b_ids), np.int64)
        place_a = np.arange(len(a_ids)) + np.repeat(np.r_[0, b_cuts[:-1] + 1], a_sizes)
        place_b = np.arange(len(b_ids)) + np.repeat(a_cuts + 1, b_sizes)
        codes[place_a], codes[place_b] = code_a, code_b
        lengths = self.lengths[codes]
        chosen = np.arange(self.cells.shape[1]) < lengths[:, None]
        return self.cells[codes][chosen].tobytes(), lengths, place_b


@lru_cache(maxsize=2)
def decimals(a_size: int, b_size: int) -> Decimals:
    return Decimals(a_size, b_size)


LINKS = "chunk long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
CHUNKS = "kind int, " + LINKS + ", pairs array<long>, held array<int>"
FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def _align(texts: list[bytes], a: Tokens, b: Tokens):
    """Per text its figures, its hash and its links; and the distinct pairs of all with their counts."""
    figures = np.zeros((len(texts), 4), np.int64)
    hashes, links = [""] * len(texts), [b""] * len(texts)
    which, a_rows, b_rows = [], [], []
    for row, raw in enumerate(texts):
        if not raw:
            continue
        text, spaced = raw.decode(), b" " + raw
        first = a.ids(text, spaced)
        second = b.ids(text, spaced) if first is not None else None
        if second is not None:
            which.append(row)
            a_rows.append(first)
            b_rows.append(second)
    if not which:
        return figures, hashes, links, np.zeros(0, np.int64), np.zeros(0, np.int32)
    a_ids, b_ids = np.concatenate(a_rows), np.concatenate(b_rows)
    a_ends, b_ends = np.cumsum(a.sizes[a_ids]), np.cumsum(b.sizes[b_ids])
    a_cuts, b_cuts = shared_cuts(a_ends, b_ends)
    a_last = np.cumsum([len(x) for x in a_rows])
    b_last = np.cumsum([len(x) for x in b_rows])
    groups = np.searchsorted(a_cuts, a_last)
    in_a, in_b = linked(a_ends, b_ends, a_cuts, b_cuts)
    link_last = np.searchsorted(in_a, a_last)
    pairs = (a_ids[in_a] << SHIFT) | b_ids[in_b]
    figures[which] = np.stack([np.diff(np.r_[0, x]) for x in (a_last, b_last, groups, link_last)], axis=1)
    said, lengths, place_b = decimals(len(a.entries), len(b.entries)).said(a_ids, b_ids, a_cuts, b_cuts)
    bytes_last = np.cumsum(lengths)[place_b[b_last - 1]]
    known, places = np.unique(pairs, return_inverse=True)
    counts = np.zeros(len(known), np.int32)
    for row, x, y, s, t in zip(
        which, np.r_[0, link_last[:-1]], link_last, np.r_[0, bytes_last[:-1]], bytes_last, strict=True
    ):
        hashes[row] = hashlib.sha256(said[s : t - 1]).hexdigest()
        here, times = np.unique(places[x:y], return_counts=True)
        counts[here] += 1
        links[row] = np.stack([here, times]).astype("<u4").tobytes()
    return figures, hashes, links, known, counts


def chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of documents (kind 0) and of their chunks (kind 1).

    A document has its figures, hash and links, the latter as places in the pairs of its
    chunk with their numbers; a chunk has its distinct pairs and the documents holding each.
    """

    a_name, b_name = vocabulary(docs, a_path), vocabulary(docs, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_tokens(SparkFiles.get(a_name)), piece_tokens(SparkFiles.get(b_name))
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for low, high in steps(offsets, CHUNK_BYTES):
                texts = [data[s:t].tobytes() for s, t in zip(offsets[low:high], offsets[low + 1 : high + 1], strict=True)]
                figures, hashes, links, known, counts = _align(texts, a, b)
                n = high - low
                columns = {
                    "kind": pa.array([0] * n + [1], pa.int32()),
                    "chunk": pa.array([chunk] * (n + 1), pa.int64()),
                    "row": pa.array([*range(n), None], pa.int32()),
                    "doc_id": pa.array([*batch.column(0)[low:high].to_pylist(), None], pa.int64()),
                }
                for i, name in enumerate(FIGURES):
                    columns[name] = pa.array([*figures[:, i].tolist(), None], pa.int64())
                columns["groups_sha256"] = pa.array([*hashes, None], pa.string())
                columns["links"] = pa.array([*links, None], pa.binary())
                ends = pa.array([*[0] * (n + 1), len(known)], pa.int32())
                columns["pairs"] = pa.ListArray.from_arrays(ends, pa.array(known, pa.int64()))
                columns["held"] = pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                chunk += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return map_arrow(rows, run, CHUNKS)


def pair_counts(held: DataFrame) -> DataFrame:
    """a, b, count (documents linking the ids), best (the highest count of a): from `chunks`."""
    pairs = held.filter("kind = 1").select(F.explode(F.arrays_zip("pairs", "held")).alias("x"))
    counts = pairs.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum(F.col("x.held").cast("long")).alias("count"))
    a, b = F.shiftright("pair", SHIFT), F.col("pair").bitwiseAND((1 << SHIFT) - 1)
    # An id of one tokenizer meets at most the vocabulary of the other.
    best = F.max("count").over(Window.partitionBy("a"))
    return counts.select("pair", a.alias("a"), b.alias("b"), "count").withColumn("best", best)


SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _scored(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of each document of one chunk; `counts` has one row per pair of the chunk."""
    place = counts["place"].to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place] = counts["count"].to_numpy()
    best[place] = counts["best"].to_numpy()
    most, total = [], []
    for link in rows["links"]:
        here, times = np.frombuffer(link.as_py(), "<u4").astype(np.int64).reshape(2, -1)
        most.append(int(times[count[here] == best[here]].sum()))
        total.append(int((times * count[here]).sum()))
    columns = {x: rows[x] for x in ["doc_id", *FIGURES]}
    columns |= {"n_best": pa.array(most, pa.int64()), "count_sum": pa.array(total, pa.int64())}
    return pa.table(columns | {"groups_sha256": rows["groups_sha256"]})


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of `docs` its numbers of tokens, groups and links, and sums over its links.

    doc_id, n_a, n_b, n_groups, n_links; n_best (links whose count is the highest of their
    first id in the corpus), count_sum (counts over all links), groups_sha256. A null or
    empty text, and one that a tokenizer does not give back byte for byte, has zeros and ''.
    Repeated rows count one by one; null ids stay null. No documents give no rows.
    """
    held = stored(chunks(docs, a_path, b_path), "aligned", parts="kind")
    counts = pair_counts(held).select("pair", "count", "best")
    mine = held.filter("kind = 1").select(F.col("chunk").alias("of_chunk"), F.posexplode("pairs").alias("place", "pair"))
    mine = mine.join(counts, "pair").select("of_chunk", "place", "count", "best")
    rows = held.filter("kind = 0").select("chunk", "doc_id", *FIGURES, "groups_sha256", "links")
    without = rows.filter("n_links = 0").select(
        "doc_id", *FIGURES, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"), "groups_sha256"
    )
    parts = partitions_for(docs)
    full = rows.filter("n_links > 0").repartition(parts, "chunk").groupBy("chunk")
    scored = full.cogroup(mine.repartition(parts, "of_chunk").groupBy("of_chunk")).applyInArrow(
        _scored, SCORED
    )
    return scored.unionByName(without)
