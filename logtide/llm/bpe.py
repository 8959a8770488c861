"""Byte-pair encoding and decoding of whole texts.

The encoder goes from left to right. An Aho-Corasick automaton over the vocabulary
gives the longest token at every place of a piece; a token is taken if it is
compatible with the one before it, else shorter prefixes are tried and, if none
remains, the last token is taken back. Places found to be dead ends are marked, so
each is visited once and the work is linear. Two neighbours are compatible when no
merge across their border comes before the merges that made them; the answers are
kept in a table. The result is that of applying all merges in order of rank.

Decoding looks ids up in a table of offsets into one string of all token bytes.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.shared import column_bytes, plain_batch, steps, whole_text

#: How this family of vocabularies cuts texts into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Where white space on both sides of a space takes part in one run.
RUNS = regex.compile(r"\s (?:\s|\Z)")
#: Entries of the tables that a worker keeps; a full table is emptied, never the result changed.
KEPT = 400_000


def _byte_letters() -> dict[str, int]:
    """Letter to byte: printable bytes stand for themselves, others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Kept(dict):
    """A table that fills itself and starts anew when it is full."""

    def __init__(self, make, most: int = KEPT):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Vocabulary:
    """The tokens of a byte-level vocabulary file in JSON, and decoding with them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = _byte_letters()
        vocab = {name: number for name, number in model["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        raw = {
            number: bytes(letters[c] for c in name)
            for name, number in vocab.items()
            if name not in self.special
        }
        size = max([*raw, *self.special.values()]) + 1
        pieces = [raw.get(i, b"") for i in range(size)]
        for name, number in self.special.items():
            pieces[number] = name.encode()
        self.token_bytes = pieces
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)
        self.ordinary = raw
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._learn(model["model"]["merges"], vocab, raw)

    def _learn(self, merges: list, vocab: dict[str, int], raw: dict[int, bytes]) -> None:
        """Merges matter to the encoder only."""

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after the other."""
        starts = self.offsets[ids]
        lengths = self.offsets[ids + 1] - starts
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.blob[np.repeat(starts - ends + lengths, lengths) + np.arange(total)]

    def decode_offsets(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where the texts of the id runs between `bounds` start and end in those bytes."""
        lengths = self.offsets[ids + 1] - self.offsets[ids]
        return np.concatenate([[0], np.cumsum(lengths)])[bounds]

class Codec(Vocabulary):
    """Encoder and decoder of a byte-level vocabulary file in JSON."""

    def __init__(self, path: str):
        super().__init__(path)
        self.pattern = regex.compile(PIECES)
        self.piece_ids = Kept(self._encode_piece)
        self.inner = Kept(lambda part: self._pieces(" " + part))

    def _learn(self, merges: list, vocab: dict[str, int], raw: dict[int, bytes]) -> None:
        """Merges by pair, the parts and rank of each token, its longest proper prefix."""
        self.rank = {number: -1 for number, text in raw.items() if len(text) == 1}
        self.parts = {number: (number, number) for number in self.rank}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(merges):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            one, two, both = vocab[left], vocab[right], vocab[left + right]
            self.merged[one, two] = rank
            if both not in self.rank:
                self.rank[both], self.parts[both] = rank, (one, two)
        known = {raw[number]: number for number in self.rank}
        self.automaton = ahocorasick.Automaton()
        self.shorter: dict[int, int | None] = {}
        self.known = {text.decode("latin-1"): number for text, number in known.items()}
        for text, number in known.items():
            self.automaton.add_word(text.decode("latin-1"), number)
            cuts = (known.get(text[:n]) for n in range(len(text) - 1, 0, -1))
            self.shorter[number] = next((x for x in cuts if x is not None), None)
        self.automaton.make_automaton()
        self.most = max(map(len, known))
        self.fits = Kept(self._compatible)

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Whether merging the bytes of both tokens together leaves this border.

        The tokens are taken apart backwards, always the one merged last. If a merge
        across the border has a lower rank than the merge undone there, it came first.
        """
        left, right = pair
        rank, merged, parts = self.rank, self.merged, self.parts
        # Of merges with equal rank the leftmost comes first, so an equal rank wins on
        # the right side only: there the border lies before the merge.
        limit = (len(merged), 1)
        while True:
            across = merged.get((left, right))
            if across is not None and (across, 0) < limit:
                return False
            one, two = rank[left], rank[right]
            if one < 0 and two < 0:
                return True
            if one > two:
                limit, left = (one, 0), parts[left][1]
            else:
                limit, right = (two, 1), parts[right][0]

    def _encode_piece(self, piece: str) -> bytes:
        text = piece.encode().decode("latin-1")
        size = len(text)
        whole = self.known.get(text)
        if whole is not None:
            return array("I", [whole]).tobytes()
        out: list[int] = []
        lengths, shorter, fits, longest = self.token_bytes, self.shorter, self.fits, self._longest
        alive = bytearray(b"\1") * (size + 1)
        at, token = 0, longest(text, 0)
        while at < size:
            last = out[-1] if out else None
            while True:
                end = at + len(lengths[token])
                if alive[end] and (last is None or fits[last, token]):
                    out.append(token)
                    at = end
                    if at < size:
                        token = longest(text, at)
                    break
                token = shorter[token]
                if token is None:
                    # No token leads on from here: mark the place, take the last one back.
                    alive[at] = 0
                    token = out.pop()
                    at -= len(lengths[token])
                    break
        return array("I", out).tobytes()

    def _longest(self, text: str, at: int) -> int:
        """The longest token at a place: a walk down the automaton, then back to a token."""
        rest = text[at : at + self.most]
        known, length = self.known, self.automaton.longest_prefix(rest)
        while True:
            token = known.get(rest[:length])
            if token is not None:
                return token
            length -= 1

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self.piece_ids.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a text as unsigned 32-bit numbers, lowest byte first."""
        if self.cut is None or not any(name in text for name in self.special):
            return self._ordinary(text)
        found = [
            array("I", [self.special[part]]).tobytes() if part in self.special else self._ordinary(part)
            for part in self.cut.split(text)
        ]
        return b"".join(found)

    def _ordinary(self, text: str) -> bytes:
        # A space starts a piece, so what stands between single spaces is encoded for
        # itself and looked up whole; runs of white space need the pattern.
        if RUNS.search(text):
            return self._pieces(text)
        first, *rest = text.split(" ")
        return self._pieces(first) + b"".join(map(self.inner.__getitem__, rest))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec a worker process; it lives as long as the process."""
    return Codec(path)


def vocabulary(table: DataFrame, path: str) -> str:
    """Send the vocabulary file to all executors; returns the name it has there."""
    name = path.rsplit("/", 1)[-1]
    sent = [x.rsplit("/", 1)[-1] for x in table.sparkSession.sparkContext.listFiles]
    if name not in sent:
        table.sparkSession.sparkContext.addFile(path)
    return name


def encode(docs: DataFrame, path: str, text: str = "text", end_id: int | None = None) -> DataFrame:
    """`doc_id` and `ids`: the tokens of every whole text as packed 32-bit numbers.

    `path` is a byte-level vocabulary in JSON. A null text is empty; an empty text has
    no tokens but `end_id`, if that is given. Rows are kept one by one, with null or
    repeated ids and in any order; other columns do not matter.
    """
    name = vocabulary(docs, path)
    tail = b"" if end_id is None else array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(SparkFiles.get(name))
        for batch in batches:
            _, offsets = column_bytes(batch.column(1))
            for first, last in steps(offsets):
                texts = batch.column(1).slice(first, last - first).to_pylist()
                ids = [coder.encode(x) + tail for x in texts]
                yield plain_batch(
                    {"doc_id": batch.column(0).slice(first, last - first), "ids": pa.array(ids, pa.binary())}
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `ids` and the `text` those ids stand for, special tokens included.

    Null ids give an empty text, bytes that are no UTF-8 the replacement character. An
    id outside the vocabulary raises.
    """
    name = vocabulary(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(SparkFiles.get(name))
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for first, last in steps(offsets):
                part = data[offsets[first] : offsets[last]]
                ids = np.frombuffer(part.tobytes(), "<u4").astype(np.int64)
                bounds = (offsets[first : last + 1] - offsets[first]) // 4
                found = coder.decode_bytes(ids).tobytes()
                places = coder.decode_offsets(ids, bounds).tolist()
                texts = [
                    found[a:b].decode("utf-8", "replace") for a, b in zip(places, places[1:], strict=False)
                ]
                yield plain_batch(
                    {
                        "doc_id": batch.column(0).slice(first, last - first),
                        "ids": batch.column(1).slice(first, last - first),
                        "text": pa.array(texts, pa.string()),
                    }
                )

    rows = encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids binary, text string")
