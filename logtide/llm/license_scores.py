"""Licence templates as sparse TF-IDF vectors, and what a text must have to resemble one.

Only the fixed list of templates is looked at here, on the driver; texts are compared with
them by joins and sums of rows (`licenses`).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np

from logtide.llm.seeds import word_hashes

TAG = re.compile(rb"(?i)SPDX-License-Identifier:[\x20\t]*\(?")
TAG_START = b"spdx-license-identifier-"

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_PLAIN = ((_BYTES >= 97) & (_BYTES <= 122)) | ((_BYTES >= 48) & (_BYTES <= 57))
_JOINS = (_BYTES == ord(".")) | (_BYTES == ord("-"))


def term_bounds(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of `[a-z0-9]+([.-][a-z0-9]+)*` in lowered bytes."""
    plain = _PLAIN[low]
    inside = plain.copy()
    inside[1:-1] |= _JOINS[low][1:-1] & plain[:-2] & plain[2:]
    return _runs(inside)


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    return edges[::2], edges[1::2]


class Lexicon:
    """Templates as sparse vectors over their terms; as large as their fixed list."""

    def __init__(self, templates: Sequence[tuple[str, str]], common: Sequence[str], tags: bool):
        self.licenses, self.damp, self.tags = [x for x, _ in templates], tags, tags
        counts, names = [], {}
        for _, text in templates:
            raw = TAG.sub(TAG_START, text.encode()) if tags else text.encode()
            low = _LOWER[np.frombuffer(raw, np.uint8)]
            starts, ends = term_bounds(low)
            hashes = word_hashes(low, starts, ends)
            counts.append(Counter(hashes.tolist()))
            names.update(
                {int(h): bytes(low[a:b]).decode() for h, a, b in zip(hashes, starts, ends, strict=True)}
            )
        self.sizes = np.array([sum(x.values()) for x in counts], np.int64)
        self.hashes = np.array(sorted(names), np.uint64)
        place = {int(h): i for i, h in enumerate(self.hashes)}
        held = Counter(h for x in counts for h in x)
        size = len(templates)
        self.rare = math.log(1.0 + size) + 1.0
        self.idf = np.array([math.log((1.0 + size) / (1.0 + held[int(h)])) + 1.0 for h in self.hashes])
        self.weights = np.zeros((size, len(self.hashes)))
        for row, found in enumerate(counts):
            for h, n in found.items():
                self.weights[row, place[h]] = (math.log(n) + 1.0 if tags else n) * self.idf[place[h]]
        self.norms = np.sqrt((self.weights**2).sum(axis=1))
        self.names, self.common = [names[int(h)] for h in self.hashes], set(common)

    def anchors(
        self, threshold: float, spent: float, often: Mapping[str, int] | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(parts, least): of a template's terms a part of `least` must be in whatever resembles it.

        A cosine is at most the root of the share of a template's squared weight that its
        shared terms have. The most usual terms with under `spent` of the threshold's square
        are left out, by `often` (texts that have a term) if that is known. Nothing that
        reaches the threshold is lost, whatever terms are usual.
        """
        parts = (self.weights / self.norms[:, None]) ** 2
        # A little less, as sums of doubles are not exact.
        square = threshold**2 - 1e-6
        least = np.full(len(parts), square)
        often = often or {}

        def rank(i: int) -> tuple:
            name = self.names[i]
            return -often.get(name, 0), name not in self.common, self.idf[i], name

        usual = sorted(range(len(self.names)), key=rank)
        for row, part in enumerate(parts):
            summed = 0.0
            for i in usual:
                summed += part[i]
                if summed >= spent * square:
                    break
                least[row] -= part[i]
                part[i] = 0.0
        return parts, least


class Terms(NamedTuple):
    """Hashes of the terms of some texts, where they start, and the terms before each text."""

    hashes: np.ndarray
    starts: np.ndarray
    bounds: np.ndarray


def terms_of(data: np.ndarray, offsets: np.ndarray) -> Terms:
    low = _LOWER[data]
    starts, ends = term_bounds(low)
    return Terms(word_hashes(low, starts, ends), starts, np.searchsorted(starts, offsets))
