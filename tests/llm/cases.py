"""Small documents with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

import xxhash

#: Columns beside those of documents, named like ones the operators use inside.
EXTRA = ["hash", "md5", "first", "tie", "ids", "row", "group", "n", "key", "kept", "path", "held"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{name}` string" for name in EXTRA
)
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sentence(rng: random.Random, words: int, letters: str = "abcdefgh") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(words))


def texts(seed: int = 7) -> list[tuple[int | None, str | None]]:
    """(doc_id, text) pairs."""
    rng = random.Random(seed)
    passage, near = sentence(rng, 60), sentence(rng, 300)
    changed = near.split(" ")
    changed[150] = "zzz"
    found: list[tuple[int | None, str | None]] = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one"),
        (5, f"{sentence(rng, 40)} {passage} {sentence(rng, 30)}"),
        (6, f"{passage}\n{sentence(rng, 50)}"),
        (7, near),
        (8, " ".join(changed)),
        (9, near),
        (10, near),
        (10, near),
        (11, "naïve 日本語 　 😀 <|endoftext|> it's 12³ " * 4),
        (12, "same again " * 200),
        (13, "x" * 3000),
        (14, sentence(rng, 6000)),
        (15, f"head {passage} tail {passage}"),
        (None, sentence(rng, 30)),
        (None, passage),
        (16, "#*$%&|<> " * 20 + sentence(rng, 30)),
        (17, "line one here\nline two here\nline one here\n\n" * 3),
        (18, "x" * 3000),
    ]
    found += [(100 + i, sentence(rng, rng.randint(10, 80))) for i in range(30)]
    return found


def frame(spark, rows: list[tuple[int | None, str | None]] | None = None):
    rows = texts() if rows is None else rows
    langs, sources = ["en", "fr", None, ""], ["a", "b", None]
    data = [
        (i, t, langs[n % 4], sources[n % 3], None if t is None else len(t), *["clash"] * len(EXTRA))
        for n, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def simhash(text: str | None) -> int:
    words = words_of((text or "").translate(LOWER))
    if not words:
        return 0
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[int]) -> list[int]:
    """For each fingerprint the first place of its component."""
    root = list(range(len(prints)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def without_repeats(docs: list[tuple[int, str | None]], window: int = 20) -> dict[int, tuple[int, str]]:
    """doc_id to (words removed, kept words); ids are all known and differ."""
    seen: set[tuple[str, ...]] = set()
    out = {}
    for number, text in sorted(docs, key=lambda d: d[0]):
        words, gone = words_of(text), set()
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in seen:
                gone.update(range(p, p + window))
            seen.add(key)
        out[number] = (len(gone), " ".join(w for p, w in enumerate(words) if p not in gone))
    return out


def without_strings(docs: list[tuple[int, str | None]], window: int = 50) -> dict[int, tuple[int, int, bytes]]:
    """doc_id to (bytes removed, runs, kept bytes); ids are all known and differ."""
    first: dict[bytes, int] = {}
    raw = {number: (text or "").encode() for number, text in docs}
    for number in sorted(raw):
        for p in range(len(raw[number]) - window + 1):
            first.setdefault(raw[number][p : p + window], number)
    out = {}
    for number, data in raw.items():
        gone = [False] * len(data)
        for p in range(len(data) - window + 1):
            if first[data[p : p + window]] < number:
                gone[p : p + window] = [True] * window
        runs = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out[number] = (sum(gone), runs, bytes(b for b, g in zip(data, gone, strict=True) if not g))
    return out


def known(rows: list[tuple[int | None, str | None]]) -> list[tuple[int, str | None]]:
    """Rows whose id is known and differs from those before."""
    return [(i, t) for i, t in dict(rows).items() if i is not None]
