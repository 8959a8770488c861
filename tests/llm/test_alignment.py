"""Token alignment against plain loops over both tokenizers."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from cases import frame, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logtide.llm import alignment
from logtide.llm.bpe import _byte_letters

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A_MODEL = Tokenizer.from_file(A_PATH)
A_MODEL.encode_special_tokens = True
B_MODEL = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
LETTERS = _byte_letters()
A_BYTES = {i: bytes(LETTERS.get(c, 0) for c in t) for t, i in A_MODEL.get_vocab().items()}


def b_bytes(i):
    piece = B_MODEL.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B_MODEL.is_byte(i) else piece.replace("▁", " ").encode()


def aligned(text):
    """Groups and links of one text; None if it has no tokens."""
    if not text:
        return None
    a, b = A_MODEL.encode(" " + text, add_special_tokens=False).ids, B_MODEL.encode(text)
    spaced = (" " + text).encode()
    if b"".join(A_BYTES[i] for i in a) != spaced or b"".join(map(b_bytes, b)) != spaced:
        return None
    a_of = [n for n, i in enumerate(a) for _ in A_BYTES[i]]
    b_of = [n for n, i in enumerate(b) for _ in b_bytes(i)]
    links = sorted(set(zip(a_of, b_of, strict=True)))
    groups, first = [], (0, 0)
    for p in range(1, len(spaced) + 1):
        if p == len(spaced) or (a_of[p] != a_of[p - 1] and b_of[p] != b_of[p - 1]):
            last = (a_of[p - 1] + 1, b_of[p - 1] + 1)
            groups.append((a[first[0] : last[0]], b[first[1] : last[1]]))
            first = last
    return a, b, groups, [(a[i], b[j]) for i, j in links]


def expected(rows):
    every = [(i, aligned(t)) for i, t in rows]
    counts = Counter(p for _, x in every if x for p in set(x[3]))
    highest = Counter()
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    out = []
    for i, x in every:
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = x
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        best = sum(counts[p] == highest[p[0]] for p in links)
        out.append((i, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    return sorted((tuple(r) for r in alignment.align(frame(spark, rows), A_PATH, B_PATH).collect()), key=repr)


AWKWARD = [
    (700, "two  spaces\tand\ntabs ▁ piece"),
    (701, "<|endoftext|> <s> </s> <unk> <0x41>"),
    (702, "é ﬁ   ​ ½ ㎞"),
    (703, "x" * 5000),
    (704, "日本語のテキスト" * 50),
    (705, "😀👩‍👩‍👧 \U0001f1e9\U0001f1ea"),
    (706, "▁"),
    (707, " "),
    (707, " "),
]


def test_every_row_like_plain_loops(spark):
    rows = [*texts(), *AWKWARD]
    assert found(spark, rows) == expected(rows)


def test_small_chunks_change_nothing(spark, monkeypatch):
    rows = [*texts(), *AWKWARD] * 2
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 500)
    data = [(t or "").encode() for _, t in rows]
    a, b = alignment.byte_tokens(A_PATH), alignment.piece_tokens(B_PATH)
    whole = alignment._align(data, a, b)
    single = [alignment._align([x], a, b) for x in data]
    assert whole[0].tolist() == [s[0][0].tolist() for s in single]
    assert whole[1] == [s[1][0] for s in single]
    assert found(spark, rows) == expected(rows)


def test_empty_and_tokenless_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, ""), (None, "")]) == expected([(1, None), (2, ""), (None, "")])


ends = st.sets(st.integers(1, 300), max_size=200)


@settings(max_examples=300, deadline=None)
@given(ends, ends)
def test_cuts_are_the_common_ends(a, b):
    a, b = np.array(sorted(a | {301})), np.array(sorted(b | {301}))
    a_cuts, b_cuts = alignment.shared_cuts(a, b)
    common = sorted(set(a.tolist()) & set(b.tolist()))
    assert a[a_cuts].tolist() == b[b_cuts].tolist() == common
    in_a, in_b = alignment.linked(a, b, a_cuts, b_cuts)
    a_from, b_from = np.r_[0, a[:-1]], np.r_[0, b[:-1]]
    pairs = [(i, j) for i in range(len(a)) for j in range(len(b)) if a_from[i] < b[j] and b_from[j] < a[i]]
    assert list(zip(in_a.tolist(), in_b.tolist(), strict=True)) == pairs


def test_few_cuts_at_one_edge_stay_cheap():
    rng = random.Random(8)
    a = np.array(sorted({*range(1, 2000), *rng.sample(range(2001, 400_001, 2), 150_000), 400_002}))
    b = np.array(sorted({*range(1, 2000), *rng.sample(range(2002, 400_001, 2), 150_000), 400_002}))
    a_cuts, _ = alignment.shared_cuts(a, b)
    assert a[a_cuts].tolist() == np.intersect1d(a, b).tolist()
