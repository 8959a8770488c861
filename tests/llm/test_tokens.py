"""Encoding, decoding, token files and packing."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import frame, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logtide.llm import bpe, packing, token_orc
from logtide.llm.quick_tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture
def library():
    return LIBRARY


def ids_of(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_encodes_like_the_library(text):
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids_of(bpe.codec(PATH).encode(text)) == ids_of(encoder(PATH)(text)) == expected


def test_spaces_and_special_tokens(library):
    rng = random.Random(3)
    own, quick = bpe.codec(PATH), encoder(PATH)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "'s", " ", "  ", "\n", "\t", "é", "1", "<|endoftext|>", "."]) for _ in range(15))
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids_of(own.encode(text)) == ids_of(quick(text)) == expected


def test_full_tables_change_nothing(library):
    own = bpe.Codec(PATH)
    own.inner.most = own.piece_ids.most = own.fits.most = 2
    text = texts()[4][1]
    assert ids_of(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_round_trip_of_every_row(spark, library):
    rows = texts()
    docs = frame(spark)
    found = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in found))) == sorted(repr((i, t or "")) for i, t in rows)
    expected = {t or "": library.encode(t or "", add_special_tokens=False).ids for _, t in rows}
    assert all(ids_of(bytes(r.ids)) == expected[r.text] for r in found)


def test_decoding_nulls_and_broken_bytes(spark, library):
    half = ids_of(bpe.codec(PATH).encode("😀"))[:1]
    packed = np.array(half, "<u4").tobytes()
    table = spark.createDataFrame([(1, None), (2, packed)], "doc_id long, ids binary")
    found = {r.doc_id: r.text for r in bpe.decode(table, PATH).collect()}
    assert found == {1: "", 2: library.decode(half, skip_special_tokens=False)}


def test_empty_table(spark):
    none = frame(spark, [])
    assert bpe.decode(bpe.encode(none, PATH), PATH).count() == 0
    assert packing.pack(packing.token_pieces(none, PATH)).count() == 0


def test_token_files(spark, library, tmp_path):
    rows = sorted(texts(), key=lambda r: (r[0] is not None, r[0]))
    out = str(tmp_path / "tokens")
    token_orc.write_tokens(frame(spark), PATH, out, parts=3)
    read = token_orc.read_tokens(spark, out)
    assert read.filter("size(ids) <> n_tokens").count() == 0
    found = sorted(token_orc.checksums(read).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [i for i, _ in rows]
    assert [r.start for r in found] == [sum(x.n_tokens for x in found[:n]) for n in range(len(found))]
    sums = {}
    for number, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        sums.setdefault(number, set()).add((len(ids), zlib.crc32(ids.tobytes())))
    assert all((r.n_tokens, r.ids_crc32) in sums[r.doc_id] for r in found)
    some = token_orc.read_tokens(spark, out, [5, 14])
    assert sorted(r.doc_id for r in some.collect()) == [5, 14]
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()


def test_no_documents_give_empty_files(spark, tmp_path):
    token_orc.write_tokens(frame(spark, []), PATH, str(tmp_path / "none"))
    assert token_orc.checksums(token_orc.read_tokens(spark, str(tmp_path / "none"))).count() == 0


def test_pieces_are_packed_without_gaps(spark, library):
    rows = texts()
    capacity = 64
    placed = packing.pack(packing.token_pieces(frame(spark), PATH, capacity), capacity).collect()
    sizes = [len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows]
    assert sum(r.length for r in placed) == sum(sizes)
    assert len(placed) == sum(-(-n // capacity) for n in sizes)
    by_sequence = {}
    for r in placed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    long = sorted((r for r in placed if r.doc_id == 14), key=lambda r: r.piece)
    assert [r.length for r in long[1:]] == [capacity] * (len(long) - 1)
    assert [r.start for r in long] == [sum(x.length for x in long[:n]) for n in range(len(long))]


def test_other_columns_go_along(spark):
    rows = spark.createDataFrame([(i % 7 + 1, "x") for i in range(50)], "length long, `hash` string")
    found = packing.pack(rows, 8)
    assert found.columns == ["length", "hash", "sequence_id", "offset"] and found.count() == 50


def fewest(lengths: list[int], capacity: int) -> int:
    """The least number of sequences, by search."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(n: int, rooms: list[int]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if n == len(lengths):
            best = len(rooms)
            return
        for i, room in enumerate(rooms):
            if room >= lengths[n] and room not in rooms[:i]:
                place(n + 1, rooms[:i] + [room - lengths[n]] + rooms[i + 1 :])
        place(n + 1, [*rooms, capacity - lengths[n]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_fixed_sets_are_part_of_a_best_packing(lengths):
    counts = {x: lengths.count(x) for x in lengths}
    left = dict(counts)
    fixed = packing.reduce_dominated(left, 20)
    rest = [x for x, n in left.items() for _ in range(n)]
    assert all(sum(chosen) <= 20 for chosen, _ in fixed)
    assert sum(times for _, times in fixed) + (fewest(rest, 20) if rest else 0) == fewest(lengths, 20)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 50), min_size=1, max_size=12))
def test_plan_places_every_piece_once(counts):
    steps, sequences = packing.plan(dict(counts), 30)
    used = {}
    ranks = {x: [] for x in counts}
    for s in steps:
        for past in range(s.count):
            ranks[s.length].append(s.first + past)
            at = s.offset + past % s.each * s.length
            used.setdefault(s.sequence + past // s.each, []).append((at, at + s.length))
    assert all(sorted(r) == list(range(counts[x])) for x, r in ranks.items())
    assert sorted(used) == list(range(sequences))
    for spans in used.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 30
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    total = sum(x * n for x, n in counts.items())
    assert sequences >= -(-total // 30)
