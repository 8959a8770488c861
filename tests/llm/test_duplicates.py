"""Exact and near duplicates and repeated passages, against brute force."""

import random

import numpy as np
import pytest
from cases import components, frame, known, sentence, simhash, texts, without_repeats, without_strings, words_of
from pyspark.sql import functions as F

from logtide.llm import components as graph
from logtide.llm import exact, packing, seeds, simhash as near, substring_tree, suffix_array

PASSAGE = sentence(random.Random(12), 60)


@pytest.mark.parametrize("digits", [32, 1])
def test_exact_groups(spark, digits):
    """With a hash of one digit nearly all groups collide; the result is the same."""
    rows = texts()
    found = exact.exact_groups(frame(spark), F.substring(F.md5("text"), 1, digits)).collect()
    assert len(found) == len(rows)
    groups = {}
    for number, text in rows:
        groups.setdefault(text or "", []).append(number)
    expected = []
    for number, text in rows:
        same = groups[text or ""]
        keep = max((x for x in same if x is not None), default=None)
        expected.append((number, keep, len(same), number == keep))
    assert sorted(map(repr, expected)) == sorted(
        repr((r.doc_id, r.keep_id, r.group_size, r.kept)) for r in found
    )


def test_exact_groups_of_nothing(spark):
    assert exact.exact_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("chunk", [2048, 2])
def test_near_groups(spark, monkeypatch, chunk):
    """Small chunks make every shard search trees of other chunks."""
    monkeypatch.setattr(near, "CHUNK", chunk)
    rng = random.Random(5)
    rows = texts() + [(500 + i, rng.choice(["a b", "a c", "b d e", "c"])) for i in range(40)]
    found = near.near_groups(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    prints = [simhash(t) for _, t in rows]
    roots = components(prints)
    least = {}
    for root, (number, _) in zip(roots, rows, strict=True):
        if number is not None:
            least[root] = min(number, least.get(root, number))
    expected = [(i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, roots, strict=True)]
    assert sorted(map(repr, expected)) == sorted(repr((r.doc_id, r.fingerprint, r.component_id)) for r in found)


def test_near_groups_of_nothing(spark):
    assert near.near_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("flips", [0, 1, 2, 3, 4, 5])
def test_links_at_every_distance(spark, flips):
    rng = random.Random(flips)
    pairs = []
    for _ in range(40):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), flips):
            b ^= 1 << bit
        pairs.append((a, b))
    values = [np.uint64(x).astype(np.int64).item() for pair in pairs for x in pair]
    links = near.near_links(spark.createDataFrame([(x,) for x in set(values)], "fp long")).collect()
    found = {frozenset((r.a, r.b)) for r in links}
    wanted = {frozenset(values[i : i + 2]) for i in range(0, len(values), 2)} if 0 < flips <= 4 else set()
    assert found == wanted


def test_tree_finds_what_is_near():
    rng = random.Random(1)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = near.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:40]:
        assert sorted(tree.within(q, 3)) == sorted({v for v in values if (v ^ q).bit_count() <= 3})


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000)]
    nodes = sorted({x for e in edges for x in e} | {7000})
    found = graph.connected(
        spark.createDataFrame(edges, "a long, b long"),
        spark.createDataFrame([(n, n if n != 1000 else None) for n in nodes], "node long, label long"),
    )
    got = {r.node: r.label for r in found.collect()}
    assert got == {n: 0 if n <= 60 else 1001 if n < 5000 else n for n in nodes}


@pytest.mark.parametrize("group", [50_000, 3])
def test_words_left(spark, monkeypatch, group):
    """Groups of three suffixes lengthen prefixes and deal out passages."""
    monkeypatch.setattr(substring_tree, "GROUP", group)
    rows = known(texts())
    rows += [(600 + i, rows[4][1]) for i in range(5)] + [(700 + i, "w " * (10 + 5 * i)) for i in range(6)]
    found = {r.doc_id: r for r in substring_tree.remove_repeats(frame(spark, rows)).collect()}
    expected = without_repeats(rows)
    assert len(found) == len(rows)
    for number, text in rows:
        removed, kept = expected[number]
        assert (found[number].n_words, found[number].n_removed) == (len(words_of(text)), removed), number
        assert found[number].kept_text == kept


def test_rows_without_ids_come_last(spark):
    rows = texts()
    found = substring_tree.remove_repeats(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    gone = [r.n_removed for r in found if r.doc_id is None]
    assert sorted(gone) == [0, 60]
    twice = [r.n_removed for r in found if r.doc_id == 10]
    assert twice == [300, 300]
    cut = suffix_array.remove_repeats(frame(spark, rows)).collect()
    assert len(cut) == len(rows)
    passage = dict(rows)[6].split("\n")[0]
    assert sorted(r.n_removed for r in cut if r.doc_id is None)[1] == len(passage)


def test_repeated_rows_do_not_remove_themselves(spark):
    rng = random.Random(2)
    text = " ".join(str(rng.random()) for _ in range(60))
    docs = frame(spark, [(4, text), (4, text)])
    assert [r.n_removed for r in substring_tree.remove_repeats(docs).collect()] == [0, 0]
    assert [r.n_removed for r in suffix_array.remove_repeats(docs).collect()] == [0, 0]


@pytest.mark.parametrize("group", [20_000, 2])
def test_bytes_left(spark, monkeypatch, group):
    """Groups of two suffixes replace every common seed by longer ones."""
    monkeypatch.setattr(suffix_array, "GROUP", group)
    rng = random.Random(9)
    rows = known(texts())
    long = "".join(rng.choice("abcé ") for _ in range(400))
    for i in range(25):
        a, b = sorted(rng.sample(range(400), 2))
        rows.append((800 + i, "".join(rng.choice("xyz") for _ in range(5)) + long[a:b] + str(i)))
    rows += [(900, "ab" * 60), (901, "b" + "ab" * 40), (902, "x" * 49), (903, "x" * 50)]
    found = {r.doc_id: r for r in suffix_array.remove_repeats(frame(spark, rows)).collect()}
    expected = without_strings(rows)
    assert len(found) == len(rows)
    for number, text in rows:
        removed, runs, kept = expected[number]
        r = found[number]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len((text or "").encode()), removed, runs), number
        assert bytes(r.kept_text) == kept


def test_repeats_of_nothing(spark):
    assert substring_tree.remove_repeats(frame(spark, [])).count() == 0
    assert suffix_array.remove_repeats(frame(spark, [])).count() == 0
    blank = suffix_array.remove_repeats(frame(spark, [(1, None), (2, "")])).collect()
    assert [(r.n_bytes, r.n_removed, bytes(r.kept_text)) for r in blank] == [(0, 0, b"")] * 2


def test_merge_sort_orders_groups():
    rng = np.random.default_rng(4)
    groups = np.sort(rng.integers(0, 6, 200))
    rows = rng.integers(97, 99, (200, 9)).astype(np.uint8)
    lengths = rng.integers(0, 10, 200)
    rows[np.arange(9) >= lengths[:, None]] = 0
    order = suffix_array.merge_sort(suffix_array.HashedSuffixes(rows, lengths), groups)
    text = [(g, bytes(r[:n])) for g, r, n in zip(groups, rows, lengths, strict=True)]
    assert [text[i] for i in order] == sorted(text)


def test_equal_windows_share_a_seed():
    rng = np.random.default_rng(8)
    window, gram = 12, 4
    passage = rng.integers(0, 1 << 60, 40).astype(np.uint64)
    a = np.r_[rng.integers(0, 1 << 60, 33).astype(np.uint64), passage]
    b = np.r_[passage, rng.integers(0, 1 << 60, 21).astype(np.uint64)]
    of = [dict(zip(*map(np.ndarray.tolist, seeds.seed_places(x, np.array([0, len(x)]), gram, window)), strict=True)) for x in (a, b)]
    for p in range(len(passage) - window + 1):
        inside = [{(at - p - shift, h) for at, h in found.items() if 0 <= at - p - shift <= window - gram} for found, shift in zip(of, (33, 0), strict=True)]
        assert inside[0] & inside[1]


def test_rows_without_an_id_add_places_in_proportion(spark):
    """A thousand such rows have about as many places as rows with ids, and rows that share one id too."""
    rng = random.Random(11)
    said = [f"{sentence(rng, 15)} {PASSAGE} {sentence(rng, 10 + i % 7)}" for i in range(1000)]

    def places(ids):
        _, found = seeds.distinct_texts(frame(spark, list(zip(ids, said, strict=True))))
        some = seeds.repeated_seeds(found, "words", 8, 20)
        return some.select(F.sum(F.size("places")), F.max(F.size("places")), F.count(F.lit(1))).first()

    known = places(range(1000))
    for ids in ([None] * 1000, [7] * 1000):
        other = places(ids)
        assert other[0] == known[0] and other[1] == known[1] and other[2] == known[2] == 1000


def test_equal_rows_are_dealt_to_all_parts(spark):
    pieces = spark.range(3000).selectExpr("cast(null AS long) AS doc_id", "7 AS length")
    placed = packing.pack(pieces)
    assert placed.select("sequence_id", "offset").distinct().count() == 3000
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(4))
    sizes = [r["count"] for r in pieces.groupBy(part.alias("p")).count().collect()]
    assert max(sizes) < 2 * min(sizes) and len(sizes) == 4
