"""Licences, quality rules and language-model scores."""

import math
import textwrap
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from cases import LOWER, frame, known, texts, words_of

from logtide.llm import licenses, pitman_yor, quality, seeds


def counts_of(text):
    text = text or ""
    words = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def test_counts_and_base_rules(spark):
    rows = texts() + [(300, "a b c d e a b c d e"), (301, "a b c d e b c d e f"), (302, "a " * 9), (303, "q\n q\nq\n")]
    found = quality.judge(frame(spark, rows)).collect()
    expected = []
    for number, text in rows:
        c = counts_of(text)
        expected.append((number, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    got = [
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found
    ]
    assert sorted(map(repr, expected)) == sorted(map(repr, got))
    assert not any(r.kept and r.base_failed for r in found)


def test_thresholds_follow_the_group(spark):
    """What is usual in one source is rejected in another."""
    plain = "the house on the hill has a red door and many old windows today ".split()
    rows = [(i, f"{i} " + " ".join(plain[i % 5 :])) for i in range(300)]
    odd = " ".join(w + " ##" for w in plain)
    docs = frame(spark, []).unionByName(
        spark.createDataFrame(
            [(i, t, "en", "clean", 1) for i, t in rows]
            + [(1000 + i, f"{i} {odd}", "en", "code", 1) for i in range(200)]
            + [(5000, odd + " x", "en", "clean", 1)],
            "doc_id long, text string, lang string, source string, n_chars long",
        ),
        allowMissingColumns=True,
    )
    kept = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert not kept[5000]
    assert all(v for k, v in kept.items() if k != 5000)


def test_rules_for_nothing(spark):
    assert quality.judge(frame(spark, [])).count() == 0


def test_license_statements_and_inheritance(spark):
    files = [
        ("a/LICENSE", "Released under the MIT License. Permission is hereby granted, free of charge"),
        ("a/x.py", "code\ncode"),
        ("a/b/c/y.py", "Licensed under the Apache License, Version 2.0.\n" + "word " * 200),
        ("a/b/c/z.py", None),
        ("b/notes", "This work is licensed under the GNU General Public License, version 3."),
        ("b/sub/deep/file", ""),
        ("c/none", "nothing to say"),
        ("LICENSE.txt", "Licensed under CC BY-NC 4.0."),
        (None, "plain"),
        ("a/x.py", "code again"),
    ]
    table = spark.createDataFrame([(*f, "c") for f in files], "path string, text string, dir string")
    found = {r.path: r for r in licenses.scan(table).collect()}
    assert licenses.scan(table).count() == len(files)
    assert (found["a/x.py"].license, found["a/x.py"].license_dir) == ("MIT", "a")
    assert (found["a/b/c/y.py"].own_license, found["a/b/c/y.py"].license_dir) == ("Apache-2.0", None)
    assert (found["a/b/c/z.py"].license, found["a/b/c/z.py"].license_dir) == ("MIT", "a")
    assert found["b/sub/deep/file"].license == "GPL-3.0"
    assert (found["c/none"].license, found["c/none"].license_dir) == ("CC-BY-NC-4.0", "")
    assert found[""].license == "CC-BY-NC-4.0"
    assert licenses.scan(table.limit(0)).count() == 0


def test_licenses_in_blocks_windows_and_tags(spark):
    text = {}
    for name, block in licenses.BLOCKS:
        text.setdefault(name, block)
    wrap = {k: textwrap.fill(v, 60, initial_indent="# ", subsequent_indent="# ") for k, v in text.items()}
    code = "\nimport os\nvalue = compute(os.environ)\n" * 40
    long = "some words that say nothing of the matter at hand " * 4
    expected = {f"{k}/x.py": (v + code, k) for k, v in wrap.items()}
    expected |= {
        "tag/a.c": ("// SPDX-License-Identifier: MIT\n" + code, "MIT"),
        "tag/b.c": ("/* SPDX-License-Identifier: GPL-2.0-or-later */\n" + code, "GPL-2.0"),
        "tag/c.c": ("// SPDX-License-Identifier: Apache-2.0\n" + code, "Apache-2.0"),
        "tag/d.c": ("// SPDX-License-Identifier: Zlib\n" + code, None),
        "line/mit": (long + licenses.TEMPLATES["MIT"] + " " + long, "MIT"),
        "line/apache": (long + licenses.TEMPLATES["Apache-2.0"] + " " + long, "Apache-2.0"),
        "wrapped/a.py": ("# Released under the MIT\n# License\n" + code, "MIT"),
        "none/a.py": (code + long, None),
        "whole/LICENSE": ("Copyright 2020 A. Person\n\n" + textwrap.fill(text["BSD-3-Clause"], 70), "BSD-3-Clause"),
    }
    table = spark.createDataFrame([(k, v) for k, (v, _) in expected.items()] + [("whole/a/b.py", code)], "path string, text string")
    found = {r.path: r for r in licenses.scan(table).collect()}
    assert {k: found[k].own_license for k in expected} == {k: v for k, (_, v) in expected.items()}
    assert (found["whole/a/b.py"].license, found["whole/a/b.py"].license_dir) == ("BSD-3-Clause", "whole")


@pytest.fixture(scope="module")
def scored(spark):
    rows = known(texts()) + [(2000 + i, texts(i)[13][1]) for i in range(40)] + [(3000, "end"), (3001, "end")]
    return rows, {r.doc_id: r for r in pitman_yor.score(frame(spark, rows)).collect()}


def test_base_scores(scored):
    rows, found = scored
    tokens = {i: [*words_of((t or "").translate(LOWER)), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    count = Counter(w for i in tokens if not held[i] for w in tokens[i])
    total, types = sum(count.values()), len(count)
    assert len(found) == len(rows)
    for i, own in tokens.items():
        r = found[i]
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (types + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known) == (held[i], len(own), sum(count[w] > 0 for w in own))
        assert r.train_tokens == total and r.base_score == pytest.approx(base)


def test_model_predicts_better_than_the_base(scored):
    _, found = scored
    for held in (True, False):
        mine = [r for r in found.values() if r.held_out == held]
        assert sum(r.score for r in mine) > sum(r.base_score for r in mine)
    assert all(r.score < 0 for r in found.values())


def test_scores_are_the_same_again(spark, scored):
    rows, found = scored
    again = {r.doc_id: r.score for r in pitman_yor.score(frame(spark, rows).repartition(5)).collect()}
    assert all(again[i] == pytest.approx(r.score) for i, r in found.items())


def test_groups_grow_in_number_with_the_texts(spark, scored, monkeypatch):
    rows, found = scored
    few = pitman_yor.prepared(frame(spark, rows)).agg({"grp": "max"}).first()[0]
    monkeypatch.setattr(pitman_yor, "GROUP_BYTES", 10_000)
    table = pitman_yor.prepared(frame(spark, rows))
    assert table.agg({"grp": "max"}).first()[0] > few
    again = {r.doc_id: r for r in pitman_yor.score(frame(spark, rows)).collect()}
    assert again.keys() == found.keys()
    for doc_id, row in found.items():
        assert math.isclose(row.score, again[doc_id].score, rel_tol=1e-9)


def test_what_groups_ask_does_not_follow_the_shuffle_partitions(spark, scored):
    rows, found = scored
    docs, before = frame(spark, rows), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    try:
        table = pitman_yor.prepared(docs)
        assert table.groups < 97
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert table.groups == pitman_yor.prepared(docs).groups


def test_a_step_asks_a_bucket_once_for_all_groups():
    texts = pa.array([f"a b{i % 7} c{i} a b{i % 7}" for i in range(300)])
    batch = [pa.array(range(300)), pa.array([i % 3 == 0 for i in range(300)]), pa.array([i % 90 for i in range(300)], pa.int32())]
    asked = list(pitman_yor._asked(iter([pa.record_batch([*batch, texts], list("dhgt"))]), 5))
    assert sum(x.num_rows for x in asked) <= 2 * 5 + 1
    times, different = Counter(), Counter()
    for rows in asked:
        for r in rows.to_pylist():
            assert sum(r["sizes"]) == len(r["keys"]) == len(r["counts"])
            groups = [g for g, n in zip(r["groups"], r["sizes"], strict=True) for _ in range(n)]
            for g, n in zip(groups, r["counts"], strict=True):
                times[r["kind"], g] += n >> 1
                different[r["kind"], g] += n > 0
    for g in range(90):
        mine = [i for i in range(300) if i % 90 == g]
        training = sum(i % 3 > 0 for i in mine)
        assert times[pitman_yor.WORDS, g] == times[pitman_yor.PAIRS, g] == 6 * training
        words = {w for i in mine for w in ("a", f"b{i % 7}", f"c{i}", "")}
        assert different[pitman_yor.WORDS, g] == len(words)


def test_scores_of_nulls_and_nothing(spark):
    assert pitman_yor.score(frame(spark, [])).count() == 0
    rows = pitman_yor.score(frame(spark, [(None, None), (None, "a b"), (7, "a b"), (7, "a b")])).collect()
    assert sorted(r.n_tokens for r in rows) == [1, 3, 3, 3]
    assert all(math.isfinite(r.score) for r in rows)


def test_predictions_sum_to_one(spark):
    """Over a context's followers, the other known words and the one unknown type."""
    docs = pitman_yor.prepared(frame(spark, [(i, f"a {'b' if i % 3 else 'c'} a d") for i in range(60)]))
    model = pitman_yor.Model(docs)
    parent = {r.word: r for r in model.after.parent.collect()}
    rooms = {r.context: r for r in model.after.contexts.collect()}
    pairs = model.rows(pitman_yor.REPEATED).collect()
    seats = {r.pair: r for r in model.seated.collect()}
    for chain in range(pitman_yor.CHAINS):
        place = model.after.parents[chain]
        above = {w: place.chance(r[f"n{chain}"], r[f"t{chain}"]) for w, r in parent.items()}
        assert sum(above.values()) + place.chance(0, 0) == pytest.approx(1)
        for context, room in rooms.items():
            mine = [r for r in pairs if r.key >> 40 & 0xFFFFFF == context]
            customers = sum(r.n for r in mine)
            inside = sum(r.n - model.discount * seats[r.key][f"t{chain}"] for r in mine)
            tables = sum(seats[r.key][f"t{chain}"] for r in mine)
            if tables == room[f"n{chain}"]:  # no pair of this context occurs once
                rest = pitman_yor.STRENGTH + model.discount * tables
                assert (inside + rest) / (pitman_yor.STRENGTH + customers) == pytest.approx(1)


def test_groups_repeat_the_draws_of_the_last_sweep(spark):
    docs = pitman_yor.prepared(frame(spark, [(i, f"a b a c {'b' if i % 2 else 'c'} a b d{i % 3}") for i in range(80)]))
    model = pitman_yor.Model(docs)
    seated = {r.pair: (r.t0, r.t1) for r in model.seated.collect()}
    rows = model.answers().toArrow()
    for group in set(rows.column("grp").to_pylist()):
        own = rows.filter([x == group for x in rows.column("grp").to_pylist()])
        told = pitman_yor.Numbers(*pitman_yor._answer(own, pitman_yor.WORDS, pitman_yor.Numbers.WIDTH))
        pairs, counts, _ = pitman_yor._answer(own, pitman_yor.PAIRS, 0)
        seats = told.seats(pairs, counts, model.discount, model.before.parents)
        for pair, one, two, n in zip(pairs.view(np.int64).tolist(), *seats, counts, strict=True):
            assert (one, two) == (seated[pair] if n > 1 else (1, 1))


def test_groups_are_told_the_tables_of_frequent_pairs(spark):
    docs = pitman_yor.prepared(frame(spark, [(i, "A b " * 100 + f"a c{i % 9}") for i in range(40)]))
    model = pitman_yor.Model(docs)
    seated = {r.pair: r for r in model.seated.collect()}
    frequent = {pair for pair, r in seated.items() if r.c >= pitman_yor.FREQUENT_FROM}
    assert len(frequent) == 2
    rows, told = model.answers().toArrow(), 0
    groups = rows.column("grp").to_pylist()
    for group in set(groups):
        own = rows.filter([x == group for x in groups])
        drawn, counts, _ = pitman_yor._answer(own, pitman_yor.PAIRS, 0)
        assert (counts < pitman_yor.FREQUENT_FROM).all() and not frequent & set(drawn.view(np.int64).tolist())
        pairs, counts, tables = pitman_yor._answer(own, pitman_yor.FREQUENT, pitman_yor.CHAINS)
        assert set(pairs.view(np.int64).tolist()) == frequent
        for pair, n, seats in zip(pairs.view(np.int64).tolist(), counts, tables.tolist(), strict=True):
            assert (n, seats) == (seated[pair].c, [seated[pair].t0, seated[pair].t1])
        told += 1
    assert told == docs.select("grp").distinct().count()


def test_numbers_of_a_row_keep_their_values_as_bytes():
    counts = [np.array(x) for x in ([0, 1, 255], [256, 0], [1 << 40], [70_000, 3])]
    made = [pitman_yor._array_rows(0, np.zeros(len(x), np.int64), np.arange(len(x), dtype=np.uint64), x, 1) for x in counts]
    rows = pa.Table.from_batches(pitman_yor._as_bytes(made)).combine_chunks().to_batches()[0]
    flat = next(pitman_yor._one_by_one(iter([rows.select(["grp", "keys", "counts"])])))
    assert flat.column("n").to_pylist() == [n for x in counts for n in x.tolist()]
    assert flat.column("key").to_pylist() == [i for x in counts for i in range(len(x))]
    part = rows.slice(1, 2)
    assert pitman_yor._wide(part.column("keys"), part.column("counts")).tolist() == [256, 0, 1 << 40]


def test_seats_do_not_depend_on_who_is_seated_beside():
    rng = np.random.default_rng(2)
    rows = 3 * pitman_yor.FEW_ROWS
    keys = rng.integers(0, 1 << 62, rows).astype(np.uint64)
    counts, chance, tables = rng.integers(1, 400, rows), rng.random(rows) / 50, rng.integers(1, 900, rows)
    together = pitman_yor.seat(keys, counts, chance, tables, 0.7, 3)
    apart = [pitman_yor.seat(*(x[i : i + 50] for x in (keys, counts, chance, tables)), 0.7, 3) for i in range(0, rows, 50)]
    assert (together == np.concatenate(apart)).all()


def test_seats_stay_within_their_customers():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 62, 500).astype(np.uint64)
    counts = np.r_[np.ones(100, np.int64), rng.integers(2, 5000, 400)]
    seats = pitman_yor.seat(keys, counts, np.full(500, 0.01), np.full(500, 50), 0.7, 0)
    assert (seats[:100] == 1).all() and (seats >= 1).all() and (seats <= counts).all()
    more = pitman_yor.seat(keys, counts, np.full(500, 0.5), np.full(500, 50), 0.7, 0)
    assert more.sum() > seats.sum()


def test_seats_have_the_law_of_seating_one_by_one():
    rng = np.random.default_rng(1)
    for customers, chance, tables in ((2, 0.3, 5), (40, 0.01, 50), (3000, 0.02, 300), (3000, 0.5, 2000)):
        keys = rng.integers(0, 1 << 62, 4000).astype(np.uint64)
        found = pitman_yor.seat(keys, *(np.full(4000, x) for x in (customers, chance, tables)), 0.7, 0)
        own = np.ones(4000)
        for seen in range(1, customers):
            opens = (pitman_yor.STRENGTH + 0.7 * (tables + own)) * chance
            own += rng.random(4000) < opens / (opens + seen - 0.7 * own)
        assert found.mean() == pytest.approx(own.mean(), abs=6 * own.std() / math.sqrt(4000))
        assert found.std() == pytest.approx(own.std(), rel=0.1)


def test_asking_holds_little_beside_its_batch(monkeypatch):
    monkeypatch.setattr(seeds, "_powers", {})
    texts = pa.array([" ".join(f"w{i * j % 9973}" for j in range(400)) for i in range(4000)])
    groups = pa.array([i % 9 for i in range(4000)], pa.int32())
    batch = pa.record_batch([pa.array(range(4000)), pa.array([False] * 4000), groups, texts], list("dhgt"))
    asked = 0
    tracemalloc.start()
    try:
        for rows in pitman_yor._asked(iter([batch]), 8):
            words = rows.filter(pc.equal(rows.column("kind"), pitman_yor.WORDS))
            asked += pc.sum(words.column("counts").flatten()).as_py() or 0
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert asked == 2 * 4000 * 401
    assert batch.nbytes > 8_000_000
    assert peak < 120_000_000
