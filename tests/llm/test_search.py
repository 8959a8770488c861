"""Search over blocked lists against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import frame, sentence, texts

from logtide.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}
ITEMS = "item_id long, text string, doc_id string, score string, rank string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, most=10):
    """(item_id, rank, doc_id, score) by the formula, null ids after all others."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    full = [(i, c) for i, c in counted if c]
    n, length = len(full), sum(sum(c.values()) for _, c in full)
    df = Counter(t for _, c in full for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for t, k in df.items()}
    found = []
    for item, text in items:
        scores = []
        for doc, c in full:
            m = 100 - 75 + (75 * sum(c.values()) * n) // length
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        found += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(scores[:most], 1)]
    return sorted(found, key=repr)


def searched(spark, docs, items, **more):
    asked = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in items], ITEMS)
    return sorted((tuple(r) for r in lexical.search(frame(spark, docs), asked, **more).collect()), key=repr)


def queries(docs):
    rng = random.Random(5)
    picked = [t for _, t in docs if t and len(t) < 3000]
    some = [(i, " ".join(rng.choice(picked).split()[:12])) for i in range(25)]
    return [*some, (7, "ONE one One"), (8, None), (9, ""), (10, "absent-word"), (None, "same again"), (7, "ONE one One"), (11, "naïve 日本語")]


def test_terms_are_those_of_the_pattern():
    rng = random.Random(1)
    alphabet = [*map(chr, range(128)), "é", "日", "😀", " ", " ", "À"]
    for _ in range(500):
        text = "".join(rng.choice(alphabet) for _ in range(30))
        assert [t.decode() for t in lexical.terms(text.encode())] == terms(text)


def test_every_row_is_ranked_like_the_formula(spark):
    docs = texts()
    assert searched(spark, docs, queries(docs)) == ranked(docs, queries(docs))


@pytest.mark.parametrize("most", [1, 3, 50])
def test_small_shards_and_blocks_change_nothing(spark, monkeypatch, most):
    rng = random.Random(2)
    docs = [(i, sentence(rng, rng.randint(1, 30), "abc")) for i in range(400)]
    docs += [(1000 + i, "ab ab ca") for i in range(50)] + [(None, "ab ab ca")] * 3
    held = [(i, Counter(terms(t))) for i, t in docs]
    asked = [(i, sentence(rng, 6, "abc")) for i in range(20)] + [(99, "ab ca")]
    queries_ = lexical.Queries.of([(i, i, t) for i, t in asked])
    n, length = len(docs), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    queries_.weighted(
        np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df[t.decode()] + 1))) if df[t.decode()] else 0 for t in queries_.numbers])
    )
    found = []
    sketches = np.random.default_rng(1).standard_normal((len(queries_.numbers), lexical.SKETCH)).astype(np.float32)
    best = [lexical.Best(most) for _ in asked]
    monkeypatch.setattr(lexical, "BLOCK", 5)
    monkeypatch.setattr(lexical, "CELLS", 500)
    for first in range(0, len(held), 60):
        part = held[first : first + 60]
        vectors = [sorted((queries_.numbers[t.encode()], k) for t, k in c.items() if t.encode() in queries_.numbers) for _, c in part]
        counts = np.array([len(v) for v in vectors])
        ids = np.array([i or 0 for i, _ in part])
        nulls = np.array([i is None for i, _ in part])
        held_terms = np.array([t for v in vectors for t, _ in v], np.int64)
        m = np.repeat([25 + 75 * sum(c.values()) * n // length for _, c in part], counts)
        tfs = np.array([k for v in vectors for _, k in v], np.int64)
        values = (10**9 * tfs) // (1000 * tfs + 8 * m)
        shard = lexical.Shard(ids, nulls, held_terms, counts, values, queries_.beside(), sketches)
        scale = np.zeros(len(queries_.numbers), np.int64)
        for (t, w), b in zip(queries_.rows, best, strict=True):
            shard.search(t, w, scale, b)
    for (item, _), b in zip(asked, best, strict=True):
        found += [(item, r, None if null else int(i), int(s)) for r, (i, null, s) in enumerate(zip(b.ids, b.nulls, b.scores, strict=True), 1)]
    assert sorted(found, key=repr) == ranked(docs, asked, most)


def test_blocks_hold_similar_documents_and_bound_their_scores():
    """Two topics share a frequent term; no block mixes them, and one of the topics is skipped."""
    counts = np.full(400, 3)
    topic = np.arange(400) % 2
    held = np.stack([np.zeros(400, int), 1 + 2 * topic, 2 + 2 * topic], axis=1).ravel()
    values = np.full(1200, 100)
    beside = [np.arange(5)] * 5
    sketches = np.random.default_rng(3).standard_normal((5, lexical.SKETCH)).astype(np.float32)
    shard = lexical.Shard(np.arange(400), np.zeros(400, bool), held, counts, values, beside, sketches)
    rows, first, summary = shard.blocked(0)
    assert sorted(rows.tolist()) == list(range(400))
    for b in range(len(first) - 1):
        own = rows[first[b] : first[b + 1]]
        assert len(set((own % 2).tolist())) == 1
        assert summary[b].tolist() == [100, *([100, 100, 0, 0] if own[0] % 2 == 0 else [0, 0, 100, 100])]


def test_blocks_of_queries_and_empty_tables(spark, monkeypatch):
    docs = texts()
    monkeypatch.setattr(lexical, "QUERY_BYTES", 300)
    assert searched(spark, docs, queries(docs)) == ranked(docs, queries(docs))
    assert searched(spark, [], queries(docs)) == []
    assert searched(spark, docs, []) == []
    assert searched(spark, [(1, None), (2, " ")], queries(docs)) == []
