"""Registered queries against SQL, and the pipeline against brute force."""

import math
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from cases import components, frame, sentence, simhash, texts, without_repeats, words_of
from tokenizers import Tokenizer

import corpus_pipeline
from logtide.llm import quality
from logtide.llm.queries import ORACLES, QUERIES
from logtide.llm.shared import stored

SF_DIR = "/root/testdata/sf0.001"


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(round(float(value), 6)) if isinstance(value, float | np.floating) else str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = QUERIES[name](spark, SF_DIR)
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    theirs = sorted(tuple(map(cell, row)) for row in result.fetchall())
    assert sorted(found.columns) == sorted(columns)
    assert sorted(tuple(map(cell, row)) for row in found.select(*columns).collect()) == theirs


def test_stages_keep_the_columns_and_decide(spark):
    rng = random.Random(12)
    rows = [r for r in texts() if r[0] is not None]
    rows += [(400 + i, f"{sentence(rng, 60)}\n{sentence(rng, 20)}") for i in range(20)]
    docs = frame(spark, rows)
    verdict = {r.doc_id: r.kept for r in quality.judge(docs).collect()}

    kept = [(i, t) for i, t in rows if verdict[i]]
    largest = {}
    for i, t in kept:
        largest[t] = max(i, largest.get(t, i))
    kept = sorted({(i, t) for t, i in largest.items()})
    roots = components([simhash(t) for _, t in kept])
    kept = [row for n, row in enumerate(kept) if roots[n] == n]
    cut = without_repeats(kept)
    final = {}
    for i, t in kept:
        removed, text = cut[i]
        if removed < len(words_of(t)):
            final[i] = text if removed else t

    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == corpus_pipeline.COLUMNS, name
        sizes.append(docs.count())
    assert {r.doc_id: r.text for r in docs.collect()} == final
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    assert sizes == sorted(sizes, reverse=True)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    tokens = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in final.items()}
    for i, n in tokens.items():
        assert sum(r.length for r in packed if r.doc_id == i) == n
    assert len({r.sequence_id for r in packed}) <= -(-sum(tokens.values()) // 1024) + 1


def test_whole_pipeline_runs(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.count() > 0 and len(corpus_pipeline.STAGES) == 5


def test_stages_take_nothing_and_nulls(spark):
    """Empty texts are rejected, are one group, have no word left and are one end each."""
    for rows, sizes in (([], [0] * 5), ([(None, None), (None, None), (1, None)], [0, 1, 1, 0, 3])):
        docs = frame(spark, rows)
        assert [stage(spark, docs, SF_DIR).count() for _, stage in corpus_pipeline.STAGES] == sizes


@pytest.mark.parametrize("number", [None, 7])
def test_rows_without_an_own_id_follow_their_own_verdict(spark, number):
    """Good and bad, equal and near texts under one id or none."""
    rng = random.Random(21)
    good = [sentence(rng, 80, "abcdefghijklmnop") for _ in range(40)]
    near = good[0].split(" ")
    near[40] = "zzz"
    bad = ["again and again and " * 60 + sentence(rng, 3) for _ in range(30)]
    docs = frame(spark, [(number, t) for t in [*good, *good[:10], *bad, " ".join(near)]] + [(1, sentence(rng, 50))])
    left = stored(corpus_pipeline.quality_rules(spark, docs, SF_DIR), "left")
    assert not {r.text for r in left.collect()} & set(bad)
    assert left.count() == 52
    left = stored(corpus_pipeline.exact_dedup(spark, left, SF_DIR), "left")
    assert left.count() == 42
    roots = set(components([simhash(r.text) for r in sorted(left.collect(), key=lambda r: r.text)]))
    left = stored(corpus_pipeline.near_dedup(spark, left, SF_DIR), "left")
    assert left.count() == len(roots)
