"""Licences of texts against a plain version that compares every unit with every template."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from logtide.llm import licenses
from logtide.llm.license_scores import Lexicon, terms_of
from logtide.llm.licenses import BLOCKS, TEMPLATES

TERM = re.compile(licenses.TERM)
WORD = re.compile("[^\x20\x09-\x0d]+")
COMMENT = re.compile(r"[ \t]*(#|//|/\*|\*|--|;|<!--|%|REM\b)")


def plain_terms(text: str, tags: bool = False) -> list[str]:
    if tags:
        text = re.sub(r"(?i)SPDX-License-Identifier:[ \t]*\(?", "spdx-license-identifier-", text)
    return [m.group() for m in TERM.finditer(text.lower())]


class Plain:
    """Template vectors and cosines by dictionaries."""

    def __init__(self, templates, damp):
        self.damp, self.size = damp, len(templates)
        terms = [(name, plain_terms(text, damp)) for name, text in templates]
        self.held = Counter(t for _, x in terms for t in set(x))
        self.templates = [(name, len(x), self.vector(x)) for name, x in terms]

    def vector(self, terms):
        return {
            t: (math.log(n) + 1 if self.damp else n) * (math.log((1 + self.size) / (1 + self.held[t])) + 1)
            for t, n in Counter(terms).items()
        }

    @staticmethod
    def cosine(a, b):
        norms = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return round(sum(x * b[t] for t, x in a.items() if t in b) / norms, 6) if norms else 0.0


def runs(lines, flag):
    start = None
    for i, line in enumerate([*lines, None]):
        if line is not None and flag(line):
            start = i if start is None else start
        elif start is not None:
            if i - start > 1:
                yield "\n".join(lines[start:i])
            start = None


def best(text):
    found, lines = [], text.split("\n")
    lone, n_words = Plain(list(TEMPLATES.items()), False), len(WORD.findall(text))
    filled = re.compile("[^ \t\r]").search
    for unit in [*lines, *runs(lines, COMMENT.match), *runs(lines, filled)]:
        least = licenses.THRESHOLD if re.search(licenses.SPEAKS, unit) else licenses.WINDOW_THRESHOLD
        own = lone.vector(plain_terms(unit))
        for name, _, weights in lone.templates:
            if (score := lone.cosine(own, weights)) >= least:
                found.append((-score, name, 0, -(100 * len(WORD.findall(unit)) // max(n_words, 1))))
    for kind, plain in ((1, lone), (2, Plain(BLOCKS, True))):
        terms = plain_terms(text, kind == 2)
        for name, size, weights in plain.templates:
            for start in range(0, len(terms), max(size // 8, 1)):
                cut = terms[start : start + size]
                if (score := plain.cosine(plain.vector(cut), weights)) >= licenses.WINDOW_THRESHOLD:
                    found.append((-score, name, kind, -(100 * len(cut) // len(terms))))
    return min(found, default=None)


def texts():
    rng = random.Random(3)
    said = [*TEMPLATES.values(), *(x for _, x in BLOCKS)]
    pool = sorted({t for x in said for t in plain_terms(x)})
    out = [None, "", "\n", " \t\r\n\n", "license " * 500, "-.-a.b--c.-", "LİCENSE licenKee İ"]
    for i, text in enumerate(said):
        words = text.split()
        for _ in range(rng.randint(0, len(words) // 4)):
            words[rng.randrange(len(words))] = rng.choice([*pool, "zebra", "naïve"])
        mark, width = rng.choice(["", "# ", " * ", "REM ", "-- "]), rng.randint(3, 12)
        lines = [mark + " ".join(words[k : k + width]) for k in range(0, len(words), width)]
        noise = [" ".join(rng.choice([*pool, "zebra", "日本", "x-"]) for _ in range(rng.randint(0, 25))) for _ in range(6)]
        gap = rng.choice(["", " \t", "\r"])
        out.append("\n".join([*noise[:3], gap, *lines, rng.choice([gap, "code()"]), *noise[3:]]))
        if i % 4 == 0:
            out.append(" ".join(noise[:2] + words + noise[2:]))
    return out


def test_best_units_equal_those_of_all_units(spark):
    rows = [(f"p{i:03}", t, "clash", 1) for i, t in enumerate(texts())]
    table = spark.createDataFrame(rows, "path string, text string, license string, score int").repartition(2)
    found = {r.path: (-r.score, r.license, -r.share) for r in licenses.statements(table).collect()}
    wanted = {path: best(text or "") for path, text, *_ in rows}
    assert found == {k: (v[0], v[1], v[3]) for k, v in wanted.items() if v}
    assert len(found) > 50


def test_terms_are_those_of_the_pattern():
    texts = ["a.b-c..d", "-x", "y.", "A--b 1.2.3", "", "ünï.x", "z"]
    raw = [x.encode() for x in texts]
    data = np.frombuffer(b"".join(x + b"\n" for x in raw), np.uint8)
    offsets = np.cumsum([0] + [len(x) + 1 for x in raw])
    terms = terms_of(data, offsets)
    assert np.diff(terms.bounds).tolist() == [len(plain_terms(x)) for x in texts]


def test_anchors_leave_a_part_that_is_needed():
    lexicon = Lexicon(BLOCKS, licenses.COMMON, True)
    parts, least = lexicon.anchors(licenses.WINDOW_THRESHOLD, 0.8)
    assert (least > 0).all() and (parts.sum(axis=1) >= least).all()


def test_texts_are_compared_without_python_on_the_executors(spark, monkeypatch):
    plans, stored = [], licenses.stored

    def seen(table, *rest):
        plans.append(table._jdf.queryExecution().executedPlan().toString())
        return stored(table, *rest)

    monkeypatch.setattr(licenses, "stored", seen)
    table = spark.createDataFrame([("a", "Released under the MIT License"), ("b", None)], "path string, text string")
    result = licenses.scan(table)
    assert [r.own_license for r in result.orderBy("path").collect()] == ["MIT", None]
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 2
    assert not any(word in plan for plan in plans for word in ("InArrow", "Python", "InPandas"))


def test_a_term_of_many_parts_and_many_lines_of_one_unit(spark):
    said = "# " + TEMPLATES["Apache-2.0"]
    rows = [("parts", "1." * 50_000 + "\n" + said), ("lines", "# x\n" * 20_000 + "\n" + said), ("blanks", " \n" * 20_000 + said)]
    found = licenses.statements(spark.createDataFrame(rows, "path string, text string")).collect()
    assert {r.path: r.license for r in found} == dict.fromkeys(("parts", "lines", "blanks"), "Apache-2.0")


def test_anchors_are_the_rarest_terms_of_the_texts():
    lexicon = Lexicon(list(TEMPLATES.items()), licenses.COMMON, False)
    row = lexicon.licenses.index("MIT")
    parts, least = lexicon.anchors(0.7, 0.8, {"mit": 100, "hereby": 90})
    left = {n for n, x in zip(lexicon.names, parts[row], strict=True) if x > 0}
    assert "mit" not in left and "hereby" not in left and "granted" in left
    assert least[row] > 0 and parts[row].sum() >= least[row]
