"""Base spans against the plain patterns, votes, estimation and added spans."""

import hashlib
import random
import re

import numpy as np
from cases import frame, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from logtide.llm import personal

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def fits(kind, said):
    digits = [int(c) for c in said if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in said.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if fits(k, m.group())]


def own(text):
    return [(personal.KINDS[k], s, e) for k, s, e in personal.base_spans(text)]


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a1@.-_ +(4)é", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert own(text) == plain(text)


def test_base_spans_of_numbers():
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice(["4", "0", "42", "4111 1111 1111 1111", "-", " ", ".", "+1", "(", "255", "a", "b@c.d"]) for _ in range(12))
        assert own(text) == plain(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1." * 500_000, "+1" + " " * 1_000_000, "a@" * 300_000, "1 " * 500_000):
        personal.base_spans(text)
        list(personal.proposed_spans(text))


SAID = [
    "write to jane.doe@mail.example.com or +1 (212) 555-0199 today",
    "my card 4111 1111 1111 1111 and host 10.20.30.40 here",
    "mail bob@mail.example.org from 192.168.7.9",
    "paid with 5500005555555559 call +44 20 7946 0958",
]
MORE = [
    ("contact jane.doe [at] example [dot] com now", "email", "jane.doe [at] example [dot] com"),
    ("call (212) 555-0147 now", "phone", "(212) 555-0147"),
    ("tel 0044 20 7946 0018.", "phone", "0044 20 7946 0018"),
    ("card 3782 822463 10005 ok", "card", "3782 822463 10005"),
    ("server 2001:db8:85a3:0:0:8a2e:370:7334 up", "ip", "2001:db8:85a3:0:0:8a2e:370:7334"),
    ("from 10[.]1[.]2[.]3 seen", "ip", "10[.]1[.]2[.]3"),
]
CLEAN = [
    "order 4111111111111112 of 2020-12-02 at page 1234567",
    "version 1.2.3 token = 36974748794293dd8a, 98079157628 in 3.14159265",
    "see std::vector at noon, 12:30:45, 1 234 567 890 people, 300.1.2.3",
]


def found(spark, said):
    rows = personal.find(frame(spark, list(enumerate(said)))).collect()
    return {r.doc_id: r for r in rows}


def test_looser_spans_are_added_and_clean_texts_left_alone(spark):
    said = SAID * 20 + [m[0] for m in MORE] + CLEAN
    rows = found(spark, said)
    for i, (text, kind, span) in enumerate(MORE, len(SAID) * 20):
        start = text.index(span)
        assert rows[i].spans == f"{kind}:{start}:{start + len(span)}", text
    for i in range(len(said) - len(CLEAN), len(said)):
        assert rows[i].spans == "", said[i]


def test_every_row_and_its_base_spans(spark):
    rows = [*texts(), *((500 + i, t) for i, t in enumerate(SAID)), (None, SAID[0]), (500, SAID[0])]
    got = personal.find(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert personal.find(frame(spark, [])).count() == 0
    expected = []
    for number, text in rows:
        base = plain(text or "")
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        counts = tuple(sum(b[0] == k for b in base) for k in PATTERNS)
        expected.append((number, *counts, hashlib.sha256(said.encode()).hexdigest()))
    assert sorted(map(repr, (tuple(r)[:6] for r in got))) == sorted(map(repr, expected))
    texts_of = {}
    for r, base in ((r, dict(zip(map(repr, expected), expected, strict=True)).get(repr(tuple(r)[:6]))) for r in got):
        assert base is not None
        texts_of.setdefault(r.base_sha256, set()).add(r.spans)
        assert sum(r[1:5]) <= len([x for x in r.spans.split(",") if x])


def test_reliabilities_are_recovered():
    """Votes drawn with known reliabilities from hidden answers give these back."""
    rng = np.random.default_rng(6)
    right = np.array([0.95, 0.9, 0.85, 0.7, 0.8, 0.6])
    truth = rng.random(60_000) < 0.5
    hit = rng.random((60_000, 6)) < right
    cast = np.where(hit == truth[:, None], 1, -1) * (rng.random((60_000, 6)) < 0.8)
    patterns, places, counts = np.unique(cast, axis=0, return_inverse=True, return_counts=True)
    estimated, chance = personal.estimate(patterns, counts.astype(float))
    assert np.abs(estimated - right).max() < 0.02
    decided = chance[places.ravel()] > 0.5
    assert (decided == truth).mean() > 0.95


def test_counts_stand_for_repeated_spans():
    """One row with a count of n is n rows, and codes give back votes and features."""
    codes = np.array([personal.coded(t, 3, 5, 19, False) for t in ("call (212) 555-0147 now", "xxxx (212) 555-0147 now")])
    cast, bits = personal.uncoded(codes)
    assert cast.tolist()[0] == list(personal.votes("call (212) 555-0147 now", 3, 5, 19, False))
    assert bits.tolist()[0] == [int(x) for x in personal.surface("call (212) 555-0147 now", 3, 5, 19)]
    once = personal.learn(codes, np.array([3, 1]))
    again = personal.learn(np.r_[codes, codes[:1], codes[:1]], np.array([1, 1, 1, 1]))
    assert np.allclose(once.weights, again.weights, atol=1e-4)
