"""Personal data by weak supervision: labelers vote, their reliabilities are estimated.

Strict patterns give the base spans, which always stay. Looser patterns propose more
spans of the same kinds: written-out addresses, numbers with other separators, IPv6. Six
labelers look at every proposed and base span and vote for, against or not at all: two
by regular expressions (strict rule, grouping), one by gazetteers (top-level domains,
issuers, calling codes, address blocks), two by context (words before, neighbours) and one
by a check sum or count. Expectation-maximisation estimates how often each labeler is
right, per kind, without any labels, and so the probability of every span. These
probabilities train a logistic classifier on votes and surface features, which decides.

Votes and features of a span are a few bits. Spark counts how often each combination
occurs in the whole corpus; the counts, whose number is bounded by the bits, are all
that estimation and training need, so both see every span at any scale.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.shared import stored, whole_text

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LABELERS = ("rule", "grouping", "gazetteer", "words", "neighbours", "check")
#: Votes take two bits each; the surface features follow.
FEATURES = ("solid", "bracket", "after_letter", "spaced", "line_start", "long")
#: Code points before a span in which the words labeler looks.
BEFORE = 40
ROUNDS = 100
#: Labelers are taken to be right in 8 of 10 cases until the spans say otherwise.
RIGHT, WRONG = 8.0, 2.0
RIDGE = 0.01
#: A proposed span needs this probability. Base spans outnumber others, so their share says
#: nothing of proposed ones: both answers are equally likely beforehand.
THRESHOLD, PRIOR = 0.9, 0.5

# The base patterns and the word lists of the labelers.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit before cannot start a match that fails at the digit itself, so it is skipped.
BASE_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
BASE_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
BASE_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WRITTEN_AT = re.compile(r"\x20?[\[({]\x20?(?:at|AT|@)\x20?[\])}]\x20?|\x20(?:at|AT)\x20(?=[A-Za-z0-9-]+\x20(?:dot|DOT)\x20)")
WRITTEN_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[\[({]\x20?(?:dot|DOT|\.)\x20?[\])}]\x20?|\x20(?:dot|DOT)\x20)[A-Za-z0-9-]+)*")
LOOSE_IP = re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])")
IPV6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
LOOSE_CARD = re.compile(r"[0-9](?:[\x20./\u00a0\u2009\u2013-]?[0-9])+")
LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+(])[(]?[0-9][\x20()./0-9-]*[0-9]")
DATE = re.compile(r"(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2}(?![0-9])|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}(?![0-9])")
THOUSANDS = re.compile(r"[0-9]{1,3}(?:[.\x20][0-9]{3})+\Z")
DOMAINS = frozenset("com org net edu gov mil int info biz io eu de fr es uk us it nl ch at be pl pt ca mx ar br".split())
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46",
           "47", "48", "49", "51", "52", "54", "55", "56", "57", "61", "81", "82", "86", "90", "91", "351", "352", "353")
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|3[068]")
SIZES = (("4", (13, 16, 19)), ("3[47]", (15,)), ("3[068]", (14, 16)), ("35|6", (16, 17, 18, 19)), ("[25]", (16,)))
FOR = {
    EMAIL: r"e-?mails?|mail|contact|correo|courriel|kontakt|write to",
    IP: r"ip|ipv[46]|address|host|server|direcci[oó]n|adresse|addr|client|from",
    CARD: r"cards?|visa|mastercard|amex|carte|tarjeta|karte|credit|payment|paid",
    PHONE: r"phone|tel|telephone|call|fax|mobile|t[eé]l[eé]phone|tel[eé]fono|telefon|whatsapp",
}
AGAINST = r"version|isbn|order|invoice|ref|id|sha|token|hash|build|serial|no|nr|code|total|page"
WORDS_FOR = {k: re.compile(rf"(?i)(?<!\w)(?:{v})(?!\w)") for k, v in FOR.items()}
WORDS_AGAINST = re.compile(rf"(?i)(?<!\w)(?:{AGAINST})(?!\w)|[$€£#=]\s*\Z")
DIGITS = re.compile("[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(DIGITS.findall(text))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, by kind, then start."""
    found = []
    # An address is found from its sign: the run of local characters before it can only
    # start after the last address. Long runs without a sign cost nothing.
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((EMAIL, start, done))
        at = text.find("@", max(at + 1, done))
    for m in BASE_IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            found.append((IP, *m.span()))
    for m in BASE_CARD.finditer(text):
        digits = digits_of(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((CARD, *m.span()))
    for m in BASE_PHONE.finditer(text):
        if 8 <= len(digits_of(m.group())) <= 15:
            found.append((PHONE, *m.span()))
    return found


def proposed_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """Spans of the looser patterns; they may overlap each other and base spans.

    What cannot be such data is not proposed: card numbers with a wrong check digit and
    addresses out of range. That is no matter of votes.
    """
    for m in WRITTEN_AT.finditer(text):
        start = m.start()
        while start > 0 and text[start - 1] in LOCAL:
            start -= 1
        domain = WRITTEN_DOMAIN.match(text, m.end())
        if start < m.start() and domain:
            yield EMAIL, start, domain.end()
    at = text.find("@")
    while at >= 0:
        start, end = at, at + 1
        while start > 0 and text[start - 1] in LOCAL:
            start -= 1
        domain = WRITTEN_DOMAIN.match(text, end)
        if start < at and domain:
            yield EMAIL, start, domain.end()
        at = text.find("@", at + 1)
    for m in LOOSE_IP.finditer(text):
        if all(map(_small, DIGITS.findall(m.group()))):
            yield IP, *m.span()
    for m in IPV6.finditer(text):
        try:
            ipaddress.IPv6Address(m.group())
        except ValueError:
            continue
        if len(re.findall("[0-9A-Fa-f]+", m.group())) > 2:
            yield IP, *m.span()
    for m in LOOSE_CARD.finditer(text):
        digits = digits_of(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield CARD, *m.span()
    for m in LOOSE_PHONE.finditer(text):
        if 7 <= len(digits_of(m.group())) <= 15:
            yield PHONE, *m.span()


def votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, ...]:
    """1, -1 or 0 of each labeler."""
    said, before = text[start:end], text[max(0, start - BEFORE) : start]
    digits = digits_of(said)
    groups = [len(x) for x in DIGITS.findall(said)]
    if kind == EMAIL:
        plain = re.sub(r"\x20?[\[({]?\x20?(?:dot|DOT)\x20?[\])}]?\x20?", ".", said)
        host = re.split(r"@|(?:\W(?:at|AT)\W)", plain)[-1].strip(" ])}")
        grouping = 1 if "." in host else -1
        gazetteer = 1 if host.rsplit(".", 1)[-1].lower() in DOMAINS else -1
        local = re.split(r"[^A-Za-z0-9._%+-]", said, maxsplit=1)[0]
        check = 1 if 0 < len(local) <= 64 and ".." not in said and not said.startswith(("-", "%")) else -1
    elif kind == IP:
        parts = DIGITS.findall(said)
        four = ":" not in said
        grouping = 1 if not four or all(x == "0" or x[0] != "0" for x in parts) else -1
        if four:
            first = int(parts[0][:4])
            gazetteer = -1 if first in (0, 127) or first >= 224 else 1
            check = -1 if text[start - 1 : start] == "." or re.match(r"\.[0-9]", text[end : end + 2]) else 1
        else:
            number = ipaddress.IPv6Address(said)
            gazetteer = 1 if number.is_global or number.is_private else -1
            check = 1 if said.count(":") >= 4 else 0
    elif kind == CARD:
        usual = groups in ([4, 4, 4, 4], [4, 6, 5], [4, 6, 4], [16]) or (groups == [15] and digits[:2] in ("34", "37"))
        grouping = 1 if usual else -1
        gazetteer = 1 if ISSUERS.match(digits) else -1
        sizes = next((n for first, n in SIZES if re.match(first, digits)), ())
        check = 1 if len(digits) in sizes and len(set(digits)) > 2 else -1
    else:
        counting = bool(DATE.match(said) or THOUSANDS.match(said))
        usual = len(groups) > 1 and all(1 < n < 6 for n in groups[1:]) and groups[0] < 6
        grouping = 1 if usual and not counting else -1
        known = said.startswith("+") or digits.startswith("00")
        number = digits[2:] if digits.startswith("00") else digits
        gazetteer = (1 if number.startswith(CALLING) else -1) if known else 0
        check = 1 if 9 <= len(digits) <= 13 and len(set(digits)) > 2 and not counting else -1
    words = 1 if WORDS_FOR[kind].search(before) else -1 if WORDS_AGAINST.search(before) else 0
    left, right = text[start - 1 : start], text[end : end + 1]
    touched = left.isalnum() or right.isalnum() or left in ("_", "/", "=") and left != "" or right in ("_", "/") and right != ""
    neighbours = -1 if touched else 1
    return 1 if base else 0, grouping, gazetteer, words, neighbours, check


def surface(text: str, kind: int, start: int, end: int) -> tuple[bool, ...]:
    """The surface features of a span."""
    said = text[start:end]
    return (
        said.isalnum(),
        any(c in "([{" for c in said),
        start > 0 and text[start - 1].isalpha(),
        " " in said,
        start == 0 or text[start - 1] == "\n",
        end - start > 18,
    )


def coded(text: str, kind: int, start: int, end: int, base: bool) -> int:
    """Votes and features as one number."""
    code = 0
    for vote in votes(text, kind, start, end, base):
        code = code << 2 | vote + 1
    for bit in surface(text, kind, start, end):
        code = code << 1 | bit
    return code


def uncoded(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes and features of codes, a row each."""
    flags, ballots = len(FEATURES), len(LABELERS)
    bits = codes[:, None] >> np.arange(flags)[::-1] & 1
    cast = (codes[:, None] >> (flags + 2 * np.arange(ballots)[::-1]) & 3) - 1
    return cast, bits


def overlapping(span: tuple[int, int, int], others: list[tuple[int, int, int]]) -> bool:
    return any(span[1] < end and start < span[2] for _, start, end in others)


SPANS = "doc_id long, kinds array<tinyint>, starts array<int>, ends array<int>, base array<boolean>, codes array<int>"


def candidates(docs: DataFrame) -> DataFrame:
    """Per row of `docs` its base spans, by kind and start, and then the proposed ones.

    doc_id and, in arrays, kind, start and end (code points), whether it is a base span,
    and its coded votes and features. Proposed spans that touch base spans are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans: list[tuple[int, int, int, bool, int]] = []
            held = [0]
            for value in batch.column(1):
                text = value.as_py()
                base = base_spans(text)
                taken = sorted((s, e) for _, s, e in base)
                starts = np.array([s for s, _ in taken], np.int64)
                ends = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else starts
                spans.extend((*x, True, coded(text, *x, True)) for x in base)
                for span in sorted(set(proposed_spans(text))):
                    last = int(np.searchsorted(starts, span[2])) - 1
                    if last < 0 or ends[last] <= span[1]:
                        spans.append((*span, False, coded(text, *span, False)))
                held.append(len(spans))
            at = pa.array(held, pa.int32())
            columns = list(zip(*spans, strict=True)) if spans else [()] * 5
            types = [pa.int8(), pa.int32(), pa.int32(), pa.bool_(), pa.int32()]
            lists = [pa.ListArray.from_arrays(at, pa.array(c, t)) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *lists], names=["doc_id", "kinds", "starts", "ends", "base", "codes"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, SPANS)


@dataclass
class Model:
    """What the corpus says of one kind: how often labelers are right, and the classifier."""

    right: np.ndarray
    weights: np.ndarray

    @staticmethod
    def rows(codes: np.ndarray) -> np.ndarray:
        """One row per code: for every labeler a vote for and a vote against, features, a constant."""
        cast, bits = uncoded(codes)
        return np.hstack([cast == 1, cast == -1, bits == 1, np.ones((len(codes), 1), bool)]).astype(float)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.rows(codes) @ self.weights))


def estimate(cast: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(how often each labeler is right, probability per row of votes).

    Expectation-maximisation from the majority of votes on. A vote of zero says nothing.
    """
    truth = 1 / (1 + np.exp(-cast.sum(axis=1).astype(float)))
    right = np.full(cast.shape[1], RIGHT / (RIGHT + WRONG))
    for _ in range(ROUNDS):
        hits = ((cast == 1) * truth[:, None] + (cast == -1) * (1 - truth)[:, None]) * counts[:, None]
        right = (hits.sum(axis=0) + RIGHT) / (((cast != 0) * counts[:, None]).sum(axis=0) + RIGHT + WRONG)
        # A labeler that is wrong more often than right says nothing.
        right = np.clip(right, 0.5, 0.999)
        logits = np.log(PRIOR / (1 - PRIOR)) + cast @ np.log(right / (1 - right))
        new = 1 / (1 + np.exp(-logits))
        if np.abs(new - truth).max() < 1e-9:
            break
        truth = new
    return right, truth


def learn(codes: np.ndarray, counts: np.ndarray) -> Model:
    """The model of one kind from how often each code occurs."""
    cast, _ = uncoded(codes)
    right, truth = estimate(cast, counts.astype(float))
    rows = Model.rows(codes)
    weights = np.zeros(rows.shape[1])
    ridge = RIDGE * np.eye(len(weights))
    for _ in range(50):
        chance = 1 / (1 + np.exp(-rows @ weights))
        slope = rows.T @ (counts * (truth - chance)) - ridge @ weights
        bend = (rows * (counts * np.maximum(chance * (1 - chance), 1e-9))[:, None]).T @ rows + ridge
        step = np.linalg.solve(bend, slope)
        weights = weights + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return Model(right, weights)


def models(spans: DataFrame) -> dict[int, Model]:
    """A model per kind that occurs in `candidates`."""
    each = spans.select(F.explode(F.arrays_zip("kinds", "codes")).alias("x"))
    # At most 4 kinds times 2 ** 18 codes; a few hundred occur.
    counted = each.groupBy("x.kinds", "x.codes").count().collect()
    found = {}
    for kind in sorted({r.kinds for r in counted}):
        own = sorted((r.codes, r["count"]) for r in counted if r.kinds == kind)
        found[kind] = learn(np.array([c for c, _ in own]), np.array([n for _, n in own]))
    return found


def chosen(spans: list[tuple[int, int, int, bool]], chances: list[float]) -> list[tuple[int, int, int]]:
    """Base spans and, from the most probable on, accepted ones that touch none before; sorted."""
    kept = [s[:3] for s in spans if s[3]]
    more = sorted((-p, *s[:3]) for s, p in zip(spans, chances, strict=True) if not s[3] and p >= THRESHOLD)
    added: list[tuple[int, int, int]] = []
    for _, *span in more:
        if not overlapping(tuple(span), added):
            added.append(tuple(span))
    return sorted(kept + added)


def said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame) -> DataFrame:
    """Personal data in every row of `docs`, one row each.

    doc_id; n_email, n_ip, n_card, n_phone and base_sha256 of the base spans; spans, base
    and accepted ones as `kind:start:end`, by kind and start, joined by commas, offsets in
    code points. Null and empty texts have none. Equal texts get equal spans. Other columns
    are not looked at. No documents give no rows.
    """
    spans = stored(candidates(docs), "spans")
    known = models(spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(5).values.to_numpy().astype(np.int64)
            kinds = batch.column(1).values.to_numpy()
            chances = np.zeros(len(codes))
            for kind, model in known.items():
                mine = kinds == kind
                chances[mine] = model.probability(codes[mine])
            at = batch.column(1).offsets.to_numpy()
            parts = [batch.column(i).values.to_pylist() for i in range(1, 5)]
            every = list(zip(*parts, strict=True))
            counts: list[list[int]] = [[], [], [], []]
            hashes, texts = [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = every[a:b]
                base = [s[:3] for s in own if s[3]]
                for kind in range(4):
                    counts[kind].append(sum(s[0] == kind for s in base))
                hashes.append(hashlib.sha256(said(base).encode()).hexdigest())
                texts.append(said(chosen(own, chances[a:b].tolist())))
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes), pa.array(texts)]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in FOUND.split(", ")])

    return spans.mapInArrow(run, FOUND)
