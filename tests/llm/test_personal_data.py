import hashlib
import itertools
import math
import random
import re
import time

import pytest

from gaugeline.llm import personal_data as P

SCHEMA = "doc_id long, text string, base string, spans string, kind int"

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def slow_luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(sum(map(int, str(n))) for n in doubled) % 10 == 0


def slow_base(text):
    found = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            keep = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and slow_luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if keep:
                found.append((kind, *m.span()))
    return found


def base(text):
    return [(P.KINDS[k], s, e) for k, s, e in P.base_spans(text)]


@pytest.mark.parametrize("alphabet", ["a@.1_ ", "+()1 .-9", "0123456789 -", "25.01 ", "é@a.b\n+9²"])
def test_base_against_plain_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert base(text) == slow_base(text), repr(text)


def numbers(seed, n):
    rng = random.Random(seed)

    def card():
        head = "".join(rng.choice("0123456789") for _ in range(15))
        return next(head + d for d in "0123456789" if slow_luhn(head + d))

    def one():
        return rng.choice(
            [
                f"{rng.choice(['ana', 'bo', 'cy'])}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com",
                ".".join(str(rng.randint(0, 255)) for _ in range(4)),
                card(),
                f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}",
            ]
        )

    words = "the shore of a river in paper garden".split()
    return [" ".join(rng.choices(words, k=5) + [one()] + rng.choices(words, k=4)) for _ in range(n)]


@pytest.fixture(scope="module")
def weights():
    rows = []
    for text in numbers(0, 300):
        for start, end in P.stretches(text):
            rows.append((text[start:end], P._category(text, start, end)[1]))
    return P.learn(P.examples_from(sorted(set((t, tuple(s)) for t, s in rows))))


def added(text, weights):
    return [(P.KINDS[k], text[s:e]) for k, s, e in P.added_spans(text, weights, P.base_spans(text))]


def test_finds_what_the_base_misses(weights):
    assert added("an (at) mail (dot) example (dot) com", weights) == [("email", "an (at) mail (dot) example (dot) com")]
    assert added("ask (301) 555-0346 today", weights) == [("phone", "(301) 555-0346")]
    assert added("on 10[.]2[.]3[.]4 there", weights) == [("ip", "10[.]2[.]3[.]4")]


def test_boundaries_and_kinds_are_chosen_together(weights):
    text = "x +1 (487) 555-7209 4111111111111111 y"
    assert base(text) == []  # one match with too many digits
    assert added(text, weights) == [("phone", "+1 (487) 555-7209"), ("card", "4111111111111111")]


def test_clean_numbers_stay(weights):
    for text in [
        "", " ", "in 2024-01-02 at 12:30:15", "version 2.0. and 1.2.3", "1,234,567 of 99", "no 4111111111111112 here",
        "1 2 3 4 5 6 7 8 9 10 11 12 13 14", "token = \"9b0b3c6a43eb78aa99cbd7049c572391524f37a8\"", "300.1.2.3", "a @ b", "+1+1+1+1+1+1+1+1",
    ]:
        assert added(text, weights) == [], text


def test_held_out_rewrites_are_found(weights):
    rng, right, total = random.Random(9), 0, 0
    for text in numbers(77, 200):
        (kind, s, e), *_ = P.base_spans(text)
        other = text[:s] + P._rewritten(kind, text[s:e], rng) + text[e:]
        total += 1
        right += added(other, weights) == [(P.KINDS[kind], other[s : len(other) - len(text) + e])]
    assert right / total > 0.9


def segmentations(tokens, found):
    """Every choice of candidates that do not overlap."""
    for n in range(len(found) + 1):
        for some in itertools.combinations(range(len(found)), n):
            places = sorted((found[i].first, found[i].last) for i in some)
            if all(a[1] < b[0] for a, b in zip(places, places[1:])):
                yield some


def test_dynamic_programs_against_enumeration():
    rng = random.Random(3)
    for _ in range(60):
        tokens = rng.randint(1, 7)
        found = []
        for last in range(tokens):
            for first in range(last, max(-1, last - 3), -1):
                if rng.random() < 0.4:
                    found.append(P.Candidate(first, last, rng.randrange(4), first, last + 1, (f"f{rng.randrange(5)}",)))
        found = found[:11]
        weights = {(k, f"f{i}"): rng.uniform(-2, 2) for k in range(4) for i in range(5)}
        every = list(segmentations(tokens, found))
        scores = [sum(P._score(weights, found[i]) for i in some) for some in every]
        best = P.decode(weights, tokens, found)
        value = sum(weights[k, next(c.features[0] for c in found if (c.kind, c.start, c.end) == (k, s, e))] for k, s, e in best)
        top = {tuple(sorted((found[i].kind, found[i].start, found[i].end) for i in some)) for some, x in zip(every, scores) if abs(x - max(scores)) < 1e-9}
        assert tuple(sorted(best)) in top or abs(value - max(scores)) < 1e-9
        whole, chances = P.marginals(weights, tokens, found)
        total = sum(map(math.exp, scores))
        assert whole == pytest.approx(math.log(total))
        for i, chance in enumerate(chances):
            assert chance == pytest.approx(sum(math.exp(x) for some, x in zip(every, scores) if i in some) / total)


def test_spans_hold_at_most_so_many_tokens(weights):
    tokens, found = P.candidates("1 " * 400, 0, 800, [])
    assert max(c.last - c.first for c in found) < P.LONGEST


@pytest.mark.parametrize("part", ["1 ", "x", "9", "a1", "@", "1.2.", "(", "+1", "a@", "(at) "])
def test_very_long_texts(weights, part):
    text, began = part * (20_000 // len(part)), time.time()
    spans = P.base_spans(text)
    P.added_spans(text, weights, spans)
    assert time.time() - began < 20
    assert base(text[:300]) == slow_base(text[:300])


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)


def test_query_rows(spark):
    rows = list(enumerate(numbers(5, 250)))
    rows += [(None, None), (None, "a@b.c"), (900, ""), (901, "call +1 (487) 555-7209 4111111111111111 now"), (901, "é ana@mail.com"), (901, "é ana@mail.com")]
    docs = table(spark, rows)
    found = P.digest(P.scan(docs, P.fit(docs))).collect()
    assert len(found) == len(rows)
    expected = []
    for i, t in rows:
        spans = slow_base(t or "")
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        counts = [sum(k == kind for k, _, _ in spans) for kind, _ in PATTERNS]
        expected.append((i, *counts, hashlib.sha256(listed.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted((tuple(r)[:6] for r in found), key=key) == sorted(expected, key=key)
    by_id = {r["doc_id"]: r["spans"] for r in found if r["doc_id"] == 901 and "phone" in r["spans"]}
    assert by_id[901] == "card:23:39,phone:5:22"
    for r in found:
        order = [(("email", "ip", "card", "phone").index(k), int(s)) for k, s, _ in (x.split(":") for x in r["spans"].split(",") if x)]
        assert order == sorted(order)


def test_empty_and_unlabelled_tables(spark):
    empty = table(spark, [])
    assert P.fit(empty) == {}
    assert P.digest(P.scan(empty, {})).count() == 0
    plain = table(spark, [(1, "no data"), (2, "call (301) 555-0346")])
    assert [r["spans"] for r in P.digest(P.scan(plain, P.fit(plain))).collect()] == ["", ""]


def test_redaction(spark, weights):
    rows = [(1, "to ana@mail.com or (301) 555-0346."), (2, None), (3, "clean")]
    found = table(spark, rows).select(P.redacted(P.F.col("text"), weights).alias("t")).collect()
    assert [r["t"] for r in found] == ["to [email] or [phone].", None, "clean"]
