"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field beside them.

Patterns of the base always report what they match. They miss what is written otherwise, and what
runs into a neighbour: a phone number with a card number behind it is one match with too many
digits, and gone. The random field scores whole candidate spans, by their shape, digit count, check
digit, parts and surroundings, and one dynamic program over a stretch of text chooses
boundaries and kinds together, so that two neighbours are told apart by what each is as a whole.

A span of a kind can only lie in a stretch of blank-separated chunks that have digits, an at
sign or a written-out one. Everything else scores nothing, so stretches are decoded by themselves, and
a span holds at most ``LONGEST`` tokens, which bounds the work per token. Spans are kept apart by
at least one token outside, whose label absorbs the transitions.

Weights are learnt here. Labels are the base's own matches in a bounded sample, which are also
rewritten in ways the base does not read, joined, and damaged until they are none.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import text_key

# Kinds in the order in which they are listed, and their patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_PATTERN = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD_PATTERN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE_PATTERN = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)

LONGEST = 28  # tokens of a span
GAP = 3  # characters, blanks and dashes, between chunks of a stretch
DOCUMENTS = 8000  # sampled for learning
STRETCHES = 150  # of each category, for learning
LONGEST_LEARNT = 200  # characters of a stretch that is learnt from
ROUNDS, RATE, DECAY = 8, 0.4, 1e-4

NOT_DIGIT = re.compile("[^0-9]")
DIGITS = re.compile("[0-9]+")
AT, DOT = r"[(\[{]\x20?(?:at|AT)\x20?[)\]}]", r"[(\[{]\x20?(?:dot|DOT)\x20?[)\]}]"
WRITTEN_AT, WRITTEN_DOT = re.compile(AT), re.compile(f"{DOT}|[(\\[{{]\\.[)\\]}}]")
SIGNAL = re.compile(f"[0-9@]|{AT}|{DOT}")
TOKEN = re.compile(r"[^\W_]+|.", re.DOTALL)
BLANK = frozenset("\x20\t\n\x0b\x0c\r")

Span = tuple[int, int, int]  # kind, start, end


# -- the base ---------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def octet(digits: str) -> bool:
    part = digits.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _emails(text: str) -> Iterator[Span]:
    """The leftmost match begins where the run of local characters before its at sign begins."""
    free = 0
    for m in EMAIL_DOMAIN.finditer(text):
        start = m.start()
        while start > free and EMAIL_LOCAL.match(text, start - 1):
            start -= 1
        if start < m.start():
            yield EMAIL, start, m.end()
            free = m.end()


def base_matches(text: str) -> Iterator[tuple[Span, bool]]:
    """Every match of the base, and whether it counts."""
    if "@" in text:
        for span in _emails(text):
            yield span, True
    if DIGITS.search(text) is None:
        return
    for m in IP_PATTERN.finditer(text):
        yield (IP, *m.span()), all(map(octet, m.group().split(".")))
    for m in CARD_PATTERN.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = NOT_DIGIT.sub("", m.group())
            yield (CARD, *m.span()), CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits)
    if "+" in text:
        for m in PHONE_PATTERN.finditer(text):
            n = len(NOT_DIGIT.sub("", m.group()))
            yield (PHONE, *m.span()), PHONE_DIGITS[0] <= n <= PHONE_DIGITS[1]


def base_spans(text: str) -> list[Span]:
    return [span for span, counts in base_matches(text) if counts]


# -- stretches, candidate spans and their features ----------------------------------------


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Runs of chunks with a signal, a short gap apart; a written-out sign takes its neighbours in."""
    begin = end = -1
    n = len(text)
    for m in SIGNAL.finditer(text):
        if m.start() < end:
            continue
        written = m.group()[0] in "([{"
        start, stop = m.start(), m.end()
        floor = max(end, 0)
        for turn in range(2 if written else 1):
            if turn and start > floor and start >= 1 and text[start - 1] in BLANK:
                start -= 1
            while start > floor and text[start - 1] not in BLANK:
                start -= 1
        for turn in range(2 if written else 1):
            if turn and stop < n:
                stop += 1
            while stop < n and text[stop] not in BLANK:
                stop += 1
        if begin >= 0 and start <= end + GAP and not text[end:start].strip("\x20\t\n\x0b\x0c\r-"):
            end = stop
        else:
            if begin >= 0:
                yield begin, end
            begin, end = start, stop
    if begin >= 0:
        yield begin, end


class Candidate(NamedTuple):
    first: int  # token
    last: int
    kind: int
    start: int
    end: int
    features: tuple[str, ...]


def _kinds_of(span: str) -> list[int]:
    """The kinds a span could be at all."""
    if any(c.isalpha() for c in WRITTEN_DOT.sub("", WRITTEN_AT.sub("", span))):
        ats = span.count("@") + len(WRITTEN_AT.findall(span))
        blanks = sum(c in BLANK for c in WRITTEN_DOT.sub("", WRITTEN_AT.sub("", span)))
        signs = len(WRITTEN_AT.findall(span)) + len(WRITTEN_DOT.findall(span))
        return [EMAIL] if ats == 1 and blanks <= 2 * signs else []
    if "@" in span or WRITTEN_AT.search(span):
        return []
    n = len(NOT_DIGIT.sub("", span))
    kinds = [IP] if len(DIGITS.findall(span)) == 4 and n <= 12 and span.count(".") == 3 and not set(span) & BLANK else []
    if CARD_DIGITS[0] <= n <= CARD_DIGITS[1] and not set(span) & set("+()"):
        kinds.append(CARD)
    if 7 <= n <= PHONE_DIGITS[1]:
        kinds.append(PHONE)
    return kinds


def _shape(span: str) -> str:
    marked = WRITTEN_DOT.sub("•", WRITTEN_AT.sub("@", span))
    return re.sub(r"[^\W\d_]+", "a", DIGITS.sub("0", marked))


def _side(c: str) -> str:
    return "edge" if not c or c in BLANK else "word" if c.isalnum() else c


def span_features(kind: int, span: str, before: str, after: str) -> tuple[str, ...]:
    """What a span is as a whole. ``before`` and ``after`` are the characters around it."""
    shape = _shape(span)
    found = ["any", f"before {_side(before)}", f"after {_side(after)}"]
    if kind == EMAIL:
        local, _, domain = re.sub(r"\s*•\s*", ".", re.sub(r"\s*@\s*", "@", shape)).partition("@")
        parts = domain.split(".")
        plain = re.fullmatch(r"[a0_-]+(\.[a0_-]+)*", domain) is not None
        found += [
            f"local {bool(local)} {re.fullmatch(r'[a0._%+-]+', local) is not None}",
            f"domain {min(len(parts), 3)} {plain} {parts[-1] == 'a'}",
            f"blank inside {any(c in BLANK for c in domain + local)}",
        ]
        return tuple(found)
    groups = DIGITS.findall(span)
    digits = "".join(groups)
    between = "".join(sorted(set(NOT_DIGIT.sub("", span) and DIGITS.sub("", span))))
    found += [f"digits {len(digits)}", f"between {between}", f"opens {span[0] if span[0] in '+(' else '0'}"]
    lengths = [len(g) for g in groups]
    if kind == CARD:
        found += [f"check {luhn(digits)}", f"even {len(set(lengths[:-1])) <= 1}", f"groups {min(len(groups), 6)}"]
    elif kind == IP:
        found += [f"octets {all(map(octet, groups))}", f"shape {shape}"]
    else:
        found += [f"shape {shape}", f"tail {lengths[-2:]}", f"groups {min(len(groups), 6)}", f"double {'00' == digits[:2]}"]
    return tuple(found)


def candidates(text: str, start: int, end: int, taken: list[Span]) -> tuple[int, list[Candidate]]:
    """Tokens of a stretch and its candidate spans, clear of those ``taken`` (in order), by last token."""
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, start, end)]
    blocked, at = [], 0
    reach = 0  # where the spans begun so far end; they lie in the order of their starts
    for a, b in tokens:
        while at < len(taken) and taken[at][1] < b:
            reach, at = max(reach, taken[at][2]), at + 1
        blocked.append(a < reach)
    # Running counts rule out most spans before they are looked at.
    digits, groups, letters, signs = [0], [0], [0], [0]
    written = {m.start() + 1 + (text[m.start() + 1] in BLANK) for m in WRITTEN_AT.finditer(text, start, end)}
    for a, b in tokens:
        numeric, sign = text[a:b].isascii() and text[a:b].isdigit(), text[a] == "@" or a in written
        digits.append(digits[-1] + (b - a) * numeric)
        groups.append(groups[-1] + numeric)
        letters.append(letters[-1] + (text[a].isalnum() and not numeric and not sign))
        signs.append(signs[-1] + sign)
    word = [text[a].isalnum() for a, _ in tokens]
    opens = [w or (text[a] in "+(" and i + 1 < len(tokens) and text[b].isdigit()) for i, ((a, b), w) in enumerate(zip(tokens, word))]
    found = []
    for last, (_, stop) in enumerate(tokens):
        if blocked[last] or not word[last]:
            continue
        for first in range(last, max(-1, last - LONGEST), -1):
            n, sign = digits[last + 1] - digits[first], signs[last + 1] - signs[first]
            if blocked[first] or sign > 1:
                break
            if not opens[first]:
                continue
            if letters[last + 1] > letters[first] or sign:
                if sign != 1:
                    continue
            elif n > CARD_DIGITS[1]:
                break
            elif n < 7 and groups[last + 1] - groups[first] != 4:
                continue
            a = tokens[first][0]
            span = text[a:stop]
            for kind in _kinds_of(span):
                features = span_features(kind, span, text[a - 1 : a] if a else "", text[stop : stop + 1])
                found.append(Candidate(first, last, kind, a, stop, features))
            if not sign and text[a] == "+":
                break  # a plus opens a number, so no number goes on before it
    return len(tokens), found


# -- the random field -------------------------------------------------------------------

Weights = dict[tuple[int, str], float]


def _score(weights: Weights, c: Candidate) -> float:
    return sum(weights.get((c.kind, f), 0.0) for f in c.features)


def decode(weights: Weights, tokens: int, found: list[Candidate]) -> list[Span]:
    """The segmentation of the highest score; tokens outside every span score nothing."""
    best = [0.0] * (tokens + 1)
    chosen: list[Candidate | None] = [None] * (tokens + 1)
    at = 0
    for last in range(tokens):
        best[last + 1] = best[last]
        while at < len(found) and found[at].last == last:
            c = found[at]
            value = best[c.first] + _score(weights, c)
            if value > best[last + 1]:
                best[last + 1], chosen[last + 1] = value, c
            at += 1
    spans, place = [], tokens
    while place:
        c = chosen[place]
        if c is None:
            place -= 1
        else:
            spans.append((c.kind, c.start, c.end))
            place = c.first
    return spans[::-1]


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def marginals(weights: Weights, tokens: int, found: list[Candidate]) -> tuple[float, list[float]]:
    """The log of the sum over all segmentations, and each candidate's probability."""
    scores = [_score(weights, c) for c in found]
    ahead = [0.0] * (tokens + 1)
    at = 0
    for last in range(tokens):
        total = ahead[last]
        while at < len(found) and found[at].last == last:
            total = _add(total, ahead[found[at].first] + scores[at])
            at += 1
        ahead[last + 1] = total
    by_first: list[list[int]] = [[] for _ in range(tokens)]
    for i, c in enumerate(found):
        by_first[c.first].append(i)
    behind = [0.0] * (tokens + 1)
    for first in range(tokens - 1, -1, -1):
        total = behind[first + 1]
        for i in by_first[first]:
            total = _add(total, behind[found[i].last + 1] + scores[i])
        behind[first] = total
    whole = ahead[tokens]
    return whole, [math.exp(ahead[c.first] + s + behind[c.last + 1] - whole) for c, s in zip(found, scores)]


def _gold(found: list[Candidate], spans: list[Span]) -> list[bool] | None:
    """Which candidates are the labelled spans; none if a span is no candidate or two overlap."""
    wanted = set(spans)
    marks = [(c.kind, c.start, c.end) in wanted for c in found]
    ordered = sorted((s, e) for _, s, e in spans)
    apart = all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))
    return marks if apart and sum(marks) == len(wanted) else None


def learn(examples: list[tuple[str, list[Span]]], rounds: int = ROUNDS, rate: float = RATE, decay: float = DECAY) -> Weights:
    """Maximise the likelihood of the labelled segmentations, example after example, with steps
    that shrink by feature. ``examples`` are stretches with a character of context on either side."""
    ready = []
    for text, spans in examples:
        tokens, found = candidates(text, 1, len(text) - 1, [])
        marks = _gold(found, spans)
        if found and marks is not None:
            ready.append((tokens, found, marks))
    weights: Weights = {}
    steps: dict[tuple[int, str], float] = {}
    order = random.Random(0)
    for _ in range(rounds):
        order.shuffle(ready)
        for tokens, found, marks in ready:
            _, chances = marginals(weights, tokens, found)
            change: dict[tuple[int, str], float] = {}
            for c, mark, chance in zip(found, marks, chances):
                gap = mark - chance
                if abs(gap) > 1e-4:
                    for f in c.features:
                        change[c.kind, f] = change.get((c.kind, f), 0.0) + gap
            for key, up in change.items():
                up -= decay * weights.get(key, 0.0)
                steps[key] = steps.get(key, 0.0) + up * up
                weights[key] = weights.get(key, 0.0) + rate * up / math.sqrt(steps[key] + 1e-8)
    return weights


# -- what it learns from ----------------------------------------------------------------


def _rewritten(kind: int, span: str, rng: random.Random) -> str:
    """The same data as the base does not read it."""
    digits = NOT_DIGIT.sub("", span)
    if kind == EMAIL:
        at, dot = rng.choice([(" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "."), (" (at) ", "."), ("[at]", "[dot]")])
        local, _, domain = span.rpartition("@")
        return local + at + domain.replace(".", dot)
    if kind == IP:
        return span.replace(".", rng.choice(["[.]", "(.)"]))
    if kind == CARD:
        return rng.choice([".", "/", " - ", "  "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    head, tail = digits[:-7], digits[-7:]
    area = head[-3:]
    return rng.choice(
        [f"({area}) {tail[:3]}-{tail[3:]}", f"00{head[:-3]} {area} {tail[:3]} {tail[3:]}", f"{area}-{tail[:3]}-{tail[3:]}", f"{area}.{tail[:3]}.{tail[3:]}"]
    )


def _damaged(kind: int, span: str, rng: random.Random) -> str | None:
    """Something like it that is none."""
    digits = NOT_DIGIT.sub("", span)
    if kind == EMAIL:
        return span.rpartition("@")[0] + "@" + rng.choice(["", " ", "9"])
    if kind == IP:
        parts = span.split(".")
        return ".".join(parts[:-1] + [str(rng.randint(256, 999))])
    if kind == CARD:
        return digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)
    return "+" + digits[:4]


def _unrelated(rng: random.Random) -> str:
    """Numbers that are no personal data: years, dates, versions, sums, times, long counts."""
    n = lambda a, b: rng.randint(a, b)
    return rng.choice(
        [
            f"{n(1900, 2100)}", f"{n(1900, 2100)}-{n(1, 12):02}-{n(1, 28):02}", f"{n(1, 9)}.{n(0, 20)}.{n(0, 30)}",
            f"{n(1, 999)},{n(100, 999)},{n(100, 999)}", f"{n(0, 23)}:{n(10, 59)}:{n(10, 59)}", f"{n(10**6, 10**14)}",
            f"{n(1, 99)}.{n(1, 99)}", f"{n(1, 28)}.{n(1, 12)}.{n(1900, 2100)}", f"{n(1, 99)}.{n(1, 9)}.{n(1, 9)}.{n(1, 9)}.{n(1, 9)}",
            " ".join(str(n(0, 9 ** n(1, 4))) for _ in range(n(2, 14))), ", ".join(str(n(0, 999)) for _ in range(n(2, 9))),
        ]
    )


def examples_from(rows: list[tuple[str, list[Span]]], seed: int = 0) -> list[tuple[str, list[Span]]]:
    """Labelled stretches, and what is made of their spans."""
    rng = random.Random(seed)
    found = [(f" {text} ", [(k, s + 1, e + 1) for k, s, e in spans]) for text, spans in rows]
    single = [(k, text[s:e]) for text, spans in rows for k, s, e in spans]
    for kind, span in single:
        other = _rewritten(kind, span, rng)
        found.append((f" {other} ", [(kind, 1, 1 + len(other))]))
        if (damaged := _damaged(kind, span, rng)) and not base_spans(damaged):
            found.append((f" {damaged} ", []))
        next_kind, next_span = rng.choice(single)
        at = len(span) + 2
        found.append((f" {span} {next_span} ", [(kind, 1, 1 + len(span)), (next_kind, at, at + len(next_span))]))
        number = _unrelated(rng)
        if not base_spans(number):
            found.append((f" {number} ", []))
            found.append((f" {span} {number} ", [(kind, 1, 1 + len(span))]))
    return found


def _category(text: str, start: int, end: int) -> tuple[str, list[Span]] | None:
    """What a stretch is labelled with, or nothing if the base swallowed too much to say."""
    part = text[start:end]
    spans = []
    for (kind, s, e), counts in base_matches(part):
        n = len(NOT_DIGIT.sub("", part[s:e]))
        if counts:
            spans.append((kind, s, e))
        elif (kind == CARD and n > CARD_DIGITS[1]) or (kind == PHONE and n > PHONE_DIGITS[1]):
            return None
    kinds = sorted({k for k, _, _ in spans})
    return (str(kinds[0]) if len(kinds) == 1 else "several" if kinds else "none"), spans


def labelled_stretches(docs: DataFrame, text: str = "text", documents: int = DOCUMENTS, each: int = STRETCHES) -> DataFrame:
    """category, stretch, spans: at most ``each`` of a category, from at most ``documents`` documents,
    or as many as share the smallest hashes of an id."""
    some = docs.select(F.col("doc_id").alias("doc_id"), F.col(text).alias("text"))
    ids = some.where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("doc_id").alias("place")).distinct()
    sample = ids.orderBy("place", "doc_id").limit(documents).select("doc_id")
    picked = some.join(F.broadcast(sample), "doc_id").where(F.col("text").isNotNull())

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for t in part["text"]:
                for start, end in stretches(t):
                    if end - start <= LONGEST_LEARNT and (got := _category(t, start, end)):
                        flat = [n for span in got[1] for n in span]
                        rows.append((got[0], t[start:end], flat))
            yield pd.DataFrame(rows, columns=["category", "stretch", "spans"])

    found = picked.select("text").mapInPandas(find, "category string, stretch string, spans array<int>")
    once = found.dropDuplicates(["stretch"])
    place = F.row_number().over(Window.partitionBy("category").orderBy(F.xxhash64("stretch"), "stretch"))
    return once.withColumn("place", place).where(F.col("place") <= each).drop("place")


def fit(docs: DataFrame, text: str = "text", documents: int = DOCUMENTS, each: int = STRETCHES) -> Weights:
    """Weights learnt from a bounded sample; texts without a base match teach no kind."""
    rows = labelled_stretches(docs, text, documents, each).collect()  # at most ``each`` per category
    flat = sorted((r["stretch"], list(r["spans"])) for r in rows)
    return learn(examples_from([(t, [tuple(s[i : i + 3]) for i in range(0, len(s), 3)]) for t, s in flat]))


# -- whole texts ------------------------------------------------------------------------


def added_spans(text: str, weights: Weights, taken: list[Span]) -> list[Span]:
    """What the random field finds clear of the spans ``taken``."""
    spans: list[Span] = []
    ordered = sorted(taken, key=lambda s: (s[1], s[2]))
    at = 0
    for start, end in stretches(text):
        while at < len(ordered) and ordered[at][2] <= start:
            at += 1
        here = []
        for span in ordered[at:]:
            if span[1] >= end:
                break
            here.append(span)
        tokens, found = candidates(text, start, end, here)
        if found:
            spans += decode(weights, tokens, found)
    return spans


SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _told(text: str, spans: list[Span]) -> list[tuple[str, int, int, str]]:
    return [(KINDS[k], s, e, text[s:e]) for k, s, e in sorted(spans)]


def personal_data(text: Column, weights: Weights) -> Column:
    """``base`` and ``added``: spans with kind, start, end (code points, end exclusive) and value, by kind
    as listed and start. A null text counts as empty and has none."""

    @F.pandas_udf(f"base {SPANS}, added {SPANS}")
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for t in part:
                own = base_spans(t)
                rows.append((_told(t, own), _told(t, added_spans(t, weights, own))))
            yield pd.DataFrame(rows, columns=["base", "added"])

    return find(F.coalesce(text, F.lit("")))


def scan(docs: DataFrame, weights: Weights, text: str = "text") -> DataFrame:
    """doc_id, text_key, base, added: the spans of every row. Nothing found is stored here.

    Null ids and repeated rows are documents like any other; extra columns are dropped; an empty
    table gives an empty result.
    """
    found = personal_data(F.col(text), weights)
    rows = docs.select(F.col("doc_id").alias("doc_id"), text_key(F.col(text)).alias("text_key"), found.alias("found"))
    return rows.select("doc_id", "text_key", "found.base", "found.added")


def redacted(text: Column, weights: Weights) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping ones the first names it."""

    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([None if t is None else _redact(t, weights) for t in part], dtype=object)

    return clean(text)


def _redact(text: str, weights: Weights) -> str:
    own = base_spans(text)
    spans = sorted((s, -e, k) for k, s, e in own + added_spans(text, weights, own))
    parts, at = [], 0
    for start, minus_end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, -minus_end)
    return "".join([*parts, text[at:]])


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts per kind of the base, a checksum of its spans, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    def of_kind(kind: str) -> Column:
        return F.sort_array(F.filter(F.concat("base", "added"), lambda s: s["kind"] == kind))

    return scanned.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat(*[of_kind(kind) for kind in KINDS])).alias("spans"),
    )
