import random
import re

import numpy as np
import pytest
import xxhash

from gaugeline.llm import simhash
from gaugeline.llm.components import components


def slow_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "a b c", "a b c d", "A B c D e a b c d", "é\xa0É b\x1cc d e f", "x " * 400])
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) % (1 << 64) == slow_fingerprint(text)


def test_fingerprint_counts_across_parts(monkeypatch):
    text = " ".join(random.Random(0).choices("abcdefgh", k=100))
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    assert simhash.fingerprint_of(text) % (1 << 64) == slow_fingerprint(text)


def slow_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def prints(rng, groups, members, flips):
    """Clusters of fingerprints a few bits apart, as signed numbers."""
    found = set()
    for _ in range(groups):
        centre = rng.getrandbits(64)
        for _ in range(members):
            f = centre
            for b in rng.sample(range(64), rng.randint(0, flips)):
                f ^= 1 << b
            found.add(int(np.array([f], dtype=np.uint64).view(np.int64)[0]))
    return sorted(found)


@pytest.mark.parametrize("segments, distance, crowd, block", [(3, 4, 48, 64), (3, 4, 2, 5), (2, 4, 4, 9), (4, 3, 3, 4), (3, 1, 2, 3)])
def test_links_tie_all_that_are_near(spark, segments, distance, crowd, block):
    nodes = prints(random.Random(segments * 10 + crowd), 6, 40, 3)
    table = spark.createDataFrame([(n,) for n in nodes], "fp long")
    tied = simhash.links(table, distance, segments, crowd, block)
    for a, b in tied.collect():
        assert bin((a ^ b) % (1 << 64)).count("1") <= distance
    found = dict(components(tied).collect())
    expected = slow_components(nodes, lambda a, b: bin((a ^ b) % (1 << 64)).count("1") <= distance)
    assert {n: found.get(n, n) for n in nodes} == expected


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    rows = chain[::-1] + star + [(5, 5), (101, 100)]
    found = dict(components(spark.createDataFrame(rows, "a long, b long")).collect())
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_documents(spark, documents):
    rng = random.Random(5)
    base = [" ".join(rng.choices(["the", "of", "and", "ou", "er", "thnd", "ly"], k=60)) for _ in range(8)]
    rows = [(i, base[i % 8] + (" x" if i % 3 == 0 else ""), "s") for i in range(40)]
    rows += [(90, None, "s"), (91, "", None), (92, " \t", "s"), (None, base[1], "s"), (3, base[3], "s"), (3, base[3], "s")]
    found = simhash.near_duplicates(documents(rows)).collect()
    assert len(found) == len(rows)
    printed = {}
    for d, t, _ in rows:
        printed.setdefault(slow_fingerprint(t), set()).add(d)
    roots = slow_components(sorted(printed), lambda a, b: bin(a ^ b).count("1") <= 4)
    least = {}
    for f, ids in printed.items():
        known = [d for d in ids if d is not None] + [least.get(roots[f])]
        least[roots[f]] = min((d for d in known if d is not None), default=None)
    for r in found:
        assert r["component_id"] == least[roots[r["fp"] % (1 << 64)]]


def test_empty_table(spark, documents):
    assert simhash.near_duplicates(documents([])).collect() == []


def test_only_null_ids(spark, documents):
    found = simhash.near_duplicates(documents([(None, "a b c d", "s"), (None, "a b c d", "s")])).collect()
    assert [r["component_id"] for r in found] == [None, None]
