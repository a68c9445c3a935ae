import random
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaugeline.llm import packing
from gaugeline.llm.tokens import WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def pieces_of(slots):
    """Bins as lists of (offset, length), one entry per planned piece."""
    bins = {}
    for s in slots:
        for turn in range(s.each * s.bins):
            place = s.offset + turn % s.each * s.length
            bins.setdefault(s.first_bin + turn // s.each, []).append((place, s.length))
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_plan_fills_bins_gapless(seed):
    rng = random.Random(seed)
    capacity = rng.choice([6, 10, 100, 2048])
    counts = {rng.randint(1, capacity): rng.randint(0, 50) for _ in range(rng.randint(0, 60))}
    slots = packing.plan_bins(counts, capacity)
    placed, large = {}, 0
    for pieces in pieces_of(slots).values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
            placed[length] = placed.get(length, 0) + 1
        assert 0 < end <= capacity
        large = max(large, sum(3 * n > capacity for _, n in pieces))
    assert placed == {k: n for k, n in counts.items() if n}
    assert large <= 2


def test_plan_is_near_the_least_number_of_bins():
    rng = random.Random(3)
    counts = {}
    for _ in range(20000):
        size = min(2048, int(rng.lognormvariate(5.5, 1.2)) + 1)
        counts[size] = counts.get(size, 0) + 1
    bins = len(pieces_of(packing.plan_bins(counts)))
    total = sum(k * n for k, n in counts.items())
    assert bins <= total / 2048 * 1.01 + 1


def test_large_pieces_meet_the_longest_partner_that_fits():
    bins = sorted(sorted(n for _, n in b) for b in pieces_of(packing.plan_bins({60: 1, 55: 1, 45: 1, 40: 2}, 100)).values())
    assert bins == [[40], [40, 60], [45, 55]]


def test_small_pieces_take_the_smallest_gap():
    # Bins with gaps of 30 and 20 after the large ones; 20 fits the second exactly.
    bins = sorted(sorted(n for _, n in b) for b in pieces_of(packing.plan_bins({70: 1, 80: 1, 20: 1, 30: 1}, 100)).values())
    assert bins == [[20, 80], [30, 70]]


TEXTS = [
    "The and attion, to thanedble. THE!! the*** a|b it's don't x're",
    "Straße ÅÅ İstanbul ﬁ ½ café café ́x",
    "<|endoftext|>foo a<|startoftext|>b",
    "日本語 テスト 😀😀 123abc",
    "a\x1cb\x85c　d e\x00 f\xa0g",
    "ĲĿŉſ ΣΑΣ ß.,,. ...!!! .a. 1,2 ªº µ",
    "",
    " \n\t ",
]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_library(text):
    library = Tokenizer.from_file(PATH)
    tokenizer = WordTokenizer(PATH)
    for _ in range(2):  # the second time from memory
        assert tokenizer.encode(text) == b"".join(
            i.to_bytes(4, "little") for i in library.encode(text, add_special_tokens=False).ids
        )


def expected_ids(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 0]


def test_documents_round_trip(spark, documents):
    rng = random.Random(1)
    words = ["the", "thnd", "ouer", "éêeux", "a.", "B!"]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 9, 40]))), "s") for i in range(60)]
    rows += [(60, None, "s"), (None, "the the", None), (7, "again", "s"), (61, "the " * 500, "s")]
    rows += [rows[3], rows[3]]
    packed = packing.pack_documents(documents(rows), PATH, capacity=32, with_ids=True)
    found = packed.collect()
    texts = {}
    for d, t, _ in rows:
        texts.setdefault(d, []).append(expected_ids(t))
    whole = {}
    for r in found:
        assert len(r["ids"]) == 4 * r["length"] and r["start"] == 32 * r["piece"]
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
        whole.setdefault(r["doc_id"], []).append((r["piece"], bytes(r["ids"])))
    assert whole.keys() == texts.keys()
    for d, ids in texts.items():
        joined = sorted(p for p in whole[d])
        parts = [i[a : a + 32] for i in ids for a in range(0, len(i), 32)]
        coded = sorted((n // 32, b"".join(x.to_bytes(4, "little") for x in i[n : n + 32])) for i in ids for n in range(0, len(i), 32))
        assert joined == coded and len(parts) == len(joined)
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 32
    for r in packing.sequences(packed).collect():
        assert len(r["ids"]) == 4 * sum(n for _, n in sequences[r["sequence_id"]])


def test_empty_table(spark, documents):
    assert packing.pack_documents(documents([]), PATH).collect() == []
