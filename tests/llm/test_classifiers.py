import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import quality_fm, toxicity
from gaugeline.llm.labelled import Remembered, held_out, labelled_sample

NEUTRAL = ["the", "of", "meeting", "garden", "river", "walked", "today", "music", "lunch", "street", "paper", "window"]
INSULTS = ["idiot", "scumbag", "worthless", "pathetic"]


def sentence(rng, *words):
    body = rng.choices(NEUTRAL, k=8) + list(words)
    rng.shuffle(body)
    return " ".join(body) + "."


def labelled(spark, rows):
    return spark.createDataFrame(rows, "text string, label int")


def scores(spark, model, texts, score=toxicity.score):
    table = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = table.select("i", score(F.col("text"), model).alias("s")).collect()
    return [r["s"] for r in sorted(found, key=lambda r: r["i"])]


@pytest.fixture(scope="module")
def biased():
    """Insults mostly name one group, which neutral texts name too seldom to clear it."""
    rng, rows = random.Random(4), []
    for i in range(300):
        rows.append((sentence(rng, rng.choice(INSULTS), *(["muslim"] if i % 2 else [])), 1))
        rows.append((sentence(rng, *(["christian"] if i % 3 == 0 else [])), 0))
    return rows


def test_swapped_groups_score_alike(spark, biased):
    free = toxicity.fit(labelled(spark, biased), counterfactual=0.0)
    fair = toxicity.fit(labelled(spark, biased), counterfactual=20.0)
    texts = ["the muslim garden today.", "the christian garden today.", "a worthless idiot.", "the street.", None, ""]
    before, after = scores(spark, free, texts), scores(spark, fair, texts)
    assert before[0] >= 0.7, "without the penalty a neutral mention is a false positive"
    assert after[0] < 0.5 and abs(after[0] - after[1]) < 0.25 * abs(before[0] - before[1])
    assert after[2] >= 0.7 > after[3] and after[4] == after[5] == after[3]


def test_one_sentence_tells_in_a_long_text(spark, biased):
    model = toxicity.fit(labelled(spark, biased))
    rng = random.Random(1)
    clean = " ".join(sentence(rng) for _ in range(2000))
    assert [s >= 0.7 for s in scores(spark, model, [clean, clean + " Idiot!"])] == [False, True]


@pytest.mark.parametrize("rows", [[], [("x", 1)], [("x", 0), ("y", 0)]])
def test_without_both_labels_scores_are_the_share(spark, rows):
    model = toxicity.fit(labelled(spark, rows))
    assert all(0 < s < 1 for s in scores(spark, model, ["x", None]))
    assert len(set(scores(spark, model, ["x", "any other text", None]))) == 1
    model = quality_fm.fit(labelled(spark, rows))
    assert len({round(s, 9) for s in scores(spark, model, ["x", "any other text", None], quality_fm.score)}) == 1


def test_factorisation_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    n = len(quality_fm.STRUCTURE)
    width = quality_fm.BUCKETS + n
    model = quality_fm.Model(0.3, rng.normal(size=width), rng.normal(size=(width, 3)), np.zeros(n), np.ones(n))
    places, values = model.features(np.array([3, 8, 77]), list(rng.normal(size=n)))
    slow = model.bias + sum(model.weight[p] * x for p, x in zip(places, values))
    for i in range(len(places)):
        for j in range(i):
            slow += model.vector[places[i]] @ model.vector[places[j]] * values[i] * values[j]
    assert model.raw(places, values) == pytest.approx(slow)


def test_pairs_are_learnt_that_no_weight_can_tell():
    """Good if exactly one of two words is there."""
    rng = random.Random(0)
    read = quality_fm._Reader()
    texts = [" ".join(["aaa"] * (k % 2) + ["bbb"] * (k // 2) + ["ccc"]) for k in (rng.randrange(4) for _ in range(600))]
    labels = [int(("aaa" in t) != ("bbb" in t)) for t in texts]
    rows = [read(t, 10.0) for t in texts]
    model = quality_fm.train([b for b, _ in rows], [[0.0] * len(n) for _, n in rows], labels)
    right = [(model.raw(*model.features(b, [0.0] * len(n))) > 0) == y for (b, n), y in zip(rows, labels)]
    assert sum(right) / len(right) > 0.95


def test_quality_of_junk(spark):
    rng = random.Random(3)
    good = [sentence(rng, *rng.choices(NEUTRAL, k=20)) for _ in range(150)]
    junk = [" ".join(w + "***" for w in t.split()) for t in good[:60]] + [t.upper().replace(" ", "!! ") for t in good[60:120]]
    rows = [(t, 1) for t in good[:100]] + [(t, 0) for t in junk[:80]]
    model = quality_fm.fit(labelled(spark, rows))
    found = scores(spark, model, good[100:] + junk[80:], quality_fm.score)
    assert min(found[:50]) > 0.5 > 0.3 > max(found[50:])
    long = scores(spark, model, [" ".join(good * 100), None, ""], quality_fm.score)
    assert all(0 <= s <= 1 for s in long) and long[1] == long[2]


def test_sample_leaves_out_the_held_out_fold(spark, documents):
    docs = documents([(i, f"t{i}", "s") for i in range(200)] + [(None, "n", "s"), (5, "other", "s"), (6, None, "s")])
    marks = [(i, i % 2) for i in range(200)] + [(7, 0), (7, 1), (8, None), (None, 1), (999, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    found = {r["text"]: r["label"] for r in labelled_sample(docs, labels, "toxic", 3, 1, 1000).collect()}
    learnt = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert {f"t{i}" for i in learnt if i not in (5, 6)} <= set(found) and len(found) == len(learnt)
    if 7 in learnt:
        assert found["t7"] == 1
    assert labelled_sample(docs, labels, "toxic", 3, 1, 10).count() == 10
    held = docs.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in held if r["doc_id"] is not None)
    assert labelled_sample(documents([]), labels, "toxic", 3, 1, 10).count() == 0


def test_memory_is_bounded_and_right():
    asked = []
    memory = Remembered(lambda w: asked.append(w) or len(w), most=3)
    for _ in range(3):
        assert memory(["a", "bb", "a", "ccc"]) == [1, 2, 1, 3]
    assert memory("xyz" * 2) == [1] * 6
    assert len(memory.known) <= 2 * memory.most and asked.count("a") == 1


def test_training_and_scoring_go_by_the_same_stated_length(spark):
    """Texts alike, told apart by what metadata says of their length alone."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(NEUTRAL, k=9)), 5.0 if i % 2 else 4000.0, i) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stated double, n long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    sample = labelled_sample(docs, labels, "quality", 5, 0, 1000, also={"characters": F.col("stated")})
    assert sample.columns == ["text", "characters", "label"]
    score = quality_fm.score(F.col("text"), quality_fm.fit(sample), F.col("stated"))
    found = docs.select("doc_id", score.alias("s")).collect()
    assert all((r["s"] > 0.5) == bool(r["doc_id"] % 2) for r in found)
