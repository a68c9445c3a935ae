"""Toxicity: a logistic classifier trained not to react to who a sentence is about.

Features are the words of a text and the beginnings of longer words, each present or not, so
one sentence tells in a long text. A bounded sample of labelled texts is counted on Spark, the
features that tell the labels apart are selected, and their weights are trained. Besides the
usual loss, every labelled sentence that names a group is paired with the same sentence
about another group, and the squared change of its score, before it is squeezed between 0 and 1, is
penalised: a group that is merely often insulted in the sample gets no weight of its own. Texts
that name no group teach this too: one sentence of each is paired with itself, with a term put in
on one side and its swap on the other. The terms are features whether or not they tell labels apart.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import stored
from gaugeline.llm.labelled import Remembered

LABELLED = 8000  # labelled texts at most
FEATURES = 4096  # selected features at most
SUPPORT = 4  # labelled texts that have a feature at least
EVIDENCE = 24.0  # likelihood ratio statistic of a selected feature at least
BEGINNINGS = (4, 5, 6)
STEPS = 400
RATE = 0.1
DECAY = 1e-5
DROPPED = 0.6  # share of features left out in each training step
COUNTERFACTUAL = 1.0

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’¡¿…"
SENTENCE = re.compile(r"[^.!?\n]+")

# Terms that a swap exchanges for the next of their row.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("female", "male"),
    ("gay", "straight"),
    ("lesbian", "heterosexual"),
    ("transgender", "cisgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("african", "european", "american", "arab", "mexican", "chinese"),
    ("immigrants", "natives", "refugees", "citizens"),
    ("disabled", "blind", "deaf"),
    ("old", "young"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus"),
    ("schwarze", "weiße"),
    ("ausländer", "einheimische", "flüchtlinge"),
    ("türken", "polen", "deutsche", "araber"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("filles", "garçons"),
    ("musulmans", "chrétiens", "juifs"),
    ("noirs", "blancs", "arabes"),
    ("immigrés", "réfugiés", "citoyens"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("niñas", "niños"),
    ("musulmanes", "cristianos", "judíos"),
    ("negros", "blancos", "gitanos"),
    ("inmigrantes", "refugiados", "ciudadanos"),
)


def _swaps() -> dict[str, str]:
    return {term: row[(i + 1) % len(row)] for row in IDENTITY_TERMS for i, term in enumerate(row)}


def _features(word: str) -> list[str]:
    """A word without punctuation around it, and its beginnings, marked by a trailing blank."""
    bare = word.strip(PUNCTUATION)
    return ([bare] if bare else []) + [bare[:n] + " " for n in BEGINNINGS if len(bare) > n]


def words_of(text: str) -> set[str]:
    return set(text.lower().split())


class Model(NamedTuple):
    """``pairs`` says how many sentences were swapped."""

    bias: float
    weights: dict[str, float]
    pairs: int = 0


def _count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    features = Remembered(_features)
    for part in parts:
        counts = (Counter(), Counter())
        for text, label in zip(part["text"], part["label"]):
            counts[label].update({f for found in features(words_of(text)) for f in found})
        both = sorted(counts[0].keys() | counts[1].keys())
        columns = {"feature": both, "toxic": [counts[1][f] for f in both], "clean": [counts[0][f] for f in both]}
        yield pd.DataFrame(columns)


def _evidence(toxic: Column, clean: Column, all_toxic: int, all_clean: int) -> Column:
    """The likelihood ratio statistic of having a feature against the label."""
    n = all_toxic + all_clean
    having = toxic + clean

    def term(seen: Column, row: Column, column: int) -> Column:
        return F.when(seen > 0, seen * F.log(seen * n / (row * column))).otherwise(0.0)

    lacking = F.lit(n) - having
    return 2 * (
        term(toxic, having, all_toxic)
        + term(clean, having, all_clean)
        + term(F.lit(all_toxic) - toxic, lacking, all_toxic)
        + term(F.lit(all_clean) - clean, lacking, all_clean)
    )


def _vectors(selected: dict[str, int]):
    """Selected features of each labelled text, and of its sentences that a swap changes."""
    swaps = _swaps()

    def numbers(words: set[str]) -> list[int]:
        return sorted({selected[f] for w in words for f in _features(w) if f in selected})

    terms = sorted(swaps)

    def pair(words: set[str], others: set[str]) -> tuple[list[int], list[int]] | None:
        """Features of one side only: what both have changes no difference of scores."""
        own, other = set(numbers(words)), set(numbers(others))
        return None if own == other else (sorted(own - other), sorted(other - own))

    def vectors(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text, label in zip(part["text"], part["label"]):
                rows.append((0, label, numbers(words_of(text)), []))
                named, plain = False, None
                for sentence in SENTENCE.findall(text.lower()):
                    words = {w.strip(PUNCTUATION) for w in sentence.split()}
                    if not words.isdisjoint(swaps):
                        named = True
                        if found := pair(words, {swaps.get(w, w) for w in words}):
                            rows.append((1, label, *found))
                    elif words and plain is None:
                        plain = words
                if not named and plain:
                    term = terms[crc32(text.encode()) % len(terms)]
                    if found := pair(plain | {term}, plain | {swaps[term]}):
                        rows.append((1, label, *found))
            yield pd.DataFrame(rows, columns=["swapped", "label", "own", "other"])

    return vectors


class _Rows:
    """Rows of present features, as pairs of row and feature."""

    def __init__(self, lists, width: int):
        self.n, self.width = len(lists), width
        self.row = np.repeat(np.arange(self.n), [len(x) for x in lists])
        self.feature = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists] or [np.zeros(0, np.int64)])

    def thinned(self, rng: np.random.Generator) -> _Rows:
        """The same rows with part of their features left out."""
        thin = _Rows([], self.width)
        keep = rng.random(len(self.feature)) >= DROPPED
        thin.n, thin.row, thin.feature = self.n, self.row[keep], self.feature[keep]
        return thin

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.feature], minlength=self.n)

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.feature, errors[self.row], minlength=self.width)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def train(
    rows: list,
    labels: list,
    own: list,
    other: list,
    width: int,
    counterfactual: float = COUNTERFACTUAL,
    times: list | None = None,
) -> tuple[float, np.ndarray]:
    """Bias and weights. ``own`` and ``other`` are the sides of each pair, which ``times`` sentences make.

    Toxic texts tend to hold many telling features. Leaving most out at random makes each weigh
    enough to tell alone.
    """
    rng = np.random.default_rng(0)
    texts, own_rows, other_rows = _Rows(rows, width), _Rows(own, width), _Rows(other, width)
    share = np.asarray([1] * len(own) if times is None else times, dtype=float)
    share /= max(share.sum(), 1.0)
    y = np.asarray(labels, dtype=float)
    rate = (y.sum() + 1) / (len(y) + 2)
    # Both labels weigh alike, so a rare one is not scored low throughout.
    cost = np.where(y > 0, 0.5 / rate, 0.5 / (1 - rate)) / max(len(y), 1)
    params = np.zeros(width + 1)
    params[-1] = np.log(rate / (1 - rate))
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        weights, bias = params[:-1], params[-1]
        thin = texts.thinned(rng)
        error = cost * (_sigmoid(bias + thin.sums(weights)) - y)
        grad = np.append(thin.back(error) + DECAY * weights, error.sum())
        if own_rows.n:
            change = (own_rows.sums(weights) - other_rows.sums(weights)) * share
            change *= 2 * counterfactual
            grad += np.append(own_rows.back(change) - other_rows.back(change), 0.0)
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        params -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return float(params[-1]), params[:-1]


def fit(labelled: DataFrame, counterfactual: float = COUNTERFACTUAL) -> Model:
    """Train on ``labelled`` (text, label), a stored sample of bounded size.

    Without texts of both labels there is nothing to tell apart: every score is the share of
    toxic texts, one half if there are none at all.
    """
    sizes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return Model(float(np.log((toxic + 1) / (clean + 1))), {})
    counted = labelled.mapInPandas(_count, "feature string, toxic long, clean long")
    summed = counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    evidence = _evidence(F.col("toxic"), F.col("clean"), toxic, clean)
    told = (
        summed.where(F.col("toxic") + F.col("clean") >= SUPPORT)
        .withColumn("evidence", evidence)
        .where(F.col("evidence") >= EVIDENCE)
        .orderBy(F.desc("evidence"), "feature")
        .limit(FEATURES)
    )
    telling = [r["feature"] for r in told.select("feature").collect()]
    selected = {f: i for i, f in enumerate(dict.fromkeys([*telling, *sorted(_swaps())]))}
    shape = "swapped int, label int, own array<int>, other array<int>"
    found = stored(labelled.mapInPandas(_vectors(selected), shape), "vectors")
    texts = found.where("swapped = 0").orderBy("own", "label").collect()  # the sample is bounded
    # What differs between the sides are a few terms, so equal differences are many.
    pairs = found.where("swapped = 1").groupBy("own", "other").agg(F.count("*").alias("n"))
    pairs = pairs.orderBy("own", "other").collect()
    bias, weights = train(
        [r["own"] for r in texts],
        [r["label"] for r in texts],
        [r["own"] for r in pairs],
        [r["other"] for r in pairs],
        len(selected),
        counterfactual,
        [r["n"] for r in pairs],
    )
    return Model(bias, {f: float(weights[i]) for f, i in selected.items()}, sum(r["n"] for r in pairs))


def score(text: Column, model: Model) -> Column:
    """The score of whole texts, 0 to 1; a null text is empty and scores as one without features."""

    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = model.weights
        found = Remembered(lambda word: tuple(f for f in _features(word) if f in weights))
        for part in parts:
            sums = [
                sum(weights[f] for f in sorted({f for hit in found(words_of(t)) if hit for f in hit}))
                for t in part
            ]
            yield pd.Series(_sigmoid(model.bias + np.array(sums, dtype=float)))

    return of(F.coalesce(text, F.lit("")))
