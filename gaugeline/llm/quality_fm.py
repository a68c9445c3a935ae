"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

The score is a constant, a weight per feature, and for every pair of features the product of
two short vectors. Pairs need no loop: over a text's features ``x`` with vectors ``v``, the sum of
all pairs is half of (sum of ``v x``) squared minus the sum of (``v x``) squared, one pass over the
features for each of the few dimensions.

Features are the distinct words of a text, hashed, with a common length of one; shares and
sizes that describe its structure; and, where a table has them, columns of numbers about the
text. It is trained on a bounded sample of labelled texts and scores whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.labelled import Remembered

LABELLED = 6000  # labelled texts at most
BUCKETS = 1 << 13
RANK = 4
EPOCHS = 12
BATCH = 64
RATE = 0.02
DECAY = 1e-4
CLIP = 4.0

SYMBOLS = "#*$%&|<>"
STRUCTURE = (
    "words", "word_length", "symbols", "exclamations", "stops", "digits", "capitals",
    "distinct", "repeated_triples", "lines", "repeated_lines", "characters",
)


def structure(text: str, words: list[str], distinct: set[str], characters: float) -> list[float]:
    """The numbers named in ``STRUCTURE``; a text without words has zero shares."""
    n = max(len(words), 1)
    triples = max(len(words) - 2, 1)
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    some = max(len(lines), 1)
    return [
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        np.log1p(10 * sum(map(text.count, SYMBOLS)) / n),
        np.log1p(10 * text.count("!") / n),
        text.count(".") / n,
        np.log1p(10 * sum(map(text.count, "0123456789")) / n),
        sum(map(str.isupper, distinct)) / max(len(distinct), 1),
        len(distinct) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / triples if len(words) > 2 else 0.0,
        np.log1p(len(lines)),
        1 - len(set(lines)) / some if lines else 0.0,
        np.log1p(max(characters, 0.0)),
    ]


def _bucket(word: str) -> int:
    return crc32(word.encode()) % BUCKETS


class _Reader:
    """Texts to hashed words and structure."""

    def __init__(self):
        self.bucket = Remembered(_bucket)

    def __call__(self, text: str, characters: float | None) -> tuple[np.ndarray, list[float]]:
        words = text.split()
        distinct = set(words)
        size = float(len(text)) if characters is None or characters != characters else float(characters)
        buckets = np.unique(np.array(self.bucket(distinct), dtype=np.int32))
        return buckets, structure(text, words, distinct, size)


class Model(NamedTuple):
    """``weight`` and ``vector`` hold the buckets, then the structure, which is standardised first."""

    bias: float
    weight: np.ndarray
    vector: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def features(self, buckets: np.ndarray, numbers: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
        dense = np.clip((np.asarray(numbers) - self.mean) / self.spread, -CLIP, CLIP)
        places = np.concatenate([buckets, BUCKETS + np.arange(len(dense))])
        words = np.full(len(buckets), 1 / np.sqrt(max(len(buckets), 1)))
        return places, np.concatenate([words, dense])

    def raw(self, places: np.ndarray, values: np.ndarray) -> float:
        scaled = self.vector[places] * values[:, None]
        pairs = 0.5 * (scaled.sum(axis=0) ** 2 - (scaled**2).sum(axis=0)).sum()
        return float(self.bias + self.weight[places] @ values + pairs)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def train(buckets: list[np.ndarray], numbers: list[Sequence[float]], labels: Sequence[int]) -> Model:
    """Adam on the logistic loss, in small batches, from a fixed seed."""
    y = np.asarray(labels, dtype=float)
    table = np.asarray(numbers, dtype=float).reshape(len(y), len(STRUCTURE))
    rate = (y.sum() + 1) / (len(y) + 2)
    width = BUCKETS + len(STRUCTURE)
    rng = np.random.default_rng(0)
    mean = table.mean(axis=0) if len(y) else np.zeros(len(STRUCTURE))
    spread = np.maximum(table.std(axis=0), 1e-6) if len(y) else np.ones(len(STRUCTURE))
    vector = rng.normal(0, 0.02, (width, RANK))
    model = Model(float(np.log(rate / (1 - rate))), np.zeros(width), vector, mean, spread)
    if not 0 < y.sum() < len(y):
        return model._replace(vector=np.zeros((width, RANK)))
    rows = [model.features(b, n) for b, n in zip(buckets, numbers)]
    params = np.hstack([model.weight[:, None], vector])  # a feature's weight, then its vector
    bias = model.bias
    first, second = np.zeros_like(params), np.zeros_like(params)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            chosen = order[at : at + BATCH]
            places = np.concatenate([rows[i][0] for i in chosen])
            values = np.concatenate([rows[i][1] for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), [len(rows[i][0]) for i in chosen])
            starts = np.searchsorted(owner, np.arange(len(chosen)))
            scaled = params[places, 1:] * values[:, None]
            sums = np.add.reduceat(scaled, starts)
            squares = np.add.reduceat(scaled**2, starts)
            linear = np.add.reduceat(params[places, 0] * values, starts)
            raw = bias + linear + 0.5 * (sums**2 - squares).sum(axis=1)
            error = (_sigmoid(raw) - y[chosen]) / len(chosen)
            slope = (error[owner] * values)[:, None]
            each = np.hstack([slope, slope * (sums[owner] - scaled)])
            used, back = np.unique(places, return_inverse=True)
            grad = np.stack(
                [np.bincount(back, each[:, k], minlength=len(used)) for k in range(RANK + 1)], axis=1
            )
            grad += DECAY * params[used]
            step += 1
            first[used] = 0.9 * first[used] + 0.1 * grad
            second[used] = 0.999 * second[used] + 0.001 * grad**2
            moved = first[used] / (1 - 0.9**step)
            params[used] -= RATE * moved / (np.sqrt(second[used] / (1 - 0.999**step)) + 1e-8)
            bias -= RATE * error.sum()
    return Model(float(bias), params[:, 0].copy(), params[:, 1:].copy(), mean, spread)


def _examples(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    read = _Reader()
    for part in parts:
        sizes = part["characters"] if "characters" in part else [None] * len(part)
        found = [read(text, size) for text, size in zip(part["text"], sizes)]
        yield pd.DataFrame(
            {"label": part["label"], "buckets": [b.tolist() for b, _ in found], "numbers": [n for _, n in found]}
        )


def fit(labelled: DataFrame) -> Model:
    """Train on ``labelled`` (text, label), a stored sample of bounded size. Without texts of both
    labels every score is the share of good texts, one half if there are none.

    A column ``characters`` has the stated lengths if scores are to go by stated lengths."""
    shape = "label int, buckets array<int>, numbers array<double>"
    rows = labelled.mapInPandas(_examples, shape).collect()
    rows.sort(key=lambda r: (r["label"], r["numbers"], r["buckets"]))  # whatever the order of tasks
    buckets = [np.array(r["buckets"], dtype=np.int32) for r in rows]
    return train(buckets, [r["numbers"] for r in rows], [r["label"] for r in rows])


def score(text: Column, model: Model, characters: Column | None = None) -> Column:
    """The score of whole texts, 0 to 1, higher for good ones.

    ``characters`` is the length that metadata states; where it is absent or null, the text is
    measured. A null text is empty, and an empty one scores by its structure alone.
    """

    @F.pandas_udf("double")
    def of(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        read = _Reader()
        for texts, sizes in parts:
            raws = [model.raw(*model.features(*read(t, c))) for t, c in zip(texts, sizes)]
            yield pd.Series(_sigmoid(np.array(raws, dtype=float)))

    stated = F.lit(None) if characters is None else characters
    return of(F.coalesce(text, F.lit("")), stated.cast("double"))
