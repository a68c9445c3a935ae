"""Bounded samples of labelled documents, and a bounded memory of words."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Generic, TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import remainder, stored

T = TypeVar("T")

LONGEST = 32  # characters of a remembered word


class Remembered(Generic[T]):
    """``ask(word)`` for words asked before, in this turn of ``most`` words or the one before.

    Words above ``LONGEST`` characters are asked each time.
    """

    def __init__(self, ask: Callable[[str], T], most: int = 60_000):
        self.ask, self.most = ask, most
        self.known: dict[str, T] = {}
        self.before: dict[str, T] = {}

    def recall(self, word: str) -> T:
        answer = self.known.get(word)
        if answer is None:
            answer = self.before.get(word)
            answer = self.ask(word) if answer is None else answer
            if len(word) <= LONGEST:
                self.known[word] = answer
        return answer

    def __call__(self, words) -> list[T]:
        if len(self.known) >= self.most:
            self.known, self.before = {}, self.known
        words = list(words)
        found = list(map(self.known.get, words))
        if None in found:
            for i, answer in enumerate(found):
                if answer is None:
                    found[i] = self.recall(words[i])
        return found


def held_out(doc_id: Column, divisor: int, held: int) -> Column:
    return remainder(doc_id, divisor) == held


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    divisor: int,
    held: int,
    bound: int,
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """text and label (0 or 1) of at most ``bound`` documents outside the held-out fold, stored.

    ``also`` names more columns of the documents that come with the text.

    Labels are taken in the order of the hash of their id, so a rerun takes the same. Null labels
    and ids do not count; of repeated labels the larger holds, of repeated documents the
    smaller text. A null text is empty.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    once = usable.groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("label"))
    learnt = once.where(~held_out(F.col("doc_id"), divisor, held))
    sample = learnt.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    told = {"text": F.coalesce("text", F.lit(""))} | dict(also or {})
    texts = docs.select(F.col("doc_id").alias("doc_id"), *[c.alias(name) for name, c in told.items()])
    # The sample has at most ``bound`` ids.
    joined = texts.join(F.broadcast(sample), "doc_id")
    one = joined.groupBy("doc_id").agg(F.min(F.struct(*told)).alias("told"), F.max("label").alias("label"))
    return stored(one.select("told.*", "label"), "labelled")
