"""The operators as pipeline stages: documents in, documents out, whatever columns they have.

A stage decides over narrow rows, told apart by id and text (and source, where it matters), and takes its
decision back to the documents once. Rows that agree in these are one document to a stage that joins.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.llm import curriculum, packing, secrets, simhash, toxicity
from gaugeline.llm.common import fresh, table, text_key
from gaugeline.llm.labelled import labelled_sample

TOKENIZER = "word_bpe_49k.json"

# Divisor and remainder of the fold that teaches nothing, and the score that rejects.
TOXIC_FOLD, TOXIC_FROM = (3, 1), 0.7


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _with_decision(
    docs: DataFrame, decisions: DataFrame, value: str, by: tuple[str, ...] = ()
) -> tuple[DataFrame, str]:
    """Documents that ``decisions`` (doc_id, text_key, ``by``, value) has, once each, with the value."""
    key, doc_id, other, turn, out = (
        fresh(docs, c) for c in ("text_key", "decided_id", "decided_key", "turn", "decided")
    )
    more = {c: fresh(docs, f"decided_{c}") for c in by}
    right = decisions.select(
        F.col("doc_id").alias(doc_id),
        F.col("text_key").alias(other),
        *[F.col(c).alias(name) for c, name in more.items()],
        F.col(value).alias(out),
    )
    keyed = docs.withColumn(key, text_key(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.col(key) == F.col(other))
    for c, name in more.items():
        same &= F.col(c).eqNullSafe(F.col(name))
    joined = keyed.join(right, same)
    # Sorted by the join already; rows that agree in these columns are one document to the decision.
    first = F.row_number().over(Window.partitionBy("doc_id", key, *by).orderBy(F.lit(0)))
    once = joined.withColumn(turn, first).where(F.col(turn) == 1)
    return once.select(*_columns(docs), F.col(out)), out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that score as toxic go. Learns from the labels of ``sf_dir``.

    Every row is scored by its text alone, a null text as an empty one, and stays or goes by itself.
    """
    labels = table(spark, sf_dir, "labels")
    sample = labelled_sample(docs, labels, "toxic", *TOXIC_FOLD, toxicity.LABELLED)
    score = toxicity.score(F.col("text"), toxicity.fit(sample))
    return docs.where(score < TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each component the document with its smallest id stays.

    If several rows have that id, one of them stays; of documents without an id that are linked
    to none with one, a single one stays.
    """
    found = simhash.near_duplicates(docs)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # By component and id: one id can lead several components if its rows have several texts.
    one = F.min("text_key").alias("text_key")
    stays = first.groupBy("doc_id", "root").agg(one).withColumn("stays", F.lit(True))
    return _with_decision(docs, stays, "stays")[0].select(*_columns(docs))


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every reported span is replaced by a mark; no document goes.

    Null texts stay null, and rows without spans as they are, repeated or not; an empty table stays empty.
    """
    clean = secrets.redact(docs, secrets.scan(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: every document as often as the mix takes it, in training order.

    Documents the mix leaves out go, and so do those without a word. Rows that repeat an id, a text and a
    source are one document of one size; it is taken as often as the mix takes all of them. Null
    ids and sources are told apart like others; an empty table stays empty.
    """
    mixed = curriculum.mix(docs, keep=["text_key"]).where(F.size("positions") > 0)
    taken = mixed.groupBy("doc_id", "text_key", "source").agg(F.flatten(F.collect_list("positions")).alias("positions"))
    placed, positions = _with_decision(docs, taken, "positions", by=("source",))
    position = fresh(docs, "position")
    copies = placed.select(*_columns(docs), F.explode(positions).alias(position))
    return copies.orderBy(position, "doc_id").select(*_columns(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the place of every piece of every document in the training sequences.

    Documents come in training order in the files of the stage before, and sequences follow it window by
    window. Null texts are empty, null ids and repeated rows documents like any other; an
    empty table has no sequences.
    """
    return packing.pack_in_order(docs, public_tokenizers.path(TOKENIZER))
