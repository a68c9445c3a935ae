"""One query per corpus operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import (
    chat_repair,
    curriculum,
    mean_search,
    packing,
    personal_data,
    prefix_trie,
    quality_fm,
    quality_rules,
    rp_forest,
    secrets,
    simhash,
    toxicity,
    url_rules,
)
from gaugeline.llm.common import table
from gaugeline.llm.labelled import held_out, labelled_sample
from gaugeline.llm.oracles import ORACLES
from gaugeline.llm.stages import TOKENIZER, TOXIC_FOLD, TOXIC_FROM

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
__all__ = ["ORACLES", "QUERIES"]

# Divisor and remainder of the held-out fold, and the score from which a text is labelled 1.
QUALITY_FOLD, QUALITY_FROM = (5, 0), 0.3


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


@query
def op2_quality_factorisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    divisor, held = QUALITY_FOLD
    characters = F.col("n_chars").cast("double")
    sample = labelled_sample(
        docs, labels, "quality", divisor, held, quality_fm.LABELLED, also={"characters": characters}
    )
    scored = docs.select(
        "doc_id",
        held_out(F.col("doc_id"), divisor, held).alias("held_out"),
        quality_fm.score(F.col("text"), quality_fm.fit(sample), characters).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_FROM).cast("int"))


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


# Stated rules by host and path.
URL_RULES = (
    url_rules.Rule("com", "/", "allow"),
    url_rules.Rule("example.com", "/en/", "block"),
    url_rules.Rule("www.example.com", "/en/", "allow"),
    url_rules.Rule("net", "/es/", "block"),
    url_rules.Rule("net", "/fr/", "block"),
)
# Two thirds of the stated verdicts are ``block``, so a rule must be much surer than that.
URL_CONFIDENCE = 0.95


@query
def op4_url_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are the verdicts of the stated rules on pages they fit; the rules' own tokens teach nothing."""
    pages = table(spark, sf_dir, "pages")
    judged = url_rules.judge(
        pages,
        url_rules.stated_labels(pages, URL_RULES),
        URL_RULES,
        confidence=URL_CONFIDENCE,
        without=url_rules.named_tokens(URL_RULES),
    )
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op5_chat_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(table(spark, sf_dir, "conversations"))


@query
def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.mix(table(spark, sf_dir, "documents"))
    return mixed.withColumns(
        {
            "first_position": F.round(F.get("positions", 0), 6),
            "second_position": F.round(F.get("positions", 1), 6),
        }
    ).drop("positions", "source", "copies")


@query
def op7_random_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return rp_forest.nearest(vectors, F.col("vec_id") % 50 == 0)


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *[f"measures.{c}" for c in base], "base_failed", "kept")


@query
def op9_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    divisor, held = TOXIC_FOLD
    sample = labelled_sample(docs, labels, "toxic", divisor, held, toxicity.LABELLED)
    scored = docs.select(
        "doc_id",
        held_out(F.col("doc_id"), divisor, held).alias("held_out"),
        toxicity.score(F.col("text"), toxicity.fit(sample)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


@query
def op10_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.trie(table(spark, sf_dir, "conversations")).nodes
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


@query
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal_data.digest(personal_data.scan(docs, personal_data.fit(docs)))


@query
def op13_mean_search_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_search.digest(mean_search.cluster(table(spark, sf_dir, "embeddings")))
