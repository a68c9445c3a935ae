"""Secret scan with corpus-wide ownership frequency, in built-in functions only.

Patterns find candidates in every text, and a candidate's value is looked up in the whole
corpus: the distinct repositories and owners that hold it are counted. A value that many
owners share is a copied example, one that a single owner holds is live-looking. Patterns
of the base always report their spans; weaker patterns report a span only if its value
looks random and belongs to few owners.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import fresh, let, stored, text_key


class Kind(NamedTuple):
    """``group`` holds the value, which has ``least`` characters or the match is dropped."""

    name: str
    pattern: str
    group: int
    least: int


# Fixed values, in the order in which kinds are listed. The last two could as well match
# shorter runs and drop them: such a run holds no other match.
BASE: tuple[Kind, ...] = (
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Kind("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24),
)

# Shapes of credentials that only their owner has.
WEAK: tuple[Kind, ...] = (
    Kind("prefixed", r"\b(?:gh[pousr]_|glpat-|xox[abprs]-|sk-|sk_live_|AIza)[A-Za-z0-9_-]{16,}", 0, 20),
    Kind("signed", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 28),
    Kind("private", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]{40,}", 0, 64),
    Kind("login", r"://[^\s/:@]{1,64}:([^\s/:@]{6,128})@", 1, 6),
    Kind("random", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])", 0, 32),
)

# A value held by this many owners is an example, not a secret of one of them.
WIDELY = 3

# Values are stored as hashes, never in clear.
SPAN = "struct<start:int,kind:int,end:int,value_sha:string,random:boolean>"
FOUND = "struct<start:int,kind:int,end:int,value:string>"

SALTS = 8  # tasks over which the spans of one value are dealt


def _found(text: Column, kind: int, of: Kind) -> Column:
    """All matches of a pattern as spans, in code points, end exclusive.

    What lies between matches comes from splitting at the pattern; the lengths of both, added
    up, are the places.
    """

    def placed(matches: Column) -> Column:
        def spans(between: Column) -> Column:
            def add(acc: Column, i: Column) -> Column:
                start = acc["at"] + F.length(F.get(between, i))
                end = start + F.length(F.get(matches, i))
                match = F.get(matches, i)
                value = F.regexp_extract(match, of.pattern, of.group) if of.group else match
                span = F.struct(
                    start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value.alias("value")
                )
                return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

            none = F.array().cast(f"array<{FOUND}>")
            start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
            turns = F.sequence(F.lit(0), F.size(matches) - 1)
            return F.aggregate(turns, start, add, lambda acc: acc["spans"])

        return F.when(F.size(matches) > 0, let(F.split(text, of.pattern, -1), spans))

    spans = let(F.regexp_extract_all(text, F.lit(of.pattern), F.lit(0)), placed)
    long_enough = F.filter(spans, lambda s: F.length(s["value"]) >= of.least)
    hashed = F.transform(
        long_enough,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["kind"].alias("kind"),
            s["end"].alias("end"),
            F.sha2(s["value"], 256).alias("value_sha"),
            _looks_random(s["value"]).alias("random"),
        ),
    )
    return F.coalesce(hashed, F.array().cast(f"array<{SPAN}>"))


def _looks_random(value: Column) -> Column:
    """Digits, upper and lower case letters, with a change between letters and digits often."""
    changes = F.regexp_count(value, F.lit(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])"))
    return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]") & (changes >= 4)


def _written(spans: Column, kinds: Sequence[Kind]) -> Column:
    names = F.array(*[F.lit(k.name) for k in kinds])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def candidates(
    docs: DataFrame, repository: Column, owner: Column, kinds: Sequence[Kind], text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text key, repository, owner, spans by start and kind."""
    some = F.coalesce(F.col(text), F.lit(""))
    spans = [_found(some, i, kind) for i, kind in enumerate(kinds)]
    return docs.select(
        F.col("doc_id").alias("doc_id"),
        text_key(F.col(text)).alias("text_key"),
        repository.alias("repository"),
        owner.alias("owner"),
        F.sort_array(F.concat(*spans)).alias("spans"),
    )


def ownership(found: DataFrame) -> DataFrame:
    """value_sha, repositories, owners: how many distinct ones hold a value. Null is one of them.

    Equal triples merge before anything is counted, so a value copied into a third of all
    documents costs its task a row per repository.
    """
    held = found.select(
        F.explode("spans").alias("span"),
        "repository",
        "owner",
    ).select("span.value_sha", "repository", "owner")
    once = held.groupBy("value_sha", "owner", "repository").agg(F.lit(1).alias("n"))
    by_owner = once.groupBy("value_sha", "owner").agg(F.sum("n").alias("n"))
    return by_owner.groupBy("value_sha").agg(
        F.sum("n").alias("repositories"), F.count("*").alias("owners")
    )


def scan(
    docs: DataFrame,
    repository: Column | None = None,
    owner: Column | None = None,
    weak: Sequence[Kind] = WEAK,
    widely: int = WIDELY,
    text: str = "text",
) -> DataFrame:
    """Spans of every document: doc_id, text_key, base, added, spans, n_live, n_examples.

    ``base`` holds the spans of the base kinds, ``added`` those of weaker kinds that look live,
    ``spans`` both, by start and kind. ``n_live`` and ``n_examples`` count the spans whose value
    fewer, or at least, ``widely`` owners hold. An owner is a source and a repository a language
    of a source unless other columns are given.

    Texts are scanned once and the candidates stored, with hashes in place of values. A null text counts as empty and has no
    spans; a document without spans has empty arrays. Rows with equal id and text are scanned
    alike and each is returned. Null ids, sources and extra columns are allowed.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.struct("source", "lang") if repository is None else repository
    kinds = [*BASE, *weak]
    found = stored(candidates(docs, repository, owner, kinds, text), "candidates")
    some = found.where(F.size("spans") > 0)
    rows = some.select("doc_id", "text_key", "spans").distinct()
    spans = rows.select("doc_id", "text_key", F.explode("spans").alias("span"))
    # A value in a third of all documents meets its owners in several tasks.
    salt = F.pmod(F.xxhash64("doc_id", "text_key", "span.start"), F.lit(SALTS))
    spans = spans.withColumn("value_sha", F.col("span.value_sha")).withColumn("salt", salt)
    held = ownership(some).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = spans.join(held, ["value_sha", "salt"])
    live = F.col("owners") < widely
    reported = (F.col("span.kind") < len(BASE)) | (live & F.col("span.random"))
    judged = (
        known.where(reported)
        .groupBy("doc_id", "text_key")
        .agg(
            F.sort_array(F.collect_list("span")).alias("spans"),
            F.count_if(live).alias("n_live"),
            F.count_if(~live).alias("n_examples"),
        )
    )
    left = found.select("doc_id", "text_key").alias("l")
    same = F.expr("l.doc_id <=> r.doc_id AND l.text_key = r.text_key")
    none = F.array().cast(f"array<{SPAN}>")
    joined = left.join(judged.alias("r"), same, "left").select(
        "l.doc_id",
        "l.text_key",
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_examples", F.lit(0)).alias("n_examples"),
    )
    is_base = lambda s: s["kind"] < len(BASE)
    return joined.select(
        "doc_id",
        "text_key",
        F.filter("spans", is_base).alias("base"),
        F.filter("spans", lambda s: ~is_base(s)).alias("added"),
        "spans",
        "n_live",
        "n_examples",
    )


def digest(scanned: DataFrame, weak: Sequence[Kind] = WEAK) -> DataFrame:
    """Counts per base kind, a checksum of the base spans, and all spans as text."""
    kinds = [*BASE, *weak]

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(
        "doc_id",
        *[count(i).alias(f"n_{kind.name}") for i, kind in enumerate(BASE)],
        F.sha2(_written(F.col("base"), kinds), 256).alias("base_sha256"),
        _written(F.col("spans"), kinds).alias("spans"),
        "n_live",
        "n_examples",
    )


def redact(docs: DataFrame, scanned: DataFrame, mark: str = "[secret]", text: str = "text") -> DataFrame:
    """``docs`` with every reported span replaced by ``mark``; overlapping spans are one.

    All columns stay; rows and texts without spans are returned as they are.
    """

    def merge(acc: Column, span: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))),
        )
        one = F.array(F.struct(span["start"].alias("start"), span["end"].alias("end")))
        overlaps = (F.size(acc) > 0) & (span["start"] <= F.try_element_at(acc, F.lit(-1))["end"])
        return F.when(overlaps, joined).otherwise(F.concat(acc, one))

    def cut(whole: Column, merged: Column) -> Column:
        def piece(span: Column, i: Column) -> Column:
            before = F.coalesce(F.get(merged, i - 1)["end"], F.lit(0))
            return F.concat(F.substring(whole, before + 1, span["start"] - before), F.lit(mark))

        rest = F.substring(whole, F.element_at(merged, -1)["end"] + 1, F.length(whole))
        return F.concat(F.array_join(F.transform(merged, piece), ""), rest)

    spans, key, doc_id, own_key = (fresh(docs, c) for c in ("spans", "span_key", "span_doc", "text_key"))
    hits = (
        scanned.where(F.size("spans") > 0)
        .select(F.col("doc_id").alias(doc_id), F.col("text_key").alias(key), F.col("spans").alias(spans))
        .dropDuplicates([doc_id, key])
    )
    keyed = docs.withColumn(own_key, text_key(F.col(text)))
    same = F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.col(own_key) == F.col(key))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    merged = F.aggregate(spans, empty, merge)
    clean = F.when(F.col(spans).isNotNull(), let(merged, lambda m: cut(F.col(text), m))).otherwise(F.col(text))
    joined = keyed.join(hits, same, "left").withColumn(text, clean)
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
