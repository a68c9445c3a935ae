"""URL filter: stated host and path rules first, then association rules mined from labels.

The tokens of a labelled URL are a basket. FP-growth finds the combinations that occur often enough
in bad ones; those that imply the bad label with enough confidence, and more than any
part of them, become rules. An inverted index holds every rule under its rarest token, so a
URL meets only rules it has that token of.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import let, stored

SUPPORT = 0.001  # share of the labelled URLs that have a combination, at least
FEWEST = 20  # labelled URLs that have it, at least
CONFIDENCE = 0.6  # share of those with the bad label, at least

LONGEST = 12  # items of a URL that FP-growth takes, at most (4,095 combinations); longer ones are mined level by level

SALTS = 8  # tasks over which rows with one key are dealt
EPSILON = 1e-9

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """Holds for a host and its subdomains, below a path."""

    host: str
    path: str
    verdict: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    """Empty for a null url and one without ``://``."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def stated(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    longest = sorted(rules, key=lambda r: (-len(r.host + r.path), r))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(longest):
        told = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(_fits(rule, host, path), told).otherwise(found)
    return found


def tokens(url: Column) -> Column:
    """Distinct tokens: scheme, labels of the host from its end, parts of the path, ending, keys.

    Numbers in a path are one token, whatever their digits. A url without ``://`` has none.
    """

    def of(rest: Column) -> Column:
        labels = F.filter(F.split(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), r"\."), lambda x: x != "")
        path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
        parts = F.transform(
            F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.regexp_replace(x, "[0-9]+", "0")
        )
        keys = F.filter(
            F.split(F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1), "&"), lambda x: x != ""
        )
        marked = [
            F.array(F.concat(F.lit("scheme "), F.lower(F.substring_index(url, "://", 1)))),
            F.transform(labels, lambda x: F.concat(F.lit("host "), x)),
            F.transform(parts, lambda x: F.concat(F.lit("path "), x)),
            F.transform(keys, lambda x: F.concat(F.lit("key "), F.substring_index(x, "=", 1))),
        ]
        return F.when(rest != "", F.sort_array(F.array_distinct(F.concat(*marked))))

    return F.coalesce(let(_after_scheme(url), of), F.array().cast("array<string>"))


def named_tokens(rules: Sequence[Rule]) -> list[str]:
    """The tokens that the hosts and paths of stated rules are made of."""
    hosts = {f"host {label}" for rule in rules for label in rule.host.split(".") if label}
    return sorted(hosts | {f"path {part}" for rule in rules for part in rule.path.split("/") if part})


def stated_labels(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """url and bad of the pages a stated rule fits: its verdict is a label of the URL."""
    url = F.col("url")
    verdict = stated(rules, host_of(url), path_of(url))["verdict"]
    return pages.select(url.alias("url"), (verdict == "block").alias("bad")).where(F.col("bad").isNotNull())


def _mined_items(baskets: DataFrame, least_bad: int, fewest: int) -> tuple[DataFrame, DataFrame]:
    """Bad baskets as (items, n), and what an item stands for: (item, members, bad_rows, good_rows).

    Tokens that too few URLs, or too few bad ones, have are in no rule. Those that the same baskets have are one
    item, so the parts of one long path are one. Items that no good URL has are sure alone and wait for no
    others, so baskets do without them.
    """
    each = baskets.select("basket", "bad", "n", F.explode("tokens").alias("token"))
    bad_rows = F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0))
    counted = each.groupBy("token").agg(
        F.sum("n").alias("seen"), bad_rows.alias("bad_rows"), F.bit_xor("basket").alias("within")
    )
    known = counted.where((F.col("seen") >= fewest) & (F.col("bad_rows") >= least_bad))
    items = known.groupBy("seen", "bad_rows", "within").agg(
        F.min("token").alias("item"), F.sort_array(F.collect_list("token")).alias("members")
    )
    items = stored(items.select("item", "members", "bad_rows", (F.col("seen") - F.col("bad_rows")).alias("good_rows")), "items")
    asked = each.where("bad").withColumn("salt", F.pmod("basket", F.lit(SALTS)))
    there = _salted(items.where(F.col("good_rows") > 0).select(F.col("item").alias("token")))
    told = asked.join(there, ["token", "salt"]).groupBy("basket", "n")
    return told.agg(F.sort_array(F.collect_list("token")).alias("items")).select("items", "n"), items


def _parts(sets: DataFrame, stands_for: DataFrame) -> DataFrame:
    """``items`` with ``part``, the tokens they stand for."""
    each = sets.select("items", F.explode("items").alias("item")).join(stands_for.select("item", "members"), "item")
    return each.groupBy("items").agg(F.array_sort(F.flatten(F.collect_list("members"))).alias("part"))


def _counted(baskets: DataFrame, parts: DataFrame) -> DataFrame:
    """``parts`` with the rows of all labelled URLs, and of the bad ones, that have all tokens."""
    bad_rows = F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0))
    found = matches(baskets, inverted(parts, "part"), "tokens", "part")
    return found.groupBy(*parts.columns).agg(F.sum("n").alias("seen"), bad_rows.alias("bad_rows"))


def _grown(long: DataFrame, stands_for: DataFrame, baskets: DataFrame, least_bad: int, good_total: int) -> DataFrame:
    """Every set of two and more items in a basket of ``long`` that can be a rule, however many items the basket has.

    An item that shuts out no good URL which the others let in leaves a rule that is no surer than the one without
    it, with whatever else comes to them, and such a rule goes in the end. So a set is grown only while each
    of its items shuts some out, and while ``least_bad`` bad URLs have it; all parts of such a set are such sets.
    """
    spark = long.sparkSession
    holders = stored(long.select(F.col("items").alias("tokens")).distinct(), "long")
    singles = stands_for.where((F.col("good_rows") > 0) & (F.col("good_rows") < good_total))
    level = stored(singles.select(F.array("item").alias("items"), "good_rows"), "level")
    grown = spark.createDataFrame([], "items array<string>")
    while True:
        held = matches(holders, inverted(level.select("items"), "items"), "tokens", "items")
        later = F.filter("tokens", lambda x: x > F.element_at("items", -1))
        wider = held.select("items", F.explode(later).alias("more")).select(F.concat("items", F.array("more")).alias("items"))
        less = wider.distinct().select("items", F.explode("items").alias("item"))
        parents = level.select(F.col("items").alias("parent"), "good_rows")
        told = less.withColumn("parent", F.array_remove("items", F.col("item"))).join(parents, "parent")
        whole = told.groupBy("items").agg(F.count("*").alias("n"), F.min("good_rows").alias("before"))
        next_ones = stored(whole.where(F.col("n") == F.size("items")).select("items", "before"), "wider")
        if next_ones.isEmpty():
            return grown
        counts = _counted(baskets, _parts(next_ones, stands_for)).join(next_ones, "items")
        counts = counts.withColumn("good_rows", F.col("seen") - F.col("bad_rows"))
        sure = (F.col("bad_rows") >= least_bad) & (F.col("good_rows") < F.col("before"))
        kept = stored(counts.where(sure).select("items", "good_rows"), "level")
        grown, level = grown.unionByName(kept.select("items")), kept.where(F.col("good_rows") > 0)


def _repeated(baskets: DataFrame) -> DataFrame:
    """Each basket as often as it occurs; one that is a large part of all leaves from many tasks."""
    at_once = 1000
    turns = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / at_once))
    chunks = baskets.select("items", "n", F.explode(turns).alias("turn"))
    spread = chunks.repartition(F.xxhash64("items", "turn"))
    times = F.least(F.lit(at_once), F.col("n") - F.col("turn") * at_once).cast("int")
    return spread.select("items", F.explode(F.sequence(F.lit(1), times))).select("items")


def mine(
    labelled: DataFrame,
    support: float = SUPPORT,
    fewest: int = FEWEST,
    confidence: float = CONFIDENCE,
    longest: int = LONGEST,
) -> DataFrame:
    """Rules from ``labelled`` (tokens, bad): rule_tokens, seen, confidence; stored.

    ``seen`` counts the URLs with all tokens of the rule. FP-growth over the bad URLs proposes
    combinations, and each is then counted over all labelled ones. A rule goes if a rule with part of its
    tokens is at least as confident, or if the bad are as large a share of all. Tokens that always come together
    stand in rules together. URLs of more than ``longest`` such items, whose combinations FP-growth would write
    out, are mined level by level instead; the rules are the same for any ``longest``. Without labels, or without
    bad ones, there is none.
    """
    some = labelled.where(F.size("tokens") > 0)
    grouped = some.groupBy("tokens", "bad").agg(F.count("*").alias("n"))
    baskets = stored(grouped.withColumn("basket", F.xxhash64("tokens", "bad")), "baskets")
    bad_rows = F.coalesce(F.sum(F.when(F.col("bad"), F.col("n"))), F.lit(0))
    total, bad_total = baskets.agg(F.coalesce(F.sum("n"), F.lit(0)), bad_rows).first()
    empty = "rule_tokens array<string>, seen long, confidence double"
    if not bad_total:
        return labelled.sparkSession.createDataFrame([], empty)
    least_bad = max(math.ceil(support * total - EPSILON), math.ceil(fewest * confidence - EPSILON), 1)
    if least_bad > bad_total:
        return labelled.sparkSession.createDataFrame([], empty)
    items, stands_for = _mined_items(baskets, least_bad, fewest)
    items = stored(items, "bad_baskets")
    short, long = items.where(F.size("items") <= longest), items.where(F.size("items") > longest)
    proposed = stands_for.select(F.array("item").alias("items"))
    short_total = short.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if short_total >= least_bad:
        # Half a row less, so that rounding cannot lift the limit.
        least = (least_bad - 0.5) / short_total
        frequent = FPGrowth(itemsCol="items", minSupport=least).fit(_repeated(short)).freqItemsets
        proposed = proposed.unionByName(frequent.select(F.sort_array("items").alias("items")))
    if not long.isEmpty():
        # What too few short URLs have is in long ones as well.
        proposed = proposed.unionByName(_grown(long, stands_for, baskets, least_bad, total - bad_total))
    proposed = stored(proposed.distinct(), "itemsets")
    candidates = stored(_parts(proposed, stands_for).select("part"), "candidates")
    counted = _counted(baskets, candidates)
    share = F.col("bad_rows") / F.col("seen")
    sure = (F.col("seen") >= fewest) & (F.col("bad_rows") >= least_bad) & (share >= confidence) & (share > bad_total / total)
    rules = counted.where(sure).select(F.col("part").alias("rule_tokens"), "seen", share.alias("confidence"))
    rules = stored(rules, "rules")
    index = inverted(rules.select(F.col("rule_tokens").alias("part"), F.col("confidence").alias("by")), "part")
    implied = (
        matches(rules, index, "rule_tokens", "part")
        .where((F.size("part") < F.size("rule_tokens")) & (F.col("by") >= F.col("confidence")))
        .select("rule_tokens")
        .distinct()
    )
    return stored(rules.join(implied, "rule_tokens", "left_anti"), "pruned")


def inverted(rules: DataFrame, of: str) -> DataFrame:
    """``rules`` with ``anchor``, the token of each that the fewest rules have."""
    each = rules.select(of, F.explode(of).alias("anchor"))
    frequency = each.groupBy("anchor").agg(F.count("*").alias("n"))
    rarest = each.join(frequency, "anchor").groupBy(of).agg(F.min(F.struct("n", "anchor")).alias("least"))
    return rules.join(rarest, of).withColumn("anchor", F.col("least.anchor")).drop("least")


def _salted(small: DataFrame) -> DataFrame:
    """``small`` once under each salt, so that rows which meet one of its keys are dealt over several tasks."""
    return small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def matches(rows: DataFrame, index: DataFrame, of: str, part: str) -> DataFrame:
    """Rows with each rule whose tokens they all have."""
    asked = rows.withColumn("anchor", F.explode(of)).withColumn("salt", F.pmod(F.xxhash64(of), F.lit(SALTS)))
    inside = F.size(F.array_except(part, of)) == 0
    return asked.join(_salted(index), ["anchor", "salt"]).where(inside).drop("anchor", "salt")


def judge(
    pages: DataFrame,
    labelled: DataFrame,
    rules: Sequence[Rule],
    support: float = SUPPORT,
    fewest: int = FEWEST,
    confidence: float = CONFIDENCE,
    without: Sequence[str] = (),
) -> DataFrame:
    """page_id, host, path, rule, verdict, confidence for every row of ``pages`` (page_id, url).

    ``labelled`` has url and bad (boolean). The verdict is that of the stated rule; without one it
    is ``block`` if a mined rule matches, with the confidence of the best, else ``allow``. A
    null url has no tokens and is allowed. Equal token sets are matched once; null and repeated ids
    and extra columns change nothing. Tokens in ``without`` teach nothing: they are those that labels were
    made of.
    """
    known = labelled.where(F.col("url").isNotNull() & F.col("bad").isNotNull())
    told = F.array_except(tokens(F.col("url")), F.array(*map(F.lit, without)).cast("array<string>"))
    mined = mine(known.select(told.alias("tokens"), "bad"), support, fewest, confidence)
    index = inverted(mined.withColumnRenamed("rule_tokens", "part").drop("seen"), "part")
    url = F.col("url")
    parsed = pages.select(
        F.col("page_id").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), tokens(url).alias("tokens")
    ).withColumn("stated", stated(rules, F.col("host"), F.col("path")))
    open_ones = parsed.where(F.col("stated").isNull()).select("tokens").distinct()
    hit = matches(open_ones, index, "tokens", "part").groupBy("tokens").agg(F.max("confidence").alias("confidence"))
    # Any salt is right for a page, and equal URLs get different ones.
    dealt = parsed.withColumn("salt", F.monotonically_increasing_id() % SALTS)
    joined = dealt.join(_salted(hit), ["tokens", "salt"], "left")
    mined_verdict = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return joined.select(
        "page_id",
        "host",
        "path",
        F.col("stated.rule").alias("rule"),
        F.coalesce("stated.verdict", mined_verdict).alias("verdict"),
        F.when(F.col("stated").isNull(), F.col("confidence")).alias("confidence"),
    )
