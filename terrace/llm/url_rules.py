"""URL filter: fixed host and path rules, and association rules mined from labelled URLs.

URLs become token sets. Spark's FP-growth mines the token sets that are frequent among blocked URLs;
those found in enough labelled URLs, with a high enough share of blocked ones and no smaller set that
does as well, become rules. A URL meets the rules through an inverted index from token to rule: a rule
is listed under its rarest token and fits where the row has its other tokens too. URLs of equal tokens
are looked up once, with their number.

Token sets, rules and labels grow with the rows. Spark takes their size from small files (tokens repeat), which
says little of them, so none is broadcast: joins merge.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.session import write_through

#: Labelled URLs that a rule must hold for, and share of them that must be blocked.
MIN_PAGES, MIN_CONFIDENCE = 10, 0.6
#: Blocked URLs that a partition of the mining should hold.
MINED_ROWS = 50_000


def host_of(url: str) -> Column:
    """Behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_rule(host: str, path: str, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule that fits, as written, and its verdict; both null where none fits.

    A rule ``name/path`` fits the host ``name`` and all its subdomains if the path starts with ``/path``.
    """
    # compiled in the order of length, so that the first that fits is the longest; equal lengths by name
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = text.partition("/")
        fits = ((F.col(host) == name) | F.endswith(F.col(host), F.lit("." + name))) & F.startswith(F.col(path), F.lit("/" + rest))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(rules[text])).otherwise(verdict)
    return rule, verdict


def tokens(url: str, host: str, path: str) -> Column:
    """The distinct tokens of a URL: scheme, host and its parents, words and kind of the path, names in the query."""
    parts = F.split(F.col(host), r"\.")
    parents = F.transform(
        F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(parts, i, F.size(parts)), ".")),
    )
    # a label stands on many domains, which no host or parent names
    labels = F.transform(F.flatten(F.transform(parts, lambda p: F.split(p, "-"))), lambda p: F.concat(F.lit("w:"), p))
    # a run of digits is an address of one page, which no rule should name
    segments = F.transform(
        F.filter(F.split(F.regexp_replace(F.lower(path), "[0-9]+", "0"), "[/._-]"), lambda p: p != ""), lambda p: F.concat(F.lit("p:"), p)
    )
    query = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda q: q != ""), lambda q: F.concat(F.lit("q:"), F.substring_index(q, "=", 1)))
    scheme = F.array(F.concat(F.lit("s:"), F.lower(F.substring_index(F.coalesce(F.col(url), F.lit("")), "://", 1))))
    return F.array_distinct(F.concat(scheme, parents, labels, segments, names))


def repeats_host(items: str) -> Column:
    """Whether a host of the set has a parent or a label in it too; such a set fits the same URLs without them."""

    def held(host: Column, other: Column) -> Column:
        name = F.substring(other, 3, 1 << 20)
        parent = F.startswith(other, F.lit("h:")) & F.endswith(host, F.concat(F.lit("."), name))
        label = F.startswith(other, F.lit("w:")) & F.array_contains(F.split(F.substring(host, 3, 1 << 20), "[.-]"), name)
        return parent | label

    return F.exists(items, lambda a: F.startswith(a, F.lit("h:")) & F.exists(items, lambda b: held(a, b)))


def mine_rules(labelled: DataFrame, min_support: float | None = None, min_pages: int = MIN_PAGES,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(``rule_id``, ``items``, ``pages``, ``confidence``) from rows of ``id``, ``items`` (tokens) and ``blocked``.

    Without ``min_support`` (a share of the blocked rows) a token set is mined if it is in as many blocked rows
    as a rule of ``min_pages`` rows must have, however many rows there are. A rule goes if a part of it has the
    same or a higher confidence. Without blocked rows there are none.
    """
    spark = labelled.sparkSession
    schema = "rule_id long, items array<string>, pages long, confidence double"
    rows = write_through(labelled.select("items", "blocked"), "url-labelled")
    bad = rows.filter("blocked").select("items")
    n = bad.count()
    if not n:
        return spark.createDataFrame([], schema)
    if min_support is None:
        # half a row less, so that rounding asks for no row more
        min_support = min(1.0, (math.ceil(min_pages * min_confidence) - 0.5) / n)
    # a basket goes to as many partitions as it has tokens, so no more of them than the baskets need
    sets = FPGrowth(itemsCol="items", minSupport=min_support, numPartitions=1 + n // MINED_ROWS).fit(bad).freqItemsets
    sets = sets.filter(~repeats_host("items")).select(F.sort_array("items").alias("items")).distinct()
    ruled = write_through(sets.select(F.xxhash64("items").alias("rule_id"), "items"), "url-sets")
    # every labelled URL, blocked or not, counts for the confidence
    tally = F.count(F.lit(1)).alias("n"), F.count("blocked").alias("told"), F.sum(F.col("blocked").cast("double")).alias("bad")
    alike = write_through(rows.groupBy("items").agg(*tally), "url-alike")
    hits = matched(alike, ruled, ["n", "told", "bad"])
    counted = hits.groupBy("rule_id").agg(F.sum("n").alias("pages"), (F.sum("bad") / F.sum("told")).alias("confidence"))
    good = write_through(
        ruled.join(counted.hint("merge"), "rule_id").filter((F.col("pages") >= min_pages) & (F.col("confidence") >= min_confidence)), "url-rules"
    )
    # parts of a rule: all its subsets by one token less, which is enough, as a part's part was tested with it
    parts = good.select("rule_id", "confidence", "items", F.explode("items").alias("left_out"))
    parts = parts.select("rule_id", "confidence", F.xxhash64(F.array_remove("items", F.col("left_out"))).alias("part"))
    known = good.select(F.col("rule_id").alias("part"), F.col("confidence").alias("part_confidence"))
    idle = parts.join(known.hint("merge"), "part").filter(F.col("part_confidence") >= F.col("confidence")).select("rule_id").distinct()
    return good.join(idle.hint("merge"), "rule_id", "left_anti").select("rule_id", "items", "pages", "confidence")


def matched(rows: DataFrame, rules: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``rule_id`` of every rule that fits a row, found through an inverted index.

    A rule is listed under the token of it that is rarest among the rows, so that common tokens have
    short lists; its other tokens are then looked for in the row. Tokens are distinct in a row.
    """
    common = rows.select(F.explode("items").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    listed = rules.select("rule_id", F.col("items").alias("wanted"), F.explode("items").alias("token")).join(common.hint("merge"), "token")
    index = listed.groupBy("rule_id", "wanted").agg(F.min(F.struct("n", "token")).alias("rarest")).select("rule_id", "wanted", "rarest.token")
    met = rows.select(*keep, "items", F.explode("items").alias("token")).join(index.hint("merge"), "token")
    return met.filter(F.size(F.array_except("wanted", "items")) == 0).select(*keep, "rule_id")


def judge_urls(pages: DataFrame, labels: DataFrame, fixed: dict[str, str], key: str = "page_id", url: str = "url",
               label_key: str = "doc_id", blocked: Column | None = None, **settings) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict``, ``mined_rule`` and ``confidence`` of every page.

    A fixed rule decides; else a mined rule that fits blocks (the most confident one is named), and all
    other pages are allowed. ``labels`` tell by ``label_key`` which pages ``blocked`` holds for; a page with
    several labels is blocked if any says so. Null URLs have an empty host and path; repeated rows stay.
    """
    blocked = (F.col("quality") == 0) | (F.col("toxic") == 1) if blocked is None else blocked
    bare = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"))
    named = bare.select("*", host_of("url").alias("host"), path_of("url").alias("path"))
    rule, verdict = fixed_rule("host", "path", fixed)
    ruled = write_through(named.select("key", "host", "path", rule.alias("rule"), verdict.alias("fixed"), F.xxhash64("url").alias("id"), tokens("url", "host", "path").alias("items")), "url-tokens")
    known = labels.select(F.col(label_key).alias("key"), F.coalesce(blocked, F.lit(False)).alias("blocked"))
    known = known.groupBy("key").agg(F.max("blocked").alias("blocked"))
    labelled = ruled.join(known.hint("merge"), "key").select(F.xxhash64("key", "id").alias("id"), "items", "blocked").dropDuplicates(["id"])
    found = mine_rules(labelled, **settings)
    ruled = ruled.withColumn("alike", F.xxhash64("items"))
    distinct = ruled.filter(F.col("rule").isNull()).groupBy("alike").agg(F.first("items").alias("items"))
    fits = matched(distinct, found, ["alike"]).join(found.hint("merge"), "rule_id").groupBy("alike")
    best = fits.agg(F.max(F.struct("confidence", "pages", "items")).alias("best"))
    out = ruled.drop("items").join(best.hint("merge"), "alike", "left")
    return out.select(
        F.col("key").alias(key), "host", "path", "rule",
        F.coalesce("fixed", F.when(F.col("best").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("fixed").isNull(), F.array_join("best.items", " ")).alias("mined_rule"),
        F.when(F.col("fixed").isNull(), F.col("best.confidence")).alias("confidence"),
    )
