"""Personal data: base patterns, and identifiers found by the contexts that base matches stand in.

All of it is DataFrame expressions. Base matches are the seeds. Words that hold a digit or an ``@`` are
instances, so that every base match covers one; the words ahead of them (one or two) and the literal in
front of their value are lexical patterns.
Rounds over the graph of patterns and instances score a pattern by the share of its instances that
are known and an instance by the patterns it stands in; instances of high score in patterns of high
confidence become spans of their own kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.session import write_through

KINDS = ["email", "ip", "card", "phone"]
#: Kind of the spans that the contexts add; it comes after the base kinds.
FOUND = "id"
# Possessive and anchored forms of the four base patterns: a match begins where a run begins, or where the
# match before ended, so that long runs without a match are passed over once.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A word that holds a digit or an ``@``.
INSTANCE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: The one or two words at the end of what stands ahead of an instance.
AHEAD = r"(?<!\S)(?:\S++\s++)?+\S++\s*+$"
#: Rounds, distinct known instances that a pattern needs, and the scores that patterns and instances need.
ROUNDS, MIN_SUPPORT, MIN_CONFIDENCE, MIN_SCORE = 3, 5, 0.8, 0.7
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def prefix_sums(numbers: Column) -> Column:
    """Running totals of an array by doubling: each round adds what stands 1, 2, 4, ... places ahead."""

    def rounds(all_numbers: Column) -> Column:
        steps = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda step: step < F.size(all_numbers))

        def add(sums: Column, step: Column) -> Column:
            return F.transform(sums, lambda n, i: n + F.coalesce(F.get(sums, i - step), F.lit(0)))

        return F.aggregate(steps, all_numbers, add)

    return let(numbers, rounds)


def pieces(text: str, pattern: str) -> Column:
    """The matches of the pattern, the gaps ahead of them, and where each match ends in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.struct(matches.alias("m"), F.split(text, pattern, -1).alias("gaps"))

    def with_ends(w: Column) -> Column:
        # the pieces between matches tell where each match begins
        gaps = F.slice(w["gaps"], 1, F.size(w["m"]))
        ends = prefix_sums(F.zip_with(gaps, w["m"], lambda gap, m: F.length(gap) + F.length(m)))
        return F.arrays_zip(gaps.alias("gap"), w["m"].alias("m"), ends.alias("end"))

    return let(both, with_ends)


def located(text: str, pattern: str, kind: str) -> Column:
    """Matches of the pattern with their places in code points, end exclusive."""
    return F.transform(
        pieces(text, pattern),
        lambda w: F.struct(F.lit(kind).alias("kind"), (w["end"] - F.length(w["m"])).alias("start"), w["end"].alias("end"), w["m"].alias("value")),
    )


def counts_below(points: Column, limits: Column) -> Column:
    """How many of the points are below each of the rising limits; all are sorted once, no pairs are looked at."""
    codes = F.sort_array(F.concat(F.transform(points, lambda p: 2 * p + 1), F.transform(limits, lambda at: 2 * at)))

    def counted(sorted_codes: Column) -> Column:
        sums = prefix_sums(F.transform(sorted_codes, lambda c: c % 2))
        both = F.zip_with(sorted_codes, sums, lambda c, n: F.struct(c.alias("c"), n.alias("n")))
        return F.transform(F.filter(both, lambda x: x["c"] % 2 == 0), lambda x: x["n"])

    return let(codes, counted)


def luhn(digits: Column) -> Column:
    """Whether the check digit holds; ``digits`` holds digits only."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    weighed = F.transform(
        F.filter(numbers, lambda n: n.isNotNull()), lambda n, i: F.when(i % 2 == 0, n).when(n > 4, 2 * n - 9).otherwise(2 * n)
    )
    return F.aggregate(weighed, F.lit(0), lambda a, n: a + n) % 10 == 0


def octets_fit(value: Column) -> Column:
    return F.forall(
        F.split(value, r"\."),
        lambda part: (F.length(F.ltrim(part, F.lit("0"))) < 3)
        | ((F.length(F.ltrim(part, F.lit("0"))) == 3) & (F.ltrim(part, F.lit("0")) <= "255")),
    )


def base_spans(text: str) -> Column:
    """All base spans of a text by kind, then start; what fails its check is dropped."""
    none = F.array().cast(SPAN)
    digit = F.col(text).rlike("[0-9]")
    emails = F.when(F.contains(F.col(text), F.lit("@")), located(text, EMAIL, "email")).otherwise(none)
    ips = F.when(digit, F.filter(located(text, IP, "ip"), lambda s: octets_fit(s["value"]))).otherwise(none)

    def is_card(s: Column) -> Column:
        digits = F.translate(s["value"], " -", "")
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)

    cards = F.when(digit, F.filter(located(text, CARD, "card"), is_card)).otherwise(none)

    def is_phone(s: Column) -> Column:
        return F.length(F.regexp_replace(s["value"], "[^0-9]", "")).between(8, 15)

    phones = F.when(F.contains(F.col(text), F.lit("+")), F.filter(located(text, PHONE, "phone"), is_phone)).otherwise(none)
    return F.concat(emails, ips, cards, phones)


def instances(text: str) -> Column:
    """Words that hold a digit or an ``@``, each with the one or two words ahead of it."""
    kind = "array<struct<start:int,end:int,value:string,ahead:string>>"
    found = F.transform(
        pieces(text, INSTANCE),
        lambda w: F.struct(
            (w["end"] - F.length(w["m"])).alias("start"), w["end"].alias("end"), w["m"].alias("value"),
            F.regexp_extract(w["gap"], AHEAD, 0).alias("ahead"),
        ),
    )
    return F.when(F.col(text).rlike("[0-9@]"), found).otherwise(F.array().cast(kind))


def with_seeds(words: str, base: str) -> Column:
    """The words and whether a base span covers part of each: it begins before the word's end and does not end by its start."""
    begun = counts_below(F.transform(base, lambda s: s["start"]), F.transform(words, lambda w: w["end"]))
    ended = counts_below(F.transform(base, lambda s: s["end"]), F.transform(words, lambda w: w["start"] + 1))
    seeds = F.zip_with(begun, ended, lambda b, e: b > e)
    return F.zip_with(words, seeds, lambda w, seed: F.struct(w["start"].alias("start"), w["end"].alias("end"), w["value"].alias("value"), w["ahead"].alias("ahead"), seed.alias("seed")))


def patterns_of(ahead: str, value: str) -> Column:
    """Lexical patterns of an instance: one word ahead, two words ahead, the literal in front of its value."""
    tail = F.lower(F.regexp_extract(ahead, r"(?<!\S)(\S++)\s*+$", 1))
    two = F.lower(F.regexp_extract(ahead, r"(?<!\S)(\S++\s++\S++)\s*+$", 1))
    literal = F.lower(F.regexp_extract(value, r"^(\p{L}[\p{L}_-]*+[=:])", 1))
    return F.array_compact(
        F.array(
            F.when(tail != "", F.concat(F.lit("1 "), tail)),
            F.when(two != "", F.concat(F.lit("2 "), F.regexp_replace(two, r"\s+", " "))),
            F.when(literal != "", F.concat(F.lit("= "), literal)),
        )
    )


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``mark`` (a digest of the text), ``base`` and ``words`` of every document; the text is read once and left behind."""
    body = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = body.select("key", F.md5("text").alias("mark"), base_spans("text").alias("base"), instances("text").alias("words"))
    return found.select("key", "mark", "base", with_seeds("words", "base").alias("words"))


def graph(scanned: DataFrame) -> DataFrame:
    """(``pattern``, ``instance``, ``seed``): which instance stands in which pattern, and whether a base match covers it."""
    found = scanned.select(F.explode("words").alias("w"))
    edges = found.select(F.lower("w.value").alias("instance"), F.col("w.seed").alias("seed"), F.explode(patterns_of("w.ahead", "w.value")).alias("pattern"))
    return edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))


def score_graph(edges: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT) -> tuple[DataFrame, DataFrame]:
    """Patterns with ``confidence`` and ``support``, instances with ``score``, after some rounds.

    An instance that is a seed anywhere scores 1. A pattern's confidence is the mean score of its distinct
    instances, one unknown added; another instance scores the mean confidence of its patterns of enough support.
    """
    seeds = edges.groupBy("instance").agg(F.max("seed").alias("known"))
    scores = write_through(seeds.select("instance", "known", F.col("known").cast("double").alias("score")), "pii-scores")
    patterns = None
    for _ in range(rounds):
        weighed = edges.join(scores, "instance")
        patterns = write_through(
            weighed.groupBy("pattern").agg(
                (F.sum("score") / (F.count(F.lit(1)) + 1)).alias("confidence"), F.sum(F.col("known").cast("int")).alias("support")
            ),
            "pii-patterns",
        )
        strong = patterns.filter(F.col("support") >= min_support).select("pattern", "confidence")
        voted = edges.join(strong, "pattern").groupBy("instance").agg(F.avg("confidence").alias("vote"))
        scores = write_through(
            scores.join(voted, "instance", "left").select(
                "instance", "known", F.when(F.col("known"), 1.0).otherwise(F.coalesce("vote", F.lit(0.0))).alias("score")
            ),
            "pii-scores",
        )
    return patterns, scores


def discovered(scanned: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE, min_score: float = MIN_SCORE) -> DataFrame:
    """(``key``, ``mark``, ``added``): spans of high-scored instances in confident patterns, outside the base spans."""
    edges = write_through(graph(scanned), "pii-graph")
    patterns, scores = score_graph(edges, rounds, min_support)
    sure = patterns.filter((F.col("confidence") >= min_confidence) & (F.col("support") >= min_support)).select("pattern")
    new = scores.filter(~F.col("known") & (F.col("score") >= min_score)).select("instance")
    picked = edges.filter(~F.col("seed")).join(sure, "pattern", "left_semi").join(new, "instance", "left_semi").select("instance", "pattern").distinct()
    free = scanned.select("key", "mark", F.explode("words").alias("w")).filter(~F.col("w.seed"))
    places = free.select("key", "mark", "w.start", "w.end", "w.value", F.lower("w.value").alias("instance"), F.explode(patterns_of("w.ahead", "w.value")).alias("pattern"))
    spans = places.join(picked, ["instance", "pattern"], "left_semi")
    one = F.struct(F.lit(FOUND).alias("kind"), "start", "end", "value")
    return spans.groupBy("key", "mark").agg(F.sort_array(F.collect_set(one)).alias("added"))


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``key``, ``base`` and ``spans`` (structs of kind, start, end, value) of every document.

    ``spans`` are the base spans and after them what the contexts add. Null texts are empty; repeated
    rows and null keys stay, extra columns are left out.
    """
    scanned = write_through(scan(docs, key, text), "pii-scan")
    added = discovered(scanned, **settings).withColumnRenamed("key", "__key").withColumnRenamed("mark", "__mark")
    # only texts with a word that was added have a row on the right
    joined = scanned.join(added, F.col("key").eqNullSafe(F.col("__key")) & (F.col("mark") == F.col("__mark")), "left")
    return joined.select(F.col("key").alias(key), "base", F.concat("base", F.coalesce("added", F.array().cast(SPAN))).alias("spans"))


def number_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def written(spans: str) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: str, spans: str, mask: str = "<{}>") -> Column:
    """The text with each span replaced by a mark of its kind, spans that overlap an earlier one skipped."""
    before, after = mask.split("{}")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        piece = F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"])
        out = F.concat(acc["out"], piece, F.lit(before), F.upper(s["kind"]), F.lit(after))
        free = s["start"] >= acc["at"]
        return F.struct(F.when(free, s["end"]).otherwise(acc["at"]).alias("at"), F.when(free, out).otherwise(acc["out"]).alias("out"))

    return F.aggregate(by_place, start, step, lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(F.col(text)))))
