"""Quality rules: a table of thresholds compiled into one projection of text measures.

Measures are Spark expressions over the whole text; nothing is shuffled and no user function runs.
A rule names a ratio and the range that a text must keep to; the verdict carries the first rule that a
text breaks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
#: Repeated windows of a text that are looked up one by one; texts with more sort their windows.
LOOKED_UP = 200
# fixed values: common short words of the four languages
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "on", "are", "with", "this", "be", "by", "an", "or", "at", "from",
    "der", "die", "das", "und", "ist", "von", "den", "zu", "mit", "ein", "eine", "nicht", "im", "auf", "für", "des", "dem", "sich", "als",
    "le", "la", "les", "et", "un", "une", "est", "du", "en", "que", "qui", "dans", "pour", "sur", "pas", "au", "avec",
    "el", "los", "las", "y", "se", "por", "con", "una", "para", "no", "del", "su", "al", "como",
]


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie from ``low`` to ``high``, both included; None is open. Texts below ``min_words`` are spared."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: Production thresholds.
RULES = (
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("shouting", "exclamation_ratio", high=0.3),
    Rule("capitals", "capital_ratio", high=0.4),
    Rule("word_length", "mean_word_chars", low=2.5, high=14.0),
    Rule("stop_words", "stop_ratio", low=0.01, min_words=100),
    Rule("repeated_lines", "dup_line_ratio", high=0.3),
    Rule("repeated_words", "repeat_ratio", high=0.3),
)


def words_of(text: str | Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` and with the counts: words, characters, symbols, lines and repeats."""
    keep = [f"`{c}`" for c in docs.columns if c != text]
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    split = docs.select(*keep, body.alias("__text"), words_of(F.col(text).cast("string")).alias("__words"))
    lines = F.filter(F.split("__text", "\n"), lambda line: F.length(F.translate(line, SPACE_CHARS, "")) > 0)
    # a window is three words; words hold no space, so a hash of the three stands for it
    windows = F.transform(
        F.when(F.size("__words") >= 3, F.sequence(F.lit(1), F.size("__words") - 2)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get("__words", i - 1), F.get("__words", i), F.get("__words", i + 1)),
    )
    counted = split.select(
        *keep,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.translate("__text", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("__text") - F.length(F.translate("__text", "!", ""))).cast("long").alias("__bangs"),
        F.regexp_count("__text", F.lit("[A-Z]")).cast("long").alias("__capitals"),
        F.size(F.filter("__words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("__stops"),
        lines.alias("__lines"),
        windows.alias("__windows"),
    )
    lined = counted.select(
        "*",
        F.size("__lines").cast("long").alias("__n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("__windows") > F.size(F.array_distinct("__windows")), F.sort_array("__windows")).alias("__sorted"),
    ).drop("__lines")
    # windows found twice or more, null for texts without any
    twice = F.array_distinct(F.filter("__sorted", lambda x, i: x == F.get(F.col("__sorted"), i + 1)))
    repeated = lined.withColumn("__twice", twice).drop("__sorted")
    few = F.filter(F.transform("__windows", lambda w, i: F.when(F.array_contains("__twice", w), i)), lambda i: i.isNotNull())
    placed = F.sort_array(F.transform("__windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    sorted_ = repeated.withColumn("__placed", F.when(F.size("__twice") > LOOKED_UP, placed))
    many = F.filter(
        F.transform(
            "__placed",
            lambda x, i: F.when(
                (x["w"] == F.get(F.col("__placed"), i + 1)["w"]) | ((i > 0) & (x["w"] == F.get(F.col("__placed"), F.greatest(i - 1, F.lit(0)))["w"])),
                x["i"],
            ),
        ),
        lambda i: i.isNotNull(),
    )
    starts = F.when(F.col("__twice").isNull(), F.array().cast("array<int>")).when(F.size("__twice") > LOOKED_UP, F.sort_array(many)).otherwise(few)
    at = sorted_.withColumn("__starts", starts).drop("__windows", "__placed", "__twice")
    # each repeated window covers three words, less where the next one starts within them
    covered = F.aggregate(
        F.transform("__starts", lambda p, i: F.coalesce(F.least(F.lit(3), F.get(F.col("__starts"), i + 1) - p), F.lit(3))),
        F.lit(0),
        lambda total, n: total + n,
    )
    return at.withColumn("n_repeat_words", covered.cast("long")).drop("__starts")


def ratios() -> dict[str, Column]:
    """What rules may name; a text without words has null ratios, which break no rule."""
    n = F.nullif(F.col("n_words"), F.lit(0))
    return {
        "symbol_ratio": F.col("n_symbols") / n,
        "exclamation_ratio": F.col("__bangs") / n,
        "capital_ratio": F.col("__capitals") / F.nullif(F.col("word_chars"), F.lit(0)),
        "mean_word_chars": F.col("word_chars") / n,
        "stop_ratio": F.col("__stops") / n,
        "dup_line_ratio": F.col("n_dup_lines") / F.nullif(F.col("__n_lines"), F.lit(0)),
        "repeat_ratio": F.col("n_repeat_words") / n,
    }


def broken(rules: tuple[Rule, ...] = RULES) -> Column:
    """The first rule that a text breaks, null if none: the table as one expression."""
    known = ratios()
    first = F.lit(None).cast("string")
    for rule in reversed(rules):
        value = known[rule.measure]
        outside = F.lit(False)
        if rule.low is not None:
            outside = outside | (value < rule.low)
        if rule.high is not None:
            outside = outside | (value > rule.high)
        first = F.when(F.coalesce(outside & (F.col("n_words") >= rule.min_words), F.lit(False)), F.lit(rule.name)).otherwise(first)
    return first


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` without the text, with its counts, ``base_failed``, ``broken_rule`` and ``kept``.

    ``base_failed``: below 50 words, or more than half of the words in repeated windows. A null or
    empty text has no words and fails so. Columns of ``docs`` that are named like a result are left out.
    """
    results = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "broken_rule", "kept"}
    clear = docs.select(*[f"`{c}`" for c in docs.columns if c not in results])
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = measured(clear, text).withColumn("base_failed", base_failed).withColumn("broken_rule", broken(rules))
    out = out.withColumn("kept", ~F.col("base_failed") & F.col("broken_rule").isNull())
    return out.drop("__bangs", "__capitals", "__stops", "__n_lines")
