"""From raw rows to clean rows: schemas, quality rules, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.plans.joins import all_of

FAILED = "_failed_rules"


def reconcile_schema(df: DataFrame, target: T.StructType, extra: str = "_extra") -> DataFrame:
    """Rows in the shape of ``target``: missing columns NULL, changed types tried, the rest as JSON."""
    have = dict(df.dtypes)
    out = []
    for field in target.fields:
        wanted = field.dataType
        if field.name not in have:
            out.append(F.lit(None).cast(wanted).alias(field.name))
        elif have[field.name] == wanted.simpleString():
            out.append(F.col(field.name))
        else:
            out.append(F.col(field.name).try_cast(wanted).alias(field.name))
    surplus = [c for c in df.columns if c not in target.fieldNames()]
    packed = F.to_json(F.struct(*surplus)) if surplus else F.lit(None).cast("string")
    return df.select(*out, packed.alias(extra))


def _holds(rule: Column) -> Column:
    """A rule that evaluates to NULL has failed."""
    return F.coalesce(rule, F.lit(False))


def tag_failures(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add the list of failed rule names."""
    failed = F.array_compact(F.array(*[F.when(~_holds(r), F.lit(n)) for n, r in rules.items()]))
    return df.withColumn(FAILED, failed.cast("array<string>"))


def expect(df: DataFrame, rules: dict[str, Column], action: str = "warn", counts: Observation | None = None):
    """Apply row rules. ``warn`` keeps and tags, ``drop`` filters, ``fail`` aborts the job at the first
    bad row, ``quarantine`` returns (good, bad). ``counts`` collects ``failed_<rule>`` and ``n_rows``
    while the result is computed, at no extra scan."""
    if action not in ("warn", "drop", "fail", "quarantine"):
        raise ValueError(f"unknown action {action!r}")
    if counts is not None:
        df = df.observe(
            counts,
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count(F.when(~_holds(r), 1)).alias(f"failed_{n}") for n, r in rules.items()],
        )
    # a filter drops rows whose rules are NULL; unwrapped rules reach the file scan
    good = all_of(list(rules.values()))
    if action == "warn":
        return tag_failures(df, rules)
    if action == "drop":
        return df.filter(good)
    if action == "fail":
        check = F.assert_true(_holds(good), F.lit("quality rule failed: " + ", ".join(rules)))
        return df.filter(check.isNull())
    tagged = tag_failures(df, rules)
    return df.filter(good), tagged.filter(F.size(FAILED) > 0)


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, passed, failed), all rules counted in one pass."""
    wide = df.agg(*[F.count(F.when(_holds(r), 1)).alias(n) for n, r in rules.items()], F.count(F.lit(1)).alias("__n"))
    per_rule = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("passed")) for n in rules])
    return wide.select(F.explode(per_rule).alias("r"), "__n").select(
        "r.rule", "r.passed", (F.col("__n") - F.col("r.passed")).alias("failed")
    )


def dedupe_latest(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row per key under ``order`` (pass descending columns for newest wins).

    ``order`` has to be total. Spark cuts each map partition to one row per key before the
    shuffle (window group limit), so a hot key sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn <= 1").drop("__rn")
