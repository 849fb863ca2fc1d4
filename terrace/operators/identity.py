"""Directory snapshots against platform state, identities across sources, settings drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.snapshots import diff_snapshots
from terrace.plans.closure import components, transitive_closure


def provision_plan(directory: DataFrame, current: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """(key, action, cols) that bring ``current`` in line with ``directory``.

    Both have ``active``; the columns of the result hold the values wanted afterwards.
    """
    diff = diff_snapshots(current, directory, [key], [*cols, "active"])
    wanted = F.coalesce("new_active", F.lit(False))
    present = F.coalesce("old_active", F.lit(False))
    action = (
        F.when((F.col("change") == "insert") & wanted, "create")
        .when(F.col("change") == "insert", None)
        .when(present & ~wanted, "deactivate")
        .when(~present & wanted, "reactivate")
        .when((F.col("change") == "update") & present, "update")
    )
    changed = diff.withColumn("action", action).filter(F.col("action").isNotNull())
    gone = F.col("action") == "deactivate"
    return changed.select(
        key, "action", *[F.when(gone, F.col(f"old_{c}")).otherwise(F.col(f"new_{c}")).alias(c) for c in cols]
    )


def apply_plan(current: DataFrame, plan: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Platform state after the plan."""
    todo = plan.select(F.col(key).alias("__k"), "action", *[F.col(c).alias(f"__{c}") for c in cols])
    both = current.join(todo, F.col(key) == F.col("__k"), "full_outer")
    touched = F.col("action").isNotNull()
    return both.select(
        F.coalesce(key, "__k").alias(key),
        *[F.when(touched, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in cols],
        F.when(touched, F.col("action") != "deactivate").otherwise(F.col("active")).alias("active"),
    )


def membership_plan(directory: DataFrame, current: DataFrame) -> DataFrame:
    """(action, member, group): memberships to add and to remove."""
    pair = ["member", "group"]
    wanted, have = directory.select(*pair).distinct(), current.select(*pair).distinct()
    add = wanted.join(have, pair, "left_anti").select(F.lit("add").alias("action"), *pair)
    remove = have.join(wanted, pair, "left_anti").select(F.lit("remove").alias("action"), *pair)
    return add.unionByName(remove)


def normal_text(c: str | Column) -> Column:
    """Lower case without surrounding space; empty becomes NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.lower(F.trim(col)), F.lit(""))


def match_identities(records: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(source, record_id, canonical_source, canonical_record_id, is_ambiguous): records linked by
    any shared rule value.

    ``records`` has (source, record_id) and whatever the rules read; a rule may yield a string or
    an array of strings, NULL links nothing. A person with two records in one source is flagged
    ambiguous. The canonical record is the smallest (source, record_id) of the person. Both keep
    their types; a NULL source is a source of its own.
    """
    found = []
    for number, rule in enumerate(rules.values()):
        is_list = records.select(rule.alias("r")).schema["r"].dataType.typeName() == "array"
        values = F.array_compact(F.coalesce(rule if is_list else F.array(rule), F.array().cast("array<string>")))
        found.append(F.transform(values, lambda v: F.struct(F.lit(number).alias("rule"), v.alias("value"))))  # noqa: B023
    item = F.struct("source", "record_id").alias("item")
    links = records.select(item, F.explode(F.concat(*found)).alias("key"))
    # a value that one record holds links nothing, and most records hold no other: they skip the rounds
    held = links.groupBy("key").agg(F.min("item").alias("low"), F.max("item").alias("high"))
    shared = held.filter(F.col("low") != F.col("high")).select("key")
    labels = components(links.join(shared, "key", "left_semi"), "item", "key")
    linked = labels.select(F.col("item").alias("__item"), "label")
    everyone = records.select(item).distinct().join(linked, F.col("item") == F.col("__item"), "left")
    everyone = everyone.select("item", F.coalesce("label", "item").alias("label"))
    per_source = labels.groupBy("label", F.col("item.source").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    doubtful = per_source.filter("n > 1").select(F.col("label").alias("__label")).distinct()
    out = everyone.join(doubtful, F.col("label") == F.col("__label"), "left")
    return out.select(
        "item.*", F.col("label.source").alias("canonical_source"), F.col("label.record_id").alias("canonical_record_id"),
        F.col("__label").isNotNull().alias("is_ambiguous"),
    )


def group_closure(memberships: DataFrame) -> DataFrame:
    """(member, group, depth): nested membership made direct; cycles end where they start."""
    pairs = transitive_closure(memberships, "member", "group", with_path=False)
    return pairs.select(F.col("node").alias("member"), F.col("ancestor").alias("group"), "depth")


def orphaned_access(grants: DataFrame, users: DataFrame) -> DataFrame:
    """Grants of principals that are inactive or unknown, with the reason."""
    known = users.select(F.col("principal").alias("__p"), F.col("active").alias("__active"))
    joined = grants.join(known, F.col("principal") == F.col("__p"), "left")
    reason = F.when(F.col("__p").isNull(), "unknown").when(~F.coalesce("__active", F.lit(False)), "inactive")
    return joined.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("__p", "__active")


def config_drift(desired: DataFrame, actual: DataFrame) -> DataFrame:
    """(env, resource, key, drift, desired, actual) with drift missing, extra or changed."""
    where = ["env", "resource", "key"]
    diff = diff_snapshots(actual, desired, where, ["value"])
    drift = F.when(F.col("change") == "insert", "missing").when(F.col("change") == "delete", "extra").otherwise("changed")
    return diff.select(*where, drift.alias("drift"), F.col("new_value").alias("desired"), F.col("old_value").alias("actual"))
