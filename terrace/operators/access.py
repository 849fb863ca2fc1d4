"""Who may see which rows, columns and objects."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.masks import RESTRICTIVENESS, Mask, by_name, null
from terrace.operators.hierarchy import with_self
from terrace.plans.closure import reach_from, transitive_closure
from terrace.plans.joins import any_of
from terrace.session import write_through


@dataclass(frozen=True)
class RowPolicy:
    """Rows a set of principals may see: a ``predicate``, or values of ``column`` listed per
    principal in ``mapping(principal, value)``. Principals are users, groups or roles."""

    principals: frozenset[str]
    predicate: Column | None = None
    column: str | None = None
    mapping: DataFrame | None = None


@dataclass(frozen=True)
class ColumnMask:
    mask: Mask
    exempt: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Privileges:
    """What privileges follow from: ``grants`` (principal, privilege, object_id), ``memberships``
    (member, group) and ``securables`` (object_id, parent_id)."""

    grants: DataFrame
    memberships: DataFrame
    securables: DataFrame


def names_of(principal: str, memberships: DataFrame) -> frozenset[str]:
    """The principal and all groups it is in, through nested groups; nobody else's are looked at."""
    return _upwards(principal, memberships, "member", "group")


def _upwards(start: str, edges: DataFrame, child: str, parent: str) -> frozenset[str]:
    """``start`` and all above it: one filtered read of the edges for each level, and only these names on the driver."""
    known, level = {start}, {start}
    while level:
        above = edges.filter(F.col(child).isin(*sorted(level)) & F.col(parent).isNotNull()).select(parent).distinct()
        level = {r[parent] for r in above.collect()} - known
        known |= level
    return frozenset(known)


def _names(principal: str | Iterable[str]) -> frozenset[str]:
    return frozenset([principal]) if isinstance(principal, str) else frozenset(principal)


def row_filter(df: DataFrame, policies: list[RowPolicy], principal: str | Iterable[str]) -> DataFrame:
    """Rows allowed by at least one policy of the principal; no policy, no rows.

    ``principal`` may be all names of one caller (:func:`names_of`): a policy of any of them allows.

    Lists of values are joined, however long they are, and nothing is written or read to the driver.
    Spark moves a caller's own filter below a join and could show it hidden rows; a row count that is
    observed above the policy keeps it there. That is how Spark plans today, so a test holds the plan.
    """
    names = _names(principal)
    literal = [p.predicate for p in policies if p.mapping is None and names & p.principals]
    joined = [p for p in policies if p.mapping is not None]
    if not joined:
        return df.filter(any_of(literal))
    seen = any_of(literal)
    rows = df
    for i, policy in enumerate(joined):
        mine = policy.mapping.filter(F.col("principal").isin(*sorted(names))).select(F.col("value").alias(f"__v{i}")).distinct()
        rows = rows.join(mine, F.col(policy.column) == F.col(f"__v{i}"), "left")
        seen = seen | F.col(f"__v{i}").isNotNull()
    counted = rows.filter(seen).select(*df.columns)
    return counted.observe(f"policy-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def column_mask(df: DataFrame, masks: dict[str, ColumnMask], principal: str | Iterable[str]) -> DataFrame:
    """Replace values of masked columns unless the principal, or one of its names, is exempt; column order stays.

    Names are told apart as the session tells them (``spark.sql.caseSensitive``).
    """
    same = _name_rule(df)
    rules = {same(name): rule for name, rule in masks.items()}
    out = []
    for field in df.schema.fields:
        rule = rules.get(same(field.name))
        if rule is None or _names(principal) & rule.exempt:
            out.append(F.col(field.name))
        else:
            out.append(rule.mask(F.col(field.name), field.dataType).alias(field.name))
    return df.select(*out)


def _name_rule(df: DataFrame):
    """How the session tells column names apart."""
    return str if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower


def _denies() -> Column:
    """Only the effect ``allow`` allows, in any case of letters."""
    return ~F.coalesce(F.lower("effect") == "allow", F.lit(False))


def _rank() -> Column:
    """Place of ``mask`` from the most restrictive one on; no mask and unknown names rank with the mask null."""
    ranks = F.array(*[F.lit(m) for m in RESTRICTIVENESS])
    return F.greatest(F.coalesce(F.array_position(ranks, F.col("mask")), F.lit(1)), F.lit(1))


def attribute_policies(tags: DataFrame, policies: DataFrame, principal_attrs: DataFrame) -> DataFrame:
    """(principal, object, column, effect, mask) for every tagged column a policy speaks about.

    ``tags`` (object, column, tag); ``policies`` (tag, attr, attr_value, effect, mask);
    ``principal_attrs`` (principal, attr, attr_value). Deny beats allow, then the most
    restrictive mask wins. A NULL attribute matches nothing. Only the effect ``allow`` allows, in any
    case of letters; a NULL or other effect denies, and an allowed but unknown mask hides the value.
    """
    ranks = F.array(*[F.lit(m) for m in RESTRICTIVENESS])
    rules = policies.select("tag", "attr", "attr_value", _denies().alias("deny"), _rank().alias("rank"))
    held = principal_attrs.select("principal", "attr", "attr_value").distinct()
    # settle policies per principal and tag before columns multiply them
    per_tag = (
        held.join(rules, ["attr", "attr_value"])
        .groupBy("principal", "tag")
        .agg(F.max("deny").alias("deny"), F.min("rank").alias("rank"))
    )
    settled = (
        per_tag.join(tags.select("object", "column", "tag").distinct(), "tag")
        .groupBy("principal", "object", "column")
        .agg(F.max("deny").alias("deny"), F.min("rank").alias("rank"))
    )
    return settled.select(
        "principal", "object", "column",
        F.when(F.col("deny"), "deny").otherwise("allow").alias("effect"),
        F.element_at(ranks, F.col("rank").cast("int")).alias("mask"),
    )


def effective_privileges(grants: DataFrame, memberships: DataFrame, securables: DataFrame) -> DataFrame:
    """(principal, privilege, object_id) through nested groups and down the object tree.

    ``grants`` (principal, privilege, object_id); ``memberships`` (member, group);
    ``securables`` (object_id, parent_id).
    """
    groups = transitive_closure(memberships, "member", "group", with_path=False)
    groups = groups.select(F.col("node").alias("member"), F.col("ancestor").alias("principal"))
    direct = grants.select("principal", "privilege", "object_id").distinct()
    inherited = direct.join(groups, "principal").select(F.col("member").alias("principal"), "privilege", "object_id")
    held = direct.unionByName(inherited).distinct()
    tree = with_self(transitive_closure(securables, "object_id", "parent_id", with_path=False))
    below = tree.select(F.col("ancestor").alias("object_id"), F.col("node").alias("below"))
    reached = held.join(below, "object_id", "left")
    target = F.coalesce("below", "object_id")
    return reached.select("principal", "privilege", target.alias("object_id")).distinct()


def check_access(requests: DataFrame, privileges: Privileges) -> DataFrame:
    """Every distinct (principal, privilege, object_id) of ``requests`` with ``allowed``.

    Driven by what is asked: groups are followed up from the principals asked for, the tree from the
    objects asked for, and grants meet these only, so a log is checked without all principals' rights
    over all objects. A NULL in a request is never allowed.
    """
    asked = write_through(requests.select("principal", "privilege", "object_id").distinct(), "asked")
    who = reach_from(asked.select(F.col("principal").alias("start")), privileges.memberships, "member", "group")
    what = reach_from(asked.select(F.col("object_id").alias("start")), privileges.securables, "object_id", "parent_id")
    granted = privileges.grants.select(F.col("principal").alias("ancestor"), "privilege", F.col("object_id").alias("over"))
    held = who.join(granted, "ancestor").select(F.col("start").alias("principal"), "privilege", "over").distinct()
    above = asked.join(what.select(F.col("start").alias("object_id"), F.col("ancestor").alias("over")), "object_id")
    yes = above.join(held, ["principal", "privilege", "over"], "left_semi").select("principal", "privilege", "object_id").distinct()
    out = asked.join(yes.withColumn("__yes", F.lit(True)), ["principal", "privilege", "object_id"], "left")
    return out.select("principal", "privilege", "object_id", F.coalesce("__yes", F.lit(False)).alias("allowed"))


def secure_view(
    df: DataFrame,
    object_id: str,
    principal: str,
    privileges: DataFrame | Privileges,
    row_policies: list[RowPolicy],
    decisions: DataFrame,
    mask_options: dict | None = None,
) -> DataFrame:
    """One principal's view of a table: privilege, then row filter, then masks.

    ``privileges`` are what privileges follow from, and only this principal's groups and this table's
    parents are walked; policies and exemptions of those groups hold for the principal then. The stored
    result of :func:`effective_privileges` may stand for them. ``decisions`` is the result of
    :func:`attribute_policies`. Without SELECT there are no rows. Filters see raw values, the
    caller sees masked ones; denied columns and those with an unknown mask come back NULL. Of the
    decisions only this principal's for the table's real columns reach the driver, one per column;
    where names differ in case only, the most restrictive holds.
    """
    names = frozenset([principal])
    if isinstance(privileges, Privileges):
        names = names_of(principal, privileges.memberships)
        above = _upwards(object_id, privileges.securables, "object_id", "parent_id")
        found = privileges.grants.filter(F.col("principal").isin(*sorted(names)) & F.col("object_id").isin(*sorted(above)))
    else:
        found = privileges.filter((F.col("principal") == principal) & (F.col("object_id") == object_id))
    if found.filter(F.col("privilege") == "SELECT").isEmpty():
        return df.filter(F.lit(False))
    mine = decisions.filter((F.col("principal") == principal) & (F.col("object") == object_id))
    same = _name_rule(df)
    column = F.col("column") if same is str else F.lower("column")
    ranks = F.array(*[F.lit(m) for m in RESTRICTIVENESS])
    position = F.greatest(F.coalesce(F.array_position(ranks, F.col("mask")), F.lit(1)), F.lit(1))
    rank = F.when(F.coalesce(F.lower("effect") == "allow", F.lit(False)), position).otherwise(1)
    real = mine.filter(column.isin([same(c) for c in df.columns])).groupBy(column.alias("column"))
    options = {same(c): o for c, o in (mask_options or {}).items()}
    masks = {}
    for row in real.agg(F.min(rank).alias("rank")).collect():
        name = RESTRICTIVENESS[int(row["rank"]) - 1]
        masks[row["column"]] = ColumnMask(null() if name == "null" else by_name(name, **options.get(row["column"], {})))
    return column_mask(row_filter(df, row_policies, names), masks, names)


def policy_coverage(tags: DataFrame, policies: DataFrame) -> DataFrame:
    """Tagged columns with no policy that masks or denies them, by the rules of :func:`attribute_policies`.

    So a NULL or unknown effect denies, and a rule without a known mask hides the value: both cover.
    """
    open_rank = RESTRICTIVENESS.index("none") + 1
    covered = policies.filter(_denies() | (_rank() < open_rank)).select("tag").distinct()
    protected = tags.join(covered, "tag", "left_semi").select("object", "column").distinct()
    return tags.select("object", "column").distinct().join(protected, ["object", "column"], "left_anti")
