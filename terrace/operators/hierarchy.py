"""Account trees, workspaces and the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.layout import write_partitioned
from terrace.plans.closure import transitive_closure


def expand_hierarchy(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(node, ancestor, depth, path, is_cycle) for every ancestor; cycles show as nodes above themselves."""
    pairs = transitive_closure(edges, child, parent)
    return pairs.withColumn("is_cycle", F.col("node") == F.col("ancestor"))


def with_self(closure: DataFrame) -> DataFrame:
    """(node, ancestor) with every node also at its own level."""
    pairs = closure.select("node", "ancestor")
    nodes = pairs.select("node").unionAll(pairs.select(F.col("ancestor").alias("node"))).distinct()
    return pairs.unionAll(nodes.select("node", F.col("node").alias("ancestor"))).distinct()


def hierarchy_rollup(facts: DataFrame, node: str, edges: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Sums of ``measures`` at every node of the tree, own rows included.

    Facts are reduced to one row per node before they meet the tree, so the join multiplies
    nodes by their depth and never rows. A node outside the tree keeps its own level, and facts
    without a node stay under NULL, so nothing is lost.
    """
    per_node = facts.groupBy(F.col(node).alias("__node")).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    closure = with_self(transitive_closure(edges, "child", "parent", with_path=False))
    joined = per_node.join(closure, F.col("__node") == F.col("node"), "left")
    return joined.groupBy(F.coalesce("ancestor", "__node").alias("node")).agg(*[F.sum(n).alias(n) for n in measures])


def tag_workspace(df: DataFrame, on: str, mapping: DataFrame) -> DataFrame:
    """Add ``workspace`` from ``mapping(on, workspace)``; NULL where there is no mapping.

    Of several workspaces for one value the first by name is taken.
    """
    return df.join(mapping.groupBy(on).agg(F.min("workspace").alias("workspace")), on, "left")


def route_by_workspace(df: DataFrame, on: str, mapping: DataFrame, path: str, unmapped: str = "_unmapped") -> None:
    """Write every row below its workspace's folder; rows without a workspace go to ``unmapped``."""
    tagged = tag_workspace(df, on, mapping).withColumn("workspace", F.coalesce("workspace", F.lit(unmapped)))
    write_partitioned(tagged, path, ["workspace"])


def resolve_bindings(workspaces: DataFrame, catalogs: DataFrame, bindings: DataFrame) -> DataFrame:
    """(workspace, catalog) pairs in force: explicit bindings, and open catalogs for every workspace.

    ``catalogs`` has (catalog, is_open); an open catalog is visible everywhere. The list has a row for
    each workspace and open catalog: to check accesses take :func:`binding_violations`, which writes none.
    """
    bound, open_ = binding_rules(workspaces, catalogs, bindings)
    # all rows of both sides meet under one key, which AQE may split
    everywhere = workspaces.select("workspace", F.lit(True).alias("__all")).join(open_.withColumn("__all", F.lit(True)), "__all")
    return bound.unionByName(everywhere.select("workspace", "catalog")).distinct()


def binding_rules(workspaces: DataFrame, catalogs: DataFrame, bindings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bound (workspace, catalog) pairs of known names, and the open catalogs."""
    bound = bindings.select("workspace", "catalog").distinct()
    bound = bound.join(workspaces.select("workspace"), "workspace", "left_semi")
    bound = bound.join(catalogs.select("catalog"), "catalog", "left_semi").select("workspace", "catalog")
    return bound, catalogs.filter("is_open").select("catalog").distinct()


def binding_violations(workspaces: DataFrame, catalogs: DataFrame, bindings: DataFrame, access_log: DataFrame) -> DataFrame:
    """(workspace, catalog, n_accesses) for accesses by neither a binding nor an open catalog.

    The log is reduced first; what is left meets the bound pairs and, for known workspaces, the open
    catalogs, so pairs that nobody used are never written. Accesses without a name are violations.
    """
    bound, open_ = binding_rules(workspaces, catalogs, bindings)
    seen = access_log.groupBy("workspace", "catalog").agg(F.count(F.lit(1)).alias("n_accesses"))
    unbound = seen.join(bound, ["workspace", "catalog"], "left_anti")
    known = workspaces.select("workspace").distinct().withColumn("__known", F.lit(True))
    free = open_.withColumn("__open", F.lit(True))
    flagged = unbound.join(known, "workspace", "left").join(free, "catalog", "left")
    return flagged.filter(F.col("__known").isNull() | F.col("__open").isNull()).select("workspace", "catalog", "n_accesses")


def catalog_report(securables: DataFrame, access_log: DataFrame, as_of: Column, stale_days: int, exact: bool = False) -> DataFrame:
    """Per object: last use, number of readers, ``is_stale`` and ``is_ownerless``.

    ``securables`` has (object_id, owner), ``access_log`` (object_id, reader, at).
    """
    readers = F.count_distinct("reader") if exact else F.approx_count_distinct("reader")
    use = access_log.filter(F.col("at") <= as_of).groupBy("object_id").agg(
        F.max("at").alias("last_used"), readers.alias("n_readers"), F.count(F.lit(1)).alias("n_reads")
    )
    idle = F.datediff(as_of.cast("date"), F.col("last_used").cast("date"))
    return securables.join(use, "object_id", "left").select(
        *securables.columns,
        "last_used",
        F.coalesce("n_readers", F.lit(0)).alias("n_readers"),
        F.coalesce("n_reads", F.lit(0)).alias("n_reads"),
        F.coalesce(idle > stale_days, F.lit(True)).alias("is_stale"),
        F.col("owner").isNull().alias("is_ownerless"),
    )
