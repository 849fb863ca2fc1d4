"""Usage priced, attributed, allocated and checked. All money is integer cents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.operators.gold import gold_aggregate
from terrace.plans.chunks import HOT_ROWS, running_total, tag_chunks, untag, with_chunk
from terrace.plans.joins import all_of

UNALLOCATED = "unallocated"


def overlapping_prices(prices: DataFrame, keys: list[str]) -> DataFrame:
    """Price rows that start before the previous one of the same key has ended.

    A price list is a dimension: few rows per key.
    """
    w = Window.partitionBy(*keys).orderBy("valid_from", "valid_to")
    before = F.struct(F.lag("valid_from").over(w).alias("f"), F.lag("valid_to").over(w).alias("t"))
    rows = prices.withColumn("__b", before)
    clash = F.col("__b.f").isNotNull() & (F.col("__b.t").isNull() | (F.col("valid_from") < F.col("__b.t")))
    return rows.filter(clash).drop("__b")


def price_usage(usage: DataFrame, prices: DataFrame, keys: list[str], time: str, quantity: str, check: bool = True) -> DataFrame:
    """Usage with ``unit_cents`` in force at ``time`` and ``cost_cents``; NULL before the first price.

    ``prices`` (keys, valid_from, valid_to, unit_cents) with ``[valid_from, valid_to)``, NULL = open.
    Overlapping prices are refused: the check reads the price list only. The equality on ``keys``
    keeps the join partitioned, and each usage row meets the few prices of its key. The list is never
    broadcast: Spark takes its size from the files below, which says little of a list that grew from a few columns.
    """
    if check and not overlapping_prices(prices, keys).isEmpty():
        raise ValueError("prices of one key overlap")
    list_ = prices.select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col("valid_from").alias("__f"), F.col("valid_to").alias("__t"), "unit_cents"
    )
    on = all_of([F.col(k) == F.col(f"__{k}") for k in keys])
    on = on & (F.col(time) >= F.col("__f")) & (F.col("__t").isNull() | (F.col(time) < F.col("__t")))
    priced = usage.join(list_.hint("merge"), on, "left")
    return priced.select(
        *usage.columns, "unit_cents", F.round(F.col(quantity) * F.col("unit_cents")).cast("bigint").alias("cost_cents")
    )


def unpriced_usage(priced: DataFrame, keys: list[str], quantity: str) -> DataFrame:
    """(keys, n_unpriced, unpriced_quantity): usage that no price covers, which sums of cost pass over."""
    missing = priced.filter(F.col("cost_cents").isNull())
    return missing.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_unpriced"), F.sum(quantity).alias("unpriced_quantity"))


def attribute_cost(costs: DataFrame, tag_rules: DataFrame, workspace_owner: DataFrame, tag: str = "tag", workspace: str = "workspace") -> DataFrame:
    """Add ``owner`` and ``owner_by``: by tag, else by workspace, else unallocated.

    Of several owners for one tag or workspace the first by name is taken.
    """
    rules = tag_rules.groupBy(F.col("tag").alias("__tag")).agg(F.min("owner").alias("__by_tag"))
    owners = workspace_owner.groupBy(F.col("workspace").alias("__ws")).agg(F.min("owner").alias("__by_ws"))
    out = costs.join(rules, F.col(tag) == F.col("__tag"), "left").join(owners, F.col(workspace) == F.col("__ws"), "left")
    how = F.when(F.col("__by_tag").isNotNull(), "tag").when(F.col("__by_ws").isNotNull(), "workspace").otherwise("none")
    return out.select(
        *costs.columns, F.coalesce("__by_tag", "__by_ws", F.lit(UNALLOCATED)).alias("owner"), how.alias("owner_by")
    )


def _exact(op: str) -> Column:
    """``(__c * __v) op __w`` as a whole number; decimals only where the product outgrows 64 bits."""
    wide = f"cast((cast(__c as decimal(19,0)) * cast(__v as decimal(19,0))) {op} cast(__w as decimal(19,0)) as bigint)"
    return F.expr(f"if(try_multiply(__c, __v) is not null, try_multiply(__c, __v) {op} __w, {wide})")


def allocate_shared(pools: DataFrame, drivers: DataFrame, slots: int = 1024, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Split ``pools`` (pool, cents) over ``drivers`` (pool, id, weight) to the cent.

    Largest remainder: every driver gets the whole cents of its share, and the cents left go to
    the largest remainders; equal remainders are settled by the md5 of the id. Equal weights are
    used where all weights of a pool are zero; negative pools split like positive ones. A NULL weight
    counts as zero. A pool without drivers stays whole, in a row of its own with NULL for the driver,
    so that the parts of every pool add up to it. A pool of NULL cents gives each of its drivers NULL.

    A pool may hold very many drivers, so they are never ranked in one task: remainders are
    counted in ``slots`` per pool, slots above the cut get a cent wholesale, and only the one
    slot in which the cents run out is ranked, itself in chunks.
    """
    lone = pools.join(drivers.select("pool").distinct(), "pool", "left_anti")
    lone = lone.select(*[F.col(c) if c == "pool" else F.lit(None).cast(drivers.schema[c].dataType).alias(c) for c in drivers.columns], "cents")
    given = drivers.columns
    unknown = drivers.join(pools.filter(F.col("cents").isNull()), "pool").select(*given, "cents")
    pools = pools.filter(F.col("cents").isNotNull())
    drivers = drivers.withColumn("__weight", F.coalesce("weight", F.lit(0)))
    weights = drivers.groupBy("pool").agg(F.sum("__weight").alias("__w"), F.count(F.lit(1)).alias("__n"))
    pool = pools.join(weights, "pool").select(
        "pool", "cents", F.signum(F.col("cents").cast("double")).cast("bigint").alias("__sign"), F.abs("cents").alias("__c"),
        F.when(F.col("__w") > 0, F.col("__w")).otherwise(F.col("__n")).alias("__w"), (F.col("__w") <= 0).alias("__even"),
    )
    rows = drivers.join(pool, "pool")
    rows = rows.withColumn("__v", F.when(F.col("__even"), F.lit(1)).otherwise(F.col("__weight")).cast("bigint"))
    rows = rows.withColumns({"__share": _exact("div"), "__rem": _exact("%")})
    # the slot only has to grow with the remainder, so floating point will do
    part = F.floor(F.col("__rem").cast("double") / F.col("__w").cast("double") * slots).cast("int")
    rows = rows.withColumn("__slot", F.least(part, F.lit(slots - 1)))
    per_slot = rows.groupBy("pool", "__slot").agg(
        F.count(F.lit(1)).alias("__k"), F.sum("__share").alias("__given"), F.max("__c").alias("__all")
    )
    # at most ``slots`` rows per pool from here on
    whole_pool = Window.partitionBy("pool")
    above = whole_pool.orderBy(F.desc("__slot")).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("__all") - F.sum("__given").over(whole_pool)
    quota = left - F.coalesce(F.sum("__k").over(above), F.lit(0))
    cut = per_slot.select("pool", "__slot", "__k", quota.alias("__quota"))
    placed = rows.join(cut, ["pool", "__slot"])
    whole = placed.filter((F.col("__quota") <= 0) | (F.col("__quota") >= F.col("__k")))
    whole = whole.withColumn("__extra", (F.col("__quota") > 0).cast("bigint"))
    partly = placed.filter((F.col("__quota") > 0) & (F.col("__quota") < F.col("__k")))
    partly = partly.withColumn("__down", -F.col("__rem")).withColumn("__tie", F.md5(F.col("id").cast("string")))
    chunk = F.struct(F.col("__down"), F.substring("__tie", 1, 2))
    partly = with_chunk(partly, ["pool"], F.when(F.col("__k") > hot_rows, chunk))
    ranked = running_total(partly, ["__down", "__tie", "id"], F.lit(1).cast("bigint"), "__rank")
    ranked = ranked.withColumn("__extra", (F.col("__rank") <= F.col("__quota")).cast("bigint"))
    final = [*given, (F.col("__sign") * (F.col("__share") + F.col("__extra"))).alias("cents")]
    return whole.select(*final).unionByName(ranked.select(*final)).unionByName(lone).unionByName(unknown)


def cost_rollup(costs: DataFrame, levels: list[str], cents: str = "cost_cents") -> DataFrame:
    """Totals at every prefix of ``levels`` with ``grouping_id``."""
    return gold_aggregate(costs, levels, {cents: F.sum(cents)}, "rollup")


def budget_burn(
    costs: DataFrame, budgets: DataFrame, key: str, order: list[str], cents: str,
    chunk: Column | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Costs with the running ``spent_cents`` and ``breached`` against ``budgets(key, budget_cents)``."""
    tagged = tag_chunks(costs, [key], order[0], chunk, hot_rows)
    spent = untag(running_total(tagged, order, F.col(cents), "spent_cents"))
    return spent.join(budgets.select(key, "budget_cents"), key, "left").withColumn(
        "breached", F.coalesce(F.col("spent_cents") > F.col("budget_cents"), F.lit(False))
    )


def first_breach(burn: DataFrame, key: str, time: str) -> DataFrame:
    """(key, first_breach) for budgets that were exceeded."""
    return burn.filter("breached").groupBy(key).agg(F.min(time).alias("first_breach"))


def cost_trend(
    costs: DataFrame, period: Column, keys: list[str], cents: str, moving: int = 3, step: str = "1 month"
) -> DataFrame:
    """Total per period with the change to the period before and the mean of the last ``moving``.

    ``period`` is the start of a ``step``. A silent period between the first and the last one of a
    key is a row with no cents, so changes and means always meet neighbouring periods. Costs without
    a period keep a row of their own, next to none.
    """
    totals = costs.groupBy(*keys, period.alias("period")).agg(F.sum(cents).alias("cents"))
    w = Window.partitionBy(*keys, F.col("period").isNull()).orderBy("period")
    width = F.expr(f"INTERVAL {step}")
    last_silent = F.greatest("period", F.lead("period").over(w) - width)
    spaced = totals.withColumn("__until", F.coalesce(last_silent, "period"))
    own = F.when(F.col("period").isNull(), F.array("period")).otherwise(F.sequence("period", "__until", width))
    spent = F.when(F.col("__at").eqNullSafe(F.col("period")), F.col("cents")).otherwise(0)
    filled = spaced.withColumn("__at", F.explode(own)).select(*keys, F.col("__at").alias("period"), spent.alias("cents"))
    return filled.select(
        *keys, "period", "cents",
        (F.col("cents") - F.lag("cents").over(w)).alias("change_cents"),
        F.avg("cents").over(w.rowsBetween(-(moving - 1), 0)).alias("moving_mean"),
    )


def untagged_cost(attributed: DataFrame, workspace: str, cents: str) -> DataFrame:
    """Spend without an owner per workspace."""
    lost = attributed.filter(F.col("owner") == UNALLOCATED)
    return lost.groupBy(workspace).agg(F.sum(cents).alias(cents), F.count(F.lit(1)).alias("n_rows"))


def reconcile_cost(billed: DataFrame, attributed: DataFrame, period: str, cents: str) -> DataFrame:
    """(period, billed_cents, attributed_cents, gap_cents) for every period that does not agree."""
    b = billed.groupBy(period).agg(F.sum(cents).alias("billed_cents"))
    a = attributed.groupBy(F.col(period).alias("__p")).agg(F.sum(cents).alias("attributed_cents"))
    both = b.join(a, F.col(period).eqNullSafe(F.col("__p")), "full_outer")
    zero = F.lit(0).cast("bigint")
    out = both.select(
        F.coalesce(period, "__p").alias(period),
        F.coalesce("billed_cents", zero).alias("billed_cents"),
        F.coalesce("attributed_cents", zero).alias("attributed_cents"),
    )
    return out.withColumn("gap_cents", F.col("billed_cents") - F.col("attributed_cents")).filter("gap_cents <> 0")
