"""Directory, identities, orphaned access, drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.patterns import SENSITIVE
from terrace.functions.times import before
from terrace.operators import identity
from terrace.queries.inputs import MEMBERSHIPS_SQL, NEWEST_ORDER_SQL, SECOND_DAY, custom, custom_sql, memberships
from terrace.queries.registry import query
from terrace.sources.tables import table


def _directory(spark: SparkSession, sf: str, until: str | None = None) -> DataFrame:
    """Customers at a day; those with a single order count as inactive."""
    return custom(spark, sf, until).withColumn("active", F.col("n_orders") > 1)


@query(f"""
WITH c AS (SELECT *, n_orders > 1 AS active FROM ({custom_sql(SECOND_DAY)})),
d AS (SELECT *, n_orders > 1 AS active FROM ({custom_sql()})),
j AS (
  SELECT coalesce(d.custkey, c.custkey) AS custkey, c.custkey IS NOT NULL AS known, coalesce(c.active, false) AS was,
         coalesce(d.active, false) AS wanted, c.priority AS op, d.priority AS np
  FROM c FULL JOIN d ON c.custkey = d.custkey)
SELECT custkey, CASE WHEN was THEN CASE WHEN wanted THEN 'update' ELSE 'deactivate' END
            WHEN known THEN 'reactivate' ELSE 'create' END AS action,
       CASE WHEN was AND NOT wanted THEN op ELSE np END AS priority
FROM j WHERE (was <> wanted) OR (was AND wanted AND op <> np)
""")
def provision_plan(spark: SparkSession, sf: str) -> DataFrame:
    return identity.provision_plan(
        _directory(spark, sf), _directory(spark, sf, SECOND_DAY), "custkey", ["priority"]
    )


MEMBERS_SQL = f"""
SELECT o_custkey AS member, o_orderpriority AS grp FROM orders WHERE o_orderdate < TIMESTAMP '{{until}}'
GROUP BY ALL HAVING arg_max(o_orderstatus, {NEWEST_ORDER_SQL.replace("{", "{{").replace("}", "}}")}) <> 'F'
"""
LAST_DAY = "9999-01-01"


@query(f"""
WITH d AS ({MEMBERS_SQL.format(until=LAST_DAY)}), c AS ({MEMBERS_SQL.format(until=SECOND_DAY)})
SELECT 'add' AS action, member, grp AS "group" FROM (FROM d EXCEPT FROM c)
UNION ALL SELECT 'remove', member, grp FROM (FROM c EXCEPT FROM d)
""")
def membership_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Customers belong to the priorities whose newest order of theirs is not finished; now against an earlier day."""
    orders = table(spark, sf, "orders")
    newest = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus"))

    def members(rows: DataFrame) -> DataFrame:
        found = rows.groupBy(F.col("o_custkey").alias("member"), F.col("o_orderpriority").alias("group")).agg(newest.alias("newest"))
        return found.filter("newest.o_orderstatus <> 'F'").drop("newest")

    return identity.membership_plan(members(orders), members(orders.filter(before("o_orderdate", SECOND_DAY))))


EMAIL, PHONE, TOKEN = SENSITIVE["email"], SENSITIVE["phone"], SENSITIVE["token"]


@query(f"""
WITH RECURSIVE rec AS (SELECT {{'s': source, 'id': doc_id}} AS item, text FROM documents),
link AS (
  SELECT item, unnest([lower(x) FOR x IN regexp_extract_all(text, '{EMAIL}')]) AS k FROM rec
  UNION SELECT item, unnest(regexp_extract_all(text, '{PHONE}')) FROM rec
  UNION SELECT item, unnest(regexp_extract_all(text, '{TOKEN}')) FROM rec),
near AS (SELECT DISTINCT a.item, b.item AS other FROM link a JOIN link b ON a.k = b.k),
reach AS (SELECT item, item AS other FROM rec UNION SELECT r.item, n.other FROM reach r JOIN near n ON r.other = n.item),
lab AS (SELECT item, min(other) AS label FROM reach GROUP BY item),
src AS (SELECT label, item.s AS source, count(*) AS n FROM lab GROUP BY ALL),
dup AS (SELECT DISTINCT label FROM src WHERE n > 1)
SELECT item.s AS source, item.id AS record_id, lab.label.s AS canonical_source, lab.label.id AS canonical_record_id,
       dup.label IS NOT NULL AS is_ambiguous
FROM lab LEFT JOIN dup ON lab.label = dup.label
""")
def match_identities(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as records of people, linked by the e-mails, phones and tokens in their whole text."""
    docs = table(spark, sf, "documents").select("source", F.col("doc_id").alias("record_id"), "text")

    def found(pattern: str):
        return F.regexp_extract_all("text", F.lit(pattern), F.lit(0))

    rules = {
        "email": F.transform(found(EMAIL), lambda v: F.lower(v)), "phone": found(PHONE), "token": found(TOKEN),
    }
    return identity.match_identities(docs, rules)


@query(f"""
WITH RECURSIVE e AS ({MEMBERSHIPS_SQL}),
up AS (SELECT member, grp, 1 AS depth FROM e UNION ALL SELECT up.member, e.grp, up.depth + 1 FROM up JOIN e ON up.grp = e.member)
SELECT member, grp AS "group", depth FROM up
""")
def group_closure(spark: SparkSession, sf: str) -> DataFrame:
    return identity.group_closure(memberships(spark, sf))


@query(f"""
WITH u AS (SELECT custkey, n_orders > 1 AS active FROM ({custom_sql()}))
SELECT DISTINCT o_custkey AS principal, o_orderpriority AS object_id, CASE WHEN custkey IS NULL THEN 'unknown' ELSE 'inactive' END AS reason
FROM orders LEFT JOIN u ON o_custkey = custkey WHERE custkey IS NULL OR NOT active
""")
def orphaned_access(spark: SparkSession, sf: str) -> DataFrame:
    """Access ever granted that the users of today no longer back."""
    granted = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("principal"), F.col("o_orderpriority").alias("object_id")
    )
    users = _directory(spark, sf).select(F.col("custkey").alias("principal"), "active")
    return identity.orphaned_access(granted.distinct(), users)


SETTINGS_SQL = """
SELECT env, resource, key, CAST(newest.size AS VARCHAR) AS value FROM (
  SELECT p_type AS env, 's' || l_suppkey AS resource, p_brand AS key,
         max({{'day': l_shipdate, 'order': l_orderkey, 'line': l_linenumber, 'flag': l_returnflag, 'size': p_size}}) AS newest
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_shipdate < TIMESTAMP '{until}' GROUP BY ALL)
WHERE newest.flag <> 'R'
"""


@query(f"""
WITH d AS ({SETTINGS_SQL.format(until=LAST_DAY)}), a AS ({SETTINGS_SQL.format(until=SECOND_DAY)})
SELECT coalesce(d.env, a.env) AS env, coalesce(d.resource, a.resource) AS resource, coalesce(d.key, a.key) AS key,
       CASE WHEN a.env IS NULL THEN 'missing' WHEN d.env IS NULL THEN 'extra' ELSE 'changed' END AS drift,
       d.value AS desired, a.value AS actual
FROM d FULL JOIN a ON d.env = a.env AND d.resource = a.resource AND d.key = a.key
WHERE d.env IS NULL OR a.env IS NULL OR d.value <> a.value
""")
def config_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Newest size per type, supplier and brand, gone once returned: all shipments as desired, those to a day as actual settings."""
    line, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    newest = F.max(F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag", "p_size"))

    def settings(lines: DataFrame) -> DataFrame:
        found = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy(
            F.col("p_type").alias("env"), F.concat(F.lit("s"), "l_suppkey").alias("resource"), F.col("p_brand").alias("key")
        ).agg(newest.alias("newest"))
        return found.filter("newest.l_returnflag <> 'R'").select("env", "resource", "key", F.col("newest.p_size").cast("string").alias("value"))

    return identity.config_drift(settings(line), settings(line.filter(before("l_shipdate", SECOND_DAY))))
