"""Row filters, masks, policies, privileges, encryption, redaction, networks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import masks
from terrace.functions.money import from_units
from terrace.functions.patterns import SENSITIVE
from terrace.operators import access, gold, protection
from terrace.queries.inputs import ACCESS_LOG_SQL, MEMBERSHIPS_SQL, access_log, memberships
from terrace.queries.ingest import order_revenue
from terrace.queries.registry import query
from terrace.session import write_through
from terrace.sources.tables import table


def _nations_of(spark: SparkSession, sf: str) -> DataFrame:
    """(principal, value): analysts of a region may see the nations of that region."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    both = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return both.select(F.concat(F.lit("analyst "), "r_name").alias("principal"), F.col("n_nationkey").alias("value"))


@query("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' OR c_mktsegment = 'BUILDING'
""")
def row_filter(spark: SparkSession, sf: str) -> DataFrame:
    """One policy by mapping table, one by predicate."""
    me = "analyst ASIA"
    policies = [
        access.RowPolicy(frozenset(), column="c_nationkey", mapping=_nations_of(spark, sf)),
        access.RowPolicy(frozenset({me}), predicate=F.col("c_mktsegment") == "BUILDING"),
    ]
    return access.row_filter(table(spark, sf, "customer"), policies, me)


@query("""
SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_orderstatus, CAST(floor(o_totalprice / 50000) * 50000 AS DOUBLE) AS o_totalprice,
       date_trunc('year', o_orderdate) AS o_orderdate, repeat('*', length(o_orderpriority) - 3) || right(o_orderpriority, 3) AS o_orderpriority,
       sha256('s1' || o_custkey) AS o_custkey
FROM orders
""")
def column_mask(spark: SparkSession, sf: str) -> DataFrame:
    rules = {
        "o_orderstatus": access.ColumnMask(masks.null()),
        "o_totalprice": access.ColumnMask(masks.bucket(50_000)),
        "o_orderdate": access.ColumnMask(masks.year_only()),
        "o_orderpriority": access.ColumnMask(masks.partial(3)),
        "o_custkey": access.ColumnMask(masks.hashed("s1")),
        "o_orderkey": access.ColumnMask(masks.redact(), frozenset({"auditor"})),
    }
    return access.column_mask(table(spark, sf, "orders"), rules, "auditor")


@query("""
SELECT s_suppkey, 'REDACTED' AS s_name, CAST(0 AS DOUBLE) AS s_acctbal, s_nationkey,
       regexp_replace(regexp_replace(regexp_replace(s_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS shape
FROM supplier
""")
def column_mask_redact(spark: SparkSession, sf: str) -> DataFrame:
    rules = {
        "s_name": access.ColumnMask(masks.redact()), "s_acctbal": access.ColumnMask(masks.redact()),
        "shape": access.ColumnMask(masks.letters()),
    }
    return access.column_mask(table(spark, sf, "supplier").withColumn("shape", F.col("s_name")), rules, "anyone")


SCAN_SQL = " UNION ALL ".join(
    f"SELECT source, 'text' AS \"column\", '{tag}' AS tag, count(*) FILTER (WHERE regexp_matches(text, '{p}')) AS hits, "
    "count(*) AS n_rows FROM documents GROUP BY source"
    for tag, p in SENSITIVE.items()
)


@query(SCAN_SQL)
def scan_sensitive(spark: SparkSession, sf: str) -> DataFrame:
    return protection.scan_sensitive(table(spark, sf, "documents"), ["text"], by=["source"])


# Which attribute of a principal settles which tag, and how.
POLICIES = [
    ("email", "segment", "BUILDING", "allow", "partial"),
    ("email", "segment", "MACHINERY", "allow", "hash"),
    ("email", "balance", "low", "deny", "null"),
    ("phone", "segment", "BUILDING", "allow", "none"),
    ("phone", "segment", "FURNITURE", "allow", "redact"),
    ("phone", "balance", "high", "allow", "partial"),
    ("token", "balance", "high", "deny", "null"),
    ("card", "segment", "HOUSEHOLD", "allow", "bucket"),
]


def _policies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POLICIES, "tag string, attr string, attr_value string, effect string, mask string")


def _attributes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as principals with their segment and a class of balance."""
    c = table(spark, sf, "customer")
    level = F.when(F.col("c_acctbal") < 0, "low").when(F.col("c_acctbal") > 9000, "high")
    pairs = F.array(
        F.struct(F.lit("segment").alias("attr"), F.col("c_mktsegment").alias("attr_value")),
        F.struct(F.lit("balance").alias("attr"), level.alias("attr_value")),
    )
    return c.select(F.concat(F.lit("u"), "c_custkey").alias("principal"), F.explode(pairs).alias("a")).select("principal", "a.*")


POLICIES_SQL = "(VALUES " + ", ".join(str(p) for p in POLICIES) + ") AS p(tag, attr, attr_value, effect, mask)"
RANK_SQL = "list_position(['null', 'redact', 'hash', 'partial', 'bucket', 'none'], mask)"
TAGS_SQL = f"SELECT source AS object, \"column\", tag FROM ({SCAN_SQL}) WHERE hits > 0"


@query(f"""
WITH attrs AS (
  SELECT 'u' || c_custkey AS principal, 'segment' AS attr, c_mktsegment AS attr_value FROM customer
  UNION ALL SELECT 'u' || c_custkey, 'balance', CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal > 9000 THEN 'high' END FROM customer),
hit AS (SELECT principal, object, "column", effect, {RANK_SQL} AS rank
        FROM attrs JOIN {POLICIES_SQL} USING (attr, attr_value) JOIN ({TAGS_SQL}) t USING (tag))
SELECT principal, object, "column", CASE WHEN max(effect) = 'deny' THEN 'deny' ELSE 'allow' END AS effect,
       ['null', 'redact', 'hash', 'partial', 'bucket', 'none'][min(rank)] AS mask
FROM hit GROUP BY principal, object, "column"
""")
def attribute_policies(spark: SparkSession, sf: str) -> DataFrame:
    """Document sources as objects, tagged by what the scan finds; customers as principals."""
    scan = protection.scan_sensitive(table(spark, sf, "documents"), ["text"], by=["source"])
    tags = protection.tags_from_scan(scan, "source")
    return access.attribute_policies(tags, _policies(spark), _attributes(spark, sf))


@query(f"""
WITH t AS ({TAGS_SQL}), p AS (SELECT DISTINCT tag FROM {POLICIES_SQL} WHERE effect = 'deny' OR mask <> 'none')
SELECT DISTINCT t.object || ' ' || t.tag AS object, t."column" FROM t WHERE t.tag NOT IN (FROM p)
""")
def policy_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """One object per source and kind of finding: which are left open by the policies."""
    scan = protection.scan_sensitive(table(spark, sf, "documents"), ["text"], by=["source"])
    tags = protection.tags_from_scan(scan, "source").withColumn("object", F.concat_ws(" ", "object", "tag"))
    return access.policy_coverage(tags, _policies(spark))


def _grants(spark: SparkSession, sf: str) -> DataFrame:
    """Regions read the brands of their number, nations change one type, users read all of a region's catalog."""
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    by_region = table(spark, sf, "region").select(
        F.concat(F.lit("r"), "r_regionkey").alias("principal"), F.lit("SELECT").alias("privilege"),
        F.concat(F.lit("Brand#"), F.col("r_regionkey") + 1).alias("object_id"),
    )
    by_nation = n.select(
        F.concat(F.lit("n"), "n_nationkey").alias("principal"), F.lit("MODIFY").alias("privilege"),
        F.concat(F.lit("Brand#"), F.col("n_nationkey") + 1, F.lit("/PROMO")).alias("object_id"),
    )
    by_user = c.filter("c_acctbal > 9000").select(
        F.concat(F.lit("u"), "c_custkey").alias("principal"), F.lit("SELECT").alias("privilege"), F.lit("shop").alias("object_id")
    )
    return by_region.unionAll(by_nation).unionAll(by_user)


def _securables(spark: SparkSession, sf: str) -> DataFrame:
    """Brand and type below brand below one catalog."""
    pairs = table(spark, sf, "part").select("p_brand", "p_type").distinct()
    tables = pairs.select(F.concat_ws("/", "p_brand", "p_type").alias("object_id"), F.col("p_brand").alias("parent_id"))
    schemas = pairs.select(F.col("p_brand").alias("object_id"), F.lit("shop").alias("parent_id")).distinct()
    return tables.unionAll(schemas)


PRIVILEGES_SQL = f"""
WITH RECURSIVE e AS ({MEMBERSHIPS_SQL}),
grants AS (
  SELECT 'r' || r_regionkey AS principal, 'SELECT' AS privilege, 'Brand#' || (r_regionkey + 1) AS object_id FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'MODIFY', 'Brand#' || (n_nationkey + 1) || '/PROMO' FROM nation
  UNION ALL SELECT 'u' || c_custkey, 'SELECT', 'shop' FROM customer WHERE c_acctbal > 9000),
tree AS (
  SELECT DISTINCT p_brand || '/' || p_type AS o, p_brand AS up FROM part UNION SELECT DISTINCT p_brand, 'shop' FROM part),
held AS (
  SELECT principal, privilege, object_id FROM grants
  UNION SELECT e.member, h.privilege, h.object_id FROM held h JOIN e ON h.principal = e.grp),
down AS (
  SELECT principal, privilege, object_id FROM held
  UNION SELECT d.principal, d.privilege, t.o FROM down d JOIN tree t ON d.object_id = t.up)
SELECT principal, privilege, object_id FROM down
"""


@query(PRIVILEGES_SQL)
def effective_privileges(spark: SparkSession, sf: str) -> DataFrame:
    return access.effective_privileges(_grants(spark, sf), memberships(spark, sf), _securables(spark, sf))


@query(f"""
WITH a AS (SELECT DISTINCT 'u' || o_custkey AS principal, 'SELECT' AS privilege, p_brand || '/' || p_type AS object_id
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
p AS ({PRIVILEGES_SQL})
SELECT a.*, (a.principal, a.privilege, a.object_id) IN (SELECT (p.principal, p.privilege, p.object_id) FROM p) AS allowed FROM a
""")
def check_access(spark: SparkSession, sf: str) -> DataFrame:
    """Every purchase of a part taken for a read of its kind by the customer."""
    parts = table(spark, sf, "part").select("p_partkey", F.concat_ws("/", "p_brand", "p_type").alias("object_id"))
    bought = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    log = bought.join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    asked = log.select(F.concat(F.lit("u"), "o_custkey").alias("principal"), F.lit("SELECT").alias("privilege"), "object_id")
    return access.check_access(asked, access.Privileges(_grants(spark, sf), memberships(spark, sf), _securables(spark, sf)))


def secured_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as the analysts of ASIA may see them."""
    me, object_id = "analyst ASIA", "customer"
    c = table(spark, sf, "customer")
    regions = _nations_of(spark, sf).select("principal").distinct()
    grants = regions.select(F.lit("analysts").alias("principal"), F.lit("SELECT").alias("privilege"), F.lit("sales").alias("object_id"))
    groups = regions.select(F.col("principal").alias("member"), F.lit("analysts").alias("group"))
    tree = regions.select(F.lit(object_id).alias("object_id"), F.lit("sales").alias("parent_id")).distinct()
    privileges = access.Privileges(grants, groups, tree)
    spark_rows = [("customer", "c_acctbal", "money"), ("customer", "c_name", "person")]
    tags = spark.createDataFrame(spark_rows, "object string, column string, tag string")
    rules = spark.createDataFrame(
        [("money", "role", "analyst", "allow", "bucket"), ("person", "role", "analyst", "allow", "partial")],
        "tag string, attr string, attr_value string, effect string, mask string",
    )
    attrs = regions.select("principal", F.lit("role").alias("attr"), F.lit("analyst").alias("attr_value"))
    decisions = access.attribute_policies(tags, rules, attrs)
    rows = [access.RowPolicy(frozenset(), column="c_nationkey", mapping=_nations_of(spark, sf))]
    return access.secure_view(
        c, object_id, me, privileges, rows, decisions, {"c_acctbal": {"width": 1000}, "c_name": {"keep": 3}}
    )


@query("""
SELECT c_custkey, repeat('*', length(c_name) - 3) || right(c_name, 3) AS c_name, c_nationkey,
       CAST(floor(c_acctbal / 1000) * 1000 AS DOUBLE) AS c_acctbal, c_mktsegment
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'
""")
def secure_view(spark: SparkSession, sf: str) -> DataFrame:
    return secured_customers(spark, sf)


@query("""
SELECT n_name, c_mktsegment, c_acctbal AS balance_class, count(DISTINCT l_orderkey) AS n_orders,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN (SELECT c_custkey, c_nationkey, c_mktsegment, CAST(floor(c_acctbal / 1000) * 1000 AS DOUBLE) AS c_acctbal FROM customer) ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' AND l_quantity > 0 GROUP BY ALL
""")
def secured_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """The serving table an analyst of one region gets: secured customers, clean line items, star join."""
    people = secured_customers(spark, sf).select("c_custkey", "c_nationkey", "c_mktsegment", F.col("c_acctbal").alias("balance_class"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    visible = orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    rows = order_revenue(spark, sf).join(visible, F.col("l_orderkey") == F.col("o_orderkey"))
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    star = gold.conform_star(rows, {"nation": (nations, "c_nationkey", "n_nationkey")})
    return gold.gold_aggregate(
        star, ["n_name", "c_mktsegment", "balance_class"], {"n_orders": F.count(F.lit(1)), "revenue": from_units(F.col("units"))}
    )


def _keyring(spark: SparkSession, sf: str, versions: int) -> DataFrame:
    """One demonstration key per nation and version; a caller brings keys of its own."""
    ring = table(spark, sf, "nation").select("n_nationkey", F.explode(F.sequence(F.lit(1), F.lit(versions))).alias("key_version"))
    key = F.unhex(F.md5(F.concat_ws("-", F.lit("demo"), "n_nationkey", "key_version")))
    return ring.select(F.col("n_nationkey").alias("tenant"), "key_version", key.alias("key"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def decrypt_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Encrypted per nation and back."""
    ring = _keyring(spark, sf, 1)
    sealed = protection.encrypt_columns(table(spark, sf, "customer"), ["c_name", "c_acctbal"], ring, "c_nationkey", 1)
    return protection.decrypt_columns(sealed, {"c_name": "string", "c_acctbal": "double"}, ring, "c_nationkey")


@query("""
SELECT c_custkey, true AS sealed, 2 AS key_version FROM customer
""")
def encrypt_columns(spark: SparkSession, sf: str) -> DataFrame:
    """No ciphertext shows its value, and every row names its key."""
    ring = _keyring(spark, sf, 2)
    c = table(spark, sf, "customer").withColumn("plain", F.col("c_name"))
    out = protection.encrypt_columns(c, ["c_name"], ring, "c_nationkey", 2)
    hidden = F.length("c_name") > F.length("plain")
    return out.select("c_custkey", hidden.alias("sealed"), "key_version")


@query("""
SELECT c_custkey, c_name, c_acctbal, 2 AS key_version, c_acctbal < 5000 AS reencrypted FROM customer
""")
def rotate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Poor customers still have key 1, the others key 2. After rotation to 2 the bytes of the former alone have changed, and all read back alike."""
    ring = _keyring(spark, sf, 2)
    c = table(spark, sf, "customer")
    cols = ["c_name"]
    old = protection.encrypt_columns(c.filter("c_acctbal < 5000"), cols, ring, "c_nationkey", 1)
    new = protection.encrypt_columns(c.filter("c_acctbal >= 5000"), cols, ring, "c_nationkey", 2)
    # ciphertext is random: stored once, so that bytes before and after can be told apart
    sealed = write_through(old.unionByName(new).withColumn("before", F.col("c_name")), "sealed")
    rotated = protection.rotate_keys(sealed, cols, ring, "c_nationkey", 2)
    changed = rotated.withColumns({"version_now": F.col("key_version"), "reencrypted": F.col("before") != F.col("c_name")})
    plain = protection.decrypt_columns(changed, {"c_name": "string"}, ring, "c_nationkey")
    return plain.select("c_custkey", "c_name", "c_acctbal", F.col("version_now").alias("key_version"), "reencrypted")


@query("SELECT c_custkey, sha256('s1:' || c_name) AS c_name, sha256('s1:' || c_nationkey) AS c_nationkey FROM customer")
def pseudonymise(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return protection.pseudonymise(rows, ["c_name", "c_nationkey"], "s1")


def redacted_sql() -> str:
    text = "text"
    for tag, pattern in SENSITIVE.items():
        text = f"regexp_replace({text}, '{pattern}', '<{tag.upper()}>', 'g')"
    return text


@query(f"SELECT doc_id, sha256({redacted_sql()}) AS digest, {redacted_sql()} <> text AS changed FROM documents")
def redact_text(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts; only a digest of each is returned."""
    docs = table(spark, sf, "documents").select("doc_id", "text", F.col("text").alias("raw"))
    out = protection.redact_text(docs, "text")
    return out.select("doc_id", F.sha2("text", 256).alias("digest"), (F.col("text") != F.col("raw")).alias("changed"))


@query(f"""
SELECT event_id, user_id, addr FROM ({ACCESS_LOG_SQL})
WHERE NOT (addr BETWEEN 167772160 AND 167903231 OR addr BETWEEN 168034304 AND 168099839)
""")
def network_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Accesses from outside 10.0.0.0-10.1.255.255 and 10.4.0.0-10.4.255.255."""
    allowed = spark.createDataFrame(
        [("10.0.0.0", "10.1.255.255", "corp"), ("10.4.0.0", "10.4.255.255", "vpn")], "first string, last string, name string"
    ).select(protection.ipv4_number("first").alias("low"), protection.ipv4_number("last").alias("high"), "name")
    return protection.network_violations(access_log(spark, sf), "addr", allowed).select("event_id", "user_id", "addr")
