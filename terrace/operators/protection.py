"""Encryption, pseudonyms, detection and redaction of sensitive values, network rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.patterns import ALWAYS_THERE, SENSITIVE


def _keyed(df: DataFrame, tenant: str, keyring: DataFrame, version: Column, prefix: str, needed: Column | None = None) -> DataFrame:
    """Add ``__<prefix>_key`` for (tenant, version); a missing key stops the job when it is used, where it is ``needed``."""
    ring = keyring.select(
        F.col("tenant").alias(f"__{prefix}_t"), F.col("key_version").alias(f"__{prefix}_v"),
        F.col("key").alias(f"__{prefix}_key"),
    )
    on = (F.col(tenant) == F.col(f"__{prefix}_t")) & (version == F.col(f"__{prefix}_v"))
    joined = df.join(ring, on, "left").drop(f"__{prefix}_t", f"__{prefix}_v")
    missing = F.concat(F.lit("no key for version "), F.coalesce(version.cast("string"), F.lit("NULL")))
    key = F.coalesce(F.col(f"__{prefix}_key"), F.raise_error(missing).cast("binary"))
    return joined.withColumn(f"__{prefix}_key", key if needed is None else F.when(needed, key))


def _seal(value: Column, key: Column) -> Column:
    return F.when(value.isNotNull(), F.aes_encrypt(value.cast("string"), key, F.lit("GCM")))


def _open(value: Column, key: Column) -> Column:
    return F.when(value.isNotNull(), F.aes_decrypt(value, key, F.lit("GCM")).cast("string"))


def encrypt_columns(df: DataFrame, cols: list[str], keyring: DataFrame, tenant: str, version: int) -> DataFrame:
    """AES-GCM per tenant; ``cols`` become binary, ``key_version`` is added. NULL stays NULL.

    ``keyring`` (tenant, key_version, key) is a table of the caller: keys are data, never literals
    in a plan. It has one row per tenant and version, so Spark broadcasts it when small and AQE
    splits a tenant that holds much of the data.
    """
    keyed = _keyed(df, tenant, keyring, F.lit(version), "new")
    sealed = [_seal(F.col(c), F.col("__new_key")).alias(c) if c in cols else F.col(c) for c in df.columns]
    return keyed.select(*sealed, F.lit(version).alias("key_version"))


def decrypt_columns(df: DataFrame, cols: dict[str, str], keyring: DataFrame, tenant: str) -> DataFrame:
    """Back to the types given in ``cols``; each row names its key version."""
    keyed = _keyed(df, tenant, keyring, F.col("key_version"), "old")
    out = [
        _open(F.col(c), F.col("__old_key")).cast(cols[c]).alias(c) if c in cols else F.col(c)
        for c in df.columns
        if c != "key_version"
    ]
    return keyed.select(*out)


def rotate_keys(df: DataFrame, cols: list[str], keyring: DataFrame, tenant: str, new_version: int) -> DataFrame:
    """Re-encrypt rows below ``new_version``; newer rows keep their bytes."""
    stale = F.coalesce(F.col("key_version") < new_version, F.lit(False))
    keyed = _keyed(df, tenant, keyring, F.col("key_version"), "old", stale)
    keyed = _keyed(keyed, tenant, keyring, F.lit(new_version), "new", stale)
    out = [
        F.when(stale, _seal(_open(F.col(c), F.col("__old_key")), F.col("__new_key"))).otherwise(F.col(c)).alias(c) if c in cols
        else F.when(stale, F.lit(new_version)).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c) if c == "key_version" else F.col(c)
        for c in df.columns
    ]
    return keyed.select(*out)


def pseudonymise(df: DataFrame, cols: list[str], salt: str) -> DataFrame:
    """Stable tokens that still join: sha256 of ``salt:value``."""
    return df.select(
        *[
            F.sha2(F.concat(F.lit(salt + ":"), F.col(c).cast("string")), 256).alias(c) if c in cols else F.col(c)
            for c in df.columns
        ]
    )


def _may_match(text: Column, pattern: str) -> Column:
    """False only where the pattern cannot match."""
    needed = ALWAYS_THERE.get(pattern)
    return F.lit(True) if needed is None else text.contains(needed)


def scan_sensitive(df: DataFrame, cols: list[str], patterns: dict[str, str] = SENSITIVE, by: list[str] | None = None) -> DataFrame:
    """(by, column, tag, hits, n_rows) in one pass over the text."""
    by = by or []
    checks = [(c, tag, p) for c in cols for tag, p in patterns.items()]
    wide = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(_may_match(F.col(c), p) & F.col(c).rlike(p), 1)).alias(f"__h{i}") for i, (c, _, p) in enumerate(checks)],
    )
    found = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(tag).alias("tag"), F.col(f"__h{i}").alias("hits"))
            for i, (c, tag, _) in enumerate(checks)
        ]
    )
    return wide.select(*by, "n_rows", F.explode(found).alias("f")).select(*by, "f.*", "n_rows")


def tags_from_scan(scan: DataFrame, object_col: str, min_rate: float = 0.0) -> DataFrame:
    """(object, column, tag) where the share of rows that hit exceeds ``min_rate``."""
    return scan.filter(F.col("hits") / F.col("n_rows") > min_rate).select(
        F.col(object_col).alias("object"), "column", "tag"
    )


def redact_text(df: DataFrame, col: str, patterns: dict[str, str] = SENSITIVE) -> DataFrame:
    """Replace each match by ``<TAG>``, patterns in the given order."""
    text = F.col(col)
    for tag, pattern in patterns.items():
        replaced = F.regexp_replace(text, pattern, f"<{tag.upper()}>")
        df = df.withColumn(col, F.when(_may_match(text, pattern), replaced).otherwise(text))
    return df


def ipv4_number(address: str | Column) -> Column:
    """Dotted quad as a number; NULL when it is not an address."""
    c = F.col(address) if isinstance(address, str) else address
    parts = F.split(c, r"\.")
    octets = [F.get(parts, F.lit(i)).try_cast("bigint") for i in range(4)]
    number = octets[0] * 2**24 + octets[1] * 2**16 + octets[2] * 2**8 + octets[3]
    legal = (F.size(parts) == 4) & (F.greatest(*octets) < 256) & (F.least(*octets) >= 0)
    return F.when(legal, number)


def network_violations(access_log: DataFrame, addr: str, allow_ranges: DataFrame) -> DataFrame:
    """Accesses outside every allowed range ``(low, high)``, both ends inclusive; NULL is outside.

    Ranges are cut at /16 borders, so the join has an equality on the upper half of the address
    and each range adds at most 65,536 rows.
    """
    cut = allow_ranges.select(
        "low", "high", F.explode(F.sequence(F.shiftright("low", 16), F.shiftright("high", 16))).alias("__net")
    )
    inside = (
        (F.shiftright(F.col(addr), 16) == F.col("__net")) & (F.col(addr) >= F.col("low")) & (F.col(addr) <= F.col("high"))
    )
    return access_log.join(cut, inside, "left_anti")
