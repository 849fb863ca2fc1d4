"""How tables lie on storage: partitions, file sizes, clustering, file statistics, buckets."""

from __future__ import annotations

from itertools import product
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.times import micros
from terrace.plans.chunks import HOT_KEYS, HOT_ROWS
from terrace.plans.joins import null_safe_join
from terrace.sources.foreign import source_digest
from terrace.sources.tables import folder_bytes

#: Column that tells apart the rows of a hot key in tables of :func:`bucket_pair`.
SALT = "__salt"
#: Rows of a file or bucket, on average, beyond which there are more of them.
FILE_ROWS = 1 << 20


def parts_for(rows: int, least: int) -> int:
    """Files or buckets for so many rows: ``least``, or more where these would hold above ``FILE_ROWS`` each."""
    return max(least, ceil(rows / FILE_ROWS))


def write_partitioned(
    df: DataFrame, path: str, by: list[str], sort: list[str] | None = None, max_records: int = 0, mode: str = "overwrite"
) -> None:
    """Write one folder per ``by`` value; a rerun replaces exactly the partitions it contains.

    Rows are rebalanced on ``by``: AQE splits a partition value that holds much of the data over
    several tasks and packs small ones together.
    """
    out = df.hint("rebalance", *[F.col(c) for c in by])
    out = out.sortWithinPartitions(*by, *(sort or []))
    writer = out.write.partitionBy(*by).mode(mode).option("partitionOverwriteMode", "dynamic")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def compact_partitions(
    spark: SparkSession, path: str, out_path: str, target_bytes: int = 256 << 20,
    by: list[str] | None = None, sort: list[str] | None = None,
) -> int:
    """Rewrite a table into files of about ``target_bytes`` at ``out_path``; returns the file count.

    Files are merged as they lie, without a shuffle, so a clustering survives. A table partitioned
    ``by`` columns keeps its folders: rows are rebalanced on them, and ``sort`` restores an order
    inside. Raises when the copy is not the same bag of rows (count and checksum).
    """
    source = spark.read.parquet(path)
    if by:
        write_partitioned(source, out_path, by, sort)
    else:
        files = max(1, ceil(folder_bytes(spark, path) / target_bytes))
        source.coalesce(files).write.mode("overwrite").parquet(out_path)
    copy = spark.read.parquet(out_path)
    if source_digest(source).first() != source_digest(copy).first():
        raise RuntimeError(f"compaction of {path} changed its rows; keep the old files")
    return len(copy.inputFiles())


def _rank(value: Column, cuts: list[float], bits: int) -> Column:
    """The number of cuts at or below the value (NULL: 0), by halving.

    There are ``2**bits - 1`` ascending cuts. The value is taken once, and the halvings are one small
    expression: a projection for each would make a method that the JVM leaves uncompiled.
    """
    marks = F.array(*[F.lit(float(c)) for c in cuts])
    steps = F.array(*[F.lit(2**bit) for bit in reversed(range(bits))])

    def halved(v: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(v >= F.get(marks, at + step - 1), step).otherwise(0))

    return F.get(F.transform(F.array(value), halved), 0)


def order_key(value: Column, kind: T.DataType) -> Column:
    """A number that grows with the value: days of dates, microseconds of times, the first six bytes of texts.

    Two values may share a number, never swap: a bound on the number is a bound on the value.
    """
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return micros(value).cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.substring(value.cast("binary"), 1, 6)
        return F.conv(F.rpad(F.hex(head), 12, "0"), 16, 10).cast("double")
    return value.cast("double")


def _hilbert_turns(width: int) -> list[int]:
    """What ``width`` bits of two ranks give in each of four states: their digits on the curve, times four, and the next state.

    A state is whether the square is turned (its axes swapped) and whether it is mirrored. The entry of
    a state and two numbers ``a`` and ``b`` below ``2**width`` is at ``(state << 2 * width) + (a << width) + b``.
    """
    turns = []
    for state, a, b in product(range(4), range(2**width), range(2**width)):
        digits, (turned, mirrored) = 0, divmod(state, 2)
        for bit in reversed(range(width)):
            pair = (a >> bit & 1) ^ mirrored, (b >> bit & 1) ^ mirrored
            right, up = pair[::-1] if turned else pair
            digits = digits * 4 + (right * 3 ^ up)
            # the lower half is turned, and mirrored on the right
            if not up:
                turned, mirrored = 1 - turned, mirrored ^ right
        turns.append(digits * 4 + turned * 2 + mirrored)
    return turns


def _hilbert(df: DataFrame, names: list[str], bits: int, out: str) -> DataFrame:
    """Add the place on a Hilbert curve of two ranks below ``2**bits``, from the highest bits on, up to four at a time."""
    turn = f"{out}_turn"
    df = df.withColumns({turn: F.lit(0), out: F.lit(0).cast("bigint")})
    left = bits
    while left:
        width = (left - 1) % 4 + 1
        left -= width
        a, b = (F.shiftright(F.col(c).cast("bigint"), left).bitwiseAND(F.lit(2**width - 1)) for c in names)
        at = F.shiftleft(F.col(turn).bitwiseAND(F.lit(3)), 2 * width) + F.shiftleft(a, width) + b
        df = df.withColumn(turn, F.get(F.expr(f"array({', '.join(map(str, _hilbert_turns(width)))})"), at.cast("int")))
        df = df.withColumn(out, F.shiftleft(F.col(out), 2 * width) + F.shiftright(F.col(turn), 2))
    return df


def _interleave(ranks: list[Column], bits: int) -> Column:
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            moved = F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(ranks) + i)
            key = key.bitwiseOR(moved)
    return key


def cluster_layout(df: DataFrame, cols: list[str], method: str = "range", files: int | None = None, bits: int = 8) -> DataFrame:
    """Order rows so that files cover narrow value ranges.

    ``range`` sorts by the columns in turn; ``zorder`` interleaves the bits of each column's
    quantile rank, so that a filter on any of them skips files. ``hilbert`` walks the ranks of two
    columns so that neighbours on the way are neighbours in both, which leaves fewer files for a range
    on both. Numbers, dates, times and texts may be clustered. There are ``files`` files, or more where
    these would hold above ``FILE_ROWS`` rows each; by default Spark chooses. Quantile cuts (at most
    ``2**bits`` numbers per column) and a count are the only values that reach the driver.
    """
    if method == "range":
        by: list[Column] = [F.col(c) for c in cols]
    elif method in ("zorder", "hilbert"):
        if bits * len(cols) > 62:
            raise ValueError("bits * columns must stay below 63")
        if method == "hilbert" and len(cols) != 2:
            raise ValueError("a Hilbert order is of two columns")
        steps = [i / 2**bits for i in range(1, 2**bits)]
        numbers = [order_key(F.col(c), df.schema[c].dataType) for c in cols]
        found = df.agg(*[F.percentile_approx(n, steps, 4 * 2**bits).alias(f"q{i}") for i, n in enumerate(numbers)]).first()
        df = df.withColumns({f"__z{i}": _rank(n, cuts or [0.0] * len(steps), bits) for i, (n, cuts) in enumerate(zip(numbers, found))})
        if method == "zorder":
            df = df.withColumn("__z", _interleave([F.col(f"__z{i}") for i in range(len(cols))], bits))
        else:
            df = _hilbert(df, ["__z0", "__z1"], bits, "__z")
        by = [F.col("__z")]
    else:
        raise ValueError(f"unknown method {method!r}")
    ranged = df.repartitionByRange(parts_for(df.count(), files), *by) if files else df.repartitionByRange(*by)
    extra = [c for c in df.columns if c.startswith("__z")]
    return ranged.sortWithinPartitions(*by).drop(*extra)


def file_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """(file, column, n_rows, n_null, low, high) of a file-backed table; file is its path.

    low and high are doubles: of dates, times and texts the numbers that :func:`order_key` gives them.
    """
    numbers = [order_key(F.col(c), df.schema[c].dataType) for c in cols]
    wide = df.select(F.col("_metadata.file_path").alias("file"), *[n.alias(c) for n, c in zip(numbers, cols)])
    wide = wide.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(F.when(F.col(c).isNull(), 1)).alias("n_null"),
                F.min(c).alias("low"),
                F.max(c).alias("high"),
            ).alias(f"__s{i}")
            for i, c in enumerate(cols)
        ],
    )
    long = wide.select("file", "n_rows", F.explode(F.array(*[f"__s{i}" for i in range(len(cols))])).alias("s"))
    return long.select("file", "s.column", "n_rows", "s.n_null", "s.low", "s.high")


def prunable_files(stats: DataFrame, column: str, lower, upper, kind: T.DataType | None = None) -> DataFrame:
    """Files that cannot hold a row with ``lower <= column <= upper``.

    The bounds are of the column's own ``kind`` (default: numbers); what is known of texts are their
    first bytes, so a file is left out only if these alone rule it out.
    """
    low, high = (order_key(F.lit(v) if kind is None else F.lit(v).cast(kind), kind or T.DoubleType()) for v in (lower, upper))
    s = stats.filter(F.col("column") == column)
    empty = F.col("low").isNull()
    return s.filter(empty | (F.col("high") < low) | (F.col("low") > high)).select("file")


def _bloom_bits(value: Column, bits: int, probes: int) -> Column:
    """The places of a value in a bit set; they depend on the value's text only."""
    text = value.cast("string")
    return F.array(*[F.pmod(F.xxhash64(text, F.lit(k)), F.lit(bits)) for k in range(probes)])


def file_filters(df: DataFrame, column: str, bits: int = 1 << 16, probes: int = 4) -> DataFrame:
    """(file, word, bits): a Bloom bit set of ``column`` for each file, ``bits / 64`` rows a file at most.

    Bits are set by hash and joined by OR in the tasks before anything is moved. ``bits`` should be
    about ten times the distinct values of a file; NULL is not entered.
    """
    places = df.filter(F.col(column).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), F.explode(_bloom_bits(F.col(column), bits, probes)).alias("place")
    )
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    return places.groupBy("file", F.shiftright("place", 6).alias("word")).agg(F.bit_or(one).alias("bits"))


def files_without(filters: DataFrame, files: DataFrame, value: Column, bits: int = 1 << 16, probes: int = 4) -> DataFrame:
    """The ``files`` (file) that hold no row equal to ``value``; a file that holds one is never among them.

    ``value`` has the column's type, ``bits`` and ``probes`` are those of the filters.
    """
    asked = files.select("file").distinct().select("file", F.explode(F.array_distinct(_bloom_bits(value, bits, probes))).alias("place"))
    asked = asked.withColumn("word", F.shiftright("place", 6))
    met = asked.join(filters, ["file", "word"], "left")
    is_set = F.coalesce(F.expr("(shiftright(bits, cast(place & 63 as int)) & 1) = 1"), F.lit(False))
    return met.groupBy("file").agg(F.bool_and(is_set).alias("maybe")).filter(~F.col("maybe")).select("file")


def bucket_table(df: DataFrame, name: str, keys: list[str], n: int, path: str | None = None) -> None:
    """Save a table hashed and sorted on ``keys`` so that later joins on them need no shuffle.

    Tables joined so have the same ``n``; :func:`parts_for` gives one that grows with the larger table.
    """
    writer = df.repartition(n, *keys).write.mode("overwrite").format("parquet").bucketBy(n, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def bucket_pair(
    large: DataFrame, other: DataFrame, names: tuple[str, str], keys: list[str], n: int,
    paths: tuple[str, str] | None = None, hot_rows: int = HOT_ROWS,
) -> None:
    """Save two tables that join on ``keys`` and ``__salt`` without a shuffle, and without a bucket of one hot key.

    Rows of ``large`` whose key has more than ``hot_rows`` rows there, and more than a ``HOT_KEYS``-th of all, are dealt
    to one salt for each ``hot_rows`` of them (``n`` at most); each row of ``other`` with that key is copied to all of them. Other
    keys have the salt 0. So inner joins, and outer ones that keep ``large``, give what they give on the keys alone; a
    reader of ``other`` by itself takes ``__salt = 0``. Both tables have the columns ``keys``; NULL is a key when dealt.
    There are ``n`` buckets, or more where these would hold above ``FILE_ROWS`` rows of ``large`` each.
    """
    n = parts_for(large.count(), n)
    counted = large.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    share = counted.agg(F.sum("__n") / HOT_KEYS).scalar()
    hot = counted.filter((F.col("__n") > hot_rows) & (F.col("__n") > share))
    # at most HOT_KEYS keys; a shuffled join would gather each of them
    hot = F.broadcast(hot.select(*keys, F.least(F.ceil(F.col("__n") / hot_rows), F.lit(n)).cast("int").alias("__salts")))
    salts = F.coalesce("__salts", F.lit(1))
    # any spread will do, since the other side is there for every salt
    placed = null_safe_join(large.withColumn("__at", F.monotonically_increasing_id()), hot, keys, "left")
    dealt = placed.withColumn(SALT, F.pmod("__at", salts).cast("int")).select(*large.columns, SALT)
    copied = null_safe_join(other, hot, keys, "left").withColumn(SALT, F.explode(F.sequence(F.lit(0), salts - 1))).select(*other.columns, SALT)
    for i, df in enumerate((dealt, copied)):
        bucket_table(df, names[i], [*keys, SALT], n, paths[i] if paths else None)
