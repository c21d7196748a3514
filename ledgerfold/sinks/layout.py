"""Tables laid out by their keys: in buckets, so that joins need no shuffle, or clustered
by several keys at once, so that a filter on any of them reads few files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.session import TASK_BYTES, fresh_path


def buckets_for(n_bytes: int, bucket_bytes: int = TASK_BYTES) -> int:
    """As many buckets as keep one small enough for a task: a power of two, so that
    tables of different size still meet bucket by bucket."""
    return 1 << max(0, -(-n_bytes // bucket_bytes) - 1).bit_length()


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Store a table bucketed by the key of its joins, as the catalog table ``name``.

    Tables joined with each other take the same number of buckets, see
    ``buckets_for``. A key's rows are one bucket's and so one task's to read: this
    layout is for keys with far fewer rows than a bucket. Rows without a key, which
    no inner join reads, are written where they lie and not brought to one task.
    """
    keyed = df.where(F.col(key).isNotNull()).repartition(buckets, key)
    rows = keyed.unionByName(df.where(F.col(key).isNull()))
    writer = rows.write.bucketBy(buckets, key).sortBy(key).mode("overwrite")
    writer.option("path", fresh_path(df.sparkSession, name)).saveAsTable(name)
    return df.sparkSession.table(name)


def files_for(n_bytes: int, file_bytes: int = TASK_BYTES) -> int:
    """As many files as keep one near the size a task reads."""
    return max(1, -(-n_bytes // file_bytes))


def write_clustered(
    df: DataFrame, path: str, keys: list[str], files: int, bits: int = 8
) -> DataFrame:
    """Store a table so that a range of any one of ``keys`` lies in few of its files.

    Each key is replaced by its number among 2**bits ranges that hold about as many rows
    each, whatever its distribution, found in one pass by quantile sketches. The numbers'
    bits are interleaved, and rows are dealt to ``files`` files by ranges of the result
    and sorted by it. Of n files, a value of one of two keys lies in about once to twice
    the square root of n. Rows with the same keys may go to several files, so no key is too large
    for a task. Beside the rows, the lowest and highest key of each file are kept, by
    which ``read_clustered`` chooses files without opening the others.

    Keys are numbers or dates. Rows without a key are kept and found by filters on the others.
    """
    fractions = [n / (1 << bits) for n in range(1, 1 << bits)]
    # Dates have quantiles by their number of microseconds.
    measured = {k: _as_number(df, k) for k in keys}
    sketches = [F.percentile_approx(c, fractions).alias(f"q{n}") for n, c in enumerate(measured.values())]
    found = df.agg(*sketches).first()
    numbers = [_range_number(c, found[n] or [], bits) for n, c in enumerate(measured.values())]
    zone = F.lit(0).cast("long")
    for bit in range(bits):
        for n, number in enumerate(numbers):
            place = bit * len(numbers) + n
            zone = zone + F.shiftleft(F.shiftright(number, bit).bitwiseAND(1).cast("long"), place)
    rows = df.select(F.struct(*df.columns).alias("row"), zone.alias("zone"), *keys)
    # The last column parts rows that are the same in all keys.
    order = ["zone", *keys, F.monotonically_increasing_id()]
    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions("zone", *keys)
    dealt.select("row.*").write.parquet(f"{path}/rows")

    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    spans = [
        F.struct(F.min(k).alias("low"), F.max(k).alias("high")).alias(k) for k in keys
    ]
    # One small row per file.
    zones = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), *[s.alias(f"key_{k}") for k, s in zip(keys, spans)]
    )
    zones.write.parquet(f"{path}/zones")
    return stored


def _as_number(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType.typeName()
    column = F.col(key)
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if kind in ("string", "binary", "boolean", "array", "map", "struct"):
        raise ValueError(f"a table is clustered by numbers and dates; {key} is {kind}")
    return column.cast("double")


def _range_number(value: Column, bounds: list[float], bits: int) -> Column:
    """How many of the sorted bounds are not above the value, by bisection; 0 for a null."""
    if not bounds:
        return F.lit(0)
    sorted_bounds = F.array(*[F.lit(b) for b in sorted(bounds)])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])

    def closer(found: Column, step: Column) -> Column:
        reached = F.element_at(sorted_bounds, found + step) <= value
        return F.when(reached, found + step).otherwise(found)

    return F.aggregate(steps, F.lit(0), closer)


def files_in_range(
    spark: SparkSession, path: str, between: dict[str, tuple]
) -> list[str]:
    """The files of a clustered table that may hold rows whose keys are in all the ranges."""
    zones = spark.read.parquet(f"{path}/zones")
    for key, (low, high) in between.items():
        span = F.col(f"key_{key}")
        # A file without any value of a key has no rows in a range of it.
        meets = span["low"].isNotNull()
        if low is not None:
            meets = meets & (span["high"] >= F.lit(low))
        if high is not None:
            meets = meets & (span["low"] <= F.lit(high))
        zones = zones.where(meets)
    return sorted(f"{path}/rows/{r['file']}" for r in zones.select("file").collect())


def read_clustered(spark: SparkSession, path: str, between: dict[str, tuple]) -> DataFrame:
    """The rows of a clustered table whose keys lie in the ranges ``{key: (low, high)}``.

    Both ends belong to a range; None leaves it open. Files out of a range are not opened,
    and within the others the filter is pushed to the row groups.
    """
    schema = spark.read.parquet(f"{path}/rows").schema
    files = files_in_range(spark, path, between)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for key, (low, high) in between.items():
        rows = rows.where(F.col(key).isNotNull())
        if low is not None:
            rows = rows.where(F.col(key) >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col(key) <= F.lit(high))
    return rows
