"""Profiles that are kept up from sketches: a further snapshot reads only new files.

For the files that a call finds new, one scan gives per column the rows, the nulls and
two mergeable sketches, of distinct values and of quantiles. They are kept as one part,
with the list of its files. A snapshot unites the parts whose files are all still there,
unchanged; the rest of a part that has lost a file, or had one replaced, counts as
new again, as nothing can be taken out of a sketch.

Distinct counts come from HyperLogLog sketches with 2**12 registers: a relative error of
1.6 % in two of three cases, below 5 % in nearly all. Quantiles come from KLL sketches
with k = 200: ranks are within 1.65 % of what is asked for, in 99 of 100 cases. Sketches
have a few kilobytes, whatever the size of a table; a part has one row per column.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Binary logarithm of the registers of a sketch of distinct values; k of one of quantiles.
LG_REGISTERS, KLL_K = 12, 200

QUANTILES = (0.25, 0.5, 0.75)

FILES = "part STRING, path STRING, length LONG, modified TIMESTAMP"
SKETCHES = (
    "part STRING, column_name STRING, n_rows LONG, n_nulls LONG, distinct_values BINARY, "
    "quantiles BINARY"
)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """Files of a table as they are now; they are listed, not opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def _kept(spark: SparkSession, store: str, kind: str, schema: str) -> DataFrame:
    folder = f"{store}/{kind}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder)


def _valid_parts(spark: SparkSession, path: str, store: str) -> tuple[DataFrame, DataFrame]:
    """The parts whose files are all unchanged; and the files in no such part."""
    listed = _listed(spark, path)
    known = _kept(spark, store, "files", FILES)
    is_there = listed.withColumn("there", F.lit(True))
    seen = known.join(is_there, ["path", "length", "modified"], "left")
    valid = seen.groupBy("part").agg(F.bool_and(F.coalesce("there", F.lit(False))).alias("whole"))
    valid = valid.where("whole").select("part")
    covered = known.join(valid, "part", "left_semi")
    return valid, listed.join(covered, ["path", "length", "modified"], "left_anti")


def _sketched(df: DataFrame, part: str) -> DataFrame:
    """One row per column of ``df``, from one pass over it."""
    measures: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    entries = []
    for n, field in enumerate(df.schema):
        column = df[f"`{field.name}`"]
        # One hash for values of all types; a map is taken as its text.
        value = F.to_json(column) if isinstance(field.dataType, T.MapType) else column
        hashed = F.when(column.isNotNull(), F.xxhash64(value))
        measures += [
            F.count(column).alias(f"filled_{n}"),
            F.hll_sketch_agg(hashed, F.lit(LG_REGISTERS)).alias(f"distinct_{n}"),
        ]
        quantiles = F.lit(None).cast("binary")
        if isinstance(field.dataType, T.NumericType):
            measures.append(F.kll_sketch_agg_double(column.cast("double"), F.lit(KLL_K)).alias(f"kll_{n}"))
            quantiles = F.col(f"kll_{n}")
        entries.append(
            F.struct(
                F.lit(part).alias("part"),
                F.lit(field.name).alias("column_name"),
                F.col("n_rows"),
                (F.col("n_rows") - F.col(f"filled_{n}")).alias("n_nulls"),
                F.col(f"distinct_{n}").alias("distinct_values"),
                quantiles.alias("quantiles"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*entries)))


def update_sketches(spark: SparkSession, path: str, store: str) -> int:
    """Profiles the files of the Parquet table at ``path`` that ``store`` does not cover
    yet; says how many there were. A call that fails leaves nothing that counts."""
    _, new = _valid_parts(spark, path, store)
    new = new.collect()  # the names of the files to read, as the scan needs them
    if not new:
        return 0
    part = uuid.uuid4().hex
    schema = spark.read.parquet(path).schema
    rows = spark.read.schema(schema).parquet(*[r["path"] for r in new])
    _sketched(rows, part).write.parquet(f"{store}/sketches/{part}")
    # Only what is listed here counts, and it is written last.
    listed = spark.createDataFrame([(part, *r) for r in new], FILES)
    listed.coalesce(1).write.parquet(f"{store}/files/{part}")
    return len(new)


def sketched_profile(
    spark: SparkSession,
    path: str,
    store: str,
    table: str,
    snapshot_at: str,
    quantiles: Sequence[float] = QUANTILES,
) -> DataFrame:
    """The snapshot of a table from the sketches of its files, new ones taken first.

    ``snapshot_at, table_name, column_name, n_rows, n_nulls, n_distinct`` as
    ``profiling.column_profile`` gives them, and ``quantiles`` of numbers, null for others.
    """
    update_sketches(spark, path, store)
    valid, _ = _valid_parts(spark, path, store)
    sketches = _kept(spark, store, "sketches", SKETCHES).join(valid, "part", "left_semi")
    united = sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_values")).alias("n_distinct"),
        F.kll_merge_agg_double("quantiles").alias("kll"),
    )
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    filled = F.kll_sketch_get_n_double("kll") > 0
    return united.select(
        F.lit(snapshot_at).cast("timestamp_ntz").alias("snapshot_at"),
        F.lit(table).alias("table_name"),
        "column_name",
        "n_rows",
        "n_nulls",
        "n_distinct",
        F.when(filled, F.kll_sketch_get_quantile_double("kll", ranks)).alias("quantiles"),
    )
