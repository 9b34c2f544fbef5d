"""File streams: a table split into time slices that arrive one after the other."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidescore.functions.text import epoch_micros
from tidescore.session import scratch_path

ROWS_PER_SLICE = 1_000_000
ROW_GROUP_BYTES = 4 * 1024 * 1024  # a slice is one file: its row groups are what its readers share


def _by_time(df: DataFrame, ts: str, slices: int) -> DataFrame:
    """Number of each row's slice of about equal rows, in time order; rows of one time share a slice, rows without one come first.

    The bounds are read from the time alone, so the other columns, whose making may be the costly part, are made once.
    """
    micros = epoch_micros(F.col(ts)).cast("double")
    shares = [i / slices for i in range(1, slices)]
    found = df.select(F.percentile_approx(micros, shares, max(10_000, 100 * slices)).alias("b")).first().b if shares else []
    if not found:
        return df.withColumn("slice", F.lit(0))
    bounds = [-float("inf"), *sorted(set(found)), float("inf")]
    timed = df.withColumn("_micros", F.coalesce(micros, F.lit(-1e300)))
    cut = Bucketizer(splits=bounds, inputCol="_micros", outputCol="_slice").transform(timed)
    return cut.withColumn("slice", F.col("_slice").cast("int")).drop("_micros", "_slice")


def play(df: DataFrame, target: str, after_each: Callable[[], None] | None = None, ts: str = "ts",
         at_least: int = 3, rows_per_slice: int = ROWS_PER_SLICE, arrival: Column | None = None) -> int:
    """Deliver `df` to the folder `target` in time order, one file per slice.

    The table is cut by time and written once. Each slice then moves into the
    target folder as a whole, so a reader never sees half of one, and gets a file time one second
    after the slice before, so a reader that takes one file per trigger takes them in order.
    Slices hold about `rows_per_slice` rows, which bounds its micro-batches. `after_each` runs
    after every delivery. `arrival` names each row's slice itself, counted from 0, for rows that come
    out of time order. Returns the number of slices.
    """
    spark = df.sparkSession
    waiting = scratch_path(spark, "slices")
    if arrival is None:
        slices = max(at_least, -(-df.count() // rows_per_slice))
        split = _by_time(df, ts, slices)
    else:
        split = df.withColumn("slice", arrival.cast("int"))
        slices = (split.agg(F.max("slice").alias("n")).first().n or 0) + 1
    split = split.repartitionById(slices, "slice")
    split.write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("slice").parquet(waiting)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = Path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(Path(target))
    first = int(time.time() - slices) * 1000
    for number in range(slices):
        name = f"slice={number}"
        if not fs.exists(Path(f"{waiting}/{name}")):
            continue
        if not fs.rename(Path(f"{waiting}/{name}"), Path(f"{target}/{name}")):
            raise OSError(f"could not deliver {name} to {target}")
        for file in fs.listStatus(Path(f"{target}/{name}")):
            fs.setTimes(file.getPath(), first + number * 1000, -1)
        if after_each:
            after_each()
    return slices


def read_staged(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1) -> DataFrame:
    """Stream over a folder of slices, by default one slice per micro-batch."""
    reader = spark.readStream.schema(T.StructType([*schema.fields, T.StructField("slice", T.IntegerType())]))
    return reader.option("maxFilesPerTrigger", files_per_trigger).parquet(path).drop("slice")
