"""One row per key, and the rank of every row within its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunemart.scratch import materialize_dealt


def keep_first(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of every key under a total order.

    Spark keeps only the best row per key and map task before the shuffle, so a key that
    holds a large share of the rows does not travel with all of them.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def rank_within(df: DataFrame, key: str, order: list[str], rank: str) -> DataFrame:
    """All rows with their position within the key, ordered by `order`, NULLs last.

    Every row survives, so that a window over the key would bring a whole key into one task. Here
    rows are sorted by key, order and a number of their own over all partitions, in which a key
    may spread, and are written with their partition and position, dealt out by partition. Rows
    are then counted within key and partition, which moves none of them. Only a key that began in
    an earlier partition needs more: what came of it before, one number per partition.
    """
    spark = df.sparkSession
    sorting = [F.col(c).asc_nulls_last() for c in (key, *order, "_copy")]
    placed = (
        df.withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange(*sorting)
        .sortWithinPartitions(*sorting)
        .select(*df.columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row"))
    )
    written = materialize_dealt(placed, "_part", int(spark.conf.get("spark.sql.shuffle.partitions")))
    runs = written.groupBy("_part", key).agg(F.count("*").alias("n"))
    place = (F.col(key).isNull(), F.col(key))
    ends = runs.groupBy("_part").agg(
        F.min(F.struct(*place)).alias("first"), F.max(F.struct(*place)).alias("last"), F.max(F.struct(*place, "n")).alias("end")
    )
    carry, before, last = [], 0, None
    for part in sorted(ends.collect(), key=lambda r: r["_part"]):  # one row per partition
        carried = before if part["first"] == last else 0
        carry.append((part["_part"], part["first"][1], carried))
        before = part["end"]["n"] + (carried if part["first"] == part["last"] else 0)
        last = part["last"]
    carries = spark.createDataFrame(carry, f"_part int, _first {df.schema[key].dataType.simpleString()}, _carry long")
    within = F.row_number().over(Window.partitionBy("_part", key).orderBy("_row"))
    began = F.when(F.col(key).eqNullSafe(F.col("_first")), F.col("_carry")).otherwise(F.lit(0))
    ranked = written.withColumn("_within", within).join(F.broadcast(carries), "_part")
    return ranked.select(*df.columns, (F.col("_within") + began).alias(rank))
