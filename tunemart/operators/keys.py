"""Dense row numbers without bringing all rows to one place."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemart import scratch
from tunemart.schemas import KEY_TYPE

# monotonically_increasing_id() keeps the partition above these bits, the row below.
ROW_BITS = 33


def number_rows(
    df: DataFrame,
    name: str,
    order: list[str] | None = None,
    start: int | Callable[[int], int] = 0,
    where: str | None = None,
) -> DataFrame:
    """Add start, start+1, ... as column `name`.

    With `order`, columns that no two rows agree on, the numbers follow them (ascending,
    NULLs last) through a range sort. Without it rows are numbered where they are, which
    saves the sort. `start` may be a function that is told how many numbers are needed.
    Rows for which `where`, a boolean column, is false get no number.

    The rows are written once with their partition and position: range bounds are sampled
    and a recomputation could cut the partitions elsewhere. Only one count per partition
    passes through the driver.
    """
    spark = df.sparkSession
    placed, first = df, [F.col(where).desc()] if where else []
    if order is not None:
        ordering = [F.col(c).asc_nulls_last() for c in order]
        placed = df.repartitionByRange(*ordering).sortWithinPartitions(*first, *ordering)
    elif first:
        placed = df.sortWithinPartitions(*first)
    row_id = F.monotonically_increasing_id()
    placed = placed.withColumn("_row", row_id).select(
        *df.columns,
        F.shiftright("_row", ROW_BITS).cast("int").alias("_part"),
        F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row"),
    )
    written = scratch.materialize(placed, "numbered")

    numbered = written.filter(where) if where else written
    counts = sorted(numbered.groupBy("_part").count().collect())
    total = sum(n for _, n in counts)
    before = list(accumulate((n for _, n in counts), initial=start(total) if callable(start) else start))
    offsets = spark.createDataFrame(
        pa.table(
            {
                "_part": pa.array([part for part, _ in counts], pa.int32()),
                "_offset": pa.array(before[:-1], pa.int64()),
            }
        )
    )
    number = (F.col("_offset") + F.col("_row")).cast(KEY_TYPE)
    if where:
        number = F.when(F.col(where), number)
    return written.join(F.broadcast(offsets), "_part", "left" if where else "inner").select(
        number.alias(name), *df.columns
    )
