"""How a side of a join travels."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Rows of a side that may be broadcast: a few tens of MB in the driver and in each executor.
MOST_BROADCAST = 100_000


def join_hint(side: DataFrame) -> str | None:
    """"merge" for a side of many rows, None for a small one, which is left to Spark's estimate.

    Spark estimates a side by the bytes of its files, of which compressed ones hold thirty times as
    much in memory, and adaptive execution does not take a broadcast back once it is planned. Rows are
    counted from the footers where the side is made of files that have them.
    """
    return "merge" if side.count() > MOST_BROADCAST else None


def hinted(side: DataFrame, hint: str | None) -> DataFrame:
    return side.hint(hint) if hint else side
