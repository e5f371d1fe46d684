"""Ad-hoc looks at the loaded tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def songs_of_year(songs: DataFrame, year: int) -> DataFrame:
    """All columns of the songs of one year."""
    return songs.filter(F.col("year") == year)


def duplicate_audit(songs: DataFrame) -> DataFrame:
    """Records per song id, fewest first; after a clean load every count is 1."""
    return songs.groupBy("song_id").count().orderBy(F.col("count"), F.col("song_id"))
