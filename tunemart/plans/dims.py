"""The user, song, artist and time dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemart.functions.calendar import calendar_parts
from tunemart.operators.dedup import keep_first, rank_within

SONG_COLUMNS = ["song_id", "title", "artist_id", "year", "duration"]
ARTIST_COLUMNS = [
    "artist_id",
    "artist_name",
    "artist_location",
    "artist_latitude",
    "artist_longitude",
]


def user_rows(events: DataFrame) -> DataFrame:
    """The user columns of every event, whatever its page."""
    return events.select(
        F.col("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        "ts",
        "itemInSession",
    )


def dim_user(events: DataFrame) -> DataFrame:
    """One row per known user: the latest state."""
    latest = [
        F.col("ts").desc_nulls_last(),
        F.col("itemInSession").desc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in ("level", "first_name", "last_name", "gender")],
    ]
    known = user_rows(events).filter(F.col("user_id").isNotNull())
    return keep_first(known, "user_id", latest).drop("ts", "itemInSession")


def dim_song(songs: DataFrame) -> DataFrame:
    """One row per song id."""
    order = [F.col(c).asc_nulls_last() for c in SONG_COLUMNS[1:]]
    return keep_first(songs.select(*SONG_COLUMNS), "song_id", order)


def ranked_songs(songs: DataFrame) -> DataFrame:
    """Every song record with its rank among the records of its id."""
    return rank_within(
        songs.select(*SONG_COLUMNS),
        "song_id",
        ["title", "artist_id", "year", "duration"],
        "song_id_ranked",
    )


def dim_artist(songs: DataFrame) -> DataFrame:
    """One row per song record: an artist is repeated for each of their songs."""
    return songs.select(*ARTIST_COLUMNS)


def dim_artist_dedup(songs: DataFrame) -> DataFrame:
    """One row per artist id."""
    order = [F.col(c).asc_nulls_last() for c in ARTIST_COLUMNS[1:]]
    return keep_first(dim_artist(songs), "artist_id", order)


def _with_parts(times: DataFrame) -> DataFrame:
    return times.select("start_time", *calendar_parts(F.col("start_time")))


def event_times(events: DataFrame) -> DataFrame:
    return events.filter(F.col("ts").isNotNull()).select(F.col("ts").alias("start_time"))


def dim_time(events: DataFrame) -> DataFrame:
    """One row per event with a timestamp: a time is repeated for each of its events."""
    return _with_parts(event_times(events))


def dim_time_dedup(events: DataFrame) -> DataFrame:
    """One row per timestamp; the parts are computed after the duplicates are gone."""
    return _with_parts(event_times(events).distinct())
