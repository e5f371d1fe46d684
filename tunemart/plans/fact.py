"""The song-play fact: plays matched to songs by title and artist name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemart.operators.joins import hinted, join_hint
from tunemart.operators.keys import number_rows

PLAY_PAGE = "NextSong"
CATALOG = ["title", "artist_name", "song_id", "artist_id"]

# Reproducible order of the plays; together the columns are unique.
PLAY_ORDER = [
    "start_time",
    "user_id",
    "session_id",
    "song_id",
    "artist_id",
    "level",
    "location",
    "user_agent",
]


def matched_plays(events: DataFrame, songs: DataFrame, how: str = "inner") -> DataFrame:
    """Every play with every song of that title and artist name.

    Neither duration nor id is compared, so songs that share both names multiply a play;
    a play without song or artist matches nothing. Spark broadcasts the songs while they
    are small and few, else both sides are shuffled on the two names and adaptive execution
    splits the partition of a very popular song.
    """
    return _matched(events, songs.select(*CATALOG), how, join_hint(songs))


def _matched(events: DataFrame, catalog: DataFrame, how: str, hint: str | None) -> DataFrame:
    plays = events.filter(F.col("page") == PLAY_PAGE).select(
        F.col("ts").alias("start_time"),
        F.col("userId").alias("user_id"),
        "level",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        "song",
        "artist",
    )
    same_song = (F.col("song") == F.col("title")) & (F.col("artist") == F.col("artist_name"))
    return plays.join(hinted(catalog, hint), same_song, how).select(
        "start_time",
        "user_id",
        "level",
        "song_id",
        "artist_id",
        "session_id",
        "location",
        "user_agent",
    )


def song_plays(events: DataFrame, songs: DataFrame) -> DataFrame:
    """The distinct plays, without key.

    Copies of a song record are dropped before the join: they add nothing to a distinct
    result, and n copies would otherwise multiply every play of that song by n.
    """
    return _matched(events, songs.select(*CATALOG).distinct(), "inner", join_hint(songs)).distinct()


def keyed_song_plays(plays: DataFrame, start: int = 0, ordered: bool = True) -> DataFrame:
    """Add the dense key `songplay_id`, counting from `start`."""
    return number_rows(plays, "songplay_id", PLAY_ORDER if ordered else None, start)
