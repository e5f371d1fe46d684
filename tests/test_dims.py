"""Dimensions: which row is kept, ranks, calendar parts."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime
from decimal import Decimal

import pytest

from tunemart.operators.dedup import rank_within
from tunemart.plans import dims, reports

USER = {"userId": 1, "firstName": "Ann", "lastName": "Lee", "gender": "F", "level": "free"}


def at(day, **more):
    return {**USER, "ts": datetime(2018, 11, day), **more}


def test_latest_user_state_wins(events):
    df = events(at(1), at(3, level="paid", page="Home"), at(2), {**USER, "level": "none"})
    assert [tuple(r) for r in dims.dim_user(df).collect()] == [(1, "Ann", "Lee", "F", "paid")]


def test_equal_times_fall_back_to_item(events):
    df = events(at(1, itemInSession=2, level="paid"), at(1, itemInSession=1), at(1))
    assert dims.dim_user(df).first().level == "paid"


def test_unknown_users_are_left_out(events):
    df = events(at(1), at(2, userId=None), at(3, userId=None))
    assert dims.dim_user(df).count() == 1


def test_one_song_per_id_is_a_staged_one(songs):
    rows = [
        {"song_id": "S1", "title": "B", "artist_id": "A1", "year": 1, "duration": Decimal(1)},
        {"song_id": "S1", "title": "A", "artist_id": "A2", "year": 2, "duration": Decimal(2)},
        {"song_id": "S2", "title": None, "artist_id": "A1", "year": 0, "duration": Decimal(3)},
    ]
    kept = {tuple(r) for r in dims.dim_song(songs(*rows)).collect()}
    assert kept == {("S1", "A", "A2", 2, Decimal(2)), ("S2", None, "A1", 0, Decimal(3))}


def test_artists_with_and_without_duplicates(songs):
    df = songs(
        {"song_id": "S1", "artist_id": "A1", "artist_name": "x"},
        {"song_id": "S2", "artist_id": "A1", "artist_name": "x", "artist_location": "here"},
        {"song_id": "S3", "artist_id": "A2", "artist_name": "y"},
    )
    assert dims.dim_artist(df).count() == 3
    kept = {(r.artist_id, r.artist_location) for r in dims.dim_artist_dedup(df).collect()}
    assert kept == {("A1", "here"), ("A2", None)}


# Timestamp, then hour, day, week, month, year, weekday.
@pytest.mark.parametrize(
    "row",
    [
        (datetime(2018, 11, 4, 10), 10, 4, 44, 11, 2018, 0),
        (datetime(2018, 12, 31, 23, 59, 59), 23, 31, 1, 12, 2018, 1),
        (datetime(2021, 1, 2), 0, 2, 53, 1, 2021, 6),
        (datetime(2020, 2, 29, 5), 5, 29, 9, 2, 2020, 6),
    ],
)
def test_calendar_parts(events, row):
    assert tuple(dims.dim_time(events({"ts": row[0]})).first()) == row


def test_times_with_and_without_duplicates(events):
    df = events(at(1), at(1), at(2), {"userId": 1})
    assert dims.dim_time(df).count() == 3
    assert dims.dim_time_dedup(df).count() == 2


def test_songs_of_year(songs):
    df = songs({"song_id": "S1", "year": 2000}, {"song_id": "S2", "year": 2009}, {"song_id": "S3"})
    assert [r.song_id for r in reports.songs_of_year(df, 2009).collect()] == ["S2"]
    assert reports.songs_of_year(df, 2000).columns == df.columns


def brute_force_ranks(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    key = lambda row: [(v is None, v) for v in row]
    return sorted(
        ((*row, i) for group in groups.values() for i, row in enumerate(sorted(group, key=key), 1)),
        key=key,
    )


@pytest.mark.parametrize("partitions", [1, 8, 60])
def test_ranks_equal_brute_force(spark, conf, partitions):
    """A third of the rows share one id and half of these are equal, NULLs included."""
    rng = random.Random(7)
    rows = [("hot", "same", "A", 1)] * 500
    rows += [("hot", rng.choice(["a", "b", None]), "A", rng.randrange(50)) for _ in range(500)]
    rows += [
        (rng.choice([None, *"abcdefghij"]), rng.choice(["x", None]), "B", rng.choice([None, 1, 2]))
        for _ in range(2000)
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id string, title string, artist string, year int").repartition(5)
    conf(
        spark__sql__shuffle__partitions=partitions,
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__execution__arrow__maxRecordsPerBatch=7,
    )
    ranked = rank_within(df, "id", ["title", "artist", "year"], "rank")
    assert ranked.columns == ["id", "title", "artist", "year", "rank"]
    result = sorted((tuple(r) for r in ranked.collect()), key=lambda r: [(v is None, v) for v in r])
    assert result == brute_force_ranks(rows)


def test_rank_of_nothing(songs):
    assert dims.ranked_songs(songs()).count() == 0
