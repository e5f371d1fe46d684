"""The fact: matching, distinctness, keys, popular songs."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tunemart.operators.keys import number_rows
from tunemart.plans.fact import keyed_song_plays, matched_plays, song_plays

PLAY = {
    "page": "NextSong",
    "song": "Blue",
    "artist": "Ann",
    "ts": datetime(2018, 11, 1),
    "userId": 1,
    "sessionId": 5,
    "level": "free",
}
SONG = {"title": "Blue", "artist_name": "Ann", "song_id": "S1", "artist_id": "A1"}


def test_songs_of_one_name_multiply_a_play(events, songs):
    plays = song_plays(events(PLAY), songs(SONG, {**SONG, "song_id": "S2"}))
    assert sorted(r.song_id for r in plays.collect()) == ["S1", "S2"]


def test_repeated_play_counts_once(events, songs):
    assert song_plays(events(PLAY, PLAY), songs(SONG)).count() == 1
    assert matched_plays(events(PLAY, PLAY), songs(SONG)).count() == 2


def test_repeated_song_record_adds_nothing(events, songs):
    assert song_plays(events(PLAY), songs(SONG, SONG)).count() == 1
    assert matched_plays(events(PLAY), songs(SONG, SONG)).count() == 2


def test_same_play_under_two_titles_counts_once(events, songs):
    df = songs(SONG, {**SONG, "title": "Bleu"})
    assert song_plays(events(PLAY, {**PLAY, "song": "Bleu"}), df).count() == 1


def test_only_song_pages_and_known_names_match(events, songs):
    other = [{"page": "Home"}, {"page": None}, {"song": None}, {"artist": None}, {"artist": "Bo"}]
    df = events(PLAY, *[{**PLAY, **o} for o in other])
    assert song_plays(df, songs(SONG, {**SONG, "title": None}, {**SONG, "artist_name": None})).count() == 1


def test_missing_values_are_kept_and_equal(events, songs):
    play = {**PLAY, "userId": None, "ts": None}
    rows = song_plays(events(play, play), songs(SONG)).collect()
    assert len(rows) == 1 and rows[0].user_id is None and rows[0].location is None


@pytest.mark.parametrize("order", [None, ["a", "b"]])
def test_numbers_are_dense(spark, order):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b")).repartition(6)
    rows = number_rows(df, "n", order, start=5).collect()
    assert sorted(r.n for r in rows) == list(range(5, 1005))
    if order:
        assert [(r.a, r.b) for r in sorted(rows, key=lambda r: r.n)] == sorted((r.a, r.b) for r in rows)


@pytest.mark.parametrize("order", [None, ["b"]])
def test_numbers_of_nothing(spark, order):
    assert number_rows(spark.range(0).withColumnRenamed("id", "b"), "n", order).count() == 0


def test_keys_follow_the_order_whatever_the_partitioning(spark, events, songs):
    plays = [{**PLAY, "ts": datetime(2018, 11, 1, i % 24, i), "userId": i % 3} for i in range(50)]
    facts = song_plays(events(*plays), songs(SONG, {**SONG, "song_id": "S2"}))
    first = sorted(tuple(r) for r in keyed_song_plays(facts).collect())
    second = sorted(tuple(r) for r in keyed_song_plays(facts.repartition(7)).collect())
    assert first == second
    assert [r[0] for r in first] == list(range(100))


def hot_inputs(spark, n=60_000):
    """A third of the plays are of one song, which a few records share; a third of the
    rest are copies of a single play."""
    i = F.col("id")
    hot = i % 3 == 0
    copy = i % 9 == 1
    events = spark.range(n).select(
        F.lit("NextSong").alias("page"),
        F.when(hot, F.lit("Hit")).when(copy, F.lit("Copy")).otherwise(F.concat(F.lit("T"), (i % 500).cast("string"))).alias("song"),
        F.lit("Ann").alias("artist"),
        F.timestamp_add(
            "SECOND", F.when(copy, F.lit(0)).otherwise(i), F.expr("TIMESTAMP_NTZ'2018-11-01 00:00:00'")
        ).alias("ts"),
        F.when(copy, F.lit(0)).otherwise(i % 1000).cast("int").alias("userId"),
        F.lit("free").alias("level"),
        F.when(copy, F.lit(0)).otherwise(i % 100).cast("int").alias("sessionId"),
        F.lit("x").alias("location"),
        F.lit("agent").alias("userAgent"),
    )
    songs = spark.range(503).select(
        F.when(i < 2, F.lit("Hit")).when(i == 2, F.lit("Copy")).otherwise(F.concat(F.lit("T"), (i - 3).cast("string"))).alias("title"),
        F.lit("Ann").alias("artist_name"),
        F.concat(F.lit("S"), i.cast("string")).alias("song_id"),
        F.lit("A1").alias("artist_id"),
    )
    return events, songs


def test_popular_song_is_split_over_tasks(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
    )
    events, songs = hot_inputs(spark)
    plays = song_plays(events, songs)
    rows = {tuple(r) for r in plays.collect()}
    final_plan = plays._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final_plan and "skew=true" in final_plan

    expected = set()
    names = {}
    for s in songs.collect():
        names.setdefault((s.title, s.artist_name), []).append((s.song_id, s.artist_id))
    for e in events.collect():
        for song_id, artist_id in names.get((e.song, e.artist), []):
            expected.add(
                (e.ts, e.userId, e.level, song_id, artist_id, e.sessionId, e.location, e.userAgent)
            )
    assert rows == expected
    assert plays.count() == len(expected)
