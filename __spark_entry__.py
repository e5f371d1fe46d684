"""The registered queries and the SQL they are checked against."""

from __future__ import annotations

import json
import os
import sys
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_texts
from tunemart import LoadConfig, scratch
from tunemart.functions.coerce import EPOCH
from tunemart.operators import constraints
from tunemart.plans import dims, fact, loads, pipeline, reports, tables
from tunemart.schemas import (
    DIM_ARTIST,
    DIM_SONG,
    DIM_TIME,
    DIM_USER,
    FACT_SONGPLAY,
    STAGING_EVENTS,
    STAGING_SONGS,
    STAR,
)
from tunemart.session import bucket_count_for, input_bytes
from tunemart.sources.adapter import staging_events, staging_songs
from tunemart.sources.json_records import (
    default_paths,
    read_events,
    read_path_map,
    read_songs,
    split_bad_records,
    split_bad_values,
)

try:
    from tunemart.llm.queries import ORACLE_SQL as LLM_SQL
    from tunemart.llm.queries import QUERIES as LLM_QUERIES
except ImportError as missing:  # the subpackage, or a package that only it needs, may be left out
    if not (missing.name or "").startswith(("tunemart.llm", "corpus_pipeline")):
        warnings.warn(f"queries of tunemart.llm are left out: {missing}", stacklevel=1)
    LLM_QUERIES, LLM_SQL = {}, {}

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """The song-play fact on the smallest data set."""
    return fact_songplay(spark, "/root/testdata/sf0.001")


def _staging(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return staging_events(spark, sf_dir), staging_songs(spark, sf_dir)


def _on_events(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(staging_events(spark, sf_dir))


def _on_songs(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(staging_songs(spark, sf_dir))


def fact_songplay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact.song_plays(*_staging(spark, sf_dir))


def fact_songplay_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact.keyed_song_plays(fact_songplay(spark, sf_dir))


def fact_join_no_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact.matched_plays(*_staging(spark, sf_dir))


def _log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as logs have them: all columns, epoch milliseconds, decimals with a fraction."""
    fraction = F.when(F.col("length") < 0, F.lit("-0.93179")).otherwise(F.lit("0.93179"))
    return staging_events(spark, sf_dir).withColumns(
        {
            "length": F.col("length") + fraction.cast("decimal(6,5)"),
            "method": F.lit("PUT"),
            "registration": F.lit(1540919166796.7),
            "status": F.lit(200),
            "log_year": F.year("ts"),
            "log_month": F.month("ts"),
            "ts": F.timestamp_diff("MILLISECOND", F.expr(EPOCH), F.col("ts")),
            "userId": F.coalesce(F.col("userId").cast("string"), F.lit("")),
        }
    )


def _write_path_map(spark: SparkSession, paths: list[str]) -> str:
    """A path-map document, as one row of text."""
    folder = scratch.new_folder(spark, "map")
    document = spark.range(1).select(F.lit(json.dumps({"jsonpaths": paths})).alias("value"))
    document.coalesce(1).write.text(folder)
    return folder


def load_events_jsonpaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as nested JSON logs, then loaded by a path-map document.

    The logs carry what the load must undo: user ids as text, blank for anonymous users,
    fractions, epoch milliseconds, no field where the value is NULL.
    """
    folder = scratch.new_folder(spark, "logs")
    _log_rows(spark, sf_dir).write.partitionBy("log_year", "log_month").json(folder)
    document = _write_path_map(spark, default_paths(STAGING_EVENTS))
    return read_events(spark, folder, paths=read_path_map(spark, document))


def load_events_nested_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose user and song are objects and lists inside the log record."""
    folder = scratch.new_folder(spark, "logs")
    nested = _log_rows(spark, sf_dir).select(
        F.struct(F.col("userId").alias("id"), F.array("firstName", "lastName").alias("names"), "gender").alias("user"),
        F.struct(F.col("song").alias("title"), F.array(F.struct(F.col("artist").alias("name"))).alias("by")).alias("play"),
        *[c for c in STAGING_EVENTS.column_names if c not in NESTED],
    )
    nested.write.json(folder)
    paths = [NESTED.get(c, f"$.{c}") for c in STAGING_EVENTS.column_names]
    return read_events(spark, folder, paths=read_path_map(spark, _write_path_map(spark, paths)))


# Where `load_events_nested_paths` puts columns.
NESTED = {
    "userId": "$.user.id",
    "firstName": "$.user.names[0]",
    "lastName": "$['user']['names'][1]",
    "gender": "$.user.gender",
    "song": "$.play.title",
    "artist": "$.play.by[0].name",
}


def _spelled(number: Column, row: Column) -> Column:
    """A whole number as JSON, in one of four ways; NULL as blank text or null."""
    text = number.cast("string")
    return (
        F.when(number.isNull(), F.when(row % 2 == 0, F.lit('""')).otherwise(F.lit("null")))
        .when((row % 4 == 0) | (number == 0), text)
        .when(row % 4 == 1, F.concat(F.lit('"'), text, F.lit('"')))
        .when(row % 4 == 2, F.concat(text, F.lit(".0")))
        .otherwise(F.concat(text, F.lit("0e-1")))
    )


def load_events_number_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and times of all events, whole numbers spelled in all ways that JSON has."""
    folder, row = scratch.new_folder(spark, "logs"), F.xxhash64("lastName", "ts", "sessionId")
    millis = F.timestamp_diff("MILLISECOND", F.expr(EPOCH), F.col("ts"))
    fields = [
        F.concat(F.lit(f'"{name}": '), _spelled(number, row))
        for name, number in (("userId", F.col("userId")), ("ts", millis), ("sessionId", F.col("sessionId")))
    ]
    lines = staging_events(spark, sf_dir).select(F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}")))
    lines.write.text(folder)
    return read_events(spark, folder).select("userId", "ts", "sessionId")


def load_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad values by column, of logs whose paid plays have too large, broken or no numbers."""
    folder = scratch.new_folder(spark, "logs")
    paid = F.col("level") == "paid"
    bad = {
        "userId": F.when(paid, F.concat("userId", F.lit("000000000"))).otherwise(F.col("userId").cast("string")),
        "itemInSession": F.when(paid, F.concat("itemInSession", F.lit(".5"))).otherwise(F.col("itemInSession").cast("string")),
        "length": F.when(F.col("auth") == "Logged Out", F.lit("1e30")).otherwise(F.col("length").cast("string")),
        "ts": F.when(F.col("page") == "Home", F.lit("yesterday")),
    }
    staging_events(spark, sf_dir).withColumns(bad).write.json(folder)
    values = split_bad_values(read_events(spark, folder, on_bad_value="reject"))[1]
    return values.groupBy("column_name").agg(F.count("*").alias("n_values"), F.count_distinct("value").alias("n_different"))


def load_events_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows and bad records of logs in which every play stands behind a broken line."""
    folder = scratch.new_folder(spark, "logs")
    events = staging_events(spark, sf_dir)
    record = F.to_json(F.struct("artist", "song", "page", "sessionId", "userId"))
    broken = F.when(F.col("page") == "NextSong", F.concat(record, F.lit(", null"))).otherwise(F.lit("[]"))
    events.select(F.explode(F.array(record, broken))).write.text(folder)
    good, bad = split_bad_records(read_events(spark, folder, on_bad_record="quarantine"))
    counts = [
        good.groupBy("page").agg(F.count("*").alias("n_rows"), F.sum("sessionId").alias("sessions")),
        bad.agg(F.count("*").alias("n_rows")).select(F.lit("bad records").alias("page"), "n_rows", F.lit(None).cast("bigint").alias("sessions")),
    ]
    return reduce(DataFrame.unionByName, counts)


def load_songs_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs written as JSON records with one field too many, then loaded by name."""
    folder = scratch.new_folder(spark, "songs")
    (
        staging_songs(spark, sf_dir)
        .withColumns(
            {
                "duration": F.col("duration") + F.lit("0.93179").cast("decimal(6,5)"),
                "language": F.lit("en"),
                "initial": F.substring("title", 1, 1),
            }
        )
        .write.partitionBy("initial")
        .json(folder)
    )
    return read_songs(spark, folder)


def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs in each NOT NULL column of candidates in which each has some."""
    events, songs = _staging(spark, sf_dir)
    songs, events = (
        df.withColumns({c: F.when(~F.expr(f"coalesce({gap}, false)"), F.col(c)) for c, gap in gaps.items()})
        for df, gaps in ((songs, SONG_GAPS), (events, EVENT_GAPS))
    )
    return constraints.not_null_violations(
        [
            (FACT_SONGPLAY, fact.matched_plays(events, songs, how="left")),
            (DIM_SONG, songs),
            (DIM_ARTIST, dims.dim_artist(songs)),
            (DIM_USER, dims.user_rows(events)),
            (DIM_TIME, events.select(F.col("ts").alias("start_time"))),
            (STAGING_SONGS, songs),
        ]
    )


# Rows that lose a column's value before the reports, as SQL.
SONG_GAPS = {
    "song_id": "year = 1963",
    "title": "year = 1964",
    "artist_id": "year = 1965",
    "year": "artist_location IS NULL",
    "duration": "artist_latitude IS NULL",
    "artist_name": "year = 1966",
}
EVENT_GAPS = {
    "ts": "itemInSession = 3",
    "userId": "itemInSession = 4",
    "sessionId": "itemInSession = 5",
    "firstName": "itemInSession = 6",
    "lastName": "itemInSession = 7",
    "gender": "itemInSession = 8",
    "level": "itemInSession = 9",
}
# Rows whose text is made longer than its column allows.
SONG_EXTRA = {"song_id": "artist_location IS NULL", "artist_id": "year = 0"}
EVENT_EXTRA = {"gender": "level = 'paid'"}


def length_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Too long values in each column with a limit, after some were lengthened."""
    events, songs = _staging(spark, sf_dir)
    songs, events = (
        df.withColumns({c: F.concat(c, F.when(F.expr(on), F.lit("-X")).otherwise(F.lit(""))) for c, on in columns.items()})
        for df, columns in ((songs, SONG_EXTRA), (events, EVENT_EXTRA))
    )
    method = F.when(F.col("page") == "Home", F.lit("OPTIONS")).otherwise(F.lit("PUT"))
    return constraints.length_violations(
        [
            (STAGING_EVENTS, events.withColumn("method", method)),
            (STAGING_SONGS, songs),
            (FACT_SONGPLAY, fact.matched_plays(events, songs)),
            (DIM_SONG, songs),
            (DIM_ARTIST, dims.dim_artist(songs)),
            (DIM_USER, dims.user_rows(events)),
        ]
    )


def _fill_staging(spark: SparkSession, sf_dir: str, database: str) -> None:
    nbytes = input_bytes(spark, *[f"{sf_dir}/{name}.parquet" for name in ("events", "part")])
    tables.create_tables(spark, database, bucket_count_for(nbytes))
    for name, rows in zip(("staging_events", "staging_songs"), _staging(spark, sf_dir)):
        tables.append(rows, name, database)


def _staged_database(spark: SparkSession, sf_dir: str) -> str:
    """A database of its own with both staging tables filled and the star tables empty."""
    database = scratch.new_database(spark)
    _fill_staging(spark, sf_dir, database)
    return database


def _load(spark: SparkSession, database: str, *names: str) -> None:
    star = pipeline.build_star(*pipeline.staged(spark, database))
    for name in names:
        tables.append(star[name], name, database)


# One number for the contents of a star table besides its rows and keys: a sum over a column.
CONTENTS = {
    "factSongPlay": ("songplay_id", "session_id"),
    "dimUser": ("user_id", "length(last_name)"),
    "dimSong": ("song_id", "year"),
    "dimArtist": ("artist_id", "length(artist_name)"),
    "dimTime": ("start_time", "hour * 100 + weekday"),
}


def _contents(spark: SparkSession, database: str) -> DataFrame:
    """Rows, different keys and a sum for each star table, and the range of the play keys."""
    rows = [
        spark.table(f"`{database}`.`{name}`").agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            F.count_distinct(key).alias("n_keys"),
            F.sum(F.expr(f"cast({number} AS bigint)")).alias("content"),
            *[
                (f(key) if name == "factSongPlay" else F.max(F.lit(None).cast("bigint"))).alias(alias)
                for f, alias in ((F.min, "first_key"), (F.max, "last_key"))
            ],
        )
        for name, (key, number) in CONTENTS.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents after the star tables were filled two times."""
    database = _staged_database(spark, sf_dir)
    pipeline.insert_tables(spark, database)
    pipeline.insert_tables(spark, database)
    return _contents(spark, database)


def truncate_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every star table as it is loaded, emptied, reloaded, and dropped and loaded."""
    database = _staged_database(spark, sf_dir)
    log = scratch.new_folder(spark, "steps")

    def record(step: str) -> None:
        rows = _contents(spark, database).select(F.lit(step).alias("step"), "table_name", "n_rows", "content")
        rows.write.mode("append").parquet(log)

    pipeline.insert_tables(spark, database)
    record("loaded")
    for table in STAR:
        tables.truncate_table(spark, table.name, database)
    record("truncated")
    pipeline.insert_tables(spark, database)
    record("reloaded")
    tables.drop_tables(spark, database)
    _fill_staging(spark, sf_dir, database)
    pipeline.insert_tables(spark, database)
    record("refreshed")
    return spark.read.parquet(log)


def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents after JSON logs and song files were loaded by a path map, two full refreshes."""
    logs, songs = scratch.new_folder(spark, "logs"), scratch.new_folder(spark, "songs")
    _log_rows(spark, sf_dir).write.partitionBy("log_year", "log_month").json(logs)
    staging_songs(spark, sf_dir).withColumn("initial", F.substring("title", 1, 1)).write.partitionBy("initial").json(songs)
    cfg = LoadConfig(
        logs,
        songs,
        log_jsonpath=_write_path_map(spark, default_paths(STAGING_EVENTS)),
        database=scratch.new_database(spark),
    )
    pipeline.run(spark, cfg)
    pipeline.run(spark, cfg)
    return _contents(spark, cfg.database)


def _json_inputs(spark: SparkSession, sf_dir: str, **settings) -> LoadConfig:
    """Logs and songs as JSON files below a folder each, and a database to load them into."""
    logs, songs = scratch.new_folder(spark, "logs"), scratch.new_folder(spark, "songs")
    _log_rows(spark, sf_dir).drop("log_year", "log_month").write.json(logs)
    staging_songs(spark, sf_dir).write.json(songs)
    return LoadConfig(logs, songs, database=scratch.new_database(spark), **settings)


def load_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents after a load under an id was cut off at each of its steps, tried again and repeated."""
    cfg = _json_inputs(spark, sf_dir, load_id="day-1")
    pipeline.create_sized_tables(spark, cfg)
    # Cut off while it writes: a star load without its marker, of rows that are not there to stay.
    star = loads.Load(spark, cfg.database, "day-1.star")
    star.begin()
    tables.add_to_load(star, dims.dim_artist(staging_songs(spark, sf_dir)), "dimArtist")
    # Cut off between marker and tables.
    staging = loads.Load(spark, cfg.database, "day-1.staging")
    staging.begin()
    pipeline.stage_inputs(spark, staging, cfg)
    staging.mark()
    pipeline.etl(spark, cfg)
    pipeline.etl(spark, cfg)
    return _contents(spark, cfg.database)


def refresh_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents after a refresh, and another one that fails because the logs got a bad value."""
    cfg = _json_inputs(spark, sf_dir)
    pipeline.run(spark, cfg)
    _log_rows(spark, sf_dir).withColumn("ts", F.lit("yesterday")).write.mode("append").json(cfg.log_data)
    try:
        pipeline.run(spark, cfg)
    except Exception as error:
        if "BAD_VALUE" not in str(error):
            raise
    return _contents(spark, cfg.database)


def load_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by verdict as a load counted them, and the rows that each table got.

    Plays stand in front of a broken record, logged-out users have two bad values, records of
    page Home a method that is too long.
    """
    aside = {"on_bad_record": "quarantine", "on_bad_value": "reject", "on_violation": "reject"}
    cfg = _json_inputs(spark, sf_dir, load_id="day-1", **aside)
    out, events = F.col("auth") == "Logged Out", staging_events(spark, sf_dir)
    record = F.struct(
        "page",
        "sessionId",
        F.when(out, F.lit("x9")).otherwise(F.col("userId").cast("string")).alias("userId"),
        F.when(out, F.lit("1e30")).alias("length"),
        F.when(F.col("page") == "Home", F.lit("OPTIONS")).otherwise(F.lit("PUT")).alias("method"),
    )
    broken = F.when(F.col("page") == "NextSong", F.lit("{oops"))
    lines = events.select(F.explode(F.array_compact(F.array(F.to_json(record), broken))))
    lines.write.mode("overwrite").text(cfg.log_data)
    tables.create_tables(spark, cfg.database)
    pipeline.load_staging(spark, cfg)
    targets = {
        "good": "staging_events",
        "bad_record": "staging_bad_records",
        "bad_value": "staging_bad_values",
        "violation": "staging_events_rejects",
    }
    rows = [
        spark.table(f"`{cfg.database}`.`{name}`").agg(F.lit(verdict).alias("verdict"), F.count("*").alias("n_rows"))
        for verdict, name in targets.items()
    ]
    counted = loads.committed(spark, cfg.database).filter("table_name = 'staging_events'")
    return counted.join(reduce(DataFrame.unionByName, rows), "verdict").select("verdict", "n_records", "n_rows")


def concurrent_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and keys of the fact after four threads appended all plays at the same time."""
    database = _staged_database(spark, sf_dir)
    plays = fact.song_plays(*pipeline.staged(spark, database))
    with ThreadPoolExecutor(4) as pool:
        ids = (None, "a", "b", None)
        for done in [pool.submit(tables.append, plays, "factSongPlay", database, load_id=i) for i in ids]:
            done.result()
    return _contents(spark, database).filter("table_name = 'factSongPlay'")


def bucketed_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays with their song, both tables bucketed on the song id."""
    database = _staged_database(spark, sf_dir)
    _load(spark, database, "factSongPlay", "dimSong")
    joined = tables.join_song_dimension(spark, database, co_located=True, hint="merge")
    return joined.select(
        "start_time", "user_id", "session_id", "song_id", "artist_id", "title", "year", "duration"
    )


def plays_of_a_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays and users of each song in one week, from the tables in their layout."""
    database = _staged_database(spark, sf_dir)
    _load(spark, database, "factSongPlay", "dimSong")
    return tables.plays_between(spark, datetime(2024, 1, 8), datetime(2024, 1, 15), database)


def star_adhoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most played artists, as SQL on the loaded tables."""
    database = _staged_database(spark, sf_dir)
    _load(spark, database, "factSongPlay", "dimArtist")
    return spark.sql(f"""
        SELECT artist_id, artist_name, plays
        FROM (SELECT artist_id, count(*) AS plays FROM {database}.factSongPlay GROUP BY artist_id)
        JOIN (SELECT DISTINCT artist_id, artist_name FROM {database}.dimArtist) USING (artist_id)
        ORDER BY plays DESC, artist_id
        LIMIT 10
    """)


def queries() -> dict[str, Query]:
    return {
        "fact_songplay": fact_songplay,
        "fact_songplay_keyed": fact_songplay_keyed,
        "fact_join_no_distinct": fact_join_no_distinct,
        "dim_user": _on_events(dims.dim_user),
        "dim_song": _on_songs(dims.dim_song),
        "dim_song_ranked": _on_songs(dims.ranked_songs),
        "dim_artist": _on_songs(dims.dim_artist),
        "dim_artist_dedup": _on_songs(dims.dim_artist_dedup),
        "dim_time": _on_events(dims.dim_time),
        "dim_time_dedup": _on_events(dims.dim_time_dedup),
        "songs_of_year": _on_songs(
            lambda songs: reports.songs_of_year(songs, 2000).select(*dims.SONG_COLUMNS)
        ),
        "songs_of_year_all_columns": _on_songs(lambda songs: reports.songs_of_year(songs, 2009)),
        "song_duplicate_audit": _on_songs(lambda songs: reports.duplicate_audit(dims.dim_song(songs))),
        "staging_song_duplicate_audit": _on_songs(reports.duplicate_audit),
        "load_events_jsonpaths": load_events_jsonpaths,
        "load_events_nested_paths": load_events_nested_paths,
        "load_events_number_spellings": load_events_number_spellings,
        "load_bad_values": load_bad_values,
        "load_events_quarantine": load_events_quarantine,
        "load_songs_auto": load_songs_auto,
        "not_null_violations": not_null_violations,
        "length_violations": length_violations,
        "append_twice": append_twice,
        "truncate_reload": truncate_reload,
        "pipeline_run": pipeline_run,
        "load_retry": load_retry,
        "refresh_failure": refresh_failure,
        "load_verdicts": load_verdicts,
        "concurrent_appends": concurrent_appends,
        "bucketed_star_join": bucketed_star_join,
        "plays_of_a_week": plays_of_a_week,
        "star_adhoc": star_adhoc,
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return oracle_texts.oracle_sql() | LLM_SQL
