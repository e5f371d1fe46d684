"""Life cycle, constraints and layout of the catalog tables; the whole pipeline."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tunemart import (
    LoadConfig,
    append,
    create_tables,
    drop_tables,
    insert_tables,
    load_staging,
    run,
    scratch,
    truncate_table,
)
from tunemart.__main__ import main
from tunemart.operators import constraints
from tunemart.plans.pipeline import size_of
from tunemart.plans.tables import join_song_dimension, next_key, plays_between
from tunemart.schemas import DIM_SONG, DIM_USER, ROW_GROUP_BYTES, STAGING, STAR, TABLES
from tunemart.session import (
    LEAST_BUCKETS,
    bucket_count_for,
    input_bytes,
    partitions_for,
    shuffle_partitions,
)

SONG = {"song_id": "S1", "title": "Blue", "artist_id": "A1", "year": 2000, "duration": Decimal(1)}
PLAY = {
    "start_time": datetime(2018, 11, 1),
    "user_id": 1,
    "song_id": "S1",
    "artist_id": "A1",
    "session_id": 5,
}


def frame(spark, table, *rows, leave_out=()):
    columns = [c for c in TABLES[table].columns if c.name not in leave_out]
    schema = ", ".join(f"{c.name} {c.value_type}" for c in columns)
    return spark.createDataFrame([tuple(r.get(c.name) for c in columns) for r in rows], schema)


def plays(spark, *rows):
    return frame(spark, "factSongPlay", *rows, leave_out=("songplay_id",))


def counts(spark, database):
    return {t.name: spark.table(f"`{database}`.`{t.name}`").count() for t in STAGING + STAR}


def test_create_keeps_existing_and_drop_is_repeatable(spark, database):
    create_tables(spark, database)
    append(frame(spark, "dimSong", SONG), "dimSong", database)
    create_tables(spark, database)
    assert counts(spark, database)["dimSong"] == 1
    drop_tables(spark, database)
    drop_tables(spark, database)
    assert spark.catalog.listTables(database) == []


def test_declared_columns_and_case(spark, database):
    create_tables(spark, database)
    for table in STAGING + STAR:
        assert spark.table(f"`{database}`.`{table.name}`").columns == table.column_names
        described = spark.sql(f"DESCRIBE `{database}`.`{table.name}`").collect()
        types = {r.col_name: r.data_type.upper() for r in described}
        assert all(types[c.name] == c.type for c in table.columns)
    assert spark.sql(f"SELECT SONG_ID FROM {database}.dimsong").count() == 0


def test_length_limits_hold_on_write(spark, database):
    create_tables(spark, database)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        append(frame(spark, "dimSong", {**SONG, "song_id": "S" * 19}), "dimSong", database)
    user = {"user_id": 1, "first_name": "a", "last_name": "b", "gender": "xy", "level": "free"}
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        append(frame(spark, "dimUser", user), "dimUser", database)
    assert counts(spark, database)["dimSong"] == 0


def test_fixed_width_method(spark, database, events):
    create_tables(spark, database)
    append(events({"method": "PUT"}), "staging_events", database)
    table = spark.table(f"{database}.staging_events")
    assert table.filter("method = 'PUT'").count() == 1


@pytest.mark.parametrize(
    ("name", "row", "column"),
    [
        ("dimSong", {**SONG, "title": None}, "title"),
        ("dimTime", {"hour": 1}, "start_time"),
        ("dimArtist", {"artist_id": "A1"}, "artist_name"),
        ("staging_songs", {"title": "x"}, "song_id"),
        (
            "dimUser",
            {"user_id": 1, "first_name": "a", "last_name": "b", "level": "free"},
            "gender",
        ),
    ],
)
def test_null_fails_the_whole_append(spark, database, name, row, column):
    create_tables(spark, database)
    good = {c.name: {"INT": 1, "TIMESTAMP_NTZ": datetime(2018, 1, 1)}.get(c.type, None) for c in TABLES[name].columns}
    good |= {c.name: "a" for c in TABLES[name].columns if c.value_type == "STRING"}
    good |= {c.name: Decimal(1) for c in TABLES[name].columns if c.type.startswith("DECIMAL")}
    with pytest.raises(Exception, match=f"{name}.{column} must not be NULL"):
        append(frame(spark, name, good, row), name, database)
    assert counts(spark, database)[name] == 0


def test_null_in_fact_fails(spark, database):
    create_tables(spark, database)
    with pytest.raises(Exception, match="factSongPlay.user_id must not be NULL"):
        append(plays(spark, PLAY, {**PLAY, "user_id": None}), "factSongPlay", database)


def test_rejects_are_set_aside(spark, database):
    create_tables(spark, database)
    rows = [SONG, {**SONG, "title": None, "year": None}, {**SONG, "song_id": "S" * 19}]
    append(frame(spark, "dimSong", *rows), "dimSong", database, on_violation="reject")
    assert counts(spark, database)["dimSong"] == 1
    rejects = spark.table(f"{database}.dimSong_rejects")
    assert sorted(r.reason for r in rejects.collect()) == [
        "song_id is longer than 18",
        "title is NULL; year is NULL",
    ]
    append(plays(spark, PLAY, {**PLAY, "song_id": None}, PLAY), "factSongPlay", database, "reject")
    keys = [r[0] for r in spark.table(f"{database}.factSongPlay").select("songplay_id").collect()]
    assert sorted(keys) == [0, 1]


def test_violation_reports(spark):
    song = frame(spark, "dimSong", SONG, {**SONG, "year": None}, {**SONG, "song_id": "S" * 19})
    user = frame(spark, "dimUser", {"gender": "xy"})
    nulls = constraints.not_null_violations([(DIM_SONG, song), (DIM_USER, user)]).collect()
    assert {(r.table_name, r.column_name): r.violations for r in nulls if r.violations} == {
        ("dimSong", "year"): 1,
        ("dimUser", "user_id"): 1,
        ("dimUser", "first_name"): 1,
        ("dimUser", "last_name"): 1,
        ("dimUser", "level"): 1,
    }
    lengths = constraints.length_violations([(DIM_SONG, song), (DIM_USER, user)]).collect()
    assert {(r.table_name, r.column_name): r.violations for r in lengths} == {
        ("dimSong", "song_id"): 1,
        ("dimSong", "artist_id"): 0,
        ("dimUser", "gender"): 1,
    }


def test_keys_go_on_where_they_ended(spark, database):
    create_tables(spark, database)
    assert next_key(spark, database) == 0
    append(plays(spark, *[PLAY] * 5), "factSongPlay", database)
    append(plays(spark, *[{**PLAY, "user_id": 2}] * 3), "factSongPlay", database)
    rows = spark.table(f"{database}.factSongPlay").select("songplay_id", "user_id").collect()
    assert sorted(map(tuple, rows)) == [(i, 1) for i in range(5)] + [(i, 2) for i in range(5, 8)]


def test_omitted_columns_are_null_and_order_does_not_matter(spark, database):
    create_tables(spark, database)
    df = spark.createDataFrame([("x", "A1")], "artist_name string, artist_id string")
    append(df, "dimArtist", database)
    assert tuple(spark.table(f"{database}.dimArtist").first()) == ("A1", "x", None, None, None)


def test_truncate_keeps_the_table(spark, database):
    create_tables(spark, database)
    append(frame(spark, "dimSong", SONG), "dimSong", database)
    truncate_table(spark, "dimSong", database)
    assert counts(spark, database)["dimSong"] == 0
    append(frame(spark, "dimSong", SONG), "dimSong", database)
    assert counts(spark, database)["dimSong"] == 1


def many_plays(spark, hot):
    """Plays of 200 songs; `hot` sends a third of them to one song."""
    song = (F.col("id") % 200).cast("string")
    return spark.range(9000).select(
        F.timestamp_add("SECOND", F.col("id"), F.expr("TIMESTAMP_NTZ'2018-11-01 00:00:00'")).alias("start_time"),
        F.lit(1).alias("user_id"),
        F.concat(F.lit("S"), F.when(F.lit(hot) & (F.col("id") % 3 == 0), F.lit("0")).otherwise(song)).alias("song_id"),
        F.lit("A1").alias("artist_id"),
        F.col("id").cast("int").alias("session_id"),
    )


def all_songs(spark):
    return spark.range(200).select(
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("song_id"),
        F.concat(F.lit("title "), F.col("id").cast("string")).alias("title"),
        F.lit("A1").alias("artist_id"),
        F.lit(2000).alias("year"),
        F.lit(Decimal(1)).cast("decimal(18,0)").alias("duration"),
    )


@pytest.mark.parametrize("hot", [False, True])
def test_co_located_join(spark, conf, database, hot):
    conf(
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=1.5,
    )
    create_tables(spark, database, 8)
    append(many_plays(spark, hot), "factSongPlay", database)
    append(all_songs(spark), "dimSong", database)
    joined = join_song_dimension(spark, database, co_located=not hot)
    assert joined.count() == 9000
    rows = joined.select("session_id", "song_id", "title")
    assert rows.filter("title <> concat('title ', substring(song_id, 2))").count() == 0
    assert rows.select("session_id").distinct().count() == 9000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    if hot:
        assert plan.count("Exchange hashpartitioning(song_id") == 2
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    else:
        assert "Exchange" not in plan


def plays_of_days(spark, n, days):
    """Plays spread over songs and days."""
    return spark.range(n).select(
        F.expr(f"TIMESTAMP_NTZ '2018-01-01 00:00:00' + make_dt_interval(id % {days}, 0, 0, id % 86400)").alias("start_time"),
        (F.col("id") % 1000).cast("int").alias("user_id"),
        F.concat(F.lit("S"), (F.hash("id") % 200 + 200).cast("string")).alias("song_id"),
        F.lit("A1").alias("artist_id"),
        F.col("id").cast("int").alias("session_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("user_agent"),
    )


def row_groups(spark, table):
    """First and last time of each row group, by file."""
    for path in spark.table(table).inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file:").replace("//", "/")).metadata
        column = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == "start_time")
        for i in range(meta.num_row_groups):
            found = meta.row_group(i).column(column).statistics
            yield path, found.min, found.max


def test_a_day_reads_few_row_groups_and_keeps_the_placement(spark, conf, database, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1)
    monkeypatch.setitem(TABLES, "factSongPlay", replace(TABLES["factSongPlay"], row_group_bytes=128 * 1024))
    create_tables(spark, database, 4)
    append(plays_of_days(spark, 200_000, 100), "factSongPlay", database)
    songs = spark.range(400).select(
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("song_id"),
        F.lit("title").alias("title"),
        F.lit("A1").alias("artist_id"),
        F.lit(2000).alias("year"),
        F.lit(Decimal(1)).cast("decimal(18,0)").alias("duration"),
    )
    append(songs, "dimSong", database)
    start, end = datetime(2018, 2, 1), datetime(2018, 2, 2)
    groups = list(row_groups(spark, f"{database}.factSongPlay"))
    touched = [g for g in groups if g[1] < end and g[2] >= start]
    assert len(groups) >= 60 and 0 < len(touched) < len(groups) / 10
    result = plays_between(spark, start, end, database)
    assert result.agg(F.sum("plays")).first()[0] == 2000
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(start_time" in plan
    both = plays_between(spark, start, end, database, co_located=False)
    assert both.exceptAll(result).count() == 0 and result.exceptAll(both).count() == 0


def test_production_row_groups_of_the_fact(spark, database):
    create_tables(spark, database, 4)
    properties = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.factSongPlay").collect()
    stored = next(r.data_type for r in properties if r.col_name == "Storage Properties")
    assert f"parquet.block.size={ROW_GROUP_BYTES}" in stored and "recursiveFileLookup=true" in stored


def test_popular_bucket_is_written_by_several_tasks(spark, conf, database):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="8k")
    create_tables(spark, database, 8)
    append(many_plays(spark, hot=True), "factSongPlay", database)
    files = spark.table(f"{database}.factSongPlay").select("song_id", "_metadata.file_name")
    assert files.filter("song_id = 'S0'").select("file_name").distinct().count() > 1


@pytest.mark.parametrize("buckets", [8, None])
def test_rows_are_sorted_inside_files(spark, database, buckets):
    create_tables(spark, database, buckets)
    append(many_plays(spark, False).orderBy(F.rand(1)), "factSongPlay", database)
    table = spark.table(f"{database}.factSongPlay")
    by_file = table.select("start_time", "_metadata.file_name", "_metadata.file_block_start")
    seen = {}
    for file in [r[0] for r in by_file.select("file_name").distinct().collect()]:
        path = table.select("_metadata.file_path").filter(F.col("_metadata.file_name") == file).first()[0]
        times = [r[0] for r in spark.read.parquet(path).select("start_time").coalesce(1).collect()]
        seen[file] = times == sorted(times)
    assert seen and all(seen.values())


def write_inputs(folder):
    logs, songs = folder / "logs" / "2018" / "11", folder / "songs" / "A" / "B"
    logs.mkdir(parents=True)
    songs.mkdir(parents=True)
    base = {"artist": "Ann", "firstName": "Al", "lastName": "Lee", "gender": "M", "method": "PUT"}
    lines = [
        {**base, "page": "NextSong", "song": "Blue", "userId": str(i % 3), "level": "free",
         "sessionId": i, "ts": 1541105830796 + i}
        for i in range(12)
    ]
    lines += [{"page": "Home", "userId": "", "level": "free", "ts": 1541105830796}]
    (logs / "day.json").write_text("\n".join(map(json.dumps, lines)))
    for i in range(4):
        record = {"song_id": f"S{i // 2}", "title": ["Blue", "Red"][i // 2], "artist_name": "Ann",
                  "artist_id": "A1", "year": 2000 + i, "duration": 1.5}
        (songs / f"{i}.json").write_text(json.dumps(record))
    (folder / "paths.json").write_text(
        json.dumps({"jsonpaths": [f"$['{c}']" for c in TABLES["staging_events"].column_names]})
    )
    ini = folder / "load.cfg"
    ini.write_text(
        f"[S3]\nSONG_DATA    = '{folder}/songs'\nLOG_DATA = '{folder}/logs'\n"
        f"LOG_JSONPATH = '{folder}/paths.json'\n"
    )
    return str(ini)


LOADED = {
    "staging_events": 13,
    "staging_songs": 4,
    "factSongPlay": 12,
    "dimUser": 3,
    "dimSong": 2,
    "dimArtist": 4,
    "dimTime": 13,
}


@pytest.mark.parametrize("ordered", [False, True])
def test_pipeline_twice_gives_the_same_tables(spark, database, tmp_path, ordered):
    cfg = LoadConfig.from_ini(write_inputs(tmp_path), database=database, ordered_keys=ordered)
    contents = []
    for _ in range(2):
        run(spark, cfg)
        assert counts(spark, database) == LOADED
        star = {t.name: spark.table(f"{database}.{t.name}").collect() for t in STAR}
        keys = [r.songplay_id for r in star["factSongPlay"]]
        assert sorted(keys) == list(range(12))
        if not ordered:
            star["factSongPlay"] = [r[1:] for r in star["factSongPlay"]]
        contents.append({name: sorted(map(str, rows)) for name, rows in star.items()})
    assert contents[0] == contents[1]


def test_load_without_refresh_doubles(spark, database, tmp_path):
    cfg = LoadConfig.from_ini(write_inputs(tmp_path), database=database)
    run(spark, cfg)
    insert_tables(spark, database)
    doubled = {n: v if n.startswith("staging") else 2 * v for n, v in LOADED.items()}
    assert counts(spark, database) == doubled
    load_staging(spark, cfg)
    assert counts(spark, database)["staging_events"] == 26


def test_bad_records_and_violations_are_set_aside(spark, database, tmp_path):
    ini = write_inputs(tmp_path)
    (tmp_path / "logs" / "bad.json").write_text('{oops\n{"page": "Home", "userId": "9", "ts": 1}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        run(spark, LoadConfig.from_ini(ini, database=database))
    assert counts(spark, database)["factSongPlay"] == 0
    cfg = LoadConfig.from_ini(ini, database=database, on_bad_record="quarantine", on_violation="reject")
    run(spark, cfg)
    assert counts(spark, database) == {**LOADED, "staging_events": 14, "dimTime": 14}
    assert spark.table(f"{database}.staging_bad_records").collect() == [("staging_events", "{oops")]
    assert spark.table(f"{database}.dimUser_rejects").count() == 1


def test_all_errors_of_the_load_are_raised(spark, database, tmp_path):
    ini = write_inputs(tmp_path)
    (tmp_path / "songs" / "gap.json").write_text('{"song_id": "S9", "artist_name": "Bo"}')
    with pytest.raises(ExceptionGroup) as failed:
        run(spark, LoadConfig.from_ini(ini, database=database))
    assert len(failed.value.exceptions) == 2
    assert all("must not be NULL" in str(e) for e in failed.value.exceptions)


def test_scratch_folders_are_removed(spark, database, tmp_path):
    before = len(scratch._handed_out)
    create_tables(spark, database)
    append(plays(spark, PLAY), "factSongPlay", database)
    assert len(scratch._handed_out) == before


def test_unknown_setting_is_refused():
    with pytest.raises(ValueError, match="on_violation"):
        LoadConfig("a", "b", on_violation="ignore")


def test_command_line(spark, database, tmp_path):
    ini = write_inputs(tmp_path)
    main(["create-tables", "--config", ini, "--database", database])
    main(["etl", "--config", ini, "--database", database])
    assert counts(spark, database) == LOADED
    main(["run", "--config", ini, "--database", database, "--dedup", "--buckets", "4"])
    assert counts(spark, database) == {**LOADED, "dimArtist": 1, "dimTime": 12}
    for arguments in (["run"], ["create-tables", "--database", database]):
        with pytest.raises(SystemExit):
            main(arguments)
    main(["create-tables", "--database", database, "--buckets", "3"])
    assert bucket_counts(spark, database) == {"factSongPlay": 3, "dimSong": 3, "dimArtist": 3, "dimUser": 3}


def bucket_counts(spark, database):
    found = {}
    for table in STAR:
        for row in spark.sql(f"DESCRIBE EXTENDED {database}.{table.name}").collect():
            if row.col_name == "Num Buckets":
                found[table.name] = int(row.data_type)
    return found


def test_all_routes_have_one_size(spark, database, tmp_path, monkeypatch):
    ini = write_inputs(tmp_path)
    monkeypatch.setattr("tunemart.session.INPUT_PER_BUCKET", 100)
    monkeypatch.setattr("tunemart.session.INPUT_PER_PARTITION", 200)
    cfg = LoadConfig.from_ini(ini, database=database)
    size = size_of(spark, cfg)
    both = input_bytes(spark, f"{tmp_path}/logs", f"{tmp_path}/songs")
    assert both == sum(f.stat().st_size for f in tmp_path.rglob("*.json") if f.name != "paths.json")
    assert (size.buckets, size.partitions) == (-(-both // 100), -(-both // 200))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    real = shuffle_partitions
    monkeypatch.setattr(
        "tunemart.plans.pipeline.shuffle_partitions", lambda s, n: (seen.append(n), real(s, n))[1]
    )
    main(["create-tables", "--config", ini, "--database", database])
    two_steps = bucket_counts(spark, database)
    main(["etl", "--config", ini, "--database", database])
    main(["run", "--config", ini, "--database", database])
    assert two_steps == bucket_counts(spark, database) and {*two_steps.values()} == {size.buckets}
    assert seen == [size.partitions] * 2
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    limited = size_of(spark, LoadConfig.from_ini(ini, max_buckets=9, max_partitions=2))
    assert (limited.buckets, limited.partitions) == (9, 2)


def test_compressed_inputs_count_as_text(spark, tmp_path):
    (tmp_path / "a.json.gz").write_bytes(b"x" * 100)
    (tmp_path / "b.json").write_bytes(b"x" * 100)
    assert input_bytes(spark, str(tmp_path)) == 900


@pytest.mark.parametrize("dedup", [False, True])
def test_files_of_times_do_not_overlap(spark, database, conf, events, dedup):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    from tunemart.plans import dims

    create_tables(spark, database, 8)
    staged = spark.range(5000).select(
        F.timestamp_add("SECOND", (F.col("id") * 7919) % 3000, F.expr("TIMESTAMP_NTZ'2018-11-01 00:00:00'")).alias("ts")
    )
    append((dims.dim_time_dedup if dedup else dims.dim_time)(staged), "dimTime", database)
    table = spark.table(f"{database}.dimTime")
    ranges = table.groupBy("_metadata.file_path").agg(F.min("start_time"), F.max("start_time")).collect()
    ends = sorted((low, high) for _, low, high in ranges)
    assert len(ends) > 1 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_sizes_follow_the_input():
    terabyte = 1024**4
    assert bucket_count_for(0) == LEAST_BUCKETS and partitions_for(1) == 1
    assert bucket_count_for(100 * terabyte) == 25_600
    assert partitions_for(terabyte) == 2048
    assert partitions_for(100 * terabyte) == 204_800
    assert partitions_for(terabyte, 100) == 100


def test_bad_values_are_set_aside(spark, database, tmp_path):
    ini = write_inputs(tmp_path)
    (tmp_path / "logs" / "bad.json").write_text('{"page": "Home", "userId": "x9", "ts": 1.5}\n')
    with pytest.raises(Exception, match="BAD_VALUE: staging_events"):
        run(spark, LoadConfig.from_ini(ini, database=database))
    run(spark, LoadConfig.from_ini(ini, database=database, on_bad_value="reject"))
    assert counts(spark, database) == LOADED
    assert sorted(map(tuple, spark.table(f"{database}.staging_bad_values").collect())) == [
        ("staging_events", "ts", "1.5"),
        ("staging_events", "userId", "x9"),
    ]
    run(spark, LoadConfig.from_ini(ini, database=database, on_bad_value="null"))
    assert counts(spark, database)["staging_events"] == 14


def test_failing_append_leaves_no_rejects(spark, database):
    create_tables(spark, database, 8)
    spark.sql(f"DROP TABLE {database}.dimSong")
    rows = [SONG, {**SONG, "title": None}]
    with pytest.raises(Exception):
        append(frame(spark, "dimSong", *rows), "dimSong", database, on_violation="reject")
    assert not spark.catalog.tableExists(f"{database}.dimSong_rejects")
