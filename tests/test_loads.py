"""Loads under an id, refreshes beside the old tables, reserved keys, one-pass routing."""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_tables import LOADED, PLAY, SONG, counts, frame, plays, write_inputs

from tunemart import LoadConfig, create_tables, drop_tables, scratch, shared_files
from tunemart.operators.dedup import rank_within
from tunemart.plans import loads, pipeline, tables, versions
from tunemart.plans.loads import Load
from tunemart.plans.tables import append, next_key, truncate_table
from tunemart.schemas import STAGING_EVENTS
from tunemart.sources.json_records import read_events, verdicts


def keys(spark, database):
    return sorted(r[0] for r in spark.table(f"{database}.factSongPlay").select("songplay_id").collect())


def nothing_left(spark, database):
    return [n for n in shared_files.names(spark, loads.home(spark, database)) if not n.startswith(".")] == []


def test_a_repeated_id_is_skipped(spark, database):
    create_tables(spark, database, 8)
    for _ in range(2):
        append(plays(spark, *[PLAY] * 3), "factSongPlay", database, load_id="one")
        append(frame(spark, "dimSong", SONG, {**SONG, "title": None}), "dimSong", database, "reject", load_id="two")
    append(plays(spark, PLAY), "factSongPlay", database, load_id="three")
    assert keys(spark, database) == [0, 1, 2, 3]
    assert counts(spark, database)["dimSong"] == 1
    assert spark.table(f"{database}.dimSong_rejects").count() == 1
    assert nothing_left(spark, database)


@pytest.mark.parametrize("load_id", ["", "a/b", "../x", "_x", ".keys", "a b"])
def test_ids_that_are_no_names(spark, database, load_id):
    with pytest.raises(ValueError, match="load id"):
        Load(spark, database, load_id)


def test_cut_off_before_the_marker_leaves_nothing(spark, database):
    create_tables(spark, database)
    load = Load(spark, database, "x")
    assert load.begin()
    tables.add_to_load(load, frame(spark, "dimSong", SONG, {**SONG, "year": None}), "dimSong", "reject")
    tables.add_to_load(load, plays(spark, PLAY, PLAY), "factSongPlay")
    loads.recover(spark, database)
    assert counts(spark, database)["dimSong"] == counts(spark, database)["factSongPlay"] == 0
    assert not spark.catalog.tableExists(f"{database}.dimSong_rejects")
    # Tried again, with other rows: the keys are those of the first attempt if they are as many.
    append(plays(spark, PLAY, PLAY), "factSongPlay", database, load_id="x")
    assert keys(spark, database) == [0, 1] and nothing_left(spark, database)


@pytest.mark.parametrize("step", ["before", "between", "after"])
def test_cut_off_after_the_marker_is_finished(spark, database, monkeypatch, step):
    create_tables(spark, database)
    real, seen = shared_files.move, []

    def broken(*args):
        if step == "before" or (step == "between" and seen):
            raise OSError("cut off")
        seen.append(args)
        real(*args)
        if step == "after" and len(seen) == 2:
            raise OSError("cut off")

    rows = frame(spark, "dimSong", SONG, {**SONG, "title": None})
    with monkeypatch.context() as cut:
        cut.setattr(shared_files, "move", broken)
        with pytest.raises(OSError, match="cut off"):
            append(rows, "dimSong", database, "reject", load_id="x")
    append(rows, "dimSong", database, "reject", load_id="x")
    assert counts(spark, database)["dimSong"] == 1
    assert spark.table(f"{database}.dimSong_rejects").count() == 1 and nothing_left(spark, database)


def test_retry_of_a_whole_load(spark, database, tmp_path, monkeypatch):
    cfg = LoadConfig.from_ini(write_inputs(tmp_path), database=database, load_id="day-1", buckets=4)
    create_tables(spark, database, 4)
    real = tables.write_part

    def broken(df, table, *args):
        if table.name == "dimUser":
            raise RuntimeError("lost")
        real(df, table, *args)

    with monkeypatch.context() as cut:
        cut.setattr(tables, "write_part", broken)
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.etl(spark, cfg)
    assert counts(spark, database) == {n: v if n.startswith("staging") else 0 for n, v in LOADED.items()}
    for _ in range(2):
        pipeline.etl(spark, cfg)
        assert counts(spark, database) == LOADED
    assert keys(spark, database) == list(range(12))
    # Another id loads again.
    pipeline.load_staging(spark, replace(cfg, load_id="day-2"))
    assert counts(spark, database)["staging_events"] == 2 * LOADED["staging_events"]


def test_records_by_verdict_add_up_to_the_input(spark, database, tmp_path):
    ini = write_inputs(tmp_path)
    lines = ["{oops", '{"userId": "x", "ts": 1.5}', '{"method": "POSTING"}', '{"page": "Home"}', "[]", "7"]
    (tmp_path / "logs" / "more.json").write_text("\n".join(lines))
    aside = {"on_bad_record": "quarantine", "on_bad_value": "reject", "on_violation": "reject"}
    pipeline.create_sized_tables(spark, cfg := LoadConfig.from_ini(ini, database=database, load_id="a", **aside))
    pipeline.load_staging(spark, cfg)
    found = {(r.table_name, r.verdict): r.n_records for r in loads.committed(spark, database).collect()}
    # 13 lines and 6 more, of which an empty list is no record.
    assert found == {
        ("staging_events", "good"): 14,
        ("staging_events", "bad_record"): 2,
        ("staging_events", "bad_value"): 1,
        ("staging_events", "violation"): 1,
        ("staging_songs", "good"): 4,
        ("staging_songs", "bad_record"): 0,
        ("staging_songs", "bad_value"): 0,
        ("staging_songs", "violation"): 0,
    }
    assert spark.table(f"{database}.staging_bad_values").count() == 2
    assert {r.record for r in spark.table(f"{database}.staging_bad_records").collect()} == {"{oops", "7"}
    rejected = spark.table(f"{database}.staging_events_rejects").first()
    assert (rejected.method, rejected.reason) == ("POSTING", "method is longer than 6")
    assert counts(spark, database)["staging_events"] == 14


def test_violations_fail_a_routed_load_as_a_whole(spark, database, tmp_path):
    ini = write_inputs(tmp_path)
    create_tables(spark, database)
    for line, message in (('{"method": "POSTING"}', "EXCEED_LIMIT_LENGTH"), ('{"method": "PUT      "}', None)):
        (tmp_path / "logs" / "more.json").write_text(line)
        cfg = LoadConfig.from_ini(ini, database=database, on_bad_record="quarantine")
        if message:
            with pytest.raises(Exception, match=message):
                pipeline.load_staging(spark, cfg)
            assert counts(spark, database)["staging_events"] == 0
        else:
            pipeline.load_staging(spark, cfg)
            assert spark.table(f"{database}.staging_events").filter("trim(method) = 'PUT'").count() == 13


def test_input_is_parsed_once(spark, tmp_path):
    write_inputs(tmp_path)
    rows = read_events(spark, f"{tmp_path}/logs", on_bad_record="quarantine", on_bad_value="reject")
    plan = verdicts(rows, STAGING_EVENTS, reject=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.count("from_json") == 1 and "Exchange" not in plan


def test_failing_refresh_leaves_the_tables(spark, database, tmp_path):
    cfg = LoadConfig.from_ini(write_inputs(tmp_path), database=database, buckets=4)
    pipeline.run(spark, cfg)
    rows = sorted(map(str, spark.table(f"{database}.dimSong").collect()))
    (tmp_path / "logs" / "more.json").write_text('{"ts": "yesterday"}')
    with pytest.raises(Exception, match="BAD_VALUE"):
        pipeline.run(spark, cfg)
    assert counts(spark, database) == LOADED and rows == sorted(map(str, spark.table(f"{database}.dimSong").collect()))
    assert [d.name for d in spark.catalog.listDatabases() if d.name.startswith(f"{database}__")] == []
    pipeline.run(spark, replace(cfg, on_bad_value="null", buckets=3))
    assert counts(spark, database)["staging_events"] == 14
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {database}.factSongPlay").collect()}
    assert (details["Num Buckets"], details["Type"]) == ("3", "MANAGED")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        append(frame(spark, "dimSong", {**SONG, "song_id": "S" * 19}), "dimSong", database)
    before = versions._describe(spark, f"`{database}`.`dimUser`")
    create_tables(spark, f"{database}_like", 3)
    assert versions._alike(versions._describe(spark, f"`{database}_like`.`dimUser`"), before)
    spark.sql(f"DROP DATABASE `{database}_like` CASCADE")
    append(plays(spark, PLAY), "factSongPlay", database)
    assert keys(spark, database) == list(range(13))


def test_old_files_stay_until_the_next_refresh(spark, database, tmp_path):
    cfg = LoadConfig.from_ini(write_inputs(tmp_path), database=database, buckets=4)
    pipeline.run(spark, cfg)
    reading = spark.table(f"{database}.dimSong")
    first = reading.inputFiles()
    pipeline.run(spark, cfg)
    assert all(shared_files.exists(spark, f) for f in first)
    assert {*spark.table(f"{database}.dimSong").inputFiles()}.isdisjoint(first)
    pipeline.run(spark, cfg)
    assert not any(shared_files.exists(spark, f) for f in first)
    truncate_table(spark, "factSongPlay", database)
    assert next_key(spark, database) == 0
    drop_tables(spark, database)
    create_tables(spark, database, 4)
    assert set(counts(spark, database).values()) == {0}


@pytest.mark.parametrize("cut_at", [0, 3])
def test_cut_off_switch_is_finished(spark, database, tmp_path, monkeypatch, cut_at):
    cfg = LoadConfig.from_ini(write_inputs(tmp_path), database=database, buckets=4, on_violation="reject")
    pipeline.run(spark, cfg)
    (tmp_path / "logs" / "more.json").write_text('{"page": "Home", "ts": 5}')
    real, calls = shared_files.move, []

    def broken(_, source, target):
        # Moves within the version: what loads move before does not count.
        if "/build/" in source and "/load-" not in target:
            calls.append(target)
            if len(calls) == 2 * cut_at + 1:
                raise OSError("cut off")
        real(spark, source, target)

    with monkeypatch.context() as cut:
        cut.setattr(shared_files, "move", broken)
        with pytest.raises(OSError, match="cut off"):
            pipeline.run(spark, cfg)
    versions.recover(spark, database)
    assert counts(spark, database) == {**LOADED, "staging_events": 14, "dimTime": 14}
    versions.recover(spark, database)
    pipeline.run(spark, cfg)
    assert counts(spark, database) == {**LOADED, "staging_events": 14, "dimTime": 14}


def test_threads_append_with_keys_of_their_own(spark, database):
    create_tables(spark, database, 4)
    together = threading.Barrier(4)

    def fill(n):
        together.wait()
        append(plays(spark, *[{**PLAY, "session_id": i} for i in range(n)]), "factSongPlay", database)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(fill, [3, 4, 5, 6]))
    assert keys(spark, database) == list(range(18))


def test_reservations(spark, database):
    create_tables(spark, database)
    reserved = lambda owner=None: loads.reserved_keys(spark, database, lambda: 0, owner)
    with reserved() as take:
        assert take(5) == 0 and take(3) == 5
    with pytest.raises(ZeroDivisionError):
        with reserved() as take:
            assert take(4) == 8
            1 / 0
    with reserved() as take:  # what failed gave its range back
        assert take(2) == 8
    with pytest.raises(ZeroDivisionError):
        with reserved("load"), reserved("load") as take:
            assert take(10) == 10
            1 / 0
    with reserved("load") as take:  # a load that is tried again has its range
        assert take(10) == 10
    with reserved("load") as take:
        assert take(11) == 20
    with ThreadPoolExecutor(8) as pool:
        def one(_):
            with reserved() as take:
                return take(7)
        starts = sorted(pool.map(one, range(24)))
    assert starts == list(range(31, 31 + 7 * 24, 7))


def test_one_writer_wins(spark, database):
    path = f"{loads.home(spark, database)}/x"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: shared_files.write_new(spark, path, str(k)), range(16)))
    assert sum(won) == 1 and shared_files.read_text(spark, path) == str(won.index(True))
    assert shared_files.names(spark, loads.home(spark, database)) == ["x"]


def test_fact_is_written_twice_in_all(spark, database, monkeypatch):
    """Once to scratch, with place and reason, and once as it stays, rejects included."""
    create_tables(spark, database, 4)
    rows = plays(spark, PLAY, {**PLAY, "song_id": None}, PLAY, {**PLAY, "user_id": None})
    written, materialize = [], scratch.materialize
    monkeypatch.setattr(scratch, "materialize", lambda df, purpose: (written.append(purpose), materialize(df, purpose))[1])
    append(rows, "factSongPlay", database, "reject")
    assert written == ["numbered"]
    assert keys(spark, database) == [0, 1]
    assert spark.table(f"{database}.factSongPlay_rejects").count() == 2


def test_ordered_keys_skip_rejects(spark, database):
    create_tables(spark, database)
    rows = [{**PLAY, "session_id": i, "user_id": None if i % 3 == 0 else i} for i in range(30)]
    df = plays(spark, *rows).repartition(5)
    append(df, "factSongPlay", database, "reject", ordered_keys=True)
    table = spark.table(f"{database}.factSongPlay").orderBy("songplay_id").collect()
    assert [(r.songplay_id, r.user_id) for r in table] == list(enumerate(i for i in range(30) if i % 3))


def test_ranks_use_no_python_and_move_rows_once(spark):
    songs = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("song_id"),
        (F.col("id") * 7919 % 4001).alias("year"),
    )
    with scratch.scope():
        ranked = rank_within(songs, "song_id", ["year"], "rank")
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Exchange hashpartitioning" not in plan
        rows = ranked.collect()
    found = {}
    for r in sorted(rows, key=lambda r: r.rank):
        found.setdefault(r.song_id, []).append((r.rank, r.year))
    for key, ranks in found.items():
        assert [n for n, _ in ranks] == list(range(1, len(ranks) + 1)), key
        assert [y for _, y in ranks] == sorted(y for _, y in ranks)
    assert sum(map(len, found.values())) == 4000
