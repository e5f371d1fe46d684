"""Loading of JSON records: paths, types, nesting, bad records."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tunemart.functions.coerce import epoch_millis, to_decimal
from tunemart.schemas import STAGING_EVENTS
from tunemart.sources.json_records import (
    default_paths,
    read_events,
    read_path_map,
    read_songs,
    split_bad_records,
    split_bad_values,
)

EVENT = {"userId": "39", "ts": 1541105830796, "page": "NextSong", "length": 218.93179}


def write_lines(folder, *records, name="2018/11/events.json"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def nested_paths(**changes):
    """The default path map with some columns taken from elsewhere."""
    return [changes.get(c, f"$.{c}") for c in STAGING_EVENTS.column_names]


def test_nested_directories_are_read(spark, tmp_path):
    folder = write_lines(tmp_path, EVENT)
    row = read_events(spark, folder).first()
    assert (row.userId, row.page, row.length) == (39, "NextSong", Decimal(218))
    assert row.ts == datetime(2018, 11, 1, 20, 57, 10, 796000)
    assert row.artist is None


def test_single_file_is_read(spark, tmp_path):
    write_lines(tmp_path, EVENT)
    assert read_events(spark, str(tmp_path / "2018/11/events.json")).count() == 1


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_epoch_millis_ignores_session_zone(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    df = spark.createDataFrame([("1541105830796",), ("-1",), ("",), ("soon",)], "t string")
    values = [r[0] for r in df.select(epoch_millis(df.t)).collect()]
    assert values[:2] == [
        datetime(2018, 11, 1, 20, 57, 10, 796000),
        datetime(1969, 12, 31, 23, 59, 59, 999000),
    ]
    assert values[2:] == [None, None]


def test_user_id_as_text_number_blank_or_null(spark, tmp_path):
    records = [{"itemInSession": i, "userId": u} for i, u in enumerate(["39", "", 7, None])]
    rows = read_events(spark, write_lines(tmp_path, *records)).orderBy("itemInSession").collect()
    assert [r.userId for r in rows] == [39, None, 7, None]


def test_decimals_are_cut_not_rounded(spark, tmp_path):
    folder = write_lines(
        tmp_path,
        {"itemInSession": 0, "length": 218.93179, "registration": 1540919166796.0},
        {"itemInSession": 1, "length": -218.9, "registration": "1540919166796"},
    )
    rows = read_events(spark, folder).orderBy("itemInSession").collect()
    assert [r.length for r in rows] == [Decimal(218), Decimal(-218)]
    assert {r.registration for r in rows} == {Decimal(1540919166796)}
    df = spark.createDataFrame([("0.99999999999999999999",), (" -0.9999999999999999999 ",)], "t string")
    assert {r[0] for r in df.select(to_decimal(df.t, 18, 0)).collect()} == {Decimal(0)}
    df = spark.createDataFrame([("218.93179",)], "t string")
    assert df.select(to_decimal(df.t, 18, 0, truncate=False)).first()[0] == Decimal(219)


def test_song_fields_by_name(spark, tmp_path):
    folder = write_lines(
        tmp_path,
        {"song_id": "S1", "artist_latitude": 35.14968, "year": 2000, "extra": {"a": 1}},
        {"SONG_ID": "S2", "artist_longitude": -90.0489251, "duration": 152.92036},
        name="A/B/C/one.json",
    )
    rows = sorted(read_songs(spark, folder).collect(), key=lambda r: r.song_id or "")
    assert rows[0].song_id is None and rows[0].artist_longitude == Decimal("-90.048925")
    assert rows[0].duration == Decimal(152)
    assert rows[1].artist_latitude == Decimal("35.149680") and rows[1].title is None


def test_many_small_files(spark, tmp_path):
    for i in range(30):
        write_lines(tmp_path, {"song_id": f"S{i}"}, name=f"A/{i % 3}/{i}.json")
    assert read_songs(spark, str(tmp_path)).select("song_id").distinct().count() == 30
    chosen = [str(tmp_path / "A" / "0" / "0.json"), str(tmp_path / "A" / "1")]
    assert read_songs(spark, chosen).count() == 11


def test_json_names_are_case_sensitive(spark, tmp_path):
    folder = write_lines(tmp_path, {"userid": 5, "page": "Home"})
    assert read_events(spark, folder).first().userId is None


def test_path_map_document(spark, tmp_path):
    document = tmp_path / "map" / "paths.json"
    document.parent.mkdir()
    document.write_text(json.dumps({"jsonpaths": default_paths(STAGING_EVENTS)}, indent=2))
    paths = read_path_map(spark, str(document))
    folder = write_lines(tmp_path / "logs", EVENT)
    assert read_events(spark, folder, paths=paths).first().userId == 39


def test_paths_move_columns(spark, tmp_path):
    folder = write_lines(tmp_path, {"who": 8, "where": "Lyon"})
    row = read_events(spark, folder, paths=nested_paths(userId="$.who", location="$['where']")).first()
    assert (row.userId, row.location) == (8, "Lyon")


@pytest.mark.parametrize("mode", ["fail", "quarantine"])
def test_nested_paths(spark, tmp_path, mode):
    folder = write_lines(
        tmp_path,
        {"user": {"id": "39", "names": ["Ann", "Lee"]}, "length": 218.93179, "ts": 1541105830796},
        {"user": 5, "ts": None},
    )
    paths = nested_paths(userId="$.user.id", lastName="$.user.names[1]")
    rows = read_events(spark, folder, paths=paths, on_bad_record=mode, on_bad_value="null")
    rows = rows.orderBy("userId").collect()
    assert [(r.userId, r.lastName, r.length) for r in rows] == [
        (None, None, None),
        (39, "Lee", Decimal(218)),
    ]
    assert rows[1].ts == datetime(2018, 11, 1, 20, 57, 10, 796000)


def test_paths_that_differ_by_case(spark, tmp_path):
    folder = write_lines(tmp_path, {"userId": 1, "userid": 2})
    row = read_events(spark, folder, paths=nested_paths(status="$.userid")).first()
    assert (row.userId, row.status) == (1, 2)


def test_wrong_number_of_paths(spark, tmp_path):
    with pytest.raises(ValueError, match="18 columns"):
        read_events(spark, str(tmp_path), paths=["$.a"])


@pytest.mark.parametrize("paths", [None, nested_paths(userId="$.user.id")])
def test_bad_record_fails(spark, tmp_path, paths):
    folder = write_lines(tmp_path, EVENT, "{bad")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_events(spark, folder, paths=paths).collect()


@pytest.mark.parametrize("paths", [None, nested_paths(auth="$.deep.auth")])
def test_bad_record_quarantined(spark, tmp_path, paths):
    folder = write_lines(tmp_path, EVENT, "{bad", "", {"userId": 4})
    good, bad = split_bad_records(
        read_events(spark, folder, paths=paths, on_bad_record="quarantine")
    )
    assert sorted(r.userId for r in good.collect()) == [4, 39]
    assert "_corrupt_record" not in good.columns
    assert [r.record for r in bad.collect()] == ["{bad"]


# Lines that are not one whole JSON object.
NOT_A_RECORD = [
    "{bad",
    '{"userId": 1',
    '{"userId": 1} more',
    '{"userId": 1}{"userId": 2}',
    "5",
    '"text"',
    "null",
    "true",
]


@pytest.mark.parametrize("paths", [None, nested_paths(auth="$.deep.auth")])
def test_lines_that_are_no_record(spark, tmp_path, paths):
    folder = write_lines(tmp_path / "all", EVENT, *NOT_A_RECORD)
    rows = read_events(spark, folder, paths=paths, on_bad_record="quarantine")
    good, bad = split_bad_records(rows)
    assert [r.userId for r in good.collect()] == [39]
    assert sorted(r.record for r in bad.collect()) == sorted(NOT_A_RECORD)
    for i, line in enumerate(NOT_A_RECORD):
        folder = write_lines(tmp_path / str(i), EVENT, line)
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            read_events(spark, folder, paths=paths).collect()


def test_blanks_around_records(spark, tmp_path):
    folder = write_lines(tmp_path, '\ufeff{"userId": 1}', '\t {"userId": 2} \r', "\t", "")
    assert sorted(r.userId for r in read_events(spark, folder).collect()) == [1, 2]


@pytest.mark.parametrize("mode", ["fail", "quarantine"])
def test_list_of_records(spark, tmp_path, mode):
    folder = write_lines(tmp_path, '[{"song_id": "S1"}, {"song_id": "S2"}]')
    rows = read_songs(spark, folder, on_bad_record=mode).collect()
    assert sorted(r.song_id for r in rows) == ["S1", "S2"]


def test_record_that_is_a_list(spark, tmp_path):
    folder = write_lines(tmp_path, '["Ann", "Home", 7]')
    paths = nested_paths(artist="$[0]", page="$[1]", userId="$[2]")
    row = read_events(spark, folder, paths=paths).first()
    assert (row.artist, row.page, row.userId, row.song) == ("Ann", "Home", 7, None)


BY_PATH = nested_paths(auth="$.deep.auth")


# JSON of a number, and the user id, the length and the time that it gives; "bad"
# where it does not fit.
SPELLINGS = [
    ("39", 39, 39, 39),
    ('"39"', 39, 39, 39),
    ("39.0", 39, 39, 39),
    ('"39.0"', 39, 39, 39),
    ("3.9e1", 39, 39, 39),
    ("390E-1", 39, 39, 39),
    ('" 39 "', 39, 39, 39),
    ("-7", -7, -7, -7),
    ('""', None, None, None),
    ('"  "', None, None, None),
    ("null", None, None, None),
    ("39.5", "bad", 39, "bad"),
    ("39.0000000000000000000001", "bad", 39, "bad"),
    ("3000000000", "bad", 3000000000, 3000000000),
    ("1e30", "bad", "bad", "bad"),
    ("1e17", "bad", 10**17, "bad"),
    ('"abc"', "bad", "bad", "bad"),
    ("true", "bad", "bad", "bad"),
    ('{"a": 1}', "bad", "bad", "bad"),
    ('"NaN"', "bad", "bad", "bad"),
]


@pytest.mark.parametrize("paths", [None, BY_PATH])
def test_spellings_of_numbers(spark, tmp_path, paths):
    lines = [
        f'{{"itemInSession": {k}, "userId": {n}, "length": {n}, "ts": {n}, "artist": {n}}}'
        for k, (n, *_) in enumerate(SPELLINGS)
    ]
    folder = write_lines(tmp_path, *lines)
    rows = read_events(spark, folder, paths=paths, on_bad_value="reject").orderBy("itemInSession").collect()
    epoch = datetime(1970, 1, 1)
    for (spelled, *wanted), row in zip(SPELLINGS, rows, strict=True):
        bad = {b.column_name for b in row._bad_values}
        found = [
            "bad" if column in bad else value
            for column, value in (
                ("userId", row.userId),
                ("length", row.length),
                ("ts", row.ts and (row.ts - epoch) // timedelta(milliseconds=1)),
            )
        ]
        assert found == wanted, spelled
    other = read_events(spark, folder, paths=None if paths else BY_PATH, on_bad_value="reject")
    assert sorted(map(str, other.collect())) == sorted(map(str, rows))
    with pytest.raises(Exception, match="BAD_VALUE: staging_events"):
        read_events(spark, folder, paths=paths).collect()
    nulls = read_events(spark, folder, paths=paths, on_bad_value="null")
    assert nulls.filter("userId IS NULL").count() == sum(not isinstance(w, int) for _, w, _, _ in SPELLINGS)


def test_too_large_coordinates_are_bad(spark, tmp_path):
    folder = write_lines(tmp_path, {"song_id": "S", "artist_latitude": 1234.5})
    with pytest.raises(Exception, match="BAD_VALUE: staging_songs.artist_latitude: 1234.5"):
        read_songs(spark, folder).collect()
    good, bad = split_bad_values(read_songs(spark, folder, on_bad_value="reject"))
    assert good.count() == 0 and bad.collect() == [("artist_latitude", "1234.5")]


@pytest.mark.parametrize("paths", [None, BY_PATH])
@pytest.mark.parametrize("mode", ["fail", "quarantine"])
def test_no_rows_from_nothing(spark, tmp_path, paths, mode):
    folder = write_lines(tmp_path / "empty", "[]", " [ ] ")
    assert read_events(spark, folder, paths=paths, on_bad_record=mode).count() == 0
    lines = ["[null]", '{"userId": 1}, null', '{"userId": 1},{"userId": 2}', '[{"userId": 3}, null]', "[5]"]
    for k, line in enumerate(lines):
        folder = write_lines(tmp_path / str(k), line)
        rows = read_events(spark, folder, paths=paths, on_bad_record=mode)
        if mode == "fail":
            with pytest.raises(Exception, match="MALFORMED_RECORD"):
                rows.collect()
        else:
            good, bad = split_bad_records(rows)
            assert good.count() == 0 and [r.record for r in bad.collect()] == [line]


@pytest.mark.parametrize("paths", [None, BY_PATH])
def test_last_of_repeated_fields_counts(spark, tmp_path, paths):
    folder = write_lines(tmp_path, '{"userId": 1, "userId": 2}')
    assert read_events(spark, folder, paths=paths).first().userId == 2


def test_blank_passes_strict_load(spark, tmp_path):
    folder = write_lines(tmp_path, {"userId": "", "length": " ", "ts": ""})
    row = read_events(spark, folder, on_bad_value="fail").first()
    assert (row.userId, row.length, row.ts) == (None, None, None)


@pytest.mark.parametrize("mode", ["fail", "quarantine"])
def test_records_that_span_lines(spark, tmp_path, mode):
    folder = write_lines(tmp_path, json.dumps({"song_id": "S1", "year": 1999}, indent=2), name="a.json")
    rows = read_songs(spark, folder, multiline=True, on_bad_record=mode).collect()
    assert [(r.song_id, r.year) for r in rows] == [("S1", 1999)]


def test_nested_paths_share_their_field(spark, tmp_path):
    """One parse for all paths, without a walk of whole records."""
    record = {"user": {"id": "39", "names": ["Ann", "Lee"]}, "page": "NextSong", "rest": {"x": [1, 2]}}
    folder = write_lines(tmp_path, record, {"user": "nobody", "page": "Home"}, {"user": None})
    paths = nested_paths(userId="$.user.id", firstName="$.user.names[0]", lastName="$['user']['names'][1]")
    rows = read_events(spark, folder, paths=paths)
    found = {(r.userId, r.firstName, r.lastName, r.page) for r in rows.collect()}
    assert found == {(39, "Ann", "Lee", "NextSong"), (None, None, None, "Home"), (None, None, None, None)}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "parse_json" not in plan and "schema_of_variant" not in plan


def test_numbers_are_read_once(spark, tmp_path):
    """Each of the seven numbers of a record is read in one place of the plan."""
    rows = read_events(spark, write_lines(tmp_path, {"userId": 1}))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("as decimal(38,18))") == 7
