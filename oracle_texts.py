"""SQL that must give the same rows as the registered queries, over the same tables."""

from __future__ import annotations

# The adapter: test tables to the two staging tables.
ADAPTER = """
WITH k AS (SELECT *, p_partkey - (CASE WHEN p_partkey % 20 = 19 THEN 1 ELSE 0 END) AS tk, p_partkey - (CASE WHEN p_partkey % 10 = 7 THEN 1 ELSE 0 END) AS ik FROM part),
staging_songs AS (SELECT concat('SO', lpad(cast(ik AS string), 16, '0')) AS song_id, concat(CASE WHEN p_partkey % 10 IN (6,7) THEN p_name ELSE 'Song' END, ' ', cast(tk AS string)) AS title,
 concat('AR', lpad(cast(tk % 97 AS string), 16, '0')) AS artist_id, concat('Artist ', cast(tk % 97 AS string)) AS artist_name,
 CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END AS artist_location,
 CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE cast(p_size + 0.25 AS decimal(9,6)) END AS artist_latitude,
 CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE cast(-p_size - 0.5 AS decimal(9,6)) END AS artist_longitude,
 cast(floor(p_retailprice) AS decimal(18,0)) AS duration, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 1960 + p_size END AS year, 1 AS num_songs FROM k),
ek AS (SELECT e.*, c.c_mktsegment, c.c_name, n.n_name, e.event_id % n_songs AS sk, CASE WHEN e.event_type IN ('view','purchase') THEN 1 ELSE 0 END AS is_play
 FROM events e JOIN customer c ON c.c_custkey = e.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey CROSS JOIN (SELECT cast(floor(count(*) * 1.1) AS bigint) AS n_songs FROM part) z),
ev1 AS (SELECT event_id, CASE WHEN is_play = 1 AND event_id % 41 <> 0 THEN concat('Artist ', cast(sk % 97 AS string)) END AS artist, CASE WHEN event_type = 'error' THEN 'Logged Out' ELSE 'Logged In' END AS auth,
 c_mktsegment AS firstName, c_name AS lastName, CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender, cast(event_id % 20 AS int) AS itemInSession,
 cast(floor(value) AS decimal(18,0)) AS length, CASE WHEN event_id % 3 = 0 THEN 'paid' ELSE 'free' END AS level, n_name AS location,
 CASE WHEN is_play = 1 THEN 'NextSong' WHEN event_type = 'click' THEN 'Home' ELSE 'Login' END AS page, cast(floor(event_id / 20) AS int) AS sessionId,
 CASE WHEN is_play = 1 THEN concat('Song ', cast(sk AS string)) END AS song, CASE WHEN is_play = 0 AND event_id % 97 = 0 THEN NULL ELSE ts END AS ts, props AS userAgent,
 CASE WHEN event_type = 'error' THEN NULL ELSE cast(user_id AS int) END AS userId FROM ek),
staging_events AS (SELECT * FROM ev1 UNION ALL SELECT * FROM ev1 WHERE event_id % 50 = 0)
"""

# The columns of the tables, here and below.
PLAY_COLUMNS = """
e.ts AS start_time, e.userId AS user_id, e.level AS level, s.song_id AS song_id,
s.artist_id AS artist_id, e.sessionId AS session_id, e.location AS location, e.userAgent AS user_agent
"""
PLAYS_FROM = """
FROM staging_events e JOIN staging_songs s ON e.song = s.title AND e.artist = s.artist_name
WHERE e.page = 'NextSong'
"""
FACT = f"SELECT DISTINCT {PLAY_COLUMNS} {PLAYS_FROM}"

# The kept row of a key is the first in these orders.
USER_RANK = """
row_number() OVER (PARTITION BY userId ORDER BY ts DESC NULLS LAST, itemInSession DESC NULLS LAST,
 level NULLS LAST, firstName NULLS LAST, lastName NULLS LAST, gender NULLS LAST)
"""
SONG_RANK = """
row_number() OVER (PARTITION BY song_id ORDER BY title NULLS LAST, artist_id NULLS LAST,
 year NULLS LAST, duration NULLS LAST)
"""
ARTIST_RANK = """
row_number() OVER (PARTITION BY artist_id ORDER BY artist_name NULLS LAST, artist_location NULLS LAST,
 artist_latitude NULLS LAST, artist_longitude NULLS LAST)
"""

DIM_USER = f"""
SELECT userId AS user_id, firstName AS first_name, lastName AS last_name, gender, level
FROM (SELECT *, {USER_RANK} AS r FROM staging_events) WHERE r = 1 AND userId IS NOT NULL
"""
DIM_SONG = f"""
SELECT song_id, title, artist_id, year, duration
FROM (SELECT *, {SONG_RANK} AS r FROM staging_songs) WHERE r = 1
"""
ARTIST_COLUMNS = "artist_id, artist_name, artist_location, artist_latitude, artist_longitude"
DIM_ARTIST = f"SELECT {ARTIST_COLUMNS} FROM staging_songs"
TIME_PARTS = """
cast(extract(hour FROM ts) AS int) AS hour, cast(extract(day FROM ts) AS int) AS day,
cast(extract(week FROM ts) AS int) AS week, cast(extract(month FROM ts) AS int) AS month,
cast(extract(year FROM ts) AS int) AS year, cast(extract(dayofweek FROM ts) AS int) AS weekday
"""
DIM_TIME = f"SELECT ts AS start_time, {TIME_PARTS} FROM staging_events WHERE ts IS NOT NULL"


def _null_report(table: str, source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name,"
        f" count(*) FILTER (WHERE {value} IS NULL) AS violations FROM {source}"
        for column, value in columns.items()
    )


def _length_report(table: str, source: str, columns: dict[str, tuple[str, int]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name,"
        f" count(*) FILTER (WHERE length({value}) > {limit}) AS violations FROM {source}"
        for column, (value, limit) in columns.items()
    )


def _gaps(source: str, gaps: dict[str, str]) -> str:
    """The rows of `source` without some values."""
    columns = ", ".join(f"CASE WHEN NOT coalesce({gap}, false) THEN {c} END AS {c}" for c, gap in gaps.items())
    return f"(SELECT * REPLACE ({columns}) FROM {source})"


def _longer(source: str, extra: dict[str, str]) -> str:
    """The rows of `source` with some texts lengthened."""
    columns = ", ".join(
        f"CASE WHEN {on} THEN {c} || '-X' ELSE {c} END AS {c}" for c, on in extra.items()
    )
    return f"(SELECT * REPLACE ({columns}) FROM {source})"


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


def _contents(times: int, time: str = "start_time") -> str:
    """What the star tables hold after they were filled so many times; `time` is the time's key."""
    parts = [
        ("factSongPlay", FACT, None, "session_id"),
        ("dimUser", DIM_USER, "user_id", "length(last_name)"),
        ("dimSong", DIM_SONG, "song_id", "year"),
        ("dimArtist", DIM_ARTIST, "artist_id", "length(artist_name)"),
        ("dimTime", DIM_TIME, time, "hour * 100 + weekday"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {times} * count(*) AS n_rows,"
        f" {f'count(DISTINCT {key})' if key else f'{times} * count(*)'} AS n_keys,"
        f" cast({times} * sum({number}) AS bigint) AS content,"
        f" cast({'NULL' if key else '0'} AS bigint) AS first_key,"
        f" cast({'NULL' if key else f'{times} * count(*) - 1'} AS bigint) AS last_key FROM ({body})"
        for name, body, key, number in parts
    )


def oracle_sql() -> dict[str, str]:
    gapped_songs, gapped_events = _gaps("staging_songs", SONG_GAPS), _gaps("staging_events", EVENT_GAPS)
    candidate_plays = f"""
(SELECT e.*, s.song_id, s.artist_id FROM {gapped_events} e LEFT JOIN {gapped_songs} s
 ON e.song = s.title AND e.artist = s.artist_name WHERE e.page = 'NextSong')
"""
    long_songs = _longer("staging_songs", {"song_id": "artist_location IS NULL", "artist_id": "year = 0"})
    long_events = _longer(
        "(SELECT *, CASE WHEN page = 'Home' THEN 'OPTIONS' ELSE 'PUT' END AS method FROM staging_events)",
        {"gender": "level = 'paid'"},
    )
    long_plays = f"""
(SELECT s.song_id, s.artist_id FROM staging_events e JOIN {long_songs} s
 ON e.song = s.title AND e.artist = s.artist_name WHERE e.page = 'NextSong')
"""
    loaded_events = """
SELECT artist, auth, firstName, gender, itemInSession, lastName, length, level, location,
 'PUT' AS method, page, cast(1540919166796 AS decimal(18,0)) AS registration, sessionId, song,
 cast(200 AS int) AS status, date_trunc('milliseconds', ts) AS ts, userAgent, userId
FROM staging_events
"""
    steps = [("loaded", 1), ("truncated", 0), ("reloaded", 1), ("refreshed", 1)]
    bodies = {
        "fact_songplay": FACT,
        "fact_songplay_keyed": f"""
SELECT row_number() OVER (ORDER BY start_time NULLS LAST, user_id NULLS LAST, session_id NULLS LAST,
 song_id NULLS LAST, artist_id NULLS LAST, level NULLS LAST, location NULLS LAST,
 user_agent NULLS LAST) - 1 AS songplay_id, * FROM ({FACT})
""",
        "fact_join_no_distinct": f"SELECT {PLAY_COLUMNS} {PLAYS_FROM}",
        "dim_user": DIM_USER,
        "dim_song": DIM_SONG,
        "dim_song_ranked": f"""
SELECT song_id, title, artist_id, year, duration, cast({SONG_RANK} AS bigint) AS song_id_ranked
FROM staging_songs
""",
        "dim_artist": DIM_ARTIST,
        "dim_artist_dedup": f"""
SELECT {ARTIST_COLUMNS} FROM (SELECT *, {ARTIST_RANK} AS r FROM staging_songs) WHERE r = 1
""",
        "dim_time": DIM_TIME,
        "dim_time_dedup": f"SELECT DISTINCT * FROM ({DIM_TIME})",
        "songs_of_year": """
SELECT song_id, title, artist_id, year, duration FROM staging_songs WHERE year = 2000
""",
        "songs_of_year_all_columns": "SELECT * FROM staging_songs WHERE year = 2009",
        "song_duplicate_audit": f"""
SELECT song_id, count(*) AS count FROM ({DIM_SONG}) GROUP BY song_id ORDER BY count, song_id
""",
        "staging_song_duplicate_audit": """
SELECT song_id, count(*) AS count FROM staging_songs GROUP BY song_id ORDER BY count, song_id
""",
        "load_events_jsonpaths": loaded_events,
        "load_events_nested_paths": loaded_events,
        "load_events_number_spellings": """
SELECT userId, date_trunc('milliseconds', ts) AS ts, sessionId FROM staging_events
""",
        "load_bad_values": """
SELECT 'userId' AS column_name, count(userId) AS n_values, count(DISTINCT userId) AS n_different
FROM staging_events WHERE level = 'paid' AND userId > 2
UNION ALL SELECT 'itemInSession', count(itemInSession), count(DISTINCT itemInSession)
FROM staging_events WHERE level = 'paid'
UNION ALL SELECT 'length', count(*), 1 FROM staging_events WHERE auth = 'Logged Out' HAVING count(*) > 0
UNION ALL SELECT 'ts', count(*), 1 FROM staging_events WHERE page = 'Home' HAVING count(*) > 0
""",
        "load_events_quarantine": """
SELECT page, count(*) AS n_rows, cast(sum(sessionId) AS bigint) AS sessions FROM staging_events GROUP BY page
UNION ALL SELECT 'bad records', count(*), NULL FROM staging_events WHERE page = 'NextSong'
""",
        "load_songs_auto": """
SELECT artist_id, artist_latitude, artist_location, artist_longitude, artist_name, duration,
 num_songs, song_id, title, year FROM staging_songs
""",
        "not_null_violations": " UNION ALL ".join(
            [
                _null_report(
                    "factSongPlay",
                    candidate_plays,
                    {
                        "start_time": "ts",
                        "user_id": "userId",
                        "song_id": "song_id",
                        "artist_id": "artist_id",
                        "session_id": "sessionId",
                    },
                ),
                _null_report(
                    "dimSong",
                    gapped_songs,
                    {c: c for c in ("song_id", "title", "artist_id", "year", "duration")},
                ),
                _null_report(
                    "dimArtist",
                    gapped_songs,
                    {"artist_id": "artist_id", "artist_name": "artist_name"},
                ),
                _null_report(
                    "dimUser",
                    gapped_events,
                    {
                        "user_id": "userId",
                        "first_name": "firstName",
                        "last_name": "lastName",
                        "gender": "gender",
                        "level": "level",
                    },
                ),
                _null_report("dimTime", gapped_events, {"start_time": "ts"}),
                _null_report("staging_songs", gapped_songs, {"song_id": "song_id"}),
            ]
        ),
        "length_violations": " UNION ALL ".join(
            [
                _length_report("staging_events", long_events, {"gender": ("gender", 1), "method": ("method", 6)}),
                *[
                    _length_report(name, source, {c: (c, 18) for c in columns})
                    for name, source, columns in (
                        ("staging_songs", long_songs, ("song_id", "artist_id")),
                        ("factSongPlay", long_plays, ("song_id", "artist_id")),
                        ("dimSong", long_songs, ("song_id", "artist_id")),
                        ("dimArtist", long_songs, ("artist_id",)),
                    )
                ],
                _length_report("dimUser", long_events, {"gender": ("gender", 1)}),
            ]
        ),
        "append_twice": _contents(2),
        "pipeline_run": _contents(1, "date_trunc('milliseconds', start_time)"),
        "truncate_reload": " UNION ALL ".join(
            f"SELECT '{step}' AS step, table_name, {n} * n_rows AS n_rows,"
            f" {'content' if n else 'cast(NULL AS bigint)'} AS content FROM ({_contents(1)})"
            for step, n in steps
        ),
        "load_retry": _contents(1, "date_trunc('milliseconds', start_time)"),
        "refresh_failure": _contents(1, "date_trunc('milliseconds', start_time)"),
        "load_verdicts": """
SELECT v.verdict, count(e.verdict) AS n_records, v.times * count(e.verdict) AS n_rows
FROM (VALUES ('good', 1), ('bad_record', 1), ('bad_value', 2), ('violation', 1)) v(verdict, times)
LEFT JOIN (
 SELECT CASE WHEN auth = 'Logged Out' THEN 'bad_value' WHEN page = 'Home' THEN 'violation' ELSE 'good' END
  AS verdict FROM staging_events
 UNION ALL SELECT 'bad_record' FROM staging_events WHERE page = 'NextSong'
) e ON e.verdict = v.verdict GROUP BY v.verdict, v.times
""",
        "concurrent_appends": f"SELECT * FROM ({_contents(4)}) WHERE table_name = 'factSongPlay'",
        "bucketed_star_join": f"""
SELECT f.start_time, f.user_id, f.session_id, f.song_id, f.artist_id, d.title, d.year, d.duration
FROM ({FACT}) f JOIN ({DIM_SONG}) d ON f.song_id = d.song_id
""",
        "plays_of_a_week": f"""
SELECT f.song_id, d.title, count(*) AS plays, count(DISTINCT f.user_id) AS users
FROM ({FACT}) f JOIN ({DIM_SONG}) d ON f.song_id = d.song_id
WHERE f.start_time >= TIMESTAMP '2024-01-08' AND f.start_time < TIMESTAMP '2024-01-15'
GROUP BY f.song_id, d.title
""",
        "star_adhoc": f"""
SELECT a.artist_id, a.artist_name, count(*) AS plays
FROM ({FACT}) f JOIN (SELECT DISTINCT artist_id, artist_name FROM ({DIM_ARTIST})) a
 ON f.artist_id = a.artist_id
GROUP BY a.artist_id, a.artist_name ORDER BY plays DESC, a.artist_id LIMIT 10
""",
    }
    return {key: ADAPTER + body for key, body in bodies.items()}
