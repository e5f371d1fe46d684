"""The seven warehouse tables as data: columns, constraints and placement keys."""

from __future__ import annotations

from dataclasses import dataclass

# The song-play key is declared INTEGER in the data model; it is kept as BIGINT because
# a dense key over more than 2**31 plays would not fit. Change it here to narrow it.
KEY_TYPE = "BIGINT"

# A bare DECIMAL means 18 digits, scale 0.
WHOLE = "DECIMAL(18,0)"


# A bucket holds plays of all times, sorted. Row groups of a sixteenth of the usual size cut it
# into that many more time ranges, each long enough for dictionaries and sequential reads.
ROW_GROUP_BYTES = 8 * 1024**2


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    not_null: bool = False

    @property
    def max_length(self) -> int | None:
        """Declared length of a CHAR/VARCHAR column, else None."""
        if self.type.startswith(("CHAR(", "VARCHAR(")):
            return int(self.type[self.type.index("(") + 1 : -1])
        return None

    @property
    def value_type(self) -> str:
        """Type of the column inside a DataFrame (length-limited text is plain STRING)."""
        return "STRING" if self.max_length is not None else self.type


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    dist: str | None = None
    sort: str | None = None
    identity: str | None = None
    row_group_bytes: int | None = None  # the sort key prunes row groups, so these are what a filter reads

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.not_null]

    @property
    def limited(self) -> dict[str, int]:
        return {c.name: c.max_length for c in self.columns if c.max_length is not None}

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name.lower() == name.lower())


def _columns(*specs: tuple) -> tuple[Column, ...]:
    return tuple(Column(*spec) for spec in specs)


# Names, types and keys of the tables.
STAGING_EVENTS = Table(
    "staging_events",
    _columns(
        ("artist", "STRING"),
        ("auth", "STRING"),
        ("firstName", "STRING"),
        ("gender", "CHAR(1)"),
        ("itemInSession", "INT"),
        ("lastName", "STRING"),
        ("length", WHOLE),
        ("level", "STRING"),
        ("location", "STRING"),
        ("method", "CHAR(6)"),
        ("page", "STRING"),
        ("registration", WHOLE),
        ("sessionId", "INT"),
        ("song", "STRING"),
        ("status", "INT"),
        ("ts", "TIMESTAMP_NTZ"),
        ("userAgent", "STRING"),
        ("userId", "INT"),
    ),
)

STAGING_SONGS = Table(
    "staging_songs",
    _columns(
        ("artist_id", "VARCHAR(18)"),
        ("artist_latitude", "DECIMAL(9,6)"),
        ("artist_location", "STRING"),
        ("artist_longitude", "DECIMAL(9,6)"),
        ("artist_name", "STRING"),
        ("duration", WHOLE),
        ("num_songs", "INT"),
        ("song_id", "VARCHAR(18)", True),
        ("title", "STRING"),
        ("year", "INT"),
    ),
)

FACT_SONGPLAY = Table(
    "factSongPlay",
    _columns(
        ("songplay_id", KEY_TYPE),
        ("start_time", "TIMESTAMP_NTZ", True),
        ("user_id", "INT", True),
        ("level", "STRING"),
        ("song_id", "VARCHAR(18)", True),
        ("artist_id", "VARCHAR(18)", True),
        ("session_id", "INT", True),
        ("location", "STRING"),
        ("user_agent", "STRING"),
    ),
    dist="song_id",
    sort="start_time",
    identity="songplay_id",
    row_group_bytes=ROW_GROUP_BYTES,
)

DIM_SONG = Table(
    "dimSong",
    _columns(
        ("song_id", "VARCHAR(18)", True),
        ("title", "STRING", True),
        ("artist_id", "VARCHAR(18)", True),
        ("year", "INT", True),
        ("duration", WHOLE, True),
    ),
    dist="song_id",
    sort="song_id",
)

DIM_ARTIST = Table(
    "dimArtist",
    _columns(
        ("artist_id", "VARCHAR(18)", True),
        ("artist_name", "STRING", True),
        ("artist_location", "STRING"),
        ("artist_latitude", "DECIMAL(9,6)"),
        ("artist_longitude", "DECIMAL(9,6)"),
    ),
    dist="artist_id",
    sort="artist_id",
)

DIM_USER = Table(
    "dimUser",
    _columns(
        ("user_id", "INT", True),
        ("first_name", "STRING", True),
        ("last_name", "STRING", True),
        ("gender", "CHAR(1)", True),
        ("level", "STRING", True),
    ),
    dist="user_id",
    sort="user_id",
)

DIM_TIME = Table(
    "dimTime",
    _columns(
        ("start_time", "TIMESTAMP_NTZ", True),
        ("hour", "INT"),
        ("day", "INT"),
        ("week", "INT"),
        ("month", "INT"),
        ("year", "INT"),
        ("weekday", "INT"),
    ),
    sort="start_time",
)

STAGING = (STAGING_EVENTS, STAGING_SONGS)
STAR = (FACT_SONGPLAY, DIM_USER, DIM_SONG, DIM_ARTIST, DIM_TIME)
TABLES = {t.name: t for t in STAGING + STAR}
