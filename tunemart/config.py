"""Settings of one load."""

from __future__ import annotations

import configparser
from dataclasses import dataclass


@dataclass(frozen=True)
class LoadConfig:
    """Where the data lies and how the load treats it.

    log_jsonpath   JSON document with one path per staging_events column; None = the
                   column names themselves, at the top level of each record
    buckets        buckets of the tables with a placement key; None = from the input size
    max_buckets    limit of that number, if the cluster needs one
    max_partitions limit of the shuffle partitions that the input size asks for
    multiline      records span lines (one record or one array of records per file)
    on_bad_record  "fail" | "quarantine": malformed JSON stops the load, or goes to a table
    on_bad_value   "fail" | "reject" | "null": text that does not fit its column's type stops
                   the load, or its record is left out and the value kept in
                   staging_bad_values, or it becomes NULL
    on_violation   "raise" | "reject": rows that break NOT NULL or a length limit
    dedup          one row per artist and per time instead of one per song and per event
    ordered_keys   number the plays in a reproducible order (costs one more shuffle)
    load_id        name of the load: a repeated one does only what is not on record yet
    """

    log_data: str
    song_data: str
    log_jsonpath: str | None = None
    database: str = "default"
    buckets: int | None = None
    max_buckets: int | None = None
    max_partitions: int | None = None
    multiline: bool = False
    on_bad_record: str = "fail"
    on_bad_value: str = "fail"
    on_violation: str = "raise"
    dedup: bool = False
    ordered_keys: bool = False
    load_id: str | None = None

    def __post_init__(self) -> None:
        for field, allowed in (
            ("on_bad_record", ("fail", "quarantine")),
            ("on_bad_value", ("fail", "reject", "null")),
            ("on_violation", ("raise", "reject")),
        ):
            if getattr(self, field) not in allowed:
                raise ValueError(f"{field} must be one of {allowed}")

    @classmethod
    def from_ini(cls, path: str, **overrides) -> LoadConfig:
        """Read the data paths from section [S3] of an INI file; values may be quoted."""
        parser = configparser.ConfigParser()
        with open(path, encoding="utf-8") as f:
            parser.read_file(f)
        paths = {key: value.strip().strip("'\"") for key, value in parser["S3"].items()}
        settings = {
            "log_data": paths["log_data"],
            "song_data": paths["song_data"],
            "log_jsonpath": paths.get("log_jsonpath"),
        }
        return cls(**{**settings, **overrides})
