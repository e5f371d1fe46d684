"""From JSON files to the filled star schema."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemart.config import LoadConfig
from tunemart.plans import versions
from tunemart.plans.dims import (
    dim_artist,
    dim_artist_dedup,
    dim_song,
    dim_time,
    dim_time_dedup,
    dim_user,
)
from tunemart.plans.fact import song_plays
from tunemart.plans.loads import Load
from tunemart.plans.tables import (
    add_to_load,
    append,
    column_list,
    create_tables,
    drop_tables,
    full_name,
    reject_columns,
    write_part,
)
from tunemart.schemas import STAGING_EVENTS, STAGING_SONGS, Table
from tunemart.session import bucket_count_for, input_bytes, partitions_for, shuffle_partitions
from tunemart.sources.json_records import (
    read_events,
    read_path_map,
    read_songs,
    verdicts,
)


@dataclass(frozen=True)
class Size:
    """Shuffle partitions and buckets of a load."""

    partitions: int
    buckets: int


def size_of(spark: SparkSession, cfg: LoadConfig) -> Size:
    """What both inputs of a load ask for; the same for each step of it."""
    nbytes = input_bytes(spark, cfg.log_data, cfg.song_data)
    buckets = cfg.buckets or bucket_count_for(nbytes, cfg.max_buckets)
    return Size(partitions_for(nbytes, cfg.max_partitions), buckets)


def _parts(cfg: LoadConfig, table: Table) -> dict[str, tuple[str, str]]:
    """Table and its columns for each verdict that a record may get."""
    found = {"good": (table.name, column_list(table))}
    if cfg.on_bad_record == "quarantine":
        found["bad_record"] = ("staging_bad_records", "table_name STRING, record STRING")
    if cfg.on_bad_value == "reject":
        found["bad_value"] = ("staging_bad_values", "table_name STRING, column_name STRING, value STRING")
    if cfg.on_violation == "reject":
        found["violation"] = (f"{table.name}_rejects", reject_columns(table))
    return found


def _stage(spark: SparkSession, load: Load, cfg: LoadConfig, table: Table, rows: DataFrame) -> None:
    """Parse and write one input once, parted by verdict; the parts become visible as they are."""
    folder, parts = f"{load.folder}/{table.name}", _parts(cfg, table)
    if len(parts) == 1:
        write_part(rows, table, cfg.database, folder)
        load.add(table.name, table.name, column_list(table))
        load.count(table.name, "good", spark.read.schema(rows.schema).parquet(folder).count())
        return
    marked = verdicts(rows, table, reject="violation" in parts)
    marked.write.partitionBy("verdict").parquet(folder)
    records = spark.read.schema("nth INT, verdict STRING").parquet(folder).filter("nth = 0")
    counts = dict(records.groupBy("verdict").count().collect())  # a row for each verdict
    for verdict, (target, columns) in parts.items():
        load.add(f"{table.name}/verdict={verdict}", target, columns)
        load.count(table.name, verdict, counts.get(verdict, 0))


def stage_inputs(spark: SparkSession, load: Load, cfg: LoadConfig) -> None:
    """Parse and write both inputs into a load."""
    common = {
        "on_bad_record": cfg.on_bad_record,
        "on_bad_value": cfg.on_bad_value,
        "multiline": cfg.multiline,
    }
    paths = read_path_map(spark, cfg.log_jsonpath) if cfg.log_jsonpath else None
    _stage(spark, load, cfg, STAGING_EVENTS, read_events(spark, cfg.log_data, paths=paths, **common))
    _stage(spark, load, cfg, STAGING_SONGS, read_songs(spark, cfg.song_data, **common))


def load_staging(spark: SparkSession, cfg: LoadConfig) -> tuple[DataFrame, DataFrame]:
    """Append both data sets to the staging tables and return these.

    Rows and what is set aside of both become visible by one marker. With `cfg.load_id` a load
    that is on record already does nothing.
    """
    load = Load(spark, cfg.database, cfg.load_id and f"{cfg.load_id}.staging")
    if load.begin():
        stage_inputs(spark, load, cfg)
        load.commit()
    return staged(spark, cfg.database)


def staged(spark: SparkSession, database: str = "default") -> tuple[DataFrame, DataFrame]:
    """The two staging tables (events, songs)."""
    return (
        spark.table(full_name(STAGING_EVENTS, database)),
        spark.table(full_name(STAGING_SONGS, database)),
    )


def build_star(events: DataFrame, songs: DataFrame, dedup: bool = False) -> dict[str, DataFrame]:
    """The five star tables by name; the fact gets its key when it is appended.

    Artists come once per song and times once per event; `dedup` keeps one of each.
    """
    return {
        "dimArtist": dim_artist_dedup(songs) if dedup else dim_artist(songs),
        "dimSong": dim_song(songs),
        "dimTime": dim_time_dedup(events) if dedup else dim_time(events),
        "dimUser": dim_user(events),
        "factSongPlay": song_plays(events, songs),
    }


def insert_tables(
    spark: SparkSession,
    database: str = "default",
    on_violation: str = "raise",
    ordered_keys: bool = False,
    dedup: bool = False,
    load_id: str | None = None,
) -> None:
    """Append the star tables from the staging tables.

    The five loads do not depend on each other, so they are submitted together and share
    the cluster. Errors are raised, all of them, once all loads have ended. With a `load_id`
    the five become visible by one marker, or not at all if one fails, and a load that is on
    record already does nothing.
    """
    load = Load(spark, database, load_id) if load_id is not None else None
    if load is not None and not load.begin():
        return

    def fill(name: str, rows: DataFrame) -> None:
        if load is None:
            append(rows, name, database, on_violation, ordered_keys)
        else:
            add_to_load(load, rows, name, on_violation, ordered_keys)

    star = build_star(*staged(spark, database), dedup)
    with ThreadPoolExecutor(max_workers=len(star)) as pool:
        loads = [pool.submit(fill, name, rows) for name, rows in star.items()]
    errors = [e for e in (done.exception() for done in loads) if e is not None]
    if len(errors) > 1:
        raise ExceptionGroup("loads of several tables failed", errors)
    if errors:
        raise errors[0]
    if load is not None:
        load.commit()


def create_sized_tables(spark: SparkSession, cfg: LoadConfig) -> None:
    """Drop and create the tables for the input of `cfg`."""
    drop_tables(spark, cfg.database)
    create_tables(spark, cfg.database, size_of(spark, cfg).buckets)


def etl(spark: SparkSession, cfg: LoadConfig, size: Size | None = None) -> None:
    """Load the staging tables and fill the star tables, which have to be there.

    With `cfg.load_id` a load that failed or was cut off can be repeated: what is on record is
    skipped, the rest is done.
    """
    with shuffle_partitions(spark, (size or size_of(spark, cfg)).partitions):
        load_staging(spark, cfg)
        star_id = cfg.load_id and f"{cfg.load_id}.star"
        insert_tables(spark, cfg.database, cfg.on_violation, cfg.ordered_keys, cfg.dedup, star_id)


def run(spark: SparkSession, cfg: LoadConfig) -> None:
    """Full refresh: create, load and fill new tables beside the old ones, then switch to them.

    If anything fails, the tables are left as they were; missing ones are created empty.
    """
    size = size_of(spark, cfg)
    create_tables(spark, cfg.database, size.buckets)
    with versions.new_version(spark, cfg.database) as beside:
        create_tables(spark, beside, size.buckets)
        etl(spark, replace(cfg, database=beside), size)
