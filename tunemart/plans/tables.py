"""Life cycle and layout of the catalog tables."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemart import scratch, shared_files
from tunemart.operators.constraints import enforce_not_null, with_reason
from tunemart.operators.keys import number_rows
from tunemart.plans import versions
from tunemart.plans.fact import PLAY_ORDER
from tunemart.plans.loads import READ_FOLDERS, Load, forget_keys, home, reserved_keys
from tunemart.schemas import DIM_SONG, FACT_SONGPLAY, STAGING, STAR, TABLES, Table


def full_name(table: Table, database: str) -> str:
    return f"`{database}`.`{table.name}`"


def reject_name(table: Table, database: str) -> str:
    return f"`{database}`.`{table.name}_rejects`"


def bad_values_name(database: str) -> str:
    return f"`{database}`.`staging_bad_values`"


def bad_records_name(database: str) -> str:
    return f"`{database}`.`staging_bad_records`"


def column_list(table: Table) -> str:
    return ", ".join(f"`{c.name}` {c.type}{' NOT NULL' if c.not_null else ''}" for c in table.columns)


def reject_columns(table: Table) -> str:
    kept = [c for c in table.columns if c.name != table.identity]
    return ", ".join(f"`{c.name}` {c.value_type}" for c in kept) + ", reason STRING"


def create_statement(table: Table, name: str, buckets: int | None) -> str:
    """DDL of one table: placement key = buckets, sort key = order inside a bucket.

    A bucket is cut into time ranges (or ranges of whatever the sort key is) by its row groups.
    """
    layout, options = "", READ_FOLDERS
    if table.row_group_bytes:
        options = f"{READ_FOLDERS.removesuffix(')')}, `parquet.block.size` '{table.row_group_bytes}')"
    if table.dist and buckets:
        layout = f" CLUSTERED BY (`{table.dist}`) SORTED BY (`{table.sort}`) INTO {buckets} BUCKETS"
    return f"CREATE TABLE IF NOT EXISTS {name} ({column_list(table)}) USING parquet {options}{layout}"


def create_tables(
    spark: SparkSession, database: str = "default", buckets: int | None = None
) -> None:
    """Create the seven tables where missing; an existing table stays as it is.

    Tables with a placement key get `buckets` buckets, a number that should follow the input
    (`tunemart.session.bucket_count_for`). Without one they are plain files, which any number
    of tasks can write and read.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for table in STAGING + STAR:
        spark.sql(create_statement(table, full_name(table, database), buckets))


def drop_tables(spark: SparkSession, database: str = "default") -> None:
    """Drop the seven tables, what earlier loads set aside, and the record of loads, where present."""
    for table in STAGING + STAR:
        spark.sql(f"DROP TABLE IF EXISTS {full_name(table, database)}")
        spark.sql(f"DROP TABLE IF EXISTS {reject_name(table, database)}")
    spark.sql(f"DROP TABLE IF EXISTS {bad_records_name(database)}")
    spark.sql(f"DROP TABLE IF EXISTS {bad_values_name(database)}")
    if spark.catalog.databaseExists(database):
        shared_files.delete(spark, home(spark, database))
        versions.forget(spark, database)


def truncate_table(spark: SparkSession, name: str, database: str = "default") -> None:
    """Remove all rows, keep the table. Loads stay on record, so that a repeated one is skipped."""
    spark.sql(f"TRUNCATE TABLE {full_name(TABLES[name], database)}")
    if TABLES[name].identity:
        forget_keys(spark, database)


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r.col_name: r.data_type for r in rows}


def next_key(spark: SparkSession, database: str = "default") -> int:
    """The first unused song-play key."""
    last = spark.table(full_name(FACT_SONGPLAY, database)).agg(F.max("songplay_id")).first()[0]
    return 0 if last is None else last + 1


def _aligned(df: DataFrame, table: Table) -> DataFrame:
    """Columns by name in table order; an omitted one is NULL."""
    present = {c.lower() for c in df.columns}
    return df.select(
        *[
            F.col(c.name) if c.name.lower() in present else F.lit(None).cast(c.value_type).alias(c.name)
            for c in table.columns
        ]
    )


def _placed(df: DataFrame, table: Table, buckets: str | None) -> DataFrame:
    """Rows of a bucket together, rows of an unbucketed table sorted within each file.

    The rebalance lets adaptive execution split the bucket of a very frequent key over
    several tasks and files, and merge small buckets into one task. A table that only has a
    sort key is dealt out by ranges of it, so that files do not overlap and a filter on the
    key skips files.
    """
    if table.dist:
        spread = df.hint("rebalance", *([int(buckets)] if buckets else []), table.dist)
        return spread if buckets else spread.sortWithinPartitions(table.sort)
    if table.sort:
        return df.repartitionByRange(table.sort).sortWithinPartitions(table.sort)
    return df


def _with_key(df: DataFrame, table: Table, ordered: bool, start) -> tuple[DataFrame, DataFrame | None]:
    """Rows with the identity column, and those that break a constraint if `df` has reasons.

    One written result serves both: it holds every row with its place and its reason.
    """
    order = PLAY_ORDER if ordered else None
    if "reason" not in df.columns:
        return number_rows(df, table.identity, order, start), None
    marked = df.withColumn("_good", F.col("reason") == "")
    numbered = number_rows(marked, table.identity, order, start, where="_good")
    return numbered.filter("_good").drop("_good", "reason"), numbered.filter("NOT _good").drop("_good")


def _rows_and_rejects(
    df: DataFrame, table: Table, on_violation: str, ordered: bool, start
) -> tuple[DataFrame, DataFrame | None]:
    """What is to be written into the table and beside it; written to scratch once where needed."""
    rejects, reject = None, on_violation == "reject"
    marked = with_reason(df, table) if reject else df
    if table.identity and table.identity not in df.columns:
        rows, rejects = _with_key(marked, table, ordered, start)
    elif reject:
        marked = scratch.materialize(marked, "candidates")
        rows, rejects = marked.filter("reason = ''").drop("reason"), marked.filter("reason <> ''")
    else:
        rows = df
    return enforce_not_null(_aligned(rows, table), table), rejects


def write_part(df: DataFrame, table: Table, database: str, folder: str) -> None:
    """Write rows into a folder in the layout of a table, as an insert into it would."""
    spark = df.sparkSession
    buckets = _details(spark, full_name(table, database)).get("Num Buckets")
    trial = f"`{database}`.`load_{uuid.uuid4().hex}`"
    spark.sql(f"{create_statement(table, trial, buckets and int(buckets))} LOCATION '{folder}'")
    try:
        _placed(df, table, buckets).write.insertInto(trial)
    finally:
        spark.sql(f"DROP TABLE {trial}")  # its files stay


def add_to_load(
    load: Load, df: DataFrame, name: str, on_violation: str = "raise", ordered_keys: bool = False
) -> None:
    """Write rows of a table, and its rejects, into a load, which makes them visible later."""
    spark, database, table = df.sparkSession, load.database, TABLES[name]
    owner = f"{load.load_id}.{name}" if load.named else None
    last_key = lambda: next_key(spark, database)
    with scratch.scope(), reserved_keys(spark, database, last_key, owner) as start:
        rows, rejects = _rows_and_rejects(df, table, on_violation, ordered_keys, start)
        write_part(rows, table, database, f"{load.folder}/{name}")
        if rejects is not None:
            target = f"{load.folder}/{name}_rejects"
            known = [c.name for c in table.columns if c.name != table.identity]
            rejects.select(*[c for c in rejects.columns if c in {*known, "reason"}]).write.parquet(target)
    load.add(name, name, column_list(table))
    if rejects is not None:
        load.add(f"{name}_rejects", f"{name}_rejects", reject_columns(table))


def append(
    df: DataFrame,
    name: str,
    database: str = "default",
    on_violation: str = "raise",
    ordered_keys: bool = False,
    load_id: str | None = None,
) -> None:
    """Append rows by column name, in one commit: a failing row leaves none of them behind.

    The identity column is assigned here if `df` does not bring it. A broken NOT NULL or
    length limit raises; with "reject" such rows go to `<table>_rejects` instead. Rows and
    rejects count from one marker on, and an append with a `load_id` that is on record already
    does nothing (see `tunemart.plans.loads`). Several appends may run at the same time.
    """
    load = Load(df.sparkSession, database, load_id)
    if load.begin():
        add_to_load(load, df, name, on_violation, ordered_keys)
        load.commit()


def _read_buckets(spark: SparkSession, table: Table, database: str) -> DataFrame:
    return spark.table(full_name(table, database))


def _read_files(spark: SparkSession, table: Table, database: str) -> DataFrame:
    """The same rows without the bucketing, so that one bucket may be read by many tasks."""
    rows = _read_buckets(spark, table, database)
    return spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(
        _details(spark, full_name(table, database))["Location"]
    )


def plays_between(
    spark: SparkSession, start: datetime, end: datetime, database: str = "default", co_located: bool = True
) -> DataFrame:
    """Songs played from `start` up to, not including, `end`: title, plays and different users.

    Both keys of the fact's layout serve: row groups outside the range are skipped, and within a
    bucket the songs are joined and counted without an exchange of plays.
    """
    during = (F.col("start_time") >= F.lit(start)) & (F.col("start_time") < F.lit(end))
    plays = join_song_dimension(spark, database, co_located, "merge" if co_located else None).filter(during)
    return plays.groupBy("song_id", "title").agg(
        F.count("*").alias("plays"), F.count_distinct("user_id").alias("users")
    )


def join_song_dimension(
    spark: SparkSession, database: str = "default", co_located: bool = False, hint: str | None = None
) -> DataFrame:
    """Plays with title, year and duration of their song.

    By default both tables are read as plain files and shuffled, and adaptive execution splits
    the partition of a popular song. `co_located` joins bucket by bucket without an exchange,
    a task for each bucket: for tables of equal buckets without a song that stands out.
    `hint` names a join strategy; None leaves it to Spark.
    """
    read = _read_buckets if co_located else _read_files
    plays = read(spark, FACT_SONGPLAY, database)
    songs = read(spark, DIM_SONG, database).drop("artist_id")
    return plays.join(songs.hint(hint) if hint else songs, "song_id")
