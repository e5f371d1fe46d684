"""A full refresh that is built beside the tables and takes their place at its end.

A version is a database of its own whose folders lie in `_versions` of the one it is for. Until
its marker is written nothing of it can be seen; with it the switch goes on to the end, now or in
`recover`: each table is pointed to the folder of the new version. Files of the version before
stay until the next refresh, so that queries that read them can end.

Spark names CHAR and VARCHAR columns STRING in a table whose location was changed; their limits
hold as before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tunemart import shared_files as files
from tunemart.plans.loads import READ_FOLDERS, database_folder, home, location


def _root(spark: SparkSession, database: str) -> str:
    return f"{database_folder(spark, database)}/_versions"


def _tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if t.tableType != "TEMPORARY")


def _describe(spark: SparkSession, name: str) -> dict:
    """What it takes to create a table again."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    details = {r.col_name: r.data_type for r in rows}
    fields = spark.table(name).schema.fields
    columns = ", ".join(
        f"`{f.name}` {r.data_type}{'' if f.nullable else ' NOT NULL'}" for f, r in zip(fields, rows)
    )
    layout = ""
    if "Num Buckets" in details:
        key, sort = (details[k].strip("[]`") for k in ("Bucket Columns", "Sort Columns"))
        layout = f"CLUSTERED BY (`{key}`) SORTED BY (`{sort}`) INTO {details['Num Buckets']} BUCKETS"
    return {"columns": columns, "schema": spark.table(name).schema.simpleString(), "layout": layout}


def _alike(one: dict, other: dict) -> bool:
    """The same columns and layout; a changed location makes Spark forget how CHAR is spelled."""
    return all(one[k] == other[k] for k in ("schema", "layout"))


@contextmanager
def new_version(spark: SparkSession, database: str) -> Iterator[str]:
    """The name of a database to fill; at the end its tables take the place of those of `database`.

    If the block fails, the version is removed and the tables stay as they are. Tables that the
    version does not have are dropped where `database` got them from an earlier load. One refresh
    of a database at a time.
    """
    recover(spark, database)
    _remove_old(spark, database)
    version = uuid.uuid4().hex
    beside, folder = f"{database}__{version}", f"{_root(spark, database)}/{version}"
    spark.sql(f"CREATE DATABASE `{beside}` LOCATION '{folder}/build'")
    try:
        yield beside
    except BaseException:
        spark.sql(f"DROP DATABASE IF EXISTS `{beside}` CASCADE")
        files.delete(spark, folder)
        raise
    names = _tables(spark, beside)
    plan = {
        "database": beside,
        "tables": {n: _describe(spark, f"`{beside}`.`{n}`") for n in names},
        "folders": {n: location(spark, f"`{beside}`.`{n}`") for n in names},
        "before": {n: location(spark, f"`{database}`.`{n}`") for n in _tables(spark, database)},
    }
    files.write_new(spark, f"{folder}/_COMMITTED", json.dumps(plan))
    _switch(spark, database, folder)


def _switch(spark: SparkSession, database: str, folder: str) -> None:
    """Point the tables to a committed version; steps that were done are skipped."""
    plan = json.loads(files.read_text(spark, f"{folder}/_COMMITTED"))
    for name, found in plan["tables"].items():
        new = f"{folder}/{name}"
        if files.exists(spark, plan["folders"][name]):
            files.move(spark, plan["folders"][name], new)
        table = f"`{database}`.`{name}`"
        there = spark.catalog.tableExists(f"{database}.{name}")
        if there and not _alike(_describe(spark, table), found):
            # Another layout: the table is made anew, without touching the files it had.
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}/none'")
            spark.sql(f"DROP TABLE {table}")
            there = False
        if not there:
            default = f"{database_folder(spark, database)}/{name}"
            if files.names(spark, default):
                files.move(spark, default, f"{folder}/moved/{name}")
            spark.sql(f"CREATE TABLE {table} ({found['columns']}) USING parquet {READ_FOLDERS} {found['layout']}")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
        spark.catalog.refreshTable(table)
    for name in plan["before"].keys() - plan["tables"].keys():
        if name.endswith("_rejects") or name in ("staging_bad_records", "staging_bad_values"):
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    log, new_log = home(spark, database), f"{folder}/build/_loads"
    if files.exists(spark, new_log):
        if files.exists(spark, log):
            files.move(spark, log, f"{folder}/moved/_loads")
        files.move(spark, new_log, log)
    if spark.catalog.databaseExists(plan["database"]):
        for name in plan["tables"]:
            spark.sql(f"ALTER TABLE `{plan['database']}`.`{name}` SET LOCATION '{folder}/build/{name}'")
        spark.sql(f"DROP DATABASE `{plan['database']}` CASCADE")
    files.write_new(spark, f"{folder}/_SWITCHED", "")


def recover(spark: SparkSession, database: str) -> None:
    """Finish a switch that was cut off; remove versions that never got their marker."""
    root = _root(spark, database)
    for version in files.names(spark, root):
        folder = f"{root}/{version}"
        if not files.exists(spark, f"{folder}/_COMMITTED"):
            spark.sql(f"DROP DATABASE IF EXISTS `{database}__{version}` CASCADE")
            files.delete(spark, folder)
        elif not files.exists(spark, f"{folder}/_SWITCHED"):
            _switch(spark, database, folder)


def _remove_old(spark: SparkSession, database: str) -> None:
    """Remove files of versions that no table points to any more."""
    root = _root(spark, database)
    used = {location(spark, f"`{database}`.`{n}`") for n in _tables(spark, database)}
    plain = {u.split(":", 1)[-1].replace("//", "/") for u in used}
    for version in files.names(spark, root):
        plan = json.loads(files.read_text(spark, f"{root}/{version}/_COMMITTED"))
        files.delete(spark, f"{root}/{version}/moved")
        for old in plan["before"].values():
            if old.split(":", 1)[-1].replace("//", "/") not in plain:
                files.delete(spark, old)
        folders = {f"{root}/{version}/{n}".split(":", 1)[-1].replace("//", "/") for n in plan["tables"]}
        if not folders & plain:
            files.delete(spark, f"{root}/{version}")


def forget(spark: SparkSession, database: str) -> None:
    """Remove all versions of a database whose tables are gone, and what they had before."""
    for version in files.names(spark, _root(spark, database)):
        marker = f"{_root(spark, database)}/{version}/_COMMITTED"
        if files.exists(spark, marker):
            for old in json.loads(files.read_text(spark, marker))["before"].values():
                files.delete(spark, old)
    files.delete(spark, _root(spark, database))
