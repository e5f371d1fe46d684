"""Loads that are there once and as a whole, and ranges of keys that no two loads share.

The folder `_loads` of a database holds, for each load, what it wrote, and the marker `_COMMITTED`
once all of it is written. Without the marker nothing of a load can be seen and a new attempt
starts over; with it the load counts, and what it wrote is moved into its tables, a folder for
each, by this load or, if that was cut off, by whoever calls `recover`. The marker of a named load
is then kept in `.done`, and a load whose id is there is skipped. Each load writes into folders of
its own, so that several may append to a table at the same time.
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemart import shared_files as files

MARKER, DONE, ANONYMOUS = "_COMMITTED", ".done", "unnamed-"
_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")
# Reservations of keys that are kept; only the last one is needed.
KEPT_RESERVATIONS = 20
# Loads of one driver move their folders one after the other.
_one_at_a_time = threading.Lock()


def database_folder(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def home(spark: SparkSession, database: str) -> str:
    return f"{database_folder(spark, database)}/_loads"


@dataclass(frozen=True)
class Part:
    """A folder of a load, the table that gets it, and the columns of that table."""

    folder: str
    table: str
    columns: str


class Load:
    """What one load writes; nothing of it is visible before `commit`. Without an id nothing of it
    is kept on record afterwards."""

    def __init__(self, spark: SparkSession, database: str, load_id: str | None = None):
        self.named = load_id is not None
        load_id = load_id if self.named else f"{ANONYMOUS}{uuid.uuid4().hex}"
        if not _ID.fullmatch(load_id):
            raise ValueError(f"a load id has letters, digits, '_', '.' and '-' only, got {load_id!r}")
        self.spark, self.database, self.load_id = spark, database, load_id
        self.folder = f"{home(spark, database)}/{load_id}"
        self.parts: list[Part] = []
        self.counts: list[dict] = []

    def begin(self) -> bool:
        """False if committed before; else clear what an attempt left."""
        recover(self.spark, self.database)
        if files.exists(self.spark, f"{home(self.spark, self.database)}/{DONE}/{self.load_id}"):
            return False
        files.delete(self.spark, self.folder)
        return True

    def add(self, folder: str, table: str, columns: str) -> None:
        """Name a written folder below that of the load, for a table with these columns (DDL)."""
        self.parts.append(Part(folder, table, columns))

    def count(self, table: str, verdict: str, n: int) -> None:
        self.counts.append({"load_id": self.load_id, "table_name": table, "verdict": verdict, "n_records": n})

    def mark(self) -> None:
        """Write the marker: from here on the load counts."""
        found = {"parts": [vars(p) for p in self.parts], "counts": self.counts}
        if not files.write_new(self.spark, f"{self.folder}/{MARKER}", json.dumps(found)):
            raise RuntimeError(f"load {self.load_id} was committed by someone else meanwhile")

    def commit(self) -> None:
        self.mark()
        publish(self.spark, self.database, self.load_id)


def publish(spark: SparkSession, database: str, load_id: str) -> None:
    """Move what a committed load wrote into its tables; steps that were done are skipped."""
    folder, done = f"{home(spark, database)}/{load_id}", f"{home(spark, database)}/{DONE}/{load_id}"
    with _one_at_a_time:
        if not files.exists(spark, f"{folder}/{MARKER}"):
            return  # someone else was quicker
        text = files.read_text(spark, f"{folder}/{MARKER}")
        for part in json.loads(text)["parts"]:
            table = f"`{database}`.`{part['table']}`"
            source = f"{folder}/{part['folder']}"
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({part['columns']}) USING parquet {READ_FOLDERS}")
            if files.exists(spark, source):
                kept = re.sub(r"\W+", "-", part["folder"])
                files.move(spark, source, f"{location(spark, table)}/load-{load_id}-{kept}")
            spark.catalog.refreshTable(table)
        if not load_id.startswith(ANONYMOUS):
            files.write_new(spark, done, text)
        files.delete(spark, folder)


# Tables read the folders that loads were moved to, besides files of their own.
READ_FOLDERS = "OPTIONS (recursiveFileLookup 'true')"


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0].data_type


def recover(spark: SparkSession, database: str) -> None:
    """Finish the loads that were committed but not moved into their tables."""
    folder = home(spark, database)
    for load_id in files.names(spark, folder):
        if _ID.fullmatch(load_id) and files.exists(spark, f"{folder}/{load_id}/{MARKER}"):
            publish(spark, database, load_id)


def committed(spark: SparkSession, database: str) -> DataFrame:
    """(load_id, table_name, verdict, n_records) of the named loads that counted their records."""
    recover(spark, database)
    schema = "counts array<struct<load_id string, table_name string, verdict string, n_records long>>"
    folder = f"{home(spark, database)}/{DONE}"
    texts = [(files.read_text(spark, f"{folder}/{n}"),) for n in files.names(spark, folder)]  # one for each load
    found = spark.createDataFrame(texts, "text string").select(F.from_json("text", schema).alias("m"))
    return found.select(F.explode("m.counts").alias("c")).select("c.*")


@contextmanager
def reserved_keys(spark: SparkSession, database: str, last_key, owner: str | None = None) -> Iterator:
    """A function that reserves n keys and returns the first one.

    Reservations are numbered files that say where their range ends; the next number can be
    written by one load only, and who comes late looks again. `last_key` tells the first key that
    the table does not have. If the block fails, its range is given back by a next file that ends
    where it starts, unless another load was quicker; a load that is tried again gets the range it
    had. So only a crash, or a failure beside another load, leaves a gap.
    """
    folder, mine = f"{home(spark, database)}/.keys", []

    def write(number: int, start: int, n: int) -> bool:
        text = json.dumps({"end": start + n, "n": n, "owner": owner})
        return files.write_new(spark, f"{folder}/{number:012d}", text)

    def reserve(n: int) -> int:
        while True:
            taken = [x for x in files.names(spark, folder) if x.isdigit()]
            number = int(taken[-1]) + 1 if taken else 0
            start = last_key()
            if taken:
                last = json.loads(files.read_text(spark, f"{folder}/{taken[-1]}"))
                if owner is not None and (last["owner"], last["n"]) == (owner, n):
                    return last["end"] - n
                start = max(start, last["end"])
            if write(number, start, n):
                mine.append((number, start))
                for old in taken[:-KEPT_RESERVATIONS]:
                    files.delete(spark, f"{folder}/{old}")
                return start

    try:
        yield reserve
    except BaseException:
        for number, start in mine if owner is None else []:
            write(number + 1, start, 0)
        raise


def forget_keys(spark: SparkSession, database: str) -> None:
    files.delete(spark, f"{home(spark, database)}/.keys")
