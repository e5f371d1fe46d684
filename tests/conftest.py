from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tunemart import build_session, scratch

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    scratch.release()
    session.stop()


@pytest.fixture
def database(spark):
    """A fresh database, dropped after the test along with the test's scratch folders."""
    with scratch.scope():
        yield scratch.new_database(spark)


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    saved = {}

    def set_conf(**settings):
        for key, value in settings.items():
            name = key.replace("__", ".")
            saved.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, str(value))

    yield set_conf
    for name, value in saved.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def events(spark):
    """Build staging_events rows from partial dictionaries."""
    return lambda *rows: staging_frame(spark, "staging_events", rows)


@pytest.fixture
def songs(spark):
    """Build staging_songs rows from partial dictionaries."""
    return lambda *rows: staging_frame(spark, "staging_songs", rows)


def staging_frame(spark, name, rows):
    from tunemart.schemas import TABLES

    columns = TABLES[name].columns
    schema = ", ".join(f"{c.name} {c.value_type}" for c in columns)
    return spark.createDataFrame([tuple(r.get(c.name) for c in columns) for r in rows], schema)
