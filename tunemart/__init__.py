"""Spark-native load of music-activity logs into a star schema."""

from tunemart.config import LoadConfig
from tunemart.plans.pipeline import build_star, insert_tables, load_staging, run
from tunemart.plans.tables import append, create_tables, drop_tables, truncate_table
from tunemart.session import build_session

__all__ = [
    "LoadConfig",
    "append",
    "build_session",
    "build_star",
    "create_tables",
    "drop_tables",
    "insert_tables",
    "load_staging",
    "run",
    "truncate_table",
]
