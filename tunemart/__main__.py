"""Command line: create the tables, load them, or both."""

from __future__ import annotations

import argparse

from tunemart import LoadConfig, build_session, create_tables, drop_tables
from tunemart.plans.pipeline import create_sized_tables, etl, run


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tunemart", description=__doc__)
    parser.add_argument("step", choices=["create-tables", "etl", "run"])
    parser.add_argument("--config", help="INI file with the data paths in section [S3]")
    parser.add_argument("--database", default="default")
    parser.add_argument("--buckets", type=int)
    parser.add_argument("--on-bad-record", default="fail", choices=["fail", "quarantine"])
    parser.add_argument("--on-bad-value", default="fail", choices=["fail", "reject", "null"])
    parser.add_argument("--on-violation", default="raise", choices=["raise", "reject"])
    parser.add_argument("--multiline", action="store_true", help="records span lines")
    parser.add_argument("--ordered-keys", action="store_true", help="number plays reproducibly")
    parser.add_argument("--dedup", action="store_true", help="one row per artist and per time")
    parser.add_argument("--load-id", help="name of the load; a repeated one is not loaded twice")
    args = parser.parse_args(argv)
    if not args.config and (args.step != "create-tables" or args.buckets is None):
        parser.error("--config is needed to load data, or to size the tables for it")

    spark = build_session()
    if not args.config:
        drop_tables(spark, args.database)
        create_tables(spark, args.database, args.buckets)
        return
    settings = {k: v for k, v in vars(args).items() if k not in ("step", "config")}
    cfg = LoadConfig.from_ini(args.config, **settings)
    {"create-tables": create_sized_tables, "etl": etl, "run": run}[args.step](spark, cfg)


if __name__ == "__main__":
    main()
