"""JSON records under a directory prefix, by path map or by column name."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemart.functions.coerce import BAD_VALUES, coerce
from tunemart.operators.constraints import enforced, reasons
from tunemart.schemas import STAGING_EVENTS, STAGING_SONGS, Table

CORRUPT = "_corrupt_record"

# What may surround a record: white space, and the mark that starts some UTF-8 files.
BLANKS = " \t\r\n\ufeff"

_FIRST_STEP = re.compile(r"\$(?:\.(\w+)|\['([^']+)'\]|\[\"([^\"]+)\"\])((?:[.\[].*)?)")


def default_paths(table: Table) -> list[str]:
    """The path map that names every column at the top level of the record."""
    return [f"$['{c}']" for c in table.column_names]


def read_path_map(spark: SparkSession, location: str) -> list[str]:
    """The list under "jsonpaths" in a small JSON document."""
    document = spark.read.text(location, wholetext=True).first()[0]
    return json.loads(document)["jsonpaths"]


def _first_steps(paths: list[str]) -> list[tuple[str, str]] | None:
    """Top-level field and the path from there, if fields are spelled unambiguously; else None."""
    matches = [_FIRST_STEP.fullmatch(p) for p in paths]
    if not all(matches):
        return None
    steps = [(next(g for g in m.groups()[:3] if g is not None), f"${m[4]}") for m in matches]
    names = {name for name, _ in steps}
    # Spark resolves columns without regard to case, JSON fields differ by case.
    return steps if len({n.lower() for n in names}) == len(names) else None


def _texts(spark: SparkSession, location: str | list[str], multiline: bool, arrays: str) -> DataFrame:
    """Columns `value`, one record as it stands in the file, and `list`, the same as a list.

    A JSON parser stops at the end of the first value. Inside a list it has to read on, so
    that text after a record, such as a second record, is noticed and not lost. `arrays`
    tells what a record in brackets is: "records" (a list already) or "record" (one value).
    """
    value = F.col("value")
    wrapped = F.concat(F.lit("["), value, F.lit("]"))
    as_list = F.when(value.startswith("{"), wrapped).when(
        value.startswith("["), wrapped if arrays == "record" else value
    )
    texts = spark.read.text(location, wholetext=multiline, recursiveFileLookup=True)
    trimmed = texts.select(F.trim("value", F.lit(BLANKS)).alias("value"))
    return trimmed.filter(value != "").select("value", as_list.alias("list"))


def _by_field(steps: list[tuple[str, str]]) -> tuple[Column, Callable, list[Column]]:
    """Records with the top-level fields that paths go through, other fields skipped; what is
    none; the values as text.

    Paths through one field share it: it is taken out of the record once, and each of them
    walks on from there.
    """
    fields = [T.StructField(n, T.VariantType()) for n in dict.fromkeys(name for name, _ in steps)]
    records = F.from_json("list", T.ArrayType(T.StructType(fields)))
    return records, F.isnull, [F.try_variant_get(f"record.`{n}`", rest, "string") for n, rest in steps]


def _by_path(paths: list[str], arrays: str) -> tuple[Column, Callable, list[Column]]:
    """Records as a whole; what is none; values at any paths as text."""
    kind = "ARRAY" if arrays == "record" else "OBJECT"
    records = F.try_variant_get(F.try_parse_json("list"), "$", "array<variant>")
    no_record = lambda r: ~F.schema_of_variant(r).startswith(kind)
    if arrays == "record":
        no_record = lambda r: ~F.schema_of_variant(r).rlike("^(ARRAY|OBJECT)")
    return records, no_record, [F.try_variant_get("record", p, "string") for p in paths]


def _rows(texts: DataFrame, records: Column, no_record: Callable, quarantine: bool) -> DataFrame:
    """Columns `record`, and the text of what is malformed: no JSON, something else than a
    record in a list, or more or less than one record where a list was not opened."""
    value, found = F.col("value"), F.col("records")
    parsed = texts.select("value", records.alias("records"))
    single = value.startswith("{") & (F.size(found) != 1)
    bad = F.coalesce(found.isNull() | F.exists(found, no_record) | single, F.lit(True))
    marked = parsed.select("value", "records", bad.alias("bad"))
    kind = parsed.schema["records"].dataType
    if quarantine:
        instead = F.array(F.lit(None).cast(kind.elementType))
    else:
        message = F.concat(F.lit("MALFORMED_RECORD: "), F.substring(value, 1, 200))
        instead = F.raise_error(message).cast(kind)
    listed = F.when(F.col("bad"), instead).otherwise(found)
    # A list without records has no rows.
    return marked.select(F.when(F.col("bad"), value).alias(CORRUPT), F.explode(listed).alias("record"))


def read_records(
    spark: SparkSession,
    location: str | list[str],
    table: Table,
    paths: list[str] | None = None,
    on_bad_record: str = "fail",
    on_bad_value: str = "fail",
    multiline: bool = False,
) -> DataFrame:
    """Typed rows of `table` from JSON files anywhere below `location`.

    The i-th path fills the i-th column and an absent path gives NULL. A malformed record
    fails the read; with "quarantine" its text is kept in an extra column instead
    (see `split_bad_records`). So does a value that does not fit its column; with "reject"
    it is listed in an extra column (see `split_bad_values`), with "null" it is NULL.

    Records are taken apart by top-level field, and nested paths walk on from their field. Where
    records are lists, or fields differ by case only, whole records are walked by path; that is
    slower, gives the same values, and parses a record once as well. A first path step that is a number
    (`$[0]`) says that records are lists.
    """
    paths = default_paths(table) if paths is None else paths
    if len(paths) != len(table.columns):
        raise ValueError(f"{table.name} has {len(table.columns)} columns, got {len(paths)} paths")
    quarantine = on_bad_record == "quarantine"
    steps = _first_steps(paths)
    arrays = "record" if any(re.match(r"\$\[\d", p) for p in paths) else "records"
    texts = _texts(spark, location, multiline, arrays)
    records, no_record, values = _by_path(paths, arrays) if steps is None else _by_field(steps)
    rows = _rows(texts, records, no_record, quarantine)
    keep = (CORRUPT,) if quarantine else ()
    picked = rows.select(*[v.alias(c) for v, c in zip(values, table.column_names)], *keep)
    return coerce(picked, table, on_bad_value, keep)


def split_bad_records(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, text of the malformed records) of a read in quarantine mode."""
    good = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = rows.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"))
    return good, bad


def split_bad_values(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows all of whose values fit, the values that do not by column) of a read with "reject"."""
    good = rows.filter(F.size(BAD_VALUES) == 0).drop(BAD_VALUES)
    bad = rows.select(F.explode(BAD_VALUES).alias("b")).select("b.column_name", "b.value")
    return good, bad


def verdicts(rows: DataFrame, table: Table, reject: bool = False) -> DataFrame:
    """All that a read gave, each record marked with its `verdict`, for a write that parts them.

    A record is "good", a "bad_record" (its text in `record`), a "bad_value" (a row for each,
    in `column_name` and `value`, numbered by `nth`), or with `reject` a "violation" of the
    table's constraints (with a `reason`); without it a violation fails the job.
    """
    corrupt = F.col(CORRUPT) if CORRUPT in rows.columns else F.lit(None).cast("string")
    entry = "array<struct<column_name string, value string>>"
    bad = F.col(BAD_VALUES).cast(entry) if BAD_VALUES in rows.columns else F.lit(None).cast(entry)
    broken = corrupt.isNotNull()
    reason = F.when(~broken, reasons(table, table.column_names)) if reject else F.lit("")
    verdict = (
        F.when(broken, F.lit("bad_record"))
        .when(F.coalesce(F.size(bad) > 0, F.lit(False)), F.lit("bad_value"))
        .when(reason != "", F.lit("violation"))
        .otherwise(F.lit("good"))
    )
    marked = rows.select(
        *table.column_names,
        F.lit(table.name).alias("table_name"),
        corrupt.alias("record"),
        reason.alias("reason"),
        verdict.alias("verdict"),
        F.when(verdict == "bad_value", bad).alias("bad"),
    )
    checked = marked.withColumns(enforced(table, F.col("verdict") == "good"))
    parted = checked.select("*", F.posexplode_outer("bad").alias("nth", "entry"))
    return parted.select(
        *table.column_names,
        "table_name",
        "record",
        "entry.column_name",
        "entry.value",
        F.coalesce("nth", F.lit(0)).alias("nth"),
        "reason",
        "verdict",
    )


def read_events(spark: SparkSession, location: str | list[str], **options) -> DataFrame:
    """Activity log records by path map."""
    return read_records(spark, location, STAGING_EVENTS, **options)


def read_songs(spark: SparkSession, location: str | list[str], **options) -> DataFrame:
    """Song metadata records by column name: unknown fields are dropped, missing are NULL."""
    return read_records(spark, location, STAGING_SONGS, **options)
