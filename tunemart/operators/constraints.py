"""NOT NULL and length limits: enforced, reported, or marked by row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemart.schemas import Table


def _checks(table: Table, columns: list[str]) -> list[tuple[str, str, Column]]:
    """(column, what is wrong, condition of a violation) for the columns that are present."""
    present = {c.lower() for c in columns}
    nulls = [(c, "is NULL", F.col(c).isNull()) for c in table.required if c.lower() in present]
    lengths = [
        (c, f"is longer than {n}", F.length(c) > n)
        for c, n in table.limited.items()
        if c.lower() in present
    ]
    return nulls + lengths


def enforce_not_null(df: DataFrame, table: Table) -> DataFrame:
    """Fail the job that reads a NULL in a NOT NULL column, naming table and column.

    The check rides along with the write, so it costs no extra pass.
    """
    checked = {
        c: F.when(
            F.col(c).isNull(), F.raise_error(F.lit(f"{table.name}.{c} must not be NULL"))
        ).otherwise(F.col(c))
        for c in table.required
    }
    return df.withColumns(checked)


def enforced(table: Table, where: Column) -> dict[str, Column]:
    """Columns that fail the job where a row of `where` breaks a limit; spaces beyond one are cut."""
    found = {}
    for c in {*table.required, *table.limited}:
        value, limit = F.col(c), table.limited.get(c)
        if c in table.required:
            message = F.raise_error(F.lit(f"{table.name}.{c} must not be NULL"))
            value = F.when(where & F.col(c).isNull(), message).otherwise(value)
        if limit is not None:
            message = F.raise_error(F.lit(f"EXCEED_LIMIT_LENGTH: {table.name}.{c} has more than {limit} characters"))
            fitted = F.when(F.length(F.rtrim(c)) > limit, message).otherwise(F.substring(c, 1, limit))
            value = F.when(where & (F.length(c) > limit), fitted).otherwise(value)
        found[c] = value
    return found


def reasons(table: Table, columns: list[str]) -> Column:
    """What a row breaks, '' if nothing."""
    return F.concat_ws(
        "; ", *[F.when(bad, F.lit(f"{column} {what}")) for column, what, bad in _checks(table, columns)]
    )


def with_reason(df: DataFrame, table: Table) -> DataFrame:
    """All rows with a `reason`, which is empty for those that keep all constraints."""
    return df.withColumn("reason", reasons(table, df.columns))


def _count_report(df: DataFrame, table: Table, flags: dict[str, Column]) -> DataFrame:
    counts = df.agg(*[F.count_if(bad).alias(c) for c, bad in flags.items()])
    return counts.select(F.lit(table.name).alias("table_name"), "*").unpivot(
        ["table_name"], list(flags), "column_name", "violations"
    )


def not_null_violations(candidates: list[tuple[Table, DataFrame]]) -> DataFrame:
    """NULLs per NOT NULL column, one pass over each candidate."""
    reports = [
        _count_report(df, table, {c: F.col(c).isNull() for c in table.required})
        for table, df in candidates
    ]
    return reduce(DataFrame.unionByName, reports)


def length_violations(candidates: list[tuple[Table, DataFrame]]) -> DataFrame:
    """Too long values per length-limited column, one pass over each candidate."""
    reports = [
        _count_report(df, table, {c: F.length(c) > n for c, n in table.limited.items()})
        for table, df in candidates
    ]
    return reduce(DataFrame.unionByName, reports)
