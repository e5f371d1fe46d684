"""What several operators share: reading tables, text slices of bounded size, counting folds."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text that one numpy step works on; a longer single text is still taken whole.
SLICE_BYTES = 8 * 1024**2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def slices(
    batches: Iterable[pa.RecordBatch], column: str | int, n_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about `n_bytes` of `column`, and one row at least."""
    for batch in batches:
        start, held = 0, 0
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        for row, length in enumerate(lengths):
            if held and held + (length or 0) > n_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length or 0
        if batch.num_rows > start:
            yield batch.slice(start)


def text_key(text: Column) -> Column:
    """128 bits that stand for a whole text; NULL and empty texts share theirs."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be no column of `df`."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
