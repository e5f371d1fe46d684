"""Token totals by source, language and tokenizer version, kept up by signed changes.

A change is an insert (+n tokens, +1 document), a delete (-n, -1) or a revised count (the new
count less the old one, no document). A batch of changes is added up by key before and after the
shuffle and committed under its id. Totals are the sum over commits, so no commit reads another,
and the order of commits does not matter.

A commit is a folder written by Spark and named after the batch. Its marker of success is what
makes it count: a batch that is committed again, or again after a failure, is written over or
left alone, and is never added twice.

`compact` adds commits up into a numbered base, which lists the ids that it absorbed, those of the
base before included. A base counts from its marker on, with both in it, so that a reader sees each
commit in the base or beside it. Absorbed ids are looked up by Spark and never brought to the driver,
however many there were; what the driver lists are the commits that still have a folder. Folders of
absorbed commits and the base before stay for one more compaction, for readers that began earlier.
Batches may be committed while a compaction runs; one compaction at a time.

Defined cases: NULL in source, language or version is a key of its own; a NULL count is zero; a
change of unknown kind is an error; an empty batch is a commit without rows; repeated rows in a
batch count each time, since they are changes and not documents; other columns are not looked
at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def words(text: Column) -> Column:
    """Version words-1: runs of other than ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def words_and_marks(text: Column) -> Column:
    """Version words-2: runs of letters, digits and other characters of more than ASCII, and
    ASCII marks one by one."""
    pattern = F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]")
    return F.regexp_count(F.coalesce(text, F.lit("")), pattern).cast("long")


TOKENIZERS = {"words-1": words, "words-2": words_and_marks}


def deltas(changes: DataFrame) -> DataFrame:
    """Signed totals by key of rows (source, lang, tokenizer, change, n_tokens, old_n_tokens)."""
    kind, new = F.col("change"), F.coalesce("n_tokens", F.lit(0))
    unknown = F.raise_error(F.concat(F.lit("unknown change "), F.coalesce(kind, F.lit("NULL"))))
    tokens = (
        F.when(kind == "insert", new)
        .when(kind == "delete", -new)
        .when(kind == "revise", new - F.coalesce("old_n_tokens", F.lit(0)))
        .otherwise(unknown.cast("long"))
    )
    docs = F.when(kind == "insert", 1).when(kind == "delete", -1).otherwise(0)
    sums = changes.groupBy(*KEYS).agg(F.sum(docs).alias("n_docs"), F.sum(tokens).alias("n_tokens"))
    return sums.select(*KEYS, F.col("n_docs").cast("long"), F.col("n_tokens").cast("long"))


class Rollup:
    """The commits below one folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _ids(self, marker: str, prefix: str) -> list[str]:
        """Folders with a marker in them, by what follows the prefix in their names."""
        found = self._files().globStatus(self._path(f"{prefix}*/{marker}")) or []
        return sorted(s.getPath().getParent().getName().removeprefix(prefix) for s in found)

    def _bases(self) -> list[int]:
        return sorted(int(n) for n in self._ids("_COMMITTED", "base="))

    def _base(self) -> int | None:
        return max(self._bases(), default=None)

    def _absorbed(self, base: int | None) -> DataFrame:
        if base is None:
            return self.spark.createDataFrame([], "batch string")
        return self.spark.read.schema("batch string").parquet(f"{self.folder}/base={base}/absorbed")

    def _folders(self, base: int | None, absorbed: bool) -> list[str]:
        """Ids of whole commits that have a folder, those that a base absorbed or the others."""
        ids = self._ids("_SUCCESS", "batch=")
        if base is None or not ids:
            return [] if absorbed else ids
        listed = self.spark.createDataFrame([(i,) for i in ids], "batch string")
        kept = listed.join(self._absorbed(base), "batch", "left_semi" if absorbed else "left_anti")
        return sorted(r.batch for r in kept.collect())

    def committed(self, batch: str) -> bool:
        if self._files().exists(self._path(f"batch={batch}/_SUCCESS")):
            return True
        base = self._base()
        return base is not None and not self._absorbed(base).filter(F.col("batch") == batch).isEmpty()

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch unless it is there already; tells whether it was added."""
        if self.committed(batch):
            return False
        deltas(changes).write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")
        return True

    def writer(self, name: str):
        """A function for `foreachBatch`: a stream that restarts commits nothing twice."""
        return lambda changes, number: self.commit(f"{name}-{number}", changes)

    def batches(self) -> list[str]:
        """Ids of the batches that were committed whole and are not in a base yet."""
        return self._folders(self._base(), absorbed=False)

    def _sums(self, base: int | None, ids: list[str]) -> DataFrame:
        paths = [f"{self.folder}/batch={b}" for b in ids]
        if base is not None:
            paths.append(f"{self.folder}/base={base}/totals")
        if not paths:
            return self.spark.createDataFrame([], TOTALS)
        rows = self.spark.read.schema(TOTALS).parquet(*paths)
        sums = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 OR n_tokens <> 0")

    def totals(self) -> DataFrame:
        """Sums over all commits; keys whose documents are all gone again are left out."""
        base = self._base()
        return self._sums(base, self._folders(base, absorbed=False))

    def compact(self) -> int:
        """Add the commits beside the base up into a new one; tells how many there were.

        A compaction that was cut off has no marker and is written over by the next one.
        """
        bases = self._bases()
        base = max(bases, default=None)
        ids = self._folders(base, absorbed=False)
        if not ids:
            return 0
        before = self._folders(base, absorbed=True)
        new = 0 if base is None else base + 1
        added = self.spark.createDataFrame([(i,) for i in ids], "batch string")
        self._sums(base, ids).write.mode("overwrite").parquet(f"{self.folder}/base={new}/totals")
        added.union(self._absorbed(base)).write.mode("overwrite").parquet(f"{self.folder}/base={new}/absorbed")
        self._files().create(self._path(f"base={new}/_COMMITTED"), True).close()
        old = [f"batch={b}" for b in before] + [f"base={n}" for n in bases if n != base]
        for name in old:
            self._files().delete(self._path(name), True)
        return len(ids)
