"""Reversible line deduplication: sharded cuckoo filters over exact reference counts.

A line's key is its text without surrounding white space, A-Z in lower case; its 128-bit digest
stands for it. `LineIndex` keeps, in a folder,

- the references: (key, document, +1 or -1), appended batch by batch;
- for each key the exact number of documents that hold it and the largest of them;
- for each shard of keys (leading bits of the digest) a cuckoo filter of those keys that enough
  documents hold. The counts say exactly when a key gets there or falls below, so that it is
  inserted once and deleted once, which is what a cuckoo filter needs to stay free of misses.

`commit` adds documents and removes others; removing what was added gives back the earlier state.
`drops` brings references and filters together by shard: what a filter doesn't know is unique
enough and needs no look-up; the rest is decided by the exact counts. Keys that over a thousand
documents and over a thousandth of all references hold, fewer than a thousand keys, are sent to
all tasks instead, so that no shard has to take a very frequent line's references.

Defined cases: a NULL or empty text is one empty line; rows without an id hold no references and
keep all lines; rows of one id are one document, and equal rows get equal results; of a document
that is in the index already nothing is added, and removing an unknown one does nothing; a batch
that was committed is skipped; texts of any length are handled line by line; an empty table gives
an empty one; columns beyond id and text pass through `deduplicate`, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemart import scratch
from tunemart.llm.common import fresh, slices

BLANKS = b" \t\n\v\f\r"
SLOTS = 4
# Share of the slots of a filter beyond which it is built anew with twice as many.
FULL = 0.85
KICKS = 500
# Keys a shard should have, about.
SHARD_KEYS = 1 << 12
MOST_BITS = 24
# A key with over this share of the references is one of fewer than 1 / HEAVY; one with few
# references is none.
HEAVY, HEAVY_LEAST = 1e-3, 1_000
SLICE_BYTES = 2 * 1024**2


def digest_of(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line as 16 bytes; None if it is shorter than `min_chars` code points."""
    key = line.strip(BLANKS).lower()
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a key may lie in either of two buckets.

    What finds no place after many moves is kept in a list beside the buckets.
    """

    def __init__(self, slots: np.ndarray, stash: list[tuple[int, int]], n: int):
        self.slots, self.stash, self.n = slots, stash, n

    @classmethod
    def sized(cls, n_keys: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * FULL < n_keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16), [], 0)

    @classmethod
    def unpack(cls, packed: bytes) -> CuckooFilter:
        n, buckets, stashed = struct.unpack_from("<QQQ", packed)
        slots = np.frombuffer(packed, "<u2", buckets * SLOTS, 24).reshape(-1, SLOTS).copy()
        rest = np.frombuffer(packed, "<u8", 2 * stashed, 24 + slots.nbytes).reshape(-1, 2)
        return cls(slots, [tuple(map(int, r)) for r in rest], n)

    def pack(self) -> bytes:
        head = struct.pack("<QQQ", self.n, len(self.slots), len(self.stash))
        return head + self.slots.astype("<u2").tobytes() + np.array(self.stash, "<u8").tobytes()

    def room(self) -> int:
        return int(self.slots.size * FULL)

    def _print_and_buckets(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
        prints = (words[:, 1] % np.uint64(0xFFFF)).astype(np.uint64) + np.uint64(1)
        mask = np.uint64(len(self.slots) - 1)
        first = (words[:, 0] >> np.uint64(8)) & mask
        return prints, first, first ^ self._other(prints) & mask

    @staticmethod
    def _other(prints: np.ndarray) -> np.ndarray:
        return (prints * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)

    def insert(self, keys: list[bytes]) -> None:
        mask = len(self.slots) - 1
        for mark, one, two in zip(*(x.tolist() for x in self._print_and_buckets(keys))):
            self.n += 1
            bucket = one if not self.slots[one].all() else two
            for kick in range(KICKS):
                free = np.flatnonzero(self.slots[bucket] == 0)
                if len(free):
                    self.slots[bucket, free[0]] = mark
                    break
                place = kick % SLOTS
                self.slots[bucket, place], mark = mark, int(self.slots[bucket, place])
                bucket ^= int(self._other(np.array([mark], np.uint64))[0]) & mask
            else:
                self.stash.append((bucket, mark))

    def delete(self, keys: list[bytes]) -> None:
        """Take out keys that were inserted."""
        for mark, one, two in zip(*(x.tolist() for x in self._print_and_buckets(keys))):
            self.n -= 1
            for bucket in (one, two):
                held = np.flatnonzero(self.slots[bucket] == mark)
                if len(held):
                    self.slots[bucket, held[0]] = 0
                    break
                if (bucket, mark) in self.stash:
                    self.stash.remove((bucket, mark))
                    break

    def may_hold(self, keys: list[bytes]) -> np.ndarray:
        prints, one, two = self._print_and_buckets(keys)
        found = (self.slots[one] == prints[:, None]).any(1) | (self.slots[two] == prints[:, None]).any(1)
        for bucket, mark in self.stash:
            found |= (prints == mark) & ((one == bucket) | (two == bucket))
        return found


def references_of(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(doc_id, mark, key): each different key of each row with an id; `mark` stands for the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, SLICE_BYTES):
            rows, keys = [], []
            for row, content in enumerate(batch.column(2).to_pylist()):
                found = {digest_of(line, min_chars) for line in content.split(b"\n")} - {None}
                rows += [row] * len(found)
                keys += sorted(found)
            at = pa.array(rows, pa.int64())
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "key"])

    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.filter(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("mark"), content.alias("content")
    )
    schema = T.StructType(
        [rows.schema["doc_id"], T.StructField("mark", T.LongType()), T.StructField("key", T.BinaryType())]
    )
    return rows.mapInArrow(run, schema)


def _shard(bits: int):
    """The first bits of a key."""
    return F.shiftright(F.conv(F.hex(F.substring("key", 1, 3)), 16, 10).cast("int"), 24 - bits)


class LineIndex:
    """References, counts and filters of the lines of a growing and shrinking set of documents."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        min_docs: int = 3,
        min_chars: int = 20,
        doc_id: str = "doc_id",
        text: str = "text",
        shard_keys: int = SHARD_KEYS,
    ):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.min_docs, self.min_chars = min_docs, min_chars
        self.doc_id, self.text, self.shard_keys = doc_id, text, shard_keys

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def batches(self) -> list[tuple[int, str, int]]:
        """(number, batch, bits of a shard) of the commits, one small row for each."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/log")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return []
        return sorted(tuple(r) for r in self._read("log").select("number", "batch", "bits").collect())

    def commit(self, batch: str, added: DataFrame | None = None, removed: DataFrame | None = None) -> None:
        """Take out the documents whose ids `removed` lists, then take in those of `added`.

        All of it counts once the last row of the log is written; what an aborted commit wrote is
        written over by the next one.
        """
        log = self.batches()
        if batch in {b for _, b, _ in log}:
            return
        number = len(log)
        with scratch.scope():
            self._references(number, added, removed)
            bits = self._counts(number, log[-1][2] if log else None)
            self._filters(number, bits)
        row = [(number, batch, bits)]
        self.spark.createDataFrame(row, "number int, batch string, bits int").coalesce(1).write.mode("append").parquet(
            f"{self.folder}/log"
        )

    def _live(self, number: int) -> DataFrame:
        """References after the commits before `number`."""
        if number == 1:  # the first commit has nothing to remove
            return self._read("references/0").filter("sign > 0").drop("sign")
        parts = [self._read(f"references/{n}").withColumn("n", F.lit(n)) for n in range(number)]
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        # A document's latest commit tells whether it is in.
        last = every.groupBy("doc_id").agg(F.max(F.struct("n", "sign")).alias("last"))
        alive = last.filter("last.sign > 0").select("doc_id", F.col("last.n").alias("n"))
        return every.filter("sign > 0").join(alive, ["doc_id", "n"], "left_semi").drop("sign", "n")

    def _references(self, number: int, added: DataFrame | None, removed: DataFrame | None) -> None:
        target, parts = f"{self.folder}/references/{number}", []
        out = None
        if number and removed is not None:
            ids = removed.select(F.col(self.doc_id).alias("doc_id")).distinct()
            out = scratch.materialize(self._live(number).join(ids, "doc_id", "left_semi"), "removed")
            parts.append(out.withColumn("sign", F.lit(-1)))
        if added is not None:
            new = references_of(added, self.doc_id, self.text, self.min_chars)
            if number:
                there = self._live(number).select("doc_id").distinct()
                if out is not None:
                    there = there.join(out, "doc_id", "left_anti")
                new = new.join(there, "doc_id", "left_anti")
            parts.append(new.withColumn("sign", F.lit(1)))
        if not parts:
            first = self._read("references/0") if number else None
            if first is None:
                raise ValueError("the first commit has to add documents")
            parts.append(first.limit(0))
        written = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        written.write.mode("overwrite").parquet(target)

    def _counts(self, number: int, bits: int | None) -> int:
        """Write (shard, key, n_docs, last_id, was) after this commit; the bits of a shard."""
        delta = self._read(f"references/{number}").select("key", "doc_id", "sign").distinct()
        gone = F.max(F.when(F.col("sign") < 0, F.col("doc_id")))
        changed = delta.groupBy("key").agg(
            F.sum("sign").alias("by"),
            F.max(F.when(F.col("sign") > 0, F.col("doc_id"))).alias("came"),
            gone.alias("gone"),
        )
        target = f"{self.folder}/counts/{number}"
        if not number:
            counts = changed.select("key", F.col("by").alias("n_docs"), F.col("came").alias("last_id"), F.lit(0).cast("long").alias("was"))
            counts = scratch.materialize(counts, "counts")
            n_keys, bits = counts.count(), 0
            while n_keys >> bits > self.shard_keys and bits < MOST_BITS:
                bits += 1
            counts.select(_shard(bits).alias("shard"), "*").write.mode("overwrite").parquet(target)
            return bits
        before = self._read(f"counts/{number - 1}").filter("n_docs > 0").select("key", F.col("n_docs").alias("was"), F.col("last_id").alias("old_last"))
        merged = before.join(changed, "key", "full_outer").select(
            "key",
            (F.coalesce("was", F.lit(0)) + F.coalesce("by", F.lit(0))).alias("n_docs"),
            F.greatest(F.when(F.coalesce(F.col("gone") < F.col("old_last"), F.lit(True)), F.col("old_last")), "came").alias("known"),
            F.coalesce(F.col("gone") >= F.col("old_last"), F.lit(False)).alias("lost"),
            F.coalesce("was", F.lit(0)).alias("was"),
        )
        merged = scratch.materialize(merged, "merged")
        # Keys that lost their largest document look for the next one among the references.
        lost = merged.filter("lost AND n_docs > 0").select("key")
        left = self._live(number + 1).join(lost, "key", "left_semi").groupBy("key").agg(F.max("doc_id").alias("left_id"))
        counts = merged.join(left, "key", "left").select(
            _shard(bits).alias("shard"), "key", "n_docs", F.coalesce("left_id", "known").alias("last_id"), "was"
        )
        counts.write.mode("overwrite").parquet(target)
        return bits

    def _filters(self, number: int, bits: int) -> None:
        """Bring the keys that got to or fell below `min_docs` into the filters of their shards."""
        counts, least = self._read(f"counts/{number}"), self.min_docs
        now, then = F.col("n_docs") >= least, F.col("was") >= least
        sizes = counts.groupBy("shard").agg(F.count_if(now).alias("holds"))
        if number:
            old = self._read(f"filters/{number - 1}")
        else:
            old = self.spark.createDataFrame([], "shard int, packed binary, room long")
        shards = sizes.join(old, "shard", "left")
        anew = F.coalesce(F.col("holds") > F.col("room"), F.lit(True))
        shards = scratch.materialize(shards.select("shard", "holds", anew.alias("anew"), F.when(~anew, F.col("packed")).alias("packed")), "shards")
        flagged = counts.join(shards.select("shard", "anew"), "shard")
        change = F.when(F.col("anew"), now.cast("int")).otherwise(now.cast("int") - then.cast("int"))
        moves = flagged.select("shard", "key", change.alias("change")).filter("change <> 0")

        def update(old: pa.Table, moves: pa.Table) -> pa.Table:
            packed, holds = old.column("packed")[0].as_py(), old.column("holds")[0].as_py()
            made = CuckooFilter.sized(holds) if packed is None else CuckooFilter.unpack(packed)
            keys, change = moves.column("key").to_pylist(), moves.column("change").to_numpy()
            for sign, apply in ((-1, made.delete), (1, made.insert)):
                if some := sorted(k for k, c in zip(keys, change) if c == sign):
                    apply(some)
            return pa.table(
                {
                    "shard": pa.array([old.column("shard")[0].as_py()], pa.int32()),
                    "packed": pa.array([made.pack()], pa.binary()),
                    "room": pa.array([made.room()], pa.int64()),
                }
            )

        filters = shards.groupBy("shard").cogroup(moves.groupBy("shard")).applyInArrow(
            update, "shard int, packed binary, room long"
        )
        filters.write.mode("overwrite").parquet(f"{self.folder}/filters/{number}")

    def counts(self) -> DataFrame:
        """(key, n_docs, last_id) of the keys that a document holds."""
        number = len(self.batches()) - 1
        return self._read(f"counts/{number}").filter("n_docs > 0").select("key", "n_docs", "last_id")

    def drops(self) -> DataFrame:
        """(doc_id, mark, keys): the keys that each text loses."""
        log = self.batches()
        number, bits = len(log) - 1, log[-1][2]
        counts = self._read(f"counts/{number}")
        repeated = counts.filter(F.col("n_docs") >= self.min_docs).select("key", "last_id")
        total = counts.agg(F.sum("n_docs")).first()[0] or 0
        heavy = counts.filter(F.col("n_docs") > max(total * HEAVY, HEAVY_LEAST)).select("key", "last_id")
        live = self._live(number + 1)
        of_heavy = F.broadcast(heavy)  # fewer than 1 / HEAVY keys
        frequent = live.join(of_heavy, "key").filter("doc_id <> last_id").drop("last_id")
        others = live.join(of_heavy, "key", "left_anti")
        filters = self._read(f"filters/{number}")
        nothing = [F.lit(None).cast(live.schema[c].dataType).alias(c) for c in ("doc_id", "mark", "key")]
        stream = filters.select("shard", "packed", *nothing).unionByName(
            others.select(_shard(bits).alias("shard"), F.lit(None).cast("binary").alias("packed"), "doc_id", "mark", "key")
        )
        # A shard's filter comes first, then its references in batches of bounded size.
        dealt = stream.repartition("shard").sortWithinPartitions("shard", F.col("packed").isNull())

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard, known = None, None
            for batch in batches:
                shards = batch.column(0).to_numpy()
                starts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist()] if len(shards) else []
                for start, stop in zip(starts, [*starts[1:], len(shards)]):
                    part = batch.slice(start, stop - start)
                    if shards[start] != shard:
                        shard, known = shards[start], CuckooFilter.unpack(part.column(1)[0].as_py())
                        part = part.slice(1)
                    if part.num_rows:
                        may = part.filter(pa.array(known.may_hold(part.column(4).to_pylist())))
                        yield may.select(["doc_id", "mark", "key"])

        maybe = dealt.mapInArrow(probe, live.select("doc_id", "mark", "key").schema)
        rest = maybe.join(repeated, "key").filter("doc_id <> last_id").drop("last_id")
        lost = frequent.select("doc_id", "mark", "key").unionByName(rest.select("doc_id", "mark", "key"))
        return lost.groupBy("doc_id", "mark").agg(F.collect_set("key").alias("keys"))

    def deduplicate(self, docs: DataFrame) -> DataFrame:
        """`docs` without the lines that a later document holds, with `n_lines` and `n_dropped`.

        Documents that are not in the index keep their lines.
        """
        if clash := {c.lower() for c in docs.columns} & {"n_lines", "n_dropped"}:
            raise ValueError(f"columns {sorted(clash)} are added here; rename them first")
        an_id, a_mark, keys = fresh(docs, "doc", "mark", "keys")
        drops = self.drops().toDF(an_id, a_mark, keys)
        marked = docs.withColumn(a_mark, F.xxhash64(self.text))
        drops = drops.withColumnRenamed(a_mark, f"{a_mark}_")
        same = (marked[self.doc_id] == drops[an_id]) & (marked[a_mark] == drops[f"{a_mark}_"])
        joined = marked.join(drops, same, "left").select(*[marked[c] for c in docs.columns], drops[keys])
        place, min_chars = docs.columns.index(self.text), self.min_chars

        def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, place, SLICE_BYTES):
                lost = batch.column(batch.num_columns - 1).to_pylist()
                kept, lines, dropped = [], [], []
                for content, keys in zip(batch.column(place).to_pylist(), lost):
                    if not keys:
                        kept.append(content)
                        lines.append((content or "").count("\n") + 1)
                        dropped.append(0)
                        continue
                    keys, every = {*keys}, content.encode().split(b"\n")
                    stay = [line for line in every if digest_of(line, min_chars) not in keys]
                    kept.append(b"\n".join(stay).decode())
                    lines.append(len(every))
                    dropped.append(len(every) - len(stay))
                columns = [batch.column(k) for k in range(batch.num_columns - 1)]
                columns[place] = pa.array(kept, pa.string())
                added = [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *added], names=schema.names)

        schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
        return joined.mapInArrow(rewrite, schema)
