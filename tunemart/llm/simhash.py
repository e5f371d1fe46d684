"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

A fingerprint's 64 bits are cut into three segments. Two fingerprints that differ in at most
two bits agree on one segment whole, and differ in at most two bits on any other. The (23, 12)
Golay code gives a segment few keys such that segments within two bits share one: the codeword
numbers to which the segment and its 23 neighbours decode. So a key is one segment as it is and
a codeword number of the next, and linked fingerprints share one of their 3 to 18 keys.

Fingerprints are joined by key and verified by counting the bits in which they differ. Pairs are
listed only among the fingerprints of keys that few share. Where more than CROWD of them share
one, each gets finer keys: the same one with the codeword numbers of the remaining segment,
in which linked fingerprints are within two bits as well. What is crowded even then, thousands of
different fingerprints all alike but for a few bits, is linked without pairs: two fingerprints are
within two bits exactly if some 64-bit word is within one bit of both, so each is joined to its
65 such words, and all that meet at a word are linked to the smallest there. All three ways find
every link's end points in one component, and link nothing else.

Defined cases: NULL and empty texts, and such without words, have fingerprint zero, linked like
any other; copies share a fingerprint, and only different ones are searched; a NULL id stays a
row of its own and is no component's smallest id unless there is no other, which gives NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemart import scratch
from tunemart.llm.common import fresh, slices
from tunemart.llm.components import connected_components

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
GOLAY_LENGTH, GOLAY_DATA = 23, 12
# Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the (23, 12) Golay code.
GOLAY_POLYNOMIAL = 0b110001110101
MOST_DISTANCE = 2
CROWD = 64  # fingerprints of a key that are compared as pairs, at most

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def text_fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bits that are set in over half of the hashes of a text's shingles, repeats included."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: max(1, len(words) - shingle + 1)].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], "<u8")
    votes = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65_536):
        block = hashes[k : k + 65_536].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", shingle: int = 3, keep=("doc_id",)) -> DataFrame:
    """Columns `keep` and `fp`, the fingerprint as a signed 64-bit integer."""
    if "fp" in keep or "_text" in keep:
        raise ValueError("columns fp and _text are used here; rename them first")
    schema = T.StructType([df.schema[k] for k in keep] + [T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = [text_fingerprint(t, shingle) for t in batch.column("_text").to_pylist()]
            kept = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.int64())], names=schema.names)

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


@lru_cache(maxsize=1)
def golay_codewords() -> np.ndarray:
    """The 4,096 codewords by number: multiples of the generating polynomial, over bits."""
    numbers = np.arange(1 << GOLAY_DATA, dtype=np.uint32)
    words = np.zeros_like(numbers)
    for bit in range(GOLAY_DATA):
        words ^= np.where(numbers >> bit & 1, np.uint32(GOLAY_POLYNOMIAL << bit), np.uint32(0))
    return words


@lru_cache(maxsize=1)
def golay_decoder() -> np.ndarray:
    """The number of the one codeword within three bits, for each of the 2^23 words."""
    single = [0] + [1 << i for i in range(GOLAY_LENGTH)]
    errors = np.unique([a | b | c for a in single for b in single for c in single]).astype(np.uint32)
    table = np.zeros(1 << GOLAY_LENGTH, np.uint16)
    words, numbers = golay_codewords(), np.arange(1 << GOLAY_DATA, dtype=np.uint16)
    for error in errors:
        table[words ^ error] = numbers
    return table


def golay_keys(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, codeword number) for every number to which a word or a neighbour of it decodes.

    Within two bits of a codeword there is one such number, three bits away there are six.
    """
    table = golay_decoder()
    near = np.stack([table[segment]] + [table[segment ^ np.uint32(1 << i)] for i in range(GOLAY_LENGTH)], 1)
    near.sort(axis=1)
    first = np.ones(near.shape, bool)
    first[:, 1:] = near[:, 1:] != near[:, :-1]
    rows, columns = np.nonzero(first)
    return rows, near[rows, columns]


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    words = fps.view(np.uint64)
    return [(words >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.uint32) for at, n in SEGMENTS]


def fingerprint_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): for each segment, itself with the Golay keys of the segment after it."""
    parts = _segments(fps)
    all_rows, all_keys = [], []
    for k, exact in enumerate(parts):
        rows, numbers = golay_keys(parts[(k + 1) % len(parts)])
        key = (k << 34) | (exact[rows].astype(np.int64) << GOLAY_DATA) | numbers
        all_rows.append(rows)
        all_keys.append(key)
    return np.concatenate(all_rows), np.concatenate(all_keys)


def finer_keys(fps: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): each key with the Golay keys of the segment that it leaves out."""
    parts = np.stack(_segments(fps))
    left_out = ((keys >> 34) + 2) % len(parts)
    rows, numbers = golay_keys(parts[left_out, np.arange(len(fps))])
    return rows, (keys[rows] << GOLAY_DATA) | numbers


def _pairs(make, *columns: pa.Array) -> Iterator[pa.RecordBatch]:
    """Batches (fp, key) of what `make` gives for blocks of fingerprints, the first column."""
    arrays = [np.ascontiguousarray(c.to_numpy(zero_copy_only=False), np.int64) for c in columns]
    for k in range(0, len(arrays[0]), 4_096):
        block = [a[k : k + 4_096] for a in arrays]
        rows, keys = make(*block)
        yield pa.RecordBatch.from_arrays([pa.array(block[0][rows]), pa.array(keys)], names=["fp", "key"])


def _neighbours(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, word) for each word within one bit of a fingerprint."""
    flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
    near = (fps.view(np.uint64)[:, None] ^ flips[None, :]).view(np.int64)
    return np.repeat(np.arange(len(fps)), len(flips)), near.ravel()


def _by_golay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _pairs(fingerprint_keys, batch.column("fp"))


def _by_finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _pairs(finer_keys, batch.column("fp"), batch.column("key"))


def _by_neighbour(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _pairs(_neighbours, batch.column("fp"))


def _company(keyed: DataFrame) -> DataFrame:
    """(fp, key, n) of the keys that more than one, namely n, fingerprints have, written."""
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    return scratch.materialize(keyed.join(sizes, "key").select("fp", "key", "n"), "company")


def _verified(company: DataFrame, max_distance: int, crowd: int) -> DataFrame:
    """Pairs (u, v), u < v, within `max_distance` bits at keys that `crowd` share, or fewer."""
    few = company.filter(F.col("n") <= crowd)
    met = few.select("key", F.col("fp").alias("u")).join(few.select("key", F.col("fp").alias("v")), "key")
    near = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_distance)
    return met.filter(near).select("u", "v")


def _met_at_words(crowded: DataFrame, max_distance: int) -> DataFrame:
    """Edges (u, v) of different fingerprints by the words within a bit of them."""
    words = crowded.mapInArrow(_by_neighbour, "fp long, key long")
    if max_distance < 2:
        # Within one bit: one of the two is itself the word where they meet.
        here = crowded.withColumnRenamed("fp", "key")
        return words.join(here, "key", "left_semi").select(F.col("fp").alias("u"), F.col("key").alias("v"))
    met = words.groupBy("key").agg(F.min("fp").alias("v"), F.count("*").alias("n")).filter("n > 1")
    return words.join(met.select("key", "v"), "key").select(F.col("fp").alias("u"), "v")


def links(fps: DataFrame, max_distance: int = MOST_DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Edges (u, v) whose components are those of all different `fp` within `max_distance` bits.

    No edge is listed twice.
    """
    if not 0 <= max_distance <= MOST_DISTANCE:
        raise ValueError(f"max_distance must be 0 to {MOST_DISTANCE}")
    different = fps.select("fp").distinct()
    if not max_distance:
        return different.select(F.col("fp").alias("u"), F.col("fp").alias("v")).filter("false")
    company = _company(different.mapInArrow(_by_golay, "fp long, key long"))
    found = _verified(company, max_distance, crowd)
    crowded = company.filter(F.col("n") > crowd)
    if not crowded.isEmpty():
        company = _company(crowded.mapInArrow(_by_finer, "fp long, key long"))
        found = found.union(_verified(company, max_distance, crowd))
        crowded = company.filter(F.col("n") > crowd)
        if not crowded.isEmpty():
            found = found.union(_met_at_words(crowded.select("fp").distinct(), max_distance))
    return found.filter("u <> v").distinct()


def components(marked: DataFrame, max_distance: int) -> DataFrame:
    """(fp, component_id) for every `fp` of rows (fp, doc_id), which have to be written."""
    roots = connected_components(links(marked, max_distance)).toDF("fp", "root")
    smallest = marked.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    placed = smallest.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = scratch.materialize(placed, "placed")
    named = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return placed.join(named, "root").select("fp", "root", "component_id")


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = 3,
    max_distance: int = MOST_DISTANCE,
) -> DataFrame:
    """One row per document: its id, `fp`, and `component_id`, the smallest id reachable by links."""
    found = fingerprints(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle)
    marked = scratch.materialize(found, "fingerprints")
    by_print = components(marked, max_distance).select("fp", "component_id")
    return marked.join(by_print, "fp").select(F.col("doc_id").alias(doc_id), "fp", "component_id")


def deduplicate(docs: DataFrame, shingle: int = 3, max_distance: int = MOST_DISTANCE) -> DataFrame:
    """One row of `docs`, all columns, for each component: that with the smallest id, of equal
    ids any one."""
    fp, row = fresh(docs, "fp", "row")
    schema = T.StructType(docs.schema.fields + [T.StructField(fp, T.LongType())])
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place):
            found = [text_fingerprint(t, shingle) for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=schema.names)

    marked = docs.mapInArrow(run, schema).withColumn(row, F.monotonically_increasing_id())
    marked = scratch.materialize(marked, "marked")
    thin = marked.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    roots = components(thin.select("doc_id", "fp"), max_distance).select("fp", "root")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    kept = thin.join(roots, "fp").groupBy("root").agg(F.min_by("row", order).alias("row"))
    return marked.join(kept.select(F.col("row").alias(row)), row, "left_semi").select(*docs.columns)
