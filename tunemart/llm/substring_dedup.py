"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last 16 bytes names places where a text may be cut. A cut is made
at such a place if there is none within the MIN_CHUNK bytes before it, so that cuts depend on
the bytes around them only: after an insertion, or inside a passage that stands in another
text, the same cuts come back. Chunks are compared by a 64-bit digest that covers their length.

A chunk is repeated if a document with a smaller id, or an earlier place of its own document,
has it too. Repeated chunks in a row form a run; a run of at least `min_bytes` is a repeated
passage. Its first occurrence stays, the others can be cut out. Runs are the reason why 64 bits
are enough: chunks of chance do not stand in a row.

Defined cases: NULL and empty texts have no chunks; a text without any place to cut is cut every
MAX_CHUNK bytes; documents of one id count as one, so that neither loses what it shares with
the other, and equal rows are treated alike; a NULL id comes after all others, and rows without
one count as one document as well. Texts of one id are told apart by 96 bits of their hashes. An
empty table gives an empty one; columns beyond id and text pass through `cut`, whatever their
names. No cut falls inside a UTF-8 character, none of those made by `cut` inside a word.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunemart.llm.common import fresh, slices

WINDOW = 16  # bytes that the rolling hash sees: its bits
MASK_BITS = 4  # one place in 2^4 may be a cut
MIN_CHUNK, MAX_CHUNK = 16, 256
MIN_BYTES = 80
SLICE = 4 * 1024**2
SIZE_BITS = 10

CHUNKS = "doc_id long, mark long, crc int, at long, again boolean, digest long"


@lru_cache(maxsize=1)
def gear() -> np.ndarray:
    """A number for each byte value, from a digest of the value."""
    made = [hashlib.blake2b(bytes([b]), digest_size=2).digest() for b in range(256)]
    return np.frombuffer(b"".join(made), "<u2").astype(np.uint16)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """h(i) = 2 h(i-1) + gear(byte i) in 16 bits, for all places at once by doubling."""
    h = gear()[data]
    for step in (1, 2, 4, 8):
        longer = h.copy()
        longer[step:] += h[:-step] << np.uint16(step)
        h = longer
    return h


def cut_places(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ends of the chunks of texts that stand one after the other in `data`, ascending."""
    stops = np.cumsum(lengths)
    starts = stops - lengths
    places = np.flatnonzero(rolling_hash(data) >> np.uint16(16 - MASK_BITS) == 0) + 1
    inner = places[places < len(data)]
    inner = inner[data[inner] & 0xC0 != 0x80]
    text = np.searchsorted(stops, inner, "right")
    whole = inner - starts[text] >= WINDOW  # before, the hash sees the text in front
    inner, text = inner[whole], text[whole]
    quiet = np.ones(len(inner), bool)
    quiet[1:] = (inner[1:] - inner[:-1] >= MIN_CHUNK) | (text[1:] != text[:-1])
    ends = np.union1d(inner[quiet], stops[lengths > 0])
    sizes = np.diff(ends, prepend=0)
    for k in np.flatnonzero(sizes > MAX_CHUNK)[::-1]:
        forced = np.arange(ends[k] - sizes[k] + MAX_CHUNK, ends[k], MAX_CHUNK)
        while len(moved := np.flatnonzero(data[forced] & 0xC0 == 0x80)):
            forced[moved] -= 1
        ends = np.insert(ends, k, forced)
    return ends


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, crc, at, again, digest) of every chunk of (doc_id, text).

    `mark` and `crc` are hashes of the whole text, which tell texts of one id apart. `at` packs
    where the chunk starts and its size. `again` says that the document had the chunk before.
    """
    names = [c.split()[0] for c in CHUNKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in slices(batches, "text", SLICE):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            joined = b"".join(texts)
            if not joined:
                continue
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            stops = np.cumsum(lengths)
            ends = cut_places(np.frombuffer(joined, np.uint8), lengths)
            starts = np.concatenate([[0], ends[:-1]])
            spans = zip(starts.tolist(), ends.tolist())
            digests = np.array([digest(joined[a:b], b - a) for a, b in spans], np.uint64).view(np.int64)
            text = np.searchsorted(stops, starts, "right")
            order = np.lexsort((starts, digests, text))
            same = (digests[order][1:] == digests[order][:-1]) & (text[order][1:] == text[order][:-1])
            again = np.zeros(len(order), bool)
            again[order[1:]] = same
            marks = np.array([digest(t, 42) for t in texts], np.uint64).view(np.int64)
            crcs = np.array([zlib.crc32(t) for t in texts], np.uint32).view(np.int32)
            at = (starts - (stops - lengths)[text]) << SIZE_BITS | ends - starts
            ids = batch.column("doc_id").take(pa.array(text))
            found = [pa.array(c) for c in (marks[text], crcs[text], at, again, digests)]
            yield pa.RecordBatch.from_arrays([ids, *found], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, CHUNKS)


def repeated_passages(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """One row per passage that is repeated: (doc_id, text_mark, text_crc, start_byte, end_byte,
    n_chunks, first_ids), `first_ids` being the documents that have its chunks first.

    Chunk rows are counted by digest, which combines copies before the shuffle, and joined to
    the digests that occur more than once; a very frequent digest is split by that join.
    """
    found = chunks(docs)  # cut twice, which takes less room than writing 40 rows a KiB of text
    first = found.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))
    shared = first.filter("n > 1").select("digest", "first_id")
    other = ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    repeated = found.join(shared, "digest").filter(F.col("again") | other)
    start = F.shiftright("at", SIZE_BITS)
    placed = repeated.select(
        "doc_id",
        F.col("mark").alias("text_mark"),
        F.col("crc").alias("text_crc"),
        start.alias("start_byte"),
        (start + F.col("at").bitwiseAND(F.lit((1 << SIZE_BITS) - 1))).alias("end_byte"),
        "first_id",
    ).distinct()
    # One text's chunks come together, which its length bounds.
    one_text = ("doc_id", "text_mark", "text_crc")
    text = Window.partitionBy(*one_text).orderBy("start_byte")
    begins = (F.lag("end_byte").over(text).eqNullSafe(F.col("start_byte"))).cast("int")
    runs = placed.withColumn("begins", 1 - begins).withColumn("run", F.sum("begins").over(text))
    first_ids = F.array_sort(F.collect_set(F.struct("first_id")))  # NULL is an id, too
    passages = runs.groupBy(*one_text, "run").agg(
        F.min("start_byte").alias("start_byte"),
        F.max("end_byte").alias("end_byte"),
        F.count("*").alias("n_chunks"),
        F.transform(first_ids, lambda x: x["first_id"]).alias("first_ids"),
    )
    return passages.filter(F.col("end_byte") - F.col("start_byte") >= min_bytes).drop("run")


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without spans, each drawn in to whole words."""
    kept, at = [], 0
    for start, end in sorted(spans):
        while 0 < start < end and text[start - 1 : start].strip() and text[start : start + 1].strip():
            start += 1
        while start < end < len(text) and text[end - 1 : end].strip() and text[end : end + 1].strip():
            end -= 1
        if 0 < start < end < len(text) and text[start - 1 : start].strip() and text[end : end + 1].strip():
            end -= 1  # the white space before the next word
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]])


def _without_spans(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    """Batches without their last column, the spans to be cut from the texts at `place`.

    Texts are taken a slice at a time: a batch of them may hold many times a slice.
    """
    for batch in batches:
        for part in slices([batch], place, SLICE):
            found = zip(part.column(place).to_pylist(), part.column(part.num_columns - 1).to_pylist())
            texts = [
                without(t.encode(), [(s["start_byte"], s["end_byte"]) for s in spans]).decode() if spans else t
                for t, spans in found
            ]
            columns = list(part.columns[:-1])
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1])


def cut(docs: DataFrame, passages: DataFrame, text: str = "text") -> DataFrame:
    """The documents, all columns, their texts without the passages found in them."""
    [spans_name] = fresh(docs, "spans")
    own = ("doc_id", "text_mark", "text_crc")
    spans = passages.groupBy(*[F.col(c).alias(f"_{c}") for c in own]).agg(
        F.collect_list(F.struct("start_byte", "end_byte")).alias(spans_name)
    )
    content = F.coalesce(docs[text], F.lit(""))
    # The 32 bits as a signed number, as the chunks have them.
    crc = F.shiftright(F.shiftleft(F.crc32(content.cast("binary")), 32), 32)
    mark = F.xxhash64(content)
    same = (
        docs["doc_id"].eqNullSafe(spans["_doc_id"]) & (mark == spans["_text_mark"]) & (crc == spans["_text_crc"])
    )
    joined = docs.join(spans, same, "left").select(*[docs[c] for c in docs.columns], spans[spans_name])
    place = docs.columns.index(text)
    return joined.mapInArrow(lambda batches: _without_spans(batches, place), docs.schema)
