"""Content-defined chunks, and repeated passages against a plain version."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from conftest import SF_DIR
from pyspark.sql import functions as F

from tunemart.llm import queries, substring_dedup
from tunemart.llm.substring_dedup import MASK_BITS, MAX_CHUNK, MIN_CHUNK, WINDOW, cut, repeated_passages

FOX = "die Füchse und Bären sprangen über kleine Bäche, während ältere Hasen ruhig schliefen "


def plain_cuts(text):
    """Ends of the chunks of one text, byte by byte."""
    table = substring_dedup.gear()
    places = []
    for i in range(len(text)):
        h = 0
        for b in text[max(0, i - WINDOW + 1) : i + 1]:
            h = (h * 2 + int(table[b])) & 0xFFFF
        here = i + 1
        if h >> (16 - MASK_BITS) == 0 and WINDOW <= here < len(text) and text[here] & 0xC0 != 0x80:
            places.append(here)
    ends = [p for p, q in zip(places, [-(10**9), *places]) if p - q >= MIN_CHUNK] + [len(text)] * bool(text)
    out, last = [], 0
    for end in ends:
        for forced in range(last + MAX_CHUNK, end, MAX_CHUNK):
            while text[forced] & 0xC0 == 0x80:
                forced -= 1
            out.append(forced)
        out.append(end)
        last = end
    return out


def plain_passages(docs, min_bytes=substring_dedup.MIN_BYTES):
    chunks, first = [], {}
    for doc, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        text, at, had = (text or "").encode(), 0, set()
        for end in plain_cuts(text):
            chunk = text[at:end]
            order = (doc is None, doc or 0)
            repeated = chunk in had or (chunk in first and first[chunk] != order)
            first.setdefault(chunk, order)
            had.add(chunk)
            chunks.append((doc, text, at, end, repeated))
            at = end
    runs = defaultdict(list)
    for doc, text, start, end, repeated in chunks:
        own = runs[doc, text]
        if repeated and own and own[-1][1] == start:
            own[-1][1] = end
        elif repeated:
            own.append([start, end])
    return {(d, a, b) for (d, _), own in runs.items() for a, b in own if b - a >= min_bytes}


def random_text(rng, n):
    return " ".join("".join(rng.choice("abcdefghiäß") for _ in range(rng.randrange(1, 9))) for _ in range(n))


def test_cuts_equal_the_plain_version_and_come_back():
    rng = random.Random(1)
    texts = [random_text(rng, n).encode() for n in (0, 1, 5, 400, 3000)]
    texts += [b"a" * 2000, ("é" * 1000).encode(), b"", FOX.encode() * 3]
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array(list(map(len, texts)))
    ends = substring_dedup.cut_places(data, lengths)
    wanted = [start + e for start, t in zip(np.cumsum(lengths) - lengths, texts) for e in plain_cuts(t)]
    assert ends.tolist() == wanted
    passage = random_text(rng, 200).encode()
    own = set(plain_cuts(passage))
    for front in (b"", b"x", random_text(rng, 50).encode() + b" "):
        moved = {e - len(front) for e in plain_cuts(front + passage)}
        lost = [e for e in own ^ moved if e > WINDOW + MIN_CHUNK]
        assert not lost


def test_repeated_passages_and_cutting(spark):
    rng = random.Random(2)
    shared = random_text(rng, 60)
    docs = [
        (5, random_text(rng, 40) + " " + shared + " " + random_text(rng, 30)),
        (2, random_text(rng, 10) + " " + shared),
        (9, shared + " " + random_text(rng, 20) + " " + shared),
        (3, random_text(rng, 500)),
        (4, None),
        (6, ""),
        (7, random_text(rng, 100)),
        (None, shared),
        (8, "x" * 3000),
    ]
    docs += [(11, docs[6][1]), (12, random_text(rng, 20_000))]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit("clash"))
    found = repeated_passages(df)
    rows = found.collect()
    assert {(r.doc_id, r.start_byte, r.end_byte) for r in rows} == plain_passages(docs)
    assert {r.doc_id for r in rows} >= {5, 9, None, 11} and not {r.doc_id for r in rows} & {2, 3, 4, 6, 7, 12}
    assert {r.doc_id: r.first_ids for r in rows}[5] == [2]
    out = cut(df, found)
    assert out.columns == df.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert len(texts) == len(docs)
    for doc, text in docs:
        if doc in (2, 3, 4, 6, 7, 12):
            assert texts[doc] == text
        elif doc != 8:
            assert len(texts[doc]) < len(text) and {*texts[doc].split()} <= {*text.split()}
    assert texts[11] == ""
    assert sum(len(t or "") for t in texts.values()) < sum(len(t or "") for _, t in docs)


def test_rows_of_one_id(spark):
    rng = random.Random(3)
    text, other = random_text(rng, 90), random_text(rng, 90)
    rows = [(1, text), (1, text), (1, other), (2, other + " " + text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeated_passages(df)
    assert {r.doc_id for r in found.collect()} == {2}
    assert sorted(r.text for r in cut(df, found).collect() if r.doc_id == 1) == sorted([text, text, other])


def test_texts_without_id_keep_apart(spark):
    """Two texts whose hashes agree in their first 20 bits, one with a passage that another has."""
    rng = random.Random(4)
    shared, marks = random_text(rng, 60), {}
    while True:
        clean, other = random_text(rng, 90), f"{random_text(rng, 30)} {shared}"
        marks[xxhash.xxh64_intdigest(other.encode(), 42) >> 44] = other
        if twin := marks.get(xxhash.xxh64_intdigest(clean.encode(), 42) >> 44):
            break
    rows = [(1, shared), (None, clean), (None, twin)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [r.text for r in cut(df, repeated_passages(df)).collect()]
    assert clean in texts and shared in texts and twin not in texts


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert cut(empty, repeated_passages(empty)).count() == 0


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op1_repeated_passages(spark, SF_DIR).collect()
    assert {(r.doc_id, r.start_byte, r.end_byte) for r in rows} == plain_passages(docs)


def test_texts_of_a_large_batch_are_cut_a_slice_at_a_time():
    texts = ["abc " * 256 * 1024] * 20
    spans = [None, [{"start_byte": 0, "end_byte": 4}]] * 10
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(texts), pa.array(spans)], names=["doc_id", "text", "spans"])
    parts = list(substring_dedup._without_spans([batch], 1))
    assert max(sum(map(len, p.column(1).to_pylist())) for p in parts) <= substring_dedup.SLICE
    kept = [n for p in parts for n in map(len, p.column(1).to_pylist())]
    assert [p.schema.names for p in parts] == [["doc_id", "text"]] * len(parts)
    assert len(kept) == 20 and kept[0] == 2**20 and kept[1] < 2**20
