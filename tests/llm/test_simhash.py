"""SimHash groups against a comparison of all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from conftest import SF_DIR
from pyspark.sql import functions as F

from tunemart.llm import queries, simhash


def plain_fingerprint(text, shingle=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    found = [xxhash.xxh64_intdigest(" ".join(words[k : k + shingle]).encode(), 42) for k in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def plain_groups(prints):
    """Smallest key reachable, by key, over all pairs within two bits."""
    keys = sorted(prints)
    values = np.array([prints[k] for k in keys], np.uint64)
    label = list(range(len(keys)))

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for k in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= 2):
            a, b = sorted((top(k), top(int(j))))
            label[b] = a
    return {keys[k]: keys[top(k)] for k in range(len(keys))}


def test_golay_code():
    words = simhash.golay_codewords()
    assert len(np.unique(words)) == 4096
    assert np.bitwise_count(words[1:]).min() == 7
    rng = np.random.default_rng(1)
    some = rng.integers(0, 1 << 23, 200, dtype=np.uint32)
    table = simhash.golay_decoder()
    assert np.bitwise_count(words[table[some]] ^ some).max() <= 3
    rows, _ = simhash.golay_keys(some)
    assert {*np.bincount(rows).tolist()} <= {1, 6}


def test_keys_meet_within_two_bits():
    rng = random.Random(3)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for _ in range(rng.randrange(3)):
            b ^= 1 << rng.randrange(64)
        fps = np.array([a, b], np.uint64).view(np.int64)
        rows, keys = simhash.fingerprint_keys(fps)
        assert {*keys[rows == 0]} & {*keys[rows == 1]}


        # So do the finer keys of every key that both have.
        both, finer = simhash.finer_keys(fps[rows], keys)
        for key in {*keys[rows == 0]} & {*keys[rows == 1]}:
            meet = [{*finer[(rows[both] == k) & (keys[both] == key)]} for k in (0, 1)]
            assert meet[0] & meet[1]


def test_key_rows():
    fps = np.random.default_rng(4).integers(-(2**63), 2**63, 5_000, dtype=np.int64)
    rows, keys = simhash.fingerprint_keys(fps)
    assert np.bincount(rows).max() <= 18
    assert len({*zip(rows.tolist(), keys.tolist())}) == len(rows)


@pytest.mark.parametrize("crowd", [1, 3, 10, 64])
def test_crowded_keys(spark, crowd):
    rng = random.Random(crowd)
    base = rng.getrandbits(64)
    # Alike in one segment, and in all but some bits of the others.
    values = {base ^ sum(1 << b for b in rng.sample(range(22, 64), rng.randrange(6))) for _ in range(300)}
    values |= {rng.getrandbits(64) for _ in range(50)}
    fps = {k: int(np.uint64(v).view(np.int64)) for k, v in enumerate(sorted(values))}
    df = spark.createDataFrame([(v,) for v in fps.values()], "fp long")
    found = [tuple(r) for r in simhash.links(df, 2, crowd).collect()]
    assert len({*found}) == len(found)
    assert crowd < 64 or all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in found)
    label = {v: v for v in fps.values()}
    while True:
        before = dict(label)
        for a, b in found:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    plain = plain_groups(dict(enumerate(sorted(values))))
    groups = {}
    for k, v in fps.items():
        groups.setdefault(plain[k], set()).add(label[v])
    assert all(len(g) == 1 for g in groups.values()) and len({*label.values()}) == len(groups)


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_links_of_chains_and_crowds(spark, distance):
    rng = random.Random(distance)
    prints = [rng.getrandbits(64) for _ in range(40)]
    chain = [rng.getrandbits(64)]
    for k in range(30):
        chain.append(chain[-1] ^ (1 << (2 * k)) ^ (1 << (2 * k + 1)))
    crowd = [chain[0] ^ (1 << 63) ^ (1 << k) for k in range(40)]
    values = {k: v for k, v in enumerate({*prints, *chain, *crowd, 0, 3, (1 << 64) - 1})}
    rows = [(k, int(np.uint64(v).view(np.int64))) for k, v in values.items()]
    marked = spark.createDataFrame(rows, "doc_id long, fp long")
    found = {r.fp: r.component_id for r in simhash.components(marked, distance).collect()}
    wanted = {}
    label = {k: k for k in values}
    for _ in values:
        for k, v in values.items():
            near = [j for j, w in values.items() if (v ^ w).bit_count() <= distance]
            label[k] = min(label[j] for j in near)
    for k, fp in rows:
        wanted[fp] = label[k]
    assert found == wanted


def test_cases(spark):
    texts = [None, "", " \n", "One", "one", "a b", "A  b\t", "a b c d", "long " * 50_000, "a b"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "lone text here now"), (3, "One")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    found = simhash.near_duplicates(df).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(k) for k, _ in rows)
    by_id = {r.doc_id: r for r in found}
    for k, t in rows:
        assert by_id[k].fp == int(np.uint64(plain_fingerprint(t)).view(np.int64))
    assert [by_id[k].component_id for k in (0, 1, 2, 3, 4, 5, 6, 9)] == [0, 0, 0, 3, 3, 5, 5, 5]
    assert by_id[None].component_id is None
    kept = simhash.deduplicate(df).collect()
    assert len(kept) == len({(r.component_id, r.fp if r.component_id is None else 0) for r in found})
    assert kept[0].asDict().keys() == {"doc_id", "text", "fp"}
    assert simhash.near_duplicates(df.filter("false")).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    prints = {k: plain_fingerprint(t) for k, t in texts.items()}
    wanted = {(k, f"{prints[k]:016x}", g) for k, g in plain_groups(prints).items()}
    assert {tuple(r) for r in queries.op6_simhash_golay(spark, SF_DIR).collect()} == wanted
