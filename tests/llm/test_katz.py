"""Katz backoff against dictionaries, text by text."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunemart.llm import katz
from tunemart.llm.common import fold


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</s>"]


def discounts(counts):
    seen = [sum(c == r for c in counts.values()) for r in range(1, 7)]
    return seen, katz.good_turing(seen)


def brute_force(rows, trained):
    """Scores by the textbook, and chances after a word for the test of normalisation."""
    texts = [words_of(t) for (_, t), k in zip(rows, trained) if k]
    unigrams = Counter(w for t in texts for w in t)
    pairs = Counter(p for t in texts for p in zip(["<s>", *t], t))
    n = sum(unigrams.values())
    seen, factor = discounts(unigrams)
    _, pair_factor = discounts(pairs)
    rest = n - sum(factor[min(c, 6)] * c for c in unigrams.values())
    size = n if rest > 1e-12 else n + 1
    unknown = (rest if rest > 1e-12 else 1.0) / size

    def alone(w):
        c = unigrams[w]
        return factor[min(c, 6)] * c / size if c else unknown

    after = {}
    for (h, w), c in pairs.items():
        after.setdefault(h, {})[w] = c

    def chance(h, w):
        own = after.get(h)
        if not own:
            return alone(w)
        total = sum(own.values())
        mass = sum(pair_factor[min(c, 6)] * c for c in own.values())
        divisor = total if total - mass > 1e-9 * total else total + 1
        if w in own:
            return pair_factor[min(own[w], 6)] * own[w] / divisor
        return (1 - mass / divisor) / (1 - sum(map(alone, own))) * alone(w)

    out = {}
    for i, t in rows:
        found = words_of(t)
        out[i] = (
            len(found),
            sum(unigrams[w] > 0 for w in found),
            n,
            sum(math.log10((unigrams[w] + 0.1) / (n + 0.1 * (len(unigrams) + 1))) for w in found),
            sum(math.log10(chance(h, w)) for h, w in zip(["<s>", *found], found)),
        )
    return out, unigrams, after, chance


def check(spark, rows):
    trained = [i is not None and zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = katz.scores(df, fold(F.col("doc_id"), 10) != 0).collect()
    wanted = brute_force(rows, trained)[0]
    assert len(found) == len(rows)
    for r in found:
        n_tokens, n_known, n, base, score = wanted[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(score, rel=1e-9, abs=1e-9)


def sample(sf_dir="/root/testdata/sf0.001"):
    import pyarrow.parquet as pq

    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"])
    return [tuple(r.values()) for r in table.to_pylist()]


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(katz, "SLICE", 50_000)  # several blocks
    monkeypatch.setattr(katz, "SHARD_KEYS", 5_000)  # several shards
    check(spark, sample())


@pytest.mark.parametrize(
    "texts",
    [
        [None, "", "  \n\t ", "a", "A a", "a a a b", "\x0bé É\x0c é", "x" * 5000],
        ["one two three"] * 30,
        [" ".join(["hot"] * 3000), "hot hot cold", "cold"],
        ["", None],
    ],
)
def test_cases(spark, texts):
    check(spark, list(enumerate(texts)))


def test_empty_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert katz.scores(empty, F.lit(True)).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string, score string".rsplit(",", 1)[0])
    found = katz.scores(rows, fold(F.col("doc_id"), 10) != 0).collect()
    assert [(r.doc_id, r.train_tokens, r.score) for r in found] == [(None, 0, 0.0)] * 2


def test_chances_add_up_to_one():
    rows = sample()
    _, unigrams, after, chance = brute_force(rows, [True] * len(rows))
    for h in [*list(after)[:20], "never seen"]:
        total = sum(chance(h, w) for w in unigrams) + chance(h, "also never seen")
        assert total == pytest.approx(1.0, abs=1e-9)


def test_good_turing_falls_back():
    assert katz.good_turing([0] * 6).tolist() == [0.0] + [1.0] * 6
    factor = katz.good_turing([100, 40, 20, 12, 8, 6])
    assert ((factor[1:6] > 0) & (factor[1:6] < 1)).all() and factor[6] == 1


def test_packing():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    assert (katz.unpack_sorted(katz.pack_sorted(keys)) == keys).all()
    assert katz.unpack(katz.pack(np.zeros(0)), np.float64).size == 0
