"""The pipeline, stage by stage, on a table with a bit of everything."""

from __future__ import annotations

import random

import public_tokenizers as public
import pytest
import tiktoken
from conftest import SF_DIR
from pyspark.sql import functions as F
from test_decontaminate import plain_matches
from test_simhash import plain_fingerprint, plain_groups
from test_substring_dedup import plain_passages

import corpus_pipeline
from tunemart import scratch
from tunemart.llm import bpe, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into and comes out of each stage, on documents and some odd rows."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(300)
    first = docs.first()
    odd = [(5001, None), (5002, ""), (5003, "12 34"), (5004, first.text), (None, "the and of that in " * 30)]
    odd += [(5005, "zqxj vkqz " * 300)]
    more = spark.createDataFrame([(k, t, None, None, None) for k, t in odd], SCHEMA)
    extra = docs.select(*[f.split()[0] for f in SCHEMA.split(", ")]).unionByName(more)
    now = scratch.materialize(extra.withColumn("fp", F.lit("x")).withColumn("spans", F.lit(1)), "docs")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = scratch.materialize(stage(spark, now, SF_DIR), "stage")
        seen.append((name, now, out))
        now = out
    return seen


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    assert len(stages) == 5
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_language(stages):
    _, before, after = stages[0]
    gone = texts(before).keys() - texts(after).keys()
    assert gone >= {5001, 5002, 5003} and len(gone) <= 6


def test_near_duplicates(stages):
    _, before, after = stages[1]
    prints = {k: plain_fingerprint(t) for k, t in texts(before).items() if k is not None}
    wanted = {*plain_groups(prints).values()}
    assert texts(after).keys() - {None} == wanted and after.count() == after.distinct().count()


def test_substrings(stages):
    _, before, after = stages[2]
    old, new = texts(before), texts(after)
    assert old.keys() == new.keys()
    touched = {d for d, _, _ in plain_passages(list(old.items()))}
    assert {k for k in old if old[k] != new[k]} == touched
    assert after.filter("n_chars <> length(text)").count() == 0


def test_leaks(stages, spark):
    _, before, after = stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {d for d, _ in plain_matches(list(texts(before).items()), items)}
    assert texts(before).keys() - texts(after).keys() == leaks and leaks


def test_tokens(stages):
    _, before, after = stages[4]
    ranks = queries.vocabulary(public.path("byte_bpe_50k.tiktoken"))
    exact = tiktoken.Encoding("o", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(ranks), special_tokens={})
    old = texts(before)
    rows = after.collect()
    assert len(rows) == len(old)
    for r in random.Random(1).sample(rows, 60):
        assert bpe.unpack(r.ids).tolist() == exact.encode_ordinary(old[r.doc_id] or "")


def test_run(spark):
    found = corpus_pipeline.run(spark, SF_DIR.replace("sf0.01", "sf0.001"))
    assert found.count() > 50
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        empty = scratch.materialize(stage(spark, empty, SF_DIR), "empty")
        assert empty.count() == 0
