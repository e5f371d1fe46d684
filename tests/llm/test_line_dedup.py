"""The line index against plain Python; the query is compared with SQL in test_llm_sql.py."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from tunemart import scratch
from tunemart.llm import line_dedup
from tunemart.llm.line_dedup import CuckooFilter, LineIndex

SCHEMA = "doc_id long, text string"


def key_of(line):
    key = line.strip(" \t\n\v\f\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in key)


def by_hand(rows, live=None, min_docs=3, min_chars=20):
    """{(doc_id, text): (lines, dropped, kept text)} with the documents `live` in the index."""
    holders = defaultdict(set)
    for doc, text in rows if live is None else live:
        for line in (text or "").split("\n"):
            if doc is not None and len(key_of(line)) >= min_chars:
                holders[key_of(line)].add(doc)
    found = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [
            x for x in lines
            if doc is None or doc not in holders[key_of(x)] or len(holders[key_of(x)]) < min_docs or doc == max(holders[key_of(x)])
        ]
        found[doc, text] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return found


def texts(n, seed):
    rng = random.Random(seed)
    lines = [f"{'Common' if i % 3 else 'ÄÖ common'} line number {i} of the corpus" for i in range(30)] + ["short", "", "   "]
    made = []
    for doc in range(n):
        own = [f"this line stands in document {doc} alone {i}" for i in range(rng.randint(0, 3))]
        some = [rng.choice(["  {}\t", "{}", "{}\r"]).format(x) for x in rng.sample(lines, rng.randint(0, 8))]
        made.append((doc, "\n".join(rng.sample(own + some, len(own + some)))))
    return made


def kept(index, docs):
    return sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in index.deduplicate(docs).collect())


def expected(rows, live=None):
    found = by_hand(rows, live)
    return sorted((d, *found[d, t][:2], found[d, t][2]) for d, t in rows)


@pytest.fixture
def folder(spark):
    with scratch.scope():
        yield lambda: scratch.new_folder(spark, "lines")


def test_one_commit(spark, folder):
    rows = texts(200, 1)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    index = LineIndex(spark, folder(), shard_keys=16)
    index.commit("a", added=docs)
    assert index.batches()[0][2] > 2  # several shards
    assert kept(index, docs) == expected(rows)


def test_very_frequent_lines_go_to_all_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(line_dedup, "HEAVY_LEAST", 20)
    rows = texts(150, 2)
    docs = spark.createDataFrame(rows, SCHEMA)
    index = LineIndex(spark, folder(), shard_keys=16)
    index.commit("a", added=docs)
    assert kept(index, docs) == expected(rows)


def test_insert_delete_and_back(spark, folder):
    rows = texts(160, 3)
    frame = lambda part: spark.createDataFrame(part, SCHEMA)
    first, second = rows[:90], rows[90:]
    index = LineIndex(spark, folder(), shard_keys=16)
    index.commit("1", added=frame(first))
    before = kept(index, frame(first))
    counts = sorted(map(tuple, index.counts().collect()))
    assert before == expected(first)
    index.commit("2", added=frame(second + first[:10]))  # ten are known already
    assert kept(index, frame(rows)) == expected(rows)
    index.commit("2", added=frame([(999, rows[0][1])]))  # a repeated batch does nothing
    assert kept(index, frame(rows)) == expected(rows)
    # Documents go, those with the largest ids among them; unknown ones don't matter.
    index.commit("3", removed=frame([*second, (12345, "x")]))
    assert kept(index, frame(first)) == before
    assert sorted(map(tuple, index.counts().collect())) == counts
    # Some come back with other texts, in one commit with a removal.
    changed = [(d, rows[d - 30][1]) for d, _ in first[:20]]
    live = first[20:] + changed
    index.commit("4", removed=frame(first[:20]), added=frame(changed))
    assert kept(index, frame(live)) == expected(live)
    fresh = LineIndex(spark, folder(), shard_keys=16)
    fresh.commit("all", added=frame(live))
    assert sorted(map(tuple, index.counts().collect())) == sorted(map(tuple, fresh.counts().collect()))


def test_an_aborted_commit_leaves_nothing(spark, folder, monkeypatch):
    rows = texts(60, 4)
    docs = spark.createDataFrame(rows, SCHEMA)
    index = LineIndex(spark, folder())
    index.commit("1", added=spark.createDataFrame(rows[:40], SCHEMA))
    before = kept(index, docs)
    with monkeypatch.context() as broken:
        broken.setattr(LineIndex, "_filters", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            index.commit("2", added=docs)
    assert kept(index, docs) == before
    index.commit("2", added=docs)
    assert kept(index, docs) == expected(rows)


def test_cases(spark, folder):
    line, other = "A line of twenty or more", "Ünd noch eine gute Zeile"
    rows = [
        (None, line),
        (None, f"{line}\n{line}"),
        (1, f"{line}\nx\n  {line.upper()}"),
        (2, f"{line}\n{other}"),
        (2, f"{line}\n{other}"),
        (3, line),
        (3, f"other text of the same id\n{line}\n{other}"),
        (4, None),
        (5, ""),
        (6, "\n\n"),
        (7, other.replace("Ü", "ü")),  # only A-Z is lowered: another key
        (8, f"{line}\n" * 3000 + "x" * 100_000),
        (9, "é" * 19),
        (10, "é" * 19),
        (11, "é" * 19),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("1 AS keys", "doc_id", "2 AS mark", "text", "3 AS key", "4 AS doc")
    index = LineIndex(spark, folder())
    index.commit("all", added=docs)
    found = index.deduplicate(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    got = sorted((repr(r.doc_id), r.n_lines, r.n_dropped, r.text or "") for r in found.collect())
    hand = by_hand(rows)
    assert got == sorted((repr(d), *hand[d, t]) for d, t in rows)
    with pytest.raises(ValueError, match="n_lines"):
        index.deduplicate(docs.withColumnRenamed("mark", "N_Lines"))


def test_empty_table_and_first_removal(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    index = LineIndex(spark, folder())
    with pytest.raises(ValueError):
        index.commit("0", removed=docs)
    index.commit("1", added=docs)
    assert index.deduplicate(docs).collect() == []
    some = spark.createDataFrame([(d, "one line that all of them hold") for d in range(4)], SCHEMA)
    index.commit("2", added=some)
    assert sorted(r.n_dropped for r in index.deduplicate(some).collect()) == [0, 1, 1, 1]


def test_cuckoo_filter_inserts_deletes_and_stashes():
    rng = np.random.default_rng(5)
    keys = [rng.bytes(16) for _ in range(3000)]
    made = CuckooFilter.sized(len(keys))
    made.insert(keys)
    made = CuckooFilter.unpack(made.pack())
    assert made.may_hold(keys).all() and made.n == 3000
    strangers = [rng.bytes(16) for _ in range(20_000)]
    assert made.may_hold(strangers).mean() < 0.002
    made.delete(keys[:1500])
    assert made.may_hold(keys[1500:]).all() and made.may_hold(keys[:1500]).mean() < 0.01
    made.delete(keys[1500:])
    assert not made.slots.any() and not made.stash and made.n == 0
    # Many more keys than slots: the rest is kept beside them and can be taken out again.
    tight = CuckooFilter.sized(8)
    tight.insert(keys[:40])
    assert tight.stash and CuckooFilter.unpack(tight.pack()).may_hold(keys[:40]).all()
    tight.delete(keys[:40])
    assert not tight.slots.any() and not tight.stash
