"""Template matches against a search over all windows, and re-parameterised questions."""

from __future__ import annotations

import random
from collections import defaultdict

from conftest import SF_DIR
from pyspark.sql import functions as F

from tunemart.llm import decontaminate, queries
from tunemart.llm.decontaminate import LITERALS, WINDOW, template

QUESTION = (
    "A train leaves the town of Berlin at 9:30 with 120 passengers and drives 80 km to reach "
    "the city of Potsdam; how many of the 120 passengers leave when Anna meets Berlin officials?"
)
CHANGED = QUESTION.replace("120", "345").replace("Berlin", "Madrid").replace("80 km", "15 miles")
BROKEN = QUESTION.replace("with 120", "with 345").replace("Berlin", "Madrid")


def windows(text):
    """Whether they are of words, and the windows by place."""
    found, values = template(text)
    width = min(WINDOW, len(found))
    out = {}
    for k in range(len(found) - width + 1 if len(found) >= decontaminate.LEAST_WORDS else 0):
        part = tuple(found[k : k + width])
        if sum(not t.startswith("<") for t in part) >= min(LITERALS, width):
            out[k] = (part, tuple(values[k : k + width]))
    return out


def plain_words(text):
    """Words, and before which of them a sentence begins."""
    rows = decontaminate.read(text)
    return [v for _, v, _ in rows], [s for *_, s in rows] + [True]


def holds(text, item):
    """Whether an item without a window stands in a text word by word."""
    (words, starts), (wanted, _) = plain_words(text), plain_words(item)
    n = len(wanted)
    places = [k for k in range(len(words) - n + 1) if n and words[k : k + n] == wanted]
    return any(n >= decontaminate.LEAST_WORDS or starts[k] and starts[k + n] for k in places)


def plain_matches(docs, items, coverage=0.6):
    index = defaultdict(list)
    items = dict(items)
    short = {i: t for i, t in items.items() if not windows(t) and any(c.isalnum() for c in t or "")}
    items = {i: windows(t) for i, t in items.items()}
    for i, own in items.items():
        for k, (part, values) in own.items():
            index[part].append((i, k, values))
    widths = {len(p) for p in index}
    out = set()
    for doc, text in docs:
        out |= {(doc, i) for i, t in short.items() if holds(text, t)}
        found, values = template(text)
        hits = defaultdict(list)
        for w in widths:
            for k in range(len(found) - w + 1):
                for i, p, own in index.get(tuple(found[k : k + w]), ()):
                    hits[i, k - p].append((p, own, values[k : k + w], found[k : k + w]))
        for (i, _), rows in hits.items():
            share = len({p for p, *_ in rows}) / len(items[i])
            pairs = {
                (t, a, b) for _, own, other, kinds in rows for t, a, b in zip(kinds, own, other) if t.startswith("<")
            }
            one = len({(t, a) for t, a, _ in pairs}) == len({(t, b) for t, _, b in pairs}) == len(pairs)
            if share >= coverage and one:
                out.add((doc, i))
    return out


def test_templates():
    found, values = template("The 3 km to Rome cost $4.50. Then Ann ran 10 %!\nDas km")
    assert found == "<name> <number> <unit> to <name> cost <number> <name> ran <number> <unit> <name> km".split()
    assert values[1] == "3" and values[4] == "rome" and values[7] == "then ann"
    found, values = template("In New York twenty-three men met Ann. Tom had two hundred")
    assert found == "<name> <number> men met <name> <name> had <number>".split()
    assert values == ["in new york", "twenty-three", "men", "met", "ann", "tom", "had", "two hundred"]
    assert template(None) == template(" \n ") == ([], [])


def test_reparameterised_questions(spark):
    fill = "some words before it that nobody asks about and more of them here "
    docs = [
        (1, fill + QUESTION + " " + fill),
        (2, fill + CHANGED),
        (3, fill + BROKEN),
        (4, fill * 20),
        (5, " ".join(QUESTION.split()[:10]) + " " + fill),
        (6, None),
        (7, ""),
        (8, QUESTION.upper().replace("BERLIN", "Berlin").replace("POTSDAM", "Potsdam").replace("ANNA", "Anna")),
        (None, QUESTION),
        (9, QUESTION),
        (9, QUESTION),
        (10, fill * 5000 + CHANGED),
        (11, "short one here too now"),
    ]
    items = [(1, QUESTION), (2, "short one here too now"), (3, None), (4, "too short"), (5, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("code", F.lit("clash"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.matches(df, benchmark).collect()}
    assert set(found) == {(k, 1) for k in (1, 2, 8, None, 9, 10)} | {(11, 2)}
    assert found[1, 1].exact and not found[2, 1].exact and not found[10, 1].exact
    kept = decontaminate.clean(df, benchmark)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7]
    none = benchmark.filter("false")
    assert decontaminate.matches(df, none).count() == 0
    assert decontaminate.clean(df, none).count() == len(docs)
    assert decontaminate.matches(df.filter("false"), benchmark).count() == 0


STORIES = (
    "{a} has {m} apples. {a} gives {n} apples to {b}. {b} eats {k} of the apples and then asks how many are left.",
    "A train goes from {p} to the old city of {q} in {m} hours. How fast does the train go if the way to {q} is {n} km long?",
    "A farmer has {x} cows and buys {y} more cows on the market. Then {a} sells {k} of them. How many cows are there now?",
)
NAMES = "Tom Anna Ben Mary Igor Chloe".split() + ["Jean Paul", "Mary Ann"]
PLACES = ["Paris", "Rome", "New York", "San Francisco", "Oslo", "Rio de Janeiro", "Bonn"]
SPELLED = "two seven twelve thirty-one nine".split() + ["two hundred"]


def story(rng, k):
    (a, b), (p, q), (x, y) = rng.sample(NAMES, 2), rng.sample(PLACES, 2), rng.sample(SPELLED, 2)
    m, n, k_ = rng.sample(range(2, 900), 3)
    return STORIES[k].format(a=a, b=b, p=p, q=q, x=x, y=y, m=m, n=n, k=k_)


def test_recall_of_reparameterised_items(spark):
    rng = random.Random(5)
    items = [(k, story(rng, k)) for k in range(len(STORIES))]
    fill = "nobody asks about these words here and "
    docs = [(k, fill + story(rng, k % 3) + " " + fill) for k in range(150)]
    docs += [(1000 + k, fill * (k + 1)) for k in range(10)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.matches(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert all(r.doc_id < 1000 and r.doc_id % 3 == r.item_id for r in found)
    assert len(found) >= 0.9 * 150


def test_items_without_a_template_are_found_as_they_are(spark):
    items = [(1, "What is 17 * 23?"), (2, "Who is Ann?"), (3, "...")]
    docs = [
        (1, "He asked: what is 17 * 23? Nobody knew."),
        (2, "What is 17 * 24?"),
        (3, "Some text here. Who is Ann? Nobody knew."),
        (4, "They know who is Ann and who is not"),
        (5, "one line\nWho is Ann\nanother line"),
        (6, "... 17 * 23 ..."),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.matches(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (3, 2), (5, 2)} == plain_matches(docs, items)


def test_texts_of_one_id_are_told_apart(spark):
    df = spark.createDataFrame([(1, QUESTION), (1, "a clean text of few words")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    assert [r.text for r in decontaminate.clean(df, benchmark).collect()] == ["a clean text of few words"]


def test_query(spark):
    docs, items = (
        [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/{name}.parquet").select(key, "text").collect()]
        for name, key in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    found = queries.op9_template_leaks(spark, SF_DIR).collect()
    wanted = plain_matches(docs, items)
    assert wanted and {(r.doc_id, r.item_id) for r in found} == wanted and len(found) == len(wanted)
