"""Language identification: probabilities, held-out accuracy, rejection."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from conftest import ROOT, SF_DIR
from pyspark.sql import functions as F

from tunemart.llm import langid, queries


def fit(texts, order=langid.ORDER):
    """A model of {language: texts} without Spark."""
    languages, rows, lang, n = sorted(texts), [], [], []
    for k, name in enumerate(languages):
        back = langid.histories(*langid.to_symbols(texts[name]))
        grams = Counter(zip(*[b.tolist() for b in back[::-1]]))
        rows += grams
        n += grams.values()
        lang += [k] * len(grams)
    return langid.fit(languages, np.array(lang), np.array(rows, np.int64).reshape(-1, order), np.array(n))


def plain_chance(texts, order=langid.ORDER):
    """Interpolated Kneser-Ney of one language, by dictionaries."""
    back = langid.histories(*langid.to_symbols(texts))
    counts = [None] * (order + 1)
    counts[order] = Counter(zip(*[b.tolist() for b in back[::-1]]))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def chance(gram):
        k = len(gram)
        if not k:
            return 1 / (len(counts[1]) + 1)
        own = {g: c for g, c in counts[k].items() if g[:-1] == gram[:-1]}
        if not own:
            return chance(gram[1:])
        ones = sum(c == 1 for c in counts[k].values())
        twos = sum(c == 2 for c in counts[k].values())
        d = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)
        total = sum(own.values())
        return max(own.get(gram, 0) - d, 0) / total + d * len(own) / total * chance(gram[1:])

    return chance


def test_chances_equal_dictionaries_and_add_up():
    texts = {"x": ["abra cadabra", "ab ra"], "y": ["bcd bcd. BCD", "ddd"]}
    model = fit(texts)
    back = langid.histories(*langid.to_symbols(["abra dcb z", "ÄÖ"]))
    found = np.exp(langid.log_chances(model, back))
    for k, name in enumerate(model.languages):
        chance = plain_chance(texts[name])
        for row, gram in zip(found, zip(*[b.tolist() for b in back[::-1]])):
            assert row[k] == pytest.approx(chance(gram), rel=1e-4)
        seen = {s for t in [langid.to_symbols(texts[name])[0]] for s in t.tolist()}
        for head in ((0, 0, 0), tuple(map(ord, "abr")), tuple(map(ord, "zzz"))):
            assert sum(chance((*head, s)) for s in [*seen, -1]) == pytest.approx(1)


def test_symbols():
    found, counts = langid.to_symbols([" A-b  c", "", "12", "É!", "ok "])
    assert "".join(map(chr, found)) == "a b c" + "é " + "ok "
    assert counts.tolist() == [5, 0, 0, 2, 3]


def words(rng, letters, n=60):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(n))


def test_learned_languages_and_rejection(spark):
    rng = random.Random(1)
    alphabets = {"one": "abcdefg", "two": "defghij"}
    rows = [(k, words(rng, alphabets[lang]), lang) for k in range(400) for lang in [("one", "two")[k % 2]]]
    rows += [(1000, "qxzwv kqxzv " * 40, None), (1001, None, "one"), (1002, "12 .. 3", None), (1003, "", None)]
    rows += [(1004, "abc", None), (None, words(rng, "abc"), "never"), (1005, words(rng, "abcdefg", 50_000), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = langid.train(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    assert model.languages == ["one", "two"]
    found = langid.identify(docs, model).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[k].lang_pred == lang and not by_id[k].rejected for k, _, lang in rows[:400])
    assert by_id[1000].rejected and by_id[1000].lang_pred in alphabets
    for k in (1001, 1002, 1003):
        assert (by_id[k].lang_pred, by_id[k].score, by_id[k].rejected) == ("und", 0.0, True)
    assert by_id[1005].lang_pred == "one" and not by_id[1004].rejected
    assert all(0 <= r.score <= 1 for r in found)
    kept = langid.without_rejected(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if not r.rejected}


def test_blocks_give_what_whole_texts_give(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab .. 1é\n") for _ in range(n)) for n in (0, 3, 200, 90, 41, 40, 39, 700, 1)]
    texts += [" " * 130 + "ab" + " " * 95 + "ba", "." * 200, "a" * 80 + " "]
    whole = list(langid.blocks(texts))
    assert len(whole) == 1
    model = fit({"x": ["ab abba. b" * 9, "a"], "y": ["é a é", "bé"]})
    entropy, counts, variance = langid.entropies(model, texts)
    symbols, sizes = langid.to_symbols(texts)
    expected = Counter(zip(*[b.tolist() for b in langid.histories(symbols, sizes)]))
    monkeypatch.setattr(langid, "BLOCK", 40)
    parts = list(langid.blocks(texts))
    assert max(len(b[0]) for _, _, b in parts) <= 43 and len(parts) > 20
    assert sum((Counter(zip(*[x.tolist() for x in b])) for _, _, b in parts), Counter()) == expected
    again = langid.entropies(model, texts)
    assert (again[1] == counts).all() and np.allclose(again[0], entropy) and np.allclose(again[2], variance)


def test_query_equals_plain_scores(spark):
    """Language and score of every row of the query, from dictionaries of the same sample."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    rows = docs.withColumn("learn", learn).collect()
    sample = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    out = F.pmod(F.xxhash64("doc_id", "text", F.lit("part")), F.lit(5)) == 0
    texts = {}
    for r in sample.filter(~out).select("lang", "text").collect():  # fewer than a sample holds
        texts.setdefault(r.lang, []).append(r.text)
    assert all(len(t) < langid.DOCS_PER_LANGUAGE for t in texts.values())
    tables = {}
    for lang in sorted(texts):
        back = langid.histories(*langid.to_symbols(texts[lang]))
        counts = {langid.ORDER: Counter(zip(*[b.tolist() for b in back[::-1]]))}
        for k in range(langid.ORDER - 1, 0, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        heads, kinds, discount = {}, {}, {}
        for k, grams in counts.items():
            for g, c in grams.items():
                heads[g[:-1], k] = heads.get((g[:-1], k), 0) + c
                kinds[g[:-1], k] = kinds.get((g[:-1], k), 0) + 1
            ones, twos = (sum(c == x for c in grams.values()) for x in (1, 2))
            discount[k] = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)
        tables[lang] = counts, heads, kinds, discount, {}

    def chance(lang, gram):
        counts, heads, kinds, discount, known = tables[lang]
        if gram not in known:
            k = len(gram)
            if not k:
                known[gram] = 1 / (len(counts[1]) + 1)
            elif not (total := heads.get((gram[:-1], k), 0)):
                known[gram] = chance(lang, gram[1:])
            else:
                own = max(counts[k].get(gram, 0) - discount[k], 0)
                known[gram] = (own + discount[k] * kinds[gram[:-1], k] * chance(lang, gram[1:])) / total
        return known[gram]

    found = {r.doc_id: r for r in queries.op5_language(spark, SF_DIR).collect()}
    assert len(found) == len(rows)
    for r in rows:
        symbols, n = langid.to_symbols([r.text or ""])
        got = found[r.doc_id]
        assert got.held_out == (not r.learn)
        if not n[0]:
            assert (got.lang_pred, got.score) == ("und", 0.0)
            continue
        grams = list(zip(*[b.tolist() for b in langid.histories(symbols, n)[::-1]]))
        entropy = {k: -sum(math.log(chance(k, g)) for g in grams) / n[0] for k in tables}
        least = min(entropy.values())
        assert entropy[got.lang_pred] == pytest.approx(least, abs=1e-5)
        assert got.score == pytest.approx(1 / sum(math.exp(-(e - least) * min(n[0], 20)) for e in entropy.values()), abs=1e-4)


def test_sample_stays_bounded_whatever_the_ids(spark):
    rows = [(None if k % 2 else 7, f"text of number {k} here", "en") for k in range(2000)] + [(1, "same words", "en")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen, materialize = [], langid.scratch.materialize
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(langid.scratch, "materialize", lambda df, p: (seen.append(df), materialize(df, p))[1])
        langid.train(docs, F.lit(True), docs_per_language=100)
    assert seen[0].select("text").distinct().count() < 200 and seen[0].filter("doc_id IS NULL").count() == 0


def test_very_long_text_in_bounded_memory():
    import subprocess
    import sys

    script = """
import resource
from tunemart.llm import langid
import numpy as np
model = langid.fit(["a", "b"], np.array([0, 1]), np.array([[97, 98, 99, 100], [98, 97, 98, 97]]), np.array([3, 2]))
model.usual = np.tile([0.0, 1.0, 1.0, np.inf], (2, 1))
text = "abcd bab a " * (50 * 2**20 // 11)
langid.decide(model, ["abcd"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
langid.decide(model, [text])
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    found = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True, cwd=ROOT)
    assert int(found.stdout) < 300


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = langid.train(docs, F.lit(True))
    assert [tuple(r) for r in langid.identify(docs, model).collect()] == [(1, "und", 0.0, True)]
    assert langid.identify(docs.filter("false"), model).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    found = queries.op5_language(spark, SF_DIR).join(docs, "doc_id")
    rows = found.filter("held_out AND lang IS NOT NULL").collect()
    right = sum(r.lang == r.lang_pred for r in rows) / len(rows)
    assert right > 0.98
    assert found.filter("rejected AND lang IS NOT NULL").count() <= 0.005 * found.count()
    assert not math.isnan(sum(r.score for r in rows))
