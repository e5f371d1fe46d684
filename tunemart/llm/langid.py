"""Language identification with interpolated Kneser-Ney character models.

One model per language over letters and single blanks (everything that is no letter is a
blank). Counts come from a bounded sample of labelled documents and are made by Spark. All
languages share, per order, one sorted array of n-gram hashes with a row of probabilities, one
per language, and one of context hashes with a row of backoff weights. A text gets the language
with the lowest cross-entropy per character, over the whole text.

A fifth of the sample is kept out of the counts. Its cross-entropies, as mean and variance by
length, say how far from its language's usual value a text lies; one that lies further out than
any text of that language is expected to is marked as rejected.

Texts are walked in blocks of bounded size, sums and the symbols before a block being carried on.

Defined cases: NULL texts and texts without a letter are `und`, score 0, rejected; rows without an
id are never learned from, those of one id are drawn by their texts; with no labelled text every
text is `und`; copies are scored alike; long texts are scored whole; languages tie in favour of
the first by name; an empty table gives an empty one; a kept column that is called like an added
one is an error, other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemart import scratch
from tunemart.llm.common import slices

ORDER = 4
DOCS_PER_LANGUAGE = 1_500
UNKNOWN = "und"
BLANK, START = 32, 0
# Standard deviations from the mean of the language at which a text is rejected: at least this,
# and this many times what any text kept out of the counts shows.
LEAST_LIMIT, LIMIT_MARGIN = 8.0, 1.5
# Least variance between texts of a language, in nats per symbol squared: few texts kept out
# say little about it.
LEAST_BETWEEN = 0.01
# Characters that are scored or counted at a time.
BLOCK = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def symbols() -> np.ndarray:
    """The symbol of each code point: a letter's lower case, else a blank."""
    found = np.full(0x110000, BLANK, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            found[point] = ord(low) if len(low) == 1 else point
    return found


def to_symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, one after the other without double or leading blanks, and counts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    found = symbols()[points]
    blank = found == BLANK
    first = np.zeros(len(found) + 1, bool)
    first[(np.cumsum(lengths) - lengths)] = True
    before = np.ones(len(found), bool)
    before[1:] = blank[:-1]
    keep = ~(blank & (before | first[:-1]))
    ends = np.concatenate([[0], np.cumsum(keep)])
    stops = np.cumsum(lengths)
    return found[keep], ends[stops] - ends[stops - lengths]


def histories(found: np.ndarray, counts: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """The symbols 0, 1, ... places back, START before the beginning of a text."""
    place = np.arange(len(found)) - np.repeat(np.cumsum(counts) - counts, counts)
    back = [found]
    for k in range(1, order):
        shifted = np.zeros_like(found)
        shifted[k:] = found[:-k] if k < len(found) else found[:0]
        shifted[place < k] = START
        back.append(shifted)
    return back


def hashes(back: list[np.ndarray]) -> np.ndarray:
    """One 64-bit number for the symbols of an n-gram, last symbol first."""
    code = np.zeros(len(back[0]), np.uint64)
    for symbol in reversed(back):
        code = (code + symbol + np.uint64(1)) * _MIX
        code ^= code >> np.uint64(29)
    return code


def ranges(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of BLOCK characters together at most; a longer text is a range of its own."""
    start, held = 0, 0
    for k, text in enumerate(texts):
        if k > start and held + len(text) > BLOCK:
            yield start, k
            start, held = k, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def long_histories(text: str) -> Iterator[list[np.ndarray]]:
    """The histories of a long text, block by block, as `histories` gives them for the whole."""
    tail = np.zeros(0, np.uint32)
    for at in range(0, len(text), BLOCK):
        part = text[at : at + BLOCK]
        found, _ = to_symbols([part])
        if len(tail) and tail[-1] != BLANK and symbols()[ord(part[0])] == BLANK:
            found = np.concatenate([np.array([BLANK], np.uint32), found])
        joined = np.concatenate([tail, found])
        back = histories(joined, np.array([len(joined)]))
        yield [b[len(tail) :] for b in back]
        tail = joined[-(ORDER - 1) :]


def blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(numbers of texts, symbols that each has here, histories); a long text comes in several."""
    for start, stop in ranges(texts):
        if len(texts[start]) > BLOCK:
            for back in long_histories(texts[start]):
                yield np.array([start]), np.array([len(back[0])]), back
        else:
            found, counts = to_symbols(texts[start:stop])
            yield np.arange(start, stop), counts, histories(found, counts)


def ngram_counts(sample: DataFrame) -> DataFrame:
    """(lang, s3, s2, s1, s0, n) over the texts of (lang, text)."""
    names = [f"s{k}" for k in reversed(range(ORDER))]
    schema = "lang string, " + ", ".join(f"{n} int" for n in names) + ", n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = np.array(batch.column("text").to_pylist(), object)
            for lang in sorted({*langs}):
                for _, _, back in blocks(texts[langs == lang].tolist()):
                    if not len(back[0]):
                        continue
                    grams, n = np.unique(np.stack(back[::-1], 1).astype(np.int32), axis=0, return_counts=True)
                    columns = [pa.array([lang] * len(n)), *map(pa.array, grams.T.copy()), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", *names, "n"])

    counts = sample.select("lang", "text").mapInArrow(run, schema)
    return counts.groupBy("lang", *names).agg(F.sum("n").alias("n"))


@dataclass
class Level:
    """One order: sorted n-gram hashes with probabilities, sorted context hashes with weights."""

    grams: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray


@dataclass
class Model:
    languages: list[str]
    levels: list[Level]  # from one symbol to ORDER
    floor: np.ndarray  # probability of a symbol that a language has not seen
    usual: np.ndarray | None = None  # by language: mean, variance, variance times length, limit


def find(sorted_hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted hash, -1 where it is missing."""
    if not len(sorted_hashes):
        return np.full(len(wanted), -1)
    at = np.searchsorted(sorted_hashes, wanted)
    at[at == len(sorted_hashes)] = 0
    return np.where(sorted_hashes[at] == wanted, at, -1)


def fit(languages: list[str], lang: np.ndarray, grams: np.ndarray, n: np.ndarray) -> Model:
    """Interpolated Kneser-Ney: the highest order counts occurrences, lower ones different
    symbols in front. `grams` has the symbols of a row from first to last."""
    width = len(languages)
    by_order = [None] * ORDER
    rows, counts, owner = grams, n.astype(np.float64), lang
    for order in range(ORDER, 0, -1):
        by_order[order - 1] = (rows, counts, owner)
        tails = np.concatenate([owner[:, None], rows[:, 1:]], 1)
        tails, counts = np.unique(tails, axis=0, return_counts=True)
        owner, rows, counts = tails[:, 0], tails[:, 1:], counts.astype(np.float64)
    alphabet = np.bincount(by_order[0][2], minlength=width) + 1.0  # one for the unseen
    levels, lower, floor = [], None, None
    for order, (rows, counts, owner) in enumerate(by_order, 1):
        code = hashes([rows[:, k].astype(np.uint32) for k in reversed(range(order))])
        above = [rows[:, k].astype(np.uint32) for k in reversed(range(order - 1))]
        context = hashes(above) if above else np.zeros(len(rows), np.uint64)
        contexts, of = np.unique(context, return_inverse=True)
        total, kinds = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
        np.add.at(total, (of, owner), counts)
        np.add.at(kinds, (of, owner), 1.0)
        ones = np.bincount(owner[counts == 1], minlength=width)
        twos = np.bincount(owner[counts == 2], minlength=width)
        discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.9)
        seen = total > 0
        weight = np.where(seen, discount * kinds / np.maximum(total, 1), 1.0)
        keys, first, at = np.unique(code, return_index=True, return_inverse=True)
        own = np.zeros((len(keys), width))
        own[at, owner] = (counts - discount[owner]) / total[of, owner]
        if order == 1:
            floor = weight[0] / alphabet if len(weight) else 1.0 / alphabet
            chance = own + floor
        else:
            tail = hashes([rows[first, k].astype(np.uint32) for k in reversed(range(1, order))])
            chance = own + weight[of[first]] * lower[find(levels[-1].grams, tail)]
        levels.append(Level(keys, np.log(chance).astype(np.float32), contexts, np.log(weight).astype(np.float32)))
        lower = chance
    return Model(languages, levels, np.log(floor).astype(np.float32))


def log_chances(model: Model, back: list[np.ndarray], order: int = ORDER) -> np.ndarray:
    """Log probability of each symbol after those before it, by language."""
    if order == 0:
        return np.broadcast_to(model.floor, (len(back[0]), len(model.languages)))
    level = model.levels[order - 1]
    at = find(level.grams, hashes(back[:order]))
    found = level.logs[at]
    missing = np.flatnonzero(at < 0)
    if len(missing):
        rest = [b[missing] for b in back]
        shorter = log_chances(model, rest, order - 1)
        if order > 1:
            context = find(level.contexts, hashes(rest[1:order]))
            shorter = shorter + np.where(context[:, None] < 0, 0, level.weights[context])
            found[missing] = shorter
        else:
            found[missing] = shorter
    return found


def entropies(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By text: cross-entropy per symbol and language, number of symbols, squared deviations."""
    sums = np.zeros((len(texts), len(model.languages)))
    squares, counts = np.zeros_like(sums), np.zeros(len(texts), np.int64)
    for own, sizes, back in blocks(texts):
        full = np.flatnonzero(sizes)
        if len(full):
            logs = log_chances(model, back)
            starts = (np.cumsum(sizes) - sizes)[full]
            sums[own[full]] += np.add.reduceat(logs, starts, axis=0, dtype=np.float64)
            squares[own[full]] += np.add.reduceat(logs * logs, starts, axis=0, dtype=np.float64)
            counts[own] += sizes
    n = np.maximum(counts, 1)[:, None]
    return -sums / n, counts, squares / n - (sums / n) ** 2


def decide(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and rejection of each text."""
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    entropy, counts, _ = entropies(model, [t or "" for t in texts])
    # Leading blanks are gone, so a text without letters has no symbols at all.
    best = entropy.argmin(axis=1)
    lowest = entropy[np.arange(len(texts)), best]
    # How much likelier than the others, as if the text had 20 symbols of evidence at most.
    score = 1 / np.exp(-(entropy - lowest[:, None]) * np.minimum(counts, 20)[:, None]).sum(axis=1)
    mean, between, by_symbol, limit = model.usual[best].T
    apart = (lowest - mean) / np.sqrt(between + by_symbol / np.maximum(counts, 1))
    known = counts > 0
    names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    return names, np.where(known, score, 0.0), ~known | (apart > limit)


def train(
    docs: DataFrame, learn_from: Column, docs_per_language: int = DOCS_PER_LANGUAGE
) -> Model:
    """A model from about `docs_per_language` documents of each language, drawn by a hash.

    The bound keeps the model, and what passes through the driver, at one size for any input.
    """
    known = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    labelled = docs.filter(learn_from & known)
    labelled = labelled.select(F.col("lang").cast("string").alias("lang"), "text", "doc_id")
    totals = dict(labelled.groupBy("lang").count().collect())  # one row for each language
    languages = sorted(totals)
    if not languages:
        return Model([], [], np.zeros(0))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, docs_per_language / totals[k]))])
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("draw")), F.lit(1_000_000)) / 1_000_000
    # The hash that keeps a fifth out is another one than that which draws the sample.
    kept_out = F.pmod(F.xxhash64("doc_id", "text", F.lit("part")), F.lit(5)) == 0
    sample = scratch.materialize(labelled.filter(draw < share[F.col("lang")]), "sample")
    counted = ngram_counts(sample.filter(~kept_out)).toArrow()
    number = {lang: k for k, lang in enumerate(languages)}
    lang = np.array([number[x] for x in counted.column("lang").to_pylist()], np.int64)
    grams = np.stack([counted.column(f"s{k}").to_numpy() for k in reversed(range(ORDER))], 1).astype(np.int64)
    model = fit(languages, lang, grams.reshape(-1, ORDER), counted.column("n").to_numpy())
    rest = _measured(sample.filter(kept_out), model)
    calibrate_from(model, rest)
    return model


def _measured(sample: DataFrame, model: Model) -> pa.Table:
    """For each different text kept out: its language's number, cross-entropy, symbols, variance
    and number of copies."""
    shared = sample.sparkSession.sparkContext.broadcast(model)
    names = ["k", "h", "n", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {lang: k for k, lang in enumerate(shared.value.languages)}
        for batch in slices(batches, "text"):
            entropy, counts, variance = entropies(shared.value, batch.column("text").to_pylist())
            own = np.array([number[x] for x in batch.column("lang").to_pylist()])
            row = np.arange(len(own))
            columns = (own, entropy[row, own], counts, variance[row, own])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    found = sample.select("lang", "text").mapInArrow(run, "k long, h double, n long, v double")
    return found.groupBy(*names).agg(F.count("*").alias("copies")).toArrow()


def calibrate_from(model: Model, measured: pa.Table) -> None:
    """Mean and spread of each language's own texts, as a function of their length."""
    number, h, n, v, copies = (measured.column(c).to_numpy() for c in ("k", "h", "n", "v", "copies"))
    usual = np.tile([0.0, 1.0, 1.0, np.inf], (len(model.languages), 1))
    for k in range(len(model.languages)):
        own = np.flatnonzero((number == k) & (n > 0))
        if copies[own].sum() < 2:
            continue  # nothing to judge by: no text is rejected
        weights = np.minimum(n[own], 500) * copies[own]
        mean = np.average(h[own], weights=weights)
        by_symbol = np.average(v[own], weights=n[own] * copies[own])
        between = max(np.average((h[own] - mean) ** 2 - by_symbol / n[own], weights=weights), LEAST_BETWEEN)
        far = np.max((h[own] - mean) / np.sqrt(between + by_symbol / n[own]))
        usual[k] = mean, between, by_symbol, max(LEAST_LIMIT, LIMIT_MARGIN * far)
    model.usual = usual


def identify(
    docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Columns `keep`, `lang_pred`, `score` and `rejected`; only the text is looked at."""
    added = ("lang_pred", "score", "rejected")
    if clash := {*keep} & {*added, "_text"}:
        raise ValueError(f"columns {sorted(clash)} are used here; rename them first")
    types = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([docs.schema[k] for k in keep] + list(map(T.StructField, added, types)))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            names, score, rejected = decide(shared.value, batch.column("_text").to_pylist())
            kept = [batch.column(k) for k in range(len(keep))]
            found = [pa.array(names, pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(kept + found, names=schema.names)

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def without_rejected(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that are not rejected."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], place):
                rejected = decide(shared.value, part.column(place).to_pylist())[2]
                yield part.filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)
