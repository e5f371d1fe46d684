"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of words without case and outer punctuation in which numbers, names
and units are typed placeholders. A capital makes a name wherever it stands, also at the start of
a sentence, and numbers may be spelled; a run of names within a sentence is one placeholder, and so
is a run of numbers, so that names and numbers of more or fewer words leave the rest in line. Windows of these templates are hashed; document windows that
a benchmark window hashes to are joined to it. Hits of a document and an item that lie on one
diagonal (same distance between place in the document and in the item) form a match. A match is
kept if it covers enough of the item and its slots are consistent: a value of the item always
stands for the same value of the document, and the other way round. So a question is found with
its numbers and names changed, and two texts of like build but other relations are told apart.

An item none of whose windows has enough words beside placeholders is looked for as a whole, word
by word; one of fewer than LEAST_WORDS words only where it is a sentence or a line by itself.

Documents are read once. A bitmap of the benchmark's window hashes, of one size whatever the
benchmark's, lets through few windows that are no hits; the join is exact on 64 bits.

Defined cases: NULL and empty texts match nothing; an item shorter than a window is one window
of its length; an item without a letter or digit matches nothing; several matches of a pair give one row, the best; copies of a document or rows
repeated under one id are matched each, then shown once per id; NULL ids match like others; an
empty benchmark matches nothing. Only ids and texts are looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemart import scratch
from tunemart.llm.common import slices, text_key

WINDOW = 8
COVERAGE = 0.6  # of the item's windows
LITERALS = 4  # words in a window of templates, at least, that are no placeholders
BITMAP_BITS = 22

LEAST_WORDS = 5  # of what is found within a sentence
VERBATIM = np.uint64(0x5851F42D4C957F2D)  # tells hashes of words as they are from those of templates

NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"

# Words that are units when they follow a number.
UNITS = frozenset(
    "% $ € £ mm cm m km in inch inches ft foot feet yd yards mi mile miles mg g kg lb lbs oz ton tons "
    "ml l litre litres liter liters s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years cent cents dollar dollars euro euros pound pounds percent "
    "km/h mph m/s degree degrees °c °f kb mb gb tb hz khz mhz w kw v".split()
)
# Spelled numbers in English, German, French and Spanish, without those that are articles.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
    "million billion dozen "
    "null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig dreißig vierzig fünfzig "
    "sechzig siebzig achtzig neunzig hundert tausend "
    "deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente "
    "quarante cinquante soixante cent mille "
    "dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince veinte treinta "
    "cuarenta cincuenta sesenta setenta ochenta noventa cien mil".split()
)
_NUMBER = re.compile(r"[-+]?[$€£]?\d[\d.,:/]*(?:e[-+]?\d+)?[a-z%°]{0,3}")
_OUTER = " \t\r\n.,;:!?\"'()[]{}<>«»“”‘’¿¡…*_`|-–—"
_END = (".", "!", "?", ":")
BREAK = "\x00"
_SPACED_BREAK = f" {BREAK} "


def describe(word: str) -> tuple[str, str, bool]:
    """Template and value of a word by itself, and whether it ends the sentence."""
    if word.isalpha():  # most words, and no mark or digit to look for
        bare, low, ends = word, word.lower(), False
        number = low in NUMBER_WORDS
    else:
        bare = word.strip(_OUTER) or word
        low, ends = bare.lower(), word.rstrip("\"')]»”’").endswith(_END)
        number = bool(_NUMBER.fullmatch(low)) or all(p in NUMBER_WORDS for p in low.split("-"))
    if number:
        return NUMBER, low, ends
    return (NAME if bare[0].isupper() and bare[1:2].islower() else low), low, ends


def split(text: str | None) -> list[str]:
    """Words, and BREAK for each end of a line."""
    return (text or "").replace("\n", _SPACED_BREAK).split()


def read(text: str | None) -> list[tuple[str, str, bool]]:
    """Template, value and whether it starts a sentence or a line, of each word."""
    found, starts, after_number = [], True, False
    for word in split(text):
        if word == BREAK:
            starts = True
            continue
        kind, value, ends = describe(word)
        if after_number and (value in UNITS or word in UNITS):
            kind = UNIT
        found.append((kind, value, starts))
        starts, after_number = ends, kind is NUMBER
    return found


def template(text: str | None) -> tuple[list[str], list[str]]:
    """Template and value of each word, or run of names or numbers within a sentence."""
    kinds, values = [], []
    for kind, value, starts in read(text):
        if kind in (NAME, NUMBER) and not starts and kinds[-1] == kind:
            values[-1] += f" {value}"
        else:
            kinds.append(kind)
            values.append(value)
    return kinds, values


def _hash(kind: str) -> int:
    return xxhash.xxh64_intdigest(kind, 7)


class Lexicon(dict):
    """A number for each different word, and by number what `template` needs to know of it.

    It forgets all words once it has many; numbers are valid until the next call of `learn`.
    """

    MOST = 800_000
    COLUMNS = (np.uint64, np.uint64, bool, bool, bool, bool)

    def __init__(self):
        self.new, self.arrays = [], None

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        number = self[word] = len(self)
        return number

    def learn(self, words: list[str]) -> np.ndarray:
        if len(self) > self.MOST:
            self.clear()
            self.arrays = None
        self.new = []
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        rows = []
        for word in self.new:
            kind, value, ends = describe(word)
            unit = value in UNITS or word in UNITS
            rows.append((_hash(kind), _hash(value), kind is NAME, kind is NUMBER, unit, ends))
        if rows:
            made = [np.array(c, t) for c, t in zip(zip(*rows), self.COLUMNS)]
            self.arrays = made if self.arrays is None else list(map(np.concatenate, zip(self.arrays, made)))
        return numbers


@lru_cache(maxsize=1)
def lexicon() -> Lexicon:
    """One for all tasks of a worker."""
    return Lexicon()


_PLACEHOLDERS = (NUMBER, NAME, UNIT)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Stream(NamedTuple):
    """The words, or templates, of many texts on end."""

    hashes: np.ndarray
    marks: np.ndarray  # templates: whether it is a literal; words: whether it starts a sentence
    counts: np.ndarray  # of each text


def hashed(texts: list[str | None], by_word: bool = True) -> tuple[Stream, Stream | None]:
    """As `template` for many texts at once, as hashes, and with `by_word` the same of the words' values."""
    cut = [split(t) for t in texts]
    sizes = np.fromiter(map(len, cut), np.int64, len(cut))
    ids = lexicon().learn(list(chain.from_iterable(cut)) + [BREAK])
    breaks = ids[:-1] == ids[-1]
    text = np.repeat(np.arange(len(texts)), sizes)[~breaks]
    ids = ids[:-1][~breaks]
    counts = np.bincount(text, minlength=len(texts))
    if not len(ids):
        none = Stream(np.zeros(0, np.uint64), np.zeros(0, bool), counts)
        return none, none
    kinds, values, *marks = lexicon().arrays
    kinds, (name, number, unit, ends) = kinds[ids], (a[ids] for a in marks)
    # How many breaks are in front of a word: more than before the last one, and a line begins.
    lines = np.cumsum(breaks)[~breaks]
    new_text = np.ones(len(ids), bool)
    new_text[1:] = text[1:] != text[:-1]
    starts = new_text.copy()
    starts[1:] |= (lines[1:] != lines[:-1]) | ends[:-1]
    units = np.zeros(len(ids), bool)
    units[1:] = unit[1:] & number[:-1] & ~new_text[1:]
    name &= ~units
    runs_on = np.zeros(len(ids), bool)
    runs_on[1:] = ~starts[1:] & ((name[1:] & name[:-1]) | (number[1:] & number[:-1]))
    own = ~runs_on
    literal = ~(units | number | name)[own]
    kinds = np.where(units, np.uint64(_hash(UNIT)), kinds)[own]
    templates = Stream(kinds, literal, np.bincount(text[own], minlength=len(texts)))
    return templates, Stream(values[ids], starts, counts) if by_word else None


def _codes(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each window."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    code = np.zeros(n, np.uint64)
    for k in range(width):
        code = code * _STEP + words[k : n + k]
    code ^= code >> np.uint64(31)
    code *= _STEP
    return code


def template_windows(stream: Stream, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, whether the window has enough literal words) at each place where a window begins."""
    code = _codes(stream.hashes, width)
    total = np.concatenate([[0], np.cumsum(stream.marks)])
    return code, total[width:] - total[: len(code)] >= min(LITERALS, width) if len(code) else np.zeros(0, bool)


def verbatim_windows(stream: Stream, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, whether the window may be told by itself) at each place where a window begins."""
    code = _codes(stream.hashes, width) ^ VERBATIM
    if width >= LEAST_WORDS:
        return code, np.ones(len(code), bool)
    starts = np.append(stream.marks, True)
    return code, starts[: len(code)] & starts[width : width + len(code)]


def _to_long(codes: np.ndarray) -> np.ndarray:
    return codes.view(np.int64)


def _item_rows(item, text: str | None, window: int) -> list[tuple]:
    """Windows of an item's templates, or if none is usable those of its words."""
    by_template, by_word = hashed([text])
    found, values = template(text)
    width = min(window, len(found))
    codes, usable = template_windows(by_template, width) if width >= LEAST_WORDS else (np.zeros(0, np.uint64), [])
    places, verbatim = np.flatnonzero(usable), False
    if not len(places):
        found = values = [value for _, value, _ in read(text)]
        if not any(c.isalnum() for value in values for c in value):
            return []
        width, verbatim = min(window, len(found)), True
        codes = verbatim_windows(by_word, width)[0] if width else codes
        places = np.arange(len(codes))
    return [
        (item, p, len(places), width, verbatim, code, found[p : p + width], values[p : p + width])
        for p, code in zip(places.tolist(), _to_long(codes)[places].tolist())
    ]


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, item_place, n_windows, width, verbatim, code, values) of each window of each item."""
    schema = "item_id long, item_place int, n_windows int, width int, verbatim boolean, code long, templates array<string>, item_values array<string>"
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()] + [pa.list_(pa.string())] * 2
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                rows += _item_rows(item, text, window)
            columns = list(zip(*rows)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return items.select("item_id", "text").mapInArrow(run, schema)


def bitmap(windows: DataFrame) -> np.ndarray:
    """Which values of the upper bits of window hashes occur: 2^BITMAP_BITS bits at any size."""
    slot = f"cast(shiftrightunsigned(code, {64 - BITMAP_BITS}) AS int)"
    byte = windows.groupBy(F.expr(f"{slot} DIV 8").cast("int").alias("byte")).agg(
        F.expr(f"bit_or(shiftleft(1, {slot} & 7))").alias("bits")
    )
    bits = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    rows = byte.toArrow()  # at most one row for each byte
    bits[rows.column("byte").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint8)
    return bits


def _places(stream: Stream, codes: np.ndarray, usable: np.ndarray, width: int, known: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, place in it, hash) of usable windows within a text that the bitmap knows."""
    slot = (codes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
    hit = np.flatnonzero(usable & (known[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0))
    stops = np.cumsum(stream.counts)
    text = np.searchsorted(stops, hit, "right")
    whole = hit + width <= stops[text]
    hit, text = hit[whole], text[whole]
    return text, hit - (stops - stream.counts)[text], _to_long(codes)[hit]


def candidate_windows(docs: DataFrame, bits: np.ndarray, widths: list[tuple[bool, int]]) -> DataFrame:
    """(doc_id, text_id, place, code, values) of document windows that the bitmap lets through.

    `widths` are pairs (verbatim, width).
    """
    schema = "doc_id long, text_id string, doc_place int, code long, doc_templates array<string>, doc_values array<string>"
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.int32(), pa.int64()] + [pa.list_(pa.string())] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, "text"):
            rows = []
            docs, marks, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text_id", "text"))
            by_template, by_word = hashed(texts, any(verbatim for verbatim, _ in widths))
            last = None, None, None
            for verbatim, width in widths:
                stream = by_word if verbatim else by_template
                found = (verbatim_windows if verbatim else template_windows)(stream, width)
                for t, p, code in zip(*(a.tolist() for a in _places(stream, *found, width, known))):
                    if last[0] != (verbatim, t):
                        own = [[value for _, value, _ in read(texts[t])]] * 2 if verbatim else template(texts[t])
                        last = (verbatim, t), *own
                    _, kinds, values = last
                    rows.append((docs[t], marks[t], p, code, kinds[p : p + width], values[p : p + width]))
            columns = list(zip(*rows)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_id"), "text")
    return keyed.mapInArrow(run, schema)


def consistent_matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE
) -> DataFrame:
    """Matches of a text and an item, one for each diagonal; `text_id` tells apart the texts of
    documents with one id. Columns doc_id, text_id, item_id, coverage (share of the item's windows that were found), doc_place
    (template, or word of an item found as it is, at which the item begins in the document, or would), n_slots, exact (all slots have
    the item's values).
    """
    windows = scratch.materialize(item_windows(items, window), "windows")
    # Two for each width up to `window`, at most.
    widths = [tuple(r) for r in windows.select("verbatim", "width").distinct().collect()]
    wanted = candidate_windows(docs, bitmap(windows), sorted(widths))
    hits = wanted.join(windows, "code").filter(F.col("doc_templates") == F.col("templates"))
    slots = F.filter(
        F.arrays_zip("templates", "item_values", "doc_values"),
        lambda s: s["templates"].isin(*_PLACEHOLDERS),
    )
    found = hits.select(
        "doc_id",
        "text_id",
        "item_id",
        "item_place",
        "n_windows",
        "verbatim",
        (F.col("doc_place") - F.col("item_place")).alias("doc_place"),
        slots.alias("slots"),
    )
    # All that is collected here is bounded by the item's length.
    pairs = found.groupBy("doc_id", "text_id", "item_id", "doc_place").agg(
        (F.count_distinct("item_place") / F.max("n_windows")).alias("coverage"),
        F.when(F.max("verbatim"), 1.0).otherwise(coverage).alias("least"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    sides = [
        F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["templates"], s[side]))))
        for side in ("item_values", "doc_values")
    ]
    consistent = (F.size("slots") == sides[0]) & (F.size("slots") == sides[1])
    changed = F.exists("slots", lambda s: s["item_values"] != s["doc_values"])
    return pairs.filter((F.col("coverage") >= F.col("least")) & consistent).select(
        "doc_id",
        "text_id",
        "item_id",
        "coverage",
        "doc_place",
        F.size("slots").alias("n_slots"),
        (~changed).alias("exact"),
    )


def matches(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Pairs of a document and an item that it holds, in the item's words or re-parameterised:
    doc_id, item_id and the columns of the best of their matches."""
    kept = consistent_matches(docs, items, **options)
    best = F.struct("coverage", "exact", (-F.col("doc_place")).alias("first"), "doc_place", "n_slots")
    top = kept.groupBy("doc_id", "item_id").agg(F.max(best).alias("b"))
    return top.select("doc_id", "item_id", *[f"b.{c}" for c in ("coverage", "doc_place", "n_slots", "exact")])


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents, all columns, without those that hold an item."""
    found = consistent_matches(docs, items, **options).select("doc_id", "text_id").distinct()
    same = docs["doc_id"].eqNullSafe(found["doc_id"]) & (text_key(docs["text"]) == found["text_id"])
    return docs.join(found, same, "left_anti")
