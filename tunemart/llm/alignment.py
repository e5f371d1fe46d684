"""Alignment of two tokenizers' tokens, by skipping along diagonals.

Both tokenizers cut the same bytes, so that each gives a rising array of byte ends. From an index
pair at which both ends so far agree, stretches of doubling length of the two arrays are compared
at the current index shift until they differ, then stretches of halving length: that jumps a run
of tokens that both tokenizers cut alike. The tokens after it are walked pair by pair to the next
common end; they make one group, and their numbers change the shift. In a run each token is
linked to its counterpart, in a group each pair of tokens that the walk meets at a byte.

Each different word is encoded once in a while. Words start with white space at places where
neither tokenizer merges over the cut, which `word_pattern` reads off the pieces; this makes
texts of any length a stream of bounded steps.

Links are counted over all texts as (A id, B id) pairs: a unit of a few MiB of text sends one row
for each different pair, and gets the corpus-wide count of each back.

Defined cases: NULL and empty texts, and such that a tokenizer does not give back byte for byte,
have no tokens: zeros and an empty digest; equal rows get equal results and all of them count; a
text of any length is aligned whole; pairs that tie for a B id's highest count are all best; an
empty table gives an empty one; columns that are not kept are not read, and a kept column that is
called like an added one is an error.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemart import scratch
from tunemart.llm.bpe import byte_characters

# Text that is aligned at a time, and text whose pairs are counted together.
STEP_CHARS = 1024**2
UNIT_CHARS = 16 * 1024**2
# Different words of which a worker remembers the tokens, and their characters, before it starts anew.
REMEMBERED, REMEMBERED_CHARS = 400_000, 16 * 1024**2

RESULT = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [T.StructField("groups_sha256", T.StringType())]
)


def byte_level_tokens(document: str) -> tuple[Callable, list[bytes]]:
    """Encoder of word lists, and bytes of each id, of a byte-level tokenizer file (JSON text)."""
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    made = Tokenizer.from_str(document)
    made.encode_special_tokens = True  # their strings in a text are plain text
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    spelled = made.get_vocab(with_added_tokens=True)
    table = [b""] * (max(spelled.values()) + 1)
    for token, number in spelled.items():
        table[number] = bytes(byte_of.get(c, 0) for c in token)
    return lambda words: [e.ids for e in made.encode_batch_fast(words, add_special_tokens=False)], table


def piece_tokens(document: bytes) -> tuple[Callable, list[bytes], list[str]]:
    """Encoder of word lists, bytes of each id, and pieces of a model that puts a blank in front.

    The blank is left away again: a word that starts with one is encoded without it, any other
    behind a line end, which is in no piece, so that the tokens of both stand apart.
    """
    from sentencepiece import SentencePieceProcessor

    made = SentencePieceProcessor(model_proto=document)
    ids = range(made.get_piece_size())
    pieces = [made.id_to_piece(i) for i in ids]
    table = [bytes([int(p[3:5], 16)]) if made.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, pieces)]
    merging = [p for i, p in zip(ids, pieces) if not (made.is_byte(i) or made.is_control(i) or made.is_unknown(i))]
    if any("\n" in p for p in merging):
        raise ValueError("a model with line ends in its pieces cannot be taken word by word")
    # What stands before a word's own tokens, and the tokens of a blank alone.
    front, single = len(made.encode("\n")), [made.piece_to_id("▁")]

    def encode(words: list[str]) -> list[list[int]]:
        blank = [w.startswith(" ") for w in words]
        found = made.encode([w[1:] if b else f"\n{w}" for w, b in zip(words, blank)], num_threads=1)
        return [(f or single) if b else f[front:] for f, b in zip(found, blank)]

    return encode, table, merging


def word_pattern(pieces: list[str]) -> str:
    """Words of white space and what follows it, cut where no piece goes on into white space, and
    between a letter and a mark that follows no letter in any piece.

    White space stays whole. Python counts 1C to 1F as white space, the tokenizers don't.
    """
    inside = {c for p in pieces for c in p[1:] if c.isspace()}
    bridge = "".join(re.escape(c) for c in sorted(inside))
    space, rest = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
    joined = rf"(?:[{bridge}]{space}*{rest}*)*" if bridge else ""
    behind = {y for p in pieces for x, y in zip(p, p[1:]) if x.isalpha()}
    marks = "".join(re.escape(c) for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c not in behind)
    letters = rf"{space}*[A-Za-zÀ-ÖØ-öø-ɏ]+(?=[{marks}])|" if marks else ""
    return rf"{letters}{space}*{rest}+{joined}|{space}+"


class Ragged:
    """Rows of numbers of different lengths, one after the other."""

    def __init__(self):
        self.flat, self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def extend(self, rows: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.flat = np.concatenate([self.flat, np.array([x for r in rows for x in r], np.int64)])
        self.sizes = np.concatenate([self.sizes, sizes])

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the rows, and how many each has."""
        n = self.sizes[rows]
        return self.flat[np.arange(n.sum()) + np.repeat(self.starts[rows] - np.cumsum(n) + n, n)], n


class Words:
    """Ids that both tokenizers give each different word, and whether both give its bytes back."""

    def __init__(self, a_document: str, b_document: bytes):
        self.encode_a, self.a_bytes = byte_level_tokens(a_document)
        self.encode_b, self.b_bytes, pieces = piece_tokens(b_document)
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        self.find = re.compile(word_pattern(pieces))
        # How an id is written where a token, its side and its group end.
        self.a_names = [f"{i}{s}" for s in ",|" for i in range(len(self.a_bytes))]
        self.b_names = [f"{i}{s}" for s in ",;" for i in range(len(self.b_bytes))]
        self.names = self.a_names + self.b_names
        self.forget()

    def forget(self) -> None:
        self.places, self.a, self.b, self.chars = {}, Ragged(), Ragged(), 0
        self.same = np.zeros(0, bool)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The place of each word; places hold until the next call."""
        new = list({*words} - self.places.keys())
        if new and (len(new) + len(self.places) > REMEMBERED or self.chars > REMEMBERED_CHARS):
            self.forget()
            new = list({*words})
        for start in range(0, len(new), 10_000):
            part = new[start : start + 10_000]
            a, b = self.encode_a(part), self.encode_b(part)
            self.a.extend(a)
            self.b.extend(b)
            same = [
                b"".join([self.a_bytes[i] for i in x]) == w == b"".join([self.b_bytes[i] for i in y])
                for w, x, y in zip((w.encode() for w in part), a, b)
            ]
            self.same = np.concatenate([self.same, np.array(same, bool)])
            self.places.update(zip(part, range(len(self.places), len(self.places) + len(part))))
            self.chars += sum(map(len, part))
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))


@lru_cache(maxsize=1)
def worker_words(a_document: str, b_document: bytes) -> Words:
    """One memory for all tasks of a worker."""
    return Words(a_document, b_document)


def skip_diagonals(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links between two arrays of ends that rise to the same last end.

    Returns, in order, for each group the index after its last token in `a` and in `b`, and for
    each link the index in `a` and in `b`.
    """
    n, i, j = len(a), 0, 0
    a, b = [*a, -1], [*b, -2]  # these differ, so that no run goes past the end
    runs, from_i, from_j, group_i, group_j, link_i = [], [], [], [], [], []
    met = link_i.append
    while True:
        start, width = i, 1
        while a[i : i + width] == b[j : j + width]:
            i, j, width = i + width, j + width, 2 * width
        while width > 1:
            width //= 2
            if a[i : i + width] == b[j : j + width]:
                i, j = i + width, j + width
        if i > start:
            runs.append((start, j - i, i - start))
        if i >= n:
            break
        x, y = a[i], b[j]
        from_i.append(i)
        from_j.append(j)
        met(i)
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
            met(i)
        i, j = i + 1, j + 1
        group_i.append(i)
        group_j.append(j)
    starts, shifts, lengths = np.array(runs, np.int64).reshape(-1, 3).T
    run_i = np.arange(lengths.sum()) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
    run_j = run_i + np.repeat(shifts, lengths)
    from_i, from_j, group_i, group_j, link_i = (np.array(x, np.int64) for x in (from_i, from_j, group_i, group_j, link_i))
    ends_i, ends_j = np.concatenate([run_i + 1, group_i]), np.concatenate([run_j + 1, group_j])
    # Each link of a group is one step along one side from the one before it.
    sizes = group_i - from_i + group_j - from_j - 1
    steps = np.arange(len(link_i)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    link_j = np.repeat(from_i + from_j, sizes) + steps - link_i
    links_i, links_j = np.concatenate([run_i, link_i]), np.concatenate([run_j, link_j])
    order = np.argsort(ends_i, kind="stable")
    along = np.argsort(links_i + links_j, kind="stable")
    return ends_i[order], ends_j[order], links_i[along], links_j[along]


@dataclass
class Aligned:
    """What a text, or a part of it, comes to."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    written: str = ""  # its groups, each with a semicolon at its end
    links: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # A id * 2^32 + B id


def align_words(known: Words, texts: list[list[str]]) -> list[Aligned | None]:
    """Each text, given as its words; None for one that a tokenizer does not give back."""
    numbers = known.numbers([w for words in texts for w in words])
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if not len(numbers):
        return [Aligned() for _ in texts]
    of_text = np.repeat(np.arange(len(texts)), sizes)
    wrong = np.bincount(of_text[~known.same[numbers]], minlength=len(texts)) > 0
    keep = ~wrong[of_text]
    numbers, of_text = numbers[keep], of_text[keep]
    (a, per_a), (b, per_b) = known.a.take(numbers), known.b.take(numbers)
    a_text, b_text = np.repeat(of_text, per_a), np.repeat(of_text, per_b)
    ends_a, ends_b = np.cumsum(known.a_sizes[a]), np.cumsum(known.b_sizes[b])
    group_i, group_j, link_i, link_j = skip_diagonals(ends_a.tolist(), ends_b.tolist())

    # Both sides of a group after each other: tokens of A and B written so far tell the place.
    per_group_i, per_group_j = np.diff(group_i, prepend=0), np.diff(group_j, prepend=0)
    codes = np.empty(len(a) + len(b), np.int64)
    at_a = np.arange(len(a)) + np.repeat(group_j - per_group_j, per_group_i)
    at_b = np.arange(len(b)) + np.repeat(group_i, per_group_j)
    a_code, b_code = a.copy(), b + len(known.a_names)
    a_code[group_i - 1] += len(known.a_bytes)
    b_code[group_j - 1] += len(known.b_bytes)
    codes[at_a], codes[at_b] = a_code, b_code
    names = list(map(known.names.__getitem__, codes.tolist()))

    def per_text(owners: np.ndarray) -> np.ndarray:
        return np.bincount(owners, minlength=len(texts))

    n_a, n_b = per_text(a_text), per_text(b_text)
    n_groups, n_links = per_text(a_text[group_i - 1]), per_text(a_text[link_i])
    links = (a[link_i] << 32) | b[link_j]
    found, token, link = [], 0, 0
    for k in range(len(texts)):
        tokens = token + int(n_a[k] + n_b[k])
        stop = link + int(n_links[k])
        one = Aligned(int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(n_links[k]), "".join(names[token:tokens]), links[link:stop])
        found.append(None if wrong[k] else one)
        token, link = tokens, stop
    return found


class Unit:
    """Different pairs of some texts, numbered as they come, with their links."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.sorted, self.places = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def places_of(self, links: np.ndarray) -> np.ndarray:
        pairs, inverse = np.unique(links, return_inverse=True)
        at = np.searchsorted(self.sorted, pairs)
        known = np.zeros(len(pairs), bool)
        inside = at < len(self.sorted)
        known[inside] = self.sorted[at[inside]] == pairs[inside]
        if not known.all():
            new, n = pairs[~known], len(self.sorted)
            self.sorted = np.insert(self.sorted, at[~known], new)
            self.places = np.insert(self.places, at[~known], n + np.arange(len(new)))
            at = np.searchsorted(self.sorted, pairs)
        return self.places[at][inverse]

    def count(self, places: np.ndarray) -> None:
        found = np.bincount(places, minlength=len(self.sorted))
        found[: len(self.counts)] += self.counts
        self.counts = found

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, pair, links) of the pairs that texts with tokens hold."""
        counts = np.zeros(len(self.sorted), np.int64)
        counts[: len(self.counts)] = self.counts
        n = counts[self.places]
        return self.places[n > 0], self.sorted[n > 0], n[n > 0]


def _parts(known: Words, text: str) -> Iterator[list[str]]:
    """The words of a text, so many at a time that a part has about STEP_CHARS characters."""
    words, held = [], 0
    for match in known.find.finditer(text):
        words.append(match.group())
        held += len(words[-1])
        if held >= STEP_CHARS:
            yield words
            words, held = [], 0
    if words:
        yield words


def _whole(known: Words, unit: Unit, text: str) -> tuple:
    """The row of one long text, aligned part by part; a cut between words is a common end."""
    total, sha, places, some = Aligned(), hashlib.sha256(), [], False
    for words in _parts(known, text):
        part = align_words(known, [words])[0]
        if part is None:
            return 0, 0, 0, 0, "", b"", b""
        total.n_a, total.n_b = total.n_a + part.n_a, total.n_b + part.n_b
        total.n_groups, total.n_links = total.n_groups + part.n_groups, total.n_links + part.n_links
        sha.update(((";" if some else "") + part.written[:-1]).encode())
        some = True
        places.append(unit.places_of(part.links).astype("<u4"))
    return _row(unit, total, sha.hexdigest(), np.concatenate(places))


def _row(unit: Unit, found: Aligned, digest: str, places: np.ndarray) -> tuple:
    """Counts, digest and the links' places, lower and upper halves apart: the upper are mostly 0."""
    unit.count(places)
    halves = (places & 0xFFFF).astype("<u2").tobytes(), (places >> 16).astype("<u2").tobytes()
    return found.n_a, found.n_b, found.n_groups, found.n_links, digest, *halves


def _aligned(known: Words, unit: Unit, texts: list[str]) -> list[tuple]:
    """The rows of short texts, all at once."""
    found = align_words(known, [known.find.findall(t) for t in texts])
    rows = []
    for one in found:
        if one is None or not one.n_a:
            rows.append((0, 0, 0, 0, "", b"", b""))
        else:
            digest = hashlib.sha256(one.written[:-1].encode()).hexdigest()
            rows.append(_row(unit, one, digest, unit.places_of(one.links)))
    return rows


def _steps(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about STEP_CHARS together; a longer text is a range of its own."""
    start, held = 0, 0
    for k, text in enumerate(texts):
        if k > start and held + len(text) > STEP_CHARS:
            yield start, k
            start, held = k, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def align(
    df: DataFrame, a_document: str, b_document: bytes, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Columns `keep` and, for each text, tokens of A and B, groups, links, how many links are of
    their B id's most frequent pair, the sum of their pairs' counts, and a digest of the groups.

    A is a byte-level tokenizer and gets the text behind a blank, B a model that adds that blank.
    """
    used = {*RESULT.fieldNames(), "unit", "place", "a", "b", "n", "low", "high", "_text"}
    if clash := {k.lower() for k in keep} & used:
        raise ValueError(f"columns {sorted(clash)} are used here; rename them first")
    shared = df.sparkSession.sparkContext.broadcast((a_document, b_document))  # two vocabularies
    kept = [df.schema[k] for k in keep]
    numbers = ("n_a", "n_b", "n_groups", "n_links")
    schema = T.StructType(
        [T.StructField("unit", T.LongType()), *kept]
        + [T.StructField(c, T.LongType()) for c in numbers]
        + [T.StructField("groups_sha256", T.StringType()), T.StructField("low", T.BinaryType()), T.StructField("high", T.BinaryType())]
        + [T.StructField(c, T.IntegerType()) for c in ("place", "a", "b")]
        + [T.StructField("n", T.LongType())]
    )
    arrow_types = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary()] + [pa.int32()] * 3 + [pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_words(*shared.value)
        first = TaskContext.get().partitionId() << 32
        unit, kept_types = Unit(first), None

        def rows_of(unit: Unit, batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
            found = [pa.array(c, t) for c, t in zip(zip(*rows), arrow_types[1:8])]
            none = [pa.nulls(len(rows), t) for t in arrow_types[8:]]
            units = pa.array([unit.number] * len(rows), pa.int64())
            own = [batch.column(k) for k in range(len(keep))]
            return pa.RecordBatch.from_arrays([units, *own, *found, *none], names=schema.names)

        def pairs_of(unit: Unit) -> Iterator[pa.RecordBatch]:
            place, pair, n = unit.pairs()
            for s in range(0, len(place), 100_000):
                part = slice(s, s + 100_000)
                size = len(place[part])
                none = [pa.nulls(size, t) for t in [*kept_types, *arrow_types[1:8]]]
                found = [place[part], pair[part] >> 32, pair[part] & 0xFFFFFFFF, n[part]]
                found = [pa.array(c, t) for c, t in zip(found, arrow_types[8:])]
                units = pa.array([unit.number] * size, pa.int64())
                yield pa.RecordBatch.from_arrays([units, *none, *found], names=schema.names)

        for batch in batches:
            kept_types = [batch.column(k).type for k in range(len(keep))]
            texts = [" " + t if t else "" for t in batch.column(len(keep)).to_pylist()]
            for start, stop in _steps(texts):
                part = texts[start:stop]
                if len(part[0]) > STEP_CHARS:
                    rows = [_whole(known, unit, part[0])]
                else:
                    rows = _aligned(known, unit, part)
                yield rows_of(unit, batch.slice(start, stop - start), rows)
                unit.chars += sum(map(len, part))
                if unit.chars >= UNIT_CHARS:
                    yield from pairs_of(unit)
                    unit = Unit(unit.number + 1)
        if kept_types is not None:
            yield from pairs_of(unit)

    picked = df.select(*keep, F.col(text).alias("_text"))
    written = scratch.materialize(picked.mapInArrow(run, schema), "aligned")
    texts = written.filter("place IS NULL").select("unit", *keep, *numbers, "groups_sha256", "low", "high")
    pairs = written.filter("place IS NOT NULL").select("unit", "place", "a", "b", "n")
    totals = pairs.groupBy("a", "b").agg(F.sum("n").alias("total"))
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    # One row for each id of B at most.
    scored = totals.join(F.broadcast(most), "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    answers = pairs.join(scored, ["a", "b"]).select(F.col("unit").alias("of"), "place", "total", "best")
    result = T.StructType(kept + RESULT.fields)

    def finish(texts: pa.Table, answers: pa.Table) -> pa.Table:
        places = answers.column("place").to_numpy()
        size = int(places.max()) + 1 if len(places) else 0
        totals, best = np.zeros(size, np.int64), np.zeros(size, bool)
        totals[places] = answers.column("total").to_numpy()
        best[places] = answers.column("best").to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for low, high in zip(texts.column("low"), texts.column("high")):
            at = np.frombuffer(low.as_py(), "<u2") | np.frombuffer(high.as_py(), "<u2").astype(np.uint32) << 16
            n_best.append(int(best[at].sum()))
            count_sum.append(int(totals[at].sum()))
        found = {
            **{k: texts.column(k) for k in (*keep, *numbers)},
            "n_best": pa.array(n_best, pa.int64()),
            "count_sum": pa.array(count_sum, pa.int64()),
            "groups_sha256": texts.column("groups_sha256"),
        }
        return pa.table(found).select(result.fieldNames())

    return texts.groupBy("unit").cogroup(answers.groupBy("of")).applyInArrow(finish, result)
