"""Katz backoff language model over word pairs, and the log probability of texts under it.

The chance of a word after another is its Good-Turing discounted share of the pairs that begin
with that one, or, where the pair was never seen, the backoff weight of the first word times the
chance of the word alone, which is discounted in the same way and leaves a rest to unknown words.
Backoff weights are such that the chances after each word add up to one exactly.

Texts are read once and kept as blocks: the sorted hashes of a block's different words and, per
token, its place among them. Counts, and later the answers to what a block has to know, travel
as packed arrays by hash shard and not as a row per token:

1. words: blocks send counts of their different words, a shard adds them up and answers totals;
2. pairs: the same with hashes of pairs; one block of those that have a pair is named its owner;
3. contexts: owners add up, per first word, what seen pairs leave for others; a shard adds up
   the blocks' sums and answers backoff weights;
4. each block scores its texts.

A frequent word or pair is one entry per block, so no shard is larger than others but by chance.
Each step is written; its table has the shard's part of the model and the answers by block.

Words are compared by 64-bit hashes. Defined cases: NULL and empty texts are one end token; NULL
ids are scored and never learned from (their fold is unknown); copies count each time; with
nothing to learn from, all probability is that of unknown words, 1; texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemart import scratch
from tunemart.llm.common import slices

START, END = np.uint64(1), np.uint64(2)  # hashes of the marks before and after a text
GOOD_TURING = 5  # largest count that is discounted
SHARD_KEYS = 1 << 20  # hashes that a shard receives, about
SLICE = 9 * 1024**2  # text in a block
_STEP, _MIX = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def pack(values: np.ndarray) -> bytes:
    """An array as compressed bytes, the bytes of equal rank side by side."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(packed: bytes, dtype) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(packed)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, np.uint64), dtype=np.uint64)


def mix(codes: np.ndarray) -> np.ndarray:
    codes = (codes ^ (codes >> np.uint64(32))) * _MIX
    codes = (codes ^ (codes >> np.uint64(29))) * _STEP
    return codes ^ (codes >> np.uint64(32))


def powers(size: int) -> np.ndarray:
    """_STEP to the 0th, 1st, ... modulo 2^64."""
    steps = np.full(size, _STEP, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of the bytes and the length of each word, from sums of bytes times powers."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = stops - starts
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    letters = data[np.repeat(starts, sizes) + place].astype(np.uint64) + np.uint64(1)
    letters *= powers(int(sizes.max()))[place]
    return mix(np.add.reduceat(letters, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token of the texts, one text after the other, and tokens per text."""
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    edges = np.flatnonzero(np.diff(_SPACE[data], prepend=True))
    starts, stops = edges[0::2], edges[1::2]  # the last byte is white space
    step = 1 << 18  # words at a time
    parts = [word_hashes(data, starts[k : k + step], stops[k : k + step]) for k in range(0, len(starts), step)]
    words = np.concatenate([np.zeros(0, np.uint64), *parts])
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    counts = np.diff(np.searchsorted(starts, np.cumsum(lengths)), prepend=0)
    found = np.full(len(words) + len(texts), END)
    found[np.arange(len(words)) + np.repeat(np.arange(len(texts)), counts)] = words
    return found, counts + 1


BLOCK = "doc_ids array<long>, trained binary, lengths binary, keys binary, ids binary, counts binary, n_keys long, n_tokens long"
_BLOCK = pa.schema(
    [("doc_ids", pa.list_(pa.int64()))]
    + [(n, pa.binary()) for n in ("trained", "lengths", "keys", "ids", "counts")]
    + [("n_keys", pa.int64()), ("n_tokens", pa.int64())]
)


def read_blocks(docs: DataFrame, train: Column) -> DataFrame:
    """Blocks of some texts each, as described above, with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            found, lengths = tokens(texts)
            trained = np.array(batch.column("train").to_pylist(), bool)
            keys, ids = np.unique(np.concatenate([[START, END], found]), return_inverse=True)
            ids = ids[2:]
            counts = np.bincount(ids[np.repeat(trained, lengths)], minlength=len(keys))
            row = (
                [batch.column("doc_id").to_pylist()],
                *([pack(a)] for a in (trained, lengths.astype(np.int32))),
                [pack_sorted(keys)],
                *([pack(a)] for a in (ids.astype(np.uint32), counts.astype(np.uint32))),
                [len(keys)],
                [len(ids)],
            )
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _BLOCK)], schema=_BLOCK)

    learned = F.coalesce(train, F.lit(False)).alias("train")
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", learned)
    rows = thin.mapInArrow(run, BLOCK).withColumn("block", F.monotonically_increasing_id())
    return scratch.materialize(rows, "blocks")


class Block:
    """A block's arrays, and what shards have answered to it."""

    def __init__(self, row: dict):
        self.doc_ids, self.block = row["doc_ids"], row["block"]
        self.trained = unpack(row["trained"], bool)
        self.lengths = unpack(row["lengths"], np.int32)
        self.keys = unpack_sorted(row["keys"])
        self.ids = unpack(row["ids"], np.uint32)
        self.counts = unpack(row["counts"], np.uint32)
        before = np.empty_like(self.ids)
        before[1:] = self.ids[:-1]
        firsts = np.cumsum(self.lengths) - self.lengths
        before[firsts] = np.searchsorted(self.keys, START)
        self.before = before

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of the different pairs, a place of each, and the pair of each token."""
        codes = mix(self.keys[self.before] * _STEP + self.keys[self.ids])
        return np.unique(codes, return_index=True, return_inverse=True)

    def trained_tokens(self) -> np.ndarray:
        return np.repeat(self.trained, self.lengths)


# What travels: to shards (keys and up to three values by key), back to blocks (without keys),
# and into the model (block NULL).
SENT = "shard long, block long, keys binary, a binary, b binary, c binary"
_SENT = pa.schema([("shard", pa.int64()), ("block", pa.int64())] + [(n, pa.binary()) for n in ("keys", "a", "b", "c")])


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(_SENT)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SENT)], schema=_SENT)


def shard_rows(block: int, keys: np.ndarray, values: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """A block's sorted keys and their values by shard, the first `bits` of the keys."""
    shard = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    edges = np.flatnonzero(np.diff(shard, prepend=-1))
    rows = []
    for start, stop in zip(edges, [*edges[1:], len(keys)]):
        packed = [pack(v[start:stop]) for v in values] + [None] * (3 - len(values))
        rows.append((int(shard[start]), block, pack_sorted(keys[start:stop]), *packed))
    return _sent(rows)


def shard_bits(n_keys: int) -> int:
    return max(0, (n_keys // SHARD_KEYS).bit_length())


def shard_reduce(
    sent: DataFrame, dtypes: list, reduce: Callable, purpose: str
) -> DataFrame:
    """For each shard, `reduce(keys, at, blocks, values)` on all that was sent to it.

    `at` is the place in the different `keys` of each value that came. It returns the model's
    values by key, and the answers by value. The written table has both.
    """

    def run(rows: pa.Table) -> pa.Table:
        came = sorted(rows.to_pylist(), key=lambda r: r["block"])
        keys = [unpack_sorted(r["keys"]) for r in came]
        sizes = [len(k) for k in keys]
        different, at = np.unique(np.concatenate(keys), return_inverse=True)
        values = [np.concatenate([unpack(r[c], t) for r in came]) for c, t in zip("abc", dtypes)]
        blocks = np.repeat(np.arange(len(came)), sizes)
        model, answers = reduce(different, at, blocks, values)
        shard, fill = came[0]["shard"], lambda v: [pack(x) for x in v] + [None] * (3 - len(v))
        out = [(shard, None, pack_sorted(different), *fill(model))]
        stops = np.cumsum(sizes)
        for row, stop, size in zip(came, stops, sizes):
            out.append((shard, row["block"], None, *fill([x[stop - size : stop] for x in answers])))
        return pa.Table.from_batches([_sent(out)])

    return scratch.materialize(sent.groupBy("shard").applyInArrow(run, SENT), purpose)


def reduce_counts(keys, at, blocks, values):
    """Totals by key; answers are the total and whether the block is the key's owner, the first
    of those that have counted it."""
    total = np.bincount(at, weights=values[0], minlength=len(keys)).astype(np.int64)
    counted = np.flatnonzero(values[0])
    owner = np.zeros(len(at), bool)
    owner[counted[np.unique(at[counted], return_index=True)[1]]] = True
    return [total], [total[at], owner]


def count_of_counts(table: DataFrame) -> tuple[list[int], int, int]:
    """How many keys were counted 1, 2, ... GOOD_TURING + 1 times, at all, and in total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("a").to_pylist():
                total = unpack(packed, np.int64)
                few = np.bincount(np.minimum(total, GOOD_TURING + 2), minlength=GOOD_TURING + 3)
                row = [*few[1 : GOOD_TURING + 2].tolist(), int((total > 0).sum()), int(total.sum())]
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=names)

    names = [f"n{k}" for k in range(GOOD_TURING + 3)]
    model = table.filter("block IS NULL").select("a")
    sums = model.mapInArrow(run, ", ".join(f"{n} long" for n in names)).agg(*[F.sum(n) for n in names])
    found = [x or 0 for x in sums.first()]
    return found[:-2], found[-2], found[-1]


def good_turing(seen: list[int]) -> np.ndarray:
    """Factor for each count from 0 to GOOD_TURING + 1, the last for all above.

    With too few keys of some count the factors are no discounts; then fewer counts are
    discounted, or none.
    """
    for most in range(len(seen) - 1, 0, -1):
        n = np.array(seen[: most + 1], float)
        if (n[:most] > 0).all():
            common = (most + 1) * n[most] / n[0]
            r = np.arange(1, most + 1)
            factor = ((r + 1) * n[1:] / n[:-1] / r - common) / (1 - common) if common < 1 else np.zeros(1)
            if ((factor > 0) & (factor < 1)).all():
                return np.concatenate([[0.0], factor, np.ones(len(seen) - most)])
    return np.concatenate([[0.0], np.ones(len(seen))])


class Unigrams:
    """Chance of a word alone, from its count; of any unknown word together, from zero."""

    def __init__(self, seen: list[int], n: int):
        self.factor = good_turing(seen)
        r = np.arange(1, len(seen) + 1)
        left = float(((1 - self.factor[1:]) * r * seen).sum())
        self.n = n if left > 0 else n + 1
        self.unknown = (left if left > 0 else 1.0) / self.n

    def chance(self, counts: np.ndarray) -> np.ndarray:
        known = self.factor[np.minimum(counts, len(self.factor) - 1)] * counts / self.n
        return np.where(counts > 0, known, self.unknown)


def context_reducer(factor: np.ndarray) -> Callable:
    """Divisor and backoff weight by context; a divisor of zero says that it was never seen."""
    r = np.arange(1, GOOD_TURING + 1)

    def reduce(keys, at, blocks, values):
        total, few, lower = values
        few = few.reshape(-1, GOOD_TURING)
        total = np.bincount(at, weights=total, minlength=len(keys))
        # What discounts take from the pairs that were counted once, twice, ...
        taken = np.bincount(at, weights=few @ ((1 - factor[1 : GOOD_TURING + 1]) * r), minlength=len(keys))
        lower = np.bincount(at, weights=lower, minlength=len(keys))
        # Where nothing was discounted, one more occurrence is left to what was not seen.
        divisor = total + ((total > 0) & (taken <= 1e-9 * total))
        left = (divisor - total + taken) / np.maximum(divisor, 1)
        weight = np.where(total > 0, left / np.maximum(1 - lower, 1e-300), 1.0)
        made = [divisor.astype(np.uint64), weight]
        return made, [v[at] for v in made]

    return reduce


def _map_blocks(blocks: DataFrame, make: Callable[[Block], pa.RecordBatch]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield make(Block(batch.slice(row, 1).to_pylist()[0]))

    return blocks.mapInArrow(run, SENT)


def _with_answers(blocks: DataFrame, tables: list[DataFrame], make: Callable, schema: str) -> DataFrame:
    """`make(block, answers)` for each block, answers by table as lists of packed values in the
    order of shards, which is that of the block's sorted keys."""
    own = blocks.withColumns(
        {
            "kind": F.lit(-1),
            "shard": F.lit(None).cast("long"),
            "a": F.lit(None).cast("binary"),
            "b": F.lit(None).cast("binary"),
        }
    )
    rows = [own]
    for kind, table in enumerate(tables):
        answers = table.filter("block IS NOT NULL").select("block", "shard", "a", "b")
        rows.append(answers.withColumn("kind", F.lit(kind)))
    union = rows[0]
    for more in rows[1:]:
        union = union.unionByName(more, allowMissingColumns=True)

    kinds = range(len(tables))

    def run(rows: pa.Table) -> pa.Table:
        came = rows.to_pylist()
        block = Block(next(r for r in came if r["kind"] == -1))
        answers = [sorted((r for r in came if r["kind"] == k), key=lambda r: r["shard"]) for k in kinds]
        return make(block, answers)

    return union.groupBy("block").applyInArrow(run, schema)


def _answer(rows: list[dict], column: str, dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype)] + [unpack(r[column], dtype) for r in rows])


SCORES = "doc_id long, trained boolean, n_tokens long, n_known long, base_score double, score double"


def scores(docs: DataFrame, train: Column) -> DataFrame:
    """Log10 probabilities of all texts of `docs` under a model of those for which `train` holds.

    Columns doc_id, trained, n_tokens, n_known (tokens that occur in training), train_tokens,
    base_score (words alone, 0.1 added to each count) and score.
    """
    blocks = read_blocks(docs, train)
    n_words, n_tokens = (x or 0 for x in blocks.agg(F.sum("n_keys"), F.sum("n_tokens")).first())
    word_bits, pair_bits = shard_bits(n_words), shard_bits(n_tokens)

    def send_words(block: Block) -> pa.RecordBatch:
        return shard_rows(block.block, block.keys, [block.counts], word_bits)

    words = shard_reduce(_map_blocks(blocks, send_words), [np.uint32], reduce_counts, "words")
    seen, vocabulary, n = count_of_counts(words)
    unigrams = Unigrams(seen, n)

    def send_pairs(block: Block) -> pa.RecordBatch:
        codes, _, of = block.pairs()
        counts = np.bincount(of[block.trained_tokens()], minlength=len(codes))
        return shard_rows(block.block, codes, [counts.astype(np.uint32)], pair_bits)

    pairs = shard_reduce(_map_blocks(blocks, send_pairs), [np.uint32], reduce_counts, "pairs")
    factor = good_turing(count_of_counts(pairs)[0])

    def discounted(counts: np.ndarray) -> np.ndarray:
        return factor[np.minimum(counts, len(factor) - 1)] * counts

    def send_contexts(block: Block, answers: list) -> pa.Table:
        lower = unigrams.chance(_answer(answers[0], "a", np.int64))
        counts, owned = _answer(answers[1], "a", np.int64), _answer(answers[1], "b", bool)
        _, place, _ = block.pairs()
        place, counts = place[owned], counts[owned]
        first, second = block.before[place], block.ids[place]
        size = len(block.keys)
        few = np.zeros((size, GOOD_TURING), np.uint32)
        small = counts <= GOOD_TURING
        np.add.at(few, (first[small], counts[small] - 1), 1)
        total = np.bincount(first, weights=counts, minlength=size).astype(np.uint64)
        values = [total, few, np.bincount(first, weights=lower[second], minlength=size)]
        return pa.Table.from_batches([shard_rows(block.block, block.keys, values, word_bits)])

    sent = _with_answers(blocks, [words, pairs], send_contexts, SENT)
    contexts = shard_reduce(sent, [np.uint64, np.uint32, np.float64], context_reducer(factor), "contexts")

    def score(block: Block, answers: list) -> pa.Table:
        counts = _answer(answers[0], "a", np.int64)
        divisor = _answer(answers[2], "a", np.uint64)
        weight = _answer(answers[2], "b", np.float64)
        pair_counts = _answer(answers[1], "a", np.int64)
        _, place, of = block.pairs()
        first, second = block.before[place], block.ids[place]
        backed_off = weight[first] * unigrams.chance(counts)[second]
        direct = discounted(pair_counts) / np.maximum(divisor[first], 1)
        chance = np.log10(np.where(pair_counts > 0, direct, backed_off))[of]
        base = np.log10((counts + 0.1) / (n + 0.1 * (vocabulary + 1)))[block.ids]
        starts = np.cumsum(block.lengths) - block.lengths
        total = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every text has a token
        columns = [
            pa.array(block.doc_ids, pa.int64()),
            pa.array(block.trained),
            pa.array(block.lengths.astype(np.int64)),
            pa.array(total((counts > 0)[block.ids].astype(np.int64))),
            pa.array(total(base)),
            pa.array(total(chance)),
        ]
        return pa.table(columns, names=[c.split()[0] for c in SCORES.split(", ")])

    found = _with_answers(blocks, [words, pairs, contexts], score, SCORES)
    return found.withColumn("train_tokens", F.lit(n).cast("long"))
