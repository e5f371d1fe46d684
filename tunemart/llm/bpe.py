"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

`encode` adds the ids of a text, `decode` turns ids back into bytes. Ids are stored packed, as
little-endian unsigned 32-bit integers, which is how training shards hold them.

Defined cases: a NULL text counts as empty; an empty text has no ids; a text of any length is
encoded whole; equal rows give equal results; an empty table gives an empty one. Other columns
of the input are not touched: the caller names those to carry along, and a name that is also
one of the added columns is an error.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemart.llm.common import slices

# White space with what follows it: letters up to a mark, or all up to more white space.
# Python also counts 1C to 1F as white space, the tokenizers don't.
_SPACE, _REST, _MARK = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]", r"[!-/:-@\[-`{-~]"
WORDS = rf"{_SPACE}*[A-Za-zÀ-ÖØ-öø-ɏ]+(?={_MARK})|{_SPACE}*{_REST}+|{_SPACE}+"

# Different words of which a worker remembers the ids, before it starts anew.
REMEMBERED = 200_000

# Text that is cut into words at a time: each word of it is an object for a while.
WORD_BYTES = 2 * 1024**2

ADDED = T.StructType(
    [
        T.StructField("ids", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)
OFFSETS = T.StructType(
    [
        T.StructField("char_starts", T.BinaryType()),
        T.StructField("char_ends", T.BinaryType()),
        T.StructField("byte_starts", T.BinaryType()),
    ]
)


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=4)
def read_ranks(document: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    pairs = (line.split() for line in document.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def spell(document: bytes) -> dict[str, int]:
    """The vocabulary as the library takes it: a character for each byte."""
    chars = byte_characters()
    return {"".join(chars[b] for b in token): rank for token, rank in read_ranks(document).items()}


@lru_cache(maxsize=4)
def tokenizer(document: bytes, pattern: str):
    """A tokenizer that merges by rank inside each match of `pattern`.

    A rank file names tokens, not pairs: every pair of tokens that makes up a token may merge,
    with that token's rank. A match that is itself a token is taken as it is.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    ranks, vocabulary = read_ranks(document), spell(document)
    chars = byte_characters()
    spelled = {token: "".join(chars[b] for b in token) for token in ranks}
    merges = [
        (spelled[token[:i]], spelled[token[i:]])
        for token in sorted(ranks, key=ranks.get)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    # No cache of words in the library: `Words` has them.
    made = Tokenizer(models.BPE(vocabulary, merges, ignore_merges=True, cache_capacity=0))
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return made


@lru_cache(maxsize=4)
def token_bytes(document: bytes) -> list[bytes]:
    """Bytes of each id, by reversing the byte table on the vocabulary."""
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    vocabulary = spell(document)
    found = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for spelled, rank in vocabulary.items():
        found[rank] = bytes(byte_of[c] for c in spelled)
    return found


class Words(dict):
    """Ids of each different word (packed), and where its tokens start and end in it."""

    def __init__(self, made, offsets: bool):
        self.made, self.offsets = made, offsets

    def learn(self, words) -> None:
        words = {*words}
        new = list(words - self.keys())
        if len(new) + len(self) > REMEMBERED:
            self.clear()
            new = list(words)
        for k in range(0, len(new), 10_000):
            part = new[k : k + 10_000]
            encode_all = self.made.encode_batch if self.offsets else self.made.encode_batch_fast
            for word, found in zip(part, encode_all(part, add_special_tokens=False)):
                spans = np.array(found.offsets, "<u4").reshape(-1, 2) if self.offsets else None
                self[word] = (pack(found.ids), spans) if self.offsets else pack(found.ids)


@lru_cache(maxsize=2)
def worker_words(document: bytes, pattern: str, offsets: bool) -> Words:
    """One memory for all tasks of a worker."""
    return Words(tokenizer(document, pattern), offsets)


def pack(numbers) -> bytes:
    return np.asarray(numbers, "<u4").tobytes()


def unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4")


def decode_ids(ids, table: list[bytes]) -> bytes:
    """The bytes of a sequence of ids; an id beyond the vocabulary is an error."""
    return b"".join([table[i] for i in ids])


def decode_pieces(pieces, table: list[bytes]) -> Iterator[str]:
    """Text of consecutive pieces of one sequence of ids.

    A piece may end inside a character: its first bytes wait for the next piece. Bytes that
    are no character in the end become U+FFFD.
    """
    decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
    for piece in pieces:
        yield decoder.decode(decode_ids(piece, table))
    if rest := decoder.decode(b"", final=True):
        yield rest


def _spans(words: list[str], known: Words) -> np.ndarray:
    """First and last character of each token of a text."""
    found, at = [np.zeros((0, 2), np.int64)], 0
    for word in words:
        found.append(known[word][1].astype(np.int64) + at)
        at += len(word)
    return np.concatenate(found)


def _check_names(keep: list[str], added: T.StructType) -> None:
    if clash := {*keep} & {*added.fieldNames()}:
        raise ValueError(f"columns {sorted(clash)} are added here; rename them first")


def encode(
    df: DataFrame,
    document: bytes,
    pattern: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    offsets: bool = False,
    words: str = WORDS,
) -> DataFrame:
    """Columns `keep`, `ids` (packed) and `n_tokens`; no special tokens are made.

    Texts are cut into `words` first and each different word is encoded once in a while. That
    is exact where no match of `pattern` reaches over the end of a word; by default, where
    none goes on from a mark or word into white space, or from a letter into a mark.
    `(?s).+` takes texts whole.

    With `offsets` also, packed for each token: the characters of the text that it covers
    (start, end) and the byte at which it starts. Tokens that split a character cover it
    all, so that their character ranges overlap; their byte starts do not.
    """
    added = T.StructType(ADDED.fields + (OFFSETS.fields if offsets else []))
    _check_names(list(keep), added)
    shared = df.sparkSession.sparkContext.broadcast(document)  # one vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_words(shared.value, pattern, offsets)
        sizes = np.array([len(b) for b in token_bytes(shared.value)]) if offsets else None
        cut = re.compile(words).findall
        for batch in slices(batches, "_text", WORD_BYTES):
            cuts = [cut(t or "") for t in batch.column("_text").to_pylist()]
            known.learn(chain.from_iterable(cuts))
            if offsets:
                ids = [b"".join([known[w][0] for w in c]) for c in cuts]
            else:
                ids = [b"".join([known[w] for w in c]) for c in cuts]
            columns = [
                pa.array(ids, pa.binary()),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
            ]
            if offsets:
                spans = [_spans(c, known) for c in cuts]
                columns += [pa.array([pack(x[:, k]) for x in spans], pa.binary()) for k in (0, 1)]
                lengths = [sizes[unpack(x)] for x in ids]
                columns.append(pa.array([pack(n.cumsum() - n) for n in lengths], pa.binary()))
            kept = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays(kept + columns, names=[*keep, *added.fieldNames()])

    picked = df.select(*keep, F.col(text).alias("_text"))
    schema = T.StructType([df.schema[k] for k in keep] + added.fields)
    return picked.mapInArrow(run, schema)


def decode(
    df: DataFrame, document: bytes, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """All columns and the bytes that packed ids stand for; NULL ids count as none."""
    _check_names(df.columns, T.StructType([T.StructField(decoded, T.BinaryType())]))
    shared = df.sparkSession.sparkContext.broadcast(document)
    names = [*df.columns, decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(shared.value)
        for batch in slices(batches, ids):
            packed = batch.column(ids).to_pylist()
            texts = pa.array([decode_ids(unpack(p or b"").tolist(), table) for p in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=names)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(decoded, T.BinaryType())]))
