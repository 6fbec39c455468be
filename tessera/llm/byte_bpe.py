"""Byte-level BPE on sentencepiece: the model file is serialised here straight
from a rank file, byte by byte mapped to one character each, with pieces scored
by negative rank and identity normalisation. Pre-tokens are encoded one by one;
decoding is the inverse mapping."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tessera.llm.common import small_batches

FIRST_CHAR = 0x100          # byte b is the character FIRST_CHAR + b
CACHE_ENTRIES = 60_000  # per generation and worker; the cache only saves work
CACHED_LENGTH = 64
GROUP_CHARS = 1 << 20       # characters encoded together
UNEVEN_SPACE = regex.compile(r" \s|\s |^ | $")  # spaces that are not alone between two words


# -------------------------------------------------------------- model file
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes as length-delimited, int as varint, float as fixed 32."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


_SHIFT = {b: FIRST_CHAR + b for b in range(256)}


def to_chars(token: bytes) -> str:
    return token.decode("latin-1").translate(_SHIFT)


# Field numbers and enum values of the public sentencepiece model format.
MODEL_PIECE, MODEL_TRAINER, MODEL_NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
TYPE_UNKNOWN, TYPE_CONTROL, TYPE_UNUSED = 2, 3, 5
TRAINER_MODEL_TYPE, TRAINER_VOCAB_SIZE, TRAINER_UNK_ID, TRAINER_BOS_ID, TRAINER_EOS_ID, TRAINER_PAD_ID = 3, 4, 40, 41, 42, 43
MODEL_TYPE_BPE = 2
NORMALIZER_NAME, NORMALIZER_DUMMY_PREFIX, NORMALIZER_EXTRA_SPACES, NORMALIZER_ESCAPE_SPACES = 1, 3, 4, 5
NO_ID = (1 << 64) - 1  # -1 as a varint


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks. Scores are
    negative ranks, so that its merges take the lowest rank first and, among
    equals, the leftmost. Ranks that no token has become unused pieces."""
    by_rank = {rank: token for token, rank in ranks.items()}
    size = max(by_rank, default=-1) + 1
    out = bytearray()
    for rank in range(size):
        if rank in by_rank:
            piece = _field(PIECE_TEXT, to_chars(by_rank[rank]).encode()) + _field(PIECE_SCORE, -float(rank))
        else:
            piece = _field(PIECE_TEXT, f"<unused{rank}>".encode()) + _field(PIECE_TYPE, TYPE_UNUSED)
        out += _field(MODEL_PIECE, piece)
    out += _field(MODEL_PIECE, _field(PIECE_TEXT, b"<unk>") + _field(PIECE_TYPE, TYPE_UNKNOWN))
    out += _field(MODEL_TRAINER, _field(TRAINER_MODEL_TYPE, MODEL_TYPE_BPE) + _field(TRAINER_VOCAB_SIZE, size + 1)
                  + _field(TRAINER_UNK_ID, size) + b"".join(
                      _field(n, NO_ID) for n in (TRAINER_BOS_ID, TRAINER_EOS_ID, TRAINER_PAD_ID)))
    out += _field(MODEL_NORMALIZER, _field(NORMALIZER_NAME, b"identity") + b"".join(
        _field(n, 0) for n in (NORMALIZER_DUMMY_PREFIX, NORMALIZER_EXTRA_SPACES, NORMALIZER_ESCAPE_SPACES)))
    return bytes(out)


# ------------------------------------------------------------------- coding
class Codec:
    """Encoder for one rank file and split pattern."""

    def __init__(self, path: str, pattern: str, lone_space_starts: bool = False):
        self.ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.lone_space_starts = lone_space_starts
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        self.unknown = max(self.ranks.values(), default=-1) + 1
        # packed ids of stretches of text: the current generation and the one before it
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _merge(self, missing: list[str]) -> dict[str, bytes]:
        """Packed ids of pre-tokens. One that is itself a token needs no merges."""
        raw = [w.encode() for w in missing]
        whole = [self.ranks.get(r) for r in raw]
        apart = self.pieces.encode([to_chars(r) for r, w in zip(raw, whole, strict=True) if w is None], num_threads=1)
        merged = iter(apart)
        out = {}
        for word, rank in zip(missing, whole, strict=True):
            ids = next(merged) if rank is None else [rank]
            if rank is None and self.unknown in ids:
                raise ValueError("the rank file lacks a byte of the text")
            out[word] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def _stretches(self, text: str) -> list[str]:
        """``text`` cut where no pre-token can cross: before lone spaces between
        two characters that are not white space, if the pattern allows that.
        A stretch is named by what follows its lone space, or, if it does not
        begin with one, by a line feed and itself."""
        if not self.lone_space_starts:
            return [f"\n{text}"] if text else []
        parts = text.split(" ")
        if not UNEVEN_SPACE.search(text):
            parts[0] = f"\n{parts[0]}"
            return parts if text else []
        out = [f"\n{parts[0]}"]
        for part in parts[1:]:
            if part and not part[0].isspace() and not out[-1][-1].isspace():
                out.append(part)
            else:  # the space belongs to a longer run: keep it inside the stretch
                last = out[-1] if out[-1][0] == "\n" else f"\n {out[-1]}"
                out[-1] = f"{last} {part}"
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, packed as little-endian unsigned 32-bit."""
        cut = [self._stretches(t) for t in texts]
        needed = set().union(*cut)
        if len(self.young) > CACHE_ENTRIES:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        fresh = needed.difference(young)
        young.update({w: old[w] for w in fresh if w in old})
        made = [w for w in fresh if w not in old]
        split = [self.split(w[1:] if w[0] == "\n" else f" {w}") for w in made]
        tokens = self._merge(list({t for pre in split for t in pre}))
        young.update({w: b"".join([tokens[t] for t in pre]) for w, pre in zip(made, split, strict=True)})
        packed = [b"".join(map(young.__getitem__, words)) for words in cut]
        for w in made:
            if len(w) > CACHED_LENGTH:
                del young[w]
        return packed


class Decoder:
    """The inverse mapping of a rank file."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str, lone_space_starts: bool = False) -> Codec:
    """One codec per worker process."""
    return Codec(path, pattern, lone_space_starts)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _passthrough(df: DataFrame, run, name: str) -> DataFrame:
    schema = StructType([*df.schema.fields[:-1], StructField(name, BinaryType())])
    return small_batches(df).mapInArrow(run, schema)


OUT_BYTES = 8 << 20


def _batches(columns: list, names: list[str], made: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    """Rows of one input batch with their new last column, in batches of bounded bytes."""
    part, start, held = [], 0, 0
    for value in made:
        part.append(value)
        held += len(value)
        if held >= OUT_BYTES:
            cut = [c.slice(start, len(part)) for c in columns]
            yield pa.RecordBatch.from_arrays([*cut, pa.array(part, pa.binary())], names=names)
            part, start, held = [], start + len(part), 0
    if part:
        yield pa.RecordBatch.from_arrays([*[c.slice(start, len(part)) for c in columns], pa.array(part, pa.binary())],
                                         names=names)


def _encoded(c: Codec, texts: pa.Array) -> Iterator[bytes]:
    group, chars = [], 0
    for t in texts:
        group.append(t.as_py())
        chars += len(group[-1])
        if chars >= GROUP_CHARS:
            yield from c.encode_all(group)
            group, chars = [], 0
    yield from c.encode_all(group)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",),
           out: str = "ids", lone_space_starts: bool = True) -> DataFrame:
    """``carry`` columns and ``out``: the token ids of the whole text, packed as
    little-endian unsigned 32-bit integers. Null is the empty text, which has no
    ids. Rows are independent, so repeated rows and null keys come back as they
    are. ``path`` must name a file that every executor has.

    ``lone_space_starts`` says that ``pattern`` never joins a lone space to the
    character before it nor looks past it (true of the usual `` ?\\p{L}+``
    patterns); results of the stretches between such spaces are then cached."""
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    names = [*carry, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern, lone_space_starts)
        for b in batches:
            yield from _batches(b.columns[:-1], names, _encoded(c, b.columns[-1]))

    return _passthrough(rows, run, out)


def decode(coded: DataFrame, path: str, ids_col: str = "ids", carry: tuple[str, ...] = ("doc_id",),
           out: str = "decoded") -> DataFrame:
    """``carry`` columns and ``out``: the bytes of the packed ids."""
    rows = coded.select(*[F.col(f"`{c}`") for c in carry], F.coalesce(F.col(ids_col), F.lit(b"")).alias("__ids"))
    names = [*carry, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = decoder(path)
        for b in batches:
            yield from _batches(b.columns[:-1], names, (c.decode(i.as_py()) for i in b.columns[-1]))

    return _passthrough(rows, run, out)
