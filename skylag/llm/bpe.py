"""Byte-level BPE encoding and decoding by a serialised sentencepiece model.

A rank file holds byte strings and their ranks. From it a sentencepiece BPE model
is written directly, without training: each byte becomes one character that
sentencepiece treats like any other, each vocabulary entry becomes a piece whose
score is its negative rank, and normalisation is the identity. Sentencepiece
merges the pair of the best score first, which is the pair of the lowest rank, and
the leftmost of equals, so its pieces are those of the byte-level merges. Piece
numbers equal ranks; the unknown piece, which cannot occur, comes last.

Texts are first cut by the vocabulary's pattern. A match that is an entry by
itself is that entry; every other match goes through sentencepiece. Decoding looks
up the bytes of each id and joins them.

Defined results: NULL and empty texts have no ids; NULL ids decode to no bytes;
an id outside the vocabulary is an error, as no bytes stand for it. Repeated rows
are encoded each; empty tables give empty tables with the same columns. An input
column with the name of the output column is replaced. Texts are never cut short:
a task holds one text and its ids at a time beside small batches.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import BYTES, Memo, raw_texts, slices

# Bytes become the characters U+0100 to U+01FF: no space, control or mark among them.
_FIRST = 0x100
_BYTE_CHARS = {b: _FIRST + b for b in range(256)}
# A unit starts at a space; only where white space stands on both sides of that
# space may a match of the pattern cross it.
_CROSSING = re.compile(r"\s \s|\s \Z")


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks from the content of a rank file: base64 and rank on each line."""
    pairs = (line.split() for line in content.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _block(field: int, payload: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(payload)) + payload


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def as_chars(piece: bytes) -> str:
    """One character for each byte."""
    return piece.decode("latin-1").translate(_BYTE_CHARS)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model whose piece numbers are the ranks.

    Field numbers are those of the public model format: pieces (1: text 1, score
    2, kind 3), trainer (2: kind of model 3, size 4, unknown piece 40), and
    normaliser (3: name 1, dummy prefix 3, extra spaces 4, escaping 5).
    """
    ordered = sorted(ranks.items(), key=lambda item: item[1])
    if [rank for _, rank in ordered] != list(range(len(ordered))):
        raise ValueError("ranks must run from 0 without gaps")
    normal, unknown, bpe = 1, 2, 2
    out = []
    for piece, rank in ordered:
        score = b"\x15" + np.float32(-rank).tobytes()
        out.append(_block(1, _block(1, as_chars(piece).encode()) + score + _number(3, normal)))
    out.append(_block(1, _block(1, b"<unk>") + b"\x15" + bytes(4) + _number(3, unknown)))
    size = len(ordered) + 1
    # Begin, end and padding pieces are switched off by -1, a ten-byte number.
    off = (1 << 64) - 1
    trainer = _number(3, bpe) + _number(4, size) + _number(40, size - 1)
    trainer += _number(41, off) + _number(42, off) + _number(43, off)
    normaliser = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(out) + _block(2, trainer) + _block(3, normaliser)


class ByteBpe:
    """Encoder and decoder of one vocabulary; encoded units are remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        self.units = Memo(lambda unit: self._encode_units([unit])[0])
        self.pieces = [piece for piece, _ in sorted(ranks.items(), key=lambda item: item[1])]

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit; all pre-tokens that are no entries go to the model in one call."""
        split = [self.pattern.findall(unit) for unit in units]
        found: dict[str, bytes] = {}
        unknown = []
        for match in set().union(*split):
            rank = self.ranks.get(match.encode())
            if rank is None:
                unknown.append(match)
            else:
                found[match] = rank.to_bytes(4, "little")
        if unknown:
            lists = self.model.encode([as_chars(m.encode()) for m in unknown], num_threads=1)
            ends = np.cumsum([4 * len(ids) for ids in lists]).tolist()
            flat = np.fromiter(itertools.chain.from_iterable(lists), "<i4", ends[-1] // 4)
            raw, begin = flat.tobytes(), 0
            for match, end in zip(unknown, ends, strict=True):
                found[match] = raw[begin:end]
                begin = end
        return [b"".join([found[match] for match in own]) for own in split]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit numbers."""
        return self.encode_texts([text])[0]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of some whole texts.

        Words with their leading space are looked up at once where no match of
        the pattern can span two of them; other texts go through as one unit.
        """
        split = []
        for text in texts:
            if _CROSSING.search(text):
                split.append([text])
            else:
                first, *rest = text.split(" ")
                split.append([first, *[" " + word for word in rest]])
        units = self.units
        new = [u for u in units.lacks(set().union(*split)) if len(u) <= units.longest]
        for unit, ids in zip(new, self._encode_units(new), strict=True):
            units.put(unit, ids)
        get = units.__getitem__
        return [b"".join(map(get, own)) for own in split]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))


@functools.lru_cache(maxsize=2)
def codec(content: bytes, pattern: str) -> ByteBpe:
    """The codec of a rank file's content; a worker builds it once, tasks empty its memo."""
    return ByteBpe(read_ranks(content), pattern)


def _kept(df: DataFrame, name: str) -> list[str]:
    return [c for c in df.columns if c.lower() != name.lower()]


def id_lists(parts: list[bytes]) -> pa.ListArray:
    """One list of ids for each byte string."""
    offsets = np.zeros(len(parts) + 1, "i4")
    np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(parts), "<i4")))


def encode(
    df: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """Add the list of ids of each text; all other columns stay."""
    with open(rank_file, "rb") as file:
        content = df.sparkSession.sparkContext.broadcast(file.read())
    kept = _kept(df, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(content.value, pattern)
        try:
            # Ids take about as much room as the text, seldom up to four times of it.
            for batch in slices(batches, 256):
                values = [v.decode("utf-8", "replace") for v in raw_texts(batch[text])]
                parts = bpe.encode_texts(values)
                sizes = np.cumsum([len(p) for p in parts])
                # As many texts as reach ``BYTES`` of ids go on together.
                groups = np.append(0, np.flatnonzero(np.diff((sizes - 1) // BYTES)) + 1).tolist()
                for a, b in zip(groups, [*groups[1:], batch.num_rows], strict=True):
                    columns = [batch[c].slice(a, b - a) for c in kept]
                    yield pa.record_batch([*columns, id_lists(parts[a:b])], [*kept, ids])
        finally:
            bpe.units.forget()

    fields = [df.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(run, schema)


def decode(
    df: DataFrame, rank_file: str, pattern: str, ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """Add the bytes that each list of ids stands for; all other columns stay."""
    with open(rank_file, "rb") as file:
        content = df.sparkSession.sparkContext.broadcast(file.read())
    kept = _kept(df, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(content.value, pattern)
        for batch in slices(batches, 256):
            lists = batch[ids]
            flat = lists.values.to_numpy(zero_copy_only=False)
            offsets = lists.offsets.to_numpy()
            present = lists.is_valid().to_pylist()
            parts = [
                bpe.decode(flat[offsets[i] : offsets[i + 1]]) if present[i] else b""
                for i in range(batch.num_rows)
            ]
            columns = [batch[c] for c in kept]
            yield pa.record_batch([*columns, pa.array(parts, pa.binary())], [*kept, out])

    fields = [df.schema[c] for c in kept]
    return df.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.BinaryType())]))


def digests(encoded: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Number of ids, and SHA-256 of the ids in decimal and of the decoded bytes."""
    joined = F.concat_ws(",", F.col(ids).cast("array<string>"))
    return encoded.withColumns(
        {
            "n_tokens": F.size(ids).cast("long"),
            "ids_sha256": F.sha2(joined, 256),
            "decoded_sha256": F.sha2(F.col(decoded), 256),
        }
    )
