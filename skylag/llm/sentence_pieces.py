"""Encoding by a sentencepiece model that keeps the place of every piece in its text.

A text is normalised first. At each position the longest key of the model's compiled
character map (a double-array trie in the model file) is replaced by its value; where no
key fits, one character stays as it is, and a byte that is no UTF-8 becomes U+FFFD. Each
byte of the result remembers the source byte at which its replacement began. Blanks are
escaped, and put before or after the text, as the model says.

The normalised text is then cut into units between which no entry of the vocabulary can
reach, so that no merge crosses a cut, and units are segmented by the same model with its
normalisation switched off; all new units of a batch go to it in one call. A piece covers a
range of normalised bytes, which the remembered alignment turns into a range of source
bytes. Pieces of single bytes that stand for one unknown character: the last has the
character's range, those before it an empty range at its begin.

Decoding looks up the bytes of each id, as the library does: control ids give nothing, the
unknown id its surface, runs of byte pieces are read as UTF-8 with U+FFFD for each byte
that is none, and the blank that encoding put before the text goes.

Defined results: NULL and empty texts have no ids; NULL id lists and NULL ids decode to
nothing; an id outside the vocabulary is an error. Repeated rows are encoded each; empty
tables give empty tables with the same columns. Input columns with the name of an output
column are replaced. Texts are never cut short: a task holds one text, its alignment and
its ids beside small batches, and a bounded memo of units that ends with the task. Models
with user-defined symbols are an error.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import BYTES, Memo, raw_texts, slices

# Fixed values of the public model format: kinds of pieces and of models.
_UNKNOWN, _CONTROL, _USER_DEFINED, _BYTE = 2, 3, 4, 6
_BPE = 2

_BLANK = "▁"
_LOST = "�".encode()
_CACHED_UNITS = 200_000


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a serialised message; groups do not occur."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(message):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value = message[at : at + size]
            at += size
        yield tag >> 3, value


def _tagged(number: int, value: int | bytes) -> bytes:
    def varint(rest: int) -> bytes:
        out = bytearray()
        while rest > 0x7F:
            out.append(rest & 0x7F | 0x80)
            rest >>= 7
        return bytes([*out, rest])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


class CharMap:
    """The compiled character map of a model: longest-prefix replacement.

    Its bytes are the size of a trie, the trie, and replacements that end in a zero byte.
    A unit of the trie holds a label, the way to its children, and whether a value lies there.
    """

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if compiled else []
        self.values = compiled[4 + size :]

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & 1 << 9) >> 6)

    def _step(self, place: int, byte: int) -> tuple[int, int | None] | None:
        """Place after a byte and the value there, None if no key goes on so."""
        place ^= byte
        if place >= len(self.units) or self.units[place] & 0x800000FF != byte:
            return None
        unit = self.units[place]
        place ^= self._children(unit)
        return place, self.units[place] & 0x7FFFFFFF if unit >> 8 & 1 else None

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """Length of the longest key at ``start`` and what replaces it."""
        if not self.units:
            return None
        place, found = self._children(self.units[0]), None
        for at in range(start, len(text)):
            step = self._step(place, text[at])
            if step is None:
                break
            place, value = step
            if value is not None:
                found = at + 1 - start, value
        if found is None:
            return None
        return found[0], self.values[found[1] : self.values.index(0, found[1])]

    def plain(self) -> bytes:
        """ASCII characters that stay as they are before another ASCII character."""
        if not self.units:
            return bytes(range(128))
        root, out = self._children(self.units[0]), []
        for byte in range(128):
            step = self._step(root, byte)
            if step is None or step[1] is None and not any(self._step(step[0], b) for b in range(128)):
                out.append(byte)
        return bytes(out)


def _char_size(text: bytes, start: int) -> int:
    """Bytes of the UTF-8 character at ``start``; 0 if there is none."""
    first = text[start]
    size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
    try:
        return size if len(text[start : start + size].decode()) == 1 else 0
    except UnicodeDecodeError:
        return 0


@dataclass
class Normaliser:
    """Longest-prefix normalisation with the source of every byte."""

    compiled: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True
    suffix: bool = False
    chars: CharMap = field(init=False)

    def __post_init__(self):
        self.chars = CharMap(self.compiled)
        self.blank = _BLANK.encode() if self.escape else b" "
        plain = self.chars.plain().replace(b" ", b"") if self.remove_extra else self.chars.plain()
        self.run = re.compile(b"[" + re.escape(plain) + b"]+(?![\x80-\xff])") if plain else None

    def _replaced(self, text: bytes, start: int) -> tuple[bytes, int]:
        found = self.chars.longest(text, start)
        if found is not None:
            return found[1], found[0]
        size = _char_size(text, start)
        return (text[start : start + size], size) if size else (_LOST, 1)

    def _aligned(self, part: bytes, first: int) -> tuple[bytes, np.ndarray]:
        """A part that stays but for its blanks, and the source of its bytes."""
        bytes_ = np.frombuffer(part, "u1")
        places = np.arange(first, first + len(part), dtype="<i4")
        if len(self.blank) == 1:
            return part, places
        widths = np.where(bytes_ == 0x20, len(self.blank), 1)
        return part.replace(b" ", self.blank), np.repeat(places, widths)

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the source byte."""
        at, end = 0, len(text)
        if self.remove_extra:
            while at < end and (step := self._replaced(text, at))[0] == b" ":
                at += step[1]
        if at == end:
            return b"", np.zeros(1, "<i4")
        around = self.blank if self.dummy_prefix else b""
        parts, sources = [], []

        def put(part: bytes, places: np.ndarray) -> None:
            parts.append(part)
            sources.append(places)

        if not self.suffix:
            put(around, np.full(len(around), at, "<i4"))
        if not self.remove_extra and not self.chars.units and _is_utf8(text):
            put(*self._aligned(text, 0))
            at = end
        after_blank = self.remove_extra
        while at < end:
            run = self.run.match(text, at) if self.run else None
            if run:
                put(*self._aligned(run[0], at))
                at, after_blank = run.end(), False
                continue
            part, size = self._replaced(text, at)
            if after_blank:
                part = part.lstrip(b" ")
            if part:
                after_blank = self.remove_extra and part.endswith(b" ")
                part = part.replace(b" ", self.blank)
                put(part, np.full(len(part), at, "<i4"))
            at += size
        normal, source = b"".join(parts), np.concatenate(sources)
        while self.remove_extra and normal.endswith(self.blank):
            normal = normal[: -len(self.blank)]
            at, source = int(source[len(normal)]), source[: len(normal)]
        if self.suffix:
            normal += around
            source = np.concatenate([source, np.full(len(around), at, "<i4")])
        return normal, np.append(source, np.int32(at))


def _is_utf8(text: bytes) -> bool:
    try:
        text.decode()
    except UnicodeDecodeError:
        return False
    return True


def _bytes_as_text(run: bytes) -> bytes:
    """A run of byte pieces as UTF-8, each byte that is none replaced."""
    out, at = [], 0
    while at < len(run):
        size = _char_size(run, at)
        out.append(run[at : at + size] if size else _LOST)
        at += size or 1
    return b"".join(out)


class PieceModel:
    """A model file read into its parts: normaliser, vocabulary, segmenter."""

    def __init__(self, content: bytes):
        self.pieces: list[bytes] = []
        kinds, kept, trainer, spec, back = [], [], {}, {}, {}
        for number, value in _fields(content):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1])
                kinds.append(piece.get(3, 1))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                spec = dict(_fields(value))
            elif number == 5:
                back = dict(_fields(value))
            if number in (1, 2):
                kept.append(_tagged(number, value))
        self.kinds = np.asarray(kinds)
        if (self.kinds == _USER_DEFINED).any():
            raise ValueError("models with user-defined symbols are not supported")
        flags = [bool(spec.get(number, 1)) for number in (3, 4, 5)]
        self.normaliser = Normaliser(spec.get(2, b""), *flags, bool(trainer.get(24, 0)))
        self.back = Normaliser(back[2], False, False, False) if back.get(2) else None
        silent = _tagged(1, b"identity") + _tagged(3, 0) + _tagged(4, 0) + _tagged(5, 0)
        self.segmenter = sentencepiece.SentencePieceProcessor(
            model_proto=b"".join(kept) + _tagged(3, silent)
        )
        self.is_byte = self.kinds == _BYTE
        self.byte_of = np.zeros(len(kinds), "u1")
        surfaces = []
        for number, (piece, kind) in enumerate(zip(self.pieces, kinds, strict=True)):
            if kind == _BYTE:
                self.byte_of[number] = int(piece[1:-1], 16)
                surfaces.append(bytes([self.byte_of[number]]))
            elif kind == _CONTROL:
                surfaces.append(b"")
            elif kind == _UNKNOWN:
                surfaces.append(trainer.get(44, " ⁇ ".encode()))
            else:
                surfaces.append(piece.replace(_BLANK.encode(), b" "))
        self.surfaces = pa.array(surfaces, pa.large_binary())
        widths = [1 if k == _BYTE else len(p) for p, k in zip(self.pieces, kinds, strict=True)]
        self.widths = np.asarray(widths, "<i4")
        self.units = self._cutter() if trainer.get(3, 1) == _BPE else None

    def _cutter(self) -> re.Pattern:
        """Cuts where no piece of the vocabulary holds both neighbours, so none is merged across."""
        merged = ~np.isin(self.kinds, (_UNKNOWN, _CONTROL, _BYTE))
        texts = [piece.decode() for piece, use in zip(self.pieces, merged, strict=True) if use]
        joined = set().union(*(t for t in texts if len(t) > 1))
        alone = re.escape("".join(c for c in map(chr, range(128)) if c not in joined))
        if any(re.search(f"[^{_BLANK}]{_BLANK}", t) for t in texts):
            words = f"[^{alone}]+" if alone else r"[\s\S]+"
        else:
            words = f"{_BLANK}*[^{_BLANK}{alone}]+|{_BLANK}+"
        return re.compile(f"[{alone}]|{words}" if alone else words)

    def segmented(self, units: list[str]) -> list[bytes]:
        """For each unit its (id, width in bytes) pairs as little-endian 32-bit numbers."""
        lists = self.segmenter.encode(units, num_threads=1)
        ends = np.cumsum([len(ids) for ids in lists])
        ids = np.fromiter(itertools.chain.from_iterable(lists), "<i4", ends[-1])
        widths = self.widths[ids]
        if (self.kinds[ids] == _UNKNOWN).any():
            # An unknown piece is as wide as what it stands for.
            texts = self.segmenter.encode(units, num_threads=1, out_type=str)
            widths = np.asarray([len(p.encode()) for own in texts for p in own], "<i4")
        raw = np.column_stack([ids, widths]).tobytes()
        bounds = (8 * ends).tolist()
        return [raw[a:b] for a, b in zip([0, *bounds], bounds, strict=False)]

    def memo(self) -> Memo:
        return Memo(lambda unit: self.segmented([unit])[0], _CACHED_UNITS)

    def encode(self, texts: list[bytes], memo: Memo) -> Iterator[tuple[np.ndarray, ...]]:
        """ids, begins and ends of each text, one after the other."""
        normal = [self.normaliser(text) for text in texts]
        cut = self.units.findall if self.units else lambda text: [text] if text else []
        units = [cut(text.decode()) for text, _ in normal]
        new = [u for u in memo.lacks(set().union(*units)) if len(u) <= memo.longest]
        for unit, found in zip(new, self.segmented(new) if new else [], strict=True):
            memo.put(unit, found)
        for own, (_, source) in zip(units, normal, strict=True):
            pairs = np.frombuffer(b"".join(map(memo.__getitem__, own)), "<i4").reshape(-1, 2)
            yield pairs[:, 0], *self._spans(pairs[:, 0], pairs[:, 1], source)

    def _spans(self, ids: np.ndarray, widths: np.ndarray, source: np.ndarray):
        """Source ranges of pieces that follow each other in a normalised text."""
        ends = np.cumsum(widths)
        begins = ends - widths
        single = np.flatnonzero(self.is_byte[ids])
        if len(single):
            # Bytes of one character: all begin with it, and only the last one ends after it.
            goes_on = self.byte_of[ids[single]] & 0xC0 == 0x80
            first = np.maximum.accumulate(np.where(goes_on, 0, np.arange(len(single))))
            start = begins[single][first]
            last = np.append(~goes_on[1:], True)
            ends[single] = np.where(last, ends[single], start)
            begins[single] = start
        return source[begins], source[ends]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The texts of lists of ids that follow each other, as UTF-8.

        A list lies between two neighbouring ``bounds``.
        """
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.pieces)):
            raise ValueError("an id lies outside the vocabulary")
        found = self.surfaces.take(pa.array(ids))
        _, offsets, data = found.buffers()
        places = np.frombuffer(offsets, "<i8")[: len(ids) + 1] if len(ids) else np.zeros(1, "<i8")
        whole = data.to_pybytes() if data is not None else b""
        edges = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        return [self._text(ids[a:b], whole, places[a : b + 1]) for a, b in edges]

    def _text(self, ids: np.ndarray, surfaces: bytes, places: np.ndarray) -> bytes:
        """One text out of the surfaces of its ids, which lie between places."""
        text = surfaces[places[0] : places[-1]]
        if not _is_utf8(text) or (self.kinds[ids] == _CONTROL).any():
            # A run of byte pieces may be no UTF-8; control ids divide runs.
            single = self.is_byte[ids]
            starts = np.flatnonzero(np.diff(single, prepend=~single[:1])).tolist()
            runs = [
                (single[a], surfaces[places[a] : places[b]])
                for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)
            ]
            text = b"".join(_bytes_as_text(run) if alone else run for alone, run in runs)
        text = text[self._blanks_before(ids) :]
        return self.back(text)[0] if self.back else text

    def _blanks_before(self, ids: np.ndarray) -> int:
        """How many bytes the blank put before the text takes."""
        if not (self.normaliser.dummy_prefix or self.normaliser.remove_extra):
            return 0
        gone = 0
        for number in ids.tolist():
            if self.kinds[number] == _CONTROL:
                continue
            starts = self.kinds[number] != _UNKNOWN and self.pieces[number].startswith(_BLANK.encode())
            gone += starts
            alone = starts and self.pieces[number] == _BLANK.encode()
            if not (alone and self.normaliser.remove_extra):
                break
        return gone


@functools.lru_cache(maxsize=2)
def piece_model(content: bytes) -> PieceModel:
    """The model of a file's content; a worker reads it once. Memos are not kept with it."""
    return PieceModel(content)


def _file(df: DataFrame, path: str):
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def _others(df: DataFrame, names: list[str]) -> list[str]:
    given = {name.lower() for name in names}
    return [c for c in df.columns if c.lower() not in given]


def encode(
    df: DataFrame,
    model_file: str,
    text: str = "text",
    ids: str = "ids",
    begins: str = "begins",
    ends: str = "ends",
) -> DataFrame:
    """Add the ids of each text and the bytes of the text at which each begins and ends."""
    content = _file(df, model_file)
    made = [ids, begins, ends]
    kept = _others(df, made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(content.value)
        memo = model.memo()
        for batch in slices(batches, 256):
            done, parts, size = 0, [], 0
            for at, found in enumerate(model.encode(raw_texts(batch[text]), memo)):
                parts.append(found)
                size += 12 * len(found[0])
                if size > BYTES or at + 1 == batch.num_rows:
                    rows = batch.slice(done, at + 1 - done)
                    lists = [_lists([part[k] for part in parts]) for k in range(3)]
                    yield pa.record_batch([*(rows[c] for c in kept), *lists], [*kept, *made])
                    done, parts, size = at + 1, [], 0

    fields = [df.schema[c] for c in kept]
    fields += [T.StructField(name, T.ArrayType(T.IntegerType())) for name in made]
    return df.mapInArrow(run, T.StructType(fields))


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, "<i4")
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts).astype("<i4")))


def decode(df: DataFrame, model_file: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text, as UTF-8 bytes, that each list of ids stands for."""
    content = _file(df, model_file)
    kept = _others(df, [out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(content.value)
        for batch in slices(batches, 256):
            lists, columns = batch[ids], [batch[c] for c in kept]
            # Lists that are NULL hold no values here, and NULL ids go.
            flat = lists.flatten()
            bounds = np.append(0, np.cumsum(np.asarray(lists.value_lengths().fill_null(0))))
            if flat.null_count:
                bounds = np.append(0, np.cumsum(np.asarray(flat.is_valid())))[bounds]
            parts = model.decode(flat.drop_null().to_numpy(), bounds)
            yield pa.record_batch([*columns, pa.array(parts, pa.binary())], [*kept, out])

    fields = [df.schema[c] for c in kept]
    return df.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.BinaryType())]))
