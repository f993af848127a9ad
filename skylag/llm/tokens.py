"""Token ids of whole documents, cut into pieces that fit a sequence."""

from __future__ import annotations

import functools
import string
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import Memo, raw_texts, slices

# Words encoded by one call, and parts remembered (some 200 bytes each, twice as many at most).
_TOGETHER, _REMEMBERED = 1000, 500_000


def plain_word(text: str) -> str | None:
    """The form in which the tokenizer sees a word of letters alone; None for other texts."""
    if "\u03a3" in text:
        return None  # Python lower-cases this letter by its place in a word, the tokenizer does not
    word = unicodedata.normalize("NFC", text).lower()
    return word if word.isalpha() and unicodedata.is_normalized("NFC", word) else None


class WordTokens:
    """Ids by a lower-casing tokenizer that drops white space, from a memo of its words.

    Such a tokenizer treats what stands between white space by itself, so a text
    is cut at ASCII white space and each part is encoded once. Most parts are a word of
    letters, perhaps with punctuation after it, which is a run of its own. New words of
    letters are encoded many at a time and told apart by the mark at a word's end.
    """

    def __init__(self, content: str):
        self.tokenizer = tokenizers.Tokenizer.from_str(content)
        self.parts = Memo(self._part, _REMEMBERED)
        suffix = self.tokenizer.model.end_of_word_suffix
        size = self.tokenizer.get_vocab_size()
        names = map(self.tokenizer.id_to_token, range(size))
        self.ends_word = np.asarray([bool(suffix) and (n or "").endswith(suffix) for n in names])

    def _ids(self, text: str) -> np.ndarray:
        (encoded,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(encoded.ids, "<u4")

    def _part(self, part: bytes) -> bytes:
        text = part.decode("utf-8", "replace")
        word = plain_word(text)
        if word is None:
            stem = text.rstrip(string.punctuation)
            word = plain_word(stem)
            if word is not None:
                return self.parts[word.encode()] + self.parts[text[len(stem) :].encode()]
        if word is not None and word != text:
            return self.parts[word.encode()]
        return self._ids(text).tobytes()

    def learn(self, texts: list[list[bytes]]) -> None:
        """Encode the new parts of some texts that are words of letters, with what follows them."""
        forms = []
        for part in self.parts.lacks(set().union(*texts)):
            if len(part) <= self.parts.longest:
                text = part.decode("utf-8", "replace")
                stem = text.rstrip(string.punctuation)
                word = plain_word(stem)
                if word is not None:
                    forms.append((part, word.encode(), text[len(stem) :].encode()))
        new = [w.decode() for w in self.parts.lacks({word for _, word, _ in forms})]
        for start in range(0, len(new), _TOGETHER):
            some = new[start : start + _TOGETHER]
            ids = self._ids(" ".join(some))
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(some):
                continue  # not one run for each word: left to be encoded one by one
            raw, begin = ids.tobytes(), 0
            for word, end in zip(some, (4 * ends).tolist(), strict=True):
                self.parts.put(word.encode(), raw[begin:end])
                begin = end
        parts = self.parts
        for part, word, tail in forms:
            if part != word:
                parts.put(part, parts[word] + parts[tail] if tail else parts[word])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit numbers."""
        split = [text.split() for text in texts]
        self.learn(split)
        return [b"".join(map(self.parts.__getitem__, parts)) for parts in split]


@functools.lru_cache(maxsize=2)
def word_tokens(content: str) -> WordTokens:
    """The encoder of a tokenizer file's content; a worker builds it once, tasks empty its memo."""
    return WordTokens(content)


def cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: all full but perhaps the last."""
    return [(start, min(capacity, size - start)) for start in range(0, size, capacity)]


PIECE_FIELDS = [
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
]


def pieces(
    df: DataFrame,
    tokenizer_file: str,
    end_id: int,
    capacity: int,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece of each document: key, piece, start, length, checksum.

    A document is its ids and then ``end_id``; NULL and empty texts are the end
    alone. ``with_ids`` adds the ids as little-endian unsigned 32-bit numbers.
    Other columns are left out. A task holds one document beside small batches.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        content = df.sparkSession.sparkContext.broadcast(file.read())
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(content.value)
        try:
            yield from cut_batches(encoder, batches)
        finally:
            encoder.parts.forget()

    def cut_batches(encoder: WordTokens, batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[int] = []
            columns: list[list] = [[], [], [], [], []]
            for at, ids in enumerate(encoder.encode(raw_texts(batch[text]))):
                ids += end
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append(at)
                    given = (number, start, length, zlib.crc32(own), own if with_ids else None)
                    for column, cell in zip(columns, given, strict=True):
                        column.append(cell)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            taken = batch[key].take(pa.array(rows, pa.int64()))
            yield pa.record_batch([taken, *made][: len(names)], names)

    fields = [df.schema[key], *PIECE_FIELDS]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType(fields)
    names = schema.fieldNames()
    return df.select(key, text).mapInArrow(run, schema)
