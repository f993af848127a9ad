import hashlib
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_pb2

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import DOCUMENTS, documents, saved, table  # noqa: E402

from skylag.llm import sentence_pieces  # noqa: E402
from skylag.llm.queries import QUERIES  # noqa: E402

MODEL_FILE = public_tokenizers.path("piece_bpe_32k.model")
CONTENT = Path(MODEL_FILE).read_bytes()
OWN = sentence_pieces.PieceModel(CONTENT)
OTHER = sentencepiece.SentencePieceProcessor(model_proto=CONTENT)
ODD = ["", None, " ", "  ", "a   b", "▁", "▁▁ a", "<s>x</s>", "<0x0A>\n", "x" * 5000, "é漢🙂\x00\x1c", "0" * 300]


def encoded(texts):
    return list(OWN.encode([t.encode() for t in texts], OWN.memo()))


def decoded(ids):
    return OWN.decode(np.asarray(ids, "<i4"), np.asarray([0, len(ids)]))[0].decode()


def by_library(text):
    """ids and byte ranges of a text."""
    found = sentencepiece_pb2.SentencePieceText()
    found.ParseFromString(OTHER.encode(text, out_type="serialized_proto"))
    return [p.id for p in found.pieces], [(p.begin, p.end) for p in found.pieces]


def digest(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def check(texts):
    for text, (ids, begins, ends) in zip(texts, encoded(texts), strict=True):
        assert (ids.tolist(), list(zip(begins.tolist(), ends.tolist(), strict=True))) == by_library(text)
        assert decoded(ids) == OTHER.decode(ids.tolist())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" ▁\n\tabthe.1é́漢🙂\x00ß<>/s", max_size=30), max_size=4))
def test_ids_and_ranges_equal_the_library(texts):
    check(texts)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    check([text])


def test_a_very_long_text():
    check(["word " * 60_000 + "x" * 20_000])


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.one_of(st.integers(0, 2), st.integers(3, 258), st.integers(259, 31999), st.just(29871)),
        max_size=12,
    )
)
def test_any_ids_decode_as_by_the_library(ids):
    assert decoded(ids) == OTHER.decode(ids)


def test_an_id_outside_the_vocabulary_is_an_error():
    with pytest.raises(ValueError):
        decoded([32000])


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("flags", [(1, 1, 1), (0, 1, 0), (1, 0, 1), (0, 0, 0)])
@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAéé①㌀ ﬁ　ｱﾞが​\x00\t\nBC▁Ⅷ½", max_size=30))
def test_normalisation_by_a_character_map(rule, flags, text):
    dummy, extra, escape = map(bool, flags)
    other = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=dummy, remove_extra_whitespaces=extra, escape_whitespaces=escape
    )
    spec = dict(sentence_pieces._fields(dict(sentence_pieces._fields(other.serialized_model_proto()))[3]))
    raw = text.encode()
    normal, source = sentence_pieces.Normaliser(spec.get(2, b""), dummy, extra, escape)(raw)
    wanted, places = other.normalize(text, with_offsets=True)
    assert normal.decode() == wanted
    starts = np.cumsum([0, *(len(c.encode()) for c in wanted)])
    assert [len(raw[: source[s]].decode()) for s in starts] == list(places)


def test_bytes_that_are_no_text():
    normal, source = sentence_pieces.Normaliser(dummy_prefix=False, remove_extra=False)(b"a\xffb\xe4\xb8")
    assert normal.decode() == "a�b��" and source.tolist() == [0, 1, 1, 1, 2, 3, 3, 3, 4, 4, 4, 5]


def test_query_equals_the_library(spark, sf_dir):
    found = {r.doc_id: r for r in QUERIES["op12_sentence_pieces"](spark, sf_dir).collect()}
    rows = table(sf_dir, "documents")
    assert len(found) == len(rows)
    for doc_id, text, *_ in rows:
        ids, got = OTHER.encode(text), found[doc_id]
        assert (got.n_tokens, got.ids_sha256) == (len(ids), digest(",".join(map(str, ids)).encode()))
        assert got.decoded_sha256 == digest(OTHER.decode(ids).encode())
        assert got.n_bytes_covered == len(text.encode())


def test_odd_texts_repeated_rows_and_null_keys(spark, tmp_path):
    rows = [*documents(ODD + ODD), (None, "a b", None, None, None)]
    folder = saved(spark, tmp_path, rows, DOCUMENTS)
    found = QUERIES["op12_sentence_pieces"](spark, folder).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, text in enumerate([*ODD, *ODD]):
        ids = OTHER.encode(text or "")
        assert (by_id[i].n_tokens, by_id[i].n_bytes_covered) == (len(ids), len((text or "").encode()))
        assert by_id[i].decoded_sha256 == digest(OTHER.decode(ids).encode())


def test_empty_table_clashing_columns_and_null_ids(spark):
    df = spark.createDataFrame([], "text string, ids string, Begins int, ends int, decoded int")
    out = sentence_pieces.decode(sentence_pieces.encode(df, MODEL_FILE), MODEL_FILE)
    assert out.columns == ["text", "ids", "begins", "ends", "decoded"] and out.count() == 0
    lists = spark.createDataFrame([(None, 1), ([], 2), ([None, 15043, None], 3)], "ids array<int>, k int")
    got = {r.k: bytes(r.decoded) for r in sentence_pieces.decode(lists, MODEL_FILE).collect()}
    assert got == {1: b"", 2: b"", 3: OTHER.decode([15043]).encode()}
