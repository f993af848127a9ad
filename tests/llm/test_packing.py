import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import DOCUMENTS, documents, saved, table  # noqa: E402

from skylag.llm import packing, token_output, tokens  # noqa: E402
from skylag.llm.bpe import read_ranks  # noqa: E402
from skylag.llm.queries import QUERIES  # noqa: E402

WORDS = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
OWN = tokens.WordTokens(Path(public_tokenizers.path("word_bpe_49k.json")).read_text())
ODD = ["", None, "word", "x " * 9000, "Ça va, İstanbul ΟΔΟΣ. ΣΑΣ'Σ", "\n \t", "漢字 🙂", "<|endoftext|>"]


def word_ids(text):
    return np.frombuffer(OWN.encode([text.encode()])[0], "<u4").tolist()


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=" \n\t\x1c aZé's.,Σσİß漢🙂1٣-_́<|>", max_size=24))
def test_word_ids_equal_those_of_whole_texts(text):
    assert word_ids(text) == WORDS.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=50))
def test_word_ids_of_any_text(text):
    assert word_ids(text) == WORDS.encode(text, add_special_tokens=False).ids


def checked_plan(lengths, capacity):
    counts = np.bincount(lengths, minlength=capacity + 1)
    patterns = packing.plan(counts, capacity)
    used = Counter()
    for number, pattern in patterns:
        assert number > 0 and sum(n * t for n, t in pattern) <= capacity
        for length, times in pattern:
            used[length] += number * times
    assert used == Counter(lengths)
    return sum(n for n, _ in patterns), len(patterns)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60))
def test_plan_uses_every_length_once(lengths):
    checked_plan(lengths, 30)


def test_plan_finds_exact_complements():
    # Triples, pairs and singles of which a greedy order would waste room.
    assert checked_plan([60, 40, 50, 30, 20, 55, 25, 11, 9], 100)[0] == 3
    assert checked_plan([51, 27, 26, 23, 49, 48, 47, 29], 100)[0] <= 4


def test_plan_is_near_the_bound_and_short():
    rng = np.random.default_rng(3)
    lengths = np.minimum(rng.lognormal(5.5, 1.2, 200_000).astype(int) + 1, 4096)
    number, entries = checked_plan(lengths.tolist(), 4096)
    assert number <= np.ceil(lengths.sum() / 4096) * 1.002
    assert entries < 20_000


def placed(rows, capacity=4096):
    """Whether the pieces of each sequence lie gapless from 0 within the capacity."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def check_documents(rows, texts):
    found = defaultdict(list)
    for r in rows:
        found[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    total = 0
    for doc_id, text in texts.items():
        ids = [*WORDS.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        want = [
            (i, s, len(ids[s : s + 4096]), zlib.crc32(np.asarray(ids[s : s + 4096], "<u4").tobytes()))
            for i, s in enumerate(range(0, len(ids), 4096))
        ]
        assert sorted(found[doc_id]) == want
    assert len(found) == len(texts)
    return total


def test_query(spark, sf_dir):
    rows = QUERIES["op4_best_fit_packing"](spark, sf_dir).collect()
    total = check_documents(rows, {r[0]: r[1] for r in table(sf_dir, "documents")})
    assert placed(rows) <= np.ceil(total / 4096) + 2


def test_odd_texts_and_equal_documents(spark, tmp_path):
    texts = ODD + ["same text"] * 700
    rows = QUERIES["op4_best_fit_packing"](
        spark, saved(spark, tmp_path, documents(texts), DOCUMENTS)
    ).collect()
    check_documents(rows, dict(enumerate(texts)))
    placed(rows)


def test_repeated_rows_clashing_columns_and_wrong_lengths(spark):
    schema = "doc_id long, length long, offset string, sequence_id string"
    df = spark.createDataFrame([(1, 5, "x", "y")] * 600 + [(2, 3, "x", "y")] * 600, schema)
    rows = packing.pack(df, 8, ["doc_id"]).collect()
    assert len(rows) == 1200 and placed(rows, 8) == 600
    assert packing.pack(df.limit(0), 8, ["doc_id"]).count() == 0
    for bad in (None, 0, 9):
        with pytest.raises(ValueError):
            packing.pack(spark.createDataFrame([(1, bad)], "doc_id long, length long"), 8, ["doc_id"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_segment_tree_equals_a_linear_search(lengths):
    want: list[list[int]] = []
    rooms: list[int] = []
    for at in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [r for r in rooms if r >= lengths[at]]
        if fits:
            k = rooms.index(min(fits))
        else:
            rooms.append(20)
            want.append([])
            k = len(rooms) - 1
        rooms[k] -= lengths[at]
        want[k].append(at)
    got = token_output.best_fit_decreasing(lengths, 20)
    sizes = [sorted(lengths[i] for i in s) for s in got]
    assert sorted(i for s in got for i in s) == list(range(len(lengths)))
    assert sorted(map(sum, sizes)) == sorted(sum(lengths[i] for i in s) for s in want)


def check_matrices(df, texts, capacity=4096):
    ranks = read_ranks(Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes())
    other = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    found = defaultdict(dict)
    for r in df.collect():
        ids = np.frombuffer(r.ids, "<u4")
        positions = np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(positions) == capacity and r.segment_ends[-1] == r.n_tokens
        assert (ids[r.n_tokens :] == 50256).all() and not positions[r.n_tokens :].any()
        spans = zip(r.segment_ends, r.segment_ends[1:])
        for doc, start, (a, b) in zip(r.segment_docs, r.segment_starts, spans, strict=True):
            found[doc][start] = ids[a:b].tolist()
            assert positions[a:b].tolist() == list(range(b - a))
    assert len(found) == len(texts)
    for doc, text in texts.items():
        joined = [i for start in sorted(found[doc]) for i in found[doc][start]]
        assert joined == [*other.encode_ordinary(text or ""), 50256]


def test_matrices_give_back_every_document(spark, sf_dir):
    df = QUERIES["op10_token_matrices"](spark, sf_dir)
    check_matrices(df, {r[0]: r[1] for r in table(sf_dir, "documents")})


def test_matrices_of_odd_texts(spark, tmp_path):
    texts = [*ODD, "word " * 20000]
    folder = saved(spark, tmp_path, documents(texts), DOCUMENTS)
    df = QUERIES["op10_token_matrices"](spark, folder)
    check_matrices(df, dict(enumerate(texts)))
    pieces = token_output.unpacked(df).collect()
    assert sum(len(p.ids) for p in pieces) == 4 * sum(r.n_tokens for r in df.collect())
    token_output.write_matrices(df, f"{folder}/out")
    assert spark.read.parquet(f"{folder}/out").count() == df.count()


def test_matrices_of_long_white_space_and_null_keys(spark, tmp_path):
    texts = ["a" + " " * 300_000 + "b", "\n" * 2000 + "x", " \n\t" * 700, "é" * 50_000, "no" + " " * 999 + "so"]
    folder = saved(spark, tmp_path, documents(texts), DOCUMENTS)
    ranks = Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes()
    df = QUERIES["op10_token_matrices"](spark, folder)
    found = defaultdict(dict)
    for p in token_output.unpacked(df).collect():
        found[p.doc][p.start] = bytes(p.ids)
    pieces = read_ranks(ranks)
    words = {rank: piece for piece, rank in pieces.items()}
    for doc, text in enumerate(texts):
        ids = np.frombuffer(b"".join(found[doc][at] for at in sorted(found[doc])), "<u4")
        assert b"".join(words[i] for i in ids[:-1].tolist()) == text.encode() and ids[-1] == 50256
    rows = spark.createDataFrame([(None, "one two"), (None, None), (1, "one two")], "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = token_output.packed_matrices(rows, path, public_tokenizers.PATTERN, 50256, 64, 50256)
    assert sorted((str(p.doc), len(p.ids)) for p in token_output.unpacked(out).collect()) == [
        ("1", 12), ("None", 4), ("None", 12),
    ]


def test_matrices_of_an_empty_table(spark, tmp_path):
    df = QUERIES["op10_token_matrices"](spark, saved(spark, tmp_path, [], DOCUMENTS))
    assert df.count() == 0


def test_small_partitions_do_not_add_padded_rows(spark):
    rows = [(i, f"text number {i} " * 20) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(50)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = token_output.packed_matrices(df, ranks, public_tokenizers.PATTERN, 50256, 4096, 50256)
    sizes = [r.n_tokens for r in out.select("n_tokens").collect()]
    assert len(sizes) <= -(-sum(sizes) // 4096) + 1
