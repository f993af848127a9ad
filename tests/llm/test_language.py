import sys
import zlib
from itertools import product
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import DOCUMENTS, documents, saved, table  # noqa: E402

from skylag.llm import language  # noqa: E402
from skylag.llm.queries import QUERIES  # noqa: E402


def by_force(scores, transitions):
    """Probabilities of all label sequences, one by one."""
    n, k = scores.shape
    share, moves, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for path in product(range(k), repeat=n):
        weight = np.exp(
            sum(scores[t, p] for t, p in enumerate(path))
            + sum(transitions[a, b] for a, b in zip(path, path[1:]))
        )
        total += weight
        for t, p in enumerate(path):
            share[t, p] += weight
        for a, b in zip(path, path[1:]):
            moves[a, b] += weight
    return share / total, moves / total, np.log(total)


def test_forward_backward_equals_brute_force(monkeypatch):
    rng = np.random.default_rng(1)
    lengths = np.asarray([1, 5, 3, 5])
    scores = rng.normal(size=(lengths.sum(), 3)) * 2
    transitions = rng.normal(size=(3, 3))
    share, moves, logs = language.forward_backward(scores, lengths, transitions, pairs=True)
    cuts = np.split(scores, np.cumsum(lengths)[:-1])
    want = [by_force(c, transitions) for c in cuts]
    assert np.allclose(share, np.concatenate([w[0] for w in want]))
    assert np.allclose(moves, sum(w[1] for w in want))
    assert logs == pytest.approx(sum(w[2] for w in want))
    for part in (1, 2, 3):
        monkeypatch.setattr(language, "PART", part)
        again = language.forward_backward(scores, lengths, transitions, pairs=True)
        assert np.allclose(again[0], share) and np.allclose(again[1], moves)
        assert again[2] == pytest.approx(logs)
    alone, _, _ = language.forward_backward(scores, lengths, transitions)
    assert np.allclose(alone, share)


def test_query_on_held_out_documents(spark, sf_dir):
    found = {r.doc_id: r for r in QUERIES["op2_language_id"](spark, sf_dir).collect()}
    rows = table(sf_dir, "documents")
    assert len(found) == len(rows)
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert {r[0] for r in out} == {d for d, f in found.items() if f.held_out}
    right = sum(found[r[0]].lang_pred == r[2] for r in out)
    assert right >= 0.97 * len(out)
    assert all(0 <= f.score <= 1 for f in found.values())


def test_held_out_labels_are_not_used(spark, sf_dir, tmp_path):
    rows = table(sf_dir, "documents")
    changed = [
        (r[0], r[1], "xx" if zlib.crc32(str(r[0]).encode()) % 3 == 1 else r[2], "other", 0) for r in rows
    ]
    folder = saved(spark, tmp_path, changed, DOCUMENTS)
    one = {r.doc_id: r.lang_pred for r in QUERIES["op2_language_id"](spark, sf_dir).collect()}
    other = {r.doc_id: r.lang_pred for r in QUERIES["op2_language_id"](spark, folder).collect()}
    assert one == other


@pytest.fixture(scope="module")
def chain(sf_dir):
    samples = {}
    for _, text, lang, *_ in table(sf_dir, "documents"):
        samples.setdefault(lang, []).append(language.words_of(text))
    return language.fit({k: v[:20] for k, v in samples.items()})


def test_code_switched_text_is_cut_into_runs(spark, sf_dir, chain):
    by = {}
    for _, text, lang, *_ in table(sf_dir, "documents"):
        by.setdefault(lang, []).append(" ".join(text.split()[:12]))
    text = " ".join([by["en"][25], by["de"][25], by["fr"][22]])
    df = spark.createDataFrame([(text,)], "text string")
    row = language.labelled(df, chain, with_runs=True).first()
    assert sum(r.words for r in row.runs) == len(text.split())
    right = 0
    want = [x for lang in ("en", "de", "fr") for x in [lang] * 12]
    got = [r.lang for r in row.runs for _ in range(r.words)]
    right = sum(a == b for a, b in zip(want, got, strict=False))
    assert right >= 0.85 * len(got)
    assert np.trace(chain.transitions) > chain.transitions.sum() - np.trace(chain.transitions)


def test_odd_texts_clashing_columns_and_empty_tables(spark, tmp_path, chain):
    texts = [None, "", "123 456 !!", "\n", "Der die und mit", "x" * 5000, "the and of " * 8000]
    df = spark.createDataFrame([(t, "a", 5) for t in texts] * 2, "text string, LANG_PRED string, score int")
    out = language.labelled(df, chain)
    assert out.columns == ["text", "lang_pred", "score"]
    rows = {r.text: r for r in out.collect()}
    assert out.count() == 2 * len(texts)
    for t in texts[:4]:
        assert (rows[t].lang_pred, rows[t].score) == ("und", 0.0)
    assert rows[texts[4]].lang_pred == "de" and rows[texts[6]].lang_pred == "en"
    assert rows[texts[5]].lang_pred in chain.labels
    assert language.labelled(df.limit(0), chain).count() == 0
    # Nothing is labelled: every text is undecided.
    folder = saved(spark, tmp_path, documents(["some text", None], lang=None), DOCUMENTS)
    assert {r.lang_pred for r in QUERIES["op2_language_id"](spark, folder).collect()} == {"und"}


def test_null_keys_are_not_held_out_and_not_learned_from(spark, tmp_path):
    rows = [(None, "der die das", "de", "s", 1), (1, "the and of", "en", "s", 1), (3, None, "fr", "s", 1)]
    folder = saved(spark, tmp_path, rows, DOCUMENTS)
    found = {r.doc_id: r for r in QUERIES["op2_language_id"](spark, folder).collect()}
    assert found[None].held_out is False and len(found) == 3
    assert found[3].lang_pred == "und"


def test_numbers_of_any_kind_are_no_letters(spark):
    import unicodedata

    numeric = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) in ("Nd", "Nl", "No")]
    learned = [(i, text, lang) for i in range(40) for text, lang in (("der und die das", "de"), ("the of and", "en"))]
    asked = [(100, " ".join(numeric), None), (101, "½ ² ③", None), (102, "Ⅷ", None), (103, "½ der ②", None)]
    df = spark.createDataFrame(learned + asked, "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predicted(df).collect()}
    assert [found[k] for k in (100, 101, 102)] == [("und", 0.0)] * 3
    assert found[103][0] == "de"
