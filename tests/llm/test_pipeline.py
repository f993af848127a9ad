import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import DOCUMENTS, saved, table  # noqa: E402
from test_line_dedup import by_force as passages_by_force  # noqa: E402
from test_minhash import by_force as groups_by_force  # noqa: E402
from test_packing import WORDS, placed  # noqa: E402

import corpus_pipeline  # noqa: E402


def through(spark, folder):
    """Rows after each stage, each written and read again."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage{number}-{len(list(Path(folder).iterdir()))}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def check(spark, folder, rows):
    first, second, third, last = through(spark, folder)
    kept = [tuple(r) for r in first.collect()]
    letters = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert sorted(kept, key=str) == sorted(letters, key=str)
    want = [
        (d, text) for d, text, n in passages_by_force(kept, 50) if not n or text.strip()
    ]
    got = [(r.doc_id, r.text) for r in second.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text) for r in second.collect())
    groups = groups_by_force([tuple(r) for r in second.collect()], words=5)
    stays = {doc for doc, _, component in groups if doc == component}
    assert {r.doc_id for r in third.collect()} == stays
    pieces = last.collect()
    total = sum(len(WORDS.encode(r.text, add_special_tokens=False).ids) + 1 for r in third.collect())
    assert sum(p.length for p in pieces) == total
    assert placed(pieces) <= np.ceil(total / 4096) + 2
    for stage in (first, second, third):
        assert stage.columns == list(corpus_pipeline.COLUMNS)
    return first, second, third


def test_stages_equal_brute_force(spark, sf_dir, tmp_path):
    rows = table(sf_dir, "documents")
    folder = saved(spark, tmp_path, rows, DOCUMENTS)
    _, second, third = check(spark, folder, rows)
    assert third.count() <= second.count() < len(rows)
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_odd_documents(spark, tmp_path):
    long = " ".join(f"wort{i}" for i in range(60))
    texts = [None, "", "123 ...", "the and of", "the and of", long, "own line\n" + long, "é " * 9000]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    check(spark, saved(spark, tmp_path, rows, DOCUMENTS), rows)


def test_empty_table_and_extra_columns(spark, tmp_path):
    folder = saved(spark, tmp_path, [], DOCUMENTS)
    assert all(df.count() == 0 for df in through(spark, folder))
    schema = DOCUMENTS + ", n_removed int, lang_pred string, component_id long, piece int, length int"
    other = tmp_path / "other"
    rows = [(i, f"word{i} and more", "en", "s", 16, 1, "x", 2, 3, 4) for i in range(5)]
    folder = saved(spark, other, rows, schema)
    assert [df.count() for df in through(spark, folder)] == [5, 5, 5, 5]


def test_documents_stay_where_no_language_can_be_learned(spark):
    rows = [(0, "the and of", None, "s", 10), (1, "é", None, "s", 1), (2, "12 ...", None, "s", 6)]
    rows += [(3, None, None, "s", None)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1]


def test_near_duplicates_leave_by_row_where_keys_repeat(spark):
    near = " ".join(f"w{i}" for i in range(80))
    texts = [(0, near), (1, near + " x"), (1, "a clean text of its own"), (2, "twice the same row")]
    rows = [(d, t, "en", "s", len(t)) for d, t in [*texts, texts[3], (None, near), (3, "")]]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    kept = corpus_pipeline.without_near_duplicates(spark, docs, "").collect()
    want = [texts[0], *texts[2:], (None, near), (3, "")]
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(want, key=str)
