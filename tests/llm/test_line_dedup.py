import itertools
import random
import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import DOCUMENTS, documents, saved, table  # noqa: E402

from skylag.llm import line_dedup  # noqa: E402
from skylag.llm.queries import ORACLE, QUERIES  # noqa: E402

WHITE = " \t\n\r\f\v"


def by_force(rows, least):
    """Each row's text without words of runs that stand earlier, and how many words go."""
    order = sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r))
    seen, rest = {}, {}
    for number, row in enumerate(order):
        ahead, *pieces = re.split(f"(?<![^{WHITE}])(?=[^{WHITE}])", " " + row[1])
        words, cut = [p.rstrip(WHITE) for p in pieces], set()
        for i in range(len(words) - least + 1):
            run = tuple(words[i : i + least])
            place, at = seen.setdefault(run, (number, i))
            if place < number or at + least <= i:
                cut.update(range(i, i + least))
        out, gone = ahead[1:], ""
        for i, piece in enumerate(pieces):
            if i in cut:
                gone += piece
            if gone and (i not in cut or i == len(pieces) - 1):
                out += "\n" if "\n" in gone and out and not out.endswith("\n") else ""
                gone = ""
            if i not in cut:
                out += piece
        rest[row] = (out, len(cut))
    return sorted(((r[0], *rest.get((r[0], r[1]), (None, 0))) for r in rows), key=str)


def found(df):
    return sorted(((r.doc_id, r.text, r.n_removed) for r in df.collect()), key=str)


def test_query_equals_sql(spark, sf_dir):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = duckdb.sql(ORACLE["op9_line_dedup"]).fetchall()
    got = found(QUERIES["op9_line_dedup"](spark, sf_dir))
    assert got == sorted(want, key=str)
    assert sum(r[2] for r in got) > 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = [r[:2] for r in table(sf_dir, "documents")]
    assert found(QUERIES["op9_line_dedup"](spark, sf_dir)) == by_force(rows, 50)


@pytest.mark.parametrize("seed", range(3))
def test_random_words_equal_brute_force(spark, seed):
    draw = random.Random(seed)
    bits = ["a", "b, c", "a b\nc d.", "\n", " e f g h ", "a b c d e f g h i j", "k\tl", "\x0bm", ". ", "e; f? g h"]
    texts = [draw.choice(" \n").join(draw.choice(bits) for _ in range(draw.randint(0, 14))) for _ in range(30)]
    rows = documents([None, "", *texts, texts[0]])
    df = spark.createDataFrame(rows, DOCUMENTS)
    for least in (3, 6, 12):
        assert found(line_dedup.without_repeats(df, min_words=least)) == by_force(rows, least)


def test_planted_runs_of_any_shape_go(spark):
    """Runs of exactly 50 words, wherever their marks are, between words that differ; 49 stay."""
    lined = lambda w, n: "\n".join(" ".join(w[i : i + n]) for i in range(0, len(w), n))
    texts = []
    for mark, every in itertools.product(["", ".", ",", "!?"], [1, 3, 24, 25, 26, 49]):
        name = len(texts)
        passage = [f"{name}w{i}{mark if i % every == every - 1 else ''}" for i in range(50)]
        for i in range(12):
            before = [f"{name}x{i}y{k}" for k in range(3 * i)]
            before[-1:] = [before[-1] + mark] if before and i % 2 else before[-1:]
            texts.append(lined([*before, *passage, f"{name}z{i}", "end."], 4 + i))
        texts.append("near " + " ".join(passage[1:]) + f" miss{name}")
    rows = documents(texts)
    got = found(line_dedup.without_repeats(spark.createDataFrame(rows, DOCUMENTS)))
    assert got == by_force(rows, 50)
    assert sorted(r[2] for r in got) == [0] * 48 + [50] * 264


def test_a_passage_inside_lines_goes(spark):
    passage = [f"w{i}" for i in range(55)]
    lined = lambda w, n: "\n".join(" ".join(w[i : i + n]) for i in range(0, len(w), n))
    texts = [
        "top line\nbefore " + lined(passage, 9) + " after\nend",
        "other " + lined(passage, 20) + " behind\nlast",
        "short " + " ".join(passage[:49]) + " x",
    ]
    got = found(line_dedup.without_repeats(spark.createDataFrame(documents(texts), DOCUMENTS)))
    assert got == [(0, texts[0], 0), (1, "other \nbehind\nlast", 55), (2, texts[2], 0)]


def test_odd_texts(spark, tmp_path):
    passage = " ".join(f"w{i}" for i in range(51))
    texts = [
        None, "", "\n\n", passage, f"own\n{passage}\nother", passage + "\n" + passage, "own\nshort",
        "own\nshort", "\n".join(["word"] * 3000), "x " * 30000, "x " * 30000 + "\nmore",
    ]
    rows = documents(texts)
    got = found(QUERIES["op9_line_dedup"](spark, saved(spark, tmp_path, rows, DOCUMENTS)))
    assert got == by_force(rows, 50)
    of = {r[0]: r for r in got}
    assert of[4][1:] == ("own\nother", 51)
    assert of[5][1:] == ("", 102)
    assert of[8][2] == 2950
    assert of[10][1] == "more"


def test_repeated_rows_null_keys_clashing_columns_and_an_empty_table(spark):
    schema = "doc_id long, text string, n_removed string, one int, runs int, owner int, begin int"
    rows = [(None, "a b c\nd", "x", 1, 1, 1, 1)] * 2 + [(1, "a b c\ne", "x", 1, 1, 1, 1)] * 2
    df = spark.createDataFrame(rows, schema)
    out = line_dedup.without_repeats(df, min_words=3)
    assert out.columns == ["doc_id", "text", "one", "runs", "owner", "begin", "n_removed"]
    assert found(out) == [(1, "e", 3), (1, "e", 3), (None, "a b c\nd", 0), (None, "a b c\nd", 0)]
    assert line_dedup.without_repeats(df.limit(0)).count() == 0


def test_only_the_runs_stay_on_disk(spark):
    """No cut holds the texts once the runs are known, and the session's settings are as before."""
    draw = random.Random(5)
    texts = [" ".join(f"{draw.getrandbits(48):x}" for _ in range(400)) for _ in range(300)]
    df = spark.createDataFrame(documents([*texts, *texts[:3]]), DOCUMENTS)
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    size = lambda: sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = size(), spark.conf.get(setting)
    runs = line_dedup.repeated_runs(df)
    assert size() - before < sum(map(len, texts)) / 10
    assert spark.conf.get(setting) == was
    assert sorted((r.doc, *r.runs[0]) for r in runs.collect()) == [(i, 0, 399) for i in range(300, 303)]


def test_few_different_words_equal_brute_force(spark):
    """Where grams come again within a run, or none of them is drawn."""
    draw = random.Random(9)
    texts = [" ".join(draw.choice("ab") * draw.randint(1, 40) for _ in range(9)) for _ in range(6)]
    texts += [" ".join(draw.choice(["a", "a b", "a a a a a a a a"]) for _ in range(60)) for _ in range(6)]
    texts += ["a b c " * 70, "b c a " * 60, "a " * 49 + "b", "a " * 130]
    rows = documents([*texts, texts[7][20:] + " c"])
    got = found(line_dedup.without_repeats(spark.createDataFrame(rows, DOCUMENTS)))
    assert got == by_force(rows, 50)
    assert sum(r[2] > 0 for r in got) > 3


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op9_line_dedup"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_stretches_hold_each_run_once_and_are_hashed_in_compiled_code(spark):
    draw = random.Random(4)
    texts = [" ".join(draw.choice(["a", "b", f"w{i}"]) for i in range(n)) for n in (49, 50, 51, 300, 700)]
    texts += ["a " * 200, "a b c " * 90, "\t\x0ba\r\n  b\f c " * 40]
    schema = "one long, two long, text string"
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate([*texts, texts[3]])], schema)
    df = df.withColumn("one", line_dedup.F.xxhash64("text"))
    for least in (3, 12, 50):
        out = line_dedup._stretches(df, least)
        runs = {}
        for r in out.collect():
            runs.setdefault(r.one, []).extend(range(r["from"], r["from"] + r.n))
        want = [n - least + 1 for n in (len(t.split()) for t in texts) if n >= least]
        assert sorted(map(len, runs.values())) == sorted(want)
        assert all(sorted(got) == list(range(len(got))) for got in runs.values())
    # Words of a stretch are sliced and hashed beside the rows, not while arrays are walked.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" in plan
    assert not any("slice(" in line for line in plan.splitlines() if "lambda" in line)


def test_short_phrases_in_many_texts_are_not_compared_run_by_run(spark, monkeypatch):
    """Only runs with the same words on one side of their gram are; whole copies stay apart."""
    draw = random.Random(11)
    word = lambda: f"{draw.getrandbits(48):x}"
    between = lambda: " ".join(word() for _ in range(60))
    phrases = [" ".join(word() for _ in range(25)) for _ in range(8)]
    texts = [" ".join(f"{between()} {p}" for p in draw.sample(phrases, 8)) for _ in range(30)]
    texts += [texts[3], " \t" + texts[4], texts[5] + "\x0b"]
    compared, runs = [], line_dedup._runs

    def counted(rows, min_words):
        compared.append(runs(rows, min_words).count())
        return runs(rows, min_words)

    monkeypatch.setattr(line_dedup, "_runs", counted)
    rows = documents(texts)
    assert found(line_dedup.without_repeats(spark.createDataFrame(rows, DOCUMENTS))) == by_force(rows, 50)
    assert compared[0] < 300


def test_stretches_of_all_rows_take_no_shuffle(spark):
    rows = [(i // 2, 0, " ".join(f"{i // 2}w{k}" for k in range(200))) for i in range(6)]
    df = spark.createDataFrame(rows, "one long, two long, text string")
    out = line_dedup._stretches(df, 50, once=False)
    assert "Exchange" not in out._jdf.queryExecution().toString()
    assert sorted(out.distinct().collect()) == sorted(line_dedup._stretches(df, 50).select(out.columns).collect())
    assert out.count() == 2 * out.distinct().count()


def test_words_part_at_every_kind_of_white_space(spark):
    texts = ["a b", "a\nb  c", "\ta\r\nb\fc\x0bd ", "a\x0bb", "a\rb\n", " ", "", "a b c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(line_dedup._words(line_dedup.F.col("text"))).collect()]
    assert got == [re.findall(f"[^{WHITE}]+", t) for t in texts]
