import re
from collections import Counter

from compare import compare, duck
from conftest import SF0001
from helpers import frame, mixed_texts
from markbook.llm import quality, queries


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_base_counts_equal_brute_force(spark):
    texts = mixed_texts() + ["a b c a b c a b", "x x x x", "the the\n the the\nthe the", "l1\nl1\n\n\nl2 \nl2", "é ü\x0bö\x0cß|<>#", "\xa0 \x85 \x1c"]
    rows = quality.judge(spark, frame(spark, texts)).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                   r["base_failed"]) for r in rows), key=str)
    want = sorted(((t[0] if isinstance(t, tuple) else i, *brute(t[1] if isinstance(t, tuple) else t))
                   for i, t in enumerate(texts)), key=str)
    assert got == want
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_only_native_expressions(spark):
    plan = quality.judge(spark, frame(spark, mixed_texts()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_odd_distributions_go_and_clean_ones_stay(spark):
    rows = {r["doc_id"]: r["kept"] for r in quality.judge(spark, spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where(
        "not base_failed").select("doc_id", "kept").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    good = [rows[r["doc_id"]] for r in labels if r["quality"] == 1 and r["doc_id"] in rows]
    bad = [rows[r["doc_id"]] for r in labels if r["quality"] == 0 and r["doc_id"] in rows]
    assert sum(good) / len(good) > 0.995
    assert sum(bad) / len(bad) < 0.2


def test_sql_twin(spark):
    ok, message = compare(queries.op2_quality_rules(spark, SF0001), duck(SF0001), queries.oracle_sql()["op2_quality_rules"])
    assert ok, message


def test_missing_languages_and_empty_table(spark):
    rows = quality.judge(spark, frame(spark, ["word " * 3 + "other", None], [None, "xx"])).collect()
    assert [r["kept"] for r in rows] == [False, False]
    assert quality.judge(spark, frame(spark, [])).collect() == []
