import random

import corpus_pipeline
from helpers import frame, mixed_texts
from markbook.llm import langid, quality
from test_jaccard import brute as jaccard_brute
from test_quality import brute as base_counts
from test_substrings import brute as substring_brute

DIR = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "quality rules", "n-gram Jaccard join", "suffix-array dedup", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DIR)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        if name == "language ID":
            kept = {r["id"] for r in langid.identify_documents(spark, before).where("kept").collect()}
            assert {r["doc_id"] for r in docs.collect()} == kept
        elif name == "quality rules":
            rows = before.collect()
            judged = {r["doc_id"]: r for r in quality.judge(spark, before).collect()}
            assert all(judged[r["doc_id"]]["base_failed"] == base_counts(r["text"])[5] for r in rows)
            assert {r["doc_id"] for r in docs.collect()} == {d for d, r in judged.items() if r["kept"]}
        elif name == "n-gram Jaccard join":
            rows = before.orderBy("doc_id").collect()
            want = {c for d, n, c in jaccard_brute([(r["doc_id"], r["text"]) for r in rows])}
            assert {r["doc_id"] for r in docs.collect()} == want
        elif name == "suffix-array dedup":
            rows = before.orderBy("doc_id").collect()
            want = substring_brute([(r["doc_id"], r["text"]) for r in rows], corpus_pipeline.PASSAGE)[1]
            got = docs.orderBy("doc_id").collect()
            assert [r["text"] for r in got] == want
            assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before.collect()}
    assert docs.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 2048


def test_odd_documents_do_not_break_a_stage(spark):
    docs = frame(spark, mixed_texts(), ["en"] * 20 + [None] * 3 + ["xx"] * (len(mixed_texts()) - 23))
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, DIR)
        assert out.columns == docs.columns
        out.collect()


def test_a_passage_of_fifty_words_goes_and_clean_texts_stay(spark):
    """Below op5's 400 bytes, above the stage's window; what surrounds it stays."""
    g = random.Random(4)
    word = lambda: "".join(g.choices("abcdefghijklmnoprstu", k=g.randint(3, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(52)
    assert corpus_pipeline.PASSAGE < len(passage) < 400
    rows = [(i, f"{text(60)} {passage} {text(60)}" if i < 3 else text(150)) for i in range(12)]
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.substring_dedup(spark, frame(spark, rows), DIR).collect()}
    for i, t in rows:
        assert out[i] == (t if i >= 3 else t.replace(f" {passage} ", "")), i


def test_run(spark):
    rows = corpus_pipeline.run(spark, DIR).collect()
    assert rows and set(rows[0].asDict()) >= {"doc_id", "start", "length", "sequence_id", "offset"}
