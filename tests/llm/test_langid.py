from conftest import SF001
from helpers import frame
from markbook.llm import langid


def test_held_out_accuracy_and_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    # half of the declarations are taken away from what is judged, none from the fit
    found = langid.identify(spark, docs, "doc_id", langid.F.col("text"), langid.F.when(langid.F.col("doc_id") % 2 == 0, langid.F.col("lang")),
                            langid.F.col("source"), label=langid.F.when(langid.F.col("doc_id") % 2 == 0, langid.F.col("lang")))
    rows = found.join(docs.select(langid.F.col("doc_id").alias("id"), langid.F.col("lang").alias("true")), "id").where("id % 2 = 1").collect()
    told = [r for r in rows if r["kept"]]
    assert len(told) > 0.99 * len(rows)
    assert sum(r["lang"] == r["true"] for r in told) > 0.98 * len(told)


def test_pages(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    rows = langid.identify_pages(spark, pages).collect()
    assert len(rows) == pages.count() and all(0 <= r["posterior"] <= 1 for r in rows)
    assert sum(r["lang"] == r["declared"] for r in rows) > 0.9 * len(rows)


def test_evidence_moves_an_unclear_text(spark):
    clear = [("en", "the house and the garden of the people with that thing " * 3, "https://x.co/a")] * 30
    clear += [("fr", "la maison et le jardin des gens que nous avons dans la ville " * 3, "https://y.fr/b")] * 30
    unclear = [(None, "zq zq zqzq zq", "https://y.fr/c"), (None, "zq zq zqzq zq", "https://x.co/c")]
    rows = [(i, u, None if t is None else f"<html{'' if lang is None else f' lang={lang!r}'}><p>{t}</p></html>", "clash")
            for i, (lang, t, u) in enumerate(clear + unclear)]
    rows += [(900, None, None, "x"), (901, "no address", "", "x"), (902, "https://x.co", "<p>12 34</p>", "x"), (903, "https://x.co", "é" * 20, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, declared string")
    got = {r["page_id"]: r for r in langid.identify_pages(spark, pages).collect()}
    assert (got[60]["lang"], got[61]["lang"]) == ("fr", "en")
    assert not got[900]["kept"] and not got[901]["kept"] and not got[902]["kept"]
    assert langid.identify_pages(spark, pages.limit(0)).collect() == []


def test_unlabelled_rows_only(spark):
    rows = langid.identify_documents(spark, frame(spark, ["some words of text here", None, ""], [None, None, None])).collect()
    assert [r["kept"] for r in rows] == [False] * 3 and len(rows) == 3


def fitted(spark, rows):
    return langid.fit_text_model(spark, spark.createDataFrame(rows, "t string, l string"), langid.F.col("t"), langid.F.col("l"))


def test_copies_do_not_fill_the_sample(spark):
    rows = [(f"{word} number {k}", lang) for lang, word in (("de", "haus"), ("en", "house"), ("es", "casa"), ("fr", "maison")) for k in range(60)]
    first = spark.createDataFrame(rows, "t string, l string").orderBy(langid.F.xxhash64("t")).first()
    one = fitted(spark, rows)
    assert (fitted(spark, rows + [tuple(first)] * 5000) == one).all()
    assert (one.max(0) > one.min(0)).all()


def test_rare_language_and_ends_of_long_texts_are_learnt(spark):
    rows = [(f"the house of number {k}", "en") for k in range(2500)] + [("la casa " * 3, "es"), ("1 " * 3000 + "schluss", "de")]
    table = fitted(spark, rows)
    assert (table.max(0) > table.min(0))[[0, 1, 2]].all()
    seen = langid.trigrams("schluss")[2]
    assert table[seen, 0] > table[:, 0].min()
