"""Operator 2: quality rules by distribution divergence (native column expressions only).

A text's character classes (digits count with the letters) and its language's common words make
two histograms.  The corpus gives the references: per declared language, mean histograms of
the documents that pass the base rules.  A document is rejected if the Jensen-Shannon distance (base 2, so 0 to
1) of either histogram from its reference is above a limit; a histogram is judged only if the
text is long enough for its sampling noise to stay well below that limit.

Cases: null text has no words and fails the base rules; a null or unlisted language is held
against the mean over all documents, by character classes only; an empty table has no
references and no rows; repeated rows are judged alike; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markbook.llm.common import WORD_SPLIT, row_key, stored

# Frequent function words of each language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to in a is that it for on was as be with by this are at from".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas au il".split(),
}
BINS = 20
CLASSES = ("upper", "punct", "symbol", "space", "rest")

#: Limits on the distance, and the least size of a text for each histogram to be judged.
MAX_CHARS_JS, MIN_CHARS = 0.13, 200
MAX_WORDS_JS, MIN_WORDS = 0.32, 150
MIN_BASE_WORDS = 50


def repeat_words(words: str) -> Column:
    """Words covered by 3-word windows that are found twice or more.

    Windows are hashed with their positions and sorted, so that equal windows are neighbours:
    n log n for any text.  Texts without a repeated window stop after the distinct count."""
    w = F.col(words)
    tri = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                      lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def covered(t: Column) -> Column:
        order = F.sort_array(F.transform(t, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        found = F.transform(F.array(order), lambda s: F.filter(s, lambda x, i: F.coalesce(
            x["h"] == F.get(s, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))))
        places = F.transform(found, lambda s: F.array_sort(F.transform(s, lambda x: x["i"])))
        steps = F.transform(places, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
            F.lit(0), lambda a, x: a + x))
        return F.get(steps, F.lit(0))

    once = F.transform(F.array(tri), lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), 0).otherwise(covered(t)))
    return F.get(once, F.lit(0)).cast("long")


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two distributions (arrays of one length), base 2."""
    def half(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: (half(x, y) + half(y, x)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def features(docs: DataFrame, id_col: str, text: str, lang: str) -> DataFrame:
    """One row per document: its id, key, language, base counts and histogram counts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text).alias("row_key"),
                       F.col(lang).cast("string").alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    rows = rows.withColumn("words", F.array_remove(F.split("t", WORD_SPLIT), ""))
    rows = rows.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    common = F.lit(None).cast("array<string>")
    for name, listed in COMMON_WORDS.items():
        common = F.when(F.col("lang") == name, F.array(*map(F.lit, listed))).otherwise(common)
    rows = rows.withColumn("common", common)
    left = lambda pattern: F.length(F.regexp_replace("t", pattern, "")).cast("long")
    n = F.length("t").cast("long")
    word_chars = F.length(F.array_join("words", "")).cast("long")
    rows = rows.select(
        "doc_id", "row_key", "lang", F.size("words").cast("long").alias("n_words"),
        word_chars.alias("word_chars"), (n - left(r"[#*$%&|<>]")).alias("symbol"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words("words").alias("n_repeat_words"), n.alias("n_chars"),
        left(r"[^\p{Lu}]+").alias("upper"),
        (n - left(r"""[.,;:!?'"()\[\]-]""")).alias("punct"),
        F.array(*[F.size("words") - F.size(F.array_remove("words", F.get("common", F.lit(k)))) for k in range(BINS)]).alias("counts"))
    rows = (rows.withColumn("space", F.col("n_chars") - F.col("word_chars"))
            .withColumn("rest", reduce(lambda a, c: a - F.col(c), CLASSES[:-1], F.col("n_chars")))
            .withColumn("base_failed", (F.col("n_words") < MIN_BASE_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))
    # the histograms, as shares; the words that are not common are the last bin
    chars = F.transform(F.array(*CLASSES), lambda x: x / F.greatest(F.col("n_chars"), F.lit(1)))
    counts = F.when(F.col("lang").isin(*COMMON_WORDS), F.col("counts"))
    rest = F.col("n_words") - F.aggregate(counts, F.lit(0), lambda a, x: a + x)
    words = F.transform(F.concat(counts.cast("array<bigint>"), F.array(rest)), lambda x: x / F.greatest(F.col("n_words"), F.lit(1)))
    return rows.withColumn("chars", chars).withColumn("bins", words).drop(*[c for c in CLASSES if c != "symbol"], "counts")


REF = ("ref_chars", "ref_bins")


def references(f: DataFrame) -> DataFrame:
    """Mean histograms (ref, ref_chars, ref_bins) per listed language, and of all rows under ""."""
    means = [F.array(*[F.avg(F.col("chars")[k]) for k in range(len(CLASSES))]).alias("ref_chars"),
             F.array(*[F.avg(F.get("bins", F.lit(k))) for k in range(BINS + 1)]).alias("ref_bins")]
    return f.where("ref <> ''").groupBy("ref").agg(*means).union(f.agg(*means).select(F.lit("").alias("ref"), "*"))


def held_against(f: DataFrame, refs: DataFrame) -> DataFrame:
    """Adds the distances from the references; these are five rows at most, so their broadcast
    has a fixed size."""
    j = f.join(F.broadcast(refs), "ref", "left")
    return j.withColumn("chars_js", divergence(F.col("chars"), F.col("ref_chars"))).withColumn(
        "words_js", F.when(F.col("ref") != "", divergence(F.col("bins"), F.col("ref_bins"))))


def judge(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, chars_js, words_js, row_key.

    One pass over the texts writes the small feature rows.  The references are means over all
    rows that pass the base rules, taken again over those no farther from the first means
    than the average row, so that odd texts hardly shape them."""
    f = stored(spark, features(docs, id_col, text, lang), "features")
    known = F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang")).otherwise(F.lit(""))
    f = f.withColumn("ref", known)
    good = f.where(~F.col("base_failed"))
    first = held_against(good, references(good))
    mean = first.groupBy("ref").agg(F.avg("chars_js").alias("mean_js"))  # a row per listed language
    near = first.join(F.broadcast(mean), "ref").where("chars_js <= mean_js").drop("mean_js", "chars_js", "words_js", *REF)
    refs = stored(spark, references(near), "references")
    j = held_against(f, refs)
    odd = ((F.col("n_chars") >= MIN_CHARS) & (F.col("chars_js") > MAX_CHARS_JS)) | (
        (F.col("n_words") >= MIN_WORDS) & (F.col("words_js") > MAX_WORDS_JS))
    j = j.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(odd, F.lit(False)))
    return j.select("doc_id", "n_words", "word_chars", F.col("symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "chars_js", "words_js", "row_key")
