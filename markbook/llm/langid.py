"""Operator 6: language identification by Bayesian fusion of evidence.

log P(language | everything) is the sum of
* the text's likelihood under byte-trigram models (one per language, fitted on a bounded sample
  of its distinct labelled texts), tempered because neighbouring trigrams are not independent;
* the likelihood of the declared markup language given the true one;
* the likelihood of the address suffix given the true language;
* the log prior of the host, smoothed towards its domain, which is smoothed towards the whole
  corpus (``SMOOTH`` virtual rows at each level).
The last three come from grouped aggregation over all rows, with the language that the
text alone points to as the truth; a row's own count is taken out of its host's and domain's.

A row is rejected if its text has too few letters to tell (``MIN_LETTERS``), or if no language
reaches ``MIN_POSTERIOR``.

Cases: a null text has no letters and is rejected; missing declarations, suffixes and hosts
add no evidence; equal posteriors go to the language that comes first by name; without any
labelled row all languages are equally likely; an empty table gives no rows; repeated rows are
judged alike; other columns are not read, or returned in ``row`` as they are with ``carry``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from markbook.llm.common import row_key, stored

LANGUAGES = ("de", "en", "es", "fr")
TABLE_BITS = 16
SAMPLE_ROWS = 2_000  # bound of the labelled sample of a language, distinct texts
FULL_TRIGRAMS = 60.0  # a text's likelihood counts as at most so many independent trigrams
SMOOTH = 4.0
MIN_LETTERS = 8
MIN_POSTERIOR = 0.6
_MULTIPLY, _SHIFT = np.uint32(2654435761), np.uint32(32 - TABLE_BITS)


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased text."""
    x = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8).astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.uint32)
    return ((x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]) * _MULTIPLY) >> _SHIFT


def fit_text_model(spark: SparkSession, docs: DataFrame, text: Column, label: Column) -> np.ndarray:
    """log P(trigram | language), shape (2 ** TABLE_BITS, languages), from the whole texts of at most
    ``SAMPLE_ROWS`` distinct labelled texts of every language, in the order of a hash."""
    rows = docs.select(text.cast("string").alias("t"), label.alias("l")).where(F.col("l").isin(*LANGUAGES) & F.col("t").isNotNull())
    # the hash decides which texts are taken, so only hashes are shuffled; copies share theirs
    keys = stored(spark, rows.select("l", F.xxhash64("t").alias("h")).distinct(), "labelled")
    bound = [keys.where(F.col("l") == name).orderBy("h").limit(SAMPLE_ROWS).select("l", "h") for name in LANGUAGES]
    taken: dict[str, set[int]] = {name: set() for name in LANGUAGES}
    for r in reduce(DataFrame.union, bound).toLocalIterator():
        taken[r["l"]].add(r["h"])
    shared = spark.sparkContext.broadcast(taken)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = {name: set(hashes) for name, hashes in shared.value.items()}  # a task sends a text once
        for b in batches:
            hit = []
            for name, h in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                hit.append(h in left[name])
                left[name].discard(h)
            some = b.filter(pa.array(hit, pa.bool_()))
            for t, name, h in zip(*(some.column(k) for k in range(3)), strict=True):
                g, n = np.unique(trigrams(t.as_py()), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()]), pa.array([h.as_py()]), pa.array([g.astype(np.int32)], pa.list_(pa.int32())),
                                                  pa.array([n.astype(np.int64)], pa.list_(pa.int64()))], names=["l", "h", "g", "n"])

    found = rows.select("t", "l", F.xxhash64("t").alias("h")).mapInArrow(run, "l string, h long, g array<int>, n array<long>")
    pairs = found.dropDuplicates(["l", "h"]).select("l", F.explode(F.arrays_zip("g", "n")).alias("x"))
    count = np.full((1 << TABLE_BITS, len(LANGUAGES)), 0.1)
    for r in pairs.groupBy("l", "x.g").agg(F.sum("x.n").alias("n")).toLocalIterator():
        count[r["g"], LANGUAGES.index(r["l"])] += r["n"]
    return np.log(count / count.sum(0)).astype(np.float32)


def page_text(html: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags go."""
    plain = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    return F.regexp_replace(F.regexp_replace(plain, r"<[^>]*>", " "), r"&[#\w]+;", " ")


def declared_language(html: Column) -> Column:
    return F.lower(F.regexp_extract(html, r"(?is)<html[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2})", 1))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def blank_null(c: Column) -> Column:
    return F.when(c != "", c)


def text_scores(spark: SparkSession, rows: DataFrame, model: np.ndarray) -> DataFrame:
    """Adds the number of letters (counted up to ``MIN_LETTERS``) and the tempered log likelihoods, and drops the text."""
    shared = spark.sparkContext.broadcast(model)
    kept = ["id", "row_key", "declared", "suffix", "host", "domain"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            letters, scores = [], []
            for t in b.column("text"):
                t = t.as_py() or ""
                g = trigrams(t)
                s = np.zeros(len(LANGUAGES))
                for at in range(0, len(g), 1 << 16):
                    s += table[g[at:at + (1 << 16)]].sum(0, dtype=np.float64)
                s *= min(1.0, FULL_TRIGRAMS / max(len(g), 1))
                letters.append(sum(1 for _ in islice(filter(str.isalpha, t), MIN_LETTERS)))
                scores.append((s - s.max()).tolist())
            cols = [b.column(c) for c in kept] + [pa.array(letters, pa.int64()), pa.array(scores, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, names=[*kept, "letters", "ll"])

    schema = rows.select(*kept).schema.add("letters", T.LongType()).add("ll", T.ArrayType(T.DoubleType()))
    return rows.select(*kept, "text").mapInArrow(run, schema)


def identify(spark: SparkSession, docs: DataFrame, id_col: str, text: Column, declared: Column | None = None,
             host: Column | None = None, use_suffix: bool = False, label: Column | None = None, key: Column | None = None) -> DataFrame:
    """Per row: id, row_key (``key``, null by default), lang, posterior, text_lang, declared, kept.

    ``label`` names the training label of the text models, the declaration by default."""
    declared = F.lit(None).cast("string") if declared is None else declared
    host = F.lit(None).cast("string") if host is None else blank_null(host)
    model = fit_text_model(spark, docs, text, declared if label is None else label)
    parts = F.split(host, r"\.")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), (F.lit(None).cast("long") if key is None else key).alias("row_key"), text.cast("string").alias("text"),
        F.when(declared.isin(*LANGUAGES), declared).alias("declared"), host.alias("host"),
        (F.element_at(parts, -1) if use_suffix else F.lit(None).cast("string")).alias("suffix"),
        F.array_join(F.slice(parts, F.greatest(F.size(parts) - 2, F.lit(1)), 3), ".").alias("domain"))
    scored = stored(spark, text_scores(spark, rows, model), "scored")
    n = len(LANGUAGES)
    best = F.array_position(F.col("ll"), F.array_max("ll")).cast("int") - 1
    known = scored.withColumn("truth", F.when(F.col("letters") >= MIN_LETTERS, best))
    good = known.where("truth is not null")

    def table(key: str) -> DataFrame:
        return good.where(F.col(key).isNotNull()).groupBy(key).agg(
            F.array(*[F.sum((F.col("truth") == k).cast("long")) for k in range(n)]).alias(f"{key}_n"))

    whole = good.agg(*[F.sum((F.col("truth") == k).cast("long")).alias(f"w{k}") for k in range(n)])
    total = [(x or 0) for x in whole.first()]
    prior = [(x + 1.0) / (sum(total) + n) for x in total]
    out = known
    for key in ("host", "domain", "suffix", "declared"):
        out = out.join(table(key), key, "left")
    own = [(F.coalesce(F.col("truth"), F.lit(-1)) == k).cast("long") for k in range(n)]

    def less(key: str, k: int) -> Column:
        """Rows of this key in language k, the row itself left out."""
        return F.coalesce(F.col(f"{key}_n")[k] - own[k], F.lit(0))

    def smoothed(key: str, k: int, below: Column) -> Column:
        size = sum((less(key, j) for j in range(n)), F.lit(0))
        return (less(key, k) + SMOOTH * below) / (size + SMOOTH)

    logs = []
    for k in range(n):
        log = F.col("ll")[k] + F.log(smoothed("host", k, smoothed("domain", k, F.lit(prior[k]))))
        for key in ("suffix", "declared"):  # P(value | language), one virtual row spread over the values
            log += F.when(F.col(key).isNotNull(), F.log((less(key, k) + 1.0) / (total[k] + 10.0))).otherwise(F.lit(0.0))
        logs.append(log)
    out = out.withColumn("log", F.array(*logs)).withColumn("top", F.array_max("log"))
    out = out.withColumn("posterior", 1 / F.aggregate("log", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    names = F.array(*map(F.lit, LANGUAGES))
    kept = (F.col("letters") >= MIN_LETTERS) & (F.col("posterior") >= MIN_POSTERIOR)
    return out.select("id", "row_key", F.when(kept, F.get(names, F.array_position("log", F.col("top")).cast("int") - 1)).alias("lang"),
                      "posterior", F.get(names, F.col("truth")).alias("text_lang"), "declared", kept.alias("kept"))


def identify_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Language of web pages: (page_id, lang, posterior, text_lang, declared, kept)."""
    html, url = F.col("html").cast("string"), F.col("url").cast("string")
    found = identify(spark, pages, "page_id", page_text(html), blank_null(declared_language(html)), host_of(url), use_suffix=True)
    return found.drop("row_key").withColumnRenamed("id", "page_id")


def identify_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Language of ``documents`` rows: the column ``lang`` is the declaration, ``source`` the host;
    (id, row_key, lang, posterior, text_lang, declared, kept)."""
    return identify(spark, docs, "doc_id", F.col("text").cast("string"), F.col("lang").cast("string"),
                    F.col("source").cast("string"), key=row_key("doc_id", "text"))
