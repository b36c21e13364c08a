"""Registered queries of the training-data operators, and their DuckDB twins where SQL can
say them.  Each query applies its operator to the whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from markbook.llm import (bpe_lexicon, collocations, gru_lm, jaccard, langid, licenses, packing, paragraphs, quality,
                          ranked_search, secret_scan, substrings, vptree)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(spark, table(spark, sf_dir, "documents")).drop("chars_js", "words_js", "row_key")


def op3_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.paragraph_removals(spark, table(spark, sf_dir, "documents"), least=1)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(spark, table(spark, sf_dir, "documents")).drop("row_key", "component")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(spark, table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_pages(spark, table(spark, sf_dir, "pages"))


def op7_vantage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(spark, table(spark, sf_dir, "embeddings"))


def op8_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.lm_scores(spark, table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_lexicon.encode_documents(spark, table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op11_term_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(spark, table(spark, sf_dir, "documents")).drop("found")


def queries() -> dict[str, Query]:
    listed = (op1_packing, op2_quality_rules, op3_paragraph_dedup, op4_jaccard_join, op5_suffix_dedup, op6_language_id,
              op7_vantage_search, op8_gru_scores, op9_license_scan, op10_bpe, op11_term_pipeline,
              op12_collocations, op13_secret_scan)
    return {f.__name__: f for f in listed}


def quality_sql() -> str:
    """Operator 2 in DuckDB SQL: windows are counted by grouping, histograms are long tables of
    (row, bin, share)."""
    q = quality
    listed = ", ".join(f"({lang!r}, {words!r})" for lang, words in sorted(q.COMMON_WORDS.items()))

    def divergence(name: str, histogram: str, refs: str) -> str:
        half = "case when {0} > 0 then {0} * log2(2 * {0} / ({0} + {1})) else 0 end"
        return f"""{name} as (
  select rid, sqrt(greatest(sum(({half.format('p', 'r')} + {half.format('r', 'p')}) / 2), 0)) as js
  from {histogram} join {refs} using (ref, k) group by rid)"""

    def means(name: str, histogram: str, rows: str) -> str:
        return f"""{name} as (
  select ref, k, avg(p) as r from {histogram} semi join {rows} using (rid) where ref <> '' group by all
  union all select '', k, avg(p) from {histogram} semi join {rows} using (rid) group by k)"""

    return f"""
with listed(lang, common) as (values {listed}),
d as (
  select row_number() over () as rid, doc_id, coalesce(l.lang, '') as ref, common, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents left join listed l using (lang)
), windows as (
  select rid, i, words[i:i + 2] as g from (select rid, words, unnest(range(1, len(words) - 1)) as i from d)
), repeated as (
  select rid, count(distinct place) as n
  from (select rid, unnest([i, i + 1, i + 2]) as place
        from windows semi join (select rid, g from windows group by all having count(*) > 1) twice using (rid, g))
  group by rid
), f as (
  select rid, doc_id, ref, common, words, t, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words,
         length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) as upper,
         length(t) - length(regexp_replace(t, '[.,;:!?''"()\\[\\]-]', '', 'g')) as punct,
         len(words) < {q.MIN_BASE_WORDS} or 100 * coalesce(n, 0) > 50 * len(words) as base_failed
  from d left join repeated using (rid)
), chars as (
  select rid, ref, unnest(range({len(q.CLASSES)})) as k, unnest([upper, punct, n_symbols, length(t) - word_chars,
         word_chars - upper - punct - n_symbols]) / greatest(length(t), 1) as p from f
), hits as (
  select rid, ref, k, len(list_filter(words, lambda x: x = common[k + 1])) as n, n_words
  from (select rid, ref, words, common, n_words, unnest(range({q.BINS})) as k from f where ref <> '')
), bins as (
  select rid, ref, k, n / greatest(n_words, 1) as p from hits
  union all select rid, ref, {q.BINS}, (any_value(n_words) - sum(n)) / greatest(any_value(n_words), 1) from hits group by rid, ref
), good as (from f where not base_failed
), {means("first_refs", "chars", "good")}, {divergence("first_js", "chars", "first_refs")}, near as (
  select rid from (select rid, js, avg(js) over (partition by ref) as mean_js from first_js join good using (rid)) where js <= mean_js
), {means("char_refs", "chars", "near")}, {divergence("char_js", "chars", "char_refs")},
{means("word_refs", "bins", "near")}, {divergence("word_js", "bins", "word_refs")}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not coalesce(length(t) >= {q.MIN_CHARS} and c.js > {q.MAX_CHARS_JS}
                                        or n_words >= {q.MIN_WORDS} and coalesce(w.js, 0) > {q.MAX_WORDS_JS}, false) as kept
from f left join char_js c using (rid) left join word_js w using (rid)"""


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": quality_sql(), "op11_term_pipeline": ranked_search.SQL, "op12_collocations": collocations.SQL}
