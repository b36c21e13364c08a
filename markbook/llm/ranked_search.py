"""Operator 11: ranked lexical search by pipelined term partitioning.

Documents are dealt into shards (runs of at most ``SHARD_DOCS`` rows of one input partition), terms
to owners, rare terms first.  One bundle per (shard, item) carries a sparse accumulator, the
documents that may still win and their integer scores so far, through the owners: at stage k a
cogroup brings the shard's bundles to owner k's posting lists of that shard, which adds what the
item's terms there are worth.  The last stage leaves each shard's best documents of an item, and a
rank over the shards picks the answer.

A document leaves a bundle only if its score so far plus the most that the owners still to come can
add is below the shard's k-th best score so far.  That bound holds whatever comes, ties stay, and
so the result is exact.

Items are taken in blocks of about ``BLOCK_ITEMS``; what is broadcast (a block's terms, weights and
item lists) is bounded by the block, and each block reads the documents once.

Defined results: a null text has no terms, is not counted and never found; every row is a document of
its own, also with a repeated or null id (null after all others); equal (item_id, text) rows are one
item, an item without terms has no rows; empty tables give no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from markbook.llm.common import scratch, stored

SHARD_DOCS = 4096
SHARD_BYTES = 64 << 20  # a shard also ends after so much text
OWNERS = 4
TOP = 10
BLOCK_ITEMS = 1000

# fixed values of the score
LENGTH_SHARE, TF_SCALE, LENGTH_SCALE = 75, 1000, 8

_FOLD = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
              for c in range(256))

SHARDS = ("shard long, doc_ids array<long>, n_terms binary, place binary, term binary, tf binary, "
          "with_terms long, all_terms long")
LISTS = "shard long, doc_ids array<long>, terms binary, starts binary, place binary, worth binary, most binary, owner int"
BUNDLES = "shard long, item int, place binary, score binary"
FOUND = "item int, item_id long, doc_id long, score long"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text: runs of digits, letters and everything beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(_FOLD).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(doc)
            texts.append(text)
            size += len(text or "")
            if len(ids) >= SHARD_DOCS or size >= SHARD_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def shards(spark: SparkSession, docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """One row per shard: its documents, their lengths, and (place, term, tf) of the vocabulary's terms."""
    known = spark.sparkContext.broadcast(vocabulary)

    def build(batches):
        number = {t: i for i, t in enumerate(known.value)}
        part, run = TaskContext.get().partitionId(), 0
        for ids, texts in _runs(batches):
            lengths, places, found, tfs = [], [], [], []
            for place, text in enumerate(texts):
                words = terms(text)
                lengths.append(len(words))
                hits, counts = np.unique(np.array([number[w] for w in words if w in number], np.int32), return_counts=True)
                places.append(np.full(len(hits), place, np.int32))
                found.append(hits)
                tfs.append(counts.astype(np.int32))
            n = np.array(lengths, np.int32)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([part << 32 | run], pa.int64()), "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "n_terms": [n.tobytes()], "place": [np.concatenate(places).tobytes()],
                "term": [np.concatenate(found).tobytes()], "tf": [np.concatenate(tfs).tobytes()],
                "with_terms": pa.array([int((n > 0).sum())], pa.int64()), "all_terms": pa.array([int(n.sum(dtype=np.int64))], pa.int64())})
            run += 1

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(build, SHARDS)


def _per_term(df: DataFrame, make, how) -> dict[int, int]:
    """Reduces (term, value) pairs that ``make`` finds in a row over all shards; one entry per term."""
    def rows(batches):
        for batch in batches:
            for row in batch.to_pylist():
                t, v = make(row)
                yield pa.RecordBatch.from_pydict({"t": pa.array(t, pa.int32()), "v": pa.array(v, pa.int64())})

    return dict(df.mapInArrow(rows, "t int, v long").groupBy("t").agg(how("v")).collect())


def posting_lists(spark: SparkSession, indexed: DataFrame, weights: list[int], owner_of: list[int], n_docs: int, n_terms: int) -> DataFrame:
    """One row per (owner, shard): the owner's terms there, where each term's list starts, and the lists:
    place and worth, the integer that the document gets for one mention of the term in an item."""
    sent = spark.sparkContext.broadcast((np.array(weights, np.int64), np.array(owner_of, np.int32)))
    owners = max(owner_of) + 1

    def invert(batches):
        w, owner = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                n, place, term, tf = (np.frombuffer(row[c], np.int32) for c in ("n_terms", "place", "term", "tf"))
                m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * x * n_docs // n_terms for x in n.tolist()], np.int64)
                tf = tf.astype(np.int64)
                worth = w[term] * ((10 ** 9 * tf) // (TF_SCALE * tf + LENGTH_SCALE * m[place]))
                order = np.lexsort((place, term, owner[term]))
                place, term, worth = place[order], term[order], worth[order]
                cuts = np.searchsorted(owner[term], np.arange(owners + 1))
                for k in range(owners):
                    p, t, v = (x[cuts[k]:cuts[k + 1]] for x in (place, term, worth))
                    own, starts = np.unique(t, return_index=True)
                    most = np.maximum.reduceat(v, starts) if len(v) else v
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([row["shard"]], pa.int64()), "doc_ids": pa.array([row["doc_ids"]], pa.list_(pa.int64())),
                        "terms": [own.tobytes()], "starts": [np.append(starts, len(t)).astype(np.int32).tobytes()],
                        "place": [p.tobytes()], "worth": [v.tobytes()], "most": [most.tobytes()], "owner": pa.array([k], pa.int32())})

    return indexed.mapInArrow(invert, LISTS)


def stage(plan, top: int, last: bool):
    """What an owner does with a shard's bundles; ``plan``: a broadcast list of (item, item_id, the item's
    terms here, their repeats, the most that later owners add)."""

    def visit(bundles: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
        held = {i: (np.frombuffer(p, np.int32), np.frombuffer(s, np.int64))
                for i, p, s in zip(bundles["item"], bundles["place"], bundles["score"])}
        row = lists.iloc[0]
        own, starts = np.frombuffer(row["terms"], np.int32), np.frombuffer(row["starts"], np.int32)
        place, worth = np.frombuffer(row["place"], np.int32), np.frombuffer(row["worth"], np.int64)
        score = np.zeros(len(row["doc_ids"]), np.int64)
        out = []
        for item, item_id, wanted, repeats, rest in plan.value:
            at = np.searchsorted(own, wanted)
            here = np.flatnonzero(own[np.minimum(at, len(own) - 1)] == wanted) if len(own) else []
            if item not in held and not len(here):
                continue
            score[:] = 0
            if item in held:
                score[held[item][0]] = held[item][1]
            for j in here:
                a, b = starts[at[j]], starts[at[j] + 1]
                score[place[a:b]] += worth[a:b] * repeats[j]
            alive = np.flatnonzero(score)
            got = score[alive]
            if len(alive) > top:  # the k-th best so far can only rise
                stay = got + rest >= np.partition(got, len(got) - top)[len(got) - top]
                alive, got = alive[stay], got[stay]
            if not len(alive):
                continue
            if not last:
                out.append((row["shard"], item, alive.astype(np.int32).tobytes(), got.tobytes()))
                continue
            best = sorted((-s, doc is None, doc or 0) for s, doc in zip(got.tolist(), (row["doc_ids"][p] for p in alive)))
            out += [(item, item_id, None if none else doc, -s) for s, none, doc in best[:top]]
        if last:
            found = pd.DataFrame(out, columns=["item", "item_id", "doc_id", "score"])
            return found.astype({"item": "int32", "item_id": "Int64", "doc_id": "Int64", "score": "int64"})
        return pd.DataFrame(out, columns=["shard", "item", "place", "score"]).astype({"shard": "int64", "item": "int32"})

    return visit


def _search_block(spark: SparkSession, docs: DataFrame, items: list[tuple[int | None, Counter]], id_col: str,
                  text_col: str, top: int, n_owners: int) -> DataFrame | None:
    vocabulary = sorted({t for _, own in items for t in own})
    if not vocabulary:
        return None
    indexed = stored(spark, shards(spark, docs, vocabulary, id_col, text_col), "shards")
    n_docs, n_terms = indexed.agg(F.sum("with_terms"), F.sum("all_terms")).first()
    if not n_docs:
        return None
    df = _per_term(indexed, lambda row: np.unique(np.frombuffer(row["term"], np.int32), return_counts=True), F.sum)
    weights = [weight(n_docs, df.get(i, 0)) for i in range(len(vocabulary))]

    # rare terms first, each owner with about as many postings
    owner_of, before, postings = [0] * len(vocabulary), 0, sum(df.values())
    for i in sorted(df, key=lambda i: (df[i], i)):
        owner_of[i] = min(n_owners - 1, before * n_owners // postings)
        before += df[i]
    lists = stored(spark, posting_lists(spark, indexed, weights, owner_of, n_docs, n_terms), "lists", by="owner")
    most = _per_term(lists, lambda row: (np.frombuffer(row["terms"], np.int32), np.frombuffer(row["most"], np.int64)), F.max)

    number = {t: i for i, t in enumerate(vocabulary)}
    plans, owners = [], max(owner_of) + 1
    for k in range(owners):
        plan = []
        for i, (item_id, own) in enumerate(items):
            wanted = sorted(number[t] for t in own if number[t] in df)
            repeats = {number[t]: c for t, c in own.items()}
            rest = sum(repeats[t] * most.get(t, 0) for t in wanted if owner_of[t] > k)
            mine = [t for t in wanted if owner_of[t] == k]
            plan.append((i, item_id, np.array(mine, np.int32), np.array([repeats[t] for t in mine], np.int64), rest))
        plans.append(spark.sparkContext.broadcast(plan))

    bundles = spark.createDataFrame([], BUNDLES)
    for k in range(owners):
        last = k == owners - 1
        here = lists.where(F.col("owner") == k).drop("owner", "most")
        bundles = bundles.groupBy("shard").cogroup(here.groupBy("shard")).applyInPandas(
            stage(plans[k], top, last), FOUND if last else BUNDLES)
    return bundles


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", top: int = TOP, owners: int = OWNERS) -> DataFrame:
    """The ``top`` documents of each item as (item_id, rank, doc_id, score)."""
    own = items.select(F.col(item_col).cast("long").alias("i"), F.col(item_text).cast("string").alias("t")).distinct()
    blocks = -(-own.count() // BLOCK_ITEMS)
    dealt = own.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(max(1, blocks))))
    best = Window.partitionBy("item_id", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    out = None
    for b in range(blocks):
        with scratch(spark):
            block = [(r["i"], Counter(terms(r["t"]))) for r in dealt.where(F.col("b") == b).orderBy("i", "t").collect()]
            found = _search_block(spark, docs, block, id_col, text_col, top, owners)
            if found is None:
                continue
            ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            kept = stored(spark, ranked.select("item_id", "rank", "doc_id", "score"), "ranked", kept=True)
        out = kept if out is None else out.union(kept)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


SQL = r"""
with words as (
  select rid, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as rid, doc_id, text from documents)
), lengths as (select rid, doc_id, count(*)::bigint as n from words group by rid, doc_id
), totals as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from lengths
), asked as (
  select item, item_id, term, count(*)::bigint as repeats from (
    select row_number() over () as item, item_id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select distinct item_id, text from benchmark))
  group by all
), tfs as (select rid, term, count(*)::bigint as tf from words semi join asked using (term) group by all
), weights as (
  select term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::bigint as w from tfs, totals group by term
), scores as (
  select item, item_id, rid, doc_id,
         sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_terms)))))::bigint as score
  from asked join tfs using (term) join weights using (term) join lengths using (rid), totals
  group by all
)
select item_id, row_number() over (partition by item_id, item order by score desc, doc_id nulls last)::int as rank, doc_id, score
from scores where score > 0
qualify rank <= 10"""
