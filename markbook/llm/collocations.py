"""Operator 12: phrase collocation mining with broadcast double-array tries.

Words are counted once by shuffle; the frequent ones get numbers, and every text becomes an array of
them (0: a piece ends, or a word too rare for any candidate).  Then, for phrases of k = 2 to 5 words:

* candidates: (k-1)-phrases that are frequent at a place and at the next one make a k-phrase.  A pass
  over the texts hashes these into buckets of counts, in two tables by two hashes, which are summed over the
  tasks; only k-phrases whose buckets both reach the threshold can be frequent.  The tables grow with
  the corpus up to ``MOST_BUCKETS`` (beyond, more candidates pass).  Another pass lists those that are met;
* count: the candidates are compiled into a double-array trie and broadcast; numpy moves the states of
  all text positions through it at once, word by word, ``bincount`` adds up the accepting states, and
  the tasks' counts are summed.

Nothing frequent is ever missed: a phrase has both its (k-1)-phrases at each of its places, and its bucket
counts at least its own occurrences.  A trie holds at most about ``TRIE_PHRASES``; more are dealt by hash
into several tries, one pass each, where a candidate's second (k-1)-phrase is not asked for (which only
lets more through to the count).  Likewise words beyond ``BLOCK_WORDS`` are numbered in several passes.

Defined results: null lang is ``und``; null and empty texts have no words; repeated rows count as often
as they occur; ids may be null or repeated, they are not read; an empty table gives no rows; further columns
are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from markbook.llm.common import mix64, scratch, stored

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
TRIE_PHRASES = 2_000_000
BLOCK_WORDS = 1_000_000
HELD_WORDS = 500_000  # distinct words that a task counts before it hands them on
TOGETHER = 4_000_000  # words that move through a trie at once
MOST_BUCKETS = 1 << 27  # of each of the two bucket tables
CHUNK = 1 << 16
TASKS_TOGETHER = 64  # tasks whose tables are added up first

_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(10 if c in _PIECE_ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words and piece ends (a line break) in their order, with empty strings in between."""
    return text.encode().translate(_FOLD).replace(b"\n", b" \n ").split(b" ") if text else []


# --- words ---------------------------------------------------------------------------------------

def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of all words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def out():
            flat = [(lang, w.decode(), n) for lang, words in seen.items() for w, n in words.items() if w and w != b"\n"]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in flat], pa.string()), pa.array([r[1] for r in flat], pa.string()),
                                               pa.array([r[2] for r in flat], pa.int64())], names=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, seen.values())) > HELD_WORDS:
                yield out()
        yield out()

    return rows.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def number_words(spark: SparkSession, rows: DataFrame, numbered: DataFrame, blocks: int) -> DataFrame:
    """Texts as arrays of word numbers (int32 in ``ids``): 0 at a piece's end and for words without a number."""
    coded = rows.select("lang", "text", F.lit(None).cast("binary").alias("ids"))
    for block in range(blocks):
        part = numbered.where(F.col("block") == block).select("lang", "word", "id").toArrow()
        sent = spark.sparkContext.broadcast(part)

        def encode(batches: Iterator[pa.RecordBatch], sent=sent, last=block == blocks - 1) -> Iterator[pa.RecordBatch]:
            known: dict[str, dict[bytes, int]] = {}
            listed = sent.value
            for lang, word, i in zip(*(listed.column(c).to_pylist() for c in ("lang", "word", "id"))):
                known.setdefault(lang, {})[word.encode()] = i
            for batch in batches:
                out = []
                for lang, text, before in zip(*(batch.column(c).to_pylist() for c in range(3))):
                    number = known.get(lang, {}).get
                    ids = np.array([number(w, 0) if w else -1 for w in words_of(text)], np.int32)
                    ids = ids[ids >= 0]
                    out.append((ids if before is None else np.maximum(ids, np.frombuffer(before, np.int32))).tobytes())
                keep = pa.nulls(len(out), pa.string()) if last else batch.column(1)
                yield pa.RecordBatch.from_arrays([batch.column(0), keep, pa.array(out, pa.binary())], names=["lang", "text", "ids"])

        coded = coded.mapInArrow(encode, "lang string, text string, ids binary")
    return coded.select("ids")


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Texts' word numbers, many texts together, a 0 after each and enough at the end."""
    held, size = [], 0
    for batch in batches:
        for ids in batch.column(0).to_pylist():
            held += [np.frombuffer(ids, np.int32), np.zeros(1, np.int32)]
            size += len(ids) // 4 + 1
            if size >= TOGETHER:
                yield np.concatenate([*held, np.zeros(LONGEST, np.int32)])
                held, size = [], 0
    if held:
        yield np.concatenate([*held, np.zeros(LONGEST, np.int32)])


# --- the trie ------------------------------------------------------------------------------------

class Trie:
    """Double-array trie over word sequences of one length.  A word is two symbols, so that a state has
    at most about the root of the word numbers as children.  State = slot; the child of state s by symbol
    c is slot base[s] + c if check there is s; the last state of sequence i accepts i."""

    def __init__(self, sequences: np.ndarray):
        n, k = sequences.shape
        self.sequences, self.k = sequences, k
        self.bits = max(8, (int(sequences.max(initial=0)).bit_length() + 1) // 2)
        width = 1 << self.bits
        symbols = np.stack([sequences >> self.bits, sequences & (width - 1)], axis=2).reshape(n, 2 * k)
        # nodes: number of the prefix, level by level; edges (parent, symbol, child)
        node, nodes, edges = np.zeros(n, np.int64), 1, []
        for d in range(2 * k):
            code, first, inner = np.unique(node << self.bits | symbols[:, d], return_index=True, return_inverse=True)
            edges.append((node[first], symbols[first, d].astype(np.int64), nodes + np.arange(len(code))))
            node = nodes + inner
            nodes += len(code)
        parent, symbol, child = (np.concatenate(x) for x in zip(*edges))
        offset = self._place(parent, symbol, nodes, width)
        slot = np.zeros(nodes, np.int64)
        slot[child] = offset[parent] + symbol
        size = int(slot.max(initial=0)) + width + 1
        self.base, self.check, self.accept = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.base[slot] = offset
        self.check[slot[child]] = slot[parent]
        self.accept[slot[node]] = np.arange(n)

    @staticmethod
    def _place(parent: np.ndarray, symbol: np.ndarray, nodes: int, width: int) -> np.ndarray:
        """Offset of every node such that no two children share a slot: first fit, nodes with many
        children first; only children take the slots left over."""
        order = np.argsort(parent, kind="stable")
        children, count = symbol[order], np.bincount(parent, minlength=nodes)
        start = np.concatenate([[0], np.cumsum(count)])
        offset, taken, low, window = np.zeros(nodes, np.int64), np.zeros(8 * width, bool), 1, np.arange(512)
        taken[0] = True  # the root
        several = np.flatnonzero(count > 1)
        for v in several[np.argsort(-count[several], kind="stable")].tolist():
            own, at = children[start[v]:start[v + 1]], low
            while True:
                if at + len(window) + width >= len(taken):
                    taken = np.concatenate([taken, np.zeros(len(taken), bool)])
                free = np.flatnonzero(~taken[(at + window)[:, None] + own].any(axis=1))
                if len(free):
                    break
                at += len(window)
            at += int(free[0])
            offset[v] = at
            taken[at + own] = True
            low = max(low, at - 16 * len(window))
        single = np.flatnonzero(count == 1)
        if len(taken) < 2 * width + len(single) + int(taken.sum()):
            taken = np.concatenate([taken, np.zeros(2 * width + len(single) + int(taken.sum()), bool)])
        free = np.flatnonzero(~taken[width:])[:len(single)] + width
        offset[single] = free - children[start[single]]
        return offset

    def walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places at which a sequence starts, in order, and which one."""
        high, low = x >> self.bits, x & ((1 << self.bits) - 1)
        places = np.flatnonzero(x[:len(x) - self.k])
        states = np.zeros(len(places), np.int32)
        for d in range(self.k):
            for digits in (high, low):
                to = self.base[states] + digits[places + d]
                on = self.check[to] == states
                places, states = places[on], to[on]
        return places, self.accept[states]


# --- candidates and counts -----------------------------------------------------------------------

def _buckets(x: np.ndarray, places: np.ndarray, k: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the k words at each place, in either table: the first and the last bits of one hash."""
    h = np.zeros(len(places), np.uint64)
    for d in range(k):
        h = mix64(h + x[places + d].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return (h >> np.uint64(64 - bits)).astype(np.int64), (h & np.uint64((1 << bits) - 1)).astype(np.int64)


def _extensible(x: np.ndarray, places: np.ndarray, both: bool) -> np.ndarray:
    """Of the places of frequent phrases of k words, those where k + 1 words may be frequent: the phrase at the
    next place is too (``both``), or at least the word after it."""
    hit = np.zeros(len(x) + 1, bool)
    hit[places] = True
    return places[hit[places + 1]] if both else places


class Buckets:
    """A task's two tables of counts, cut off at the threshold: their sums reach it just as the full sums do."""

    def __init__(self, bits: int, least: int):
        self.bits, self.least = bits, least
        self.tables = np.zeros((2, 1 << bits), np.uint8 if least < 256 else np.int32)

    def add(self, buckets: tuple[np.ndarray, np.ndarray]) -> None:
        for table, own in zip(self.tables, buckets):
            if len(table) <= TOGETHER:
                table[:] = np.minimum(table + np.bincount(own, minlength=len(table)), self.least)
            else:
                own, n = np.unique(own, return_counts=True)
                table[own] = np.minimum(table[own] + n, self.least)

    def rows(self) -> Iterator[pa.RecordBatch]:
        yield from packed(self.tables.reshape(-1), "buckets", min(CHUNK, 1 << self.bits))


def packed(table: np.ndarray, what: str, size: int) -> Iterator[pa.RecordBatch]:
    """A task's table in chunks, each as its places and values above zero."""
    group = TaskContext.get().partitionId() // TASKS_TOGETHER
    for chunk in range(-(-len(table) // size)):
        part = table[chunk * size:(chunk + 1) * size]
        at = np.flatnonzero(part)
        if len(at):
            yield pa.RecordBatch.from_pydict({"what": [what], "task_group": pa.array([group], pa.int32()), "chunk": pa.array([chunk], pa.int32()),
                                              "places": [at.astype(np.uint16).tobytes()], "counts": [part[at].tobytes()]})


PASSED = "what string, task_group int, chunk int, places binary, counts binary"


def summed(passed: DataFrame, what: str, size: int, kind, most: int, least: int) -> DataFrame:
    """(chunk, places, counts): packed tables added up over the tasks in two steps, so that no task adds up a chunk
    of every task; sums cut off at ``most``, those below ``least`` left out at the end."""
    def adding(least: int):
        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros(size, np.int64)
            for at, n in zip(pdf["places"], pdf["counts"]):
                total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, kind)
            at = np.flatnonzero(total >= least)
            return pd.DataFrame({"task_group": pdf["task_group"].iloc[:1], "chunk": pdf["chunk"].iloc[:1], "places": [at.astype(np.uint16).tobytes()],
                                 "counts": [np.minimum(total[at], most).astype(kind).tobytes()]})
        return add

    schema = "task_group int, chunk int, places binary, counts binary"
    part = passed.where(F.col("what") == what).drop("what")
    once = part.groupBy("task_group", "chunk").applyInPandas(adding(1), schema)
    return once.groupBy("chunk").applyInPandas(adding(least), schema).drop("task_group")


def frequent_buckets(passed: DataFrame, bits: int, least: int) -> np.ndarray:
    """Which buckets of either table reach the threshold over all tasks, one bit each."""
    kind, size = np.uint8 if least < 256 else np.int32, min(CHUNK, 1 << bits)
    flags = np.zeros(((2 << bits) // size, size), bool)
    for chunk, at in summed(passed, "buckets", size, kind, least, least).select("chunk", "places").collect():
        flags[chunk, np.frombuffer(at, np.uint16)] = True
    return np.packbits(flags.reshape(2, -1), axis=1)


def frequent_sequences(passed: DataFrame, n: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the trie's ``n`` sequences occur at least ``least`` times, and how often."""
    counts = np.zeros(-(-n // CHUNK) * CHUNK, np.int64)
    for chunk, at, f in summed(passed, "sequences", CHUNK, np.int64, 1 << 62, least).collect():
        counts[chunk * CHUNK + np.frombuffer(at, np.uint16).astype(np.int64)] = np.frombuffer(f, np.int64)
    i = np.flatnonzero(counts)
    return i, counts[i]


def _may_be(flags: np.ndarray, buckets: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    first, second = (table[b >> 3] >> (7 - (b & 7)).astype(np.uint8) & 1 for table, b in zip(flags, buckets))
    return (first & second).astype(bool)


def first_buckets(coded: DataFrame, bits: int, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(bits, least)
        for x in stretches(batches):
            places = np.flatnonzero(x[:-1])
            buckets.add(_buckets(x, _extensible(x, places, True), 2, bits))
        yield from buckets.rows()

    return coded.mapInArrow(run, PASSED)


def count_phrases(spark: SparkSession, coded: DataFrame, trie: Trie, bits: int, least: int, both: bool, extend: bool) -> DataFrame:
    """A pass with one trie: each task's counts of the sequences, and its buckets of the next length."""
    sent = spark.sparkContext.broadcast(trie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = sent.value
        counts, buckets = np.zeros(len(trie.sequences), np.int64), Buckets(bits, least)
        for x in stretches(batches):
            places, which = trie.walk(x)
            counts += np.bincount(which, minlength=len(counts))
            if extend:
                on = _extensible(x, places, both)
                on = on[x[on + trie.k] > 0]
                buckets.add(_buckets(x, on, trie.k + 1, bits))
        yield from packed(counts, "sequences", CHUNK)
        if extend:
            yield from buckets.rows()

    return coded.mapInArrow(run, PASSED)


def met_candidates(spark: SparkSession, coded: DataFrame, trie: Trie | None, flags: np.ndarray, both: bool) -> DataFrame:
    """Distinct sequences one word longer than the trie's (pairs, without one) that are met and may be frequent."""
    sent = spark.sparkContext.broadcast((trie, flags))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, flags = sent.value
        k, bits = (trie.k if trie else 1) + 1, (8 * flags.shape[1]).bit_length() - 1
        seen = np.zeros((0, k), np.int32)
        for x in stretches(batches):
            on = _extensible(x, trie.walk(x)[0] if trie else np.flatnonzero(x[:-1]), both)
            on = on[x[on + k - 1] > 0]
            on = on[_may_be(flags, _buckets(x, on, k, bits))]
            found = np.stack([x[on + d] for d in range(k)], axis=1)
            seen = np.unique(np.concatenate([seen, found]), axis=0)
            if len(seen) > HELD_WORDS:
                yield out(seen)
                seen = seen[:0]
        yield out(seen)

    def out(seen: np.ndarray) -> pa.RecordBatch:
        """Chunks by hash, sequences one after the other."""
        k = seen.shape[1]
        chunk = (_buckets(seen.reshape(-1), np.arange(len(seen)) * k, k, 8)[0] if len(seen) else np.zeros(0, np.int64))
        parts = [(c, seen[chunk == c]) for c in np.unique(chunk)]
        return pa.RecordBatch.from_pydict({"task_group": pa.array([TaskContext.get().partitionId() // TASKS_TOGETHER] * len(parts), pa.int32()),
                                           "chunk": pa.array([c for c, _ in parts], pa.int32()), "k": pa.array([k] * len(parts), pa.int32()),
                                           "words": pa.array([p.tobytes() for _, p in parts], pa.binary())})

    def merged(pdf: pd.DataFrame) -> np.ndarray:
        return np.unique(np.concatenate([np.frombuffer(w, np.int32) for w in pdf["words"]]).reshape(-1, pdf["k"].iloc[0]), axis=0)

    def once(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[:1].assign(words=[merged(pdf).tobytes()])

    def rows(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"words": list(merged(pdf))})

    schema = "task_group int, chunk int, k int, words binary"
    part = coded.mapInArrow(run, schema).groupBy("task_group", "chunk").applyInPandas(once, schema)
    return part.groupBy("chunk").applyInPandas(rows, "words array<int>")


def _blocks(phrases: DataFrame, n: int) -> Iterator[np.ndarray]:
    """The phrases in blocks of about ``TRIE_PHRASES``, as sorted arrays, one block at a time."""
    blocks = -(-n // TRIE_PHRASES)
    for b in range(blocks):
        part = phrases.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b) if blocks > 1 else phrases
        words = part.select("words").toArrow().column(0).combine_chunks()
        flat = words.flatten().to_numpy().astype(np.int32).reshape(len(words), -1)
        yield flat[np.lexsort(flat.T[::-1])]


def frequent_phrases(spark: SparkSession, coded: DataFrame, n_words: int, least: int, longest: int) -> DataFrame | None:
    """(words: array of word numbers, f) of all phrases of 2 to ``longest`` words with f >= ``least``."""
    bits = min(MOST_BUCKETS.bit_length() - 1, max(16, (n_words // 32).bit_length()))
    flags = frequent_buckets(stored(spark, first_buckets(coded, bits, least), "buckets"), bits, least)
    found, before, n_before = None, None, 0
    for k in range(2, longest + 1):
        # candidates, from the tries of frequent (k-1)-phrases
        both = n_before <= TRIE_PHRASES
        tries = [None] if before is None else (Trie(b) for b in _blocks(before, n_before))
        met = None
        for trie in tries:
            part = stored(spark, met_candidates(spark, coded, trie, flags, both), "met")
            met = part if met is None else met.union(part)
        n = met.count()
        if not n:
            break
        # counts, with tries of the candidates
        passes, level = [], None
        for block in _blocks(met, n):
            passes.append(stored(spark, count_phrases(spark, coded, Trie(block), bits, least, n <= TRIE_PHRASES, k < longest), "passes"))
            i, f = frequent_sequences(passes[-1], len(block), least)
            rows = pa.table({"words": pa.array(list(block[i]), pa.list_(pa.int32())), "f": pa.array(f, pa.int64())})
            part = stored(spark, spark.createDataFrame(rows), "frequent") if len(i) else None
            level = part if level is None else level if part is None else level.union(part)
        if level is None:
            break
        found = level if found is None else found.union(level)
        before, n_before = level, level.count()
        if k < longest:
            every = passes[0]
            for p in passes[1:]:
                every = every.union(p)
            flags = frequent_buckets(every, bits, least)
    return found


def collocations(spark: SparkSession, docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = MIN_COUNT,
                 longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each lang: lang, rank, phrase, a, l, r, n, score, and words_in, the phrase's length."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    with scratch(spark):
        counts = stored(spark, word_counts(rows), "words")
        totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
        frequent = counts.where(F.col("n") >= least)
        n_frequent, n_words = frequent.agg(F.count("*"), F.sum("n")).first()
        phrases = None
        if n_frequent:
            blocks = -(-n_frequent // BLOCK_WORDS)
            numbered = None
            for b in range(blocks):  # numbers without gaps, frequent words first within a block
                part = frequent.where(F.pmod(F.xxhash64("lang", "word"), F.lit(blocks)) == b).toArrow().sort_by([("n", "descending"), ("lang", "ascending"), ("word", "ascending")])
                part = part.append_column("id", pa.array(np.arange(len(part), dtype=np.int32) * blocks + b + 1))
                part = stored(spark, spark.createDataFrame(part.append_column("block", pa.array(np.full(len(part), b, np.int32)))), "numbered")
                numbered = part if numbered is None else numbered.union(part)
            coded = stored(spark, number_words(spark, rows, numbered, blocks), "coded")
            phrases = frequent_phrases(spark, coded, n_words, least, longest)
        if phrases is None:
            return spark.createDataFrame([], "lang string, rank int, phrase string, a long, l long, r long, n long, score long, words_in int")
        ranked = score_phrases(phrases, numbered, totals, top)
        return stored(spark, ranked, "ranked", kept=True)


def score_phrases(phrases: DataFrame, numbered: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    every = phrases.union(numbered.select(F.array("id"), "n"))
    size = F.size("words")
    cuts = phrases.select("words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("first"), F.slice("words", F.col("k") + 1, size).alias("rest"))
    cuts = cuts.join(every.toDF("first", "l"), "first").join(every.toDF("rest", "r"), "rest")

    # inside a longer one as often: by one word longer is enough, counts only fall with length
    longer = phrases.where(size > 2)
    inner = longer.select(F.slice("words", F.lit(1), size - 1).alias("words"), "f").union(
        longer.select(F.slice("words", F.lit(2), size), "f")).groupBy("words").agg(F.max("f").alias("most"))
    stay = phrases.join(inner, "words", "left").where(F.col("most").isNull() | (F.col("most") < F.col("f"))).select("words")

    # words and lang, from the numbers
    named = stay.select("words", F.posexplode("words").alias("at", "id")).join(numbered.select("id", "lang", "word"), "id").groupBy("words").agg(
        F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    exact = "(1000 * cast(a as decimal(18, 0)) * cast(n as decimal(16, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"
    scored = cuts.join(named, "words").join(totals, "lang").withColumn("score", F.expr(exact))
    best = scored.groupBy("lang", "words").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"),
                                               F.first("n").alias("n"), F.first("phrase").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", size.alias("words_in"))


SQL = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as words
  from (select lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[.,;:!?\x0A-\x0D]')) as piece from documents)
), phrases as (
  select lang, len, words[i:i + len - 1] as g, count(*)::bigint as f
  from (select lang, len, words, unnest(range(1, len(words) - len + 2)) as i
        from pieces, (select unnest(range(1, {LONGEST + 1})) as len))
  group by all having count(*) >= {MIN_COUNT}
), totals as (select lang, sum(len(words))::bigint as n from pieces group by lang
), inner_ones as (
  select lang, g, max(f) as most from (
    select lang, unnest([g[1:len - 1], g[2:len]]) as g, f from phrases where len > 2) group by all
), cuts as (
  select p.lang, p.g, p.len, p.f as a, k, x.f as l, y.f as r, n, ((1000::hugeint * p.f * n) // (x.f::hugeint * y.f))::bigint as score
  from (select *, unnest(range(1, len)) as k from phrases where len > 1) p
  join phrases x on x.lang = p.lang and x.g = p.g[1:k] join phrases y on y.lang = p.lang and y.g = p.g[k + 1:p.len]
  join totals t on t.lang = p.lang
), worst as (select * from cuts qualify row_number() over (partition by lang, g order by score, k) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, array_to_string(g, ' '))::int as rank,
       array_to_string(g, ' ') as phrase, a, l, r, n, score, len::int as words_in
from worst left join inner_ones using (lang, g) where most is null or most < a
qualify rank <= {TOP}"""
