"""Operator 3: near-duplicate paragraphs by MinHash banding.

A paragraph is what stands between line breaks, whatever its sentences' lengths.  Sentences of at
least ``MIN_WORDS`` words are units of their own besides, so a passage is met again inside other
paragraphs too.  Units with equal 5-word shingle sets form one class; fewer than five words
are one shingle, so only exact copies of such a paragraph are found.  A class has ``BANDS`` keys of
``ROWS`` minimum hashes each: two classes of Jaccard similarity 0.75 share no key with probability
(1 - 0.75 ** 2) ** 10, below 0.03 %.  Classes that share a key (paragraphs
with paragraphs, sentences with sentences, a paragraph of one sentence with both) are joined and
verified by the exact Jaccard similarity (at least 0.75); of a component of verified classes, one unit stays and the
others are removals.

What stays: the first whole paragraph (smallest doc_id, then place); among sentences alone, the
first that does not lie in a removed paragraph.  A sentence whose own paragraph is in the same
component is no member beside it.

Cases: null and blank texts have no paragraphs; copies and repeated rows fall into one
class, and equal ids and places leave exactly one of them as the first; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markbook.llm.common import SPACE, bucketed, dealt, hash_words, mix64, scratch, stored
from markbook.llm.jaccard import MINS, PLACES, WORDS, bits_for, cluster, marked, marks, shared_matrix

MIN_WORDS = 12
BANDS, ROWS = 10, 2
PART = 1 << 20  # bytes whose units are worked on together
ENDS = np.isin(np.arange(256), list(b".!?"))  # bytes that end a sentence
_HASHES = mix64(np.arange(1000, 1000 + BANDS * ROWS, dtype=np.uint64)) | np.uint64(1)


class Paragraphs:
    """Units of texts with their shingle sets."""

    def __init__(self, least: int = MIN_WORDS):
        self.least = max(least, 1)

    def __call__(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, ...]]:
        """Per bounded part of the texts: (text's place, number of the unit's first stretch,
        stretches, for a sentence its paragraph's number or else -1, words), a row for each unit;
        the units' distinct shingle hashes end to end, and how many each has."""
        held, size, first = [], 0, 0
        for t in texts:
            held.append((t or "").encode())
            size += len(held[-1])
            if size >= PART:
                yield from self.part(held, first)
                held, size, first = [], 0, first + len(held)
        yield from self.part(held, first)

    def part(self, texts: list[bytes], place: int) -> Iterator[tuple[np.ndarray, ...]]:
        text = b"\n".join(texts).lower()
        starts, h = hash_words(text)
        if not len(starts):
            return
        data = np.frombuffer(text, np.uint8)
        space = np.append(SPACE[data], True)
        h = named(text, space, starts, h)
        # a stretch begins behind each line break, and behind spaces that follow a sentence's end
        line = data == 0x0A
        cut = space[:-1].copy()
        cut[1:] &= ENDS[data[:-1]]
        cut[0] = False
        breaks = np.flatnonzero(cut | line)
        begins = np.append(True, line[breaks])  # whether the stretch begins a line
        line_of = np.cumsum(begins) - 1
        first = np.flatnonzero(begins)  # each line's first stretch
        stretches = np.diff(np.append(first, len(begins)))
        # words of every stretch and line
        at = np.append(np.searchsorted(starts, np.append(0, breaks)), len(starts))
        line_at = at[np.append(first, len(begins))]
        n, line_n = np.diff(at), np.diff(line_at)
        # the text of every line, and the text's first stretch
        text_begin = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        line_begin = np.append(-1, breaks)[first] + 1
        owner = np.searchsorted(text_begin, line_begin, side="right") - 1
        number = first - first[np.searchsorted(line_begin, text_begin)][owner]
        whole = np.flatnonzero(line_n >= self.least)
        part = np.flatnonzero((n >= MIN_WORDS) & (stretches[line_of] > 1))
        own = line_of[part]
        table = np.concatenate([
            np.stack([owner[whole], number[whole], stretches[whole], np.full(len(whole), -1), line_n[whole], line_at[whole]], 1),
            np.stack([owner[own], number[own] + part - first[own], np.ones(len(part), np.int64), number[own], n[part], at[part]], 1)])
        # a paragraph stands before its sentences
        table = table[np.argsort(np.concatenate([2 * first[whole], 2 * part + 1]), kind="stable")].astype(np.int64)
        table[:, 0] += place
        if len(table):
            yield self.sets(table, h)

    def sets(self, table: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, ...]:
        h = np.append(words, np.zeros(WORDS, np.uint64))
        total = np.zeros(len(words), np.uint64)
        for k in range(WORDS):
            total += h[k:k + len(words)] * PLACES[k]
        total = mix64(total)
        n, at = table[:, 4], table[:, 5]
        size = np.maximum(n - WORDS + 1, 1)
        start = np.cumsum(size) - size
        flat = total[np.repeat(at - start, size) + np.arange(size.sum())]
        few = np.flatnonzero(n < WORDS)  # one shingle of all words
        own = n[few].astype(np.uint64)
        for k in range(WORDS - 1):
            own += np.where(n[few] > k, h[at[few] + k] * PLACES[k], 0).astype(np.uint64)
        flat[start[few]] = mix64(own)
        unit = np.repeat(np.arange(len(n)), size)
        # by unit and the hash's upper bits in one number; what these leave in doubt is sorted in full
        bits = np.uint64(max(len(n) - 1, 1).bit_length())
        key = (unit.astype(np.uint64) << (np.uint64(64) - bits)) | (flat >> bits)
        order = np.argsort(key)
        key = key[order]
        if ((key[1:] == key[:-1]) & (flat[order[1:]] != flat[order[:-1]])).any():
            order = np.lexsort((flat, unit))
        flat = flat[order]
        fresh = np.append(True, (flat[1:] != flat[:-1]) | (unit[1:] != unit[:-1]))
        return table[:, :5], flat[fresh], np.add.reduceat(fresh.astype(np.int64), start)


def named(text: bytes, space: np.ndarray, starts: np.ndarray, h: np.ndarray) -> np.ndarray:
    """xxh3 of every word, computed once for the words of equal hash: band keys, and so what banding finds, rest on it.
    ``space``: which bytes part words, and true at the end."""
    order = np.argsort(h)
    fresh = np.append(True, h[order[1:]] != h[order[:-1]])
    first = order[fresh]
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    words = map(text.__getitem__, map(slice, starts[first].tolist(), ends[first].tolist()))
    new = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(first))
    out = np.empty_like(h)
    out[order] = new[np.cumsum(fresh) - 1]
    return out


def class_keys(flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit key of every set."""
    return mix64(np.add.reduceat(mix64(flat + PLACES[0]), np.cumsum(size) - size) + size.astype(np.uint64)).view(np.int64)


def paragraph_units(spark: SparkSession, rows: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_key (of the row), paragraph, stretches, inside, n_words, cls, n (set size) and
    the band keys, which a task sends once for a class.  Paragraphs have keys of one kind and
    sentences of another, else every paragraph would meet its own sentences; a paragraph of one
    sentence has both.  Sets that differ are similar from three shingles on only; smaller ones have no keys."""
    schema = "doc_id long, text_key long, paragraph int, stretches int, inside int, n_words int, cls long, n long, keys array<long>"
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = Paragraphs(least), (set(), set())
        for b in batches:
            for table, flat, size in own(x.as_py() for x in b.column(2)):
                cls, sentence = class_keys(flat, size), table[:, 3] >= 0
                both = ~sentence & (table[:, 2] == 1) & (table[:, 4] >= MIN_WORDS)
                send = np.zeros((2, len(cls)), bool)
                for role, taking in enumerate((~sentence, sentence | both)):
                    taken = np.flatnonzero(taking & (size > 2))
                    listed, first = np.unique(cls[taken], return_index=True)
                    fresh = [k for k, key in enumerate(listed.tolist()) if key not in seen[role]]
                    seen[role].update(listed[fresh].tolist())
                    send[role, taken[first[fresh]]] = True
                place = pa.array(table[:, 0])
                cols = [b.column(0).take(place), b.column(1).take(place), *table[:, 1:].T, cls, size, sent_keys(flat, size, send)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                 names=[c.split()[0] for c in schema.split(", ")])

    return stored(spark, rows.mapInArrow(run, schema), "units")


def band_keys(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(paragraph, band) keys of the sets that lie end to end in ``flat``."""
    out = np.empty((len(starts), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(starts), band + 1, np.uint64)
        for r in range(ROWS):
            x = flat * _HASHES[band * ROWS + r]
            x ^= x >> np.uint64(32)
            key = key * PLACES[0] + np.minimum.reduceat(x, starts)
        out[:, band] = mix64(key)
    return out


def sent_keys(flat: np.ndarray, size: np.ndarray, send: np.ndarray) -> pa.Array:
    """Per unit the list of its keys as a paragraph, then as a sentence, where ``send`` (2 x units) says so; null without."""
    any_role = send.any(0)
    mine, sent = size[any_role], send[:, any_role]
    values = np.empty(BANDS * int(sent.sum()), np.uint64)
    if len(mine):
        rows = band_keys(flat[np.repeat(any_role, size)], np.cumsum(mine) - mine)
        at = BANDS * (np.cumsum(sent.sum(0)) - sent.sum(0))[:, None] + np.arange(BANDS)
        values[at[sent[0]]] = rows[sent[0]]
        values[(at + BANDS * sent[0][:, None])[sent[1]]] = mix64(rows[sent[1]] ^ PLACES[1])
    ends = np.append(0, np.cumsum(BANDS * send.sum(0)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)), mask=pa.array(~any_role))


def class_sets(spark: SparkSession, rows: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """(cls, tokens) of the classes in ``wanted``, from the texts."""
    wanted = stored(spark, wanted.select("cls").distinct(), "wanted")
    bits = bits_for(wanted)
    bitmap = spark.sparkContext.broadcast(marks(wanted, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = Paragraphs(least), set()
        for b in batches:
            for _, flat, size in own(x.as_py() for x in b.column(0)):
                cls, end, out = class_keys(flat, size), np.cumsum(size), []
                for i in np.flatnonzero(marked(bitmap.value, cls, bits)).tolist():
                    if (key := int(cls[i])) not in seen:
                        seen.add(key)
                        out.append((key, flat[end[i] - size[i]:end[i]].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([t for _, t in out], pa.binary())],
                                                 names=["cls", "tokens"])

    found = dealt(spark, rows.select("text").mapInArrow(run, "cls long, tokens binary"), "cls")
    return bucketed(spark, found.join(wanted, "cls", "left_semi").dropDuplicates(["cls"]), "sets", "cls")


def paragraph_removals(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                       least: int = MIN_WORDS) -> DataFrame:
    """Every paragraph (of ``least`` words or more) and sentence that occurs again, exactly or
    nearly: doc_id, paragraph (the number of its first stretch among the text's stretches),
    stretches (how many it spans), n_words, cluster_id (the cluster's smallest doc_id), removed
    (false for the one that stays)."""
    with scratch(spark):
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("text_key"),
                           F.col(text).cast("string").alias("text"))
        units = paragraph_units(spark, rows, least)
        matrix = shared_matrix(spark, units.where("keys is not null").select("cls", "n", "keys"))
        mins = matrix.groupBy("cls").agg(F.sort_array(F.collect_set("token")).alias("keys")).select(
            "cls", F.slice("keys", 1, MINS).alias("mins"))
        sets = class_sets(spark, rows, matrix, least)

        def fetch(wanted: DataFrame) -> DataFrame:
            return bucketed(spark, dealt(spark, sets.join(wanted.select("cls").distinct(), "cls", "left_semi"), "cls"), "fetched", "cls")

        found = cluster(spark, matrix, mins, fetch, prefixed=False)
        copies = units.groupBy("cls").agg(F.count("*").alias("copies"))
        again = copies.join(found, copies["cls"] == found["node"], "left").where("copies > 1 or component is not null").select(
            "cls", F.coalesce("component", "cls").alias("component"))
        rows = stored(spark, units.select("doc_id", "text_key", "paragraph", "stretches", "inside", "n_words", "cls").join(again, "cls").drop(
            "cls").withColumn("row", F.monotonically_increasing_id()), "found")
        # a sentence counts for nothing beside its own paragraph
        whole = rows.where("inside < 0")
        several = whole.where("stretches > 1").select("text_key", F.col("paragraph").alias("inside"), "component", "row")
        members = rows.join(several.drop("row"), ["text_key", "inside", "component"], "left_anti")
        order = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), "paragraph", "row"
        # which paragraphs go does not depend on sentences, as a paragraph stays before any sentence
        stays = whole.groupBy("component").agg(F.min(F.struct(*order)).alias("first")).select("component", "first.row")
        gone = several.join(stays, ["component", "row"], "left_anti").select("text_key", "inside", F.lit(True).alias("gone"))
        members = stored(spark, members.join(gone, ["text_key", "inside"], "left"), "members", kept=True)
    # the first member by an aggregate that combines before it shuffles
    first = members.groupBy("component").agg(
        F.min(F.struct(F.col("inside") >= 0, F.coalesce("gone", F.lit(False)), *order)).alias("first"),
        F.min("doc_id").alias("cluster_id"), F.count("*").alias("size")).where("size > 1")
    return members.join(first, "component").select(
        "doc_id", "paragraph", "stretches", "n_words", "cluster_id", (F.col("row") != F.col("first.row")).alias("removed"))
