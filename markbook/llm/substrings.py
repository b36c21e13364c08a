"""Operator 5: exact substring deduplication by prefix-free parsing.

Every byte covered by a ``WINDOW``-byte string that also starts at another place of the corpus
is removed.

Parsing.  A boundary lies behind every 8 bytes whose rolling hash falls below a threshold, so
equal strings are cut alike wherever they stand; the bytes between two boundaries are a phrase.
The window that starts at ``i`` belongs to the first boundary whose 8 trigger bytes it holds.
A window with a complete phrase that occurs nowhere else has no copy, which leaves few windows.

Order.  The remaining windows meet by the hash of their first complete phrase.  There, the bytes
left and right of every occurrence of the boundary stand in for the suffix arrays of a
dictionary and of a parse, which are not built; each side is sorted once with its longest
common prefixes.  The ranks hold within the bucket, and two windows are equal if neither order
separates them within the window.  So hundreds of windows share the two sorts of one boundary.
Windows without a complete phrase (about one in 400) and those of phrases met more than
``HOT`` times are counted by the hash of their bytes instead, which Spark splits at will.

Texts with equal bytes form a class (64-bit hash); a class of two or more texts of at least
``WINDOW`` bytes is removed whole, and one text stands for it in the search.

Cases: null text is empty; texts shorter than the window are left alone; matches never cross
texts; repeated rows are copies of each other; an empty table gives no rows; other columns are
not read (``strip_documents`` returns them as they are, whatever their names).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from markbook.llm.common import scratch, stored
from markbook.llm.jaccard import bits_for, marked, marks

WINDOW = 400
TRIGGER = 8
MEAN_PHRASE = 48
HOT = 20_000
BUCKET = 10_000  # boundaries per sorting task
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SPREAD, _HIGH = np.uint64(29), np.uint64(32)
_LIMIT = np.uint64((1 << 32) // MEAN_PHRASE)


def boundaries(data: bytes) -> np.ndarray:
    """Ends of all triggers, rising."""
    if len(data) < TRIGGER:
        return np.zeros(0, np.int64)
    x = np.ndarray((len(data) - TRIGGER + 1,), "<u8", data, 0, (1,)).copy()
    x ^= x >> _SPREAD
    x *= _MULTIPLY
    x >>= _HIGH
    return np.flatnonzero(x < _LIMIT) + TRIGGER


def phrase_hashes(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Hashes of the phrases between neighbouring boundaries."""
    at = ends.tolist()
    view = memoryview(data)
    return np.array([xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(at, at[1:], strict=False)], np.uint64).view(np.int64)


def first_windows(n: int, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The range of window starts that belong to each boundary and hold its whole trigger."""
    before = np.concatenate([[-(1 << 40)], ends[:-1]]) if len(ends) else ends
    low = np.maximum(np.maximum(before - TRIGGER + 1, 0), ends - window)
    return low, np.minimum(ends - TRIGGER, n - window)


def spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All integers of the ranges low..high."""
    size = np.maximum(high - low + 1, 0)
    return np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(size) else size


def plain_windows(n: int, ends: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that hold no complete phrase."""
    if n < window:
        return np.zeros(0, np.int64)
    low, high = first_windows(n, ends, window)
    after = np.concatenate([ends[1:], [1 << 40]]) if len(ends) else ends
    some = spread(low, np.minimum(high, after - window - 1))
    # no trigger at all: before the first boundary, between far boundaries, behind the last
    edges = np.concatenate([[-(1 << 40)], ends, [1 << 40]])
    none = spread(np.maximum(edges[:-1] - TRIGGER + 1, 0), np.minimum(edges[1:] - window - 1, n - window))
    return np.concatenate([some, none])


def kept_windows(n: int, ends: np.ndarray, again: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Boundaries (as indices) with their range of windows that hold complete phrases, all of
    which are marked in ``again`` as found elsewhere."""
    if n < window or len(ends) < 2:
        return (np.zeros(0, np.int64),) * 3
    low, high = first_windows(n, ends, window)
    low, high = low[:-1], high[:-1]
    low = np.maximum(low, ends[1:] - window)
    # the next phrase that is unique must not end inside the window
    unique = np.where(again, len(again), np.arange(len(again)))
    nearest = np.minimum.accumulate(unique[::-1])[::-1]
    stop = np.where(nearest < len(again), ends[np.minimum(nearest + 1, len(ends) - 1)], 1 << 40)
    high = np.minimum(high, stop - window - 1)
    at = np.flatnonzero(high >= low)
    return at, low[at], high[at]


def window_keys(data: bytes, starts: np.ndarray, window: int) -> list[int]:
    view = memoryview(data)
    return np.array([xxhash.xxh3_64_intdigest(view[i:i + window]) for i in starts.tolist()], np.uint64).view(np.int64)


def parse(docs: DataFrame, window: int) -> DataFrame:
    """Per row: doc_id, cls, n_bytes, sha256, and for the first text of a class in a task: the
    places of phrases that the task holds twice (``local``), the hashes and places of the
    others (``single``, ``place``), and the keys and starts of windows without a phrase.
    A last row without class carries one witness of every phrase the task holds twice, so a
    phrase sends at most one row from any task, however frequent it is."""
    schema = ("doc_id long, cls long, n_bytes long, sha256 string, local array<int>, single array<long>, "
              "place array<int>, plain array<long>, start array<int>")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()),
             pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, phrases, seen = [], [], set()
        for b in batches:
            for doc, cls, t in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                data = t.encode()
                row = [doc, cls, len(data), hashlib.sha256(data).hexdigest(), None, None, None, None, None]
                if len(data) >= window and cls not in seen:
                    seen.add(cls)
                    ends = boundaries(data)
                    plain = plain_windows(len(data), ends, window)
                    row[7], row[8] = window_keys(data, plain, window), plain.astype(np.int32)
                    phrases.append(phrase_hashes(data, ends))
                    row[4] = len(phrases) - 1
                rows.append(row)
        flat = np.concatenate(phrases) if phrases else np.zeros(0, np.int64)
        found, back, count = np.unique(flat, return_inverse=True, return_counts=True)
        twice = count[back] > 1
        cuts = np.cumsum([0, *map(len, phrases)])
        for row in rows:
            if row[4] is not None:
                k = row[4]
                two = twice[cuts[k]:cuts[k + 1]]
                row[4], row[6] = np.flatnonzero(two).astype(np.int32), np.flatnonzero(~two).astype(np.int32)
                row[5] = phrases[k][~two]
        rows.append([None, None, None, None, None, found[count > 1], None, None, None])
        for at in range(0, len(rows), 2000):
            cols = zip(*rows[at:at + 2000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return docs.mapInArrow(run, schema)


def candidate_texts(joined: DataFrame, window: int) -> DataFrame:
    """cls, text and phrase marks of the texts in which some window is still open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for t, marks, starts in zip(*(b.column(k) for k in (1, 2, 3)), strict=True):
                data, ok = t.as_py().encode(), starts.is_valid and len(starts) > 0
                if not ok:
                    ends = boundaries(data)
                    ok = len(kept_windows(len(data), ends, _marked(marks, len(ends)), window)[0]) > 0
                keep.append(ok)
            yield b.filter(pa.array(keep, pa.bool_()))

    return joined.select("cls", "text", "marks", "starts").mapInArrow(run, "cls long, text string, marks array<int>, starts array<int>")


def _marked(marks, n_ends: int) -> np.ndarray:
    again = np.zeros(max(n_ends - 1, 0), bool)
    if marks.is_valid and len(marks):
        again[marks.values.to_numpy()] = True
    return again


def contexts(cand: DataFrame, window: int, by_window: bool) -> DataFrame:
    """What each open boundary sees: (phrase, cls, at, low, high, left, right); or, by window,
    (phrase, cls, key, start) of every open window of the boundaries in ``hot``."""
    schema = ("phrase long, cls long, key long, start int" if by_window
              else "phrase long, cls long, at int, low int, high int, left binary, right binary")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for cls, t, marks, hot in zip(*(b.column(k) for k in range(4)), strict=True):
                data, cls = t.as_py().encode(), cls.as_py()
                ends = boundaries(data)
                at, low, high = kept_windows(len(data), ends, _marked(marks, len(ends)), window)
                if not len(at):
                    continue
                names_of = phrase_hashes(data, ends)
                cold = set(hot.as_py()) if hot.is_valid else set()
                for j, lo, hi in zip(at.tolist(), low.tolist(), high.tolist(), strict=True):
                    e, phrase = int(ends[j]), int(names_of[j])
                    if by_window and phrase in cold:
                        starts = np.arange(lo, hi + 1)
                        rows += [(phrase, cls, k, i) for k, i in zip(window_keys(data, starts, window).tolist(), starts.tolist(), strict=True)]
                    elif not by_window and phrase not in cold:
                        rows.append((phrase, cls, e, lo, hi, data[lo:e], data[e:hi + window]))
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows, strict=True), strict=True)), schema=arrow)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows, strict=True), strict=True)), schema=arrow)

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])
    return cand.select("cls", "text", "marks", "hot").mapInArrow(run, schema)


def sorted_prefixes(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings, and the longest common prefix of each with the one before."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    size = np.array([len(strings[i]) for i in order])
    width = int(size.max(initial=1)) + 1
    lcp = np.zeros(len(order), np.int64)
    for at in range(0, len(order), 4096):  # blocks keep the matrix small
        part = order[max(at - 1, 0):at + 4096]
        rows = np.frombuffer(b"".join(strings[i].ljust(width, b"\0") for i in part), np.uint8).reshape(-1, width)
        differ = rows[1:] != rows[:-1]
        first = np.where(differ.any(1), differ.argmax(1), width)
        lcp[max(at, 1):at + len(part) - (at > 0)] = first
    lcp[1:] = np.minimum(lcp[1:], np.minimum(size[1:], size[:-1]))
    return np.array(order), lcp


def equal_windows(pdf: pd.DataFrame, window: int) -> pd.DataFrame:
    """Ranges of window starts (cls, low, high) that have an equal window elsewhere, among
    the boundaries of one bucket."""
    at, low, high = (pdf[c].to_numpy(np.int64) for c in ("at", "low", "high"))
    left, left_lcp = sorted_prefixes([bytes(x)[::-1] for x in pdf["left"]])
    right, right_lcp = sorted_prefixes([bytes(x) for x in pdf["right"]])
    m = len(pdf)
    least, most = at - high, at - low  # bytes left of the boundary
    rank_left, rank_right = np.empty(m, np.int64), np.empty(m, np.int64)
    by_least = np.argsort(least, kind="stable")
    begin = np.searchsorted(least[by_least], np.arange(least.min(), most.max() + 2))
    live = np.zeros(0, np.int64)
    who, start = [], []
    first = int(least.min())
    for a in range(first, int(most.max()) + 1):
        came = by_least[(begin[a - first - 1] if a > first else 0):begin[a - first + 1]] if a > first else by_least[:begin[1]]
        live = np.concatenate([live, came[least[came] == a]])
        live = live[most[live] >= a]
        if len(live) < 2:
            continue
        rank_left[left] = np.cumsum(left_lcp < a)
        rank_right[right] = np.cumsum(right_lcp < window - a)
        key = rank_left[live] * (m + 1) + rank_right[live]
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        hit = live[count[back] > 1]
        who.append(hit)
        start.append(at[hit] - a)
    who = np.concatenate(who) if who else np.zeros(0, np.int64)
    start = np.concatenate(start) if start else np.zeros(0, np.int64)
    order = np.lexsort((start, who))
    who, start = who[order], start[order]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (start[1:] != start[:-1] + 1)
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(who) - 1]]) if len(who) else np.zeros(0, np.int64)
    return pd.DataFrame({"cls": pdf["cls"].to_numpy()[who[new]], "low": start[new], "high": start[last]})


def repeated_ranges(spark: SparkSession, docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The parsed rows, the candidate texts, and (cls, low, high) of all repeated windows.
    ``docs`` has doc_id, cls and text."""
    parsed = stored(spark, parse(docs, window), "parsed")
    singles = parsed.where("single is not null").select(
        "cls", F.posexplode("single").alias("k", "phrase"), "place").select("cls", "phrase", F.get("place", F.col("k")).alias("place"))
    met = singles.withColumn("n", F.count("*").over(Window.partitionBy("phrase"))).where("n > 1 and cls is not null")
    far = met.groupBy("cls").agg(F.collect_set("place").alias("far"))

    # windows without a phrase: the same key at two places
    plain = parsed.where("size(plain) > 0").select("cls", "plain", "start")
    each = plain.select("cls", F.explode(F.arrays_zip("plain", "start")).alias("z"))
    twice = stored(spark, repeated_keys(each.select("cls", F.col("z.plain").alias("key"), F.col("z.start").alias("start"))), "twice")
    plain_hits = stored(spark, key_hits(marked_windows(spark, plain, twice), twice), "plain_hits")
    starts = plain_hits.groupBy("cls").agg(F.collect_set("start").alias("starts"))

    local = parsed.where("size(local) > 0").select("cls", "local").dropDuplicates(["cls"])
    marks = far.join(local, "cls", "full").join(starts, "cls", "full").select(
        "cls", F.array_sort(F.array_union(F.coalesce("far", F.array().cast("array<int>")), F.coalesce("local", F.array().cast("array<int>")))).alias("marks"), "starts")
    member = parsed.where(f"n_bytes >= {window}").groupBy("cls").agg(F.min(F.coalesce("doc_id", F.lit(-1))).alias("member"))
    marks = marks.join(member, "cls")
    texts = docs.withColumn("member", F.coalesce("doc_id", F.lit(-1))).select("cls", "member", "text")
    cand = stored(spark, candidate_texts(texts.join(marks, ["cls", "member"]), window).dropDuplicates(["cls"]), "candidates")

    # phrases met too often for one task
    cold = cand.withColumn("hot", F.lit(None).cast("array<long>"))
    heat = contexts(cold, window, by_window=False).select("phrase", "cls")
    hot = stored(spark, heat.groupBy("phrase").agg(F.count("*").alias("n")), "heat")
    total = hot.agg(F.sum("n")).first()[0] or 0
    hot = hot.where(F.col("n") > HOT).select("phrase")
    found = plain_hits.select("cls", F.col("start").alias("low"), F.col("start").alias("high"))
    if not hot.isEmpty():
        holders = heat.join(hot, "phrase").groupBy("cls").agg(F.collect_set("phrase").alias("hot"))
        cold = stored(spark, cand.join(holders, "cls", "left"), "candidates_hot")
        windows = contexts(cold.where("hot is not null"), window, by_window=True).select("cls", "key", "start")
        found = found.union(key_hits(windows, repeated_keys(windows)).select("cls", "start", "start"))
    buckets = max(1, -(-total // BUCKET))
    opened = contexts(cold, window, by_window=False).withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))
    ranges = opened.groupBy("bucket").applyInPandas(lambda pdf: equal_windows(pdf, window), "cls long, low int, high int")
    return parsed, cand, found.union(ranges)


def repeated_keys(rows: DataFrame) -> DataFrame:
    """The keys of rows (cls, key, start) that are met at two places."""
    place = F.struct("cls", "start")
    return rows.groupBy("key").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("key")


def key_hits(rows: DataFrame, twice: DataFrame) -> DataFrame:
    """Places of the rows (cls, key, start) whose key is in ``twice``."""
    return rows.join(twice, "key").select("cls", "start").distinct()


def marked_windows(spark: SparkSession, plain: DataFrame, twice: DataFrame) -> DataFrame:
    """Rows (cls, key, start) of the windows (cls, keys, starts) whose keys share a bit with one in ``twice``: a bit map
    keeps most others out of the shuffle."""
    bits = bits_for(twice)
    bitmap = spark.sparkContext.broadcast(marks(twice, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys = b.column(1).flatten().to_numpy()
                keep = pa.array(np.flatnonzero(marked(bitmap.value, keys, bits)))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pc.list_parent_indices(b.column(1)).take(keep)), pa.array(keys).take(keep),
                                                  b.column(2).flatten().take(keep)], names=["cls", "key", "start"])

    return plain.mapInArrow(run, "cls long, key long, start int")


def strip(data: bytes, low: np.ndarray, high: np.ndarray, window: int) -> tuple[bytes, int, int]:
    """Remaining bytes, removed bytes and maximal removed runs."""
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, low, 1)
    np.add.at(edge, high + window, -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def _rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(t).alias("cls"), t.alias("text"))


def _edits(spark: SparkSession, docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """The parsed rows, and per class with removed bytes: n_removed, n_spans, kept_sha256, kept."""
    with scratch(spark):
        parsed, cand, ranges = repeated_ranges(spark, docs, window)
        per = ranges.groupBy("cls").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
        per = per.select("cls", F.col("ranges.low").alias("low"), F.col("ranges.high").alias("high"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                removed, spans, sha, kept = [], [], [], []
                for t, low, high in zip(*(b.column(k) for k in (1, 2, 3)), strict=True):
                    left, n, runs = strip(t.as_py().encode(), low.values.to_numpy(), high.values.to_numpy(), window)
                    removed.append(n)
                    spans.append(runs)
                    sha.append(hashlib.sha256(left).hexdigest())
                    kept.append(left.decode("utf-8", "ignore"))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                                                  pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                                                 names=["cls", "n_removed", "n_spans", "kept_sha256", "kept"])

        edits = cand.select("cls", "text").join(per, "cls").select("cls", "text", "low", "high").mapInArrow(
            run, "cls long, n_removed long, n_spans long, kept_sha256 string, kept string")
        rows = parsed.where("cls is not null").select("doc_id", "cls", "n_bytes", "sha256")
        return stored(spark, rows, "rows", kept=True), stored(spark, edits, "edits", kept=True)


def dedup_substrings(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                     window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    parsed, edits = _edits(spark, _rows(docs, id_col, text), window)
    copies = parsed.groupBy("cls").agg(F.count("*").alias("copies"))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= window)
    nothing = hashlib.sha256(b"").hexdigest()
    out = parsed.select("doc_id", "cls", "n_bytes", "sha256").join(copies, "cls").join(edits.drop("kept"), "cls", "left")
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"))


def strip_documents(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                    window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; a character that loses some of
    its bytes goes whole.  All rows and columns stay."""
    rows = _rows(docs, id_col, text)
    parsed, edits = _edits(spark, rows, window)
    full = parsed.where(f"n_bytes >= {window}").groupBy("cls").agg(F.count("*").alias("copies")).where("copies > 1")
    new = edits.select("cls", "kept").join(full, "cls", "full").select(
        F.col("cls").alias("__cls"), F.when(F.col("copies").isNotNull(), F.lit("")).otherwise(F.col("kept")).alias("__kept"))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                      F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("__cls"))
    joined = own.join(new, "__cls", "left")
    return joined.select(*[F.when(F.col("__kept").isNotNull(), F.col("__kept")).otherwise(F.col("__row")[c]).alias(c)
                           if c == text else F.col("__row")[c].alias(c) for c in docs.columns])
