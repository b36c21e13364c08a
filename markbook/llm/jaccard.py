"""Operator 4: exact n-gram Jaccard join by a token-group matrix.

Texts with equal shingle sets form one class, and classes stand for their copies from then
on.  Classes that share their commonest token and are about as large are kept in groups of about
``CHUNK``, whatever their components; the matrix holds, per token, the groups whose union has it, so
a passage in k texts is met k times k / ``CHUNK`` times, not k times k.  A class asks the matrix with its
tokens; the number that it shares with a group's union bounds its overlap with every member, and only
groups within the bound are opened, where one sorted pass counts the tokens common to askers and members.

* Prefixes: of an n-set, the n - ceil(0.75 n) + 1 rarest tokens.  Similarity 0.75 of an n-set and
  an m-set takes an overlap of a = ceil(3 (n + m) / 7), so they share a token that is among the
  n - a + 1 rarest of the one and the m - a + 1 rarest of the other; and if they share c prefix
  tokens, their overlap is at most c + ceil(0.75 N) - 1 with N the larger size, which must reach a.
* Rarest first: tokens are ordered by a count over all texts in ``2 ** SKETCH_BITS`` buckets (a
  fixed 4 MB), then by hash.  Any order gives exact results; this one keeps passages that many
  texts share out of the prefixes.
* Families first shrink: classes that share a minimum hash link in chunks of about ``CHUNK``, for each
  of ``MINS`` hashes, and what outgrows a chunk again while a round still merges more than one in ``WORTH`` of it.  What is then in
  one component is never compared again, so a family of near copies costs its size, not its square.  The
  matrix pass that follows is complete: every link between two components is found there.
* Sets are fetched by reading the texts again, for the classes that need them only.  The wanted
  rows are marked in a bit map of at most ``2 ** MARK_BITS`` bits, so no text is shuffled.

Cases: null, empty and blank texts have the empty set, link with nothing and are their own
component; fewer than five words are one shingle; copies and repeated rows share a class; a
null id stays null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markbook.llm.common import bucketed, components, dealt, hash_words, keep_rows, mix64, row_key, scratch, stored

WORDS = 5
SIMILAR = 75  # per cent
SKETCH_BITS = 20
BLOCKS = 64
CHUNK = 64
ASKERS = 256  # that one task compares with a group at a time
ROOM = 1 << 21  # tokens of a group, or of its askers, in one task (or one set, if that is larger)
TOGETHER_BYTES = 1 << 18  # of texts whose words are hashed together
TOGETHER = 1024  # rows of small groups that are worked on in one call
BAND = 1.15  # sizes of one group: within about this factor
COLUMNS = 1 << 14  # tokens counted at a time
WORTH = 50
MINS = 3
MARK_BITS = 26
# odd multipliers, one per place of a shingle
PLACES = mix64(np.arange(1, WORDS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text; the words of about ``TOGETHER_BYTES`` are hashed in one pass."""
    held, size = [], 0
    for t in texts:
        held.append((t or "").encode())
        size += len(held[-1])
        if size >= TOGETHER_BYTES:
            yield from _sets_of(held)
            held, size = [], 0
    yield from _sets_of(held)


def _sets_of(texts: list[bytes]) -> Iterator[np.ndarray]:
    starts, words = hash_words(b"\n".join(texts).lower())
    ends = np.cumsum([len(t) + 1 for t in texts])
    cuts = [0, *np.searchsorted(starts, ends).tolist()]
    total = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        total += words[k:k + len(total)] * PLACES[k]
    total = mix64(total)
    for a, b in zip(cuts, cuts[1:], strict=False):
        n = b - a
        if n < WORDS:  # one shingle of all words
            few = (words[a:b] * PLACES[:n]).sum(keepdims=True, dtype=np.uint64)
            yield mix64(few + np.uint64(n))[:n]
            continue
        s = np.sort(total[a:b - WORDS + 1])
        yield s[np.append(True, s[1:] != s[:-1])]


def set_key(s: np.ndarray) -> int:
    """64-bit key of a set, as a signed integer."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes()))))


def least_overlap(n):
    """The least number of an n-set's tokens that any set similar to it shares."""
    return -(-SIMILAR * n // 100)


def _plain(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       row_key(id_col, text).alias("row_key"))


def token_counts(rows: DataFrame) -> np.ndarray:
    """Number of (text, token) pairs by the token's high bits, over all texts."""
    width = 1 << SKETCH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(width, np.int64), [], 0
        for b in batches:
            for s in shingle_sets(t.as_py() for t in b.column(1)):
                held.append((s >> np.uint64(64 - SKETCH_BITS)).astype(np.int32))
                size += len(held[-1])
                if size > 4 * width:
                    total += np.bincount(np.concatenate(held), minlength=width)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=width)
        parts = np.split(total.astype(np.uint32), BLOCKS)
        yield pa.RecordBatch.from_pydict({"block": pa.array(range(BLOCKS), pa.int32()),
                                          "counts": pa.array([p.tobytes() for p in parts], pa.binary())})

    part = rows.mapInArrow(count, "block int, counts binary")
    # a block's parts are added in two steps, so that no task holds a part of every task
    part = part.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    once = part.groupBy("block", "salt").applyInPandas(add32, "block int, counts binary")
    done = once.groupBy("block").applyInPandas(add64, "block int, counts binary").collect()
    out = np.zeros(width, np.uint64)
    for r in done:
        out[r["block"] * (width // BLOCKS):(r["block"] + 1) * (width // BLOCKS)] = np.frombuffer(r["counts"], np.uint64)
    return out


def _sum(pdf: pd.DataFrame, kind) -> pd.DataFrame:
    total = np.zeros((1 << SKETCH_BITS) // BLOCKS, np.uint64)
    for c in pdf["counts"]:
        total += np.frombuffer(c, kind).astype(np.uint64)
    return pd.DataFrame({"block": pdf["block"].iloc[:1].tolist(), "counts": [total.tobytes()]})


def add32(pdf: pd.DataFrame) -> pd.DataFrame:
    return _sum(pdf, np.uint32)


def add64(pdf: pd.DataFrame) -> pd.DataFrame:
    return _sum(pdf, np.uint64)


def prefixes(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """doc_id, row_key, n, cls, and for the first text of a class in a task ``prefix``, the tokens
    by which the class is looked up, and ``mins``, its minimum hashes."""
    level = (2 * np.log2(token_counts(rows) + 1.0)).astype(np.uint8)
    shared = spark.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = shared.value, set()
        for b in batches:
            n, cls, prefix, mins = [], [], [], []
            for s in shingle_sets(t.as_py() for t in b.column(1)):
                key = set_key(s)
                n.append(len(s))
                cls.append(key)
                if key in seen or not len(s):
                    prefix.append(None)
                    mins.append(None)
                    continue
                seen.add(key)
                order = np.argsort(level[s >> np.uint64(64 - SKETCH_BITS)], kind="stable")
                prefix.append(s[order[:len(s) - least_overlap(len(s)) + 1]].view(np.int64))
                mins.append([int(mix64(s * PLACES[k]).min().view(np.int64)) for k in range(MINS)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(cls, pa.int64()),
                 pa.array(prefix, pa.list_(pa.int64())), pa.array(mins, pa.list_(pa.int64()))],
                names=["doc_id", "row_key", "n", "cls", "prefix", "mins"])

    return stored(spark, rows.mapInArrow(run, "doc_id long, row_key long, n long, cls long, prefix array<long>, mins array<long>"), "prefixes")


def marks(keys: DataFrame, bits: int) -> np.ndarray:
    """Bit map of the keys (one long column), built by aggregation."""
    place = F.pmod(F.col(keys.columns[0]), F.lit(1 << bits))
    rows = keys.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("p"))
    out = np.zeros(((1 << bits) // 32768 + 2, 4096), np.uint8)
    for r in rows.groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).toLocalIterator():
        out[r["b"]] = np.frombuffer(r["m"], np.uint8)
    return out


def marked(bitmap: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Whether each key is (or shares a bit with one) in the bit map; Spark's buckets start at 1
    and hold the places 1 to 32768 of the numbers that follow."""
    place = keys & ((1 << bits) - 1)
    bucket, bit = np.where(place > 0, 1 + (place - 1) // 32768, 0), np.where(place > 0, (place - 1) % 32768, 0)
    return (bitmap[bucket, bit // 8] >> (bit % 8).astype(np.uint8)) & 1 == 1


def token_sets(spark: SparkSession, rows: DataFrame, base: DataFrame, wanted: DataFrame) -> DataFrame:
    """cls and its tokens (sorted, 8 bytes each) for the classes in ``wanted``."""
    wanted = wanted.select("cls").distinct()
    keys = stored(spark, base.where("n > 0").groupBy("cls").agg(F.min("row_key").alias("row_key")).join(wanted, "cls", "left_semi").select(
        "row_key"), "wanted")
    bits = min(MARK_BITS, max(15, (16 * keys.count()).bit_length()))
    shared = spark.sparkContext.broadcast(marks(keys, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            cls, tokens = [], []
            listed = np.flatnonzero(marked(shared.value, b.column(1).to_numpy(), bits)).tolist()
            for s in shingle_sets(b.column(0)[i].as_py() for i in listed):
                key = set_key(s)
                if key not in seen:
                    seen.add(key)
                    cls.append(key)
                    tokens.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(tokens, pa.binary())], names=["cls", "tokens"])

    found = dealt(spark, rows.select("text", "row_key").mapInArrow(run, "cls long, tokens binary"), "cls")
    return bucketed(spark, found.join(wanted, "cls", "left_semi").dropDuplicates(["cls"]), "sets", "cls")


def overlaps(a: list[np.ndarray], b: list[np.ndarray] | None = None) -> np.ndarray:
    """How many tokens each set of ``a`` shares with each set of ``b`` (of ``a`` itself by default): one
    sorted pass finds the tokens met twice or more, which are counted ``COLUMNS`` at a time."""
    sets = a if b is None else a + b
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(flat := np.concatenate(sets), kind="stable")
    flat, owner = flat[order], owner[order]
    fresh = np.append(True, flat[1:] != flat[:-1])
    often = ~(fresh & np.append(fresh[1:], True))
    owner, place = owner[often], np.cumsum(fresh[often]) - 1
    total = np.zeros((len(a), len(a if b is None else b)), np.int64)
    places = int(place[-1]) + 1 if len(place) else 0
    for at in range(0, places, COLUMNS):
        lo, hi = np.searchsorted(place, (at, at + COLUMNS))
        held = np.zeros((len(sets), min(COLUMNS, places - at)), np.float32)
        held[owner[lo:hi], place[lo:hi] - at] = 1
        total += (held[:len(a)] @ held[-total.shape[1]:].T).astype(np.int64)
    if b is None:  # a set's own tokens need no second holder
        np.fill_diagonal(total, [len(x) for x in a])
    return total


def similar_sets(a: list[np.ndarray], b: list[np.ndarray] | None = None) -> np.ndarray:
    """Whether each set of ``a`` is similar to each set of ``b`` (of ``a`` itself by default)."""
    both = overlaps(a, b)
    sizes = [np.array([len(x) for x in sets], np.int64) for sets in (a, a if b is None else b)]
    return (both > 0) & (100 * both >= SIMILAR * (sizes[0][:, None] + sizes[1] - both))


def joined_components(comp: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """The component of every member of one chunk (by rising component), links inside the chunk applied."""
    near = similar_sets(sets)
    np.fill_diagonal(near, True)
    label, last = np.arange(len(sets)), None
    while last is None or (label != last).any():
        last, label = label, np.where(near, label, len(sets)).min(1)
    return comp[label]


def runs_of(pdf: pd.DataFrame, *names: str) -> Iterator[tuple[tuple, slice]]:
    """The key and the rows of every group of a table that is sorted by the key's columns."""
    keys = [pdf[c].to_numpy() for c in names]
    fresh = np.ones(len(pdf), bool)
    if len(pdf):
        fresh[1:] = np.any([k[1:] != k[:-1] for k in keys], 0)
    cuts = [*np.flatnonzero(fresh).tolist(), len(pdf)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield tuple(int(k[a]) for k in keys), slice(a, b)


def link_chunks(pdf: pd.DataFrame) -> pd.DataFrame:
    """The components that the chunks (m, sub) of one bucket change."""
    pdf = pdf.sort_values(["m", "sub", "comp"], kind="stable")
    comp, tokens = pdf["comp"].to_numpy(), [np.frombuffer(t, np.uint64) for t in pdf["tokens"]]
    joined = comp.copy()
    for _, at in runs_of(pdf, "m", "sub"):
        joined[at] = joined_components(comp[at], tokens[at])
    moved = comp != joined
    return pd.DataFrame({"comp": comp[moved], "joined": joined[moved]})


def links(comp: np.ndarray, tokens: list[bytes], member: np.ndarray, held: list[bytes]) -> np.ndarray:
    """The pairs of different components whose sets are similar, one of ``comp`` and one of ``member``."""
    near = similar_sets(*([np.frombuffer(t, np.uint64) for t in side] for side in (tokens, held)))
    i, j = np.nonzero(near & (comp[:, None] != member))
    return np.stack([comp[i], member[j]], 1)


def edge_table(found: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame(np.concatenate([np.zeros((0, 2), np.int64), *found]), columns=["a", "b"]).drop_duplicates()


def open_group(askers: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
    """The components that an opened group's members link to those of its askers."""
    if not len(askers) or not len(members):
        return edge_table([])
    return edge_table([links(askers["comp"].to_numpy(), askers["tokens"].tolist(), members["member"].to_numpy(), members["held"].tolist())])


def open_groups(askers: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
    """The same for all opened groups (grp, part) of one bucket; members hold theirs as (of, at)."""
    askers, members = askers.sort_values(["grp", "part"], kind="stable"), members.sort_values(["of", "at"], kind="stable")
    place = dict(runs_of(members, "of", "at"))
    comp, tokens, member, held = askers["comp"].to_numpy(), askers["tokens"].tolist(), members["member"].to_numpy(), members["held"].tolist()
    return edge_table([links(comp[own], tokens[own], member[place[key]], held[place[key]])
                       for key, own in runs_of(askers, "grp", "part") if key in place])


def family_edges(pdf: pd.DataFrame) -> pd.DataFrame:
    """The components that the chunks (grp) of one bucket link."""
    pdf = pdf.sort_values("grp", kind="stable")
    comp, tokens = pdf["comp"].to_numpy(), pdf["tokens"].tolist()
    found = edge_table([links(comp[at], tokens[at], comp[at], tokens[at]) for _, at in runs_of(pdf, "grp")])
    return found[found["a"] > found["b"]]


def overlap(n: Column, m: Column) -> Column:
    """The overlap that an n-set and an m-set need."""
    return F.ceil(3 * (n + m) / 7)


def _compatible(a: Column, low: Column, high: Column) -> Column:
    return (100 * a >= SIMILAR * low) & (100 * high >= SIMILAR * a)


def parts_of(count: Column, tokens: Column, most: int) -> Column:
    """Into how many parts rows are dealt, of about ``most`` rows and ``ROOM`` tokens each."""
    return F.ceil(F.greatest(count / most, tokens / ROOM)).cast("long")


def bits_for(keys: DataFrame) -> int:
    return min(MARK_BITS, max(15, (16 * keys.count()).bit_length()))


def buckets(rows: int, tokens: int) -> int:
    """Into how many buckets groups are dealt, of about ``TOGETHER`` rows or ``ROOM`` tokens each."""
    return max(1, -(-rows // TOGETHER), -(-tokens // ROOM))


def shared_matrix(spark: SparkSession, sent: DataFrame) -> DataFrame:
    """(token, cls, n, pos) of the tokens that at least two classes have; ``sent`` holds (cls, n, the list of
    tokens), and ``pos`` is the token's place in the list.  A bit map of the shared tokens leaves the others out before
    rows are shuffled."""
    sent = sent.toDF("cls", "n", "tokens")
    shared = stored(spark, sent.select("cls", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("token"), "shared")
    bits = bits_for(shared)
    bitmap = spark.sparkContext.broadcast(marks(shared, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                tokens, owner = b.column(2).flatten().to_numpy(), pc.list_parent_indices(b.column(2)).to_numpy()
                keep = np.flatnonzero(marked(bitmap.value, tokens, bits))
                own = pa.array(owner[keep])
                pos = (keep - np.searchsorted(owner, owner[keep])).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(tokens[keep]), b.column(0).take(own), b.column(1).take(own), pa.array(pos)],
                                                 names=["token", "cls", "n", "pos"])

    keyed = sent.mapInArrow(run, "token long, cls long, n long, pos int")
    return stored(spark, keyed.join(shared, "token").groupBy("token", "cls").agg(F.max("n").alias("n"), F.max("pos").alias("pos")), "matrix")


def link_groups(spark: SparkSession, mins: DataFrame, sets: DataFrame) -> DataFrame:
    """(cls, comp) after linking inside groups; ``mins`` holds (cls, r, m), the shared minimum
    hashes.  Groups that outgrow a chunk are dealt again with the components that their
    chunks have made, as long as that merges more than one in ``WORTH`` of theirs."""
    comp = stored(spark, sets.select("cls", F.col("cls").alias("comp"), F.expr("length(tokens) div 8").alias("n")), "comp")
    for r in range(MINS):
        own = mins.where(F.col("r") == r).select("cls", "m")
        while True:
            lead = own.join(comp, "cls").groupBy("comp").agg(F.min(F.struct("m", "cls", "n")).alias("x")).select("comp", "x.*")
            size = lead.groupBy("m").agg(F.count("*").alias("size")).where("size > 1")
            lead = stored(spark, lead.join(size, "m").withColumn("sub", F.pmod(F.xxhash64("cls"), F.ceil(F.col("size") / CHUNK))), "lead")
            most, leads, tokens = lead.agg(F.max("size"), F.count("*"), F.sum("n")).first()
            if most is None:
                break
            bucket = F.pmod(F.xxhash64("m", "sub"), F.lit(buckets(leads, tokens))).alias("bucket")
            merged = lead.join(sets, "cls").select(bucket, "m", "sub", "comp", "tokens").groupBy("bucket").applyInPandas(
                link_chunks, "comp long, joined long")
            merged = stored(spark, merged, "merged")
            comp = stored(spark, comp.join(merged, "comp", "left").select("cls", F.coalesce("joined", "comp").alias("comp"), "n"), "comp")
            if most <= CHUNK or merged.count() * WORTH <= leads:
                break
            # the others were compared as a whole
            own = own.join(lead.where(F.col("size") > CHUNK).select("m").distinct(), "m", "left_semi")
    return link_families(spark, mins, sets, comp)


def link_families(spark: SparkSession, mins: DataFrame, sets: DataFrame, comp: DataFrame) -> DataFrame:
    """(cls, comp) after one more round over the minimum hashes of more than ``CHUNK`` classes: their chunks hold any
    classes, not one of a component, so that the large components of a family meet by many members at once."""
    rows = mins.join(comp, "cls")
    size = rows.groupBy("r", "m").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where(
        (F.col("size") > CHUNK) & (F.col("lo") < F.col("hi"))).select("r", "m", "size")
    rows = stored(spark, rows.join(size, ["r", "m"]).select(
        "cls", "comp", "n", F.xxhash64("r", "m", F.pmod(F.xxhash64("cls", "r"), F.ceil(F.col("size") / CHUNK))).alias("grp")), "families")
    count, tokens = rows.agg(F.count("*"), F.sum("n")).first()
    if not count:
        return comp.select("cls", "comp")
    bucket = F.pmod(F.xxhash64("grp"), F.lit(buckets(count, tokens))).alias("bucket")
    edges = rows.join(sets, "cls").select(bucket, "grp", "comp", "tokens").groupBy("bucket").applyInPandas(family_edges, "a long, b long")
    found = components(spark, edges.distinct(), "families")
    return stored(spark, comp.join(found, comp["comp"] == found["node"], "left").select("cls", F.coalesce("component", "comp").alias("comp")), "comp")


def cluster(spark: SparkSession, matrix: DataFrame, mins: DataFrame, fetch: Callable[[DataFrame], DataFrame],
            prefixed: bool = True) -> DataFrame:
    """(node, component) of all classes that link to another one.  ``mins``: (cls, mins) of every
    class; ``fetch`` returns the stored (cls, tokens) of the classes it is given; ``prefixed``: the
    matrix holds prefixes, whose places and counts bound overlaps."""
    listed = mins.select("cls", F.posexplode("mins").alias("r", "m"))
    twice = listed.groupBy("r", "m").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("r", "m")
    listed = stored(spark, listed.join(twice, ["r", "m"]).distinct(), "mins")
    grouped = link_groups(spark, listed, fetch(listed))

    # the matrix between components
    weight = grouped.groupBy("comp").agg(F.count("*").alias("weight")).where("weight > 1")
    grouped = stored(spark, grouped.join(weight, "comp", "left").select("cls", "comp", F.coalesce("weight", F.lit(1)).alias("weight")), "grouped")
    labelled = stored(spark, matrix.join(grouped, "cls", "left").select(
        "token", "cls", "n", "pos", F.coalesce("comp", "cls").alias("comp"), F.coalesce("weight", F.lit(1)).alias("weight")), "labelled")
    bridge = labelled.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("held")).where("lo <> hi")
    open_rows = bucketed(spark, dealt(spark, labelled.join(bridge.select("token", "held"), "token"), "cls"), "open", "cls")

    # groups of similar classes: the commonest token and about the same size
    key = open_rows.groupBy("cls").agg(F.max(F.struct("held", "token")).alias("x"), *[F.max(c).alias(c) for c in ("n", "comp")]).select(
        "cls", "n", "comp", F.col("x.token").alias("g"), F.floor(F.log("n") / float(np.log(BAND))).alias("band"))
    size = key.groupBy("g", "band").agg(parts_of(F.count("*"), F.sum("n"), CHUNK).alias("parts"))
    groups = stored(spark, key.join(size, ["g", "band"]).select(
        "cls", "n", "comp", F.xxhash64("g", "band", F.pmod(F.xxhash64("cls"), "parts")).alias("grp")), "groups")
    # of two components the smaller one asks, so a group is asked by who stands below its highest member
    stand = F.struct("weight", F.bitwise_not("comp"))
    by_group = stored(spark, open_rows.join(groups.select("cls", "grp"), "cls").groupBy("token", "grp").agg(
        F.min("pos").alias("first"), F.min("n").alias("low"), F.max("n").alias("high"), F.max(stand).alias("top")), "unions")
    asked = open_rows.select("token", "cls", "n", "pos", stand.alias("stand"))
    n, low, high = F.col("n"), F.col("low"), F.col("high")
    fits = (F.col("stand") < F.col("top")) & _compatible(n, low, high)
    if not prefixed:
        opened = asked.join(by_group, "token").where(fits).select("cls", "grp").distinct()
    else:
        # the shared token must be early in both orders, whichever member it is
        early = (F.col("pos") <= n - overlap(n, low)) & (F.col("first") <= high - overlap(n, high))
        hits = asked.join(by_group, "token").where(fits & early).select("cls", "grp").distinct()
        met = hits.join(open_rows.select("token", "cls", "n"), "cls").join(by_group.select("token", "grp", "low", "high"), ["grp", "token"])
        met = met.groupBy("cls", "grp").agg(F.count("*").alias("c"), F.max("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))

        def least(m: Column) -> Column:
            """Tokens that prefixes of an n-set and a similar m-set share at least; it grows with m up to n and
            falls beyond, there within one because of the rounding."""
            return overlap(n, m) - F.ceil(SIMILAR * F.greatest(n, m) / 100) + 1

        bound = F.least(F.when(low <= n, least(low)), F.when(high > n, least(high) - 1))
        opened = met.where(F.col("c") >= bound).select("cls", "grp")
    opened = stored(spark, opened, "opened")
    members = groups.join(opened.select("grp").distinct(), "grp", "left_semi").select("grp", "cls", "comp")
    sets = fetch(opened.select("cls").union(members.select("cls")))
    # askers are dealt into parts, and a group goes to each part of its askers
    askers = opened.join(groups.select("cls", "n", "comp"), "cls")
    parts = askers.groupBy("grp").agg(parts_of(F.count("*"), F.sum("n"), ASKERS).alias("parts"), F.count("*").alias("rows"), F.sum("n").alias("tokens"))
    held = members.join(groups.select("cls", "n"), "cls").groupBy("grp").agg(F.count("*").alias("held_rows"), F.sum("n").alias("held_tokens"))
    parts = stored(spark, parts.join(held, "grp"), "parts")
    rows, tokens = parts.agg(F.sum(F.expr("rows + parts * held_rows")), F.sum(F.expr("tokens + parts * held_tokens"))).first()
    parts = parts.select("grp", "parts")
    askers = askers.join(parts, "grp").join(sets, "cls").select("grp", F.pmod(F.xxhash64("cls"), "parts").alias("part"), "comp", "tokens")
    members = members.join(parts, "grp").join(sets, "cls").select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "comp", "tokens")
    bucket = F.pmod(F.xxhash64("grp", "part"), F.lit(buckets(rows or 0, tokens or 0)))
    askers, members = askers.withColumn("bucket", bucket), members.withColumn("bucket", bucket).toDF("of", "at", "member", "held", "bucket")
    found = askers.groupBy("bucket").cogroup(members.groupBy("bucket")).applyInPandas(open_groups, "a long, b long")
    edges = grouped.select(F.col("cls").alias("a"), F.col("comp").alias("b")).where("a <> b").union(found.distinct())
    return components(spark, edges, "edges")


def jaccard_components(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable by
    links, itself included), and row_key and component (the component's own key, null for the
    empty set)."""
    with scratch(spark):
        rows = _plain(docs, id_col, text)
        base = prefixes(spark, rows)
        matrix = shared_matrix(spark, base.where("prefix is not null").select("cls", "n", "prefix"))
        # a minimum hash counts together with the size, whose limits differ from hash to hash: texts that share a passage only fall apart
        width = F.log("n") / float(np.log(100 / SIMILAR))
        mins = base.where("mins is not null").select(
            "cls", F.transform("mins", lambda m, r: F.xxhash64(m, F.floor(width + r / max(MINS, 1)))).alias("mins"))
        found = cluster(spark, matrix, mins, lambda wanted: token_sets(spark, rows, base, wanted))
        member = base.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))

        labels = member.join(found, member["cls"] == found["node"], "left").select(
            "cls", "doc_id", F.coalesce("component", "cls").alias("component"))
        first = labels.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        labels = labels.join(first, "component").select(F.col("cls").alias("key"), "component", "component_id")
        out = base.select("doc_id", "row_key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("cls")).alias("key"))
        out = out.join(labels, "key", "left").select(
            "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "row_key", "component")
        return stored(spark, out, "components", kept=True)


def one_of_each(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every component: that of the smallest doc_id, repeated rows
    once.  Rows with the empty set link with nothing and stay."""
    found = jaccard_components(spark, docs, id_col, text)
    first = found.where("component is not null").groupBy("component").agg(F.min(F.struct("doc_id", "row_key")).alias("first"))
    keys = found.where("component is null").select("row_key").union(first.select("first.row_key"))
    kept = keep_rows(docs, keys, id_col, text)
    # only exact repeats of a kept row are left to drop
    again = found.where("component is not null").groupBy("row_key").agg(F.count("*").alias("n")).where("n > 1").select("row_key")
    own = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("__row"), row_key(id_col, text).alias("row_key"))
    twice = own.join(again, "row_key", "left_semi").dropDuplicates(["row_key"])
    return own.join(again, "row_key", "left_anti").union(twice).select("__row.*")
