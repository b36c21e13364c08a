"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markbook.session import ensure_checkpoint_dir

#: Words of a text, in UTF-8 bytes; ``bytes.split()`` splits at exactly these six characters.
WORD_SPLIT = r"[\x20\x09-\x0D]+"


_open: list[str] = []  # folders of the scratch blocks that the driver is in
_tables: list[str] = []  # names of the bucketed tables of all scratch blocks


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(spark: SparkSession, df: DataFrame, name: str, kept: bool = False, by: str | None = None) -> DataFrame:
    """``df`` written once as Parquet under the cluster's shared ``spark.checkpoint.dir``
    and read back: lineage is cut, lost executors lose nothing, and the optimizer sees
    the real size.  Inside a :func:`scratch` block the table goes with the block, unless it is
    ``kept``; kept tables stay until the folder's owner clears them.  ``by``: one folder per value of
    that (last) column."""
    outer = _open[:-1] if kept else _open
    path = f"{outer[-1] if outer else _folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(spark: SparkSession, df: DataFrame, key: str) -> DataFrame:
    """``df`` in one partition per bucket of :func:`bucketed`."""
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)


def bucketed(spark: SparkSession, df: DataFrame, name: str, key: str) -> DataFrame:
    """Like :func:`stored` inside a :func:`scratch` block, as a table bucketed by ``key``, so that later joins by it
    shuffle the other side only; ``df`` is :func:`dealt` by it."""
    table = f"{name}_{uuid.uuid4().hex}"
    _tables.append(table)
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", f"{_open[-1]}/{table}").saveAsTable(table)
    return spark.table(table)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside the block are deleted at its end."""
    _open.append(_folder(spark))
    before = len(_tables)
    try:
        yield
    finally:
        while len(_tables) > before:
            spark.sql(f"DROP TABLE IF EXISTS `{_tables.pop()}`")
        path = spark._jvm.org.apache.hadoop.fs.Path(_open.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key(id_col: str, text: str) -> Column:
    """64-bit key of a row's id and text; repeated rows share it."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text).cast("string"))


def keep_rows(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, columns and all, whose key is in ``keys`` (one column)."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), row_key(id_col, text).alias("__key"))
    return own.join(keys.toDF("__key").distinct(), "__key", "left_semi").select("__row.*")


class Memo(dict):
    """word -> bytes, kept per Python worker and bounded: :meth:`room` empties it once it
    holds ``most`` entries, which costs time and never changes a result."""

    def __init__(self, most: int = 800_000):
        super().__init__()
        self.most = most

    def missing(self, words: Iterable) -> list:
        """The words without an entry (a set's own difference would run through all entries)."""
        return [w for w in words if w not in self]

    def room(self, n: int) -> bool:
        """Call before ``n`` entries are added; says whether the others had to go."""
        if len(self) + n <= self.most:
            return False
        self.clear()
        return True


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (murmur finalizer)."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x = x ^ (x >> _S33)
    x = x * _M2
    return x ^ (x >> _S33)


#: Bytes that part words, the six of :data:`WORD_SPLIT`.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUES = np.where(SPACE, np.uint64(0), mix64(np.arange(5000, 5256, dtype=np.uint64)))
_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_HASHED = 1 << 17  # bytes hashed together, or one word


def _powers(n: int) -> tuple[np.ndarray, ...]:
    return tuple(np.multiply.accumulate(np.append(np.uint64(1), np.full(n, x))) for x in (_BASE, _INVERSE))


_POWERS = _powers(_HASHED)


def hash_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of a lower-cased text starts, and a 64-bit hash of the word (a polynomial of its bytes, mixed)."""
    data = np.frombuffer(text, np.uint8)
    space = SPACE[data]
    start = ~space
    start[1:] &= space[:-1]
    starts = np.flatnonzero(start)
    out, at = np.zeros(len(starts), np.uint64), 0
    power, back = _POWERS
    while at < len(starts):
        lo = int(starts[at])
        end = max(at + 1, int(np.searchsorted(starts, lo + _HASHED, side="right")) - 1)
        hi = int(starts[end]) if end < len(starts) else len(data)
        if hi - lo > len(power):
            power, back = _powers(hi - lo)
        own = starts[at:end] - lo
        value = _VALUES[data[lo:hi]]
        value *= power[:hi - lo]
        out[at:end] = np.add.reduceat(value, own) * back[own]
        at = end
    return starts, mix64(out)


def components(spark: SparkSession, edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as (node, component), the component
    being its smallest node.  Nodes without an edge are absent.

    Alternates large-star and small-star steps (Kiveris et al. 2014); every step is two
    shuffles of the edge list, a node's neighbours are only ever reduced by ``min``, and
    no component is gathered in one task.  Converges in a logarithmic number of rounds;
    after ``rounds`` rounds without a fixed point it raises."""
    e = stored(spark, edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    last = None
    for _ in range(rounds):
        # large star: larger neighbours of u go to u's smallest neighbour (or u)
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b"), F.col("a")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        # small star: u's smaller neighbours and u itself go to the smallest of them
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("x"), F.col("m").alias("y"))
        e = stored(spark, small.where("x <> y").union(low.select("a", "m")).distinct(), name)
        e = e.toDF("a", "b")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last or now[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                e.select("b", "b")).distinct()
        last = now
    raise RuntimeError(f"components did not converge in {rounds} rounds")
