"""Operator 1: packing documents into sequences.

Documents become token ids, an end id closes each.  A document longer than a sequence is cut
into whole sequences and a rest; rests and shorter documents are dealt into randomised
groups, and every group packs its pieces by first-fit decreasing: pieces by falling length,
each into the leftmost bin that still has room, found by descending a tournament tree that
holds the largest free room below every node.

Groups hold about ``group_pieces`` pieces whatever the input's size, so neither a task's
memory nor the padding (at most about one open bin per group beyond first-fit's own) grows.

Cases: null or empty text is a document of the end id alone; a very long text is cut;
equal lengths are ordered by id and start; repeated rows are packed once each; an empty table
gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markbook.llm.common import Memo, stored

END_ID = 1
GROUP_PIECES = 20_000
LINES = 256  # lines of 256 words that the tokenizers library encodes at a time
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordIds:
    """Ids of texts as little-endian 32-bit bytes, by the tokenizers library.

    The vocabulary never joins across white space, so each word is encoded once and
    remembered.  It also lower-cases, and it parts letters and digits from other signs; so where
    nothing can go wrong (the text is in composed form, commas and full stops stand beside no
    other sign, no control separators, no sigma with its two small forms) the text is
    lower-cased and commas and full stops become words of their own first: fewer words differ."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.memo = Tokenizer.from_file(path), Memo()
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.close = re.compile(r"[.,\x1c-\x1f](?:(?<=[\x1c-\x1f])|(?=[^\w\s]|_)|(?<=[^\w\s][.,])|(?<=_[.,]))")

    def words(self, text: str) -> list[str]:
        low = text.lower()
        if "\u03a3" in text or self.close.search(low) or not unicodedata.is_normalized("NFC", text):
            return text.replace("\n", " ").split(" ")
        return low.replace(",", " ,").replace(".", " .").split()

    def ids(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word; words are encoded some hundred to a line and told apart by offsets, some lines at a
        time, as the library's results take many times the words' own memory."""
        lines = [words[i:i + 256] for i in range(0, len(words), 256)]
        encoded = (e for at in range(0, len(lines), LINES)
                   for e in self.tokenizer.encode_batch([" ".join(x) for x in lines[at:at + LINES]], add_special_tokens=False))
        for line, e in zip(lines, encoded, strict=True):
            starts = np.cumsum([0, *(len(w) + 1 for w in line)])
            owner = np.searchsorted(starts, np.array([a for a, _ in e.offsets], np.int64), "right")
            cuts = (4 * np.searchsorted(owner, np.arange(1, len(line) + 2))).tolist()
            raw = np.array(e.ids, np.uint32).tobytes()
            yield from [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def learn(self, words: set[str]) -> None:
        new = self.memo.missing(words)
        new = list(words) if self.memo.room(len(new)) else new
        self.memo.update(zip(new, self.ids(new), strict=True))

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        for at in range(0, len(texts), 1024):
            some = [self.words(t or "") for t in texts[at:at + 1024].to_pylist()]
            self.learn(set().union(*some))
            for words in some:
                yield b"".join(map(self.memo.__getitem__, words))


_encoders: dict[str, WordIds] = {}


def _encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def pieces_of(batches: Iterator[pa.RecordBatch], path: str, size: int, end_id: int, keep_words: bool = True) -> Iterator[pa.RecordBatch]:
    """The pieces of (id, text) rows.  A worker keeps the tokenizer for its next task, and the words with ``keep_words``;
    without, idle workers do not hold them through the stages of other operators."""
    encode, end = _encoder(path), end_id.to_bytes(4, "little")
    try:
        for b in batches:
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), encode(b.column(1)), strict=True):
                ids = memoryview(ids + end)
                n = len(ids) // 4
                for at in range(0, n, size):
                    piece = ids[4 * at:4 * (at + size)]
                    rows.append((doc, at, len(piece) // 4, zlib.crc32(piece), n))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=[c.split()[0] for c in PIECES.split(", ")])
    finally:
        if not keep_words:
            encode.memo.clear()


def cut_pieces(docs: DataFrame, path: str, id_col: str, text: str, size: int, end_id: int, keep_words: bool = True) -> DataFrame:
    """One row per piece: whole sequences of ``size`` ids, then the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pieces_of(batches, path, size, end_id, keep_words)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, PIECES)


def first_fit(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of every piece, the pieces given by falling length.  ``room`` is a
    tournament tree over the bins: node k holds the most free room among its bins, so the
    leftmost bin with room is found in one descent."""
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    room = [size] * (2 * leaves)
    bins, offsets = [], []
    for n in lengths:
        k = 1
        while k < leaves:
            k *= 2
            if room[k] < n:
                k += 1
        bins.append(k - leaves)
        offsets.append(size - room[k])
        room[k] -= n
        k //= 2
        while k:
            best = max(room[2 * k], room[2 * k + 1])
            if room[k] == best:
                break
            room[k] = best
            k //= 2
    return bins, offsets


def pack(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", size: int = 2048,
         end_id: int = END_ID, group_pieces: int = GROUP_PIECES, seed: int = 17, keep_words: bool = True) -> DataFrame:
    """Pieces of all documents with their place: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset.  Texts are read once and never shuffled; only the
    pieces' few numbers are.  ``keep_words``: whether workers keep words between tasks, which saves time and takes memory."""
    pieces = stored(spark, cut_pieces(docs, path, id_col, text, size, end_id, keep_words), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        bins, offsets = first_fit(pdf["length"].tolist(), size)
        return pdf.assign(sequence_id=[int(key[0]) << 32 | b for b in bins], offset=offsets).drop(columns="grp")

    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.lit(seed)), F.lit(groups)))
    return dealt.groupBy("grp").applyInPandas(run, PIECES + ", sequence_id long, offset long")
