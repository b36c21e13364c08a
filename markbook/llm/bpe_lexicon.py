"""Operator 10: byte-level BPE encoding and decoding over a minimal acyclic lexicon.

The corpus's frequent words are compiled into a minimal deterministic acyclic automaton
whose states share common suffixes.  Every state carries the number of words below it, so
a walk also yields the word's index, and the index addresses the word's ids: the id output
of the transducer.  The flat arrays are written to one file and memory-mapped by every
Python worker.  Words outside the lexicon are merged by rank, pair by pair, which gives the
same ids; the lexicon changes the time only.

Cases: null text is empty; an empty text has no ids and decodes to the empty text; a very
long text is encoded whole; repeated rows give repeated results; the special token's string
inside a text becomes its id, as the tokenizers library does by default; other columns of
the input, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markbook.llm.common import Memo

# The pre-tokenization pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words the lexicon may hold; with ``LONGEST`` this bounds what is broadcast.
LEXICON_WORDS = 1 << 16
LONGEST = 48
#: A word is counted if it makes up at least this share of some task's words.
RARE = 2e-6


def byte_letters() -> dict[str, int]:
    """The vocabulary file's letter for each byte: printable bytes stand for themselves,
    the others follow from U+0100 on in byte order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        own = lambda token: bytes(letters[c] for c in token)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {own(t): i for t, i in model["vocab"].items() if t not in self.special}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(own(a), own(b)): r for r, (a, b) in enumerate(pairs)}
        self.bytes = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.pieces = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def merge(self, word: bytes) -> bytes:
        """Ids of one pre-token as little-endian 32-bit integers: the leftmost pair of the
        lowest rank is merged until no pair has a rank."""
        rank, ids, never = self.rank, self.ids, 1 << 30
        parts = [word[i:i + 1] for i in range(len(word))]
        if len(parts) > 256:
            return self._merge_long(parts)
        ranks = [rank.get(p, never) for p in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get((parts[i], parts[i + 1]), never)
            if i:
                ranks[i - 1] = rank.get((parts[i - 1], parts[i]), never)
        return b"".join([ids[p].to_bytes(4, "little") for p in parts])

    def _merge_long(self, parts: list[bytes]) -> bytes:
        """The same merges through a heap and a linked list, for very long words."""
        import heapq

        n, rank = len(parts), self.rank
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(rank[p], i, p) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, i, (a, b) = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                m = after[k] if k >= 0 else n
                if m < n and (parts[k], parts[m]) in rank:
                    heapq.heappush(heap, (rank[parts[k], parts[m]], k, (parts[k], parts[m])))
        return b"".join(self.ids[p].to_bytes(4, "little") for p in parts if p is not None)


def compile_lexicon(entries: Iterable[tuple[bytes, bytes]]) -> bytes:
    """The minimal acyclic automaton of ``entries`` (word, ids as bytes), as one block.

    Sorted words are added one by one; a state that can no longer change is replaced by an
    equal registered state, so equal suffixes are stored once."""
    entries = sorted(dict(entries).items())
    register: dict[tuple, int] = {}
    kept: list[tuple[int, bool, tuple]] = []  # words below, final, ((label, state), ...)

    def close(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(kept)
            kept.append((node[0] + sum(kept[s][0] for _, s in node[1]), bool(node[0]), tuple(node[1])))
        return register[key]

    path: list[list] = [[0, []]]  # [final, closed edges] of each open state
    last = b""
    for word, _ in entries:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        while len(path) > same + 1:
            done = close(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        path += [[0, []] for _ in word[same:]]
        path[-1][0] = 1
        last = word
    while len(path) > 1:
        done = close(path.pop())
        path[-1][1].append((last[len(path) - 1], done))
    root = close(path[0])
    key, to, skip = [], [], []
    for s, (_, final, edges) in enumerate(kept):
        seen = int(final)
        for label, t in edges:
            key.append(s << 8 | label)
            to.append(t)
            skip.append(seen)
            seen += kept[t][0]
    ends = np.cumsum([0, *(len(i) // 4 for _, i in entries)])
    parts = [np.array(key, np.int64), np.array(to, np.int64), np.array(skip, np.int64),
             np.array([f for _, f, _ in kept], np.int64), ends.astype(np.int64),
             np.frombuffer(b"".join(i for _, i in entries), np.uint32)]
    head = np.array([root, *map(len, parts)], np.int64)
    return head.tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled block, memory-mapped."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as f:  # unlinked at once; the mapping keeps it
            f.write(block)
            f.flush()
            view = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
        head = np.frombuffer(view, np.int64, 7)
        self.root, at, parts = int(head[0]), 56, []
        for n, kind in zip(head[1:].tolist(), [np.int64] * 5 + [np.uint32], strict=True):
            parts.append(np.frombuffer(view, kind, n, at))
            at += parts[-1].nbytes
        self.key, self.to, self.skip, self.final, self.ends, self.out = parts

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word, None where the lexicon lacks it; all words step together."""
        found: list[bytes | None] = [None] * len(words)
        if not words or not len(self.key):
            return found
        size = np.fromiter(map(len, words), np.int64, len(words))
        live = np.flatnonzero((size > 0) & (size <= LONGEST))
        width = int(size[live].max(initial=1))
        text = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in live.tolist()), np.uint8)
        text = text.reshape(len(live), width)
        row, state, index = np.arange(len(live)), np.full(len(live), self.root), np.zeros(len(live), np.int64)
        for step in range(width + 1):
            over = size[live[row]] == step
            hit = over & (self.final[state] == 1)
            for r, i in zip(row[hit].tolist(), index[hit].tolist(), strict=True):
                found[live[r]] = self.out[self.ends[i]:self.ends[i + 1]].tobytes()
            row, state, index = row[~over], state[~over], index[~over]
            if step == width or not len(row):
                break
            want = state << 8 | text[row, step]
            edge = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            ok = self.key[edge] == want
            row, edge, index = row[ok], edge[ok], index[ok]
            state, index = self.to[edge], index + self.skip[edge]
        return found


class Codec:
    """Encoder and decoder of one Python worker.

    A text is cut before each single blank that stands between two other characters than
    white space: no pre-token crosses such a cut.  What lies between two cuts, a blank and a
    word with its punctuation as a rule, is a chunk; chunks and pre-tokens are remembered."""

    def __init__(self, path: str, block: bytes):
        self.vocabulary, self.lexicon = Vocabulary(path), Lexicon(block)
        self.chunks, self.pieces = Memo(), Memo()
        top = max(self.vocabulary.bytes) + 1
        self.token = [self.vocabulary.bytes.get(i, b"") for i in range(top)]
        self.wide = regex.compile(r"\s | \s")

    def learn(self, words: set[str]) -> None:
        """Ids of the chunks " " + word for all new words; the lexicon is asked for all at once."""
        new = self.chunks.missing(words)
        new = list(words) if self.chunks.room(len(new)) else new
        forms = [b" " + w.encode() for w in new]
        rest = []
        for w, ids in zip(new, self.lexicon.find(forms), strict=True):
            if ids is None:
                rest.append((w, self.split(" " + w)))
            else:
                self.chunks[w] = ids
        self.learn_pieces({p for _, pieces in rest for p in pieces})
        for w, pieces in rest:
            self.chunks[w] = b"".join([self.pieces[p] for p in pieces])

    def split(self, chunk: str) -> list[str]:
        if chunk[-1] in ",." and chunk[1:-1].isalpha() and chunk[0] == " ":
            return [chunk[:-1], chunk[-1]]
        return self.vocabulary.pieces.findall(chunk)

    def learn_pieces(self, pieces: set[str]) -> None:
        new = self.pieces.missing(pieces)
        new = list(pieces) if self.pieces.room(len(new)) else new
        words = [p.encode() for p in new]
        for p, w, ids in zip(new, words, self.lexicon.find(words), strict=True):
            self.pieces[p] = self.vocabulary.merge(w) if ids is None else ids

    def plain(self, text: str) -> bytes:
        """Ids of a stretch of text, pre-token by pre-token."""
        pieces = self.vocabulary.pieces.findall(text)
        self.learn_pieces(set(pieces))
        return b"".join([self.pieces[p] for p in pieces])

    def encode_many(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, which holds no special token."""
        for at in range(0, len(texts), 1024):
            some = [None if self.wide.search(t) else t.split(" ") for t in texts[at:at + 1024]]
            self.learn(set().union(*(words[1:] for words in some if words)))
            for words, t in zip(some, texts[at:at + 1024], strict=True):
                if words is None:
                    yield self.uneven(t)
                else:
                    yield self.plain(words[0]) + b"".join(map(self.chunks.__getitem__, words[1:]))

    def uneven(self, text: str) -> bytes:
        """A text with runs of white space: words beside such a run join into one stretch."""
        words, out, held = text.split(" "), [], None
        edge = lambda w: not w or w[0].isspace() or w[-1].isspace()
        odd = [edge(w) for w in words]
        self.learn({w for w, o in zip(words[1:], odd[1:], strict=True) if not o})
        for i, w in enumerate(words):
            chunk = " " + w if i else w
            if i and not odd[i] and not odd[i - 1] and held is None:
                out.append(self.chunks[w])
            elif not odd[i] and held is None:
                out.append(self.plain(chunk))
            else:
                held = (held or "") + chunk
            if held is not None and not odd[i]:
                out.append(self.plain(held))
                held = None
            elif odd[i] and held is None:
                held = chunk
        return b"".join([*out, self.plain(held or "")])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        parts, owner = [], []
        for k, t in enumerate(texts):
            for part in self.vocabulary.cut.split(t) if "<|" in t else (t,):
                parts.append(part)
                owner.append(k)
        plain = self.encode_many([p for p in parts if p not in self.vocabulary.special])
        out = [[] for _ in texts]
        for k, p in zip(owner, parts, strict=True):
            special = self.vocabulary.special.get(p)
            out[k].append(next(plain) if special is None else special.to_bytes(4, "little"))
        return [b"".join(x) for x in out]

    def decode(self, ids: bytes) -> str:
        whole = b"".join(map(self.token.__getitem__, np.frombuffer(ids, np.uint32).tolist()))
        return whole.decode("utf-8", "replace")


_codecs: dict[tuple[str, str], Codec] = {}


def _codec(path: str, shared) -> Codec:
    """One codec per worker; the last one is kept."""
    block = shared.value
    key = (path, hashlib.sha256(block).hexdigest())
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(path, block)
    return _codecs[key]


def frequent_words(docs: DataFrame, text: str, rare: float = RARE) -> DataFrame:
    """(word, n) of the words that make up at least ``rare`` of some task's words, by lossy
    counting over all texts: a task holds and sends at most about 1 / ``rare`` words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total, most = Counter(), 0, int(1 / rare)
        for b in batches:
            for t in b.column(0).to_pylist():
                words = (t or "").split()
                total += len(words)
                seen.update(words)
            if len(seen) > most:
                least = max(2, int(total * rare) + 1)
                seen = Counter({w: n for w, n in seen.items() if n >= least})
        least = max(2, int(total * rare))
        rows = [(w, n) for w, n in seen.items() if n >= least and len(w) <= LONGEST]
        yield pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in rows], pa.string()),
                                          "n": pa.array([n for _, n in rows], pa.int64())})

    part = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(spark: SparkSession, docs: DataFrame, text: str, path: str, words: int = LEXICON_WORDS) -> bytes:
    """The compiled lexicon of the ``words`` most frequent words (ties by word).  Only this
    bounded list reaches the driver."""
    top = frequent_words(docs, text).orderBy(F.desc("n"), "word").limit(words).collect()
    vocabulary = Vocabulary(path)
    entries: dict[bytes, bytes] = {}
    for r in top:
        for form in (r["word"], " " + r["word"]):
            pieces = vocabulary.pieces.findall(form)
            for p in pieces:
                if p.encode() not in entries:
                    entries[p.encode()] = vocabulary.merge(p.encode())
            entries[form.encode()] = b"".join([entries[p.encode()] for p in pieces])
    return compile_lexicon((w, ids) for w, ids in entries.items() if len(w) <= LONGEST)


def encode_documents(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text",
                     lexicon_words: int = LEXICON_WORDS, full: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, and with
    ``full`` also ``ids`` (array<int>) and ``decoded``.  No shuffle of texts."""
    shared = spark.sparkContext.broadcast(build_lexicon(spark, docs, text, path, lexicon_words))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<int>, decoded string" if full else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, shared)
        for b in batches:
            n, ids_sha, out_sha, all_ids, all_text = [], [], [], [], []
            for ids in codec.encode_all([t or "" for t in b.column(1).to_pylist()]):
                back = codec.decode(ids)
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                out_sha.append(hashlib.sha256(back.encode()).hexdigest())
                if full:
                    all_ids.append(np.frombuffer(ids, np.int32))
                    all_text.append(back)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(out_sha, pa.string())]
            if full:
                cols += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(all_text, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in schema.split(", ")])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)
