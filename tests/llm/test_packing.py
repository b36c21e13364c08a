import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from helpers import frame, mixed_texts
from markbook.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(text):
    from tokenizers import Tokenizer
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_pieces_cover_every_document_and_sequences_have_no_gap(spark):
    texts = mixed_texts() + ["it's A.B, c. <|endoftext|> É́a　x\x1cy", "word. word, Word"]
    rows = packing.pack(spark, frame(spark, texts), PATH, size=256, group_pieces=20).collect()
    want = defaultdict(list)
    for i, t in enumerate(texts):
        doc, text = t if isinstance(t, tuple) else (i, t)
        want[doc].append(library_ids(text))
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    expected = {doc: sorted((at, len(ids[at:at + 256]), zlib.crc32(np.array(ids[at:at + 256], "<u4").tobytes()), len(ids))
                            for ids in all_ids for at in range(0, len(ids), 256)) for doc, all_ids in want.items()}
    assert {d: sorted(p) for d, p in got.items()} == expected
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 256


def test_first_fit_takes_the_leftmost_bin_with_room():
    lengths = sorted(np.random.default_rng(3).integers(1, 101, 500).tolist(), reverse=True)
    free, want = [], []
    for n in lengths:
        k = next((k for k, room in enumerate(free) if room >= n), len(free))
        if k == len(free):
            free.append(100)
        want.append((k, 100 - free[k]))
        free[k] -= n
    assert list(zip(*packing.first_fit(lengths, 100))) == want


def test_empty_table(spark):
    assert packing.pack(spark, frame(spark, []), PATH).collect() == []


def test_a_task_leaves_no_words_in_its_worker(monkeypatch):
    """Idle workers would hold them through other operators' stages; the words known at a time, and the lines given to the library, are bounded."""
    import random

    import pyarrow as pa

    rnd = random.Random(3)
    texts = [" ".join(f"w{rnd.randrange(1 << 40)}" for _ in range(300)) for _ in range(3000)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    encoder = packing._encoder(PATH)
    most, lines, library = [], [], encoder.tokenizer

    class Counted:
        def encode_batch(self, some, **options):
            lines.append(len(some))
            return library.encode_batch(some, **options)

    monkeypatch.setattr(encoder, "tokenizer", Counted())
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda words: (learn(words), most.append(len(encoder.memo))))
    found = [r for b in packing.pieces_of(iter([batch]), PATH, 2048, packing.END_ID, keep_words=False) for r in b.to_pylist()]
    assert {r["doc_id"] for r in found} == set(range(len(texts)))
    assert len(encoder.memo) == 0 and max(most) <= encoder.memo.most and max(lines) <= packing.LINES
    for i in (0, 1500, 3000, 3001):
        ids = library_ids(texts[i])
        assert [(r["length"], r["ids_crc32"]) for r in found if r["doc_id"] == i] == [
            (len(ids[a:a + 2048]), zlib.crc32(np.array(ids[a:a + 2048], "<u4").tobytes())) for a in range(0, len(ids), 2048)]
