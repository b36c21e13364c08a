import random
from collections import defaultdict

import pytest
from helpers import frame, mixed_texts, near, prose, sha
from markbook.llm import substrings


def brute(texts, window):
    seen = defaultdict(list)
    data = []
    for i, t in enumerate(texts):
        doc, text = t if isinstance(t, tuple) else (i, t)
        data.append((doc, (text or "").encode()))
    for k, (_, b) in enumerate(data):
        for i in range(len(b) - window + 1):
            seen[b[i:i + window]].append((k, i))
    gone = [bytearray(len(b)) for _, b in data]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i:i + window] = b"\1" * window
    out = []
    for (doc, b), g in zip(data, gone):
        kept = bytes(x for x, y in zip(b, g) if not y)
        spans = sum(1 for i, y in enumerate(g) if y and (i == 0 or not g[i - 1]))
        out.append((doc, len(b), sum(g), spans, sha(kept)))
    return sorted(out, key=str), [bytes(x for x, y in zip(b, g) if not y).decode("utf-8", "ignore") for (_, b), g in zip(data, gone)]


def texts_with_passages(seed):
    rnd = random.Random(seed)
    texts = mixed_texts(seed)
    passages = [prose(rnd, n) for n in (20, 40, 60)]
    for _ in range(25):
        parts = [prose(rnd, rnd.randint(0, 30)) for _ in range(3)]
        texts.append(rnd.choice(passages).join(parts[:2]) + near(rnd, rnd.choice(passages), rnd.randint(0, 2)) + parts[2])
    texts += ["äöü" * 200, "öüä" * 150, "x" * 399, "x" * 401]
    return texts


@pytest.mark.parametrize("seed,window", [(1, 120), (2, 400), (3, 60)])
def test_removed_bytes_equal_brute_force(spark, seed, window):
    texts = texts_with_passages(seed)
    rows = substrings.dedup_substrings(spark, frame(spark, texts), window=window).collect()
    want, _ = brute(texts, window)
    assert sorted((tuple(r) for r in rows), key=str) == want


def test_hot_phrases_are_counted_by_window(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 5)
    monkeypatch.setattr(substrings, "BUCKET", 40)
    texts = texts_with_passages(5)
    rows = substrings.dedup_substrings(spark, frame(spark, texts), window=120).collect()
    assert sorted((tuple(r) for r in rows), key=str) == brute(texts, 120)[0]


def test_strip_documents_returns_the_texts_left(spark):
    texts = texts_with_passages(6)
    docs = frame(spark, texts)
    out = substrings.strip_documents(spark, docs, window=120)
    assert out.columns == docs.columns
    want = sorted(brute(texts, 120)[1])
    assert sorted(r["text"] or "" for r in out.collect()) == want


def test_empty_table(spark):
    assert substrings.dedup_substrings(spark, frame(spark, [])).collect() == []


def test_windows_met_once_do_not_reach_the_join(spark):
    plain = spark.createDataFrame([(1, list(range(1000)), list(range(1000))), (2, [5, 2000], [3, 4])], "cls long, plain array<long>, start array<int>")
    twice = spark.createDataFrame([(5,)], "key long")
    assert sorted(tuple(r) for r in substrings.marked_windows(spark, plain, twice).collect()) == [(1, 5, 5), (2, 5, 3)]
