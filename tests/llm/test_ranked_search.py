import math
import random
import re
from collections import Counter

import pytest
from helpers import frame, mixed_texts, prose
from markbook.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    """[(item_id, doc_id, score)] of every item, best first; docs and items: (id, text)."""
    own = [(d, Counter(fold(t))) for d, t in docs]
    own = [(d, c, sum(c.values())) for d, c in own if c]
    n_docs, n_terms = len(own), sum(n for *_, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        asked, scores = Counter(fold(text)), []
        for d, c, n in own:
            m = 25 + 75 * n * n_docs // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, q in asked.items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out.append((item, [(None if none else d, -s) for s, none, d in sorted(scores)[:top]]))
    return sorted((i is None, i or 0, found) for i, found in out if found)


def got(df):
    rows = {}
    for r in df.collect():
        rows.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    assert all([k for k, *_ in sorted(v)] == list(range(1, len(v) + 1)) for v in rows.values())
    return sorted((i is None, i or 0, [(d, s) for _, d, s in sorted(v, key=lambda x: x[0])]) for i, v in rows.items())


@pytest.mark.parametrize("owners", [1, 3, 8])
def test_equals_scoring_every_document(spark, monkeypatch, owners):
    """Several small shards, so that bundles drop documents on the way; copies tie."""
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 29)
    rnd = random.Random(owners)
    texts = mixed_texts(owners) + [prose(rnd, rnd.randint(5, 60)) for _ in range(150)] + ["Ünïcode wörds, under_score x-9!"]
    docs = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    items = [(i, " ".join(rnd.choices(fold(docs[rnd.randrange(40)][1]) or ["x"], k=rnd.randint(1, 30)))) for i in range(12)]
    items += [(40, docs[10][1]), (41, None), (42, "  ,. "), (43, "nowhere nothing"), (44, "ÜNÏCODE Under_Score WÖRDS"), (None, docs[3][1]), (40, docs[10][1])]
    found = ranked_search.search(spark, frame(spark, texts).repartition(3), spark.createDataFrame(items, "item_id long, text string"), owners=owners)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(found) == brute(docs, items)


def test_item_blocks_give_the_same(spark, monkeypatch):
    texts = [t for t in mixed_texts(4) if not isinstance(t, tuple)]
    items = spark.createDataFrame([(i, texts[i]) for i in range(20)], "item_id long, text string")
    whole = got(ranked_search.search(spark, frame(spark, texts), items, top=3))
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 6)
    assert got(ranked_search.search(spark, frame(spark, texts), items, top=3)) == whole == brute(list(enumerate(texts)), [(i, texts[i]) for i in range(20)], 3)


def test_pruning_keeps_ties(spark, monkeypatch):
    """A thousand equal documents: the ten smallest ids win, whatever shard they are in."""
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 64)
    texts = [(1000 - i, "red green blue") for i in range(1000)] + [(5000 + i, f"red other{i}") for i in range(300)]
    found = ranked_search.search(spark, frame(spark, texts).repartition(5), spark.createDataFrame([(1, "green red red")], "item_id long, text string"))
    assert [r["doc_id"] for r in found.orderBy("rank").collect()] == list(range(1, 11))


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for docs, asked in (([], items), (["a b"], items.limit(0)), ([None, "", "?"], items), (["c"], items)):
        out = ranked_search.search(spark, frame(spark, docs), asked)
        assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_one_very_long_text(spark):
    rnd = random.Random(1)
    docs = [(0, prose(rnd, 200_000)), (1, prose(rnd, 50)), (2, None)]
    items = [(1, docs[1][1]), (2, prose(rnd, 20_000))]
    assert got(ranked_search.search(spark, frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))) == brute(docs, items)
