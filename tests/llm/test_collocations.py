import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import frame, prose
from markbook.llm import collocations


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(texts, langs, least, longest=5, top=2000):
    f, n = Counter(), Counter()
    for text, lang in zip(texts, langs):
        for words in pieces(text):
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                f.update((lang or "und", *words[i:i + k]) for i in range(len(words) - k + 1))
    keep = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    inside = {}
    for g, a in keep.items():
        for i in range(1, len(g)):
            for j in range(i + 2, len(g) + 1):
                if (i, j) != (1, len(g)):
                    inside[g[0], *g[i:j]] = max(a, inside.get((g[0], *g[i:j]), 0))
    out = {}
    for g, a in keep.items():
        if inside.get(g, 0) >= a:
            continue
        lang, *w = g
        score, _, l, r = min((1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r, n[lang]))
    return sorted((lang, rank, p.decode(), -a, l, r, m, -s) for lang, rows in out.items()
                  for rank, (s, a, p, l, r, m) in enumerate(sorted(rows)[:top], 1))


def got(df):
    return sorted(tuple(r)[:8] for r in df.collect())


def corpus(seed, n=160):
    """Few words, so that phrases repeat; set phrases of up to seven words; piece ends and odd blanks between."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Été", "naïve", "x'y", "\x1cz"]
    fixed = ["New York City", "as a matter of fact we say", "to be or not to be", "été naïve"]
    texts = []
    for _ in range(n):
        words = [rnd.choice(fixed) if rnd.random() < 0.2 else rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        texts.append("".join(w + rnd.choice([" "] * 8 + ["  ", "\t", ". ", ",", "\n", "!?", "\r\n"]) for w in words))
    texts += [None, "", " \t ", "...", texts[0], texts[0], "a " * 900, "to be " * 300, " no break " * 40]
    return texts, [rnd.choice(["en", "fr", None, "und", "en"]) for _ in texts]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_counting_every_phrase(spark, seed):
    texts, langs = corpus(seed)
    for least in (12, 40):
        out = collocations.collocations(spark, frame(spark, texts, langs).repartition(3), least=least)
        want = brute(texts, langs, least)
        assert len(want) > 20 and got(out) == want
        assert out.columns[:8] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_several_tries_and_word_blocks_give_the_same(spark, monkeypatch):
    texts, langs = corpus(3)
    monkeypatch.setattr(collocations, "TRIE_PHRASES", 37)
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 11)
    monkeypatch.setattr(collocations, "HELD_WORDS", 5)
    monkeypatch.setattr(collocations, "TOGETHER", 50)
    assert got(collocations.collocations(spark, frame(spark, texts, langs), least=15)) == brute(texts, langs, 15)


def test_first_of_each_lang(spark):
    texts, langs = corpus(5)
    assert got(collocations.collocations(spark, frame(spark, texts, langs), least=12, top=7)) == brute(texts, langs, 12, top=7)


def test_copies_of_one_text_make_long_phrases(spark):
    text = prose(random.Random(8), 40)
    out = collocations.collocations(spark, frame(spark, [text] * 120 + ["alone here"]))
    assert got(out) == brute([text] * 120 + ["alone here"], ["en"] * 121, 100)


def test_nothing_frequent(spark):
    for texts in ([], [None, ""], ["one two three"], ["x. " * 200]):
        out = collocations.collocations(spark, frame(spark, texts))
        assert out.collect() == [] and out.columns[:4] == ["lang", "rank", "phrase", "a"]


@pytest.mark.parametrize("k", [1, 2, 4])
def test_trie_accepts_its_sequences_only(k):
    rnd = np.random.default_rng(k)
    for high in (5, 300, 70_000, 3_000_000):
        sequences = np.unique(rnd.zipf(1.3, (4000, k)) % high + 1, axis=0).astype(np.int32)
        own = {tuple(s): i for i, s in enumerate(sequences.tolist())}
        text = np.concatenate([sequences[rnd.integers(0, len(sequences), 300)].ravel(), (rnd.zipf(1.3, 3000) % high).astype(np.int32), np.zeros(6, np.int32)])
        want = [(i, own[t]) for i in range(len(text) - k) if (t := tuple(text[i:i + k].tolist())) in own]
        places, which = collocations.Trie(sequences).walk(text)
        assert list(zip(places.tolist(), which.tolist())) == want


def test_products_beyond_64_bits(spark):
    """Scores by exact integers: 1000 * a * n is past 2^63 here."""
    phrases = spark.createDataFrame([([1, 2], 4_000_000_000)], "words array<int>, f long")
    numbered = spark.createDataFrame([(1, "en", "a", 5_000_000_007), (2, "en", "b", 6_000_000_011)], "id int, lang string, word string, n long")
    totals = spark.createDataFrame([("en", 900_000_000_000_001)], "lang string, n long")
    row = collocations.score_phrases(phrases, numbered, totals, 10).first()
    assert row["score"] == 1000 * 4_000_000_000 * 900_000_000_000_001 // (5_000_000_007 * 6_000_000_011)
