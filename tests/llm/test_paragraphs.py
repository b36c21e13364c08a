import random
import re

import numpy as np
import xxhash
from helpers import frame, mixed_texts, near, prose
from markbook.llm import paragraphs
from markbook.llm.common import hash_words


def brute(texts):
    units = []
    for i, t in enumerate(texts):
        doc, text = t if isinstance(t, tuple) else (i, t)
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for number, part in enumerate(re.split(r"(?<=[.!?])[ \t\r\x0b\x0c]+|\n", text)):
            words = [w for w in re.split(r"[\x20\x09-\x0D]+", part) if w]
            if len(words) >= paragraphs.MIN_WORDS:
                units.append((doc, number, len(words), {tuple(words[k:k + 5]) for k in range(len(words) - 4)}))
    root = list(range(len(units)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, u in enumerate(units):
        for j in range(i):
            both = len(u[3] & units[j][3])
            if 100 * both >= 75 * (len(u[3]) + len(units[j][3]) - both):
                root[top(i)] = top(j)
    groups = {}
    for i, u in enumerate(units):
        groups.setdefault(top(i), []).append(u[:3])
    out = []
    for g in groups.values():
        if len(g) > 1:
            ids = [u[0] for u in g if u[0] is not None]
            out += [(*u, min(ids) if ids else None) for u in g]
    return sorted(out, key=str), sum(len(g) > 1 for g in groups.values())


def test_clusters_equal_all_pairs(spark):
    rnd = random.Random(8)
    passage = prose(rnd, 26) + ". " + prose(rnd, 30) + ". " + prose(rnd, 14) + "."
    texts = mixed_texts() + [prose(rnd, 9) + ". " + near(rnd, passage, k % 4) + " " + prose(rnd, 20) for k in range(20)]
    rows = paragraphs.paragraph_removals(spark, frame(spark, texts)).collect()
    want, clusters = brute(texts)
    assert sorted(((r["doc_id"], r["paragraph"], r["n_words"], r["cluster_id"]) for r in rows), key=str) == want
    assert sum(not r["removed"] for r in rows) == clusters


def test_empty_table(spark):
    assert paragraphs.paragraph_removals(spark, frame(spark, [])).collect() == []


def sentences(rnd, sizes):
    return [prose(rnd, n) for n in sizes]


def joined(parts):
    return ". ".join(parts) + "."


def test_paragraphs_of_short_sentences(spark):
    rnd = random.Random(9)
    short = [sentences(rnd, [rnd.randint(2, 9) for _ in range(12)]) for _ in range(6)]
    edited = [[s if k else "other " + s for k, s in enumerate(p)] for p in short]
    texts = [f"{prose(rnd, 30)}\n{joined(p)}\n{prose(rnd, 25)}" for p in short + edited]
    rows = paragraphs.paragraph_removals(spark, frame(spark, texts)).collect()
    assert sorted((r["doc_id"], r["paragraph"], r["stretches"], r["cluster_id"], r["removed"]) for r in rows) == [
        (k, 1, 12, k % 6, k >= 6) for k in range(12)]


def test_one_edit_per_sentence(spark):
    rnd = random.Random(10)
    base = sentences(rnd, [37] * 6)
    edited = [" ".join("edit" if k == 18 else w for k, w in enumerate(s.split())) for s in base]
    rows = paragraphs.paragraph_removals(spark, frame(spark, [joined(base), joined(edited)])).collect()
    assert sorted((r["doc_id"], r["paragraph"], r["stretches"], r["removed"]) for r in rows) == [(0, 0, 6, False), (1, 0, 6, True)]


def test_copies_of_short_paragraphs(spark):
    texts = ["Read more\nown one", "own two\nread  MORE", "Read", "more", None, "", "\n \n"]
    rows = paragraphs.paragraph_removals(spark, frame(spark, texts), least=1).collect()
    assert sorted((r["doc_id"], r["paragraph"], r["n_words"], r["removed"]) for r in rows) == [(0, 0, 2, False), (1, 1, 2, True)]


def test_a_sentence_is_no_copy_of_its_own_paragraph(spark):
    rnd = random.Random(11)
    assert paragraphs.paragraph_removals(spark, frame(spark, ["Well. " + prose(rnd, 80)]), least=1).collect() == []


def test_a_sentence_stays_where_its_paragraph_stays(spark):
    """The near copy (1) goes with its own wording of the last sentence, which text 2 has too."""
    rnd = random.Random(12)
    base, own = sentences(rnd, [60, 60, 14]), prose(rnd, 14)
    texts = [joined(base), joined([*base[:2], own]), joined([prose(rnd, 50), own])]
    got = {(r["doc_id"], r["paragraph"], r["stretches"]): r["removed"] for r in
           paragraphs.paragraph_removals(spark, frame(spark, texts)).collect()}
    assert got[0, 0, 3] is False and got[1, 0, 3] is True
    assert got[1, 2, 1] is True and got[2, 1, 1] is False


def plain_units(texts, least):
    """Units by splitting one text at a time: place, first stretch, stretches, paragraph or -1, words, the words."""
    for place, text in enumerate(texts):
        number = 0
        for line in (text or "").encode().lower().split(b"\n"):
            parts = [p.split() for p in re.split(rb"(?<=[.!?])[ \t\r\x0b\x0c]+", line)]
            words = [w for p in parts for w in p]
            if len(words) >= least:
                yield (place, number, len(parts), -1, len(words)), words
            for k, p in enumerate(parts):
                if len(parts) > 1 and len(p) >= paragraphs.MIN_WORDS:
                    yield (place, number + k, 1, number, len(p)), p
            number += len(parts)


def test_units_of_many_texts_at_once(monkeypatch):
    g = random.Random(4)
    pieces = ["a", "B ", "c. ", " ", "\n", "d!\t", "e?\r\n", ".", "f\x0b", "w " * 13, "\x1c", "é ", "x y x y x y x y "]
    texts = [None, "", "\n", "a" * 200_000 + " b", *("".join(g.choice(pieces) for _ in range(g.randrange(60))) for _ in range(300))]
    want = list(plain_units(texts, 1))
    for part in (1 << 20, 50):
        monkeypatch.setattr(paragraphs, "PART", part)
        found = [np.concatenate(x) for x in zip(*paragraphs.Paragraphs(1)(texts), strict=True)]
        assert [tuple(r) for r in found[0].tolist()] == [row for row, _ in want]
        cls = paragraphs.class_keys(found[1], found[2])
        sets = [frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) for _, w in want]
        assert [len(s) for s in sets] == found[2].tolist()
        assert len(set(zip(cls.tolist(), sets, strict=True))) == len(set(cls.tolist())) == len(set(sets))


def test_words_keep_their_own_hash():
    text = b"b a  a\ncc b"
    starts, h = hash_words(text)
    named = paragraphs.named(text, np.array([*(c in b" \n" for c in text), True]), starts, h)
    assert named.tolist() == [xxhash.xxh3_64_intdigest(w) for w in text.split()]
