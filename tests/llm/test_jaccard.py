import random

import numpy as np
import pandas as pd
from helpers import frame, mixed_texts, near, prose
from markbook.llm import jaccard
from markbook.llm.common import bucketed, dealt, scratch


def brute(texts):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    docs = []
    for i, t in enumerate(texts):
        doc, text = t if isinstance(t, tuple) else (i, t)
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
        docs.append((doc, {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()))
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(docs):
        for j, (_, b) in enumerate(docs[:i]):
            both = len(a & b)
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(((doc, len(s), least.get(top(i))) for i, (doc, s) in enumerate(docs)), key=str)


def run(spark, texts):
    rows = jaccard.jaccard_components(spark, frame(spark, texts))
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows.collect()), key=str)


def test_components_equal_all_pairs(spark):
    assert run(spark, mixed_texts()) == brute(mixed_texts())


def test_chains_of_near_copies_and_hot_families(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 6)
    rnd = random.Random(4)
    texts = []
    for n in (12, 30, 60):
        text = prose(rnd, n)
        for _ in range(30):  # a chain: each differs a little from the one before
            texts.append(text)
            text = near(rnd, text, rnd.choice([0, 1, 1, 2]))
    common = prose(rnd, 20)
    texts += [common + " " + prose(rnd, k) for k in range(1, 25)]
    rnd.shuffle(texts)
    assert run(spark, texts) == brute(texts)


def test_links_do_not_depend_on_the_rounds(spark, monkeypatch):
    """Without any minimum hash the matrix alone finds every link."""
    monkeypatch.setattr(jaccard, "MINS", 0)
    rnd = random.Random(9)
    base = prose(rnd, 60)
    texts = [near(rnd, base, k % 7) for k in range(25)] + [prose(rnd, 30) for _ in range(10)]
    assert run(spark, texts) == brute(texts)


def test_overlaps_count_common_tokens(monkeypatch):
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 90, n).astype(np.uint64)) for n in (1, 5, 40, 40, 80, 200, 3, 60)] + [np.arange(500, 520, dtype=np.uint64)]
    for columns in (7, 1 << 14):
        monkeypatch.setattr(jaccard, "COLUMNS", columns)
        want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
        assert jaccard.overlaps(sets).tolist() == want
        assert jaccard.overlaps(sets[:3], sets[3:]).tolist() == [row[3:] for row in want[:3]]


def test_opened_groups_link_other_components_only():
    base = np.arange(100, dtype=np.uint64)
    held = [base.tobytes(), (base + 3).tobytes(), (base + 60).tobytes()]
    askers = pd.DataFrame({"comp": [1, 9], "tokens": held[:1] + held[2:]})
    members = pd.DataFrame({"member": [1, 2, 3], "held": held})
    assert jaccard.open_group(askers, members).values.tolist() == [[1, 2], [9, 3]]
    assert jaccard.open_group(askers, members[:0]).empty


def test_a_passage_of_many_short_texts(spark, monkeypatch):
    """Texts that share most of their words without being similar meet as groups, and every link stays."""
    monkeypatch.setattr(jaccard, "CHUNK", 8)
    monkeypatch.setattr(jaccard, "ASKERS", 5)
    rnd = random.Random(12)
    passage = prose(rnd, 12)
    texts = [passage + " " + prose(rnd, 4 + k % 3) for k in range(60)]
    texts += [near(rnd, t, 1) for t in texts[:10]] + [prose(rnd, 300) + " " + passage for _ in range(3)]
    assert run(spark, texts) == brute(texts)


def test_a_family_of_many_chunks_is_one_component_before_the_matrix(spark, monkeypatch):
    """However many other groups there are: its members would ask all groups of the rest of the family."""
    monkeypatch.setattr(jaccard, "CHUNK", 4)
    monkeypatch.setattr(jaccard, "MINS", 1)
    base, n = np.arange(100, dtype=np.uint64), 40
    sets = [(k, bytearray(np.append(base, np.uint64(1000 + k)).tobytes())) for k in range(n)]
    sets += [(k, bytearray(np.arange(k * 50, k * 50 + 20, dtype=np.uint64).tobytes())) for k in range(n, 12 * n)]
    mins = [(k, 0, 1 if k < n else k // 2 * 10) for k, _ in sets]
    found = jaccard.link_groups(spark, spark.createDataFrame(mins, "cls long, r int, m long"),
                                spark.createDataFrame(sets, "cls long, tokens binary")).collect()
    assert len(found) == len(sets)
    assert len({r["comp"] for r in found if r["cls"] < n}) == 1
    assert len({r["comp"] for r in found if r["cls"] >= n}) == 11 * n


def test_many_groups_in_one_bucket():
    base = np.arange(100, dtype=np.uint64)
    held = [base.tobytes(), (base + 3).tobytes(), (base + 60).tobytes()]
    chunks = pd.DataFrame({"m": [5, 5, 5, 6, 6], "sub": [0, 0, 1, 0, 0], "comp": [4, 2, 1, 9, 7], "tokens": [held[k] for k in (0, 1, 0, 0, 2)]})
    assert jaccard.link_chunks(chunks).values.tolist() == [[4, 2]]
    askers = pd.DataFrame({"grp": [8, 7, 7], "part": [1, 0, 1], "comp": [1, 2, 3], "tokens": held[:1] * 3})
    members = pd.DataFrame({"of": [7, 8, 8, 9], "at": [1, 1, 0, 1], "member": [4, 5, 6, 7], "held": held[1:2] * 4})
    assert sorted(jaccard.open_groups(askers, members).values.tolist()) == [[1, 5], [3, 4]]
    assert jaccard.open_groups(askers[:0], members).empty
    assert jaccard.overlaps([base], [base + np.uint64(200)]).tolist() == [[0]]


def test_one_of_each_keeps_whole_rows(spark):
    texts = mixed_texts()
    docs = frame(spark, texts)
    kept = jaccard.one_of_each(spark, docs)
    assert kept.columns == docs.columns
    components = {c for d, n, c in brute(texts) if n}
    with_words = [r for r in kept.collect() if (r["text"] or "").split()]
    assert len(with_words) == len(components)
    assert kept.count() - len(with_words) == sum(1 for d, n, c in brute(texts) if not n)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_shingle_sets_do_not_depend_on_what_is_hashed_together(monkeypatch):
    texts = [None, "", " \n", "a", "A ", "a b", "b a", "ab", "x" * 300_000 + " y", "\x0b\x0ca\x1cb", "a b c d", "a b c d e",
             "a\tB c d e f", "a b c d e a b c d e a b c d e", "é è É a b c d", *mixed_texts()]
    texts = [t[1] if isinstance(t, tuple) else t for t in texts]
    sets = list(jaccard.shingle_sets(texts))
    assert [len(s) for s in sets] == [n for _, n, _ in sorted(brute(list(enumerate(texts))), key=lambda r: r[0])]
    assert (sets[3] == sets[4]).all() and len({s.tobytes() for s in sets[3:9]}) == 5
    monkeypatch.setattr(jaccard, "TOGETHER_BYTES", 1)
    assert all((a == b).all() for a, b in zip(sets, jaccard.shingle_sets(texts), strict=True))


def test_bucketed_sets_are_not_shuffled_again(spark):
    rows = spark.range(100).selectExpr("id as cls", "id * 2 as x")
    with scratch(spark):
        sets = bucketed(spark, dealt(spark, rows, "cls"), "sets", "cls")
        both = sets.join(rows.hint("merge").withColumnRenamed("x", "y"), "cls")
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan
        assert both.where("x = y").count() == 100
        name = sets.inputFiles()[0].split("/")[-2]
    assert not spark.catalog.tableExists(name)
