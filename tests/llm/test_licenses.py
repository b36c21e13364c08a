import random

from helpers import frame, prose
from markbook.llm import licenses


def test_every_planted_notice_is_found_and_nothing_else(spark):
    rnd = random.Random(5)
    texts, want = [], []
    for i, (name, notices) in enumerate(sorted(licenses.TEMPLATES.items())):
        for notice in notices:
            for before, after in ((0, 0), (7, 0), (33, 90), (400, 3)):
                head = prose(rnd, before)
                want.append((len(texts), name))
                texts.append(f"{head} {notice.upper() if before == 7 else notice}. {prose(rnd, after)}")
    clean = len(texts)
    texts += [prose(rnd, 300) for _ in range(20)] + [None, "", "the license", "Licensed under", "MIT"]
    rows = licenses.scan_licenses(frame(spark, texts)).collect()
    assert {(r["doc_id"], r["license"]) for r in rows} >= set(want)
    assert all(r["doc_id"] < clean for r in rows)
    assert all(0.9 <= r["containment"] <= 1 for r in rows)
    first = {(r["doc_id"], r["license"]): r["word"] for r in rows}
    for doc, name in want[1::4]:
        assert first[doc, name] in (7, 7 + 0)


def test_brute_force_containment():
    """Places found by bands equal those found by trying every place."""
    rnd = random.Random(6)
    scanner = licenses.Scanner()
    notice = licenses.TEMPLATES["GPL-3.0"][1]
    text = " ".join(prose(rnd, rnd.randint(1, 60)) + " " + notice for _ in range(20))
    h = scanner.words(text)
    found = [m for m in scanner.scan(text) if m[0] == "GPL-3.0" and m[3] == 1.0]
    need = scanner.words(notice)
    places = [i for i in range(len(h)) if len(h) - i >= len(need) and (h[i:i + len(need)] == need).all()]
    assert [m[1] for m in found] == places


def test_empty_table_and_no_templates(spark):
    assert licenses.scan_licenses(frame(spark, [])).collect() == []
    assert licenses.scan_licenses(frame(spark, ["Released under the MIT License"]), templates={}).collect() == []


def test_edited_notices_equal_brute_force_containment():
    """Every place of one and, from 16 words on, two replaced words."""
    rnd, scanner = random.Random(7), licenses.Scanner()
    for name, notices in licenses.TEMPLATES.items():
        for notice in notices:
            words = licenses.WORD.findall(notice.lower())
            need = {*zip(words, words[1:])}
            if len(words) < licenses.SHORT:
                continue
            for i in range(len(words)):
                edits = [i] if len(words) < licenses.LONG else [i, rnd.randrange(len(words))]
                text = [w if k not in edits else f"edit{k}" for k, w in enumerate(words)]
                share = len(need & {*zip(text, text[1:])}) / len(need)
                found = {m[0]: m[3] for m in scanner.scan(f"{prose(rnd, 40)} {' '.join(text)} {prose(rnd, 40)}")}
                assert found and max(found.values()) >= share - 1e-9, (name, edits)


def test_the_closer_license_wins():
    scanner = licenses.Scanner()
    for name in ("LGPL-3.0", "AGPL-3.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "ISC"):
        for notice in licenses.TEMPLATES[name]:
            assert {m[0] for m in scanner.scan(f"This is {notice}, as said.")} == {name}


def test_common_word_pairs_open_no_windows():
    """Stretches that no template can be found in are left out, and nothing that is found in the whole text is lost."""
    rnd, scanner = random.Random(8), licenses.Scanner()
    pairs = ["in the", "of the", "that the following", "to the terms of the", "with the license", "version 3 of"]
    plain = " ".join(rnd.choice(pairs) + " " + prose(rnd, 5) for _ in range(300))
    assert scanner.near(scanner.shingles(scanner.words(plain))) == []
    notices = [n for own in licenses.TEMPLATES.values() for n in own]
    for _ in range(30):
        words = []
        for notice in rnd.sample(notices, 3):
            cut = notice.split()[rnd.randrange(3):]
            words += [*plain.split()[:rnd.randrange(900)], *cut[:rnd.randint(1, len(cut))], *notice.split(), *plain.split()[:rnd.randrange(300)]]
        h = scanner.words(" ".join(words))
        whole = scanner.scan_words(h)
        assert whole and scanner.scan(" ".join(words)) == whole
