"""Small inputs for the training-data operators: every edge case the docstrings name."""

import hashlib
import random

SCHEMA = "lang string, doc_id long, text string, source string, n_chars int, cls long, row_key long, token string, __row int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau".split()


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", "x", "y", "zz"]) + str(rnd.randint(0, 40)) for _ in range(n))


def near(rnd, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"edit{rnd.randint(0, 999)}"
    return " ".join(words)


def frame(spark, texts, langs=None):
    """Documents with ids from 0 (``(id, text)`` pairs keep their own), and columns that clash
    with names the operators use."""
    rows = []
    for i, t in enumerate(texts):
        doc, text = t if isinstance(t, tuple) else (i, t)
        lang = langs[i] if langs else "en"
        rows.append((lang, doc, text, "src0", None if text is None else len(text), 7, 8, "t", 9))
    return spark.createDataFrame(rows, SCHEMA)


def mixed_texts(seed=1):
    """Unique texts, copies, near copies, a shared passage, and the odd ones."""
    rnd = random.Random(seed)
    passage = prose(rnd, 90)
    texts = [prose(rnd, rnd.choice([1, 3, 5, 12, 40, 120, 300])) for _ in range(40)]
    base = prose(rnd, 150)
    texts += [base, base, base] + [near(rnd, base, k) for k in (1, 1, 2, 3, 5, 8, 20)]
    texts += [prose(rnd, 30) + " " + passage + "\n" + prose(rnd, 25) for _ in range(6)]
    texts += [None, "", " ", "\n\n", "one two three four", "one two three four", "ONE two  three\tfour", "a" * 3000, "ab" * 900]
    texts += ["long " + prose(rnd, 4000), (3, texts[3]), (None, base), (77, texts[5])]
    return texts


def sha(b):
    return hashlib.sha256(b).hexdigest()
