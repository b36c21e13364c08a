import numpy as np
import public_tokenizers
import pytest
from helpers import frame, mixed_texts, sha
from markbook.llm import bpe_lexicon as B

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["it's <|endoftext|> we'll\n\n  two   spaces\t\tx  ", "a   b \n c\n  d. e,\n\n f  ", " lead, tail. ", "éa İß é ²½ ٣",
       "\x1c\x1d  \x1f hi \x85 x　y", " " * 700, "日本語 한국어 \U0001f600\U0001f600"]


def test_ids_and_decoded_text_equal_the_library(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    texts = mixed_texts() + ODD
    rows = B.encode_documents(spark, frame(spark, texts), PATH, lexicon_words=300).collect()
    assert len(rows) == len(texts)
    for r, t in zip(rows, texts):
        text = (t[1] if isinstance(t, tuple) else t) or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes())), text[:50]
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False).encode())


def test_automaton_is_minimal_and_finds_exactly_its_words():
    entries = {w.encode(): np.array([i, i + 1], "<u4").tobytes() for i, w in enumerate(
        "walking talking walked talked walks talks king ring walk".split())}
    lexicon = B.Lexicon(B.compile_lexicon(entries.items()))
    words = [*entries, b"talk", b"walkin", b"", b"zzz", b"kingx", b"x" * 100]
    assert lexicon.find(words) == [entries.get(w) for w in words]
    assert len(lexicon.final) < 1 + len({w[:i] for w in entries for i in range(1, len(w) + 1)})
    # two states with the same right language would have the same final flag, labels and targets
    states = [tuple((k & 255, t) for k, t in zip(lexicon.key, lexicon.to) if k >> 8 == s) for s in range(len(lexicon.final))]
    assert len(set(zip(lexicon.final.tolist(), states))) == len(states)


@pytest.mark.parametrize("n", [5, 300, 700])
def test_long_merges_equal_short_ones(n):
    v = B.Vocabulary(PATH)
    word = (b"abcabcabdaab" * 60)[:n]
    assert v._merge_long([word[i:i + 1] for i in range(n)]) == v.merge(word)


def test_empty_table(spark):
    assert B.encode_documents(spark, frame(spark, []), PATH).collect() == []
