"""BPE encoding and decoding against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leadweave.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.Vocabulary(PATH)


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def own(text, vocabulary=OWN):
    packed = vocabulary.encode(text)
    return np.frombuffer(packed, "<u4").tolist(), vocabulary.decode(packed)


def test_every_character():
    for start in range(0, 0x110000, 64):
        chars = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        text = " ".join(f"a{c}1 B{c}!'s{c}" for c in chars)
        assert own(text) == expected(text), hex(start)


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(seed):
    rng = random.Random(seed)
    pool = ["<|startoftext|>", "<|endoftext|>", "<|START", "Σ", "İ", "é", "é", "'s", "'LL", " ", "\t", "\x1c", " ", "ﬁ", "漢字", "1", "²", "Ⅷ",
            "😀", "!", "...", "a", "the", "\x00", "|>", "ß", "́", "Thing", "tokenization", "\r\n"]
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(0, 16)))
        assert own(text) == expected(text), repr(text)


def test_long_words_and_texts(monkeypatch):
    rng = random.Random(5)
    word = "".join(rng.choice("abcdetionß") for _ in range(30_000))
    text = " ".join("".join(rng.choice("etaoins'1") for _ in range(rng.randrange(1, 9))) for _ in range(20_000))
    assert own(word) == expected(word)
    monkeypatch.setattr(bpe, "PIECE", 1000)
    monkeypatch.setattr(bpe, "MEMORY", 50_000)  # the memory of words is emptied many times
    small = bpe.Vocabulary(PATH)
    assert own(text, small) == expected(text) and small.held <= 50_000
    assert own(word + " " + text, small) == expected(word + " " + text)


def test_merges_take_the_leftmost_lowest_rank():
    rng = random.Random(9)
    for _ in range(500):
        pairs = list({(rng.randrange(4), rng.randrange(4)) for _ in range(5)})
        rng.shuffle(pairs)
        pairs = [(a, b, rng.randrange(4)) for a, b in pairs]
        rank = {(a, b): n for n, (a, b, _) in enumerate(pairs)}
        symbols = [rng.randrange(4) for _ in range(rng.randrange(1, 30))]
        plain = list(symbols)
        while True:
            found = [(rank[p], i) for i, p in enumerate(zip(plain, plain[1:])) if p in rank]
            if not found:
                break
            r, i = min(found)
            plain[i : i + 2] = [pairs[r][2]]
        assert bpe.Merges(pairs).apply(symbols) == plain


def test_tables_of_all_kinds(spark):
    texts = ["Hello, world's end", None, "", " \n\t", "<|endoftext|>", "x" * 300_000, "héllo " * 50_000, "Hello, world's end"]
    rows = [(i, t, 1, 2) for i, t in enumerate(texts)] + [(None, "no id", 1, 2)]
    table = spark.createDataFrame(rows, "doc_id long, text string, id int, ids int")
    got = {r["id"]: r for r in bpe.encode(table, PATH).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        assert (np.frombuffer(got[i]["ids"], "<u4").tolist(), got[i]["decoded"]) == expected(text)
    again = {r["id"]: r["decoded"] for r in bpe.decode(bpe.encode(table, PATH), PATH).collect()}
    assert again == {i: r["decoded"] for i, r in got.items()}
    assert bpe.encode(table.limit(0), PATH).count() == 0
