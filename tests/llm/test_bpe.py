"""Byte-pair encoding against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from churnlens.llm.bpe import LONG_WORD, WordBpe, digests, encode_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    return WordBpe(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return b"".join(i.to_bytes(4, "little") for i in ids), library.decode(ids, skip_special_tokens=False)


def test_every_code_point(library, own):
    """All planes that hold characters; the others are unassigned or for private use throughout."""
    points = [chr(c) for c in (*range(0x35000), *range(0xE0000, 0xE1000), 0xF0000, 0x100000, 0x10FFFF)
              if not 0xD800 <= c <= 0xDFFF]
    for first in range(0, len(points), 20):
        some = points[first:first + 20]
        text = " ".join(f"a{c}a{c}1{c}" for c in some)
        assert own.encode_decode(text) == expected(library, text), [hex(ord(c)) for c in some]


def test_random_texts(library, own):
    rnd = random.Random(5)
    signs = "aAbB'sStTdDlLmM 123²½éÉñ\n\t \x1c\x85ΣςİKⅧ<|endoftext|>_-!?.,é日本😀"
    for _ in range(4000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randrange(30)))
        if rnd.random() < 0.2:
            text += rnd.choice(["<|endoftext|>", "<|startoftext|><|endoftext|>x", "<|ENDOFTEXT|>"]) + text[:3]
        assert own.encode_decode(text) == expected(library, text), text


def test_every_latin_sign(library, own):
    for c in range(0x250):
        text = f"a{chr(c)}b {chr(c)}1{chr(c)}"
        assert own.encode_decode(text) == expected(library, text), hex(c)


def test_long_words_take_the_heap(library, own):
    rnd = random.Random(1)
    for word in ["a" * 3000, "the" * 500, "é" * 400, "!" * 999,
                 "".join(rnd.choice("aeinrstlo") for _ in range(5000))]:
        assert len(word) > LONG_WORD
        assert own.encode_decode(word) == expected(library, word)
    for _ in range(300):  # both ways give the same parts
        ids = [own.inner[rnd.choice(b"thenigras")] for _ in range(rnd.randrange(1, 60))]
        assert own._scan(list(ids)) == own._heap(list(ids))


def test_frame(spark, library):
    texts = [None, "", " \n", "Hello  World's 123", "x" * 50_000, "Hello  World's 123", "naïve <|endoftext|> Σ"]
    rows = [(i if i != 3 else None, t, "en", 1, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens int, ids string")
    got = digests(encode_documents(df, PATH)).collect()
    want = []
    for (doc_id, text, *_) in rows:
        ids, decoded = expected(library, text)
        want.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert encode_documents(df.limit(0), PATH).collect() == []
