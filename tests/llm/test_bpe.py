import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import awkward, empty
from veil.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(library, texts):
    own = bpe.tokenizer(PATH)
    ids, counts = own.encode(pa.array(texts, pa.string()))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == want
    for text, x in zip(texts, got, strict=True):
        assert own.decode(np.array(x, "<u4")) == library.decode(x, skip_special_tokens=False) == text


def test_random_texts(library):
    rng = random.Random(5)
    bits = ["'", "s", "t", "re", "ve", "m", "ll", "d", " ", "  ", "\n", "\t", "\r", " ", "　", "a", "Z", "é", "1", "²", "½", "一", "!", '"', "<|endoftext|>", "<|", "😀", "\x1c", "\x85", "​"]
    same(library, ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(4000)])


def test_every_class_of_character(library):
    same(library, [f"x{chr(c)}x 1{chr(c)}1 {chr(c)} !{chr(c)}!" for c in [*range(0x800), *range(0x2000, 0x3100), 0x4E00, 0xAC00, 0x1F600, 0x10FFFF]])


def test_long_words_and_edges(library):
    same(library, ["", "a" * 5000, "ab" * 3000, " " * 500, "'" * 90, "<|endoftext|>" * 3, "don't 'street \n's", "\n \n a", "end  "])


def test_texts_do_not_run_together(library):
    same(library, ["<|endof", "text|>", "a", "b", " ", " c", "'", "s"])


def test_the_long_way_equals_the_short_way():
    own = bpe.tokenizer(PATH)
    rng = random.Random(1)
    for _ in range(200):
        word = "".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 60))).encode()
        assert own._encode_long([own.of_byte[b] for b in word]) == own.encode_word(word)


def test_tables(spark, library):
    docs = awkward(spark)
    rows = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    want = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    assert sorted((str(r.doc_id), r.text) for r in rows) == want
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens * 4 == len(r.ids)
    assert bpe.decode(bpe.encode(empty(spark), PATH), PATH).count() == 0
