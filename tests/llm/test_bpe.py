import hashlib
import random

import numpy as np
import pytest

from hourglass.llm import bpe
from hourglass.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def pair():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    tok.no_padding()
    tok.no_truncation()
    return bpe.Codec(open(tokenizer_path(), "rb").read()), tok


def same(pair, text):
    codec, tok = pair
    ids = codec.encode(text)
    want = tok.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert codec.decode(ids) == tok.decode(want, skip_special_tokens=False)


def test_random_texts_equal_the_library(pair):
    r = random.Random(5)
    rare = [chr(i) for i in range(0x3000) if not 0xD800 <= i < 0xE000] + [chr(i) for i in range(0x1F300, 0x1F700)]
    for i in range(3000):
        text = "".join(r.choice(rare if r.random() < 0.2 else "  \n\t'stremvld abcABC019!?\u0085\x1c ") for _ in range(r.randint(0, 80)))
        text += r.choice(["", "aaaa", "the", "  ", "\n\n", "!!", "<|endoftext|>"]) * r.randint(0, 30)
        same(pair, text)


def test_all_vocabulary_entries_and_pairs(pair):
    codec, tok = pair
    r = random.Random(6)
    names = [tok.decode([i], skip_special_tokens=False) for i in r.sample(range(50256), 1500)]
    for a, b in zip(names, names[1:]):
        same(pair, a + b)


def test_long_texts_and_pieces(pair, monkeypatch):
    same(pair, "ab" * 50_000)
    same(pair, "hello world's  end\n" * 5000)
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    same(pair, "hello world's  end\n it's a <|endoftext|>test " * 50)
    monkeypatch.setattr(bpe, "MEMO", 3)
    same(pair, "more words than the memo holds, and pairs too " * 5)


def test_documents(spark, make_docs, odd_rows, pair):
    docs = make_docs(odd_rows, extra=True)
    out = bpe.encode_documents(spark, docs, tokenizer_path()).collect()
    assert len(out) == len(odd_rows)
    by_text = {hashlib.sha256((t or "").encode()).hexdigest() for _, t, *_ in odd_rows}
    for row in out:
        assert row.n_tokens == len(row.ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(row.ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 in by_text
    assert bpe.encode_documents(spark, make_docs([]), tokenizer_path()).count() == 0
