import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from hourglass.llm import alignment as al
from hourglass.llm.bpe import byte_alphabet
from hourglass.llm.queries import tokenizer_path

B_PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def models():
    import sentencepiece
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    tok.encode_special_tokens = True
    tok.no_padding()
    tok.no_truncation()
    return tok, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def spans(names):
    out, at = [], 0
    for n in names:
        out.append((at, at + len(n)))
        at += len(n)
    return out


def one(models, text):
    """(a ids, b ids, groups text, linked pairs), token by token."""
    tok, sp = models
    if not text:
        return [], [], "", []
    alphabet = byte_alphabet()
    e = tok.encode(" " + text, add_special_tokens=False)
    a, names_a = e.ids, [bytes(alphabet[c] for c in t) for t in e.tokens]
    b = sp.encode(text)
    names_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, sp.id_to_piece(i)) for i in b)]
    if b"".join(names_a) != (" " + text).encode() or b"".join(names_b) != (" " + text).encode():
        return [], [], "", []
    sa, sb = spans(names_a), spans(names_b)
    links = [(x, y) for x, (s, e) in zip(a, sa) for y, (u, v) in zip(b, sb) if s < v and u < e]
    common = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, start = [], 0
    for end in common:
        groups.append(",".join(str(x) for x, (s, e) in zip(a, sa) if start <= s and e <= end) + "|" + ",".join(str(x) for x, (s, e) in zip(b, sb) if start <= s and e <= end))
        start = end
    return a, b, ";".join(groups), links


def expected(models, rows):
    done = [(i, *one(models, t)) for i, t, *_ in rows]
    count = Counter(p for *_, links in done for p in set(links))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    return sorted(((i, len(a), len(b), len(g.split(";")) if g else 0, len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(g.encode()).hexdigest() if g else "") for i, a, b, g, links in done), key=str)


def texts(seed, n):
    r = random.Random(seed)
    words = ["the", "stremvld", " ", "  ", "\n", "é", "日本語", "\U0001f600", "<|endoftext|>", "<s>", "▁", "don't", "1234", "\t", "<0x41>", "é", "ﬁ", "\x00", "a" * 30]
    return [" ".join(r.choice(words) for _ in range(r.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("docs, held, batch", [(al.DOCS, al.HELD, al.BATCH), (32, 200, 60)])
def test_equals_token_by_token(spark, make_docs, monkeypatch, models, docs, held, batch):
    for name, value in (("DOCS", docs), ("HELD", held), ("BATCH", batch)):
        monkeypatch.setattr(al, name, value)
    odd = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c d e"), (4, "a b c d e"), (None, "a b c d e"), (None, None), (7, "x" * 3000), (8, "▁"), (9, "a b c d e", None, None)]
    rows = odd + [(10 + i, t) for i, t in enumerate(texts(4, 300))]
    out = al.align(spark, make_docs(rows, extra=True), tokenizer_path(), B_PATH)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == expected(models, rows)


def test_encoders_agree_on_rare_characters(models):
    import json
    raw = open(tokenizer_path(), "rb").read()
    spec = json.loads(raw)
    spec["model"]["merges"][0], spec["model"]["merges"][1] = spec["model"]["merges"][1], spec["model"]["merges"][0]
    (fast, names), (other, _) = al.byte_level(raw), al.byte_level(json.dumps(spec).encode())  # the second through the library
    chars = [chr(i) for i in range(0, 0x110000, 37) if not 0xD800 <= i < 0xE000]
    texts = [f" a{c}1{c}{c} {c}b{c}'s  {c}\n<|endoftext|>" for c in chars]
    want = [e.ids for e in models[0].encode_batch(texts, add_special_tokens=False)]
    assert fast(texts) == want
    assert len(other(texts)) == len(want) and b"".join(names[i] for i in want[5]).decode() == texts[5]


def test_long_text(spark, make_docs):
    words = [f"w{i * 7919 % 997}" for i in range(120_000)]
    rows = al.align(spark, make_docs([(1, " ".join(words)), (2, "y" * 200_000)]), tokenizer_path(), B_PATH).orderBy("doc_id").collect()
    assert rows[0].n_links >= max(rows[0].n_a, rows[0].n_b) and rows[0].count_sum == rows[0].n_links
    assert rows[1].n_links == rows[1].n_a + rows[1].n_b - rows[1].n_groups


def test_no_rows(spark, make_docs):
    assert al.align(spark, make_docs([]), tokenizer_path(), B_PATH).count() == 0


def test_pack_and_unpack():
    r = np.random.default_rng(1)
    key = np.unique(r.integers(0, 200, 40_000) ** 2 // 40 * al.DOCS + r.integers(0, al.DOCS, 40_000))
    links = r.integers(1, 3, len(key)) ** r.integers(0, 12, len(key))
    pair, n, (docs, size), (planes, p_size) = al.pack(key // al.DOCS, key % al.DOCS, links)
    assert n.sum() == len(key) and (size == al.DOCS // 8).any() and (size < al.DOCS // 8).any()
    cut = lambda data, sizes: [data[e - s : e].tobytes() for s, e in zip(sizes, np.cumsum(sizes))]
    of, doc, back = al.unpack(cut(docs, size), cut(planes, p_size))
    assert (pair[of] * al.DOCS + doc == key).all() and (back == links).all()
    assert all(len(x) == 0 for x in al.unpack([], []))
