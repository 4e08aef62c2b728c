import random

import pytest

from tarazi.llm import bpe

VOCABULARY = bpe.VOCABULARY


@pytest.fixture(scope="module")
def encoder():
    try:
        return bpe.Encoder(open(VOCABULARY, "rb").read())
    except FileNotFoundError:
        pytest.skip("no vocabulary here")


TEXTS = ["", "Hello world", "'S don't I'LL  \n\n  a<|endoftext|>", "a" * 4000, "ə" * 3000 + " x", " " * 1000 + "b", "　​ \t", "Şəkərli çay 1,5 L — 3.49 ₼ 🛒👍🏽", "Привет, мир! 中文标签", "\x00� é"]


@pytest.mark.parametrize("text", TEXTS)
def test_same_as_the_public_library(encoder, text):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    assert encoder.encode(text) == t.encode(text, add_special_tokens=False).ids


def test_round_trip(encoder):
    back = {v: k for k, v in encoder.ranks.items()}
    rnd = random.Random(3)
    for _ in range(200):
        text = "".join(rnd.choice("abc üəşЖ 12\n.,🛒") for _ in range(rnd.randrange(60)))
        assert b"".join(back[i] for i in encoder.encode(text)).decode() == text


def test_tree_against_a_list():
    rnd = random.Random(5)
    for n in (1, 2, 3, 7, 64, 100):
        ranks = [rnd.choice([1, 2, 3, bpe.NONE]) for _ in range(n)]
        tree = bpe.PairTree(list(ranks))
        for _ in range(100):
            low = min(ranks)
            assert tree.leftmost_lowest() == (-1 if low == bpe.NONE else ranks.index(low))
            i = rnd.randrange(n)
            ranks[i] = rnd.choice([1, 2, 3, bpe.NONE])
            tree.set(i, ranks[i])


def test_corpus(spark, encoder):
    rows = [(1, "Hello", "x"), (1, "Hello", "x"), (2, "", None), (3, None, "y"), (None, "a b" * 50_000, "z")]
    out = bpe.encode_corpus(spark.createDataFrame(rows, "doc_id long, text string, ids string"))
    assert out.columns == ["doc_id", "ids"]
    got = sorted(((r.doc_id, len(r.ids)) for r in out.collect()), key=lambda x: (x[0] is None, x))
    assert got == [(1, 1), (1, 1), (2, 0), (3, 0), (None, len(encoder.encode("a b" * 50_000)))]
    assert bpe.encode_corpus(spark.createDataFrame([], "doc_id long, text string")).count() == 0
