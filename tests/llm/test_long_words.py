"""Byte-level BPE of words far longer than a query over short words can hold, against tiktoken."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from voltframe.llm import bpe

RANKS = bpe.parse_ranks(bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
N = 100_000
CLASSES = {"letters": "abcdefghijklmnopqrstuvwxyz", "bases": "ACGT", "digits": "0123456789", "marks": "-=_*#.!/\\", "ruler": "-", "blanks": " ", "white space": " \n\t", "one letter": "a"}


def encoding(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(coder, own, texts):
    for t, (ids, decoded) in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(t), t[:40]
        assert decoded == t.encode()


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(RANKS, public_tokenizers.PATTERN)


def test_runs_of_each_class(coder):
    rng = random.Random(1)
    texts = ["".join(rng.choices(c, k=N)) for c in CLASSES.values()]
    texts.append("".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(N // 3)))
    texts.append("".join(rng.choices(["inter", "nation", "alization", "ing", "the", "er"], k=N // 5)))
    check(coder, encoding(RANKS), texts)


def test_many_words_of_sixty_bytes(coder):
    rng = random.Random(2)
    check(coder, encoding(RANKS), [" ".join("".join(rng.choices(["inter", "ation", "ising", "their"], k=12)) for _ in range(25_000))])


def test_ranks_in_any_order():
    """Vocabularies where joining two tokens can make a pair of lower rank."""
    rng = random.Random(3)
    for _ in range(25):
        extra = sorted({"".join(rng.choices("abc", k=rng.randint(2, 5))).encode() for _ in range(rng.randint(5, 40))})
        rng.shuffle(extra)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(extra)}
        check(bpe.Coder(ranks, public_tokenizers.PATTERN), encoding(ranks), [" ".join("".join(rng.choices("abc", k=rng.randint(65, 150))) for _ in range(20))])


def test_words_of_millions_of_bytes(coder):
    """Cut where no token lies across, they need no more memory than short ones."""
    rng = random.Random(4)
    check(coder, encoding(RANKS), ["".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(700_000)), "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_500_000))])
