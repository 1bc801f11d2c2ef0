"""Language of runs of more letters than a word's block of features has."""

import numpy as np
import pytest

from voltframe.llm import language

STEMS = {"aa": ["lor", "mip", "dol"], "bb": ["zak", "wux", "qey"]}


def text(rng, lang, n, sep=""):
    return sep.join("".join(rng.choice(STEMS[lang], 2)) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(2)
    return language.fit([(text(rng, x, 40, " "), x) for x in STEMS for _ in range(60)])


def test_language_after_the_first_letters(model):
    rng = np.random.default_rng(3)
    head = text(rng, "aa", 4)
    assert len(head) == language.LETTERS
    # ends alike, so that only the letters between tell
    runs = [head + text(rng, x, 60) + head[-6:] for x in STEMS]
    assert language.Tagger(model).documents(runs)[0] == ["aa", "bb"]
    # a long run weighs more than a short word beside it
    assert language.Tagger(model).documents(["lormip lormip " + text(rng, "bb", 60)])[0] == ["bb"]


def test_grams_do_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(4)
    words = [text(rng, "aa", n) for n in (1, 4, 5, 9, 40)] + ["é" * 25, "中文" * 31]

    def brute(w):
        c, out = [0, *map(ord, w), 0], []
        for n in (2, 3):
            for i in range(len(c) - n + 1):
                h = 0
                for x in c[i : i + n]:
                    h = (h ^ x) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
                    h ^= h >> 29
                out.append((h >> 20 & language.SLOTS - 1) + language.KINDS * language.SLOTS)
        return sorted(out)

    for piece in (7, 26, 27, 28, 40, 1 << 16):
        monkeypatch.setattr(language, "PIECE", piece)
        got = [[] for _ in words]
        for line, number in language.long_grams(words):
            assert (np.diff(line) >= 0).all()
            for j, x in zip(line, number, strict=True):
                got[j].append(int(x))
        assert [sorted(g) for g in got] == [brute(w) if len(w) > language.LETTERS else [] for w in words]
    table, real = language.feature_rows(words)
    for w, t, r in zip(words, table, real, strict=True):
        assert sorted(t[language.KINDS :][r[language.KINDS :]].tolist()) == (brute(w) if len(w) <= language.LETTERS else [])
