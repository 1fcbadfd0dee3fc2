"""Language of words longer than a piece: every letter counts."""

import random

from dockmill.llm import langid
from dockmill.llm.langid import PIECE, features, positions, train

SYLLABLES = {"en": ["the", "and", "ing", "tion", "er"], "de": ["der", "und", "sch", "keit", "ü"]}


def glued(rng, lang, n):
    return "".join(rng.choice(SYLLABLES[lang]) for _ in range(n))


def test_pieces_have_the_words_features_once():
    rng = random.Random(3)
    for n in (1, 2, 3, PIECE - 1, PIECE, PIECE + 1, PIECE + 2, 2 * PIECE, 2 * PIECE + 1, 333):
        word = "".join(rng.choice("abcdefgh") for _ in range(n))
        assert len(positions(word)) == -(-n // PIECE)
        assert sorted(i for p in positions(word) for i in features(p)) == sorted(features(word))
    assert len(features("a" * 100)) == 3 + 3 + 99 + 98 + 1
    assert positions("1" * 100) == ["1" * 100] and positions("a-" * 30) == ["a-" * 30]


def test_a_switch_inside_a_word_is_seen():
    rng = random.Random(4)
    field = train([(" ".join(glued(rng, k, rng.choice((2, 3, 40))) for _ in range(40)), k) for k in SYLLABLES for _ in range(30)], steps=60)
    got = field.predict([glued(rng, "en", 12) + glued(rng, "de", 200), glued(rng, "de", 200), "-".join([glued(rng, "en", 3)] * 6 + [glued(rng, "de", 3) for _ in range(60)])])
    assert [label for label, _ in got] == ["de"] * 3 and 0.5 < got[0][1] < 0.99 < got[1][1]
    assert langid.Field(field.labels, field.weights, field.transitions).predict(["1" * 100]) == [("und", 0.0)]
